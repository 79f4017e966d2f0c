"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation, and a unigram base.

Training documents are those whose crc32(id as text) mod 5 is not 1. Tokens are words, A-Z lower-cased, and one end
per document. Counts of all training words make the base.

The model predicts a token from the two before it. Its leaves are the end, the most frequent words, OWN times the root of
the number of tokens, and BUCKETS times that root of buckets, to which all other words are dealt by hash; so what is learned
grows with the corpus, and every word has vectors that take part. Within a bucket the counts decide. Leaves hang in a
tree: of the leaves below a node the most frequent are its children, the others are dealt to groups of about equal sums
of roots of frequencies, half of BRANCH at most, which are its children too, until BRANCH leaves or fewer are left. At each node on the way to its leaf a
token is predicted by one rule: the logit of a child is the product of its vector with the sum of the context's vectors, each
scaled by its position, plus a bias. The normaliser of a node is the sum over its children, by matrix products, so every
log-probability is exact, and a text of any words has one. There is one such form for corpora of all sizes.

Training uses all tokens of all training documents once, in ROUNDS rounds. Texts are dealt by hash to rounds and shards; the
number of shards follows from the number of tokens. In a round every shard trains on its part in an order that depends on
hashes only, beginning with the same parameters. Changes are merged by blocks of rows: a row moves by the mean of
the changes of the shards that used it, and so do its sums of squares. The next round begins with the result. Neither the number
of tasks nor the order in which they end plays a part. Parameters are kept as halves of 32 bits between rounds.

What all tasks hold is proportional to the root of the number of tokens: the table of TABLE times that root of counts, 12 bytes
a word, and the parameters, 66 bytes a leaf and 12 more while training.

* Null text counts as empty: its one token is the end. Null ids are training documents.
* Rows are scored one by one, so repeated rows and repeated ids give repeated results. Rows with equal ids and texts are
  dealt to shards in turn; which is which is up to their places in the table. An empty table gives an empty result. Without
  training documents every base probability is 1, and the model's is that of its first parameters.
* Words of equal counts are told apart by their hashes, so ties do not depend on order.
* Very long texts: encoding takes some 25 times the size of the longest text, training and scoring go by runs of tokens.
* Other columns of the input, whatever their names, take no part. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.blocks import LOWER, blocks, hash_spans, mix, word_spans
from palimpsest.storage import Scratch

FOLDS, HELD_OUT = 5, 1
OWN, BUCKETS, TABLE = 16, 4, 64  # Per root of the number of tokens: words with vectors of their own, buckets, counts sent to all tasks.
BRANCH = 256  # Children of a node.
SIZE = 16  # Of the vectors; the last component belongs to the bias.
CONSTANT = 0.125  # Last component of predicted vectors.
NOISE = 32  # Noise children of the root per batch; one per token further down.
BATCH = 2048
RATE = 0.1
ROUNDS = 4
SHARD_TOKENS, SHARD_ROOT = 1 << 20, 200  # Tokens of a shard in a round: at least the first, and this many times the root.
POOL = 1 << 18  # Tokens shuffled among one another.
CUT = 1 << 15  # Tokens of a text that go to one shard together.
RUN = 1 << 19  # Tokens scored at once.
PART = 2048  # Rows of parameters merged together.
CELLS = 1 << 17  # Logits held at once when scoring.
STRIDE = 1 << 13  # Predicted vectors made at once when scoring.
SEED = 20240101
END = np.uint64(0x5F3A9D0C47E1B286)  # Stands for the hash of the end.

ENCODED = (
    "seq long, id long, held_out boolean, n_tokens long, known long, base double, inner double, turn int, key long, words binary, rare array<long>"
)
SCORED = "seq long, id long, held_out boolean, n_tokens long, known long, base double, lm double"


class Tree:
    """Nodes below the root, numbered so that children of one parent follow one another."""

    def __init__(self, frequencies: np.ndarray, branch: int = BRANCH):
        """frequencies: of the leaves, falling."""
        roots = np.sqrt(frequencies + 0.5)
        levels, nodes, first, last = [], [], [], []
        level, count = [(0, len(frequencies))], 0
        while level:
            below, of_leaf = [], np.full(len(frequencies), -1, np.int32)
            for a, b in level:
                groups = 0 if b - a <= branch else min(branch // 2, 1 + (b - a) // branch)
                edges = np.arange(a, min(b, a + branch - groups) + 1)
                if groups:
                    mass = np.cumsum(roots[edges[-1] : b])
                    cuts = edges[-1] + np.searchsorted(mass, mass[-1] * np.arange(1, groups) / groups)
                    edges = np.unique(np.concatenate([edges, cuts, [b]]))
                n = len(edges) - 1
                of_leaf[a:b] = np.repeat(np.arange(count, count + n), np.diff(edges))
                below += [(int(x), int(y)) for x, y in zip(edges, edges[1:], strict=False) if y - x > 1]
                nodes.append(np.add.reduceat(frequencies[:b], edges[:-1]))
                first.append(np.full(n, count))
                last.append(np.full(n, count + n))
                count += n
            levels.append(of_leaf)
            level = below
        self.paths = np.stack(levels, axis=1)  # By leaf and depth: the node, or -1 below the leaf.
        self.first, self.last = np.concatenate(first).astype(np.int32), np.concatenate(last).astype(np.int32)  # Of a node's siblings.
        self.mass = np.concatenate([[0.0], np.cumsum(np.concatenate(nodes) + 0.5)])
        self.low, self.width = self.mass[self.first], self.mass[self.last] - self.mass[self.first]
        self.chances = np.log(np.diff(self.mass) / self.width).astype(np.float32)  # Logs of the shares among siblings.


def leaves_for(tokens: int, per_root: float) -> int:
    return math.ceil(per_root * math.sqrt(tokens))


@dataclass
class Vocabulary:
    """Counts of the most frequent words by ascending hash, their leaves, and totals over all words."""

    keys: np.ndarray
    counts: np.ndarray
    leaves: np.ndarray
    of_bucket: np.ndarray  # Leaf of each bucket.
    bucket_totals: np.ndarray  # Smoothed sums of the counts in each bucket.
    frequencies: np.ndarray  # Of the leaves, falling.
    tokens: int  # N
    types: int  # V
    end: int  # Leaf of the end.

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, tokens: int, types: int, buckets: np.ndarray, bucket_types: np.ndarray, own: int) -> Vocabulary:
        """keys ascend and are the most frequent words; buckets: sums of counts and numbers of all words by bucket."""
        order = np.lexsort((keys, -counts))
        order = order[keys[order] != END][:own]
        n = len(order)
        frequencies = np.zeros(1 + n + len(buckets))
        frequencies[1 : n + 1] = counts[order]
        frequencies[0] = counts[keys == END].sum()
        apart = np.concatenate([order, np.flatnonzero(keys == END)])  # Words that are in no bucket.
        of_apart = bucket_of(keys[apart], len(buckets))
        sums = buckets - np.bincount(of_apart, counts[apart], len(buckets))
        frequencies[n + 1 :] = sums
        rank = np.empty(len(frequencies), np.int32)
        rank[np.lexsort((np.arange(len(frequencies)), -frequencies))] = np.arange(len(frequencies))
        of_bucket = rank[n + 1 :]
        leaves = of_bucket[bucket_of(keys, len(buckets))]
        leaves[order], leaves[keys == END] = rank[1 : n + 1], rank[0]
        totals = sums + 0.5 * (bucket_types - np.bincount(of_apart, minlength=len(buckets)) + 1)
        return cls(keys, counts, leaves, of_bucket, totals, np.sort(frequencies)[::-1], tokens, types, int(rank[0]))

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Leaf, count (-1 where the table does not say), log10 of the probability by counts alone (0 where it does not say)
        and of that within the leaf, without the word's own count where that is not known."""
        unique, inverse = np.unique(hashes, return_inverse=True)
        buckets = bucket_of(unique, len(self.of_bucket))
        leaves, counts = self.of_bucket[buckets], np.full(len(unique), -1, np.int64)
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, unique), len(self.keys) - 1)
            known = self.keys[at] == unique
            leaves[known], counts[known] = self.leaves[at[known]], self.counts[at[known]]
        leaves[unique == END] = self.end
        inner = np.where(leaves == self.of_bucket[buckets], -np.log10(self.bucket_totals[buckets]), 0)
        smooth = np.log10(np.maximum(counts, 0) + 0.5)
        inner[(inner != 0) & (counts >= 0)] += smooth[(inner != 0) & (counts >= 0)]
        base = np.where(counts >= 0, smooth - math.log10(self.base_total), 0)
        return leaves.take(inverse), counts.take(inverse), base.take(inverse), inner.take(inverse)

    @property
    def base_total(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return hashes.view(np.int64) % buckets


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, ends included, and the row of each."""
    data = LOWER[data]
    starts, ends, rows = word_spans(data, offsets)
    n = len(offsets) - 1
    hashes = np.full(len(starts) + n, END, np.uint64)
    hashes[np.arange(len(starts)) + rows] = hash_spans(data, starts, ends)
    return hashes, np.repeat(np.arange(n), np.bincount(rows, minlength=n) + 1)


def contexts(words: np.ndarray, rows: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The leaf before each and the one before that; ends stand for what is before a text."""
    result = []
    for back in (1, 2):
        shifted = np.full_like(words, end)
        if len(words) > back:
            shifted[back:] = np.where(rows[back:] == rows[:-back], words[:-back], end)
        result.append(shifted)
    return result[0], result[1]


class Model:
    """Vectors of leaves as contexts, vectors of nodes, scales of the two positions, and for each row of these its
    sum of squares, by which AdaGrad shortens its steps.

    The last component of every predicted vector is CONSTANT, about the size of the others, so that of a node's vector acts as its
    bias: by how much the node's logit lies above the log of its share among its siblings.
    """

    def __init__(self, tree: Tree, groups: list[np.ndarray], squares: list[np.ndarray]):
        self.tree = tree
        self.context, self.node, self.scale = self.groups = groups
        self.squares = squares

    @classmethod
    def initial(cls, tree: Tree) -> Model:
        draw = np.random.default_rng(SEED)
        context, node = (0.1 * draw.standard_normal((n, SIZE), np.float32) for n in (len(tree.paths), len(tree.chances)))
        context[:, -1], node[:, -1] = CONSTANT / 2, 0
        groups = [context, node, np.ones((2, SIZE), np.float32)]
        return cls(tree, [_rounded(g) for g in groups], [np.zeros(len(g), np.float32) for g in groups])

    def copy(self) -> Model:
        return Model(self.tree, [g.copy() for g in self.groups], [s.copy() for s in self.squares])

    def train(self, w1: np.ndarray, w2: np.ndarray, words: np.ndarray, draw: np.random.Generator) -> None:
        """One step of noise-contrastive estimation with AdaGrad on a batch of leaves and their contexts."""
        tree, paths = self.tree, self.tree.paths.take(words, axis=0)
        c1, c2 = self.context.take(w1, axis=0), self.context.take(w2, axis=0)
        predicted = c1 * self.scale[0] + c2 * self.scale[1]
        top = int(tree.last[0])
        target, drawn = paths[:, 0], np.minimum(np.searchsorted(tree.mass[1 : top + 1], tree.mass[top] * draw.random(NOISE), "right"), top - 1)
        vectors, others = self.node.take(target, axis=0), self.node.take(drawn, axis=0)
        pull = _pull(np.einsum("ij,ij->i", predicted, vectors) - np.float32(math.log(NOISE)))
        push = _push(predicted @ others.T - np.float32(math.log(NOISE)))
        of_predicted = pull[:, None] * vectors + push @ others
        places, of_nodes = [target, drawn], [pull[:, None] * predicted, push.T @ predicted]
        for depth in range(1, paths.shape[1]):
            deep = np.flatnonzero(paths[:, depth] >= 0)
            target = paths[deep, depth]
            drawn = _searched(tree.mass, tree.low.take(target) + tree.width.take(target) * draw.random(len(deep))) - 1
            drawn = np.minimum(drawn, tree.last.take(target) - 1)
            here, vectors, others = predicted.take(deep, axis=0), self.node.take(target, axis=0), self.node.take(drawn, axis=0)
            pull = _pull(np.einsum("ij,ij->i", here, vectors))[:, None]
            push = _push(np.einsum("ij,ij->i", here, others))[:, None]
            of_predicted[deep] += pull * vectors + push * others
            places += [target, drawn]
            of_nodes += [pull * here, push * here]
        of_predicted[:, -1] = 0  # That component stays as it is.
        of_scale = np.stack([np.einsum("ij,ij->j", of_predicted, c1), np.einsum("ij,ij->j", of_predicted, c2)])
        self._step(1, np.concatenate(places), np.concatenate(of_nodes))
        self._step(0, np.concatenate([w1, w2]), np.concatenate([of_predicted * self.scale[0], of_predicted * self.scale[1]]))
        self._move(2, np.arange(2), of_scale)

    def _step(self, group: int, places: np.ndarray, gradients: np.ndarray) -> None:
        """Moves the rows at `places`, which may repeat, by the sums of their gradients."""
        places = places.astype(np.int32, copy=False)
        order = np.argsort(places)
        ranked = places.take(order)
        edges = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]]))
        begin, sizes = edges[:-1], edges[1:] - edges[:-1]
        step = gradients.take(order.take(begin), axis=0)
        several = np.flatnonzero(sizes > 1)  # Most rows have one gradient, which needs no sum.
        if len(several):
            sizes_of, grouped = sizes[several], order[np.repeat(sizes > 1, sizes)]
            step[several] = np.add.reduceat(gradients.take(grouped, axis=0), np.cumsum(sizes_of) - sizes_of, axis=0)
        self._move(group, ranked.take(begin), step)

    def _move(self, group: int, rows: np.ndarray, step: np.ndarray) -> None:
        """Moves distinct rows by their gradients, which are overwritten."""
        step /= np.float32(BATCH)
        squares = self.squares[group].take(rows) + np.einsum("ij,ij->i", step, step) / np.float32(SIZE)
        self.squares[group][rows] = squares
        step *= (np.float32(RATE) / np.sqrt(squares + np.float32(1e-10)))[:, None]
        step += self.groups[group].take(rows, axis=0)
        self.groups[group][rows] = step

    def log_chances(self, w1: np.ndarray, w2: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Natural logs of the probabilities of leaves after their contexts."""
        paths, vectors = self.tree.paths.take(words, axis=0), self.logit_vectors
        predicted = np.empty((len(words), SIZE), np.float32)
        for at in range(0, len(words), STRIDE):  # What is read by chance and what is made of it stay in the cache.
            part = slice(at, at + STRIDE)
            np.add(self.context.take(w1[part], axis=0) * self.scale[0], self.context.take(w2[part], axis=0) * self.scale[1], out=predicted[part])
        logs = np.zeros(len(words))
        for depth in range(paths.shape[1]):
            some = np.flatnonzero(paths[:, depth] >= 0)
            parents = self.tree.first.take(paths[some, depth])
            order = np.argsort(parents) if depth else slice(None)
            some, parents = some[order], parents[order]
            nodes = paths[some, depth]
            of_some = predicted.take(some, axis=0)
            here = np.einsum("ij,ij->i", of_some, vectors.take(nodes, axis=0))
            bounds = np.flatnonzero(np.diff(parents, prepend=-1, append=-1))
            for first, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                here[first:stop] -= _log_sums(of_some[first:stop], vectors[parents[first] : self.tree.last[nodes[first]]])
            logs[some] += here
        return logs

    @property
    def logit_vectors(self) -> np.ndarray:
        """Vectors of nodes with whole biases."""
        vectors = self.node.copy()
        vectors[:, -1] += self.tree.chances / np.float32(CONSTANT)
        return vectors


def _pull(logit: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(logit))


def _push(logit: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return -1 / (1 + np.exp(-logit))


def _searched(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    """searchsorted(edges, values, "right"); in rising order neighbours are found in the same places of memory."""
    order = np.argsort(values)
    found = np.empty(len(values), np.int64)
    found[order] = np.searchsorted(edges, values.take(order), "right")
    return found


def _log_sums(predicted: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """For each row the log of the sum of exp(predicted . vector) over all vectors."""
    rows = max(16, CELLS // len(vectors))
    if len(predicted) > rows:
        return np.concatenate([_log_sums(predicted[at : at + rows], vectors) for at in range(0, len(predicted), rows)])
    logits = predicted @ vectors.T
    with np.errstate(over="ignore", divide="ignore"):
        sums = np.exp(logits, out=logits) @ np.ones(len(vectors), np.float32)  # Much faster than sum().
        result = np.log(sums)
    if not (sums.min() > 1e-20 and sums.max() < 1e30):
        logits = predicted @ vectors.T
        top = logits.max(axis=1, keepdims=True)
        result = np.log(np.exp(logits - top).sum(axis=1)) + top[:, 0]
    return result


def _rounded(values: np.ndarray) -> np.ndarray:
    """The nearest halves, as 32-bit floats."""
    return np.clip(values, -6e4, 6e4).astype(np.float16).astype(np.float32)


def _narrow(docs: DataFrame, id: str, text: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col(id).cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return docs.select(F.col(id).cast("long").alias("id"), held_out.alias("held_out"), F.col(text).cast("string").alias("text"))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)

    def out(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        keys, counts = merged(parts)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["h", "c"])

    parts, held = [], 0
    for batch in batches:
        for _, data, offsets in blocks(batch, "text"):
            parts.append(np.unique(tokens_of(data, offsets)[0], return_counts=True))
            held += len(parts[-1][0])
            if held > 1_000_000:
                parts = [merged(parts)]
                held = len(parts[0][0])
                if held > 500_000:
                    yield out(parts)
                    parts, held = [], 0
    if parts:
        yield out(parts)


def count(narrow: DataFrame, scratch: Scratch) -> DataFrame:
    """(h, c): all training tokens."""
    rows = narrow.where("not held_out").select("text").mapInArrow(_count_batches, "h long, c long")
    return scratch.keep(rows.groupBy("h").agg(F.sum("c").alias("c")), "counts")


def vocabulary(counts: DataFrame, limit: int | None = None) -> Vocabulary:
    """The table for all tasks has the words down to the lowest count that keeps it within `limit` words or, without one,
    TABLE times the root of the number of tokens."""
    step = F.floor(F.log2("c") * 16).cast("int")  # Under 1,024 steps.
    steps = counts.groupBy(step.alias("step")).agg(F.count("*").alias("types"), F.sum("c").alias("tokens")).collect()
    tokens, types = sum(r["tokens"] for r in steps), sum(r["types"] for r in steps)
    limit = leaves_for(tokens, TABLE) if limit is None else limit
    lowest, taken = 1 << 20, 0
    for row in sorted(steps, reverse=True):
        if taken + row["types"] > limit:
            break
        lowest, taken = row["step"], taken + row["types"]
    table = counts.where((step >= lowest) | (F.col("h") == int(END.view(np.int64)))).toArrow()
    keys, found = (np.asarray(table.column(name).combine_chunks()) for name in ("h", "c"))
    keys = keys.view(np.uint64) if len(keys) else np.zeros(0, np.uint64)
    order = np.argsort(keys)
    n = max(1, leaves_for(tokens, BUCKETS))
    of_bucket = counts.groupBy(F.pmod("h", F.lit(n)).alias("bucket")).agg(F.sum("c").alias("c"), F.count("*").alias("n")).toArrow()
    at, sums, numbers = (np.asarray(of_bucket.column(name).combine_chunks()) for name in ("bucket", "c", "n"))
    buckets, bucket_types = np.zeros(n), np.zeros(n, np.int64)
    if len(at):
        buckets[at], bucket_types[at] = sums, numbers
    return Vocabulary.of(keys[order], found[order].astype(np.int64), tokens, types, buckets, bucket_types, leaves_for(tokens, OWN))


def encode(narrow: DataFrame, words: Vocabulary) -> DataFrame:
    """Leaves of every text, what the table says of its words, and hashes of the words that it does not know."""
    held = narrow.sparkSession.sparkContext.broadcast(words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                n = len(offsets) - 1
                hashes, rows = tokens_of(data, offsets)
                leaves, found, base, inner = table.look_up(hashes)
                here = found >= 0
                bounds = np.searchsorted(rows, np.arange(n + 1))
                key = _keys(hashes, bounds, part.column("id"))
                cuts = np.searchsorted(rows[~here], np.arange(n + 1)).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(cuts), pa.array(hashes[~here].view(np.int64)))
                packed = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(bounds * 4), pa.py_buffer(leaves.astype(np.int32))])
                arrays = [
                    part.column("seq"), part.column("id"), part.column("held_out"), pa.array(np.bincount(rows, minlength=n)),
                    pa.array(np.bincount(rows, found > 0, n).astype(np.int64)), pa.array(np.bincount(rows, base, n)),
                    pa.array(np.bincount(rows, inner, n)), pa.array((key % np.uint64(ROUNDS)).astype(np.int32)), pa.array(key.view(np.int64)),
                    packed.cast(pa.binary()), rare,
                ]
                yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in ENCODED.split(", ")])

    return narrow.withColumn("seq", F.monotonically_increasing_id()).mapInArrow(work, ENCODED)


def _keys(hashes: np.ndarray, bounds: np.ndarray, ids: pa.Array) -> np.ndarray:
    """A hash of id and words for each row; rows that agree in both are numbered."""
    place = (np.arange(len(hashes)) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.uint64)
    sums = np.add.reduceat(mix(hashes) * (2 * place + np.uint64(1)), bounds[:-1])
    numbers = np.array([0 if i is None else i + 1 for i in ids.to_pylist()], np.int64).view(np.uint64)
    key = mix(mix(sums) + mix(numbers * np.uint64(0x9E6C63D0876A9A47)))
    order = np.argsort(key, kind="stable")
    same = np.concatenate([[False], key[order][1:] == key[order][:-1]])
    if same.any():
        at = np.arange(len(key))
        times = np.empty(len(key), np.uint64)
        times[order] = (at - np.maximum.accumulate(np.where(same, 0, at))).astype(np.uint64)
        key = np.where(times > 0, mix(key + times), key)
    return key


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Leaves of all rows, and where each row begins and ends."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(column) else np.zeros(0, np.uint8)
    return data.view(np.int32), (offsets - offsets[0]) // 4


def _cut(shards: int, end: int):
    """Texts in parts of CUT leaves with the two leaves before them: (shard, place, words)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _words(batch.column("words"))
            keys, parts = [], []
            for key, a, b in zip(batch.column("key").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                for k, at in enumerate(range(a, b, CUT)):
                    before = data[at - 2 : at] if at > a else np.array([end, end], np.int32)
                    keys.append((key + k) & ((1 << 64) - 1))
                    parts.append(before.tobytes() + data[at : min(b, at + CUT)].tobytes())
            place = mix(np.array(keys, np.uint64))
            arrays = [pa.array((place % np.uint64(shards)).astype(np.int32)), pa.array(place.view(np.int64)), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["shard", "place", "words"])

    return work


def deal(rows: DataFrame, shards: int, end: int) -> DataFrame:
    """(shard, place, words): parts of texts, each shard in a task of its own. By a hash of their numbers some tasks would get several
    shards and others none."""
    return rows.mapInArrow(_cut(shards, end), "shard int, place long, words binary").repartitionById(shards, "shard")


def shards_for(tokens: int) -> int:
    return max(1, int(tokens // (ROUNDS * max(SHARD_TOKENS, SHARD_ROOT * math.sqrt(tokens)))))


def _changes(model: Model, before: Model, shard: int) -> Iterator[pa.RecordBatch]:
    """Rows that have changed, in blocks of PART: (kind, first, shard, at, data, squares)."""
    for kind, (now, then, squares, old) in enumerate(zip(model.groups, before.groups, model.squares, before.squares, strict=True)):
        used = np.flatnonzero(squares != old)
        bounds = np.searchsorted(used, np.arange(0, len(now) + PART, PART))
        for block, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)):
            if a < b:
                at = used[a:b]
                change = np.clip(now[at] - then[at], -6e4, 6e4).astype(np.float16)
                parts = [(at - block * PART).astype(np.int16), change, squares[at] - old[at]]
                arrays = [pa.array([kind]), pa.array([block * PART]), pa.array([shard])] + [pa.array([x.tobytes()], pa.binary()) for x in parts]
                yield pa.RecordBatch.from_arrays(arrays, ["kind", "first", "shard", "at", "data", "squares"])


def _merge_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean changes of blocks, whose parts come one after another in the order of shards."""
    current, sums = None, []

    def out() -> pa.RecordBatch:
        total, squares, times = sums
        at = np.flatnonzero(times)
        parts = [at.astype(np.int16), (total[at] / times[at, None]).astype(np.float16), (squares[at] / times[at]).astype(np.float32)]
        arrays = [pa.array([current[0]]), pa.array([current[1]])] + [pa.array([x.tobytes()], pa.binary()) for x in parts]
        return pa.RecordBatch.from_arrays(arrays, ["kind", "first", "at", "data", "squares"])

    for batch in batches:
        for row in batch.to_pylist():
            at = np.frombuffer(row["at"], np.int16)
            change = np.frombuffer(row["data"], np.float16).reshape(len(at), -1)
            if current != (row["kind"], row["first"]):
                if current:
                    yield out()
                current, sums = (row["kind"], row["first"]), [np.zeros((PART, change.shape[1])), np.zeros(PART), np.zeros(PART)]
            sums[0][at] += change
            sums[1][at] += np.frombuffer(row["squares"], np.float32)
            sums[2][at] += 1
    if current:
        yield out()


def _train_shards(held, seed: int):
    """Trains a copy of the model on each shard, whose rows come one after another in the order of their places."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = _unpacked(*held.value)
        shard = model = draw = None
        held_back = 0  # Tokens in the pool.
        pool: list[tuple[np.ndarray, ...]] = []

        def use(columns: tuple[np.ndarray, ...]) -> None:
            order = draw.permutation(len(columns[0]))
            for at in range(0, len(order), BATCH):
                pick = order[at : at + BATCH]
                model.train(*(column[pick] for column in columns), draw)

        def fill(parts: list[tuple[np.ndarray, ...]], least: int) -> list[tuple[np.ndarray, ...]]:
            """Uses whole pools while there are as many as `least` tokens; the rest is kept."""
            columns = tuple(np.concatenate(column) for column in zip(*parts, strict=True))
            while len(columns[0]) >= least and len(columns[0]):
                use(tuple(column[:POOL] for column in columns))
                columns = tuple(column[POOL:] for column in columns)
            return [columns]

        for batch in batches:
            data, bounds = _words(batch.column("words"))
            for now, a, b in zip(batch.column("shard").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if now != shard:
                    if pool:
                        fill(pool, 1)
                        yield from _changes(model, start, shard)
                    shard, model, draw, pool, held_back = now, start.copy(), np.random.default_rng([SEED, seed, now]), [], 0
                words = data[a:b]
                pool.append((words[1:-1], words[:-2], words[2:]))
                held_back += b - a - 2
                if held_back >= POOL:
                    pool = fill(pool, POOL)
                    held_back = len(pool[0][0])
        if pool:
            fill(pool, 1)
            yield from _changes(model, start, shard)

    return work


def _packed(model: Model, squares: bool = True) -> tuple:
    halves = [g.astype(np.float16) for g in model.groups]
    return model.tree, halves, model.squares if squares else [np.zeros(0, np.float32)] * len(halves)


def _unpacked(tree: Tree, halves: list[np.ndarray], squares: list[np.ndarray]) -> Model:
    return Model(tree, [h.astype(np.float32) for h in halves], squares)


def train(encoded: DataFrame, words: Vocabulary, shards: int | None = None) -> Model:
    """ROUNDS rounds over a written table of encoded texts. What reaches the driver is the mean change of each row."""
    shards = shards_for(words.tokens) if shards is None else shards
    model = Model.initial(Tree(words.frequencies))
    context = encoded.sparkSession.sparkContext
    for turn in range(ROUNDS):
        held = context.broadcast(_packed(model))
        rows = encoded.where(~F.col("held_out") & (F.col("turn") == turn)).select("key", "words")
        dealt = deal(rows, shards, words.end).sortWithinPartitions("shard", "place", "words")
        kind = "kind long, first long"
        sent = dealt.mapInArrow(_train_shards(held, turn), f"{kind}, shard long, at binary, data binary, squares binary")
        merged = sent.repartition("kind", "first").sortWithinPartitions("kind", "first", "shard")
        table = merged.mapInArrow(_merge_batches, f"{kind}, at binary, data binary, squares binary").toArrow()
        for row in (row for batch in table.to_batches(max_chunksize=64) for row in batch.to_pylist()):
            at = row["first"] + np.frombuffer(row["at"], np.int16).astype(np.int64)
            group = model.groups[row["kind"]]
            group[at] = _rounded(group[at] + np.frombuffer(row["data"], np.float16).reshape(len(at), -1))
            model.squares[row["kind"]][at] += np.frombuffer(row["squares"], np.float32)
        held.destroy()
    return model


def _score_batches(held, end: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _unpacked(*held.value)
        for batch in batches:
            n = len(batch)
            words, bounds = _words(batch.column("words"))
            rows = np.repeat(np.arange(n, dtype=np.int32), np.diff(bounds))
            w1, w2 = contexts(words, rows, end)
            logs = np.zeros(n)
            for at in range(0, len(words), RUN):
                run = slice(at, at + RUN)
                logs += np.bincount(rows[run], model.log_chances(w1[run], w2[run], words[run]), n)
            columns = [batch.column(f.split()[0]) for f in SCORED.split(", ")[:-1]]
            lm = pa.array(logs / math.log(10) + np.asarray(batch.column("inner")))
            yield pa.RecordBatch.from_arrays([*columns, lm], [f.split()[0] for f in SCORED.split(", ")])

    return work


def score(docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", limit: int | None = None, shards: int | None = None) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    narrow = _narrow(docs, id, text)
    every = count(narrow, scratch)
    words = vocabulary(every, limit)
    encoded = scratch.keep(encode(narrow, words), "encoded")
    model = train(encoded, words, shards)
    held = docs.sparkSession.sparkContext.broadcast(_packed(model, squares=False))
    scored = scratch.keep(encoded.drop("turn", "key", "rare").mapInArrow(_score_batches(held, words.end), SCORED), "scored")
    held.destroy()

    rare = encoded.select("seq", F.explode("rare").alias("h")).groupBy("h", "seq").agg(F.count("*").alias("n"))
    joined = rare.join(every, "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    sums = joined.groupBy("seq").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known_rare"),
        F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / F.lit(words.base_total))).alias("base_rare"),
        F.sum(F.col("n") * F.log10(F.col("c") + 0.5)).alias("lm_rare"),
    )
    nil = F.lit(0)
    return scored.join(sums, "seq", "left").select(
        "id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("known_rare", nil)).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rare", nil)).alias("base_score"),
        (F.col("lm") + F.coalesce("lm_rare", nil)).alias("score"),
    )
