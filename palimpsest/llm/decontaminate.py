"""Benchmark decontamination: words of documents that lie in a window of a benchmark item.

Words are runs of letters and digits (every character beyond ASCII counts as such), A-Z lower-cased. The windows of an
item are its runs of ten words; an item of fewer words, but not none, is one window. A document word is hit if it
lies in any place where the words of a window stand consecutively in the document. Hit spans or whole documents
can then be removed.

The windows of all items are kept as a sorted set of 64-bit hashes that goes to every task. A task hashes the windows of its
documents, looks them up in a table of bits and, if the bit is set, in the set, and compares the words of every hit with
those of the window, so no collision counts. Documents are not shuffled.

What goes to the tasks at once is bounded: items are put in slices of at most SLICE_BYTES of words, a longer item is
cut into parts that overlap by nine words, and each slice is one pass over the documents. One slice is the usual case;
of several, the hits of a document are put together by its row number.

* Null texts have no words, and so no windows and no hits. Items of equal windows all count. Items are told apart by
  their ids: rows with a repeated id are one item. A null id counts as an item whose id is empty text.
* Repeated documents and repeated ids of documents are rows of their own. Empty tables give empty results, and without items
  nothing is hit.
* A text is never split: very long ones need some 20 times their size in memory.
* Other columns, whatever their names, can be carried along in `row`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.blocks import LOWER, blocks, hash_spans, windows, word_spans
from palimpsest.storage import Scratch

WINDOW = 10
SLICE_BYTES = 4 << 20  # Of words that go to all tasks at once; what is made of them takes some 30 times as much.
BITS = 1 << 22  # Of the table looked at before the set.

SEPARATORS = np.ones(256, bool)  # All but [0-9A-Za-z] and what is beyond ASCII.
SEPARATORS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


@dataclass
class Words:
    """Words of some texts: the bytes of all words, each followed by a space, and where they lie."""

    data: np.ndarray
    starts: np.ndarray  # Of words in data.
    ends: np.ndarray
    rows: np.ndarray
    hashes: np.ndarray
    places: tuple[np.ndarray, np.ndarray]  # Of words in the texts as they were.

    @classmethod
    def of(cls, data: np.ndarray, offsets: np.ndarray) -> Words:
        data = LOWER[data]
        starts, ends, rows = word_spans(data, offsets, SEPARATORS)
        lengths = ends - starts
        after = np.cumsum(lengths + 1)
        inside = np.zeros(len(data) + 1, np.int8)
        inside[starts] = 1
        inside[ends] -= 1  # A word may begin where one of the row before ends.
        letters = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
        packed = np.full(int(after[-1]) if len(after) else 0, 0x20, np.uint8)
        packed[np.arange(len(letters)) + np.repeat(np.arange(len(lengths)), lengths)] = data[letters]
        return cls(packed, after - lengths - 1, after - 1, rows, hash_spans(data, starts, ends), (starts, ends))


class Windows:
    """The windows of a slice of items: ascending hashes, the words of each, and the items it occurs in."""

    def __init__(self, ids: list[str], texts: list[str], size: int = WINDOW):
        data = np.frombuffer(" ".join(texts).encode(), np.uint8)
        lengths = np.array([len(t.encode()) for t in texts], np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths + 1)])[: len(texts) + 1]
        offsets[-1] = len(data)
        words = Words.of(data, offsets)
        counts = np.bincount(words.rows, minlength=len(texts))
        short = {n: np.flatnonzero(counts == n) for n in set(counts[(counts > 0) & (counts < size)].tolist())}
        self.names, item_of = np.unique(np.array(ids, object), return_inverse=True) if ids else (np.zeros(0, object), np.zeros(0, np.int64))
        self.sizes, self.bytes = sorted([*short, size]), []
        found = []  # (hash, size, first word, item)
        for n in self.sizes:
            hashes, first = windows(words.hashes, words.rows, n)
            if n < size:
                whole = np.isin(words.rows[first], short[n])
                hashes, first = hashes[whole], first[whole]
            found.append((hashes, np.full(len(first), n), first, item_of[words.rows[first]]))
        hashes, of_size, first, items = (np.concatenate(parts) for parts in zip(*found, strict=True))
        text = words.data.tobytes()
        same: dict[tuple[int, bytes], set[int]] = {}  # By size and words; hashes of different words may agree.
        for h, a, b, item in zip(hashes.tolist(), words.starts[first].tolist(), words.ends[first + of_size - 1].tolist(), items.tolist(), strict=True):
            same.setdefault((h, text[a:b]), set()).add(item)
        entries = sorted(same.items())
        self.hashes = np.array([h for (h, _), _ in entries], np.uint64)
        self.bytes = [words for (_, words), _ in entries]
        self.items = [np.array(sorted(of), np.int64) for _, of in entries]
        self.bits = np.zeros(BITS, bool)
        self.bits[self.hashes >> np.uint64(64 - BITS.bit_length() + 1)] = True

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words of places where a window stands, its size, and its number among the windows."""
        found = []
        for size in self.sizes:
            hashes, first = windows(words.hashes, words.rows, size)
            some = np.flatnonzero(self.bits[hashes >> np.uint64(64 - BITS.bit_length() + 1)])
            hashes, first = hashes[some], first[some]
            low, high = np.searchsorted(self.hashes, hashes, "left"), np.searchsorted(self.hashes, hashes, "right")
            for k in np.flatnonzero(high > low).tolist():
                at = int(first[k])
                here = words.data[words.starts[at] : words.ends[at + size - 1]].tobytes()
                found += [(at, size, w) for w in range(int(low[k]), int(high[k])) if self.bytes[w] == here]
        columns = np.array(found, np.int64).reshape(-1, 3).T
        return columns[0], columns[1], columns[2]


def _spans(first: np.ndarray, sizes: np.ndarray, words: Words, n: int) -> list[list[tuple[int, int]]]:
    """By row: the runs of words that are hit, as numbers in the row, ends exclusive."""
    change = np.zeros(len(words.rows) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + sizes, -1)
    hit = np.cumsum(change[:-1]) > 0
    new_row = np.ones(len(hit), bool)
    new_row[1:] = words.rows[1:] != words.rows[:-1]
    begins = np.flatnonzero(hit & (new_row | ~np.concatenate([[False], hit[:-1]])))
    closes = np.flatnonzero(hit & np.concatenate([new_row[1:] | ~hit[1:], [True]])) if len(hit) else begins
    of_row = np.searchsorted(words.rows, np.arange(n))
    result: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    for a, b in zip(begins.tolist(), closes.tolist(), strict=True):
        row = int(words.rows[a])
        result[row].append((a - int(of_row[row]), b + 1 - int(of_row[row])))
    return result


SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("stop", T.LongType())]))


def item_parts(benchmark: DataFrame, id: str, text: str, limit: int) -> DataFrame:
    """(item, part, words, size): the words of every item joined by one space, in parts of at most `limit` bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                words = Words.of(data, offsets)
                names, bounds = part.column("item").to_pylist(), np.searchsorted(words.rows, np.arange(len(offsets))).tolist()
                out = []
                for name, a, b in zip(names, bounds, bounds[1:], strict=False):
                    while a < b:
                        stop = int(np.searchsorted(words.ends[a:b], words.starts[a] + limit, "right")) + a
                        stop = min(b, max(stop, a + WINDOW))
                        out.append((name, words.data[words.starts[a] : words.ends[stop - 1]].tobytes().decode()))
                        a = b if stop == b else stop - WINDOW + 1
                arrays = [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, ["item", "words"])

    item = F.coalesce(F.col(id).cast("string"), F.lit("")).alias("item")
    parts = benchmark.select(item, F.col(text).cast("string").alias("text")).mapInArrow(work, "item string, words string")
    return parts.withColumns({"size": F.octet_length("words"), "place": F.monotonically_increasing_id()})


def _slices(parts: DataFrame, limit: int) -> Iterator[Windows]:
    """Windows of all items, in tables of at most `limit` bytes of words each (or one part)."""
    sizes = parts.groupBy((F.col("place") % F.lit(1 << 20)).alias("slot")).agg(F.sum("size").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    if total <= limit:
        rows = parts.select("item", "words").collect()
        if rows:
            yield Windows([r["item"] for r in rows], [r["words"] for r in rows])
        return
    slices = 1 + 2 * total // limit  # Half full on average, so that few need to be cut again.
    of_slice = F.pmod(F.xxhash64("item", "words"), F.lit(slices)).cast("int")
    for k in range(slices):
        held, size = {}, 0
        for row in parts.where(of_slice == k).select("item", "words", "size").toLocalIterator():
            if size and size + row["size"] > limit:
                yield Windows(*map(list, zip(*held, strict=True)))
                held, size = {}, 0
            if (row["item"], row["words"]) not in held:
                held[row["item"], row["words"]] = None
                size += row["size"]
        if held:
            yield Windows(*map(list, zip(*held, strict=True)))


def _scan(rows: DataFrame, table: Windows | None) -> DataFrame:
    """(seq, id, n_words, spans, items, row) for one slice of windows."""
    carried = ["row"] if "row" in rows.columns else []
    shared = rows.sparkSession.sparkContext.broadcast(table) if table else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value if shared else None
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                n = len(offsets) - 1
                words = Words.of(data, offsets)
                items: list[list[str]] = [[] for _ in range(n)]
                spans: list[list[tuple[int, int]]] = [[] for _ in range(n)]
                if held:
                    first, sizes, which = held.hits(words)
                    spans = _spans(first, sizes, words, n)
                    pairs = np.unique(np.stack([words.rows[first], which], axis=1), axis=0)
                    hit_rows, begin = np.unique(pairs[:, 0], return_index=True)
                    for row, some in zip(hit_rows.tolist(), np.split(pairs[:, 1], begin[1:]), strict=bool(len(hit_rows))):
                        items[row] = held.names[np.unique(np.concatenate([held.items[w] for w in some.tolist()]))].tolist()
                counts = pa.array(np.bincount(words.rows, minlength=n).astype(np.int64))
                as_spans = [[{"first": a, "stop": b} for a, b in some] for some in spans]
                kind = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
                arrays = [part.column("seq"), part.column("id"), counts, pa.array(as_spans, kind), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays + [part.column(c) for c in carried], ["seq", "id", "n_words", "spans", "items", *carried])

    schema = T.StructType().add("seq", T.LongType()).add("id", T.LongType()).add("n_words", T.LongType()).add("spans", SPANS)
    schema = schema.add("items", T.ArrayType(T.StringType()))
    return rows.mapInArrow(work, schema.add(rows.schema["row"]) if carried else schema)


def scan(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    carry: bool = False, slice_bytes: int = SLICE_BYTES,
) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items, spans, contaminated; with `carry` also `row`, its columns.

    items: ids of the items found, sorted. spans: runs of words that are hit, numbered from 0, ends exclusive.
    """
    numbered = docs.select(
        F.monotonically_increasing_id().alias("seq"), F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
        *[F.struct("*").alias("row")] * carry,
    )
    parts = scratch.keep(item_parts(benchmark, item, item_text, slice_bytes), "items")
    passes = _slices(parts, slice_bytes)
    first, second = next(passes, None), next(passes, None)
    if second is None:
        found = _scan(numbered, first)
    else:
        rows = scratch.keep(numbered, "rows")
        hits = [
            scratch.keep(_scan(rows.drop("row"), table).where(F.size("items") > 0).select("seq", "spans", "items"), f"hits-{k}")
            for k, table in enumerate(chain([first, second], passes))
        ]
        every = reduce(DataFrame.unionByName, hits)
        merged = every.groupBy("seq").agg(
            _merged(F.flatten(F.collect_list("spans"))).alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items")
        )
        plain = _scan(rows, None).drop("spans", "items")
        none = F.array().cast("array<string>"), F.array().cast(SPANS)
        found = plain.join(merged, "seq", "left").withColumns({"items": F.coalesce("items", none[0]), "spans": F.coalesce("spans", none[1])})
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["first"])
    return found.select(
        "id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.array_sort("items").alias("items"), "spans",
        (F.size("spans") > 0).alias("contaminated"), *["row"] * carry,
    )


def _merged(spans: F.Column) -> F.Column:
    """Sorted runs without overlaps, for runs that may overlap or touch."""

    def add(done: F.Column, span: F.Column) -> F.Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["stop"], span["stop"]).alias("stop"))
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))
        return F.when((F.size(done) > 0) & (span["first"] <= last["stop"]), joined).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(F.array_sort(spans), F.array().cast(SPANS), add)


def remove_spans(scanned: DataFrame, text: str = "text") -> DataFrame:
    """The result of `scan` with `carry`, and `cleaned`: the text without its hit spans, from the first word to the last
    of each; null texts stay null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("cleaned").to_pylist(), batch.column("spans").to_pylist()
            out = list(texts)
            for k, (value, some) in enumerate(zip(texts, spans, strict=True)):
                if some:
                    data = np.frombuffer(value.encode(), np.uint8)
                    starts, ends, _ = word_spans(LOWER[data], np.array([0, len(data)]), SEPARATORS)
                    raw, kept, at = data.tobytes(), [], 0
                    for span in some:
                        kept.append(raw[at : int(starts[span["first"]])])
                        at = int(ends[span["stop"] - 1])
                    out[k] = b"".join([*kept, raw[at:]]).decode()
            arrays = [*(batch.column(n) for n in batch.schema.names[:-1]), pa.array(out, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names)

    with_text = scanned.withColumn("cleaned", F.col("row")[text].cast("string"))
    return with_text.mapInArrow(work, with_text.schema)


def clean_documents(scanned: DataFrame) -> DataFrame:
    """The documents without a hit, with their own columns, of the result of `scan` with `carry`."""
    return scanned.where(~F.col("contaminated")).select("row.*")


def items_sha256(items: str = "items") -> F.Column:
    return F.sha2(F.concat_ws(",", items), 256)
