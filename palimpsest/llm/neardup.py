"""Near-duplicates by Order MinHash with banded alignment.

A text is the sequence of its shingles of five words, each labelled with how often it occurred before. A sketch
holds the labelled shingles that come first under a random order, PICKS of them, in the order of the text: two texts agree
in a sketch if they share those shingles in the same order, which falls with edits and with moved passages. SKETCHES
such sketches are the keys of a text. At a similarity of 0.8 a pair shares no key once in 100,000 cases.

Texts with a common key are aligned: similarity is m / (n1 + n2 - m), m being the length of the longest common
subsequence of their shingles. A pair that reaches 0.8 leaves so few shingles unmatched that all matches lie in a band
around the diagonal, so the band decides exactly. Linked texts form classes, transitively.

No group of equal keys is ever expanded into all its pairs. Equal texts are one. In each round every group aligns its
most central text with the members of other classes; in a group of copies that leaves one class. A text that has
been aligned with all other classes of its group leaves the group. Texts of groups that are then left with several classes
go through a prefix filter: of the labelled shingles in an order that begins with those of the fewest texts, similar texts
share one among the first fifth. Texts are put together by these only; a text with more than a fifth of its own meets no
other. Within such a small group pairs of different classes are ruled out by parities, in blocks of bounded size: shingles
are dealt to PARITIES counters, of which a text keeps the lowest bits. Shingles that two texts do not share are
at least as many as the bits in which they differ, so too many of these rule a pair out for certain, and only pairs that
are not ruled out are emitted.

* Null text counts as empty. Texts without words are equal. A text of one to four words is one shingle.
* Rows with equal words are one class. The class id is the smallest row number of its class, `keep_id` the id of its
  longest text, ties to the smaller id, null last. Exactly one row of a class is kept, even if ids repeat.
* An empty table gives an empty result. Other columns, whatever their names, can be carried along in `row`.
* Very long texts: hashing needs some 60 times the size of the longest text, aligning two texts some 100 bytes a
  word and time in proportion to the length times the band.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.llm.blocks import blocks, hash_spans, mix, windows, word_spans
from palimpsest.llm.skew import components, hot_join
from palimpsest.storage import Scratch

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 16
PICKS = 3
ROUNDS = 2  # Of aligning central texts, before classes that are left over are compared.
BLOCK_ROWS = 256  # Of a group compared with as many others in one step.
SALTS = 32  # Parts of the pairs of a text that takes part in a large share of all pairs.

PARITIES = 2048
FEW = 32  # Places of a shingle whose bits are put together anew for every step.
CACHE_BITS = 1 << 29  # Of the bits of other shingles that are kept from step to step.

SKETCHED = "seq long, n long, mark string, keys array<long>"
_SEEDS = mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ODD = _SEEDS | np.uint64(1)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of one text, in its order."""
    if 0 < len(hashes) < SHINGLE:
        return windows(hashes, np.zeros(len(hashes), np.int64), len(hashes))[0]
    return windows(hashes, np.zeros(len(hashes), np.int64), SHINGLE)[0]


def labelled(grams: np.ndarray) -> np.ndarray:
    """Shingles told apart by how often they occurred before."""
    order = np.argsort(grams, kind="stable")
    ranked = grams[order]
    begin = np.ones(len(grams), bool)
    begin[1:] = ranked[1:] != ranked[:-1]
    if begin.all():
        return grams
    first = np.maximum.accumulate(np.where(begin, np.arange(len(grams)), 0))
    times = np.empty(len(grams), np.uint64)
    times[order] = (np.arange(len(grams)) - first).astype(np.uint64)
    return np.where(times > 0, mix(grams + times * np.uint64(0xC2B2AE3D27D4EB4F)), grams)


def sketch(grams: np.ndarray) -> np.ndarray:
    """SKETCHES keys of a text with at least one shingle."""
    items = labelled(grams)
    order = (items[None, :] ^ _SEEDS[:, None]) * _ODD[:, None]
    order ^= order >> np.uint64(32)
    if len(items) > PICKS:
        picked = np.sort(np.argpartition(order, PICKS - 1, axis=1)[:, :PICKS], axis=1)
    else:
        picked = np.broadcast_to(np.arange(len(items)), (SKETCHES, len(items)))
    key = _SEEDS.copy()
    for k in range(picked.shape[1]):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + items[picked[:, k]])
    return key


def parity(grams: np.ndarray) -> np.ndarray:
    """Lowest bits of how many shingles fall to each counter, as 64-bit numbers."""
    counts = np.bincount((grams >> np.uint64(64 - PARITIES.bit_length() + 1)).astype(np.int64), minlength=PARITIES)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _row_hashes(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part, data, offsets in blocks(batch, "text"):
        starts, ends, rows = word_spans(data, offsets)
        bounds = np.searchsorted(rows, np.arange(len(offsets)))
        hashes = hash_spans(data, starts, ends)
        yield part, [hashes[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = np.multiply.accumulate(np.full(4096, 0x9E6C63D0876A9A47, np.uint64))
    for batch in batches:
        for part, texts in _row_hashes(batch):
            n, marks, keys = [], [], []
            for hashes in texts:
                grams = shingles(hashes)
                n.append(len(grams))
                if len(hashes) > len(powers):
                    powers = np.multiply.accumulate(np.full(2 * len(hashes), powers[0], np.uint64))
                sums = (hashes * powers[: len(hashes)]).sum(dtype=np.uint64), (mix(hashes) * powers[: len(hashes)]).sum(dtype=np.uint64)
                marks.append(f"{len(hashes):x}-{sums[0]:016x}{sums[1]:016x}")
                keys.append(sketch(grams).view(np.int64) if len(grams) else [])
            arrays = [part.column("seq"), pa.array(n, pa.int64()), pa.array(marks), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["seq", "n", "mark", "keys"])


def _fact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in _row_hashes(batch):
            grams = [shingles(hashes) for hashes in texts]
            parities = pa.array(map(parity, grams), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column("seq"), pa.array(map(len, grams), pa.int64()), parities], ["v", "n", "parity"])


def _facts(texts: DataFrame, used: DataFrame) -> DataFrame:
    """(v, n, parity) of the texts whose numbers are in `used` (v)."""
    wanted = texts.select("seq", "text").join(used.select(F.col("v").alias("seq")).distinct(), "seq", "left_semi")
    return wanted.mapInArrow(_fact_batches, "v long, n long, parity array<long>")


def _shingle_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in _row_hashes(batch):
            grams = [shingles(hashes).view(np.int64) for hashes in texts]
            yield pa.RecordBatch.from_arrays([part.column("seq"), pa.array(grams, pa.list_(pa.int64()))], ["v", "grams"])


class Matches:
    """Bits of the places of a shingle in a text, within windows that only move on."""

    def __init__(self, text: np.ndarray, width: int):
        self.width = width
        order = np.argsort(text, kind="stable")
        ranked = text[order]
        begin = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        self.places = {int(ranked[a]): order[a:b] for a, b in zip(begin, [*begin[1:], len(text)], strict=True)}
        self.seen: dict[int, tuple[int, int]] = {}  # Of frequent shingles: where the window began, and the bits.
        self.bits = 0

    def within(self, gram: int, low: int) -> int:
        """Bit k is set if the shingle is at place low + k of the text, for k below the width."""
        places = self.places.get(gram)
        if places is None:
            return 0
        if len(places) <= FEW:
            return sum(1 << (j - low) for j in places.tolist() if low <= j < low + self.width)
        before, bits = self.seen.get(gram, (low - self.width, 0))
        bits >>= min(low - before, self.width)
        a, b = np.searchsorted(places, [max(before + self.width, low), low + self.width])
        if b - a > FEW:
            new = np.zeros(self.width, np.uint8)
            new[places[a:b] - low] = 1
            bits |= int.from_bytes(np.packbits(new, bitorder="little").tobytes(), "little")
        else:
            for j in places[a:b].tolist():
                bits |= 1 << (j - low)
        self.bits += 0 if gram in self.seen else self.width
        if self.bits > CACHE_BITS:
            self.seen, self.bits = {}, self.width
        self.seen[gram] = low, bits
        return bits


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the aligned similarity of two shingle sequences reaches `least`.

    The row of the alignment that belongs to a shingle of `a` is kept as bits of one number, which has the width of the band
    and moves along the diagonal: a step costs the width, not the length of `b`. Columns that leave the band
    are settled, those that enter it have not been matched.
    """
    n, m = len(a), len(b)
    if not n or not m:
        return n == m
    need = int(np.ceil(least * (n + m) / (1 + least) - 1e-9))  # Matches that make the similarity reach `least`.
    if min(n, m) < need:
        return False
    k = min(n, m)
    differ = np.flatnonzero(a[:k] != b[:k])
    head = int(differ[0]) if len(differ) else k
    differ = np.flatnonzero(a[n - k + head :][::-1] != b[m - k + head :][::-1])
    tail = int(differ[0]) if len(differ) else k - head
    need -= head + tail
    if need <= 0:
        return True
    a, b = a[head : n - tail], b[head : m - tail]
    if np.isin(a, b).sum() < need or np.isin(b, a).sum() < need:
        return False
    band = len(a) + len(b) - 2 * need  # More steps off the diagonal would leave too many unmatched.
    width = 2 * band + 1
    matches, full, top = Matches(b, width), (1 << width) - 1, 1 << (width - 1)
    row, settled = full, 0  # A zero is a match.
    for i, gram in enumerate(a.tolist()):
        hit = row & matches.within(gram, i - band)
        if hit:
            row = ((row + hit) | (row - hit)) & full
        settled += not row & 1
        row = (row >> 1) | top
        if i % 64 == 63 and settled + width - row.bit_count() + len(a) - 1 - i < need:
            return False
    return settled + width - row.bit_count() >= need


def _align_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def lists(column: pa.Array) -> list[np.ndarray]:
        offsets, values = np.asarray(column.offsets), np.asarray(column.values)
        return [values[x:y] for x, y in zip(offsets, offsets[1:], strict=False)]

    for batch in batches:
        pairs = zip(lists(batch.column("grams_a")), lists(batch.column("grams_b")), strict=True)
        keep = pa.array([similar(a, b) for a, b in pairs], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(keep)


def _differ(a: str, b: str) -> F.Column:
    return sum((F.bit_count(F.get(a, k).bitwiseXOR(F.get(b, k))) for k in range(PARITIES // 64)), F.lit(0))


def _aligned(pairs: DataFrame, texts: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) that are similar. `a` may be in very many pairs. Texts are fetched only for pairs that their
    parities do not rule out."""
    pairs = scratch.keep(pairs, f"{name}-candidates")
    facts = _facts(texts, pairs.select(F.col("a").alias("v")).union(pairs.select(F.col("b").alias("v"))))
    facts = scratch.keep(facts, f"{name}-facts")
    for side in ("a", "b"):
        pairs = pairs.join(facts.select(F.col("v").alias(side), F.col("n").alias(f"n{side}"), F.col("parity").alias(f"p{side}")), side)
    allowed = (F.col("na") + F.col("nb")) * ((1 - SIMILARITY) / (1 + SIMILARITY) + 1e-9)  # Shingles that are not shared.
    pairs = scratch.keep(pairs.where(_differ("pa", "pb") <= allowed).select("a", "b"), f"{name}-pairs")
    many = pairs.groupBy("a").agg(F.count("*").alias("n"))
    total = pairs.count()
    hot = F.broadcast(many.where(F.col("n") * 1_000 > total + 100_000).select("a", F.lit(SALTS).alias("salts")))  # Under 1,000 rows.
    salted = pairs.join(hot, "a", "left").select("a", "b", F.pmod(F.hash("b"), F.coalesce("salts", F.lit(1))).alias("salt"))
    used = pairs.select(F.col("a").alias("v")).union(pairs.select(F.col("b").alias("v"))).distinct()
    grams = scratch.keep(
        texts.join(used, texts["seq"] == used["v"], "left_semi").select("seq", "text").mapInArrow(_shingle_batches, "v long, grams array<long>"),
        f"{name}-grams",
    )
    left = grams.select(F.col("v").alias("a"), F.col("grams").alias("grams_a")).join(hot, "a", "left")
    left = left.select("a", "grams_a", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    right = grams.select(F.col("v").alias("b"), F.col("grams").alias("grams_b"))
    both = salted.join(right, "b").join(left, ["a", "salt"]).select("a", "b", "grams_a", "grams_b")
    links = scratch.keep(both.mapInArrow(_align_batches, "a long, b long"), f"{name}-links")
    scratch.drop(f"{name}-candidates", f"{name}-facts", f"{name}-pairs", f"{name}-grams")
    return links


def _fits(a: str, b: str) -> F.Column:
    """Whether lengths allow the similarity: at best all of the shorter text matches."""
    return F.least(a, b) >= F.greatest(a, b) * (SIMILARITY - 1e-9)


def classes(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """(seq, class) for a written table of (seq, text)."""
    sketched = scratch.keep(rows.select("seq", "text").mapInArrow(_sketch_batches, SKETCHED), "sketches")
    groups = scratch.keep(sketched.groupBy("mark").agg(F.min("seq").alias("v"), F.count("*").alias("size")), "texts")
    member = hot_join(sketched.select("seq", "mark"), groups, "mark", "size").select("seq", "v", "size")
    member = scratch.keep(member, "members")
    nodes = scratch.keep(groups.select("v", F.col("v").alias("c")), "nodes")

    single = sketched.join(groups.select(F.col("v").alias("seq")), "seq", "left_semi")
    keyed = single.select(F.col("seq").alias("v"), "n", F.explode("keys").alias("key"))
    sizes = scratch.keep(keyed.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    shared = scratch.keep(hot_join(keyed, sizes, "key", "size"), "shared")
    central = shared.groupBy("v").agg(F.sum("size").alias("central"))
    bands = scratch.keep(shared.join(central, "v"), "bands")
    scratch.drop("sketches", "sizes", "shared")

    for turn in range(ROUNDS + 1):
        current = bands.join(nodes, "v")
        best = F.max(F.struct("central", -F.col("v"), "v", "n", "c"))
        state = current.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), best.alias("best"), F.count("*").alias("left"))
        state = scratch.keep(
            state.where("low <> high").select("key", "left", F.col("best.v").alias("pv"), F.col("best.n").alias("pn"), F.col("best.c").alias("pc")),
            f"groups-{turn}",
        )
        if state.isEmpty():
            break
        joined = hot_join(current.select("key", "v", "n", "c", "central", "size"), state, "key", "left")
        if turn < ROUNDS:
            joined = scratch.keep(joined, f"joined-{turn}")
            pairs = joined.where(F.col("c") != F.col("pc")).where(_fits("n", "pn")).select(F.col("pv").alias("a"), F.col("v").alias("b")).distinct()
            bands = joined.where("v <> pv").select("v", "n", "key", "size", "central")
        else:
            left_over = scratch.keep(joined.select("v", "c").distinct(), "left-over")
            rare = scratch.keep(_rare_shared(rows, left_over, scratch), "rare")
            parities = scratch.keep(_facts(rows, rare.select("v")).select("v", "parity"), "parities")
            pairs = _across(rare.join(parities, "v"))
        links = _aligned(pairs, rows, scratch, f"turn-{turn}")
        nodes = components(nodes, links, scratch, f"turn-{turn}")
        scratch.drop(f"groups-{turn}", f"turn-{turn}-links", *[f"joined-{turn - 1}"] * bool(turn), *["bands"] * (turn == 0))
    merged = scratch.keep(
        member.groupBy("v").agg(F.first("size").alias("size")).join(nodes, "v").select("v", "size", F.col("c").alias("class")), "classes"
    )
    return hot_join(member.select("seq", "v"), merged, "v", "size").select("seq", "class")


def _labelled_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in _row_hashes(batch):
            grams = [labelled(shingles(hashes)).view(np.int64) for hashes in texts]
            yield pa.RecordBatch.from_arrays([part.column("seq"), pa.array(grams, pa.list_(pa.int64()))], ["v", "grams"])


def prefix_length(n: str) -> F.Column:
    """How many of n shingles, in an order that all texts share, must have one in common with any text that is similar."""
    return F.col(n) - F.ceil(F.col(n) * SIMILARITY - 1e-9) + 1


def _rare_shared(rows: DataFrame, left_over: DataFrame, scratch: Scratch) -> DataFrame:
    """(key, v, n, c, left): for texts (v, c), those of their rarest labelled shingles that another text has too.

    Shingles are ordered by the number of texts they are in, then by their hash. Of two similar texts the first ones in
    this order, one more than may be unmatched, have one in common. Shingles of one text only come first and
    match nothing, so a text with enough of its own has no row at all. `left` is the number of rows of a key.
    """
    wanted = rows.select("seq", "text").join(left_over.select(F.col("v").alias("seq")), "seq", "left_semi")
    grams = scratch.keep(wanted.mapInArrow(_labelled_batches, "v long, grams array<long>"), "left-over-grams")
    each = grams.select("v", F.size("grams").cast("long").alias("n"), F.explode("grams").alias("key"))
    shared = scratch.keep(each.groupBy("key").agg(F.count("*").alias("texts")).where("texts > 1"), "left-over-shared")
    common = hot_join(each, shared, "key", "texts")
    ordered = common.groupBy("v").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("texts", "key"))).alias("common"))
    own = F.col("n") - F.size("common")
    first = ordered.withColumn("take", (prefix_length("n") - own).cast("int")).where("take > 0")
    keyed = first.select("v", "n", F.explode(F.slice("common", F.lit(1), F.col("take"))).alias("one"))
    keyed = scratch.keep(keyed.select("v", "n", F.col("one.key").alias("key")).join(left_over, "v"), "left-over-keyed")
    groups = keyed.groupBy("key").agg(F.count("*").alias("left"), F.min("c").alias("low"), F.max("c").alias("high"))
    groups = scratch.keep(groups.where("low <> high").select("key", "left"), "left-over-groups")
    return hot_join(keyed, groups, "key", "left").select("key", "v", "n", "c", "left")


def _across(joined: DataFrame) -> DataFrame:
    """Pairs of different classes within a group that may be similar. A task compares two blocks of a group at a time."""
    blocks_of = F.ceil(F.col("left") / BLOCK_ROWS).cast("int")
    rows = joined.select("key", "v", "n", "c", "parity", blocks_of.alias("blocks"), F.pmod(F.hash("v"), blocks_of).alias("own"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cells = rows.select("key", "v", "n", "c", "parity", "own", other).select(
        "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "v", "n", "c", "parity"
    )
    sorted_cells = cells.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high")
    return sorted_cells.mapInArrow(_compare_cells, "a long, b long").distinct()


def _compare_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
        key, low, high = (rows.column(name).to_numpy() for name in ("key", "low", "high"))
        last = (key == key[-1]) & (low == low[-1]) & (high == high[-1])
        held = rows.slice(len(rows) - int(last.sum()))  # It may go on in the next batch.
        yield from _compare(rows.slice(0, len(rows) - len(held)))
    if held is not None:
        yield from _compare(held)


def _compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if not len(rows):
        return
    key, low, high, own, v, n, c = (rows.column(name).to_numpy() for name in ("key", "low", "high", "own", "v", "n", "c"))
    lists = rows.column("parity").combine_chunks()
    bits = np.asarray(lists.flatten()).view(np.uint64).reshape(len(v), -1)
    change = np.flatnonzero((key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])) + 1
    found_a, found_b = [], []
    for first, stop in zip([0, *change], [*change, len(v)], strict=True):
        place = np.arange(first, stop)
        left = place[own[first:stop] == low[first]]
        right = place if low[first] == high[first] else place[own[first:stop] == high[first]]
        for at in range(0, len(left), 64):
            x = left[at : at + 64]
            total = n[x][:, None] + n[right][None, :]
            differ = np.bitwise_count(bits[x][:, None, :] ^ bits[right][None, :, :]).sum(axis=2, dtype=np.int32)
            fine = differ <= total * ((1 - SIMILARITY) / (1 + SIMILARITY) + 1e-9)
            fine &= np.minimum(n[x][:, None], n[right][None, :]) >= np.maximum(n[x][:, None], n[right][None, :]) * (SIMILARITY - 1e-9)
            fine &= c[x][:, None] != c[right][None, :]
            if low[first] == high[first]:
                fine &= v[x][:, None] < v[right][None, :]
            i, j = np.nonzero(fine)
            found_a.append(np.minimum(v[x][i], v[right][j]))
            found_b.append(np.maximum(v[x][i], v[right][j]))
    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)) for found in (found_a, found_b)], ["a", "b"])


def near_duplicates(docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: id, class_id, class_size, keep_id, kept; with `carry` also `row`, its columns.

    class_id is the smallest id of the class.
    """
    narrow = [F.monotonically_increasing_id().alias("seq"), F.col(id).cast("long").alias("id")]
    kept = scratch.keep(docs.select(*narrow, F.struct("*").alias("row") if carry else F.col(text).cast("string").alias("text")), "rows")
    rows = kept.withColumn("text", F.col("row")[text].cast("string")) if carry else kept  # Written once, read as one column.
    found = scratch.keep(classes(rows, scratch), "found")
    facts = rows.select("seq", "id", F.length(F.coalesce("text", F.lit(""))).alias("n_chars"))
    rank = F.struct(-F.col("n_chars"), F.col("id").isNull(), "id", "seq")
    summary = scratch.keep(
        facts.join(found, "seq").groupBy("class").agg(F.count("*").alias("class_size"), F.min("id").alias("class_id"), F.min(rank).alias("best"))
        .select("class", "class_id", "class_size", F.col("best.id").alias("keep_id"), F.col("best.seq").alias("keep_seq")),
        "summary",
    )
    verdict = hot_join(found, summary, "class", "class_size").withColumn("kept", F.col("seq") == F.col("keep_seq"))
    verdict = verdict.select("seq", "class_id", "class_size", "keep_id", "kept")
    return rows.select("seq", "id", *["row"] * carry).join(verdict, "seq").drop("seq")
