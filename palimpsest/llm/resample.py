"""Importance resampling towards a target: documents whose n-grams are likelier in the target are drawn more often.

Words are runs of letters and digits (every character beyond ASCII counts as such), A-Z lower-cased. Features are all runs
of one to three words of a text, joined by one space; a feature's bucket is the CRC-32 of its bytes modulo 10000. Over
all documents and over all target texts the buckets are counted; a bucket's gain is the scaled logarithm of the
ratio of its smoothed shares, and a document's weight the sum of its features' gains. To the weight a Gumbel number is
added that depends on the seed and the id only; the highest sums are drawn, which is sampling without replacement by
weight. Documents with fewer than 20 words are never drawn.

The texts of a block are joined with a separator between them, one pass of a regular expression finds the words of all,
and a search among the texts' offsets tells to which text a word belongs; n-grams that would reach from one text into the
next are masked before buckets are counted. The CRC-32 of an n-gram is put together from those of its words, which
are computed once per distinct word: a CRC is linear, so appending n bytes is a lookup in a table for n.

The draw needs no sort of all rows. An approximate quantile cuts off most of them, which is checked by a count; the rest is
sorted by ranges, and ranks are the numbers of rows before a range plus the place in it. No task sees all rows, and
equal scores or ids may be in any number.

* Null texts have no words. Null ids are hashed as if empty and come last among equal scores; equal scores and ids are
  told apart by an internal row number. Repeated rows are counted and drawn as rows of their own.
* Without target texts all gains come from smoothing alone. An empty table gives an empty result.
* A text is worked on in runs of WORDS words, so very long ones need a few times their size in memory.
* Other columns, whatever their names, can be carried along in `row`.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from palimpsest.llm.blocks import blocks
from palimpsest.storage import Scratch

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SEPARATOR = b"\x00"
BUCKETS = 10_000
SEED = "42"
PERCENT = 5
MIN_WORDS = 20
WORDS = 1 << 18  # Worked on at once.
DISTINCT = 1 << 19  # Words whose checksums a task keeps.
ACCURACY = 1_000  # Of the quantile: it is off by a thousandth of all rows at most.
SHIFTS = 64  # Lengths with a table of their own.

_shifts: list[np.ndarray] = []


def _shift_tables() -> np.ndarray:
    """By length, byte and its value: what appending so many zero bytes makes of a checksum."""
    if not _shifts:
        tables = np.zeros((SHIFTS, 4, 256), np.uint32)
        for length in range(SHIFTS):
            zeros = bytes(length)
            nothing = zlib.crc32(zeros)
            for byte in range(4):
                tables[length, byte] = [zlib.crc32(zeros, value << (8 * byte)) ^ nothing for value in range(256)]
        _shifts.append(tables)
    return _shifts[0]


class Checksums:
    """CRC-32 of words and of their runs."""

    def __init__(self):
        self.places: dict[bytes, int] = {}
        self.alone = self.spaced = self.lengths = np.zeros(0, np.uint32)

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of every word: its checksum, that of a space and the word, and the length of the latter."""
        if len(self.places) > DISTINCT:
            self.__init__()
        places, known = self.places, len(self.places)
        at = np.fromiter((places.setdefault(word, len(places)) for word in words), np.int64, len(words))
        if len(places) > known:
            new = list(islice(places, known, None))
            columns = ([zlib.crc32(w) for w in new], [zlib.crc32(b" " + w) for w in new], [len(w) + 1 for w in new])
            self.alone, self.spaced, self.lengths = (
                np.concatenate([old, np.array(column, np.uint32)]) for old, column in zip((self.alone, self.spaced, self.lengths), columns, strict=True)
            )
        return self.alone[at], self.spaced[at], self.lengths[at]


def appended(before: np.ndarray, added: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Checksums of texts with `before` followed by texts of these lengths with `added`."""
    tables = _shift_tables()
    short = np.minimum(lengths, SHIFTS - 1).astype(np.int64)
    result = added.copy()
    for byte in range(4):
        result ^= tables[short, byte, (before >> np.uint32(8 * byte)) & np.uint32(255)]
    for k in np.flatnonzero(lengths >= SHIFTS):
        zeros = bytes(int(lengths[k]))
        result[k] = added[k] ^ np.uint32(zlib.crc32(zeros, int(before[k])) ^ zlib.crc32(zeros))
    return result


def features(data: np.ndarray, offsets: np.ndarray, checksums: Checksums, at_once: int = WORDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For runs of words of a block: row of each word, row of each feature, bucket of each feature."""
    whole = data.tobytes()
    joined = SEPARATOR.join(whole[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)).lower()
    begins = offsets[:-1] + np.arange(len(offsets) - 1)  # Of every text among the joined ones.
    found = WORD.finditer(joined)
    alone = pairs = np.zeros(0, np.uint32)  # Of the words before: their checksums, and those of runs of two that end there.
    rows = np.zeros(0, np.int64)
    while matches := list(islice(found, at_once)):
        crc, spaced, lengths = checksums.of([match[0] for match in matches])
        starts = np.fromiter((match.start() for match in matches), np.int64, len(matches))
        held = len(rows)
        rows = np.concatenate([rows, np.searchsorted(begins, starts, "right") - 1])
        alone, n = np.concatenate([alone, crc]), len(crc)
        here = np.arange(held, held + n)
        has_one = np.flatnonzero((here >= 1) & (rows[np.maximum(here - 1, 0)] == rows[here]))
        two = appended(alone[here[has_one] - 1], spaced[has_one], lengths[has_one])
        new_pairs = np.zeros(n, np.uint32)
        new_pairs[has_one] = two
        pairs = np.concatenate([pairs, new_pairs])
        has_two = np.flatnonzero((here >= 2) & (rows[np.maximum(here - 2, 0)] == rows[here]))
        three = appended(pairs[here[has_two] - 1], spaced[has_two], lengths[has_two])
        new = rows[held:]
        yield new, np.concatenate([new, new[has_one], new[has_two]]), (np.concatenate([crc, two, three]) % BUCKETS).astype(np.int64)
        alone, pairs, rows = alone[-2:], pairs[-2:], rows[-2:]


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, checksums = np.zeros(BUCKETS, np.int64), Checksums()
    for batch in batches:
        for _, data, offsets in blocks(batch, "text"):
            for _, _, buckets in features(data, offsets, checksums):
                counts += np.bincount(buckets, minlength=BUCKETS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(counts[used])], ["bucket", "n"])


def count(texts: DataFrame, text: str = "text") -> np.ndarray:
    """How often each bucket occurs in all texts. A task sends a row per bucket."""
    sent = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(_count_batches, "bucket int, n long")
    counts = np.zeros(BUCKETS, np.int64)
    for row in sent.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # At most BUCKETS rows.
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = ((t + 1.0) * s_all / ((s + 1.0) * t_all) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def gumbel(id: int | None, seed: str = SEED) -> int:
    """A number that depends on seed and id only, scaled like the gains."""
    h = int(hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gain: np.ndarray, id: str, text: str, seed: str = SEED, carry: bool = False) -> DataFrame:
    """(seq, id, n_words, n_features, weight, score) and, with `carry`, row."""

    carried = ["row"] * carry

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checksums = Checksums()
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                n = len(offsets) - 1
                words, counted, weights = (np.zeros(n, np.int64) for _ in range(3))
                for word_rows, rows, buckets in features(data, offsets, checksums):
                    words += np.bincount(word_rows, minlength=n)
                    counted += np.bincount(rows, minlength=n)
                    weights += np.bincount(rows, gain[buckets], n).astype(np.int64)  # Exact: whole numbers below 2**53.
                noise = np.array([gumbel(i, seed) for i in part.column("id").to_pylist()], np.int64)
                arrays = [part.column("seq"), part.column("id"), *map(pa.array, (words, counted, weights, weights + noise))]
                arrays += [part.column(name) for name in carried]
                yield pa.RecordBatch.from_arrays(arrays, ["seq", "id", "n_words", "n_features", "weight", "score", *carried])

    narrow = docs.select(
        F.monotonically_increasing_id().alias("seq"), F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"),
        *[F.struct("*").alias("row")] * carry,
    )
    schema = T.StructType([T.StructField(name, T.LongType()) for name in ("seq", "id", "n_words", "n_features", "weight", "score")])
    return narrow.mapInArrow(work, schema.add(narrow.schema["row"]) if carry else schema)


def draw(scored: DataFrame, scratch: Scratch, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of a written table with `rank`: 1, 2, 3 ... for the drawn ones by falling score, else null."""
    may = F.col("n_words") >= min_words
    share = max(0.0, 1 - percent / 100 - 2 / ACCURACY)
    facts = scored.where(may).agg(F.count("*").alias("n"), F.percentile_approx("score", share, ACCURACY).alias("cut")).first()
    wanted = percent * facts["n"] // 100
    nothing = F.lit(None).cast("long").alias("rank")
    if not wanted:
        return scored.select("*", nothing)
    high = may & (F.col("score") >= facts["cut"])
    if scored.where(high).count() < wanted:
        high = may
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("seq")]
    ranged = scored.where(high).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = scratch.keep(ranged.withColumn("place", F.monotonically_increasing_id()), "placed")  # Range, then row in it.
    part, row = F.shiftright("place", 33), F.col("place").bitwiseAND((1 << 33) - 1)
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    offsets, before = [], 0
    for name, n in sizes:  # One per range.
        offsets += [F.lit(name).cast("long"), F.lit(before).cast("long")]
        before += n
    rank = F.element_at(F.create_map(*offsets), part) + row + 1
    ranked = placed.withColumn("rank", F.when(rank <= wanted, rank)).drop("place")
    return ranked.unionByName(scored.where(~high).select("*", nothing))


def resample(
    docs: DataFrame, target: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", target_text: str = "text",
    percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED, carry: bool = False,
) -> DataFrame:
    """One row per document: id, n_features, weight, score, rank, n_words; with `carry` also `row`, its columns."""
    gain = gains(count(docs, text), count(target, target_text))
    scored = scratch.keep(weigh(docs, gain, id, text, seed, carry), "scored")
    return draw(scored, scratch, percent, min_words).select("id", "n_features", "weight", "score", "rank", "n_words", *["row"] * carry)
