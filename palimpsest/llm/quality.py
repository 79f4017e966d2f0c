"""Quality rules: a log-likelihood ratio between trusted texts and the raw corpus over hashed n-grams.

Two multinomials over hashed n-grams of bytes are counted, one from trusted documents and one from all. A text's
score is the mean over its n-grams of log p(trusted) - log p(raw), so length does not matter. Every document is
compared with one threshold, which comes from the scores of all labelled documents. Only the fit of the trusted multinomial
has a bound, TRUSTED_ROWS.

* Null text counts as empty: no words, score 0, `base_failed`.
* Rows are judged one by one, so repeated rows and repeated ids give repeated results.
* An empty table gives an empty result; without trusted documents every score is 0 and only base rules decide.
* Other columns of the input, whatever their names, can be carried along in `row`.
* Very long texts are judged whole, in some 60 times the size of the longest one of memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palimpsest.llm.blocks import LOWER, SPACES, blocks, hash_spans, line_spans, repeats, windows, word_spans
from palimpsest.storage import Scratch

NGRAM = 4  # Bytes of an n-gram.
BUCKETS = 1 << 16
TRUSTED_ROWS = 20_000  # At most so many labelled rows of each kind are used to fit; the corpus counts cover all rows.
WINDOW = 5  # Words of a window that counts as repeated.
TAIL = 0.002  # Share of trusted texts allowed near the threshold.

COUNTS = "bucket int, trusted long, raw long"
SCORES = (
    "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, score double"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LEADING = np.ones(256, bool)  # Bytes that begin a code point.
_LEADING[0x80:0xC0] = False


def gram_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of bytes, and the row of each; n-grams stay within a row."""
    n = len(data) - NGRAM + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(n, np.uint32)
    for k in range(NGRAM):
        code = (code << np.uint32(8)) | data[k : k + n]
    bucket = ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    whole = rows[:n] == rows[NGRAM - 1 :]
    return bucket[whole], rows[:n][whole]


@dataclass
class Model:
    """Log ratio of each bucket, and the scores below which a text is rejected."""

    ratios: np.ndarray
    threshold: float | None = None


def all_labels(labels: DataFrame) -> DataFrame:
    """(id, label), a row per labelled id; ids with both labels count as 0."""
    return (
        labels.where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.min("quality").cast("int").alias("label"))
    )


def labelled_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """(id, label) of at most `rows` ids of each label, chosen by a hash."""
    ids = all_labels(labels)
    chosen = [ids.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(rows) for k in (0, 1)]
    return chosen[0].unionByName(chosen[1])


def _narrow(docs: DataFrame, id: str, text: str, carry: bool = False) -> DataFrame:
    return docs.select(
        F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"), *[F.struct("*").alias("row")] * carry
    )


def _with_labels(docs: DataFrame, id: str, text: str, sample: DataFrame) -> DataFrame:
    return _narrow(docs, id, text).join(F.broadcast(sample), "id", "left")  # At most 2 * TRUSTED_ROWS rows of two numbers.


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    trusted, raw = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part, data, offsets in blocks(batch, "text"):
            bucket, rows = gram_buckets(data, offsets)
            good = np.asarray(part.column("label").fill_null(-1)) == 1
            raw += np.bincount(bucket, minlength=BUCKETS)
            trusted += np.bincount(bucket[good[rows]], minlength=BUCKETS)
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array(trusted[used]), pa.array(raw[used])], ["bucket", "trusted", "raw"]
    )


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", rows: int = TRUSTED_ROWS) -> Model:
    """The two multinomials. What reaches the driver is one row per bucket."""
    counted = _with_labels(docs, id, text, labelled_ids(labels, rows)).mapInArrow(_count, COUNTS)
    table = counted.groupBy("bucket").agg(F.sum("trusted"), F.sum("raw")).collect()
    trusted, raw = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, n_trusted, n_raw in table:
        trusted[bucket], raw[bucket] = n_trusted, n_raw
    if not trusted.sum():
        return Model(np.zeros(BUCKETS, np.float32))
    smoothed = [(counts + 0.5) / (counts.sum() + 0.5 * BUCKETS) for counts in (trusted, raw)]
    return Model(np.log(smoothed[0] / smoothed[1]).astype(np.float32))


def describe(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each row."""
    n = len(offsets) - 1
    starts, ends, rows = word_spans(data, offsets)
    keys, first = windows(hash_spans(data, starts, ends), rows, WINDOW)
    _, repeated = repeats(keys, rows[first])
    steps = np.zeros(len(starts) + 1, np.int64)
    np.add.at(steps, first[repeated], 1)
    np.add.at(steps, first[repeated] + WINDOW, -1)
    covered = np.cumsum(steps[:-1]) > 0
    begin, end, line_rows = line_spans(data, offsets)
    wordy = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    later, _ = repeats(hash_spans(data, begin, end)[wordy], line_rows[wordy])

    def per_row(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    return {
        "n_words": np.bincount(rows, minlength=n),
        "word_chars": per_row(_LEADING[data] & ~SPACES[data]),
        "n_symbols": per_row(_SYMBOL[data]),
        "n_dup_lines": np.bincount(line_rows[wordy][later], minlength=n),
        "n_repeat_words": np.bincount(rows[covered], minlength=n),
    }


def score(
    docs: DataFrame,
    model: Model,
    id: str = "doc_id",
    text: str = "text",
    carry: bool = False,
) -> DataFrame:
    """Base counts and score of every document: id, counts, base_failed, score.

    With `carry` also `row`, a struct of all columns of the document.
    """
    ratios = model.ratios
    narrow = _narrow(docs, id, text, carry)
    schema = StructType.fromDDL(SCORES)
    if carry:
        schema.add(narrow.schema["row"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in blocks(batch, "text"):
                base = describe(data, offsets)
                bucket, of = gram_buckets(data, offsets)
                n = len(offsets) - 1
                total = np.bincount(of, ratios[bucket], minlength=n)
                mean = total / np.maximum(1, np.bincount(of, minlength=n))
                failed = (base["n_words"] < 10) | (100 * base["n_repeat_words"] > 20 * base["n_words"])
                arrays = [part.column("id"), *map(pa.array, base.values()), pa.array(failed), pa.array(mean)]
                arrays += [part.column(name) for name in ["row"] * carry]
                yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return narrow.mapInArrow(judge, schema)


def threshold(scored: DataFrame, labels: DataFrame) -> float | None:
    """Halfway between the low tail of trusted texts and the middle of untrusted ones, but not above that tail.

    All labelled documents count. Ids and scores are all that is joined; Spark shuffles them if there are many labels.
    """
    good, bad = F.col("label") == 1, F.col("label") == 0
    judged = scored.where("not base_failed and id is not null").select("id", "score").join(all_labels(labels), "id")
    low, middle = judged.agg(
        F.percentile_approx(F.when(good, F.col("score")), TAIL, 10_000),
        F.percentile_approx(F.when(bad, F.col("score")), 0.5, 10_000),
    ).first()
    if low is None:
        return None
    return low - 1 if middle is None else min(low, (low + middle) / 2)


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    scratch: Scratch,
    id: str = "doc_id",
    text: str = "text",
    rows: int = TRUSTED_ROWS,
    carry: bool = False,
) -> DataFrame:
    """One row per document: id, the base counts, base_failed, score and kept; with `carry` also `row`, its columns."""
    model = fit(docs, labels, id, text, rows)
    scored = scratch.keep(score(docs, model, id, text, carry), "quality")
    limit = threshold(scored, labels)
    fine = F.lit(True) if limit is None else F.col("score") >= limit
    return scored.withColumn("kept", ~F.col("base_failed") & fine)
