"""Exact deduplication: two passes with a Bloom filter of two planes, then a shuffle of the rows that may repeat.

The filter is a table of words of 64 bits. The hash of a row's text names one word and PROBES bits in it. The first pass
moves a word's number and bits per row, equal ones added up before they move, and makes two planes of each
word: bits that rows have set, and bits that two rows or more have set. Only the second is kept. The second pass probes:
a row one of whose bits is not in that plane has no equal and passes straight through. The others, all true repeats and a few
false ones (below 1 % of the rows), are grouped by their SHA-256.

The filter has ROWS_PER_WORD rows to a word, whatever the size of the table. It is sliced by word number; a slice of SLICE_WORDS
words, 32 MiB, is what is broadcast at once. With one slice, up to 16.7 million rows, the second pass is a
broadcast join; with several, each slice is a pass over its own rows, which lie together in every file as rows are sorted by word
when they are first written. Only built-in functions run here.

* Null text counts as empty, and so equals texts of white space only.
* Among equal texts the row with most code points stays, then the smallest id, null ids last. Rows that agree in all
  of this are told apart by an internal row number, so exactly one row of a group is kept.
* Very long texts are hashed whole, in some three times their size of memory; only hashes are compared or moved.
* An empty table gives an empty result. Other columns, whatever their names, can be carried along in `row`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.storage import Scratch

PROBES = 3  # Bits per row, in one word.
ROWS_PER_WORD = 4  # Some 0.7 % of unique rows are then taken for possible repeats.
MIN_WORDS = 1 << 10
SLICE_WORDS = 1 << 22  # 32 MiB of bits broadcast at once.
BLOCK = 512  # Words of a broadcast row.
HOT_SHARE = 1_000  # A group with more than this part of the candidates is joined by broadcast; there can be no more.


def normalised(text) -> F.Column:
    """The text without [\\x20\\x09-\\x0D]; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t-\\r]+", "")


def fingerprints(docs: DataFrame, id: str, text: str, carry: bool) -> DataFrame:
    """(seq, id, n_chars, text_sha256, row): what decides, and the columns carried along."""
    return docs.select(
        F.monotonically_increasing_id().alias("seq"),
        F.col(id).cast("long").alias("id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_chars"),
        F.sha2(normalised(F.col(text)), 256).alias("text_sha256"),
        *[F.struct("*").alias("row")] * carry,
    )


def words_for(rows: int) -> int:
    """Words of the filter: they grow with the table."""
    return max(MIN_WORDS, -(-rows // ROWS_PER_WORD))


def word_of(key: str, words: int) -> F.Column:
    return F.pmod(F.xxhash64(key), F.lit(words))


def _bits(key: str) -> F.Column:
    """The bits of a key, as a number of 64 bits."""
    hashed = F.xxhash64(F.lit(PROBES), key)
    bits = F.lit(0).cast("long")
    for k in range(PROBES):
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(hashed, 6 * k).bitwiseAND(63).cast("int")))
    return bits


def repeated_bits(rows: DataFrame, words: int, key: str = "text_sha256") -> DataFrame:
    """(word, bits): bits that the keys of two rows or more have set, for words that have any.

    Rows that set the same bits of a word are counted before they are shuffled, so a hot key is one row of each task. The
    different bit sets of a word are as few as the rows that hash to it.
    """
    counted = rows.select(word_of(key, words).alias("word"), _bits(key).alias("bits")).groupBy("word", "bits").agg(F.count("*").alias("n"))
    sets = counted.groupBy("word").agg(F.collect_list(F.struct("bits", F.when(F.col("n") > 1, F.col("bits")).otherwise(0).alias("twice"))).alias("sets"))
    nothing = F.struct(F.lit(0).cast("long").alias("once"), F.lit(0).cast("long").alias("twice"))

    def add(planes: F.Column, one: F.Column) -> F.Column:
        again = planes["once"].bitwiseAND(one["bits"]).bitwiseOR(one["twice"])
        return F.struct(planes["once"].bitwiseOR(one["bits"]).alias("once"), planes["twice"].bitwiseOR(again).alias("twice"))

    planes = sets.select("word", F.aggregate("sets", nothing, add)["twice"].alias("bits"))
    return planes.where("bits <> 0")


def probe(rows: DataFrame, found: DataFrame, words: int, scratch: Scratch, name: str, key: str = "text_sha256") -> DataFrame:
    """With the column `maybe`: whether all bits of the row were set twice or more. `rows` and `found` are written tables."""
    slices = -(-words // SLICE_WORDS)
    parts = []
    for first in range(0, words, SLICE_WORDS):
        inside = (F.col("word") >= first) & (F.col("word") < first + SLICE_WORDS)
        numbered = found.where(inside).select((F.col("word") / BLOCK).cast("long").alias("block"), (F.col("word") % BLOCK).cast("int").alias("place"), "bits")
        packed = numbered.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("place", "bits"))).alias("at"))
        dense = F.transform(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda k: F.coalesce(F.try_element_at(F.col("at"), k), F.lit(0).cast("long")))
        table = packed.select("block", dense.alias("plane"))
        some = rows if slices == 1 else rows.where(inside)
        joined = some.join(F.broadcast(table), (F.col("word") / BLOCK).cast("long") == F.col("block"), "left")  # Of a slice at most.
        plane = F.coalesce(F.get("plane", (F.col("word") % BLOCK).cast("int")), F.lit(0).cast("long"))
        part = joined.select(*rows.columns, (plane.bitwiseAND(_bits(key)) == _bits(key)).alias("maybe"))
        parts.append(part if slices == 1 else scratch.keep(part, f"{name}-{first // SLICE_WORDS}"))
    return reduce(DataFrame.unionByName, parts)


def numbered_for_probing(rows: DataFrame, words: int, key: str = "text_sha256") -> DataFrame:
    """With the column `word`, and rows of a slice together in every file if there are several."""
    with_word = rows.withColumn("word", word_of(key, words))
    return with_word.sortWithinPartitions("word") if words > SLICE_WORDS else with_word


def dedup(docs: DataFrame, scratch: Scratch, id: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256; with `carry` also `row`, its columns."""
    words = words_for(docs.count())
    rows = scratch.keep(numbered_for_probing(fingerprints(docs, id, text, carry), words), "fingerprints")
    found = scratch.keep(repeated_bits(rows, words), "filter")
    probed = probe(rows, found, words, scratch, "probed")
    carried = ["row"] * carry
    single = probed.where("not maybe").select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256", *carried
    )
    maybe = probed.where("maybe")

    rank = F.struct(-F.col("n_chars"), F.col("id").isNull(), "id", "seq")
    groups = scratch.keep(
        maybe.groupBy("text_sha256").agg(F.count("*").alias("group_size"), F.min(rank).alias("best")).select(
            "text_sha256", "group_size", F.col("best.id").alias("keep_id"), F.col("best.seq").alias("keep_seq")
        ),
        "groups",
    )
    total = groups.agg(F.sum("group_size")).first()[0] or 0
    is_hot = F.col("group_size") * HOT_SHARE > total
    hot = F.broadcast(groups.where(is_hot))  # Fewer than HOT_SHARE rows, whatever the data.
    seen = F.col("keep_seq").isNotNull()
    with_hot = maybe.join(hot, "text_sha256", "left")
    rest = with_hot.where(~seen).drop("group_size", "keep_id", "keep_seq").join(groups.where(~is_hot), "text_sha256")
    repeated = with_hot.where(seen).unionByName(rest).select(
        "id", "keep_id", "group_size", (F.col("seq") == F.col("keep_seq")).alias("kept"), "text_sha256", *carried
    )
    return single.unionByName(repeated)
