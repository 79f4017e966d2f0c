"""WARC archives: written with revisits in place of repeated payloads, read back by verifying the chain of records.

A reader that looks for the magic line of a record also finds it inside payloads. Here tasks read an archive in splits
and emit, for each magic line, a candidate: its offset and the offset its length points to. Record chains that run
through a split are contracted there; pointer jumping over the rest, from the start of each file, doubles the way with
each turn and keeps the records that can be reached. Other candidates are parts of a payload, and payloads that contain a
magic line are put together again from their parts. A second scan finds those by their SHA-1, so its splits may differ
from those of the first; a part that it does not find is an error.

Writing and reading are Spark's text sink and source with own line ends, so archives can be on any file system
and are split like any text file. Only built-in functions run here.

* A null page counts as an empty payload, a null url is left out, a null page_id too.
* Of records with equal payloads of at least `least` bytes that with the largest page_id is the response, nulls last.
  Rows that share that page_id are all responses, as a revisit of itself would say nothing.
* An empty table gives no archives and an empty result. Other columns of the input take no part.
* A file that does not begin with a record has none; a chain that breaks off ends there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.llm import exact
from palimpsest.llm.skew import hot_join
from palimpsest.storage import Scratch

MAGIC = "WARC/1.1\r\n"  # Fixed values of the format: the magic line, line ends, field names.
LINE = "\r\n"
GAP = LINE + LINE
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
DATE = "2024-01-01T00:00:00Z"
LEAST = 1000  # Bytes of a payload that a revisit may stand for.
REACH = 1 << 20  # Bytes of an archive that share a key when parts of a payload are gathered.


def _record_id(page_id, url, digest) -> F.Column:
    """A name-based UUID."""
    hashed = F.md5(F.concat_ws("\n", F.coalesce(page_id.cast("string"), F.lit("")), F.coalesce(url, F.lit("")), digest))
    return F.regexp_replace(hashed, "^(.{8})(.{4}).(.{3}).(.{3})(.{12})$", "<urn:uuid:$1-$2-5$3-a$4-$5>")


def _field(name: str, value) -> F.Column:
    """A header line; nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit(""))


def records(pages: DataFrame, scratch: Scratch, id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST) -> DataFrame:
    """Pages with what their record says: page_id, url, payload, bytes, digest, of (the response's page_id and url)."""
    payload = F.coalesce(F.col(html).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("bytes"), F.sha1(payload).alias("digest"),
    )
    narrow = scratch.keep(rows.where(F.col("bytes") >= least).select("page_id", "url", "digest"), "payloads")
    words = exact.words_for(narrow.count())
    found = scratch.keep(exact.repeated_bits(narrow, words, "digest"), "filter")
    first = F.max(F.struct(F.col("page_id").isNotNull(), "page_id", "url"))
    groups = narrow.groupBy("digest").agg(F.count("*").alias("copies"), first.alias("of")).where("copies > 1")
    groups = scratch.keep(groups.select("digest", "copies", F.struct("of.page_id", "of.url").alias("of")), "groups")

    # Only payloads that may repeat are moved.
    rows = exact.numbered_for_probing(rows, words, "digest")
    if words > exact.SLICE_WORDS:
        rows = scratch.keep(rows, "numbered")  # Every slice reads its own rows only.
    probed = exact.probe(rows, found, words, scratch, "probed", "digest")
    maybe = probed.where(F.col("maybe") & (F.col("bytes") >= least)).drop("maybe")
    alone = probed.where(~(F.col("maybe") & (F.col("bytes") >= least))).drop("maybe")
    none = F.lit(None).cast("struct<page_id: bigint, url: string>").alias("of")
    repeated = hot_join(maybe, groups, "digest", "copies").select(*rows.columns, "of")
    false = maybe.join(groups.select("digest"), "digest", "left_anti").select(*rows.columns, none)
    marked = alone.select("*", none).unionByName(repeated).unionByName(false)
    revisit = F.col("of").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("of.page_id"))
    return marked.drop("word").withColumn("of", F.when(revisit, F.col("of")))


def write(marked: DataFrame, path: str, date: str = DATE) -> None:
    """One archive per partition. `marked` is what `records` returns."""
    revisit = F.col("of").isNotNull()
    http = F.concat(F.lit(HTTP), F.col("bytes").cast("string"), F.lit(GAP))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    address = F.regexp_replace("url", "[\\x00-\\x20\\x7f]", "%20")
    header = F.concat(
        F.lit(MAGIC),
        _field("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("url"), F.col("digest"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", address),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, _record_id(F.col("of.page_id"), F.col("of.url"), F.col("digest")))),
        _field("X-Page-ID", F.col("page_id").cast("string")),
        _field("X-Payload-Length", F.col("bytes").cast("string")),
        _field("X-Refers-To-Page-ID", F.col("of.page_id").cast("string")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(LINE),
    )
    # The line end of the sink is the last character of the record.
    marked.select(F.concat(header, block, F.lit(GAP[:-1])).alias("value")).write.option("lineSep", GAP[-1]).text(path)


def _parts(spark: SparkSession, path: str) -> DataFrame:
    """What stands between magic lines: file, block, place (ascending within a block), value."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value",
    )


def _text_key() -> F.Column:
    return F.unhex(F.sha1("value")).alias("text")


def _header(name: str, header: str = "header") -> F.Column:
    found = F.regexp_extract(F.concat(F.lit(LINE), header), f"(?i)\\r\\n{name}:[ \\t]*([^\\r\\n]*)", 1)
    return F.nullif(found, F.lit(""))


def _understood(value: str) -> dict[str, F.Column]:
    """Fields of a record whose text after the magic line is in the column `value`."""
    header = F.substring_index(value, GAP, 1)
    heads = F.length(F.substring_index(value, GAP, 2)) + len(GAP)  # The record's header and the one of HTTP.
    payload = F.substr(F.col(value), heads + 1, F.length(value) - heads - len(GAP))
    return {
        "page_id": _header("X-Page-ID", header).cast("long"),
        "record_type": _header("WARC-Type", header),
        "digest": F.regexp_replace(_header("WARC-Payload-Digest", header), "^sha1:", ""),
        "stated": _header("X-Payload-Length", header).cast("long"),
        "refers_to": _header("X-Refers-To-Page-ID", header).cast("long"),
        "bytes": F.octet_length(payload).cast("long"),
        "sha1": F.sha1(payload),
    }


def candidates(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """(file, block, place, off, next, own_end, text, fields): what every magic line would be if it began a record.

    text: digest of what stands between it and the next one.
    """
    size = F.octet_length("value") + len(MAGIC)
    header = F.substring_index("value", GAP, 1)
    length = F.try_to_number(_header("Content-Length", header), F.lit("999999999999999"))
    record = len(MAGIC) + F.octet_length(header) + len(GAP) + length.cast("long") + len(GAP)
    whole = record == size  # The next magic line stands where this record ends.
    fields = F.when(whole & F.contains("value", F.lit(GAP)), F.struct(*[c.alias(n) for n, c in _understood("value").items()]))
    parts = _parts(spark, path).select(
        "file", "block", "place", size.cast("long").alias("size"), _text_key(),
        F.when(F.contains("value", F.lit(GAP)), record).alias("record"), fields.alias("fields"),
    )
    parts = scratch.keep(parts, "parts")
    of_block = Window.partitionBy("file", "block").orderBy("place")
    blocks = parts.groupBy("file", "block").agg(F.sum("size").alias("block_size"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("block_size").over(earlier), F.lit(0)).alias("before"))
    ahead = F.coalesce(F.sum("size").over(of_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = parts.withColumn("ahead", ahead)
    placed = inside.join(blocks, ["file", "block"]).withColumn("off", F.col("before") + F.col("ahead") - len(MAGIC))
    return placed.select(
        "file", "block", "place", "off", (F.col("off") + F.col("record")).alias("next"), (F.col("off") + F.col("size")).alias("own_end"), "text", "fields"
    )


def reachable(found: DataFrame, scratch: Scratch) -> DataFrame:
    """The candidates that the chain from the start of their file leads to. `found` is a written table."""
    links = found.where("off >= 0 and next is not null").select("file", "block", "place", "off", "next")
    of_block = Window.partitionBy("file", "block").orderBy("place")
    follows = links.withColumn("follows", F.coalesce(F.lag("next").over(of_block) == F.col("off"), F.lit(False)))
    leads = F.coalesce(F.lead("off").over(of_block) == F.col("next"), F.lit(False))
    # Where a link from elsewhere than the candidate just before leads to, a run has to begin.
    entries = links.withColumn("leads", leads).where(~F.col("leads")).select("file", F.col("next").alias("off")).distinct()
    heads = follows.join(entries.withColumn("entry", F.lit(True)), ["file", "off"], "left")
    heads = heads.withColumn("head", ~F.col("follows") | F.col("entry").isNotNull())
    runs = scratch.keep(
        heads.withColumn("run", F.max(F.when(F.col("head"), F.col("off"))).over(of_block.rowsBetween(Window.unboundedPreceding, 0)))
        .select("file", "off", "next", "run"),
        "runs",
    )
    jumps = scratch.keep(runs.groupBy("file", "run").agg(F.max_by("next", "off").alias("jump")), "jumps-0")
    reached = scratch.keep(jumps.where("run = 0").select("file", "run"), "reached-0")
    turn = 0
    while True:
        turn += 1
        step = reached.join(jumps, ["file", "run"]).select("file", F.col("jump").alias("run"))
        step = step.join(jumps, ["file", "run"], "left_semi")
        more = scratch.keep(reached.union(step).distinct(), f"reached-{turn}")
        if more.count() == reached.count():
            break
        reached = more
        ahead = jumps.select("file", F.col("run").alias("jump"), F.col("jump").alias("far"))
        jumps = scratch.keep(
            jumps.join(ahead, ["file", "jump"], "left").select("file", "run", F.coalesce("far", "jump").alias("jump")), f"jumps-{turn}"
        )
    return runs.join(reached, ["file", "run"], "left_semi").select("file", "off", "next")


def read(spark: SparkSession, path: str, scratch: Scratch) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to, intact.

    Length and digest of a response are those of the payload as read, of a revisit those that its header states.
    """
    found = scratch.keep(candidates(spark, path, scratch), "candidates")
    true = scratch.keep(reachable(found, scratch), "reachable")
    known = true.join(found.select("file", "off", "own_end", "fields"), ["file", "off"])
    whole = known.where("own_end = next and fields is not null").select("fields.*")
    broken = scratch.keep(known.where("own_end <> next or fields is null").select("file", "off", "next"), "spread")
    if not broken.isEmpty():
        near = F.explode(F.sequence((F.col("off") / REACH).cast("long"), (F.col("next") / REACH).cast("long")))
        spread = broken.select("file", F.col("off").alias("start"), "next", near.alias("near"))
        parts = found.where("off >= 0").select("file", "off", "text", (F.col("off") / REACH).cast("long").alias("near"))
        wanted = parts.join(spread, ["file", "near"]).where("start <= off and off < next").select("file", "off", "start", "text")
        wanted = scratch.keep(wanted, "wanted")
        texts = _parts(spark, path).select("value", _text_key()).join(wanted.select("text").distinct(), "text", "left_semi")
        texts = texts.groupBy("text").agg(F.first("value").alias("value"))
        lost = F.raise_error(F.concat(F.lit("part of a record not found again: "), "file", F.lit(" at "), F.col("off").cast("string")))
        found_again = wanted.join(texts, "text", "left").withColumn("value", F.coalesce("value", lost.cast("string")))
        joined = found_again.groupBy("file", "start").agg(F.sort_array(F.collect_list(F.struct("off", "value"))).alias("all"))
        joined = joined.select(F.array_join(F.transform("all", lambda p: p["value"]), MAGIC).alias("value"))
        whole = whole.unionByName(joined.select(*[c.alias(n) for n, c in _understood("value").items()]))
    is_revisit = F.col("record_type") == "revisit"
    return whole.select(
        "page_id",
        F.when(is_revisit, F.col("stated")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(is_revisit, F.col("digest")).otherwise(F.col("sha1")).alias("payload_digest"),
        "record_type",
        "refers_to",
        (is_revisit | (F.col("sha1") == F.col("digest"))).alias("intact"),
    )


def round_trip(pages: DataFrame, scratch: Scratch, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages written as archives and read back."""
    path = scratch.path("archives")
    write(records(pages, scratch, id, url, html), path)
    return read(scratch.spark, path, scratch)
