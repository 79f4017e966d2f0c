"""XML dumps, plain or bzip2, as one row per revision.

Both readers cut the dump into chunks at a closing tag. Chunks are lines to the text source, so one file is
read by many tasks, bzip2 included. Escaped text cannot hold a literal tag, which makes the cut safe.

`read_pages` cuts at the end of a page and suits dumps of current revisions. `read_revisions` cuts at the end
of a revision, so a page may be far larger than a task's memory: it suits full histories.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.schemas import REVDOC
from palimpsest.storage import Scratch

# The elements of the export format that the table needs. The attributes that mark hidden
# content are read so that hidden text (NULL) and empty text ('') stay apart.
PAGE_XML = """
    title STRING, ns BIGINT, id BIGINT, redirect STRUCT<_title: STRING>, restrictions ARRAY<STRING>,
    malformed STRING
"""
REVISION_XML = """
    id BIGINT, parentid BIGINT, timestamp STRING,
    contributor STRUCT<username: STRING, id BIGINT, ip: STRING>,
    minor STRING, comment STRUCT<_VALUE: STRING, _deleted: STRING>, model STRING, format STRING,
    text STRUCT<_VALUE: STRING, _bytes: BIGINT, _deleted: STRING>, sha1 STRING,
    malformed STRING
"""
XML_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "malformed",
    "ignoreSurroundingSpaces": "false",
}

PAGE_COLUMNS = ["page_id", "page_title", "page_namespace", "page_redirect", "page_restrictions"]
REVISION_COLUMNS = [name for name in REVDOC.names if name not in PAGE_COLUMNS]


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Revision documents of a dump whose pages each fit in a task, plus `malformed` (see `flatten`)."""
    pages = spark.read.option("lineSep", "</page>").text(path).where(F.col("value").contains("<revision>"))
    revisions = pages.select(
        _header(F.col("value")).alias("header"),
        F.explode(F.split("value", "</revision>")).alias("chunk"),
    ).where(F.col("chunk").contains("<revision>"))
    return flatten(revisions.select("header", _revision(F.col("chunk")).alias("revision")))


def read_revisions(spark: SparkSession, path: str | list[str], scratch: Scratch) -> DataFrame:
    """Revision documents of a dump with pages of any size, plus `malformed` (see `flatten`) and `seq`, a
    number of the row that stays the same when the result is read again.

    Only a page's first chunk names the page. Each task carries that header on to the chunks after it, and
    what it parsed is kept in `scratch`, so the dump is decompressed once. Its text is not shuffled as long as the
    table of last headers, one row per split, is below Spark's broadcast threshold (some 100,000 splits). Chunks
    at the start of a split, before its first header, then take the last header of the splits before.
    """
    chunks = (
        spark.read.option("lineSep", "</revision>")
        .text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
        .where(F.col("value").contains("<revision>"))
        .select("file", "block", _header(F.col("value")).alias("header"), _revision(F.col("value")).alias("revision"))
    )
    carried = chunks.mapInArrow(_header_carrier(), chunks.schema)
    parsed = flatten(
        carried.select("*", F.monotonically_increasing_id().alias("seq")), "file", "block", "seq", headless_column=True
    )
    parsed = scratch.keep(parsed, "parsed")

    # One row per split: small, but growing with the dump, so it is written too. Its size is then known when
    # the join is planned, and Spark broadcasts it or not accordingly.
    page = F.struct(*PAGE_COLUMNS, "malformed_page")
    tails = parsed.groupBy("file", "block").agg(
        F.max_by(page, F.when(~F.col("headless"), F.col("seq"))).alias("page")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry_in = scratch.keep(
        tails.select("file", "block", F.last("page", ignorenulls=True).over(before).alias("page")), "carry_in"
    )

    headless = parsed.where("headless").select("file", "block", "seq", *REVISION_COLUMNS, "malformed_revision")
    rejoined = headless.join(carry_in, ["file", "block"], "left").select(
        *[F.col(f"page.{name}").alias(name) for name in PAGE_COLUMNS],
        *REVISION_COLUMNS,
        "seq",
        "malformed_revision",
        F.col("page.malformed_page").alias("malformed_page"),
        F.col("page").isNull().alias("headless"),
    )
    complete = parsed.where("not headless").select(*rejoined.columns).unionByName(rejoined)
    orphan = F.when(F.col("headless"), F.concat(F.lit("no page before revision "), F.coalesce("id", F.lit(-1))))
    malformed = F.coalesce("malformed_revision", "malformed_page", orphan)
    return complete.select(*REVDOC.names, malformed.alias("malformed"), "seq")


def flatten(chunks: DataFrame, *keep: str, headless_column: bool = False) -> DataFrame:
    """Parse `(header, revision)` XML texts into revision documents, one row each.

    A text that does not fit the format gives a row whose fields are NULL and whose `malformed` holds the
    text, so that nothing is lost and bad input can be counted. `headless_column` leaves the page and the
    revision verdict apart and tells rows without a header, for a reader that has yet to find one.
    """
    parsed = chunks.select(
        *keep,
        "revision",
        F.from_xml("header", PAGE_XML, XML_OPTIONS).alias("p"),
        F.from_xml("revision", REVISION_XML, XML_OPTIONS).alias("r"),
        F.col("header").isNull().alias("headless"),
    )
    text = _content("text")
    flat = {
        "id": F.col("r.id"),
        "timestamp": F.col("r.timestamp"),
        "page_id": F.col("p.id"),
        "page_title": F.col("p.title"),
        "page_namespace": F.col("p.ns"),
        "page_redirect": F.col("p.redirect._title"),
        "page_restrictions": restrictions(F.col("p.restrictions")),
        "user_id": F.col("r.contributor.id"),
        "user_text": F.coalesce("r.contributor.username", "r.contributor.ip"),
        "minor": F.when(F.col("r.malformed").isNull(), F.col("r.minor").isNotNull()),
        "comment": _content("comment"),
        "bytes": F.coalesce(F.col("r.text._bytes"), F.octet_length(text).cast("bigint")),
        "text": text,
        "sha1": F.col("r.sha1"),
        "parent_id": F.col("r.parentid"),
        "model": F.col("r.model"),
        "format": F.col("r.format"),
    }
    columns = [flat[name].alias(name) for name in REVDOC.names]
    if headless_column:
        verdicts = [F.col("r.malformed").alias("malformed_revision"), F.col("p.malformed").alias("malformed_page")]
        return parsed.select(*keep, *columns, *verdicts, "headless")
    return parsed.select(*keep, *columns, F.coalesce("r.malformed", "p.malformed").alias("malformed"))


def restrictions(elements: Column) -> Column:
    """One entry per restrictions element, verbatim; no element gives the empty array."""
    return F.coalesce(elements, F.array().cast("array<string>"))


def _content(element: str) -> Column:
    """An element's text: NULL if it is absent or hidden. The parser drops blank text, so that is cut out here."""
    blank = F.regexp_extract("revision", rf"<{element}[^>]*>(\s*)</{element}>", 1)
    shown = F.col(f"r.{element}").isNotNull() & F.col(f"r.{element}._deleted").isNull()
    return F.when(shown, F.coalesce(F.col(f"r.{element}._VALUE"), blank))


def _header(chunk: Column) -> Column:
    """The page element without its revisions, from the last page tag before the first revision; NULL if none."""
    before = F.substring_index(chunk, "<revision>", 1)
    header = F.concat(F.lit("<page>"), F.substring_index(before, "<page>", -1), F.lit("</page>"))
    return F.when(before.contains("<page>"), header)


def _revision(chunk: Column) -> Column:
    """The revision element of a chunk that ends just before its closing tag."""
    return F.concat(F.lit("<revision>"), F.substring_index(chunk, "<revision>", -1), F.lit("</revision>"))


def _header_carrier():
    """Forward fill of `header` within a split, in the order of the file.

    Rows of a task arrive in that order, so this needs no shuffle, which a window would. Built as a closure
    so that executors need not have this package installed.
    """

    def carry(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        split, last = None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            files = batch.column("file").dictionary_encode()
            blocks = batch.column("block").to_numpy()
            moved = (np.diff(files.indices.to_numpy()) != 0) | (np.diff(blocks) != 0)
            starts = [0, *(np.flatnonzero(moved) + 1).tolist(), batch.num_rows]
            headers, filled = batch.column("header"), []
            for start, stop in zip(starts, starts[1:]):
                here = (batch.column("file")[start].as_py(), blocks[start])
                if here != split:
                    split, last = here, None
                seed = pa.array([last], type=headers.type)
                run = pc.fill_null_forward(pa.concat_arrays([seed, headers.slice(start, stop - start)])).slice(1)
                last = run[-1].as_py()
                filled.append(run)
            columns = [
                pa.concat_arrays(filled) if name == "header" else batch.column(name) for name in batch.schema.names
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return carry
