"""Revision documents, dump files and manifests made by Spark from the test tables.

`conversations` stands in for pages and their revisions (conv_id is the page, turn the revision), `documents`
for dump files (the digest of the text is the digest of the file). `(conv_id, turn)` and `doc_id` are keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.naming import Dump
from palimpsest.operators.audit import MD5
from palimpsest.schemas import REVDOC
from palimpsest.sources import digests
from palimpsest.storage import Scratch

WIKI, DAY = "samplewiki", "20240115"
REVISIONS_PER_PAGE_ELEMENT = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def revdocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One revision document per turn of a conversation."""
    turn, page = F.col("turn"), F.col("conv_id")
    revision = page * 1000 + turn
    columns = {
        "id": revision,
        "timestamp": F.format_string("2015-01-01T%02d:%02d:00Z", F.expr("turn div 60"), turn % 60),
        "page_id": page,
        "page_title": F.concat(F.lit("Conv & <"), page.cast("string"), F.lit(">")),
        "page_namespace": page % 2,
        "page_redirect": F.when(page % 7 == 0, F.concat(F.lit('To "'), page.cast("string"), F.lit('"'))),
        "page_restrictions": F.when(page % 5 == 0, F.array(F.lit("edit=sysop"))).otherwise(F.array()),
        "user_id": F.when(F.col("role") != "system", turn),
        "user_text": F.col("role"),
        "minor": turn % 3 == 0,
        "comment": F.when(turn > 0, F.concat(F.lit(" c "), turn.cast("string"))),
        "bytes": F.octet_length("text"),
        "text": F.col("text"),
        "sha1": F.sha1("text"),
        "parent_id": F.when(turn > 0, revision - 1),
        "model": F.lit("wikitext"),
        "format": F.lit("text/x-wiki"),
    }
    return table(spark, sf_dir, "conversations").select(
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in REVDOC]
    )


def printable(revdocs: DataFrame) -> DataFrame:
    """The same rows with the restrictions as text, as databases print arrays differently."""
    return revdocs.withColumn("page_restrictions", F.array_join("page_restrictions", "|"))


def _escape(text: Column) -> Column:
    escaped = text
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(entity))
    return escaped


def _element(name: str, content: Column) -> Column:
    """An element, or nothing for a NULL."""
    return F.coalesce(F.concat(F.lit(f"<{name}>"), _escape(content.cast("string")), F.lit(f"</{name}>")), F.lit(""))


def page_xml(revdocs: DataFrame) -> DataFrame:
    """`value`: page elements of at most `REVISIONS_PER_PAGE_ELEMENT` revisions each, so no group grows large."""
    contributor = F.concat(
        F.lit("<contributor>"),
        F.when(F.col("user_id").isNull(), _element("ip", F.col("user_text"))).otherwise(
            F.concat(_element("username", F.col("user_text")), _element("id", F.col("user_id")))
        ),
        F.lit("</contributor>"),
    )
    revision = F.concat(
        F.lit("    <revision>\n"),
        _element("id", F.col("id")),
        _element("parentid", F.col("parent_id")),
        _element("timestamp", F.col("timestamp")),
        contributor,
        F.when(F.col("minor"), "<minor />").otherwise(""),
        _element("comment", F.col("comment")),
        _element("model", F.col("model")),
        _element("format", F.col("format")),
        F.format_string('<text xml:space="preserve" bytes="%s">', F.col("bytes").cast("string")),
        _escape(F.col("text")),
        F.lit("</text>"),
        _element("sha1", F.col("sha1")),
        F.lit("\n    </revision>\n"),
    )
    header = F.concat(
        F.lit("  <page>\n"),
        _element("title", F.col("page_title")),
        _element("ns", F.col("page_namespace")),
        _element("id", F.col("page_id")),
        F.coalesce(F.concat(F.lit('<redirect title="'), _escape(F.col("page_redirect")), F.lit('" />')), F.lit("")),
        F.array_join(F.transform("page_restrictions", lambda r: _element("restrictions", r)), ""),
        F.lit("\n"),
    )
    group = F.expr(f"(id % 1000) div {REVISIONS_PER_PAGE_ELEMENT}").alias("part")
    # Latest first: the dump's own order is not the order the documents have to come out in.
    newest_first = F.reverse(F.array_sort(F.collect_list(F.struct("id", "xml"))))
    return (
        revdocs.select("page_id", group, header.alias("header"), "id", revision.alias("xml"))
        .groupBy("page_id", "part", "header")
        .agg(newest_first.alias("revisions"))
        .select(
            F.concat(
                "header", F.array_join(F.transform("revisions", lambda r: r["xml"]), ""), F.lit("  </page>")
            ).alias("value")
        )
    )


ROWS_PER_XML_FILE = 10_000


def write_xml(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A bzip2 XML dump of all conversations, in as many files as their number asks for, without a marker."""
    rows = revdocs(spark, sf_dir)
    pages = page_xml(rows).repartition(4 + rows.count() // ROWS_PER_XML_FILE)
    pages.write.mode("overwrite").option("compression", "bzip2").text(path)


def stage_dump(spark: SparkSession, sf_dir: str, scratch: Scratch) -> Dump:
    """A dump as it lies there before a first run: XML files with proper names, manifest, status document."""
    dump = Dump(WIKI, DAY, scratch.path("base"))
    write_xml(spark, sf_dir, scratch.path("xml"))
    place(spark, scratch.path("xml"), dump.xml_path, lambda n: f"{WIKI}-{DAY}-pages-meta-history{n}.xml-p{n}.bz2")
    manifest = digests(spark, dump.xml_path, MD5).select(F.concat_ws("  ", "digest", "filename"))
    manifest.coalesce(1).write.text(scratch.path("md5"))
    place(spark, scratch.path("md5"), dump.path, lambda n: f"{WIKI}-{DAY}-md5sums.txt")
    status = spark.range(1).select(F.lit("<html>Dump complete</html>"))
    status.coalesce(1).write.text(scratch.path("status"))
    place(spark, scratch.path("status"), dump.path, lambda n: "status.html")
    return dump


def place_current(spark: SparkSession, sf_dir: str, dump: Dump, scratch: Scratch) -> None:
    """Files of the other dump type beside those of `stage_dump`: each page under another number, its revisions with a text
    that is one character longer. The manifest of both is at `md5-both`."""
    rows = revdocs(spark, sf_dir).withColumns(
        {"page_id": F.col("page_id") + 1_000_000, "text": F.concat("text", F.lit("+")), "bytes": F.col("bytes") + 1}
    )
    page_xml(rows).write.option("compression", "bzip2").text(scratch.path("current"))
    place(spark, scratch.path("current"), dump.xml_path, lambda n: f"{WIKI}-{DAY}-pages-articles{n}.xml-p{n}.bz2")
    digests(spark, dump.xml_path, MD5).select(F.concat_ws("  ", "digest", "filename")).write.text(scratch.path("md5-both"))


def place(spark: SparkSession, source: str, target: str, name: Callable[[int], str]) -> None:
    """Give the part files of `source` names of our own in `target`."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    fs.mkdirs(path(target))
    parts = sorted(status.getPath().toString() for status in fs.globStatus(path(f"{source}/part-*")))
    for number, part in enumerate(parts):
        fs.rename(path(part), path(f"{target}/{name(number)}"))


def write_status_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """One status document per language and source; the number of documents decides which are complete."""
    dumps = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    state = F.when(F.col("n") % 3 == 0, "in progress").otherwise("complete")
    dumps.select(
        F.format_string("%swiki-%s", "lang", "source").alias("dump"),
        F.concat(F.lit("<html>\n<p>Dump "), state, F.lit("</p>\n</html>")).alias("value"),
    ).write.partitionBy("dump").text(path)


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(line_no, line)`: a manifest with other wikis, other days, bad spacing, indexes and repeated names."""
    documents = table(spark, sf_dir, "documents")
    doc = F.col("doc_id")
    family = (
        F.when(doc % 24 == 0, "pages-articles-multistream")
        .when(doc % 4 == 0, "pages-articles")
        .otherwise("pages-meta-history")
    )
    wiki = F.when(doc % 13 == 5, "otherwiki").otherwise(WIKI)
    day = F.when(doc % 11 == 3, "20240101").otherwise(DAY)
    gap = F.when(doc % 17 == 2, " ").otherwise("  ")
    suffix = F.when(doc % 19 == 4, ".xml.7z").when(doc % 23 == 6, "-index.txt.bz2").otherwise(".xml-p1.bz2")
    # Ten documents in a row share a name when their number is a multiple of 50; the last one counts.
    number = F.when(doc % 50 < 10, doc - doc % 10).otherwise(doc).cast("string")
    return documents.select(
        doc.alias("line_no"),
        F.concat(F.md5("text"), gap, F.concat_ws("-", wiki, day, family), number, suffix).alias("line"),
    )


def expected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(filename, md5)`: a manifest that lists nine of ten documents, some with a wrong or no digest."""
    doc = F.col("doc_id")
    md5 = (
        F.when(doc % 7 == 1, F.md5(F.concat("text", F.lit("x"))))
        .when(doc % 29 == 3, F.lit(None))
        .otherwise(F.md5("text"))
    )
    return (
        table(spark, sf_dir, "documents")
        .where(doc % 10 != 9)
        .select(F.concat(F.lit("file-"), doc.cast("string")).alias("filename"), md5.alias("md5"))
    )


def present_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(filename, length, digest, sha1)`: the files that are there, four of five documents; some are unreadable."""
    doc = F.col("doc_id")
    return (
        table(spark, sf_dir, "documents")
        .where(doc % 5 != 2)
        .select(
            F.concat(F.lit("file-"), doc.cast("string")).alias("filename"),
            F.octet_length("text").cast("bigint").alias("length"),
            F.when(doc % 31 != 8, F.md5("text")).alias("digest"),
            F.sha1("text").alias("sha1"),
        )
    )


def day_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`(event_id, day)`: days of events, and texts that are nearly days, from 2005 to 2024."""
    event = F.col("event_id")
    made = F.concat(
        (2005 + event % 20).cast("string"),
        F.lpad((event % 14).cast("string"), 2, "0"),
        F.lpad((event % 33).cast("string"), 2, "0"),
    )
    day = (
        F.when(event % 3 == 0, F.date_format("ts", "yyyyMMdd"))
        .when(event % 41 == 1, F.concat(F.lit("x"), made))
        .when(event % 43 == 2, F.concat(made, F.lit("cd")))
        .when(event % 47 == 4, F.substring(made, 1, 4))
        .when(event % 53 == 5, F.lit(None))
        .otherwise(made)
    )
    return table(spark, sf_dir, "events").select("event_id", day.alias("day"))
