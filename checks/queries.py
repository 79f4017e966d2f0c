"""One query per operator, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import samples
from palimpsest.functions import hex_digest, null_if_empty, valid_dump_day
from palimpsest.naming import dump_locations
from palimpsest.operators import audit, sinks
from palimpsest.operators.metadata import metadata, project_metadata
from palimpsest.operators.sql_steps import run_steps
from palimpsest.plans import Options, check_staged_files, convert, run
from palimpsest.sources import (
    digests,
    inventory,
    manifest_entries,
    manifest_pattern,
    read_metadata,
    read_pages,
    read_revdocs,
    read_revisions,
    ready_dumps,
    register_fulltext,
    register_metadata,
)
from palimpsest.storage import session_scratch, touch

ROWS_PER_FILE = 5_000  # Of the files that checks write, so that no file and no page of one grows with the tables.

FULLTEXT_TABLE, METADATA_TABLE = "check_fulltext", "check_metadata"


def check_files(spark: SparkSession, sf_dir: str) -> int:
    """How many files a check writes: by the size of the table."""
    return 8 + samples.table(spark, sf_dir, "conversations").count() // ROWS_PER_FILE


def metadata_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    revdocs = samples.revdocs(spark, sf_dir)
    retold = revdocs.withColumn("text", F.concat("text", F.lit(" again")))
    return samples.printable(metadata(revdocs.unionByName(revdocs).unionByName(retold)))


def metadata_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.printable(project_metadata(samples.revdocs(spark, sf_dir)))


def empty_restrictions_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    restrictions = F.when(F.col("id") % 4 != 3, F.col("page_restrictions"))
    cleaned = null_if_empty(restrictions)
    return samples.revdocs(spark, sf_dir).select(
        "id",
        F.size(restrictions).alias("n_before"),
        cleaned.isNull().alias("is_null"),
        F.array_join(cleaned, "|").alias("restrictions"),
    )


def metadata_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice, with each compression; the second write replaces the first."""
    path = session_scratch(spark).path("meta_parquet")
    revdocs = samples.revdocs(spark, sf_dir)
    sinks.write_metadata(revdocs.where("false"), path, files=check_files(spark, sf_dir), compression="gzip")
    sinks.write_metadata(revdocs.unionByName(revdocs), path, files=check_files(spark, sf_dir), compression="snappy")
    return samples.printable(read_metadata(spark, path))


def metadata_table_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the registered full-text table into the registered metadata table."""
    scratch = session_scratch(spark)
    revdocs = samples.revdocs(spark, sf_dir)
    sinks.write_revdocs(revdocs.unionByName(revdocs), scratch.path("jsonbz2"), check_files(spark, sf_dir))
    register_fulltext(spark, FULLTEXT_TABLE, scratch.path("jsonbz2"))
    register_metadata(spark, METADATA_TABLE, scratch.path("meta_parquet"))
    sinks.load_metadata(spark, FULLTEXT_TABLE, METADATA_TABLE, files=check_files(spark, sf_dir), compression="GZIP")
    return samples.printable(spark.table(METADATA_TABLE))


def revdocs_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session_scratch(spark).path("jsonbz2")
    sinks.write_revdocs(samples.revdocs(spark, sf_dir), path, check_files(spark, sf_dir), row_id="id")
    return samples.printable(read_revdocs(spark, path))


def revdocs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session_scratch(spark).path("jsonbz2")
    sinks.write_revdocs(samples.revdocs(spark, sf_dir), path, check_files(spark, sf_dir), row_id="id")
    register_fulltext(spark, "check_revdocs", path)
    return samples.printable(spark.table("check_revdocs"))


def xml_flatten_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session_scratch(spark).path("xmlbz2")
    samples.write_xml(spark, sf_dir, path)
    return samples.printable(read_pages(spark, path))


def xml_flatten_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = session_scratch(spark)
    samples.write_xml(spark, sf_dir, scratch.path("xmlbz2"))
    return samples.printable(read_revisions(spark, scratch.path("xmlbz2"), scratch).drop("seq"))


def page_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the written files look like per page. Every third conversation goes to one hot page."""
    path = session_scratch(spark).path("jsonbz2")
    page = F.when(F.col("page_id") % 3 == 0, F.lit(0)).otherwise(F.col("page_id"))
    minute = F.format_string("2015-01-%02dT%02d:00:00Z", 1 + F.col("page_id") % 28, F.col("id") % 24)
    revdocs = samples.revdocs(spark, sf_dir).withColumns({"timestamp": minute, "page_id": page})
    sinks.write_revdocs(revdocs, path, check_files(spark, sf_dir), row_id="id", slice_bytes=0)
    return files_per_page(read_revdocs(spark, path))


def files_per_page(written: DataFrame) -> DataFrame:
    rows = written.select(
        "page_id", "timestamp", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("seq")
    )
    in_file = Window.partitionBy("page_id", "file").orderBy("seq")
    by_time = Window.partitionBy("page_id").orderBy("first", "last")
    pieces = (
        rows.withColumn("late", F.lag("timestamp").over(in_file) > F.col("timestamp"))
        .groupBy("page_id", "file")
        .agg(
            F.count("*").alias("n"),
            F.min("timestamp").alias("first"),
            F.max("timestamp").alias("last"),
            (F.max("seq") - F.min("seq") + 1 == F.count("*")).alias("contiguous"),
            F.coalesce(F.bool_or("late"), F.lit(False)).alias("unsorted"),
        )
        .withColumn("overlaps", F.coalesce(F.lag("last").over(by_time) > F.col("first"), F.lit(False)))
    )
    return pieces.groupBy("page_id").agg(
        F.sum("n").alias("n"),
        F.bool_and("contiguous").alias("contiguous"),
        F.bool_and(~F.col("unsorted")).alias("sorted_in_files"),
        F.bool_and(~F.col("overlaps")).alias("files_in_time_order"),
        (F.count("*") > 1).alias("cut"),
    )


def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = manifest_pattern(samples.WIKI, samples.DAY, "history")
    return manifest_entries(samples.manifest_lines(spark, sf_dir), pattern)


def dump_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = samples.manifest_lines(spark, sf_dir)

    def entries(label: str, kind: str, exclude_multistream: bool = False) -> DataFrame:
        pattern = manifest_pattern(samples.WIKI, samples.DAY, kind)
        found = manifest_entries(lines, pattern, exclude_multistream=exclude_multistream)
        return found.select(F.lit(label).alias("dump_type"), "filename", "md5")

    return (
        entries("history", "history")
        .unionByName(entries("current", "current"))
        .unionByName(entries("current_single_stream", "current", exclude_multistream=True))
    )


def status_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session_scratch(spark).path("status")
    samples.write_status_documents(spark, sf_dir, path)
    ready = ready_dumps(spark, f"{path}/*/*.txt")
    return ready.select(F.regexp_replace("wiki", "^dump=", "").alias("wiki"), "day")


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory(spark, sf_dir).select("filename", "length")


def file_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _file_digests(spark, sf_dir)


def file_digest_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in chunks of 10 kB, so that every file has many."""
    return _file_digests(spark, sf_dir, chunk_bytes=10_000)


def _file_digests(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    md5, sha1 = (
        digests(spark, sf_dir, algorithm, **options).select(
            "filename", "length", F.lit(algorithm).alias("algorithm"), "digest"
        )
        for algorithm in (audit.MD5, audit.SHA1)
    )
    return md5.unionByName(sha1)


def content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.table(spark, sf_dir, "documents").select(
        "doc_id",
        hex_digest(F.col("text"), "md5").alias("md5"),
        hex_digest(F.col("text"), "sha1").alias("sha1"),
        F.octet_length("text").cast("bigint").alias("length"),
    )


def _statuses(spark: SparkSession, sf_dir: str, check: bool = True) -> DataFrame:
    return audit.file_status(samples.expected_files(spark, sf_dir), samples.present_files(spark, sf_dir), check)


def file_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _statuses(spark, sf_dir).select(F.lit(True).alias("checked"), "*")
    unchecked = _statuses(spark, sf_dir, check=False).select(F.lit(False).alias("checked"), "*")
    return checked.unionByName(unchecked).withColumn("code", audit.status_code(F.col("status")))


def pending_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.pending_files(_statuses(spark, sf_dir))


def unexpected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = samples.present_files(spark, sf_dir).select("filename", "length")
    return audit.unexpected_files(files, samples.expected_files(spark, sf_dir))


def unverified_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    verified = _statuses(spark, sf_dir).where(F.col("status") == audit.PRESENT)
    return audit.unverified_files(samples.expected_files(spark, sf_dir), verified)


def status_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    statuses = _statuses(spark, sf_dir)
    clean = statuses.where(F.col("status") != audit.ERROR)
    return (
        audit.any_error(statuses).select(F.lit("all").alias("files"), "any_error")
        .unionByName(audit.any_error(clean).select(F.lit("clean").alias("files"), "any_error"))
    )


def verify_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files, listed = samples.present_files(spark, sf_dir), samples.expected_files(spark, sf_dir)
    sha1 = files.select("filename", "length", F.col("sha1").alias("digest"))
    runs = {
        "none": audit.verify_files(files, listed, None),
        "md5": audit.verify_files(files, listed.withColumnRenamed("md5", "expected"), audit.MD5),
        "sha1": audit.verify_files(sha1, listed.select("filename", F.sha1("filename").alias("expected")), audit.SHA1),
        "size": audit.verify_files(
            files.withColumn("length", F.col("length") - F.col("length") % 2), _sizes(spark, sf_dir), audit.SIZE
        ),
    }
    verdicts = [df.select(F.lit(name).alias("check"), "filename", "verdict") for name, df in runs.items()]
    result = verdicts[0]
    for more in verdicts[1:]:
        result = result.unionByName(more)
    return result


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected lengths, half of them of an odd number of bytes."""
    return samples.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("file-"), F.col("doc_id").cast("string")).alias("filename"),
        F.octet_length("text").cast("bigint").alias("expected"),
    )


def valid_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.day_texts(spark, sf_dir).select(
        "event_id",
        "day",
        valid_dump_day(F.col("day")).alias("valid"),
        valid_dump_day(F.col("day"), strict=True).alias("valid_strictly"),
    )


def dump_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    dumps = samples.table(spark, sf_dir, "events").select(
        F.concat("event_type", F.lit("wiki")).alias("wiki"), F.date_format("ts", "yyyyMMdd").alias("day")
    )
    return dumps.distinct().select("wiki", "day", *dump_locations(F.col("wiki"), F.col("day"), "/dumps/"))


def sql_step(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = session_scratch(spark).path("jsonbz2")
    sinks.write_revdocs(samples.revdocs(spark, sf_dir), path, check_files(spark, sf_dir), row_id="id")
    register_fulltext(spark, "check_steps", path)
    statements = [
        "REFRESH TABLE IDENTIFIER(:revdocs)",
        """SELECT page_id, count(*) AS n, sum(bytes) AS bytes, :label AS label
           FROM IDENTIFIER(:revdocs) WHERE user_text = :author GROUP BY page_id""",
    ]
    return run_steps(spark, statements, {"revdocs": "check_steps", "author": "user", "label": "a=b; --c"})


def guarded_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs over one output: the second is skipped, the third is forced."""
    scratch = session_scratch(spark)
    revdocs = samples.revdocs(spark, sf_dir)
    results = []
    for attempt, force in ((1, False), (2, False), (3, True)):
        output = scratch.path("jsonbz2")
        rows = revdocs.withColumn("comment", F.concat(F.lit(f"attempt {attempt} of "), F.col("id").cast("string")))
        outcome = sinks.write_guarded(
            spark, lambda: sinks.write_revdocs(rows, output, check_files(spark, sf_dir), row_id="id"), output, force=force
        )
        seen = scratch.keep(read_revdocs(spark, output).select("id", "comment"), f"seen{attempt}")
        results.append(seen.select(F.lit(attempt).alias("attempt"), F.lit(outcome).alias("outcome"), "id", "comment"))
    return results[0].unionByName(results[1]).unionByName(results[2])


def custom_converter(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = session_scratch(spark)
    xml, json = scratch.path("xmlbz2"), scratch.path("jsonbz2")
    samples.write_xml(spark, sf_dir, xml)
    touch(spark, f"{xml}/_SUCCESS")
    convert(
        spark, xml, json, files=check_files(spark, sf_dir), converter=lambda df: df.withColumn("comment", F.upper(F.trim("comment")))
    )
    return read_revdocs(spark, json).select("id", "page_id", "comment", "text")


def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged dump through all five stages; the metadata table that comes out."""
    dump = samples.stage_dump(spark, sf_dir, session_scratch(spark))
    run(spark, dump, Options(revdoc_files=check_files(spark, sf_dir), metadata_files=check_files(spark, sf_dir)))
    return samples.printable(spark.table(dump.metadata_table))


def full_run_with_strays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with files in the folder that no manifest lists; both tables, and what the check counted."""
    scratch = session_scratch(spark)
    dump = samples.stage_dump(spark, sf_dir, scratch)
    strays = samples.revdocs(spark, sf_dir).withColumn("page_id", F.col("page_id") + 1_000_000)
    samples.page_xml(strays).coalesce(2).write.option("compression", "bzip2").text(scratch.path("strays"))
    samples.place(spark, scratch.path("strays"), dump.xml_path, lambda n: f"{samples.WIKI}-{samples.DAY}-pages-articles{n}.xml.bz2")
    outcome = run(spark, dump, Options(revdoc_files=check_files(spark, sf_dir), metadata_files=None))
    rows = spark.table(dump.metadata_table).select("id", "page_id", "bytes").join(
        spark.table(dump.fulltext_table).select("id", "text"), "id", "full"
    )
    return rows.select("*", (F.lit(outcome["unexpected_files"]) != "0").alias("strays_counted"))


def full_run_both_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of both dump types in one folder and one manifest, both checked, then each converted by a run of its own."""
    scratch = session_scratch(spark)
    dump = samples.stage_dump(spark, sf_dir, scratch)
    samples.place_current(spark, sf_dir, dump, scratch)
    for kind in ("history", "current"):
        check_staged_files(spark, dump, manifest_path=scratch.path("md5-both"), kind=kind)
    seen = []
    for kind in ("current", "history"):
        options = Options(check_files=False, kind=kind, force=True, revdoc_files=check_files(spark, sf_dir), metadata_files=None)
        run(spark, dump, options)
        rows = spark.table(dump.metadata_table).select(F.lit(kind).alias("dump_type"), "id", "page_id", "bytes")
        seen.append(scratch.keep(rows, f"rows-{kind}"))
    return seen[0].unionByName(seen[1])


def missing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list that stays when files of a manifest are missing: one line per document, none of them staged."""
    scratch = session_scratch(spark)
    dump = samples.stage_dump(spark, sf_dir, scratch)
    documents = samples.table(spark, sf_dir, "documents")
    name = F.format_string(f"{samples.WIKI}-{samples.DAY}-pages-meta-history%s.xml-doc.bz2", F.col("doc_id").cast("string"))
    documents.select(F.concat_ws("  ", F.md5("text"), name)).write.text(scratch.path("lines"))
    try:
        check_staged_files(spark, dump, manifest_path=scratch.path("lines"))
    except RuntimeError:
        return spark.read.parquet(f"{dump.path}/problems/files_missing_or_corrupt")
    raise AssertionError("missing files were not noticed")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        metadata_load,
        metadata_projection,
        empty_restrictions_null,
        metadata_parquet_roundtrip,
        metadata_table_load,
        revdocs_json_roundtrip,
        revdocs_table,
        xml_flatten_page,
        xml_flatten_revision,
        page_order,
        manifest_scan,
        dump_types,
        status_ready,
        file_inventory,
        file_digest,
        file_digest_chunked,
        content_digest,
        file_status,
        pending_files,
        unexpected_files,
        unverified_files,
        status_guard,
        verify_files,
        valid_day,
        dump_naming,
        sql_step,
        guarded_write,
        custom_converter,
        full_run,
        full_run_with_strays,
        full_run_both_types,
        missing_report,
    )
}
