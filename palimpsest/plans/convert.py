"""Stage 2: XML to revision documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest import storage
from palimpsest.operators import sinks
from palimpsest.operators.ordering import SLICE_BYTES
from palimpsest.schemas import REVDOC
from palimpsest.sources import inventory, read_pages, read_revisions
from palimpsest.sources.manifest import require_kind

Converter = Callable[[DataFrame], DataFrame]


def convert(
    spark: SparkSession,
    xml_path: str,
    json_path: str,
    kind: str = "history",
    files: int | None = sinks.REVDOC_FILES,
    converter: Converter | None = None,
    allow_malformed: bool = False,
    force: bool = False,
    marker: str = storage.SUCCESS_MARKER,
    also: Callable[[DataFrame], None] | None = None,
    only: DataFrame | None = None,
    slice_bytes: int = SLICE_BYTES,
) -> str:
    """Read the marked XML folder and write sorted revision documents, unless that is done already.

    `only` lists the files to read (`filename`, `length`, `modified`, `digest`); None reads all of the folder. What was read
    is listed in `input_path(json_path)`. A marked output that was made from other files, or as another dump type, is
    neither skipped nor replaced but an error, unless `force` is set. Malformed revisions are listed whole in
    `<json_path>_malformed`. A page of more than `slice_bytes` may be cut into several files (see `order_by_page`).

    `converter` is applied to the revision documents on the way. Input that does not fit the format stops the
    run before anything is written; with `allow_malformed` its rows are kept, with NULL fields. `also` gets the
    revision documents once they are written, while they are still at hand as columns; it is not called if
    there was nothing to do.
    """

    require_kind(kind)
    if only is None and storage.has_marker(spark, xml_path, marker):
        only = inventory(spark, xml_path).withColumn("digest", F.lit(None).cast("string"))
    if storage.has_marker(spark, json_path, marker) and not force and only is not None:
        require_same_input(spark, json_path, kind, only)

    parsed: list[DataFrame] = []

    with storage.Scratch(spark) as scratch:

        def parse() -> None:
            # As many names as the dump has files.
            source = [f"{xml_path}/{row['filename']}" for row in only.select("filename").orderBy("filename").collect()]
            if not source:
                raise RuntimeError(f"no {kind} file to read in {xml_path}")
            if kind == "current":
                numbered = read_pages(spark, source).withColumn("seq", F.monotonically_increasing_id())
                revdocs = scratch.keep(numbered, "parsed")
            else:
                revdocs = read_revisions(spark, source, scratch)
            if not allow_malformed:
                bad = revdocs.where(F.col("malformed").isNotNull()).select("seq", "id", "page_id", "malformed")
                n = bad.count()
                if n:
                    listed = f"{json_path}_malformed"
                    bad.write.mode("overwrite").parquet(listed)
                    raise RuntimeError(f"{n} malformed revisions in {xml_path}, listed in {listed}")
            parsed.append(revdocs)

        def write() -> None:
            revdocs = parsed[0]
            if converter is not None:
                converted = revdocs.drop("malformed", "seq").transform(converter).select(*REVDOC.names)
                revdocs = scratch.keep(converted.withColumn("seq", F.monotonically_increasing_id()), "converted")
            read = only.select(F.lit(kind).alias("kind"), "filename", "length", "modified", "digest")
            read.write.mode("overwrite").parquet(input_path(json_path))
            sinks.write_revdocs(revdocs, json_path, files, row_id="seq", slice_bytes=slice_bytes)
            if also is not None:
                also(revdocs.select(*REVDOC.names))

        return sinks.write_guarded(spark, write, json_path, input=xml_path, force=force, marker=marker, prepare=parse)


def input_path(json_path: str) -> str:
    """Where the files are listed that the revision documents were made from."""
    return f"{json_path}_input"


def require_same_input(spark: SparkSession, json_path: str, kind: str, files: DataFrame) -> None:
    """An error if the output says that it was made from other files. Files of equal digests are the same; without
    digests their lengths and times decide."""
    if not storage.exists(spark, input_path(json_path)):
        return
    read = spark.read.parquet(input_path(json_path))
    if not read.where(F.col("kind") != kind).isEmpty():
        raise RuntimeError(f"{json_path} holds revisions of another dump type than {kind}; set force to replace them")
    was = read.select("filename", *[F.col(name).alias(f"{name}_was") for name in ("length", "modified", "digest")])
    both = F.col("digest").isNotNull() & F.col("digest_was").isNotNull() & (F.length("digest") == F.length("digest_was"))
    same = F.when(both, F.col("digest") == F.col("digest_was")).otherwise(F.col("modified") == F.col("modified_was"))
    same = F.coalesce(same & (F.col("length") == F.col("length_was")), F.lit(False))
    other = files.join(was, "filename", "full").where(~same)
    if not other.isEmpty():
        raise RuntimeError(f"{json_path} was made from other files than are there now; set force to replace it")
