"""Writes: revision documents, metadata, and the marker rules that make a write repeatable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest import storage
from palimpsest.operators.metadata import metadata
from palimpsest.operators.ordering import SLICE_BYTES, order_by_page
from palimpsest.schemas import REVDOC

# How many files by default, and the compressions of the metadata.
REVDOC_FILES = 2000
METADATA_FILES = 64
METADATA_COMPRESSIONS = ("snappy", "gzip")

WRITTEN, SKIPPED = "written", "skipped"


def write_revdocs(
    revdocs: DataFrame,
    path: str,
    files: int | None = REVDOC_FILES,
    compression: str = "bzip2",
    row_id: str | None = None,
    slice_bytes: int = SLICE_BYTES,
) -> None:
    """JSON lines in at most `files` files, each sorted by page and time (see `order_by_page`, also for None).

    Without a `row_id` the rows are first written to scratch storage, which numbers them. That also spares
    computing them more than once if they come from more than a scan.
    """
    with storage.Scratch(revdocs.sparkSession) as scratch:
        if row_id is None:
            row_id = "row"
            numbered = revdocs.select(*REVDOC.names, F.monotonically_increasing_id().alias(row_id))
            revdocs = scratch.keep(numbered, "numbered")
        ordered = order_by_page(revdocs, files, row_id, scratch, slice_bytes).select(*REVDOC.names)
        ordered.write.mode("overwrite").option("compression", compression).json(path)


def write_metadata(
    revdocs: DataFrame, path: str, files: int | None = METADATA_FILES, compression: str = "snappy"
) -> None:
    """Replace the Parquet files at `path` by the metadata of `revdocs`.

    `files` is the number of files; None leaves it to adaptive execution, which sizes them by their bytes. The
    aggregation is spread as the session says in either case: a number of files moves its narrow result once more.
    """
    require_compression(compression)
    _in_files(metadata(revdocs), files).write.mode("overwrite").option("compression", compression.lower()).parquet(path)


def load_metadata(
    spark: SparkSession,
    fulltext_table: str,
    metadata_table: str,
    files: int | None = METADATA_FILES,
    compression: str = "snappy",
) -> None:
    """The same from one registered table into the other, replacing what is there."""
    require_compression(compression)
    spark.sql(f"ALTER TABLE {metadata_table} SET SERDEPROPERTIES ('compression' = '{compression.lower()}')")
    _in_files(metadata(spark.table(fulltext_table)), files).write.insertInto(metadata_table, overwrite=True)


def _in_files(rows: DataFrame, files: int | None) -> DataFrame:
    return rows if files is None else rows.repartition(files)


def write_guarded(
    spark: SparkSession,
    write: Callable[[], None],
    output: str,
    input: str | None = None,
    force: bool = False,
    marker: str = storage.SUCCESS_MARKER,
    prepare: Callable[[], None] | None = None,
) -> str:
    """Run `write`, which fills `output`, unless its marker says that this is done already.

    `prepare` runs first, so what it refuses leaves the output of an earlier run as it was.

    `input`, if given, must carry the marker. With `force`, or if a run before left no marker, what is in
    `output` gives way. The marker appears last; a write that ends without one is an error.
    """
    if input is not None and not storage.has_marker(spark, input, marker):
        raise RuntimeError(f"no {marker} in input {input}")
    if storage.has_marker(spark, output, marker) and not force:
        return SKIPPED
    if prepare is not None:
        prepare()
    storage.delete(spark, output)
    write()
    if marker != storage.SUCCESS_MARKER and storage.has_marker(spark, output):
        storage.touch(spark, f"{output}/{marker}")
    if not storage.has_marker(spark, output, marker):
        raise RuntimeError(f"no {marker} in output {output} after writing")
    return WRITTEN


def require_compression(compression: str) -> None:
    if compression.lower() not in METADATA_COMPRESSIONS:
        raise ValueError(f"unknown compression {compression!r}, expected one of {METADATA_COMPRESSIONS}")

