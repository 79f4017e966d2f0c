"""What is in a directory: names and lengths from the listing, digests from the content."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 4 * 1024 * 1024
READABLE_SCHEMES = ("file", "hdfs", "viewfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")

_FILE = "path string, length bigint, modified bigint"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def empty_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Paths and times (in ms) of the files of no bytes in a directory, hidden ones left out."""
    fs, target = _file_system(spark, path)
    empty = [s for s in fs.listStatus(target) if s.getLen() == 0 and s.isFile()]
    found = [(s.getPath().getName(), s.getPath().toString(), s.getModificationTime()) for s in empty]
    return [(path, time) for name, path, time in found if not name.startswith(("_", "."))]


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """`(path, filename, length, modified)` of the files in a directory. File contents are not read.

    Names that start with `_` or `.`, success markers among them, are hidden as in every Spark file source.
    """
    listing = spark.read.format("binaryFile").load(path)
    files = listing.select("path", _filename().alias("filename"), "length", F.col("modificationTime").alias("modified"))
    # Scans leave out files of no bytes, so those, and only those, are taken from the file system's own listing.
    empty = empty_files(spark, path)
    if not empty:
        return files
    listed = json.dumps([{"path": path, "length": 0, "modified": time} for path, time in empty])
    rows = spark.range(1).select(F.inline(F.from_json(F.lit(listed), f"array<struct<{_FILE}>>")))
    return files.unionByName(
        rows.select("path", _filename().alias("filename"), "length", F.timestamp_millis("modified").alias("modified"))
    )


def digests(
    spark: SparkSession,
    path: str,
    algorithm: str = "md5",
    only: DataFrame | None = None,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """The inventory of a directory with `digest`, which is NULL where reading failed.

    Every file, whatever its size, is read by one client in chunks, in constant memory. A digest is sequential, so a
    file is read by one task; files come to tasks as the scan of the listing deals them out, by their sizes, large ones
    alone, without a shuffle. Chunks are read by Arrow's file systems, which have credentials of their own; a scheme they
    do not know is an error at once. With `only`, a table of `filename`, no other file is read.
    """
    scheme = _file_system(spark, path)[0].getUri().getScheme()
    if scheme not in READABLE_SCHEMES:
        raise ValueError(f"files can't be read in chunks from {scheme}:, only from {READABLE_SCHEMES}")
    files = inventory(spark, path)
    if only is not None:
        files = files.join(only.select("filename").distinct(), "filename", "left_semi").select(*files.columns)
    schema = "path string, filename string, length bigint, modified timestamp, digest string"
    return files.mapInArrow(_hasher(algorithm, chunk_bytes), schema)


def _filename() -> Column:
    return F.substring_index("path", "/", -1)


def _hasher(algorithm: str, chunk_bytes: int):
    """Built as a closure so that executors need not have this package installed."""

    def hash_files(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa
        from pyarrow import ArrowException, fs

        def digest(path: str) -> str | None:
            hasher = hashlib.new(algorithm)
            try:
                if path.startswith("file:"):
                    store, name = fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
                else:
                    store, name = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                # The digest is of the file as it is; by default its name would decide on decompression.
                with store.open_input_stream(name, compression=None) as stream:
                    while chunk := stream.read(chunk_bytes):
                        hasher.update(chunk)
            except (OSError, ArrowException):
                return None
            return hasher.hexdigest()

        for batch in batches:
            found = pa.array([digest(path) for path in batch.column("path").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "digest"])

    return hash_files
