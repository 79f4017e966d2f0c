"""Checksum manifests: which files a dump should have, and their digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A manifest line is a 32-character digest, two spaces and the file name. The dump type picks
# the family of file names.
FILE_FAMILIES = {"history": "pages-meta-history", "current": "pages-articles"}
LINE_PATTERN = r"({value})  ({wiki}-{day}-{family}.*\.xml.*\.bz2)"
VALUES = {"md5": r"\w{32}", "sha1": r"\w{40}", "size": r"\d+"}  # What stands before the name, by check.
MULTISTREAM = "-multistream"


def manifest_pattern(wiki: str, day: str, kind: str = "history", check: str | None = "md5") -> str:
    """The pattern of the lines that list the files of one wiki, day and dump type, with what `check` compares."""
    require_kind(kind)
    return LINE_PATTERN.format(value=VALUES[check or "md5"], wiki=wiki, day=day, family=FILE_FAMILIES[kind])


def require_kind(kind: str) -> None:
    if kind not in FILE_FAMILIES:
        raise ValueError(f"unknown dump type {kind!r}, expected one of {sorted(FILE_FAMILIES)}")


def manifest_entries(
    lines: DataFrame, pattern: str, line: str = "line", order: Column | str = "line_no", exclude_multistream: bool = False
) -> DataFrame:
    """`(md5, filename)` for every file listed in `lines`; the last line wins if a name is repeated.

    The pattern is searched for in the line, not anchored. The aggregate keeps one row per name on the map
    side, so a name repeated without bound never gathers in one task.
    """
    entries = lines.where(F.col(line).rlike(pattern)).select(
        F.regexp_extract(line, pattern, 1).alias("md5"),
        F.regexp_extract(line, pattern, 2).alias("filename"),
        (F.col(order) if isinstance(order, str) else order).alias("_order"),
    )
    if exclude_multistream:
        entries = entries.where(~F.col("filename").contains(MULTISTREAM))
    return entries.groupBy("filename").agg(F.max_by("md5", "_order").alias("md5")).select("md5", "filename")


def read_manifest(
    spark: SparkSession,
    path: str,
    wiki: str,
    day: str,
    kind: str = "history",
    exclude_multistream: bool = False,
    check: str | None = "md5",
) -> DataFrame:
    """The entries of the manifest file (or files) at `path`; `md5` holds whatever value `check` compares."""
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("seq"),
        ).alias("line_no"),
    )
    return manifest_entries(lines, manifest_pattern(wiki, day, kind, check), exclude_multistream=exclude_multistream)
