"""Staged files against their manifest. File names are unique on both sides of every join here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The file statuses and their numbers.
PRESENT, ABSENT, CORRUPT, ERROR = "PRESENT", "ABSENT", "CORRUPT", "ERROR"
STATUS_CODES = {PRESENT: 0, ABSENT: 1, CORRUPT: 2, ERROR: 3}

# The checks. No check at all accepts every file.
MD5, SHA1, SIZE = "md5", "sha1", "size"
CHECKS = (MD5, SHA1, SIZE)

OK, MISMATCH = "OK", "MISMATCH"


def file_status(manifest: DataFrame, files: DataFrame, check: bool = True) -> DataFrame:
    """`(filename, md5, status)` for every file of the manifest.

    `files` holds `filename` and `digest`, the latter NULL if the file could not be read. Without `check`,
    being there is enough.
    """
    found = files.select("filename", *(["digest"] if check else []), F.lit(True).alias("found"))
    status = F.when(F.col("found").isNull(), ABSENT)
    if check:
        status = (
            status.when(F.col("digest").isNull() | F.col("md5").isNull(), ERROR)
            .when(F.col("digest") != F.col("md5"), CORRUPT)
        )
    return manifest.join(found, "filename", "left").select("filename", "md5", status.otherwise(PRESENT).alias("status"))


def status_code(status: Column) -> Column:
    """The number of a status."""
    code = None
    for name, number in STATUS_CODES.items():
        code = F.when(status == name, number) if code is None else code.when(status == name, number)
    return code


def pending_files(statuses: DataFrame) -> DataFrame:
    """Files still to be fetched: all that are not present and right."""
    return statuses.where(F.col("status") != PRESENT)


def unexpected_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that are there but not in the manifest."""
    return files.join(manifest, "filename", "left_anti")


def unverified_files(manifest: DataFrame, verified: DataFrame) -> DataFrame:
    """Manifest entries without a file of that name and digest among the verified ones."""
    return manifest.join(verified, ["filename", "md5"], "left_anti")


def any_error(statuses: DataFrame) -> DataFrame:
    """One row, `any_error`: whether a file could not be checked at all."""
    return statuses.agg(F.coalesce(F.bool_or(F.col("status") == ERROR), F.lit(False)).alias("any_error"))


def verify_files(files: DataFrame, expected: DataFrame, check: str | None) -> DataFrame:
    """`(filename, verdict)` for every row of `expected (filename, expected)`.

    `check` is md5 or sha1 (compared with `digest` of `files`), size (with `length`), or None, which accepts
    everything. A missing expected value, and a file that is not there or cannot be read, is an ERROR.
    """
    if check is None:
        return expected.select("filename", F.lit(OK).alias("verdict"))
    if check not in CHECKS:
        raise ValueError(f"unknown check {check!r}, expected one of {CHECKS} or None")
    actual = files.select("filename", F.col("length" if check == SIZE else "digest").cast("string").alias("actual"))
    wanted = F.col("expected").cast("string")
    verdict = (
        F.when(wanted.isNull() | (wanted == "") | F.col("actual").isNull(), ERROR)
        .when(F.col("actual") == wanted, OK)
        .otherwise(MISMATCH)
    )
    return expected.join(actual, "filename", "left").select("filename", verdict.alias("verdict"))
