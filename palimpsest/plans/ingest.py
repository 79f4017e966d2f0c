"""Stage 1: are the staged files of a dump complete and right?"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest import storage
from palimpsest.functions import valid_dump_day
from palimpsest.naming import Dump
from palimpsest.operators import audit
from palimpsest.sources import digests, inventory, read_manifest, ready_dumps
from palimpsest.sources.manifest import FILE_FAMILIES, require_kind



def check_staged_files(
    spark: SparkSession,
    dump: Dump,
    manifest_path: str | None = None,
    status_path: str | None = None,
    kind: str = "history",
    check: str | None = audit.MD5,
    exclude_multistream: bool = False,
    delete_unexpected: bool = False,
    delete_corrupt: bool = False,
    marker: str = storage.SUCCESS_MARKER,
) -> dict[str, int]:
    """Compare the files below `dump.xml_path` with the manifest and mark the folder if all are right.

    Returns how many files are present and how many do not belong there. Raises if the dump is not complete at
    its source, the manifest lists nothing, a file cannot be read, or a file is missing or corrupt: once those
    are staged again, another run gets further. All such files are listed in a Parquet folder that stays, named in
    the message. Files that do not belong stay, unless `delete_unexpected` is set, and corrupt ones, unless
    `delete_corrupt` is. The marker of an earlier run is taken away first.

    `check` is what the manifest holds before each name: md5 or sha1, size, or None if being there is enough.
    Only files of the manifest are read. Those that were right are listed in `verified_path(dump, kind)`, with their
    lengths, times and digests, a list for each dump type.
    """
    manifest_path = manifest_path or f"{dump.path}/{dump.wiki}-{dump.day}-md5sums.txt"
    status_path = status_path or f"{dump.path}/status.html"
    require_valid_day(spark, dump.day)
    require_ready(spark, dump, status_path)
    if check is not None and check not in audit.CHECKS:
        raise ValueError(f"unknown check {check!r}, expected one of {audit.CHECKS} or None")
    storage.make_folder(spark, dump.xml_path)
    storage.delete(spark, f"{dump.xml_path}/{marker}")
    storage.delete(spark, verified_path(dump, kind))

    with storage.Scratch(spark) as scratch:
        manifest = scratch.keep(
            read_manifest(spark, manifest_path, dump.wiki, dump.day, kind, exclude_multistream, check), "manifest"
        )
        if manifest.isEmpty():
            raise RuntimeError(f"{manifest_path} lists no {kind} file of {dump.wiki} {dump.day}")
        if check in (audit.MD5, audit.SHA1):
            files = scratch.keep(digests(spark, dump.xml_path, check, only=manifest), "files")
        else:
            files = inventory(spark, dump.xml_path).withColumn("digest", F.col("length").cast("string"))
            files = scratch.keep(files, "files")
        statuses = scratch.keep(audit.file_status(manifest, files, check is not None), "statuses")

        # Four rows at most.
        tally = {row["status"]: row["count"] for row in statuses.groupBy("status").count().collect()}
        if audit.ERROR in tally:
            _fail(dump, "files that could not be checked", statuses.where(F.col("status") == audit.ERROR))
        if delete_corrupt:
            for row in statuses.where(F.col("status") == audit.CORRUPT).select("filename").toLocalIterator():
                storage.delete(spark, f"{dump.xml_path}/{row['filename']}")
        unexpected = scratch.keep(audit.unexpected_files(inventory(spark, dump.xml_path), manifest), "unexpected")
        if delete_unexpected:
            for row in unexpected.toLocalIterator():
                storage.delete(spark, row["path"])
        present = statuses.where(F.col("status") == audit.PRESENT)
        missing = audit.unverified_files(manifest, present)
        if not missing.isEmpty():
            _fail(dump, "files missing or corrupt", missing.join(statuses.select("filename", "status"), "filename"))
        verified = files.join(present.select("filename"), "filename", "left_semi")
        digest = F.col("digest") if check in (audit.MD5, audit.SHA1) else F.lit(None).cast("string")
        listed = verified.select(F.lit(kind).alias("kind"), "filename", "length", "modified", digest.alias("digest"))
        listed.write.mode("overwrite").parquet(verified_path(dump, kind))
        storage.touch(spark, f"{dump.xml_path}/{marker}")
        return {"present": tally[audit.PRESENT], "unexpected": unexpected.count()}


def require_valid_day(spark: SparkSession, day: str) -> None:
    valid = spark.range(1).select(valid_dump_day(F.lit(day)).alias("valid")).first()["valid"]
    if not valid:
        raise ValueError(f"{day!r} is not a day of the form yyyyMMdd that a dump can be of")


def require_ready(spark: SparkSession, dump: Dump, status_path: str) -> None:
    ready = ready_dumps(spark, status_path)
    named = (F.col("wiki") == dump.wiki) & (F.col("day") == dump.day)
    # A path that does not name a dump must lead to one document, which then speaks for this dump.
    nameless = (F.col("wiki") == "") & (F.lit(spark.read.text(status_path, wholetext=True).count()) == 1)
    if ready.where(named | nameless).isEmpty():
        raise RuntimeError(f"{status_path} does not say that the dump of {dump.wiki} {dump.day} is complete")


def verified_path(dump: Dump, kind: str = "history") -> str:
    """Where the files of a dump type are listed that the last check of that type found right."""
    require_kind(kind)
    return f"{dump.path}/verified/{kind}"


def inputs(spark: SparkSession, dump: Dump, kind: str) -> DataFrame:
    """`(kind, filename, length, modified, digest)`: the files that stage 2 has to read.

    Those are the verified ones of the dump type, and an error if one of them has changed since, or is gone. If only the
    other type was verified, the marker speaks for that one, which is an error too. Without any check, all files of
    the folder count but those named like another dump type's; their digests are NULL.
    """
    there = inventory(spark, dump.xml_path)
    if storage.exists(spark, verified_path(dump, kind)):
        listed = spark.read.parquet(verified_path(dump, kind))
        now = there.select("filename", F.col("length").alias("length_now"), F.col("modified").alias("modified_now"))
        same = F.coalesce((F.col("length") == F.col("length_now")) & (F.col("modified") == F.col("modified_now")), F.lit(False))
        changed = listed.join(now, "filename", "left").where(~same)
        if not changed.isEmpty():
            _fail(dump, "files changed since they were checked", changed)
        return listed
    for other in sorted(set(FILE_FAMILIES) - {kind}):
        if storage.exists(spark, verified_path(dump, other)):
            raise RuntimeError(f"{dump.xml_path} was checked for {other} files, not for {kind} files")
    stray = F.lit(False)
    for other, family in FILE_FAMILIES.items():
        if other != kind:
            stray = stray | F.col("filename").contains(f"-{family}")
    return there.where(~stray).select(F.lit(kind).alias("kind"), "filename", "length", "modified", F.lit(None).cast("string").alias("digest"))


def _fail(dump: Dump, what: str, files: DataFrame) -> None:
    """Raise with the number of files, and list them all in a folder that stays."""
    listed = f"{dump.path}/problems/{what.replace(' ', '_')}"
    files.write.mode("overwrite").parquet(listed)
    raise RuntimeError(f"{spark_count(files, listed)} {what}, listed in {listed}")


def spark_count(files: DataFrame, listed: str) -> int:
    return files.sparkSession.read.schema(files.schema).parquet(listed).count()
