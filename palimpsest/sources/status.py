"""Status documents: which dumps are finished."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

READY_TEXT = "Dump complete"  # Fixed value: what a status document says once its dump is finished.

# A dump's directory is named <wiki>-<day>; the wiki and the day are read off the document's path.
DUMP_DIRECTORY = r"([^/]+)-([^/-]+)/[^/]+$"


def ready_dumps(spark: SparkSession, path: str) -> DataFrame:
    """`(wiki, day)` of every staged status document at `path` (a glob, usually) that says the dump is complete."""
    documents = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    return documents.where(F.col("value").contains(READY_TEXT)).select(
        F.regexp_extract("file", DUMP_DIRECTORY, 1).alias("wiki"),
        F.regexp_extract("file", DUMP_DIRECTORY, 2).alias("day"),
    )
