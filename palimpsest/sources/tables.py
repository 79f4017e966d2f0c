"""The two tables as files and as catalog entries."""

from pyspark.sql import DataFrame, SparkSession

from palimpsest.operators.sql_steps import run_steps
from palimpsest.schemas import METADATA, REVDOC, ddl


def read_revdocs(spark: SparkSession, path: str) -> DataFrame:
    """Full-text JSON lines. A line that is not JSON of this shape fails the read instead of turning into NULLs."""
    return spark.read.schema(REVDOC).option("mode", "FAILFAST").json(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METADATA).parquet(path)


# A table with a location is external: dropping it leaves the files.
REGISTER_FULLTEXT = [
    "DROP TABLE IF EXISTS IDENTIFIER(:table)",
    f"CREATE TABLE IDENTIFIER(:table) ({ddl(REVDOC)}) USING json OPTIONS (mode 'FAILFAST') LOCATION :path",
]
REGISTER_METADATA = [
    "DROP TABLE IF EXISTS IDENTIFIER(:table)",
    f"CREATE TABLE IDENTIFIER(:table) ({ddl(METADATA)}) USING parquet LOCATION :path",
]


def register_fulltext(spark: SparkSession, table: str, path: str) -> None:
    """(Re-)create the external full-text table over the JSON files at `path`."""
    run_steps(spark, REGISTER_FULLTEXT, {"table": table, "path": path})


def register_metadata(spark: SparkSession, table: str, path: str) -> None:
    """(Re-)create the external metadata table over the Parquet files at `path`."""
    run_steps(spark, REGISTER_METADATA, {"table": table, "path": path})
