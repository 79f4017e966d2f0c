"""Lists of SQL statements with named parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def check_parameters(spark: SparkSession, statements: Sequence[str], parameters: Mapping[str, object]) -> dict:
    """The parameters that have a value; raises if a statement names one that has none.

    Spark's own parser says which names a statement uses: explaining it binds them without running it.
    """
    bound = {name: value for name, value in parameters.items() if value not in (None, "")}
    for statement in statements:
        try:
            spark.sql("EXPLAIN " + statement, args=bound)
        except AnalysisException as error:
            # Anything else, such as a table an earlier statement has yet to create, is for the run to tell.
            if error.getCondition() == "UNBOUND_SQL_PARAMETER":
                raise ValueError(f"parameter without a value in: {statement}") from error
    return bound


def run_steps(spark: SparkSession, statements: Sequence[str], parameters: Mapping[str, object]) -> DataFrame | None:
    """Run the statements in order and return the last one's result.

    Statements use `:name` for values and `IDENTIFIER(:name)` for tables. Nothing runs unless every name has
    a value. Values are bound, never pasted into the text, so they may hold any character.
    """
    bound = check_parameters(spark, statements, parameters)
    result = None
    for statement in statements:
        result = spark.sql(statement, args=bound)
    return result
