import pytest

from palimpsest.operators.sql_steps import run_steps


def test_values_may_hold_anything(spark):
    row = run_steps(spark, ["SELECT :a AS a, :b AS b, ':c -- ;' AS c"], {"a": "x=y; DROP", "b": "--'"}).first()
    assert (row["a"], row["b"], row["c"]) == ("x=y; DROP", "--'", ":c -- ;")


@pytest.mark.parametrize("parameters", [{}, {"value": ""}, {"value": None}, {"other": "x"}])
def test_nothing_runs_without_all_values(spark, parameters, tmp_path):
    statements = [
        f"CREATE TABLE steps_table (a INT) USING parquet LOCATION '{tmp_path}/t'",
        "SELECT :value AS value",
    ]
    with pytest.raises(ValueError, match="parameter without a value"):
        run_steps(spark, statements, parameters)
    assert not spark.catalog.tableExists("steps_table")


def test_unused_parameters_may_be_empty(spark):
    assert run_steps(spark, ["SELECT :a AS a"], {"a": 1, "unused": ""}).first()["a"] == 1


def test_statements_run_in_order_on_tables_made_before(spark, tmp_path):
    result = run_steps(
        spark,
        [
            "DROP TABLE IF EXISTS IDENTIFIER(:t)",
            "CREATE TABLE IDENTIFIER(:t) (a INT) USING parquet LOCATION :p",
            "INSERT OVERWRITE TABLE IDENTIFIER(:t) SELECT 3",
            "SELECT * FROM IDENTIFIER(:t)",
        ],
        {"t": "steps_order", "p": str(tmp_path / "data")},
    )
    assert [r["a"] for r in result.collect()] == [3]
