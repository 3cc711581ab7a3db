from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from earshot.operators import quality
from earshot.sinks import checked


def checks(minimum=None, dates=()):
    return checked.TableChecks(
        {"not_null:t.a": quality.is_missing("a"), "range:t.b": quality.outside("b", 0, 10)},
        dates=dates,
        minimum=minimum,
        rows_name="t",
        ts="ts",
    )


def table(spark, values):
    found = spark.createDataFrame(values, "a string, b int, day string")
    return found.withColumn("ts", F.to_timestamp("day")).withColumn("date", F.to_date("day"))


def test_counts_of_the_write_equal_those_of_a_second_pass(spark, tmp_path):
    df = table(spark, [("x", 1, "2024-01-01"), (None, 11, "2024-01-02"), (None, None, "2024-01-02")])
    path, counts = str(tmp_path / "t"), str(tmp_path / "c")
    checked.write_checked(df, path, ["date"], checks(5, ("2024-01-02", "2024-02-01")), counts)
    written = spark.read.parquet(path)
    plain = quality.union(
        quality.check_not_null(written, "t", "a"),
        quality.check_range(written, "t", b=(0, 10)),
        quality.check_rows_for_date(written, "2024-01-02", "ts"),
        quality.check_rows_for_date(written, "2024-02-01", "ts"),
        quality.check_min_rows({"t": written}, 5),
    )
    assert rows(checked.read_checks(spark, counts)) == rows(plain)
    assert written.count() == 3


def test_batches_add_up_and_a_repeated_one_replaces_its_counts(spark, tmp_path):
    path, counts = str(tmp_path / "t"), str(tmp_path / "c")
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    for batch, day in [*enumerate(days), (2, days[2])]:
        checked.write_checked(table(spark, [(None, batch, day)] * 4), path, ["date"], checks(12), counts, batch)
    found = {r["check_name"]: (r["violations"], r["status"]) for r in checked.read_checks(spark, counts).collect()}
    assert found == {"not_null:t.a": (12, "failure"), "range:t.b": (0, "success"), "min_rows:t": (0, "success")}


def test_the_write_scans_its_table_once(spark, tmp_path):
    source = str(tmp_path / "s")
    table(spark, [("x", 1, "2024-01-01")] * 50).write.parquet(source)
    watched, observation = checks(1).observed(spark.read.parquet(source).hint("rebalance", "date"))
    plan = watched._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("CollectMetrics") == 1
    # Counted behind the shuffle, where each task counts once.
    assert plan.index("CollectMetrics") < plan.index("Exchange")
    watched.write.parquet(str(tmp_path / "t"))
    assert observation.get == {"c0": 0, "c1": 0, "c2": 50}


def test_empty_tables_and_no_checks(spark, tmp_path):
    counts = str(tmp_path / "c")
    checked.write_checked(table(spark, []), str(tmp_path / "t"), [], checks(1), counts)
    found = {r["check_name"]: r["violations"] for r in checked.read_checks(spark, counts).collect()}
    assert found == {"not_null:t.a": 0, "range:t.b": 0, "min_rows:t": 1}
    with pytest.raises(ValueError, match="no check"):
        checked.TableChecks({})
