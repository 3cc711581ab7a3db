"""Quality checks measured by the very pass that writes a table.

The counts are observed metrics of the write, so neither the rows nor the written table are read
a second time.  They are taken behind the last shuffle, in the tasks whose results Spark counts once,
also if executors are lost.  Each batch's counts are stored as a run and summed at reading, so a
check of a table of any age costs a few rows per batch; a batch that is written again replaces
its counts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from earshot.operators import quality
from earshot.operators.filters import on_date
from earshot.sinks.levels import LevelledRuns

COUNTS = "check_name string, counted long, at_least long"


class TableChecks:
    """Checks of one table that can be counted row by row.

    ``checks`` names conditions that no row may meet; ``dates`` are days that must have rows, and
    ``minimum`` is the least number of rows over all batches.
    """

    def __init__(
        self,
        checks: dict[str, Column],
        dates: tuple[str | dt.date, ...] = (),
        minimum: int | None = None,
        rows_name: str = "rows",
        ts: str = "played_at",
    ) -> None:
        found = {name: (F.count_if(bad), None) for name, bad in checks.items()}
        found |= {f"rows_for_date:{d}": (F.count_if(on_date(F.col(ts), d)), 1) for d in dates}
        if minimum is not None:
            found[f"min_rows:{rows_name}"] = (F.count(F.lit(1)), minimum)
        if not found:
            raise ValueError("no check was given")
        self.found = found

    def observed(self, df: DataFrame) -> tuple[DataFrame, Observation]:
        """``df`` with the counts as metrics of whatever job computes it first."""
        observation = Observation()
        counts = [count.alias(f"c{i}") for i, (count, _) in enumerate(self.found.values())]
        return df.observe(observation, *counts), observation

    def rows(self, spark: SparkSession, observation: Observation) -> DataFrame:
        """The observed counts, one row per check; waits for the job that they are taken in."""
        values = observation.get
        rows = [
            (name, int(values[f"c{i}"]), at_least)
            for i, (name, (_, at_least)) in enumerate(self.found.items())
        ]
        return spark.createDataFrame(rows, COUNTS)


def _summed(counts: DataFrame, *_) -> DataFrame:
    return counts.groupBy("check_name").agg(
        F.sum("counted").alias("counted"), F.max("at_least").alias("at_least")
    )


def check_runs(spark: SparkSession, path: str) -> LevelledRuns:
    return LevelledRuns(spark, path, COUNTS, _summed)


def write_checked(
    df: DataFrame, path: str, by: list[str], checks: TableChecks, counts_path: str, batch_id: int = 0
) -> None:
    """Writes Parquet partitioned by path, as ``write_partitioned``, and stores what was counted.

    Rows are written first: a job that breaks off in between is repeated as a whole.
    """
    dealt = df.hint("rebalance", *[F.col(c) for c in by]) if by else df
    watched, observation = checks.observed(dealt)
    writer = watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    counts = checks.rows(df.sparkSession, observation)
    check_runs(df.sparkSession, counts_path).add(batch_id, counts.coalesce(1))


def read_checks(spark: SparkSession, *counts_paths: str) -> DataFrame:
    """Results (check_name, violations, status) over all batches of the given tables."""

    def graded(path: str) -> DataFrame:
        missing = F.greatest(F.col("at_least") - F.col("counted"), F.lit(0))
        violations = F.when(F.col("at_least").isNull(), F.col("counted")).otherwise(missing)
        return quality.graded(
            _summed(check_runs(spark, path).read()).select(
                "check_name", violations.alias("violations")
            )
        )

    return quality.union(*map(graded, counts_paths))
