"""A table that grows by one run of rows per batch, with runs merged in levels.

A batch writes its rows to a folder of its own, ``l0-<batch>-<batch>``.  Once ``fan`` runs of a
level have gathered, they are merged into one run of the next level, so that n batches leave at
most ``fan`` folders on each of log(n) levels, and each row is rewritten once per level.

A run counts once Spark has marked its folder as finished, and a run that lies within
a larger finished one does not count any more, so a job that breaks off at any point, also
between a merge and the removal of the merged runs, neither loses nor doubles a row.
Merged runs are removed when the next batch begins, for readers that still have them open.  A
repeated batch replaces its own run: only runs of earlier batches are merged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from earshot.sinks import files

FAN = 8
FINISHED = "_SUCCESS"

Run = tuple[int, int, int]


class LevelledRuns:
    """The runs below ``path``; ``merge`` makes the rows of several runs those of one.

    ``merge`` gets the rows and the first and last batch that they come from.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType | str,
        merge: Callable[[DataFrame, int, int], DataFrame],
        fan: int = FAN,
    ) -> None:
        if fan < 2:
            raise ValueError("at least two runs are merged")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.merge, self.fan = merge, fan

    def _folder(self, run: Run) -> str:
        return f"{self.path}/l{run[0]}-{run[1]}-{run[2]}"

    def _stored(self) -> list[Run]:
        """All folders, whether or not they count."""
        found = [name[1:].split("-") for name in files.names(self.spark, self.path)]
        return sorted((tuple(map(int, parts)) for parts in found), key=lambda run: run[1:])

    def runs(self, before: int | None = None) -> list[Run]:
        """Runs that count, (level, first batch, last batch) in order of their batches."""
        finished = [
            run
            for run in self._stored()
            if (before is None or run[2] < before)
            and files.exists(self.spark, f"{self._folder(run)}/{FINISHED}")
        ]
        return [
            run
            for run in finished
            if not any(other[0] > run[0] and other[1] <= run[1] and run[2] <= other[2] for other in finished)
        ]

    def read(
        self, before: int | None = None, first: int | None = None, last: int | None = None
    ) -> DataFrame:
        """Rows of the batches below ``before``, or of those from ``first`` to ``last``."""
        runs = [
            run
            for run in self.runs(before)
            if (first is None or run[1] >= first) and (last is None or run[2] <= last)
        ]
        if not runs:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*map(self._folder, runs))

    def add(self, batch_id: int, rows: DataFrame) -> None:
        """Stores the rows of a batch, after what earlier batches left to do."""
        self.tidy(batch_id)
        rows.write.mode("overwrite").parquet(self._folder((0, batch_id, batch_id)))

    def tidy(self, before: int) -> None:
        """Removes merged runs and merges full levels, among the batches below ``before``."""
        live = self.runs(before)
        for run in self._stored():
            if run[2] < before and run not in live:
                files.delete(self.spark, self._folder(run))
        level = 0
        while any(run[0] >= level for run in live):
            full = [run for run in live if run[0] == level]
            if len(full) >= self.fan:
                self._merge(full, level + 1)
                live = self.runs(before)
            level += 1

    def compact(self, before: int) -> None:
        """Merges all batches below ``before`` into one run."""
        live = self.runs(before)
        if len(live) > 1:
            self._merge(live, max(run[0] for run in live) + 1)

    def _merge(self, runs: list[Run], level: int) -> None:
        first, last = runs[0][1], runs[-1][2]
        rows = self.spark.read.schema(self.schema).parquet(*map(self._folder, runs))
        merged = self.merge(rows, first, last)
        merged.write.mode("overwrite").parquet(self._folder((level, first, last)))
