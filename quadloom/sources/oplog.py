"""An append-only log of ops, and snapshots of what it comes to.

Layout below the root:
  log/batch=<n>/         ops of one batch; writing a batch again replaces it
  snapshot/through=<n>/  accumulated batches up to and with n
  finished/              one row (through) per snapshot that is whole

Nothing that may be being read is written over: a compaction makes a new
snapshot, and readers use the newest finished one with the batches after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadloom.operators import state
from quadloom.vocab import DEFAULTS, Settings


class OpLog:
    def __init__(self, spark: SparkSession, root: str, attrs: Sequence[str]):
        self.spark = spark
        self.attrs = list(attrs)
        self._log = root.rstrip("/") + "/log"
        self._snapshots = root.rstrip("/") + "/snapshot"
        self._finished = root.rstrip("/") + "/finished"

    def append(self, ops: DataFrame, batch: int) -> None:
        """Write a batch. Doing so again with the same number changes nothing."""
        names = ["op", "identifier", "ts", "seq", *self.attrs]
        ops.select(*names).write.mode("overwrite").parquet(f"{self._log}/batch={batch}")

    def ops(self) -> DataFrame:
        return self.spark.read.parquet(self._log)

    def _newest_snapshot(self) -> int | None:
        try:
            finished = self.spark.read.schema("through BIGINT").parquet(self._finished)
        except AnalysisException:  # there is no such folder yet
            return None
        return finished.agg(F.max("through")).first()[0]

    def accumulated(self, through: int | None = None) -> DataFrame:
        ops = self.ops() if through is None else self.ops().filter(F.col("batch") <= through)
        base = self._newest_snapshot()
        if base is None or (through is not None and base > through):
            return state.accumulate(ops, self.attrs)
        saved = self.spark.read.parquet(f"{self._snapshots}/through={base}")
        return state.combine(saved, state.accumulate(ops.filter(F.col("batch") > base), self.attrs))

    def current(self) -> DataFrame:
        return state.live(self.accumulated(), self.attrs)

    def additions(self, text_col: str) -> DataFrame:
        """Append-only rows added by the log."""
        return state.additions_of_ops(self.ops(), text_col)

    def versions(self, settings: Settings = DEFAULTS) -> DataFrame:
        """A version of each write in the log."""
        return state.versions_of_ops(self.ops(), self.attrs, settings)

    def compact(self, through: int) -> None:
        """Save what the log up to batch ``through`` comes to, if it is not saved yet."""
        newest = self._newest_snapshot()
        if newest is not None and newest >= through:
            return
        self.accumulated(through).write.mode("overwrite").parquet(f"{self._snapshots}/through={through}")
        done = self.spark.range(1).select(F.lit(through).cast("bigint").alias("through"))
        done.write.mode("append").parquet(self._finished)
