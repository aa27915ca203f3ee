"""Stage tables of many runs side by side: a run adds, and what it adds counts once its status is there."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


class StageStore:
    """Tables below a folder, one for each stage, partitioned by run and subset.

    Nothing is overwritten: a run writes below a name of its own, its status last.
    Of a sequence the latest run with a status of it counts, so a rerun replaces
    just the sequences it was about, and one that fails, or whose executors are
    lost, leaves all tables as they were.
    """

    STATUS = "status"

    def __init__(self, spark: SparkSession, folder: str, keys: tuple[str, ...]) -> None:
        self.spark, self.folder, self.keys = spark, folder.rstrip("/"), list(keys)
        self.run = self._next()

    def _next(self) -> str:
        before = self._read(self.STATUS)
        last = before.agg(F.max("run")).first()[0] if before is not None else None
        return f"{int(last.split('-')[0]) + 1 if last else 1:08d}-{uuid.uuid4().hex[:8]}"

    def _read(self, name: str) -> DataFrame | None:
        """A stage's rows of all runs, those of failed ones too; None where no run wrote any."""
        try:
            # A subset or run that looks like a number stays text.
            return self.spark.read.option("mergeSchema", "true").parquet(f"{self.folder}/{name}").withColumn("run", F.col("run").cast("string"))
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """Add this run's rows of a stage; returns them as read back."""
        df.withColumn("run", F.lit(self.run)).write.mode("append").partitionBy("run", self.keys[0]).parquet(f"{self.folder}/{name}")
        path = f"{self.folder}/{name}/run={self.run}"
        # No rows make no partition; the subset is read back as text, whatever it looks like.
        try:
            return self.spark.read.schema(df.schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], df.schema)

    def latest(self) -> DataFrame | None:
        """Each sequence's newest status, with its run; None before the first run has ended."""
        rows = self._read(self.STATUS)
        if rows is None:
            return None
        rest = [c for c in rows.columns if c not in self.keys]
        keys = [F.col(k).cast("string").alias(k) for k in self.keys]
        newest = rows.select(*keys, *rest).groupBy(*self.keys).agg(F.max_by(F.struct(*rest), "run").alias("_row"))
        return newest.select(*self.keys, "_row.*")

    def current(self, name: str) -> DataFrame | None:
        """Rows of a stage that count: for each sequence those of its newest run."""
        if name == self.STATUS:
            return self.latest()
        rows, newest = self._read(name), self.latest()
        if rows is None or newest is None:
            return None
        rows = rows.withColumns({k: F.col(k).cast("string") for k in self.keys})
        return rows.join(newest.select(*self.keys, "run"), [*self.keys, "run"], "left_semi").drop("run")
