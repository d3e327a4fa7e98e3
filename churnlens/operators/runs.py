"""Parameters and metrics of model runs, kept as a table with a folder for each thing logged.

What a run logs lies in the partition (run_id, kind, batch), the batch being named after the keys
logged, or by the caller, and a write replaces its own partitions only. So logging the same thing again, after a failure
or by a second attempt of a job, leaves one set of rows, and other runs are not touched.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import col
from .models import save_model

SCHEMA = "run_id string, run_name string, kind string, key string, value string, ts timestamp"


def metric_rows(metrics: DataFrame, run_name: str) -> DataFrame:
    """A one-row metric table as (run_name, kind, key, value)."""
    names = metrics.columns
    return metrics.unpivot([], [col(c) for c in names], "key", "value").select(
        F.lit(run_name).alias("run_name"), F.lit("metric").alias("kind"), "key", "value"
    )


def _named_after(keys: Iterable[str]) -> str:
    return hashlib.md5("\n".join(sorted(keys)).encode()).hexdigest()[:16]


class RunLog:
    """Runs below one folder: a Parquet table of entries, and the models."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def start(self, run_name: str, run_id: str | None = None) -> Run:
        """A run; with the ``run_id`` of an earlier one, that run again."""
        return Run(self, run_id or uuid.uuid4().hex, run_name)

    def entries(self) -> DataFrame:
        read = self.spark.read.schema(f"{SCHEMA}, batch string").parquet(f"{self.path}/entries")
        return read.select(*[f.split()[0] for f in SCHEMA.split(", ")])

    def search(self, **equal: str) -> DataFrame:
        """Entries whose run_id, run_name, kind, key or value equal the given ones."""
        df = self.entries()
        for name, value in equal.items():
            df = df.where(F.col(name) == value)
        return df

    def filter_run(self, run_id: str, n: int = 10) -> DataFrame:
        """The first entries of one run."""
        return self.search(run_id=run_id).orderBy("kind", "key").limit(n)


class Run:
    def __init__(self, log: RunLog, run_id: str, run_name: str):
        self.log, self.run_id, self.run_name = log, run_id, run_name

    def _write(self, rows: DataFrame, batch: str) -> None:
        rows.select(
            F.lit(self.run_id).alias("run_id"),
            F.lit(self.run_name).alias("run_name"),
            "kind",
            F.lit(batch).alias("batch"),
            "key",
            F.col("value").cast("string").alias("value"),
            F.current_timestamp().alias("ts"),
        ).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "run_id", "kind", "batch"
        ).parquet(f"{self.log.path}/entries")

    def log_params(self, params: dict, batch: str | None = None) -> None:
        rows = [("param", k, str(v)) for k, v in params.items()]
        if rows:
            table = self.log.spark.createDataFrame(rows, "kind string, key string, value string")
            self._write(table, batch or _named_after(params))

    def log_metrics(self, metrics: DataFrame, batch: str | None = None) -> None:
        """Logs a one-row metric table without fetching it."""
        self._write(metric_rows(metrics, self.run_name), batch or _named_after(metrics.columns))

    def log_model(self, model: Model) -> str:
        path = f"{self.log.path}/models/{self.run_id}"
        save_model(model, path, self.log.spark)
        return path


def runs_wide(entries: DataFrame, keys: list[str], by: tuple[str, ...] = ("run_id", "run_name")) -> DataFrame:
    """One row per run with a column per key."""
    return entries.groupBy(*by).pivot("key", keys).agg(F.max("value"))
