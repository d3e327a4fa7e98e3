"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import new_work_path

__all__ = ["new_work_path", "staged"]


def staged(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read back.

    Cuts lineage: whatever reads the table later, also after an executor is lost, reads files.
    """
    spark = df.sparkSession
    path = new_work_path(spark, name)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
