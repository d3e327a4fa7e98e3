"""Sinks. Stages are Parquet; CSV is for exchange with other tools."""

from __future__ import annotations

from pyspark.sql import DataFrame


def sink_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV part files with a header."""
    df.write.mode(mode).option("header", True).csv(path)


def sink_gzip_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Compressed CSV. Every task writes a file, so the result can be read in parallel."""
    df.write.mode(mode).option("header", True).option("compression", "gzip").csv(path)


def sink_stage_table(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a stage as Parquet and return it read back: what follows starts from the file,
    prunes columns and survives lost executors."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def sink_bucketed_table(
    df: DataFrame, table: str, key: str, buckets: int, mode: str = "overwrite"
) -> DataFrame:
    """A table bucketed and sorted by a join key; equality joins of such tables do not shuffle."""
    df.write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)
