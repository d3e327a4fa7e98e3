"""Text sources. ``header`` is always the caller's statement: a header line read as data
would become a row."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.projection import nan_to_null

# Characters that cannot be seen: control and format characters, byte order mark.
_INVISIBLE = re.compile("[\u0000-\u001f\u007f-\u009f­​-‏ -‮⁠﻿]")


def clean_names(df: DataFrame) -> DataFrame:
    """Strip characters that do not print from the column names."""
    return df.toDF(*[_INVISIBLE.sub("", c) for c in df.columns])


def scan_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType, header: bool = False
) -> DataFrame:
    """CSV with a fixed schema; no pass over the data to find one. NaN becomes NULL."""
    return nan_to_null(clean_names(spark.read.schema(schema).option("header", header).csv(path)))


def scan_header_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return scan_typed_csv(spark, path, schema, header=True)


def scan_infer_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV whose types are inferred, at the price of one more pass over the file."""
    return clean_names(spark.read.option("header", True).option("inferSchema", True).csv(path))


def scan_stage_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    index_column: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """A stage written as CSV, gzip or not (told by the file name).

    ``index_column``: the first, unnamed column is a row number and is left out. A gzip file
    cannot be split and is read by one task; ``partitions`` spreads its rows afterwards.
    """
    full = T.StructType(
        ([T.StructField("_index", T.StringType())] if index_column else []) + schema.fields
    )
    df = scan_header_csv(spark, path, full).drop("_index")
    return df.repartition(partitions) if partitions else df


def scan_stage_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
