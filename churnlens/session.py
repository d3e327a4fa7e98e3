"""Session helpers: the shared working folder and column quoting."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only where driver and executors are one process (``local`` master) and none is named, a
    folder is made, once a session; anywhere else its absence is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = _own_dir(spark.sparkContext.master, spark.sparkContext.applicationId)
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


@cache
def _own_dir(master: str, application: str) -> str:
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(
            f"set spark.checkpoint.dir to a folder that all executors share (master {master!r})"
        )
    return tempfile.mkdtemp(prefix="churnlens-")


def new_work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def quoted(name: str) -> str:
    """A column name as SQL text; names may hold spaces, dashes or dots."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string as SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def col(name: str) -> Column:
    return F.col(quoted(name))


def with_row(df: DataFrame, row: DataFrame, name: str) -> DataFrame:
    """Adds a one-row frame as a struct column. It is a scalar subquery: evaluated once, then a
    constant of the plan, with no join."""
    return df.withColumn(name, row.select(F.struct("*")).scalar())
