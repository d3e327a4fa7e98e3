"""Raw files to typed landing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..fixtures import Tables
from ..schemas import SOURCES
from .csv import scan_typed_csv
from .sinks import sink_stage_table

# Only the metrics file is known to start with a header line.
DEFAULT_HEADERS = {"metrics": True}


def land_raw(
    spark: SparkSession,
    raw: dict[str, str],
    landing_dir: str,
    headers: dict[str, bool] = DEFAULT_HEADERS,
) -> Tables:
    """Read the five CSV sources with their schemas and write each as a landing table."""
    landed = {
        name: sink_stage_table(
            scan_typed_csv(spark, raw[name], schema, headers.get(name, False)),
            f"{landing_dir}/{name}",
        )
        for name, schema in SOURCES.items()
    }
    return Tables(**landed)


def read_landing(spark: SparkSession, landing_dir: str) -> Tables:
    return Tables(**{name: spark.read.parquet(f"{landing_dir}/{name}") for name in SOURCES})


def list_landing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, modificationTime, relative) of all files below a folder; contents are not read.
    ``relative`` is the path below the folder."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
        .select("path", "length", "modificationTime")
    )
    folder = "/" + path.split("://", 1)[-1].split(":", 1)[-1].strip("/") + "/"
    return files.withColumn("relative", F.substring_index("path", folder, -1))
