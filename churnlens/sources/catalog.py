"""Catalogs and databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def setup_namespace(spark: SparkSession, catalog: str, database: str) -> None:
    """Make a catalog and a database current; the database is created if it is missing."""
    spark.catalog.setCurrentCatalog(catalog)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    spark.catalog.setCurrentDatabase(database)


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")
