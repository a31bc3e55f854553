"""Reads of the driver's parquet tables (column-pruned, filter-pushable)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])


def first_table(spark: SparkSession, names, fallback_path: str | None = None) -> tuple[DataFrame, str]:
    """The first existing table or view of an ordered candidate list, else
    the parquet fallback; error when nothing exists."""
    for n in names:
        if spark.catalog.tableExists(n):
            return spark.table(n), n
    if fallback_path is not None:
        return spark.read.parquet(fallback_path), fallback_path
    raise ValueError(f"none of the tables exist: {list(names)}")


def ensure_table(spark: SparkSession, name: str, ddl: str, path: str) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS with an explicit schema, parquet at ``path``."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl}) USING parquet LOCATION '{path}'")
    return spark.table(name)
