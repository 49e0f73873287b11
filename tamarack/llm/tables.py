"""Readers of the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import few_rows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def platforms(spark: SparkSession, folder: str) -> list[str]:
    """Hosts of platform_hosts: a fixed table of a few rows."""
    return [r.host for r in few_rows(table(spark, folder, "platform_hosts"))]


def payloads(raw: DataFrame, *fields: str) -> DataFrame:
    """Columns id, source, ingested_at and the named payload fields as text."""
    parsed = raw.select("id", F.col("source").alias("__source"), "ingested_at", F.json_tuple("payload_json", *fields).alias(*[f"__{f}" for f in fields]))  # one parse for all fields
    return parsed.select("id", F.col("__source").alias("source"), "ingested_at", *[F.col(f"__{f}").alias(f) for f in fields])
