"""Named Parquet tables under one folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The table ``name`` as it lies in ``base``: a file or a folder of part files."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
