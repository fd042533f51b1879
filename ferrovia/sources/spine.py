"""Integer spine source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spine(spark: SparkSession, lo: int, hi: int, name: str = "n") -> DataFrame:
    """Every integer in ``[lo, hi]`` — always complete, one small partition."""
    return spark.range(lo, hi + 1, 1, numPartitions=1).withColumnRenamed("id", name)
