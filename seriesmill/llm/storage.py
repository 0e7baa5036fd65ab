"""Intermediate tables of the corpus operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seriesmill import session


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished jobs now.

    It removes them once the driver has collected its garbage, which else may
    take longer than a sequence of large jobs.
    """
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read from there; its shuffle files can go."""
    out = session.written(df, label)
    release(df.sparkSession)
    return out
