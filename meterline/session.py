"""Session settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def utc(spark: SparkSession) -> SparkSession:
    """Timestamps are UTC wall clock."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
