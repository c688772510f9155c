"""Tables that a job writes for itself, in the folder that executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []
ROWS_A_RANGE = 1_000_000


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which executors share; below a temporary one only where that is unset."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root and sc._jsc.sc().getCheckpointDir().isDefined():
        root = sc._jsc.sc().getCheckpointDir().get()
    if not root and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that executors share")
    if not root:
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="meterline-"))
        root = _own[0]
    return f"{root.rstrip('/')}/sink-{uuid.uuid4().hex}"


def written(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """df, computed once and read back from Parquet, so that what follows may read it often and lost executors cost no more
    than a re-read. by: columns that files are partitioned by."""
    path = scratch(df.sparkSession)
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    schema = df.select(*[c for c in df.columns if c not in (by or [])], *(by or [])).schema
    return df.sparkSession.read.schema(schema).parquet(path).select(*df.columns)


def ranged(df: DataFrame, order: list[Column], rows: int = ROWS_A_RANGE) -> DataFrame:
    """df, written, with `_part`: a number of ranges that follows the number of rows, about `rows` in each, in this order.
    The order should end with a key, so that no range holds too many equal rows."""
    kept = written(df)
    parts = -(-kept.count() // rows)  # from the files' footers
    if parts < 2:
        return kept.withColumn("_part", F.lit(0))
    return written(kept.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
