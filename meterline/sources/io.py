"""Scans and sinks."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.columns import bucket, file_stem, pad_id
from ..operators.quality import upsert_history
from . import commits


@dataclass(frozen=True)
class PositionalCsv:
    """Columns of a headerless CSV by position: (name, type); ids are padded."""

    columns: tuple[tuple[str, str], ...]
    ids: tuple[str, ...] = ()


def typed(df: DataFrame, c: PositionalCsv) -> DataFrame:
    """Text columns trimmed, cast (null where text doesn't fit) and ids padded."""
    out = [(pad_id(F.col(n)) if n in c.ids else F.trim(n) if t == "string" else F.trim(n).try_cast(t)).alias(n) for n, t in c.columns]
    return df.select(*out)


def read_positional_csv(spark: SparkSession, path: str, c: PositionalCsv) -> DataFrame:
    schema = StructType([StructField(n, StringType()) for n, _ in c.columns])
    return typed(spark.read.schema(schema).csv(path), c)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_records(spark: SparkSession, path: str, marker: str = "00000001,") -> DataFrame:
    """Records of several lines that begin with a marker, one per row, as arrays of lines. They are cut where files are
    read, so files still split and no line is numbered."""
    raw = spark.read.option("lineSep", f"\n{marker}").text(path)
    whole = F.when(F.col("value").startswith(marker), F.col("value")).otherwise(F.concat(F.lit(marker), "value"))
    return raw.where(F.length(F.trim("value")) > 0).select(F.split(F.regexp_replace(whole, r"\s+$", ""), "\r?\n").alias("record"), F.input_file_name().alias("path"))


def read_reads(spark: SparkSession, *paths: str) -> DataFrame:
    """Reads of several versions; those without updated_time_utc count as the oldest."""
    return null_safe_version(spark.read.option("mergeSchema", "true").parquet(*paths))


def null_safe_version(df: DataFrame, column: str = "updated_time_utc") -> DataFrame:
    old = F.timestamp_seconds(F.lit(0))
    return df.withColumn(column, F.coalesce(column, old) if column in df.columns else old)


def days_between(df: DataFrame, date: Column, start: str, end: str, pad: int = 0) -> DataFrame:
    """Rows from `pad` days before start to `pad` days after end."""
    return df.where(date.between(F.date_sub(F.lit(start).cast("date"), pad), F.date_add(F.lit(end).cast("date"), pad)))


def scan_days(spark: SparkSession, root: str, start: str, end: str, pad: int = 0) -> DataFrame:
    """Days of a table partitioned by year, month and day. The bounds on year are plain, so that they prune."""
    df = spark.read.parquet(root).where(F.col("year").between(int(start[:4]) - (pad > 0), int(end[:4]) + (pad > 0)))
    return days_between(df, F.make_date("year", "month", "day"), start, end, pad)


def jdbc(spark: SparkSession, options: dict[str, str], query: str, by: str | None = None, rows: int = 1_000_000, most: int = 32) -> DataFrame:
    """A query that the database runs. With a numeric column `by` it is read in ranges of that column, of about `rows` rows
    each, by at most `most` connections at once; one query of the database finds the bounds and the count. Conditions and
    columns of what follows reach the database."""
    reader = spark.read.format("jdbc").options(**options)
    if by is None:
        return reader.option("query", query).load()
    low, high, n = reader.option("query", f'select min(q."{by}") as low, max(q."{by}") as high, count(*) as n from ({query}) q').load().first()
    parts = min(most, -(-int(n) // rows), 0 if low is None else int(high) - int(low) + 1)
    if parts > 1:
        reader = spark.read.format("jdbc").options(**options, partitionColumn=by, lowerBound=str(low), upperBound=str(int(high) + 1), numPartitions=str(parts))
    else:
        reader = spark.read.format("jdbc").options(**options)
    return reader.option("dbtable", f"({query}) q").load()


CHANNEL_MAP = """select c."channel_id", c."account_id", c."location_id", case when c."direction_code" = {delivered} then 'D' else 'R' end as "direction",
  trim(leading '0' from c."external_id") as "external_id", l."name" as "location", t."name" as "tenant"
  from {channels} c join {locations} l on c."location_id" = l."location_id" join {tenants} t on l."tenant_id" = t."tenant_id" """


def read_channel_map(spark: SparkSession, options: dict[str, str], channels: str = "channel", locations: str = "location", tenants: str = "tenant", delivered: int = 1, rows: int = 1_000_000, most: int = 32) -> DataFrame:
    """Channels with their locations and tenants: the database joins them, and channels are read in ranges of their id.
    Directions become D and R, and external ids lose leading zeros; one that is all zeros is '0'."""
    df = jdbc(spark, options, CHANNEL_MAP.format(channels=channels, locations=locations, tenants=tenants, delivered=delivered), "channel_id", rows, most)
    return df.withColumn("external_id", F.when(F.col("external_id") == "", "0").otherwise(F.col("external_id")))


def read_audit(spark: SparkSession, path: str, name: str, event: str = "DECRYPT_SUCCESS", header: int = 0) -> DataFrame:
    """audit_filename, audit_checksum, audit_linecount, date_utc of audit events whose file name contains `name`. `data` is
    a struct or its JSON text, as the files have it; `header` lines aren't counted."""
    df = spark.read.json(path).where(F.col("filename").contains(name) & (F.col("event_type") == event))
    text = dict(df.dtypes).get("data") == "string"
    field = lambda k: F.get_json_object("data", f"$.{k}") if text else F.col(f"data.{k}")
    return df.select(
        F.col("filename").alias("audit_filename"),
        field("inDigest").alias("audit_checksum"),
        (field("linesRead").cast("int") - header).alias("audit_linecount"),
        F.to_date(F.timestamp_millis("timestamp_utc")).alias("date_utc"),
    )


def with_source_file(df: DataFrame, path: Column | None = None) -> DataFrame:
    return df.withColumn("source_file_name", file_stem(F.input_file_name() if path is None else path))


def append_partitioned(df: DataFrame, path: str, columns: list[str]) -> DataFrame:
    """Appends df by partition columns; counts per partition of the rows that were written.

    df is computed once: it is written to a hidden folder below path, the counts come from the footers of those files, and
    the files then move to their partitions. A write that fails before that leaves nothing that readers see."""
    spark = df.sparkSession
    draft = f"{path}/_append-{uuid.uuid4().hex}"
    draft_path = spark._jvm.org.apache.hadoop.fs.Path(draft)
    fs = draft_path.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        df.repartition(*columns).write.partitionBy(*columns).parquet(draft)
        written = spark.read.schema(df.schema).parquet(draft)
        counts = written.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
        rows = counts.collect()  # a row for each partition written
        files = fs.listFiles(draft_path, True)
        while files.hasNext():
            source = files.next().getPath()
            if source.getName().startswith("part-"):
                target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{source.toString().split(f'/{draft_path.getName()}/', 1)[1]}")
                fs.mkdirs(target.getParent())
                if not fs.rename(source, target):
                    raise OSError(f"{source} could not be moved to {target}")
        return spark.createDataFrame(rows, counts.schema)
    finally:
        fs.delete(draft_path, True)


def overwrite_days(df: DataFrame, path: str, columns: list[str]) -> None:
    """Replaces the partitions that df has rows for, in one write."""
    df.repartition(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def publish_version(df: DataFrame, root: str, run_id: str) -> str:
    path = f"{root}/run={run_id}"
    df.write.mode("errorifexists").parquet(path)
    return path


def merge_pointers(old: DataFrame, new: DataFrame, key: str = "date", value: str = "folder") -> DataFrame:
    """The pointer table after a run: new folders replace old ones."""
    return old.select(key, F.col(value).alias("_old")).join(new.select(key, F.col(value).alias("_new")), key, "full").select(key, F.coalesce("_new", "_old").alias(value))


POINTERS = "date_utc string, load_folder string"


def read_pointers(spark: SparkSession, path: str) -> DataFrame:
    """(date_utc, load_folder) of the newest commit; no rows where nothing was published yet."""
    return commits.read(spark, path, POINTERS)[1]


def save_pointers(spark: SparkSession, path: str, new: DataFrame, base: int | None = None) -> int:
    """Merges new pointers into the commit log of path; the number of the commit. Runs that publish at once each get a
    commit of their own. With the number of the commit that a run started from, it fails (commits.Conflict) where another
    has moved one of its dates since then."""
    return commits.update(spark, path, POINTERS, "date_utc", lambda old: merge_pointers(old, new, "date_utc", "load_folder"), new, base)


def save_history(spark: SparkSession, root: str, name: str, today: DataFrame, key: str) -> int:
    """Upserts today's rows into a table of the commit log below root: rows with today's keys give way. Readers
    (commits.read_table) see the old table or the new one."""
    return commits.replace_table(spark, root, name, lambda old: today if old is None else upsert_history(old, today, key))


def resolve_version(spark: SparkSession, pointers: str, root: str, date: str) -> DataFrame:
    """The rows of a date in the version that the pointer table names for it. ValueError where it names none."""
    folder = read_pointers(spark, pointers).where(F.col("date_utc") == date).first()
    if folder is None:
        raise ValueError(f"no version of {date} in {pointers}")
    return spark.read.parquet(f"{root}/{folder['load_folder']}").where(F.col("date_utc").cast("string") == date)


def with_bucket(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.withColumn("bucket", bucket(F.col(key), n))


def write_buckets(df: DataFrame, path: str, key: str, n: int) -> None:
    with_bucket(df, key, n).repartition(n, "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)


def save_errors(df: DataFrame, path: str) -> None:
    """Error rows (step, metric, …) in a folder of each step and metric, which are replaced."""
    overwrite_days(df, path, ["step", "metric"])


def append_audit(df: DataFrame, path: str, columns: list[str]) -> None:
    df.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").partitionBy(*columns).json(path)


def save_report(df: DataFrame, path: str, order: str) -> None:
    df.orderBy(order).drop(order).write.mode("overwrite").option("header", "true").csv(path)


def export_training(df: DataFrame, path: str, by: str, order: list[str]) -> None:
    df.repartition(by).sortWithinPartitions(by, *order).write.mode("overwrite").option("header", "true").partitionBy(by).csv(path)
