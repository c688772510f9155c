"""The library's tables as views over the test tables, in Spark and in SQL with the same meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ZONES = ("US/Eastern", "US/Central", "US/Mountain", "US/Pacific")

READS_SQL = """reads as (
  select 'c' || user_id as channel_uuid, case when user_id % 10 = 0 then 'R' else 'D' end as direction,
    time_bucket(interval 15 minute, ts) as interval_start_utc, value as consumption,
    case event_type when 'click' then 1 when 'purchase' then 2 when 'signup' then 3 when 'error' then 0 end as consumption_code,
    case user_id % 4 when 0 then 'US/Eastern' when 1 then 'US/Central' when 2 then 'US/Mountain' else 'US/Pacific' end as time_zone,
    event_id, 900 as seconds_per_interval, 'KWH' as consumption_unit
  from events)"""
QUARTERS_SQL = READS_SQL + """, quarters as (
  select * replace (date_trunc('hour', interval_start_utc) + to_minutes(cast(15 * q as integer)) as interval_start_utc, consumption / 4 as consumption, 4 * event_id + q as event_id)
  from reads, (values (0), (1), (2), (3)) v(q) where q = 0 or cast(substr(channel_uuid, 2) as bigint) % 3 > 0)"""
WIDE_SQL = QUARTERS_SQL + """, newest as (
  select * from quarters qualify row_number() over (partition by channel_uuid, interval_start_utc order by event_id desc) = 1),
hours as (
  select channel_uuid, direction, time_zone, cast(interval_start_utc as date) as date_utc, hour(interval_start_utc) as hour_utc,
    sum(consumption) filter (consumption_code >= 1) as consumption_total, count(*) filter (consumption_code >= 1) * 900 = 3600 as is_complete
  from newest group by all)"""
LATEST_SQL = READS_SQL + """, latest as (
  select * from reads qualify row_number() over (partition by channel_uuid, interval_start_utc order by event_id desc) = 1)"""
EVERY_SQL = QUARTERS_SQL + """, whole as (
  select * replace (((cast(cast((interval_start_utc at time zone 'UTC') at time zone time_zone as date) as timestamp) at time zone time_zone) at time zone 'UTC') + to_minutes(cast(15 * q as integer)) as interval_start_utc, consumption / 96 as consumption)
  from (select *, cast((interval_start_utc at time zone 'UTC') at time zone time_zone as date) as day_local from reads where cast(substr(channel_uuid, 2) as bigint) % 10 = 4
    qualify row_number() over (partition by channel_uuid, day_local order by event_id desc) = 1), range(96) r(q)),
every as (
  select * from quarters where cast(substr(channel_uuid, 2) as bigint) % 10 <> 4
  union all by name select * exclude (day_local) from whole),
final as (select * from every qualify row_number() over (partition by channel_uuid, interval_start_utc order by event_id desc) = 1)"""
HOURLY_SQL = EVERY_SQL + """, h0 as (
  select channel_uuid, direction, cast(interval_start_utc as date) as date_utc, hour(interval_start_utc) as hour_utc, time_zone,
    min(seconds_per_interval) as min_seconds, max(seconds_per_interval) as max_seconds,
    count(*) filter (consumption_code = 1) as num_reads_actual, count(*) filter (consumption_code = 2) as num_reads_estimated,
    count(*) filter (consumption_code >= 3) as num_reads_other,
    count(*) filter (consumption_code is null or consumption_code <= 0) as num_reads_missing,
    sum(consumption) filter (consumption_code = 1) as consumption_actual,
    sum(consumption) filter (consumption_code = 2) as consumption_estimated,
    sum(consumption) filter (consumption_code >= 3) as consumption_other
  from final where consumption_unit = 'KWH' group by all),
hourly as (
  select *, num_reads_actual + num_reads_estimated + num_reads_other as num_reads_total,
    case when num_reads_actual + num_reads_estimated + num_reads_other > 0 then
      coalesce(consumption_actual, 0) + coalesce(consumption_estimated, 0) + coalesce(consumption_other, 0) end as consumption_total,
    coalesce((num_reads_actual + num_reads_estimated + num_reads_other) * max_seconds = 3600 and min_seconds = max_seconds, false) as is_complete
  from h0)"""
DAILY_SQL = HOURLY_SQL + """, daily as (
  select channel_uuid, direction, time_zone,
    cast(((cast(date_utc as timestamp) + to_hours(cast(hour_utc as integer))) at time zone 'UTC') at time zone time_zone as date) as date_local,
    sum(num_reads_actual) as num_reads_actual, sum(num_reads_missing) as num_reads_missing, sum(num_reads_total) as num_reads_total,
    sum(consumption_total) as consumption_total, 3600 * count(*) filter (is_complete) as complete_seconds,
    100.0 * 3600 * count(*) filter (is_complete) / 86400 as pct_complete
  from hourly group by all)"""
BILLS_SQL = """bills as (
  select o_orderkey as bill_id, o_custkey as account_id, cast(o_orderdate as date) as bill_start,
    cast(o_orderdate as date) + cast(15 + o_orderkey % 31 as integer) as bill_end, o_totalprice as consumption,
    case when o_orderkey % 4 = 0 then 'GAS' else 'ELECTRIC' end as fuel_type, cast(15 + o_orderkey % 31 as integer) as bill_days
  from orders),
billm as (
  select *, consumption / bill_days as bill_adc, bill_start + cast(floor(bill_days / 2) as integer) as bill_midpoint,
    month(bill_start + cast(floor(bill_days / 2) as integer)) as bill_month
  from bills)"""
LOCATIONS_SQL = """locations as (
  select c_custkey as location_id, c_custkey as account_id, n_regionkey as tenant_id, n_name as state
  from customer join nation on c_nationkey = n_nationkey)"""
FILES_SQL = """files as (select doc_id, source as file_name, n_chars as line_count, md5(text) as checksum from documents)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    zone = F.element_at(F.array(*map(F.lit, ZONES)), (F.col("user_id") % 4 + 1).cast("int"))
    code = F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "signup", 3).when(F.col("event_type") == "error", 0)
    return e.select(
        F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("channel_uuid"),
        F.when(F.col("user_id") % 10 == 0, "R").otherwise("D").alias("direction"),
        F.timestamp_seconds(F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 900) * 900).alias("interval_start_utc"),
        F.col("value").alias("consumption"),
        code.alias("consumption_code"),
        zone.alias("time_zone"),
        "event_id",
        F.lit(900).alias("seconds_per_interval"),
        F.lit("KWH").alias("consumption_unit"),
    )


def quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads spread over the four quarters of their hour; a third of the channels deliver the first quarter only, so
    that their hours stay incomplete."""
    q = F.when(F.substring("channel_uuid", 2, 20).cast("long") % 3 > 0, F.array(*map(F.lit, range(4)))).otherwise(F.array(F.lit(0)))
    rows = reads(spark, sf_dir).withColumn("q", F.explode(q))
    start = F.timestamp_seconds(F.unix_timestamp(F.date_trunc("hour", "interval_start_utc")) + 900 * F.col("q"))
    return rows.withColumns({"interval_start_utc": start, "consumption": F.col("consumption") / 4, "event_id": 4 * F.col("event_id") + F.col("q")}).drop("q")


def every_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """quarters, but a tenth of the channels deliver all 96 quarters of each local day that has a read (the day's last)."""
    whole = F.substring("channel_uuid", 2, 20).cast("long") % 10 == 4
    local = F.to_date(F.from_utc_timestamp("interval_start_utc", F.col("time_zone")))
    rows = reads(spark, sf_dir).where(whole).withColumn("day_local", local)
    last = rows.groupBy("channel_uuid", "day_local").agg(F.max_by(F.struct(*[c for c in rows.columns if c not in ("channel_uuid", "day_local")]), "event_id").alias("r"))
    midnight = F.unix_timestamp(F.to_utc_timestamp(F.col("day_local").cast("timestamp"), F.col("r.time_zone")))
    start = F.timestamp_seconds(midnight + 900 * F.col("q"))
    dense = last.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(95)))).select("channel_uuid", start.alias("interval_start_utc"), (F.col("r.consumption") / 96).alias("consumption"), *[f"r.{c}" for c in ("direction", "consumption_code", "time_zone", "event_id", "seconds_per_interval", "consumption_unit")])
    return quarters(spark, sf_dir).where(~whole).unionByName(dense)


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("bill_id"),
        F.col("o_custkey").alias("account_id"),
        F.to_date("o_orderdate").alias("bill_start"),
        F.date_add(F.to_date("o_orderdate"), (15 + F.col("o_orderkey") % 31).cast("int")).alias("bill_end"),
        F.col("o_totalprice").alias("consumption"),
        F.when(F.col("o_orderkey") % 4 == 0, "GAS").otherwise("ELECTRIC").alias("fuel_type"),
    )


def locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("location_id"), F.col("c_custkey").alias("account_id"), F.col("n_regionkey").alias("tenant_id"), F.col("n_name").alias("state"))


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("file_name"), F.col("n_chars").alias("line_count"), F.md5("text").alias("checksum"))
