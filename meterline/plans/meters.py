"""Queries over reads: normalising, de-duplication, roll-ups, windows. Each comes with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import dedup, normalize, quality, rollup, sample, windows
from ..sources import io
from .catalogue import query, with_sql
from .views import BILLS_SQL, DAILY_SQL, FILES_SQL, HOURLY_SQL, LATEST_SQL, READS_SQL, WIDE_SQL, bills, every_read, files, quarters, reads, table


def latest(spark: SparkSession, d: str) -> DataFrame:
    return dedup.latest_wins(reads(spark, d), ["channel_uuid", "interval_start_utc"], [F.col("event_id").desc()])


def hourly(spark: SparkSession, d: str) -> DataFrame:
    """Hours of the latest reads; a tenth of the channels have whole days, a third of the others no whole hour."""
    final = dedup.latest_wins(every_read(spark, d), ["channel_uuid", "interval_start_utc"], [F.col("event_id").desc()])
    return rollup.with_completeness(rollup.finalize_rollup(rollup.hourly_rollup(final)))


def daily(spark: SparkSession, d: str) -> DataFrame:
    return rollup.daily_rollup(hourly(spark, d))


r6 = lambda c: F.round(c, 6)


@query("S1_positional_csv", "select lpad(trim(cast(p_partkey as varchar)), 20, '0') as part_id, trim(p_name) as name, cast(p_size as integer) as size from part")
def s1(spark, d):
    raw = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("part_id"), F.col("p_name").alias("name"), F.col("p_size").cast("string").alias("size"))
    return io.typed(raw, io.PositionalCsv((("part_id", "string"), ("name", "string"), ("size", "int")), ids=("part_id",)))


@query("S3_null_safe_version", "select event_id, timestamp '1970-01-01 00:00:00' as updated_time_utc from events")
def s3(spark, d):
    return io.null_safe_version(table(spark, d, "events").select("event_id"))


@query("S7_source_file", "select page_id, case when length(url) > 0 then regexp_extract(regexp_extract(url, '[^/]*$'), '^(.[^.]*|)', 1) else 'UNKNOWN' end as source_file_name from pages")
def s7(spark, d):
    return io.with_source_file(table(spark, d, "pages"), F.col("url")).select("page_id", "source_file_name")


@query("S10_merge_pointers", "with o as (select distinct cast(o_orderdate as date) as date, 'run=1' as folder from orders where o_orderkey % 2 = 0), n as (select distinct cast(o_orderdate as date) as date, 'run=2' as folder from orders where o_orderkey % 3 = 0) select coalesce(o.date, n.date) as date, coalesce(n.folder, o.folder) as folder from o full join n on o.date = n.date")
def s10(spark, d):
    o = table(spark, d, "orders").withColumn("date", F.to_date("o_orderdate"))
    return io.merge_pointers(o.where("o_orderkey % 2 = 0").select("date", F.lit("run=1").alias("folder")).distinct(), o.where("o_orderkey % 3 = 0").select("date", F.lit("run=2").alias("folder")).distinct())


@query("S11_buckets")
def s11(spark, d):
    return io.with_bucket(reads(spark, d), "channel_uuid", 16).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("channel_uuid").alias("channels"))


@query("P1_rename_columns", "select c_custkey as account_id, trim(c_name) as name, trim(c_mktsegment) as segment from customer")
def p1(spark, d):
    return normalize.rename_columns(table(spark, d, "customer"), {"c_custkey": "account_id", "c_name": "name", "c_mktsegment": "segment"})


@query("P2_require_ids", "select doc_id from documents where length(trim(source)) > 0 and length(trim(lang)) > 0")
def p2(spark, d):
    return normalize.require_ids(table(spark, d, "documents"), ["source", "lang"]).select("doc_id")


@query("P3_pad_ids", "select cast(c_custkey as varchar) as raw_id, lpad(cast(c_custkey as varchar), 20, '0') as id from customer")
def p3(spark, d):
    return normalize.pad_ids(table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id")), ["id"]).select("raw_id", "id")


@query("P4_direction", with_sql(READS_SQL, " select channel_uuid, direction, count(*) as n from reads where direction in ('D', 'R') group by all"))
def p4(spark, d):
    long = reads(spark, d).withColumn("direction", F.when(F.col("direction") == "D", " delivered").otherwise("RECEIVED"))
    return normalize.normalize_direction(long).groupBy("channel_uuid", "direction").agg(F.count(F.lit(1)).alias("n"))


@query("P5_read_code", "select event_id, case event_type when 'click' then 1 when 'purchase' then 2 when 'signup' then 3 end as code from events")
def p5(spark, d):
    e = table(spark, d, "events")
    return e.select("event_id", normalize.read_code(F.when(F.col("event_type") == "click", " ACT ").when(F.col("event_type") == "purchase", "EST").when(F.col("event_type") == "signup", "PRO").otherwise("?")).alias("code"))


@query("P6_time_zone", "select user_id, count(*) as n, case user_id % 3 when 0 then 'US/Eastern' when 1 then 'US/Central' else 'US/Pacific' end as time_zone from events group by user_id")
def p6(spark, d):
    e = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return e.withColumn("time_zone", normalize.time_zone(F.when(F.col("user_id") % 3 == 0, "EST5EDT").when(F.col("user_id") % 3 == 1, "CST"), "US/Pacific"))


@query("P7_to_utc", with_sql(READS_SQL, " select event_id, (interval_start_utc at time zone 'Etc/GMT+5') at time zone 'UTC' as fixed_utc, (interval_start_utc at time zone time_zone) at time zone 'UTC' as zone_utc from reads"))
def p7(spark, d):
    ts = F.col("interval_start_utc")
    return reads(spark, d).select("event_id", normalize.UtcPolicy("fixed_offset").utc(ts).alias("fixed_utc"), normalize.UtcPolicy("column_tz").utc(ts).alias("zone_utc"))


@query("P8_interval_start", with_sql(READS_SQL, " select event_id, interval_start_utc - interval 900 second as start_utc, cast(day(interval_start_utc - interval 900 second) as integer) as day from reads"))
def p8(spark, d):
    df = reads(spark, d).select("event_id", normalize.interval_start(F.col("interval_start_utc"), F.col("seconds_per_interval")).alias("start_utc"))
    return normalize.with_day_parts(df, "start_utc").select("event_id", "start_utc", F.col("day").cast("int"))


@query("P9_updated_time", "select user_id, ts as name_ts, case when user_id % 5 = 0 then timestamp '2024-02-01 00:00:00' else (date_trunc('second', ts) at time zone 'US/Eastern') at time zone 'UTC' end as updated from events")
def p9(spark, d):
    e = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    name = F.when(F.col("user_id") % 5 == 0, "no_time").otherwise(F.concat(F.lit("meter_"), F.date_format("ts", "yyyyMMddHHmmss"), F.lit("_x")))
    out = normalize.updated_time(name, r"^meter_(\d{4})(\d\d)(\d\d)(\d\d)(\d\d)(\d\d)_.*$", "$1-$2-$3 $4:$5:$6", "US/Eastern", F.to_timestamp(F.lit("2024-02-01 00:00:00")))
    return e.select("user_id", F.col("ts").alias("name_ts"), out.alias("updated"))


@query("P10_cast_measures", "select event_id, case when event_id % 7 = 0 then null else value end as consumption from events")
def p10(spark, d):
    e = table(spark, d, "events").select("event_id", F.lit("900").alias("seconds_per_interval"), F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("consumption"), F.lit(" kwh").alias("consumption_unit"))
    return normalize.cast_measures(e).select("event_id", "consumption")


@query("P11_breakout", "select event_id, cast(ts as date) as utc_date, cast(hour(ts) as integer) as utc_hour from events")
def p11(spark, d):
    return normalize.breakout(table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "utc").select("event_id", "utc_date", F.col("utc_hour").cast("int"))


@query("P12_local_date", with_sql(READS_SQL, " select event_id, cast((interval_start_utc at time zone 'UTC') at time zone time_zone as date) as date_local from reads"))
def p12(spark, d):
    df = reads(spark, d).withColumns({"date": F.to_date("interval_start_utc"), "h": F.hour("interval_start_utc")})
    return df.select("event_id", normalize.local_date(normalize.hour_start(F.col("date"), F.col("h")), F.col("time_zone")).alias("date_local"))


@query("P13_history", "select event_id from events where cast(ts as date) < date '2024-01-20' and cast(ts as date) >= date '2024-01-20' - 10")
def p13(spark, d):
    return normalize.history(table(spark, d, "events"), "2024-01-20", 10, F.to_date("ts")).select("event_id")


@query("P14_shoulder_weekdays", "select o_orderkey from orders where month(o_orderdate) in (3,4,5,9,10,11) and dayofweek(o_orderdate) between 1 and 5")
def p14(spark, d):
    return normalize.shoulder_weekdays(table(spark, d, "orders"), "o_orderdate").select("o_orderkey")


@query("P15_split_labelled", "select case when toxic is not null then 'labelled' else 'unlabelled' end as part, count(*) as n from documents left join labels using (doc_id) where n_chars is not null or lang is not null group by 1")
def p15(spark, d):
    df = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    known, rest = normalize.split_labelled(df, "toxic", ["n_chars", "lang"])
    return known.select(F.lit("labelled").alias("part")).union(rest.select(F.lit("unlabelled").alias("part"))).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("P16_sentinel", "select doc_id, source from documents")
def p16(spark, d):
    return normalize.strip_sentinel(normalize.with_sentinel(table(spark, d, "documents").select("doc_id", "source"), ["source"]), ["source"])


@query("P17_uuid", "select c_custkey as n, regexp_replace(lower(lpad(printf('%x', 11), 16, '0') || lpad(printf('%x', c_custkey), 16, '0')), '(.{8})(.{4})(.{4})(.{4})(.{12})', '\\1-\\2-\\3-\\4-\\5') as uuid, 11 as prefix from customer")
def p17(spark, d):
    df = table(spark, d, "customer").select(C.uuid_from_parts(F.lit(11), F.col("c_custkey")).alias("uuid"))
    prefix, n = C.parts_from_uuid(F.col("uuid"))
    return df.select(n.alias("n"), "uuid", prefix.alias("prefix"))


@query("P18_event_tag", "select case user_id % 5 when 0 then 'EHER' when 1 then 'HBA' when 2 then 'CHALLENGE' when 3 then 'CHALLENGE' else 'OTHER' end as tag, event_type, count(*) as n from events group by all")
def p18(spark, d):
    tags = F.array(F.lit("2019 eHER mail "), F.lit("Winter-HBA/"), F.lit("Summer CHALLENGE "), F.lit("production_v2 "), F.lit("news "))
    tag = F.concat(F.get(tags, (F.col("user_id") % 5).cast("int")), "event_type")
    return table(spark, d, "events").groupBy(C.generalize_tag(tag).alias("tag"), "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("P19_keyword_flag", "select p_partkey, case when p_size < 20 then cast(regexp_matches(lower(p_type), 'steel|brass') as integer) end as flag from part")
def p19(spark, d):
    return table(spark, d, "part").select("p_partkey", C.keyword_flag(F.col("p_type"), ["steel", "brass"], F.col("p_size"), 20).alias("flag"))


@query("P20_profile_flag", "select o_orderkey, case when o_orderkey % 5 < 3 then case when o_orderstatus = 'F' then 1 else 0 end end as flag from orders")
def p20(spark, d):
    return table(spark, d, "orders").select("o_orderkey", C.profile_flag(F.col("o_orderstatus"), F.col("o_orderkey") % 5, "F", 3).alias("flag"))


@query("P21_json_path", "select event_id, json_extract_string(props, '$.k') as k from events")
def p21(spark, d):
    return table(spark, d, "events").select("event_id", C.json_path(F.col("props"), "$.k", "string").alias("k"))


@query("P22_explode_nested", "select vec_id, count(*) as n, round(sum(cast(x as double)), 3) + 0.0 as total from (select vec_id, unnest(embedding) as x from embeddings) group by vec_id")
def p22(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.array(F.struct(F.col("embedding").alias("xs"))).alias("blocks"))
    return normalize.explode_nested(e, "blocks", "xs", "x").groupBy("vec_id").agg(F.count(F.lit(1)).alias("n"), (F.round(F.sum(F.col("x").cast("double")), 3) + F.lit(0.0)).alias("total"))


@query("P23_name_part", "select page_id, array_to_string(list_slice(string_split(url, '/'), 2, 3), '/') as part from pages")
def p23(spark, d):
    return table(spark, d, "pages").select("page_id", C.name_part(F.col("url"), 2, 3, "/").alias("part"))


@query("P24_bill_metrics", with_sql(BILLS_SQL, " select bill_id, bill_days, round(bill_adc, 6) as bill_adc, bill_midpoint, cast(bill_month as integer) as bill_month from billm"))
def p24(spark, d):
    return normalize.bill_metrics(bills(spark, d)).select("bill_id", "bill_days", r6("bill_adc").alias("bill_adc"), "bill_midpoint", "bill_month")


@query("P25_bill_days", with_sql(BILLS_SQL, " select bill_date, count(*) as n from (select unnest(generate_series(cast(bill_start + 1 as timestamp), cast(bill_end as timestamp), interval 1 day))::date as bill_date from bills) group by bill_date"))
def p25(spark, d):
    return normalize.explode_bill_days(bills(spark, d)).groupBy("bill_date").agg(F.count(F.lit(1)).alias("n"))


@query("P26_zip5", "select c_custkey, substr(lpad(cast(c_custkey as varchar), 9, '0'), 1, 5) as zip from customer")
def p26(spark, d):
    return table(spark, d, "customer").select("c_custkey", C.zip5(F.lpad(F.col("c_custkey").cast("string"), 9, "0")).alias("zip"))


@query("D1_latest_wins", with_sql(LATEST_SQL, " select channel_uuid, interval_start_utc, event_id, consumption from latest"))
def d1(spark, d):
    return latest(spark, d).select("channel_uuid", "interval_start_utc", "event_id", "consumption")


@query("D2_distinct_ids", "select distinct o_custkey, o_orderstatus from orders")
def d2(spark, d):
    return dedup.distinct_ids(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


@query("D3_dedupe_keys", "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1")
def d3(spark, d):
    return dedup.dedupe_keys(table(spark, d, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("A1_A2_hourly_rollup", with_sql(HOURLY_SQL, " select channel_uuid, direction, date_utc, cast(hour_utc as integer) as hour_utc, time_zone, num_reads_actual, num_reads_estimated, num_reads_other, num_reads_missing, num_reads_total, round(consumption_total, 5) as consumption_total from hourly"))
def a1(spark, d):
    return hourly(spark, d).select("channel_uuid", "direction", "date_utc", "hour_utc", "time_zone", "num_reads_actual", "num_reads_estimated", "num_reads_other", "num_reads_missing", "num_reads_total", F.round("consumption_total", 5).alias("consumption_total"))


@query("A3_completeness", with_sql(HOURLY_SQL, " select channel_uuid, date_utc, count(*) filter (is_complete) as complete, count(*) as hours from hourly group by all"))
def a3(spark, d):
    return hourly(spark, d).groupBy("channel_uuid", "date_utc").agg(F.count_if("is_complete").alias("complete"), F.count(F.lit(1)).alias("hours"))


@query("A4_daily_rollup", with_sql(DAILY_SQL, " select channel_uuid, direction, time_zone, date_local, cast(num_reads_total as bigint) as num_reads_total, round(consumption_total, 5) as consumption_total, round(pct_complete, 6) as pct_complete from daily"))
def a4(spark, d):
    return daily(spark, d).select(*rollup.DAY_KEYS, "num_reads_total", F.round("consumption_total", 5).alias("consumption_total"), r6("pct_complete").alias("pct_complete"))


@query("A5_affected_local_days", with_sql(READS_SQL, ", span as (select time_zone, min(interval_start_utc) as lo, max(interval_start_utc) as hi from reads group by 1) select time_zone, unnest(generate_series(cast(cast((lo at time zone 'UTC') at time zone time_zone as date) as timestamp), cast(cast((hi at time zone 'UTC') at time zone time_zone as date) as timestamp), interval 1 day))::date as date_local from span"))
def a5(spark, d):
    return rollup.affected_local_days(reads(spark, d))


HOURS_SQL = ", ".join(f"round(sum(consumption_total) filter (is_complete and hour_utc = {h}), 3) as kwh_h{h:02d}" for h in range(24))


def newest(spark: SparkSession, d: str) -> DataFrame:
    return dedup.latest_wins(quarters(spark, d), ["channel_uuid", "interval_start_utc"], [F.col("event_id").desc()])


def wide_days(spark: SparkSession, d: str) -> DataFrame:
    return rollup.pivot_day(rollup.finalize_rollup(rollup.hourly_rollup(newest(spark, d))))


WIDE_DAYS_SQL = with_sql(WIDE_SQL, f" select channel_uuid, time_zone, date_utc, {HOURS_SQL}, cast(max(hour_utc) filter (is_complete) as integer) as latest_hour, round(100.0 * count(*) filter (is_complete) / 24, 6) as pct_complete from hours where direction = 'D' group by channel_uuid, time_zone, date_utc")


@query("A6_pivot_day", WIDE_DAYS_SQL)
def a6(spark, d):
    return wide_days(spark, d).select("channel_uuid", "time_zone", "date_utc", *[F.round(f"kwh_h{i:02d}", 3).alias(f"kwh_h{i:02d}") for i in range(24)], "latest_hour", r6("pct_complete").alias("pct_complete"))


DAYS_SQL = ", ".join(f"round(sum(consumption_total) filter (pct_complete >= 95 and day(date_local) = {x}), 5) as kwh_d{x:02d}" for x in range(1, 32))


@query("A7_pivot_month", with_sql(DAILY_SQL, f" select channel_uuid, time_zone, cast(date_trunc('month', date_local) as date) as month_start, {DAYS_SQL} from daily where direction = 'D' group by 1, 2, 3"))
def a7(spark, d):
    wide = rollup.pivot_month(daily(spark, d))
    return wide.select("channel_uuid", "time_zone", "month_start", *[F.round(f"kwh_d{i:02d}", 5).alias(f"kwh_d{i:02d}") for i in range(1, 32)])


@query("A8_touched_months", "select distinct cast(date_trunc('month', o_orderdate) as date) as month_start, last_day(cast(o_orderdate as date)) as month_end from orders")
def a8(spark, d):
    return rollup.touched_months(table(spark, d, "orders"), "o_orderdate")


@query("A9_summarize_raw", with_sql(READS_SQL, """ select channel_uuid, cast(interval_start_utc as date) as date_utc, count(*) filter (consumption_code = 1) as reads_actual,
    count(*) filter (consumption_code = 0) as reads_missing, count(*) filter (consumption_code is null) as reads_unknown, count(*) as reads_total,
    round(cast(coalesce(sum(cast(consumption as decimal(16,3))), 0) as double), 3) as kwh_total from reads group by all"""))
def a9(spark, d):
    out = rollup.summarize_raw(reads(spark, d).withColumn("date_utc", F.to_date("interval_start_utc")), ["channel_uuid", "date_utc"])
    return out.select("channel_uuid", "date_utc", "reads_actual", "reads_missing", "reads_unknown", "reads_total", F.round(F.col("kwh_total").cast("double"), 3).alias("kwh_total"))


@query("A10_summarize_by_account", "select o_custkey as account, count(*) filter (o_orderstatus = 'F') as reads_actual, count(*) as reads_total, round(cast(sum(cast(o_totalprice as decimal(16,3))) as double), 3) as kwh_total from orders where o_orderpriority <> '1-URGENT' group by 1")
def a10(spark, d):
    o = table(spark, d, "orders").where("o_orderpriority <> '1-URGENT'").select(F.col("o_custkey").alias("account"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(2).alias("code"), "o_totalprice")
    return rollup.summarize_raw(o, ["account"], "code", "o_totalprice").select("account", "reads_actual", "reads_total", F.round(F.col("kwh_total").cast("double"), 3).alias("kwh_total"))


@query("A11_error_distribution", "select string_agg(t || ':' || n, ',' order by t || ':' || n) as distribution from (select event_type as t, count(*) as n from events group by 1)")
def a11(spark, d):
    return rollup.error_distribution(table(spark, d, "events"), "event_type")


@query("A12_metric_counts", "select source, lang, grouping(source, lang) as level, count(*) as n from documents group by grouping sets ((source, lang), (source), (lang), ())")
def a12(spark, d):
    return rollup.metric_counts(table(spark, d, "documents"), "source", "lang")


@query("A13_audit_map", "with s as (select source, lang, sum(n_chars) as v from documents group by all) select source, string_agg(lang || '=' || cast(v as bigint), ',' order by lang) as metrics, cast(sum(v) as bigint) as row_count from s group by source")
def a13(spark, d):
    out = rollup.audit_map(table(spark, d, "documents"), "source", "lang", "n_chars")
    entries = F.transform(F.array_sort(F.map_entries("metrics")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return out.select("source", F.array_join(entries, ",").alias("metrics"), "row_count")


@query("A14_file_severity", "with f as (select source, 100.0 * count(*) filter (n_chars >= 200) / count(*) as p from documents group by 1) select source, round(p, 6) as pct_ok, case when p >= 100 then 'info' when p >= 95 then 'warning' else 'error' end as severity from f")
def a14(spark, d):
    return rollup.file_severity(table(spark, d, "documents"), "source", F.col("n_chars") >= 200).select("source", r6("pct_ok").alias("pct_ok"), "severity")


@query("A15_file_inventory", with_sql(FILES_SQL, ", e as (select distinct source as file_name from documents), g as (select file_name, count(*) as c, sum(line_count) as l from files where doc_id % 2 = 0 group by 1) select e.file_name, coalesce(c, 0) as file_count, cast(coalesce(l, 0) as bigint) as line_count from e left join g using (file_name)"))
def a15(spark, d):
    f = files(spark, d)
    return rollup.file_inventory(f.where("doc_id % 2 = 0"), f, "file_name", "line_count")


CHANNELS_SQL = ", channels as (select distinct 'c' || user_id as channel_uuid, user_id % 20 as location_id from events)"


def channels(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.concat(F.lit("c"), F.col("user_id").cast("string")).alias("channel_uuid"), (F.col("user_id") % 20).alias("location_id")).distinct()


@query("A16_has_data", with_sql(DAILY_SQL, CHANNELS_SQL + ", p as (select channel_uuid, sum(num_reads_actual) > 0 as has_ami from daily where date_local >= date '2024-01-10' and date_local < date '2024-01-12' group by 1) select location_id, coalesce(bool_or(has_ami), false) as has_ami from channels left join p using (channel_uuid) group by 1"))
def a16(spark, d):
    return rollup.has_data(normalize.history(daily(spark, d), "2024-01-12", 2, F.col("date_local")), channels(spark, d))


@query("A17_fill_rate", with_sql(DAILY_SQL, CHANNELS_SQL + ", p as (select channel_uuid, avg(pct_complete / 100) as f from daily group by 1) select location_id, round(avg(f), 9) as fill_rate from channels left join p using (channel_uuid) group by 1"))
def a17(spark, d):
    return rollup.fill_rate(daily(spark, d), channels(spark, d)).select("location_id", F.round("fill_rate", 9).alias("fill_rate"))


@query("A18_location_means", "select c_nationkey, round(avg(c_acctbal), 4) as c_acctbal from customer group by 1")
def a18(spark, d):
    return rollup.location_means(table(spark, d, "customer"), ["c_nationkey"], ["c_acctbal"]).select("c_nationkey", F.round("c_acctbal", 4).alias("c_acctbal"))


@query("A19_location_max", "select c_nationkey, c_mktsegment, max(c_acctbal) as c_acctbal from customer group by all")
def a19(spark, d):
    return rollup.location_max(table(spark, d, "customer"), ["c_nationkey", "c_mktsegment"], "c_acctbal")


@query("A20_event_counts", "select user_id, nullif(count(distinct event_id) filter (event_type = 'click'), 0) as click, nullif(count(distinct event_id) filter (event_type = 'error'), 0) as error from events where event_type in ('click', 'error') group by 1")
def a20(spark, d):
    return rollup.event_counts(table(spark, d, "events"), ["user_id"], "event_type", ["click", "error"], "event_id")


@query("A21_widen", "select o_custkey, coalesce(max(case when o_orderstatus = 'F' then 'yes' end), 'NA') as F, coalesce(max(case when o_orderstatus = 'O' then 'yes' end), 'NA') as O, coalesce(max(case when o_orderstatus = 'P' then 'yes' end), 'NA') as P from orders group by 1")
def a21(spark, d):
    o = table(spark, d, "orders").select("o_custkey", "o_orderstatus").distinct().withColumn("v", F.lit("yes"))
    return rollup.widen(o, "o_custkey", "o_orderstatus", ["F", "O", "P"], "v")


@query("A28_digest", with_sql(FILES_SQL, " select file_name, md5(string_agg(checksum, '' order by checksum)) as digest, count(*) as n from files group by 1"))
def a28(spark, d):
    return rollup.digest(files(spark, d), "checksum", ["file_name"])


@query("A29_label_counts", "select quality, toxic, count(*) as n from labels group by all")
def a29(spark, d):
    return rollup.label_counts(table(spark, d, "labels"), ["quality", "toxic"])


@query("W1_odometer", with_sql(READS_SQL, ", l as (select channel_uuid, interval_start_utc as ts, max(event_id) as reading from reads group by all), n as (select *, lead(reading) over w - reading as consumption, epoch(lead(ts) over w) - epoch(ts) as s from l window w as (partition by channel_uuid order by ts)) select channel_uuid, ts, consumption, cast(s as bigint) as interval_seconds from n where consumption is not null and s <= 86400"))
def w1(spark, d):
    odo = reads(spark, d).groupBy("channel_uuid", F.col("interval_start_utc").alias("ts")).agg(F.max("event_id").alias("reading"))
    return windows.odometer_to_interval(odo, ["channel_uuid"], "ts", "reading", 86400).select("channel_uuid", "ts", "consumption", "interval_seconds")


@query("W2_prior_days", "with t as (select distinct cast(ts as date) as d from events where user_id % 50 = 1), x as (select d from t union select d - 1 from t) select cast(ts as date) as date, count(*) as n from events where cast(ts as date) in (select d from x) group by 1")
def w2(spark, d):
    e = table(spark, d, "events").select("user_id", F.to_date("ts").alias("date"))
    return windows.with_prior_days(e, e.where("user_id % 50 = 1").select("date").distinct(), "date").groupBy("date").agg(F.count(F.lit(1)).alias("n"))


WEEK_SQL = LATEST_SQL + ", wk as (select *, cast(year(interval_start_utc) as integer) as year, cast(weekofyear(interval_start_utc) as integer) as week_of_year from latest), st as (select *, consumption - lag(consumption) over (partition by channel_uuid, year, week_of_year order by interval_start_utc) as jump from wk), starts as (select channel_uuid, year, week_of_year, interval_start_utc as box_start, consumption as start_consumption from st where jump > 20), pairs as (select r.channel_uuid, r.year, r.week_of_year, r.interval_start_utc, r.consumption, s.box_start, s.start_consumption, max(case when r.consumption / s.start_consumption - 1 < -0.2 then 1 else 0 end) over (partition by r.channel_uuid, r.year, r.week_of_year, s.box_start order by r.interval_start_utc rows unbounded preceding) as over_ from wk r join starts s on r.channel_uuid = s.channel_uuid and r.year = s.year and r.week_of_year = s.week_of_year and r.interval_start_utc >= s.box_start and r.interval_start_utc < s.box_start + interval 1 day), boxr as (select * from pairs where over_ = 0)"
BOX = windows.Boxes(start_jump={900: 20.0}, min_length={900: 1}, max_seconds=86400)


def week(spark: SparkSession, d: str) -> DataFrame:
    return windows.with_week(latest(spark, d))


@query("W3_box_starts", with_sql(WEEK_SQL, " select channel_uuid, week_of_year, box_start, start_consumption from starts"))
def w3(spark, d):
    return windows.box_starts(week(spark, d), BOX).select("channel_uuid", "week_of_year", "box_start", "start_consumption")


@query("J9_W4_box_rows", with_sql(WEEK_SQL, " select channel_uuid, box_start, interval_start_utc, consumption from boxr"))
def w4(spark, d):
    return windows.box_rows(week(spark, d), BOX).select("channel_uuid", "box_start", "interval_start_utc", "consumption")


STATS_SQL = WEEK_SQL + ", bx as (select channel_uuid, year, week_of_year, box_start, count(*) as n, epoch(max(interval_start_utc)) - epoch(box_start) as len, sum(consumption) as kwh from boxr group by channel_uuid, year, week_of_year, box_start having count(*) > 1), bs as (select channel_uuid, year, week_of_year, avg(len) / 900 as week_mean_duration, avg(kwh) as week_mean_consumption, count(*) as week_box_count from bx group by channel_uuid, year, week_of_year)"


@query("W5_box_stats", with_sql(STATS_SQL, " select channel_uuid, week_of_year, round(week_mean_duration, 6) as week_mean_duration, round(week_mean_consumption, 7) as week_mean_consumption, week_box_count from bs"))
def w5(spark, d):
    return windows.box_stats(week(spark, d), BOX).select("channel_uuid", "week_of_year", r6("week_mean_duration").alias("week_mean_duration"), F.round("week_mean_consumption", 7).alias("week_mean_consumption"), "week_box_count")


@query("W6_ev_features", with_sql(STATS_SQL, ", wkl as (select channel_uuid, year, week_of_year, max(consumption) as peak, min(interval_start_utc) as week_start from wk group by all) select channel_uuid, round(avg(week_box_count), 6) as mean_box_count, round(avg(peak), 6) as mean_peak, round(count(*) / 0.5 / (2026 - year(min(week_start))), 6) as heuristic_score from wkl join bs using (channel_uuid, year, week_of_year) group by 1"))
def w6(spark, d):
    w = week(spark, d)
    weekly = w.groupBy(*windows.WEEK).agg(F.kurtosis("consumption").alias("kurtosis"), F.skewness("consumption").alias("skewness"), F.max("consumption").alias("peak"), F.min("interval_start_utc").alias("week_start"))
    return windows.ev_features(weekly, windows.box_stats(w, BOX), 2026, BOX).select("channel_uuid", r6("mean_box_count").alias("mean_box_count"), r6("mean_peak").alias("mean_peak"), r6("heuristic_score").alias("heuristic_score"))


@query("W7_complete_channels", with_sql(READS_SQL, ", p as (select channel_uuid, count(distinct interval_start_utc) / ((epoch(max(interval_start_utc)) - epoch(min(interval_start_utc))) / 900 + 1) as s from reads group by 1) select channel_uuid, count(*) as n from reads where channel_uuid in (select channel_uuid from p where s > 0.02 and s <= 1) group by 1"))
def w7(spark, d):
    return windows.complete_channels(reads(spark, d), 0.02).groupBy("channel_uuid").agg(F.count(F.lit(1)).alias("n"))


@query("W8_complete_rollup", with_sql(DAILY_SQL, ", p as (select channel_uuid from daily group by 1 having sum(num_reads_actual) / nullif(sum(num_reads_total), 0) > 0.4 and max(date_local) - min(date_local) > 20) select channel_uuid, count(*) as n from daily where channel_uuid in (select channel_uuid from p) group by 1"))
def w8(spark, d):
    return windows.complete_rollup_channels(daily(spark, d), 0.4, 20).groupBy("channel_uuid").agg(F.count(F.lit(1)).alias("n"))


@query("W13_flag_multi", "select o_orderkey, count(*) over (partition by o_custkey, o_orderstatus) > 1 as is_multi from orders")
def w13(spark, d):
    return windows.flag_multi(table(spark, d, "orders"), ["o_custkey", "o_orderstatus"]).select("o_orderkey", "is_multi")


@query("L2_top_k", "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def l2(spark, d):
    return sample.top_k(table(spark, d, "orders"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 20).select("o_orderkey", "o_totalprice")


MOST_SLICE = 5


@query("L1_audit_slice", with_sql(HOURLY_SQL, f""", g as (select date_utc, hour_utc, channel_uuid from hourly where is_complete),
n as (select date_utc, hour_utc, count(distinct channel_uuid) as n, cast('0x' || substr(md5(date_utc || '|' || hour_utc || ':7'), 1, 13) as bigint) as h from g group by all),
s as (select date_utc, hour_utc from n order by n > {MOST_SLICE} desc, case when n > {MOST_SLICE} then h end, n desc, date_utc, hour_utc limit 1)
select g.date_utc, cast(g.hour_utc as integer) as hour_utc, channel_uuid from (select distinct * from g) g join s using (date_utc, hour_utc)
order by cast('0x' || substr(md5(channel_uuid || ':7'), 1, 13) as bigint), channel_uuid limit {MOST_SLICE}"""))
def l1(spark, d):
    return sample.pick_audit_slice(hourly(spark, d), ["date_utc", "hour_utc"], "channel_uuid", F.col("is_complete"), MOST_SLICE)


@query("L1_fullest_slice", with_sql(HOURLY_SQL, ", g as (select date_utc, hour_utc, channel_uuid from hourly where is_complete), s as (select date_utc, hour_utc from g group by all order by count(distinct channel_uuid) desc, date_utc, hour_utc limit 1) select distinct g.date_utc, cast(g.hour_utc as integer) as hour_utc, channel_uuid from g join s using (date_utc, hour_utc) order by channel_uuid limit 1000"))
def l1_fullest(spark, d):
    return sample.pick_audit_slice(hourly(spark, d), ["date_utc", "hour_utc"], "channel_uuid", F.col("is_complete"), 1000, pick_fullest=True)


@query("Q10_check_rollup", with_sql(WIDE_SQL, ", w as (select channel_uuid, cast(substr(channel_uuid, 2) as bigint) as k from hours where is_complete and direction = 'D') select case when k % 7 = 0 or k % 11 = 0 then 0 else 1 end as qc_status, count(*) as n from w group by 1"))
def q10(spark, d):
    """Raw sums are half a kWh off for some channels and absent for others; those hours have to fail."""
    k = F.substring("channel_uuid", 2, 20).cast("long")
    raw = newest(spark, d).where("consumption_code >= 1 and direction = 'D'").groupBy("channel_uuid", F.to_date("interval_start_utc").alias("date_utc"), F.hour("interval_start_utc").alias("hour_utc")).agg(F.sum("consumption").alias("raw_kwh"))
    raw = raw.withColumn("raw_kwh", F.col("raw_kwh") + F.when(k % 7 == 0, 0.5).otherwise(0.0)).where(k % 11 != 0)
    return quality.check_rollup(raw, wide_days(spark, d), ["channel_uuid", "date_utc"]).groupBy("qc_status").agg(F.count(F.lit(1)).alias("n"))


@query("Q11_ingest_time", "select o_orderkey, cast(86400 * (o_orderkey % 3) as bigint) as ingest_seconds, case when 86400 * (o_orderkey % 3) <= 86400 then 1 else 0 end as qc_status from orders")
def q11(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("s"))
    o = o.withColumn("e", F.timestamp_seconds(F.unix_timestamp("s") + 86400 * (F.col("o_orderkey") % 3)))
    return quality.check_ingest_time(o, "s", "e").select("o_orderkey", "ingest_seconds", "qc_status")


@query("flagship_wide_day", WIDE_DAYS_SQL)
def flagship(spark, d):
    """Latest reads, rolled up to hours, as one row per channel and day."""
    return a6(spark, d)
