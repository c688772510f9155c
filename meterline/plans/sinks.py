"""Queries that write with a sink and read back what it wrote."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import band, pad_id
from ..operators import linking, ml, normalize, quality, scores
from ..sources import commits, io
from ..sources.staging import scratch
from .catalogue import query
from .models import CUSTOMERS_SQL, FEATURES, customers
from .views import reads, table

@query("S2_lines", "select conv_id, count(*) as n_lines from (select conv_id, unnest(string_split(coalesce(text, ''), chr(10))) as line from conversations) group by conv_id")
def s2(spark, d):
    """Turns written as lines of text (each with its conversation) and read again."""
    path = scratch(spark)
    line = F.explode(F.split(F.coalesce("text", F.lit("")), "\n"))
    table(spark, d, "conversations").select("conv_id", line.alias("line")).select(F.concat_ws("\t", F.col("conv_id").cast("string"), F.regexp_replace("line", "\r", "")).alias("value")).write.text(path)
    return io.read_lines(spark, path).groupBy(F.split("value", "\t")[0].cast("long").alias("conv_id")).agg(F.count(F.lit(1)).alias("n_lines"))


@query("S3_read_reads", "select event_id, case when event_id % 2 = 0 then timestamp '2024-01-01 00:00:00' + to_seconds(event_id) else timestamp '1970-01-01 00:00:00' end as updated_time_utc from events")
def s3(spark, d):
    """Two versions of reads, the older without the column."""
    path = scratch(spark)
    e = table(spark, d, "events")
    e.where("event_id % 2 = 1").select("event_id").write.parquet(f"{path}/old")
    e.where("event_id % 2 = 0").select("event_id", F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01").cast("timestamp")) + F.col("event_id")).alias("updated_time_utc")).write.parquet(f"{path}/new")
    return io.read_reads(spark, f"{path}/old", f"{path}/new").select("event_id", "updated_time_utc")


@query("S4_scan_days", "select o_orderkey from orders where cast(o_orderdate as date) between date '1995-02-27' - 1 and date '1995-03-02' + 1")
def s4(spark, d):
    path = scratch(spark)
    normalize.with_day_parts(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate").repartition("year", "month").write.partitionBy("year", "month").parquet(path)
    return io.scan_days(spark, path, "1995-02-27", "1995-03-02", 1).select("o_orderkey")


@query("S5_read_audit", """select 'drop_' || user_id || '.csv' as audit_filename, md5(cast(event_id as varchar)) as audit_checksum, cast(event_id - 1 as integer) as audit_linecount, cast(ts as date) as date_utc from events where event_type = 'click'""")
def s5(spark, d):
    """Audit events as files of JSON, `data` as text for half of them and as a struct for the other."""
    e = table(spark, d, "events")
    data = F.struct(F.md5(F.col("event_id").cast("string")).alias("inDigest"), F.col("event_id").alias("linesRead"))
    kind = F.when(F.col("event_type") == "click", "DECRYPT_SUCCESS").otherwise("DECRYPT_FAIL")
    rows = e.select(F.concat(F.lit("drop_"), F.col("user_id").cast("string"), F.lit(".csv")).alias("filename"), kind.alias("event_type"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp_utc"), data.alias("data"), "event_id")
    root = scratch(spark)
    rows.where("event_id % 2 = 0").drop("event_id").write.json(f"{root}/struct")
    rows.where("event_id % 2 = 1").drop("event_id").withColumn("data", F.to_json("data")).write.json(f"{root}/text")
    return io.read_audit(spark, f"{root}/struct", "drop_", header=1).union(io.read_audit(spark, f"{root}/text", "drop_", header=1))


@query("S6_channel_map", """select s_suppkey as channel_id, s_suppkey * 2 as account_id, s_nationkey as location_id, case when s_suppkey % 2 = 0 then 'D' else 'R' end as direction,
  cast(s_suppkey as varchar) as external_id, n_name as location, r_name as tenant
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def s6(spark, d):
    """Suppliers, nations and regions as tables of the database that comes with Spark, in the memory of this process (the
    driver and its tasks have to share it), joined there and read back in ranges of a few rows."""
    url = {"url": f"jdbc:derby:memory:m{uuid.uuid4().hex};create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    put = lambda df, name, types: df.coalesce(4).write.format("jdbc").options(**url, dbtable=name, createTableColumnTypes=types).save()
    s = table(spark, d, "supplier")
    put(s.select(F.col("s_suppkey").alias("channel_id"), (F.col("s_suppkey") * 2).alias("account_id"), F.col("s_nationkey").alias("location_id"), (1 + F.col("s_suppkey") % 2).alias("direction_code"), pad_id(F.col("s_suppkey").cast("string")).alias("external_id")), "channel", "external_id varchar(40)")
    put(table(spark, d, "nation").select(F.col("n_nationkey").alias("location_id"), F.col("n_regionkey").alias("tenant_id"), F.col("n_name").alias("name")), "location", "name varchar(80)")
    put(table(spark, d, "region").select(F.col("r_regionkey").alias("tenant_id"), F.col("r_name").alias("name")), "tenant", "name varchar(80)")
    return io.read_channel_map(spark, url, rows=20)


@query("S8_append_partitioned", "select cast(year(o_orderdate) as integer) as year, 2 * count(*) as n, count(*) as reported from orders group by 1")
def s8(spark, d):
    """Appended twice; beside what lies there the counts that the second write reports."""
    path = scratch(spark)
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    io.append_partitioned(o, path, ["year"])
    reported = io.append_partitioned(o, path, ["year"]).withColumnRenamed("n", "reported")
    return spark.read.parquet(path).groupBy(F.col("year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n")).join(reported, "year")


@query("S9_overwrite_days", "select cast(year(o_orderdate) as integer) as year, count(*) filter (year(o_orderdate) > 1995 or o_orderkey % 2 = 0) as n from orders group by 1")
def s9(spark, d):
    """The years to 1995 are written again with every other order; later years stay."""
    path = scratch(spark)
    o = table(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    io.overwrite_days(o, path, ["year"])
    io.overwrite_days(o.where("year <= 1995 and o_orderkey % 2 = 0"), path, ["year"])
    return spark.read.parquet(path).groupBy(F.col("year").cast("int").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("S10_publish_version", "select c_nationkey, count(*) as n from customer group by 1")
def s10(spark, d):
    return spark.read.parquet(io.publish_version(table(spark, d, "customer"), scratch(spark), "1f")).groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))


@query("S10_resolve_version", "select cast(cast(date_trunc('month', o_orderdate) as date) as varchar) as date_utc, case when o_orderdate >= timestamp '1995-06-01' then 2 else 1 end as version, count(*) as n from orders where cast(o_orderdate as date) between date '1995-05-01' and date '1995-07-31' group by all")
def s10_resolve(spark, d):
    """Two runs publish orders by month; the second's pointers take over from June on, and each is read in its version."""
    path = scratch(spark)
    o = table(spark, d, "orders").select(F.to_date(F.trunc("o_orderdate", "month")).alias("date_utc"), "o_orderkey")
    for run, part in (("01", o), ("02", o.where("date_utc >= date'1995-06-01'"))):
        io.publish_version(part.withColumn("version", F.lit(int(run))), path, run)
        io.save_pointers(spark, f"{path}/pointers", part.select(F.col("date_utc").cast("string").alias("date_utc"), F.lit(f"run={run}").alias("load_folder")).distinct())
    months = [io.resolve_version(spark, f"{path}/pointers", path, f"1995-0{x}-01") for x in (5, 6, 7)]
    return reduce(DataFrame.union, months).groupBy(F.col("date_utc").cast("string").alias("date_utc"), "version").agg(F.count(F.lit(1)).alias("n"))


@query("U4_save_history", "select cast(o_orderdate as date) as day, count(*) as n, case when cast(o_orderdate as date) = date '1995-06-02' then 2 else 1 end as run from orders where cast(o_orderdate as date) between date '1995-06-01' and date '1995-06-03' group by all")
def u4(spark, d):
    """A history of days that three runs upsert in turn, the last two of them the same day."""
    root = scratch(spark)
    o = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    for days, run in ((("1995-06-01", "1995-06-02"), 1), (("1995-06-03",), 1), (("1995-06-02",), 2)):
        io.save_history(spark, root, "orders_by_day", o.where(F.col("day").isin(*days)).withColumn("run", F.lit(run)), "day")
    return commits.read_table(spark, root, "orders_by_day")


@query("S12_save_errors", "select cast(1 + c_custkey % 7 as integer) as step, 1 as metric, count(*) as n from customer group by 1")
def s12(spark, d):
    path = scratch(spark)
    io.save_errors(table(spark, d, "customer").select((1 + F.col("c_custkey") % 7).cast("int").alias("step"), F.lit(1).alias("metric"), "c_name"), path)
    return spark.read.parquet(path).groupBy("step", "metric").agg(F.count(F.lit(1)).alias("n"))


@query("S13_append_audit", "select cast(year(o_orderdate) as integer) as year, max(o_orderdate) as last from orders group by 1")
def s13(spark, d):
    path = scratch(spark)
    o = table(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp").alias("at"), F.year("o_orderdate").alias("year"))
    io.append_audit(o, path, ["year"])
    back = spark.read.schema("at timestamp, year int").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss'Z'").json(path)
    return back.groupBy("year").agg(F.max("at").alias("last"))


@query("S14_save_report", "select cast(n_nationkey as varchar) as key, n_name as name from nation")
def s14(spark, d):
    path = scratch(spark)
    io.save_report(table(spark, d, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"), (-F.col("n_nationkey")).alias("ordering")), path, "ordering")
    return spark.read.option("header", True).csv(path)


@query("S15_export_training", "select cast(c_nationkey as integer) as location_id, count(*) as n from customer group by 1")
def s15(spark, d):
    path = scratch(spark)
    io.export_training(table(spark, d, "customer").select(F.col("c_nationkey").alias("location_id"), "c_custkey", "c_acctbal"), path, "location_id", ["c_custkey"])
    return spark.read.option("header", True).csv(path).groupBy(F.col("location_id").cast("int").alias("location_id")).agg(F.count(F.lit(1)).alias("n"))


@query("S11_write_buckets")
def s11(spark, d):
    path = scratch(spark)
    io.write_buckets(reads(spark, d).select("channel_uuid", "consumption"), path, "channel_uuid", 8)
    return spark.read.parquet(path).groupBy("bucket").agg(F.count_distinct("channel_uuid").alias("channels"))


@query("T7_demand_response", CUSTOMERS_SQL + ", b as (select case when n_orders > 12 then 'high' else 'low' end as propensity, count(*) as n from c group by 1) select propensity, n, round(n / sum(n) over (), 6) as share from b")
def t7(spark, d):
    """Participants (whom the orders tell) against the others, a forest, and its bands' shares."""
    c = customers(spark, d).drop("label")
    members = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n")).where("n > 12").select("c_custkey")
    df = linking.label_participants(c, members, "c_custkey")
    model = ml.safe_fit(ml.rf_pipeline("label", FEATURES, trees=20, depth=7, categories=2, featureSubsetStrategy="all", maxBins=128), df, "label")
    scored = ml.safe_score(model, df, "label", keep_labels=False)
    return scores.band_share(scored.withColumn("propensity", band(F.col("score"), scores.PROPENSITY_BANDS, "low")), "propensity").withColumn("share", F.round("share", 6))


@query("T8_baseload_filter", "select event_id from events where cast(ts as date) >= date '2024-01-15' - 7 and cast(ts as date) < date '2024-01-15'")
def t8(spark, d):
    e = normalize.with_day_parts(table(spark, d, "events"), "ts")
    return normalize.history(e, "2024-01-15", 7).select("event_id")


Q1_SQL = "with c(step, step_name, metric, metric_name, message, errors) as (values {}) select c.*, case when c.step = {} then (select count(*) from orders where o_orderkey % 3 = 2) end as n from c"


def sql_values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'" for v in row) + ")" for row in rows)


@query("Q1_catalogue", Q1_SQL.format(sql_values([(c.step, quality.STEPS[c.step], c.metric, c.name, c.message, c.errors) for c in quality.CHECKS]), quality.CHECKS[-1].step))
def q1(spark, d):
    """Checks that have rows to look at in the given table: errors of step 7 among its orders."""
    late = quality.check_ingest_time(table(spark, d, "orders").select(F.col("o_orderdate").cast("timestamp").alias("s"), F.timestamp_seconds(F.unix_timestamp("o_orderdate") + 86400 * (F.col("o_orderkey") % 3)).alias("e")), "s", "e")
    check = quality.CHECKS[-1]
    found = quality.error_rows(late, check).agg(F.count(F.lit(1)).alias("n")).withColumn("step", F.lit(check.step))
    return quality.catalogue(spark).join(F.broadcast(found), "step", "left")
