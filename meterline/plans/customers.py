"""Queries over accounts, bills, scores and files. Each comes with its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ..operators import linking, normalize, quality, records, rollup, sample, scores, windows
from .catalogue import query, with_sql
from .views import BILLS_SQL, FILES_SQL, LOCATIONS_SQL, bills, files, locations, table

r6 = lambda c: F.round(c, 6)

QUAD = ["external_account_id", "external_location_id", "direction"]
TREE_SQL = """ids as (select distinct 'a' || o_custkey as external_account_id, 'l' || (o_custkey + o_orderkey % 3) as external_location_id, case when o_orderkey % 5 = 0 then 'R' else 'D' end as direction from orders),
accounts as (select 'a' || (c_custkey - case when c_custkey % 9 = 8 then 1 else 0 end) as external_account_id, 'A' || c_custkey as account_uuid, c_custkey % 7 = 0 as is_inactive from customer),
locs as (select c_custkey as c, k, 'l' || (c_custkey + case when k = 2 then 1 else 0 end) as external_location_id, 'A' || c_custkey as account_uuid, 'L' || c_custkey || '-' || k as location_uuid
  from customer, (values (0), (1), (2)) v(k) where k = 0 or (k = 1 and c_custkey % 5 = 0) or (k = 2 and c_custkey % 2 = 0)),
chans as (select location_uuid, direction, 'C' || c || direction || k || i as channel_uuid from locs, (values ('D', 0), ('D', 1), ('R', 0)) v(direction, i)
  where (direction = 'D' and c % 4 <> 1 and (i = 0 or c % 6 = 0)) or (direction = 'R' and c % 8 = 0)),
j as (select i.*, a.account_uuid, a.is_inactive, l.location_uuid, c.channel_uuid from ids i left join accounts a using (external_account_id)
  left join locs l on i.external_location_id = l.external_location_id and a.account_uuid = l.account_uuid
  left join chans c on l.location_uuid = c.location_uuid and i.direction = c.direction),
n as (select external_account_id, external_location_id, direction, count(distinct account_uuid) as n_accounts, count(distinct location_uuid) as n_locations, count(distinct channel_uuid) as n_channels from j group by 1, 2, 3),
resolved as (select j.*, n_accounts, n_locations, n_channels from j join n using (external_account_id, external_location_id, direction)),
coded as (select *, case when n_accounts = 1 and n_locations = 1 and not coalesce(is_inactive, false) and n_channels = 1 then 'ok'
    when n_accounts = 1 and n_locations = 1 and not coalesce(is_inactive, false) and n_channels = 0 then 'incomplete' else 'error' end as status,
  case when n_accounts > 1 then 5241 when account_uuid is null then 4041 when is_inactive then 5141 when n_locations > 1 then 5242
    when location_uuid is null then 4042 when n_channels > 1 then 5243 when channel_uuid is null then 4043 else 5000 end as error_code from resolved)"""


def id_tables(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    name = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    ids = o.select(name("a", F.col("o_custkey")).alias("external_account_id"), name("l", F.col("o_custkey") + F.col("o_orderkey") % 3).alias("external_location_id"), F.when(F.col("o_orderkey") % 5 == 0, "R").otherwise("D").alias("direction")).distinct()
    key = F.col("c_custkey")
    accounts = c.select(name("a", key - F.when(key % 9 == 8, 1).otherwise(0)).alias("external_account_id"), name("A", key).alias("account_uuid"), (key % 7 == 0).alias("is_inactive"))
    # A location under its own id, a second one for some, and one under the next customer's id for others.
    kinds = F.filter(F.array(*map(F.lit, (0, 1, 2))), lambda k: (k == 0) | ((k == 1) & (key % 5 == 0)) | ((k == 2) & (key % 2 == 0)))
    rows = c.select(key.alias("c"), F.explode(kinds).alias("k")).select("c", "k", F.concat(name("L", F.col("c")), name("-", F.col("k"))).alias("location_uuid"))
    locs = rows.select(name("l", F.col("c") + F.when(F.col("k") == 2, 1).otherwise(0)).alias("external_location_id"), name("A", F.col("c")).alias("account_uuid"), "location_uuid")
    both = F.array(*[F.struct(F.lit(d).alias("direction"), F.lit(i).alias("i")) for d, i in (("D", 0), ("D", 1), ("R", 0))])
    chans = rows.select("*", F.inline(both)).where("(direction = 'D' and c % 4 <> 1 and (i = 0 or c % 6 = 0)) or (direction = 'R' and c % 8 = 0)")
    chans = chans.select("location_uuid", "direction", F.concat(name("C", F.col("c")), "direction", F.col("k").cast("string"), F.col("i").cast("string")).alias("channel_uuid"))
    return ids, accounts, locs, chans


def resolved(spark: SparkSession, d: str) -> DataFrame:
    return linking.resolve_channels(*id_tables(spark, d), QUAD)


@query("J1_resolve_channels", with_sql(TREE_SQL, " select external_account_id, external_location_id, direction, account_uuid, location_uuid, channel_uuid, n_accounts, n_locations, n_channels from resolved"))
def j1(spark, d):
    return resolved(spark, d).select(*QUAD, "account_uuid", "location_uuid", "channel_uuid", "n_accounts", "n_locations", "n_channels")


@query("J2_resolve_via_alias", with_sql(TREE_SQL, " select external_account_id as alias_id, external_location_id, direction, channel_uuid, n_channels from resolved"))
def j2(spark, d):
    ids, accounts, locs, chans = id_tables(spark, d)
    alias = F.concat(F.lit("hub-"), F.col("external_account_id"))
    aliases = ids.select(alias.alias("alias_id"), "external_account_id").distinct()
    out = linking.resolve_via_alias(ids.withColumn("external_account_id", alias), aliases, accounts, locs, chans, QUAD)
    return out.select(F.substring("alias_id", 5, 99).alias("alias_id"), "external_location_id", "direction", "channel_uuid", "n_channels")


@query("J3_resolve_by_account", "with t as (select 'a' || (c_custkey - case when c_custkey % 5 = 3 then 1 else 0 end) as external_account_id, 'L' || (c_custkey - c_custkey % 2) as location_uuid, 'C' || c_custkey as channel_uuid from customer where c_custkey % 10 > 0), p as (select external_account_id, count(distinct location_uuid) as nl, count(distinct channel_uuid) as nc, min(location_uuid) as l, min(channel_uuid) as c from t group by 1), i as (select distinct 'a' || o_custkey as external_account_id from orders) select i.external_account_id, case when nl = 1 and nc = 1 then c end as channel_uuid, coalesce(case when nl is not null then 'US/Central' end, 'US/Eastern') as time_zone from i left join p using (external_account_id)")
def j3(spark, d):
    k = F.col("c_custkey")
    name = lambda p, x: F.concat(F.lit(p), x.cast("string"))
    tree = table(spark, d, "customer").where("c_custkey % 10 > 0").select(name("a", k - F.when(k % 5 == 3, 1).otherwise(0)).alias("external_account_id"), name("A", k).alias("account_uuid"), name("L", k - k % 2).alias("location_uuid"), name("C", k).alias("channel_uuid"), F.lit("US/Central").alias("time_zone"))
    ids = table(spark, d, "orders").select(name("a", F.col("o_custkey")).alias("external_account_id"), F.lit("x").alias("time_zone")).distinct()
    return linking.resolve_by_account(ids, tree, "US/Eastern").select("external_account_id", "channel_uuid", "time_zone")


@query("J4_split_resolved", with_sql(TREE_SQL, " select status, count(*) as n from coded group by 1"))
def j4(spark, d):
    ok, incomplete, error = linking.split_resolved(resolved(spark, d))
    return ok.unionByName(incomplete).unionByName(error).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("J5_classify_errors", with_sql(TREE_SQL, " select error_code, count(*) as n from coded where status = 'error' group by 1"))
def j5(spark, d):
    return linking.classify_errors(linking.split_resolved(resolved(spark, d))[2]).groupBy("error_code").agg(F.count(F.lit(1)).alias("n"))


@query("J6_attach_channel", "select case when c_custkey is not null then 'matched' else 'unmatched' end as part, count(*) as n from events left join (select c_custkey from customer where c_custkey % 3 = 0) on user_id = c_custkey group by 1")
def j6(spark, d):
    m = table(spark, d, "customer").where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("channel_uuid"))
    ok, bad = linking.attach_channel(table(spark, d, "events"), m, ["user_id"])
    return ok.select(F.lit("matched").alias("part")).union(bad.select(F.lit("unmatched").alias("part"))).groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("J7_explain_unmatched", "select coalesce(e.code, 5000) as error_code, count(*) as n from events left join (select distinct user_id, case when user_id % 2 = 0 then 4041 else 4042 end as code from events where user_id % 5 = 0) e using (user_id) where user_id % 3 > 0 group by 1")
def j7(spark, d):
    e = table(spark, d, "events")
    errors = e.where("user_id % 5 = 0").select("user_id", F.when(F.col("user_id") % 2 == 0, 4041).otherwise(4042).alias("error_code"), F.lit("m").alias("error_message"))
    return linking.explain_unmatched(e.where("user_id % 3 > 0"), errors, ["user_id"]).groupBy("error_code").agg(F.count(F.lit(1)).alias("n"))


@query("J8_link_documents", "select s_suppkey, count(*) as n from lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey group by 1")
def j8(spark, d):
    linkage = table(spark, d, "supplier").select(F.col("s_suppkey").alias("meter_id"), F.col("s_nationkey").alias("linkage_id"))
    chans = table(spark, d, "nation").select(F.col("n_nationkey").alias("linkage_id"), "n_name")
    return linking.link_documents(table(spark, d, "lineitem"), linkage, chans, "l_suppkey").groupBy(F.col("meter_id").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("n"))


WEATHER_SQL = """weather as (select cast(day as date) as date_local, n_nationkey as postal, greatest(0.0, 10 * sin(datediff('day', date '1990-01-01', cast(day as date)) / 58.0) + n_nationkey % 5) as hdd,
  greatest(0.0, -10 * sin(datediff('day', date '1990-01-01', cast(day as date)) / 58.0) + n_nationkey % 3) as cdd
  from (select unnest(generate_series(timestamp '1991-01-01', timestamp '2001-12-31', interval 1 day)) as day), nation)"""


def weather(spark: SparkSession, d: str) -> DataFrame:
    days = spark.range(1).select(F.explode(F.expr("sequence(date'1991-01-01', date'2001-12-31')")).alias("date_local"))
    wave = 10 * F.sin(F.datediff("date_local", F.lit("1990-01-01").cast("date")) / 58.0)
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("postal_code"))
    return n.join(days).select("postal_code", "date_local", F.greatest(F.lit(0.0), wave + F.col("postal_code") % 5).alias("hdd"), F.greatest(F.lit(0.0), -wave + F.col("postal_code") % 3).alias("cdd"))


def bill_weather(spark: SparkSession, d: str) -> DataFrame:
    b = normalize.explode_bill_days(bills(spark, d)).withColumns({"channel_id": F.when(F.col("bill_id") % 2 == 0, F.col("bill_id")), "location_id": F.col("account_id")})
    loc = table(spark, d, "customer").select(F.col("c_custkey").alias("location_id"), F.col("c_custkey").alias("account_id"), F.col("c_nationkey").alias("postal_code"))
    return linking.join_bills_weather(b, loc, weather(spark, d))


BW_SQL = BILLS_SQL + ", " + WEATHER_SQL + """, bw as (select bill_id, account_id, bill_days, consumption, bill_start, avg(hdd) as mean_hdd, avg(cdd) as mean_cdd, count(*) as n_days
  from bills join customer on account_id = c_custkey join weather on postal = c_nationkey and date_local between bill_start + 1 and bill_end group by all)"""


@query("J10_A26_bills_weather", with_sql(BW_SQL, " select bill_id, round(mean_hdd, 6) as mean_hdd, round(mean_cdd, 6) as mean_cdd, n_days from bw"))
def j10(spark, d):
    return rollup.mean_degree_days(bill_weather(spark, d), ["bill_id"]).select("bill_id", r6("mean_hdd").alias("mean_hdd"), r6("mean_cdd").alias("mean_cdd"), "n_days")


@query("J11_participants", "select c_custkey, case when c_custkey in (select o_custkey from orders where o_orderstatus = 'P') then 1 else 0 end as label from customer")
def j11(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return linking.label_participants(table(spark, d, "customer").select("c_custkey"), o, "c_custkey")


@query("J12_widen_fuels", "with t as (select l_suppkey, l_returnflag as f, round(sum(l_quantity), 2) as q from lineitem group by all) select coalesce(a.l_suppkey, r.l_suppkey) as l_suppkey, a.q as a_q, r.q as r_q from (select * from t where f = 'A') a full join (select * from t where f = 'R') r on a.l_suppkey = r.l_suppkey")
def j12(spark, d):
    t = table(spark, d, "lineitem").groupBy("l_suppkey", "l_returnflag").agg(F.round(F.sum("l_quantity"), 2).alias("q"))
    return linking.widen_fuels(t, ["l_suppkey"], "l_returnflag", {"A": "a", "R": "r"}, ["q"])


@query("J13_assemble_features", "select c_custkey, n_name, count(o_orderkey) > 0 as has_orders from customer join nation on c_nationkey = n_nationkey left join orders on o_custkey = c_custkey group by 1, 2")
def j13(spark, d):
    base = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    names = base.join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    has = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.lit(True).alias("has")).distinct()
    return linking.assemble_features(base, "c_custkey", names, has).select("c_custkey", "n_name", F.coalesce("has", F.lit(False)).alias("has_orders"))


@query("J14_Q8_reconcile", "with a as (select cast(o_orderdate as date) as day, count(*) as left_n from orders group by 1), b as (select cast(l_shipdate as date) as day, count(*) as right_n from lineitem group by 1) select coalesce(a.day, b.day) as day, coalesce(left_n, 0) as left_n, coalesce(right_n, 0) as right_n, coalesce(left_n, 0) - coalesce(right_n, 0) as delta from a full join b on a.day = b.day")
def j14(spark, d):
    a = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("left_n"))
    b = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("right_n"))
    return linking.reconcile_counts(a, b, ["day"], "left_n", "right_n")


@query("J15_suppress", "select c_custkey, case when c_custkey % 5 = 0 or upper(c_name) like '%LOT%' or c_custkey % 7 = 0 then -1.0 else c_acctbal end as score from customer")
def j15(spark, d):
    c = table(spark, d, "customer").select("c_custkey", (F.col("c_custkey") % 5 == 0).alias("multi_family"), F.col("c_name").alias("address"), F.when(F.col("c_custkey") % 7 == 0, 1).alias("truth"), F.col("c_acctbal").alias("score"))
    return linking.suppress_scores(c).select("c_custkey", "score")


@query("A22_A23_seasons", with_sql(BILLS_SQL, ", m as (select account_id, bill_month, arg_min(bill_adc, bill_start) as adc from (select * from billm qualify row_number() over (partition by account_id, bill_month order by bill_start, bill_id) = 1) group by all), p as (select account_id, " + ", ".join(f"max(adc) filter (bill_month = {m}) as m{m}" for m in range(1, 13)) + " from m group by 1), s as (select account_id, m3 + m4 + m5 as a, m6 + m7 + m8 as b, m9 + m10 + m11 as c, m12 + m1 + m2 as e from p) select account_id, round(a, 4) as spring, round(greatest(a, b, c, e) / least(a, b, c, e), 6) as max_min_ratio from s"))
def a22(spark, d):
    b = normalize.bill_metrics(bills(spark, d)).withColumn("bill_start", F.struct("bill_start", "bill_id"))
    return rollup.season_ratio(rollup.pivot_months(b, ["account_id"])).select("account_id", F.round("spring", 4).alias("spring"), r6("max_min_ratio").alias("max_min_ratio"))


@query("A24_group_kurtosis", with_sql(BILLS_SQL + ", " + LOCATIONS_SQL, ", x as (select account_id, tenant_id, bill_adc from billm join locations using (account_id)), s as (select tenant_id, avg(bill_adc) as m, stddev_samp(bill_adc) as sd from x group by 1), z as (select account_id, (bill_adc - m) / sd as z from x join s using (tenant_id)), c as (select account_id, avg(z) as mz from z group by 1) select account_id, round(avg(pow(z - mz, 4)) / pow(avg(pow(z - mz, 2)), 2) - 3, 4) as kurtosis from z join c using (account_id) group by 1 having count(*) > 3"))
def a24(spark, d):
    x = normalize.bill_metrics(bills(spark, d)).join(locations(spark, d).select("account_id", "tenant_id"), "account_id")
    many = x.groupBy("account_id").count().where("count > 3").select("account_id")
    return rollup.group_kurtosis(x, "tenant_id", "account_id", "bill_adc").join(many, "account_id", "left_semi").select("account_id", F.round("kurtosis", 4).alias("kurtosis"))


@query("A25_weekly_stats", "with g as (select user_id, avg(value) as m from events group by 1) select user_id, round(avg(pow(value - m, 4)) / pow(avg(pow(value - m, 2)), 2) - 3, 4) as kurtosis, round(avg(pow(value - m, 3)) / pow(avg(pow(value - m, 2)), 1.5), 4) as skewness, max(value) as peak from events join g using (user_id) group by 1")
def a25(spark, d):
    out = rollup.weekly_stats(table(spark, d, "events"), ["user_id"], "value")
    return out.select("user_id", F.round("kurtosis", 4).alias("kurtosis"), F.round("skewness", 4).alias("skewness"), "peak")


@query("A27_ols2", "with m as (select l_suppkey as k, count(*) as n, regr_count(l_extendedprice, l_quantity) as c, avg(l_extendedprice) as my, avg(l_quantity) as m1, avg(l_discount) as m2 from lineitem group by 1 having count(*) >= 8), s as (select k, n, my, m1, m2, sum((l_quantity - m1) * (l_quantity - m1)) as s11, sum((l_discount - m2) * (l_discount - m2)) as s22, sum((l_quantity - m1) * (l_discount - m2)) as s12, sum((l_quantity - m1) * (l_extendedprice - my)) as s1y, sum((l_discount - m2) * (l_extendedprice - my)) as s2y, sum((l_extendedprice - my) * (l_extendedprice - my)) as syy from lineitem join m on l_suppkey = k group by all), b as (select *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) as b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) as b2 from s) select k as l_suppkey, n, round(b1, 3) as coef_1, round((b1 * s1y + b2 * s2y) / syy, 6) as rsquare from b")
def a27(spark, d):
    out = rollup.ols2(table(spark, d, "lineitem"), ["l_suppkey"], "l_extendedprice", "l_quantity", "l_discount")
    return out.select("l_suppkey", "n", F.round("coef_1", 3).alias("coef_1"), r6("rsquare").alias("rsquare"))


@query("A30_total_consumption", with_sql(BILLS_SQL, ", c as (select account_id, count(*) as n from bills group by 1 having count(*) >= 8) select account_id, n, round(sum(consumption), 2) as total_consumption from c join bills using (account_id) group by all"))
def a30(spark, d):
    b = bills(spark, d)
    c = b.groupBy("account_id").agg(F.count(F.lit(1)).alias("n")).where("n >= 8")
    return rollup.total_consumption(b, c, ["account_id"], "consumption").select("account_id", "n", F.round("total_consumption", 2).alias("total_consumption"))


@query("W9_top_channel", with_sql(BILLS_SQL, " select account_id, fuel_type, bill_id from bills qualify rank() over (partition by account_id, fuel_type order by consumption desc) = 1"))
def w9(spark, d):
    return windows.top_channel(bills(spark, d), ["account_id", "fuel_type"], "consumption").select("account_id", "fuel_type", "bill_id")


@query("W10_bucketize", "with t as (select c_custkey, c_nationkey, case when c_custkey % 9 > 0 then c_acctbal end as score, c_custkey % 11 = 0 as owner from customer), r as (select *, score is not null and not owner as ranked from t) select c_custkey, cast(case when owner then 0 when score is null then -1 else ceil(row_number() over (partition by c_nationkey, ranked order by score desc, c_custkey) * 5 / count(*) over (partition by c_nationkey, ranked)) end as integer) as bucket from r")
def w10(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 9 > 0, F.col("c_acctbal")).alias("score"), (F.col("c_custkey") % 11 == 0).alias("owner"))
    return windows.bucketize(c, "c_nationkey", "c_custkey", "score", "owner").select("c_custkey", "bucket")


ROC_SQL = "t as (select toxic as y, (n_chars % 97) / 97.0 as s from labels join documents using (doc_id)), p as (select s, count(*) filter (y = 1) as pos, count(*) filter (y <> 1) as neg from t group by 1), c as (select *, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over () as np, sum(neg) over () as nn from p window w as (order by s desc))"


def scored(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id").select(F.col("toxic").alias("y"), ((F.col("n_chars") % 97) / 97.0).alias("s"), "lang")


@query("W11_roc_curve", with_sql(ROC_SQL, " select round(s, 6) as s, cast(tp as bigint) as tp, cast(fp as bigint) as fp, round(tp / np, 9) as tpr, round(fp / nn, 9) as fpr from c"))
def w11(spark, d):
    return windows.roc_curve(scored(spark, d), "y", "s").select(r6("s").alias("s"), "tp", "fp", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"))


@query("W12_eval_metrics", with_sql(ROC_SQL, " select (select count(*) from t) as n, round((select avg(pow(s - y, 2)) from t), 6) as brier, round(sum(pos * (nn - fp + 0.5 * neg)) / max(np * nn), 6) as auc, round(coalesce(max(tp / np) filter (fp / nn <= 0.1), 0), 6) as tpr_at_fpr from c"))
def w12(spark, d):
    return windows.eval_metrics(scored(spark, d), "y", "s").select("n", r6("brier").alias("brier"), r6("auc").alias("auc"), r6("tpr_at_fpr").alias("tpr_at_fpr"))


@query("W14_assemble_records", "select conv_id, count(*) as n_lines, max(text) filter (turn = 0) as first_line from conversations group by 1")
def w14(spark, d):
    out = records.assemble_records(table(spark, d, "conversations"), "conv_id", "turn", "text")
    return out.select("conv_id", F.size("record").cast("long").alias("n_lines"), F.get("record", F.lit(0)).alias("first_line"))


def meter_records(spark: SparkSession, d: str) -> DataFrame:
    """One five-line record per order: some with channel 2, bad values, missing lines or too many readings."""
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    value = F.when(k % 11 == 0, "x").when(k % 13 == 0, "0-.5").otherwise((k % 9).cast("string"))
    data = F.concat(F.lit("10000000,"), value, F.lit(",a,b,1.5,a,b, ,a,b,2,a,b"), F.when(k % 17 == 0, "").otherwise(""))
    lines = F.array(
        F.concat(F.lit("00000001,sp"), k.cast("string"), F.when(k % 7 == 0, ",2,").otherwise(",1,"), day, F.lit("000000,"), day, F.when(k % 17 == 0, "003000,0,0").otherwise("010000,0,0")),
        F.concat(F.lit("00000002,0,0,0,0,0,0,900,0,0,0,0,0,US/Eastern")),
        F.concat(F.lit("00000003,acc"), (k % 5).cast("string"), F.lit(",Doe, J")),
        F.when(k % 19 == 0, "00000004,x").otherwise("00000004,0,A"),
        data,
    )
    return o.select(k.alias("id"), "o_orderdate", lines.alias("record"))


@query("R1_R2_parse_records", """with o as (select o_orderkey as k, case when o_orderkey % 19 = 0 then 'MALFORMED' when o_orderkey % 7 = 0 then 'CHANNEL' when o_orderkey % 11 = 0 then 'VALUE_ERROR' end as error_type from orders),
  r as (select k, error_type, unnest(case when error_type is not null then [cast(null as double)] when k % 17 = 0 then [case when k % 13 = 0 then 0.0 else k % 9 end, 1.5] else [case when k % 13 = 0 then 0.0 else k % 9 end, 1.5, null, 2.0] end) as v from o)
  select error_type, count(*) as n, count(v) as n_values, round(coalesce(sum(v), 0), 3) as total from r group by 1""")
def r1(spark, d):
    return records.parse_records(meter_records(spark, d)).groupBy("error_type").agg(F.count(F.lit(1)).alias("n"), F.count("consumption").alias("n_values"), F.round(F.coalesce(F.sum("consumption"), F.lit(0.0)), 3).alias("total"))


@query("L3_balance_classes", "with c as (select count(*) filter (toxic = 1) as p, count(*) filter (toxic = 0) as q from labels) select 0 as toxic, least(p, q) as n from c union all select 1, least(p, q) from c")
def l3(spark, d):
    return sample.balance_classes(table(spark, d, "labels"), "toxic", "doc_id").groupBy("toxic").agg(F.count(F.lit(1)).alias("n"))


@query("L4_fill_negatives", """with t as (select doc_id, lang, case when toxic = 1 then 1 when doc_id % 40 = 0 then 0 end as label from documents left join labels using (doc_id)),
  s as (select lang, count(*) filter (label = 1) as p, count(*) filter (label = 0) as q, count(*) filter (label is null) as u from t group by 1),
  f as (select lang, coalesce(label, case when cast('0x' || substr(md5(doc_id || ':7'), 1, 13) as bigint) / 4503599627370496.0 < greatest(p - q, 0) / nullif(u, 0) then 0 end) as label from t join s using (lang) where p > 0)
  select lang, label, count(*) as n from f where label is not null group by all""")
def l4(spark, d):
    df = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left").withColumn("label", F.when(F.col("toxic") == 1, 1).when(F.col("doc_id") % 40 == 0, 0))
    return sample.fill_negatives(df, "lang", "label", "doc_id").groupBy("lang", "label").agg(F.count(F.lit(1)).alias("n"))


@query("L5_sample_limit", "select c_custkey from customer order by md5(c_custkey || ':7'), c_custkey limit 100")
def l5(spark, d):
    return sample.sample_limit(table(spark, d, "customer").select("c_custkey"), "c_custkey", 100)


@query("L6_assign_folds", "select cast(cast('0x' || substr(md5(c_custkey || ':7'), 1, 13) as bigint) % 5 as integer) as fold, count(*) as n from customer group by 1")
def l6(spark, d):
    return sample.assign_folds(table(spark, d, "customer").select("c_custkey"), "c_custkey", 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


@query("U1_U3_union", "select key from (select c_nationkey as key from customer union select s_nationkey from supplier)")
def u1(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("key")).unionByName(table(spark, d, "supplier").select(F.col("s_nationkey").alias("key"))).distinct()


@query("U4_upsert_history", "select n_nationkey, n_name, case when n_nationkey % 3 = 0 then 'new' else 'old' end as v from nation")
def u4(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    return quality.upsert_history(n.withColumn("v", F.lit("old")), n.where("n_nationkey % 3 = 0").withColumn("v", F.lit("new")), "n_nationkey")


@query("C1_income_per_occupant", "select c_nationkey as tenant_id, c_custkey as location_id, round(case c_custkey % 4 when 0 then 7500 when 1 then 42500 else 500000 end / ((c_custkey % 3) + (c_custkey % 2)), 0) as income_per_occupant from customer where c_custkey % 3 > 0 and c_custkey % 4 < 3")
def c1(spark, d):
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("tenant_id"), k.alias("location_id"), (k % 3).alias("number_of_adults"), (k % 2).alias("number_of_children"), F.element_at(F.array(*map(F.lit, "ADLU")), (k % 4 + 1).cast("int")).alias("income_range"))
    return scores.income_per_occupant(c)


def demographics(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(
        k.alias("location_id"),
        (k % 6 - 1).alias("has_ev_bucket"),
        F.when(k % 10 > 0, k % 5).alias("green_aware"),
        (k % 4).alias("marital_model_1"),
        (k % 3).alias("total_children"),
        (k % 9).alias("length_residence"),
        (20 + k % 60).alias("age_1"),
        (800 + k % 1500).alias("home_sq_footage"),
        F.element_at(F.array(*map(F.lit, ("1M", "5M", "5S", "5U"))), (k % 4 + 1).cast("int")).alias("mrtl_model_1"),
        F.when(k % 7 > 0, 10 + k % 12 * 10).alias("income"),
        F.when(k % 8 > 0, F.element_at(F.array(*map(F.lit, (0, 11, 12, 13, 14, 15, 53))), (k % 7 + 1).cast("int"))).alias("education"),
    )


DEMO_SQL = "dem as (select c_custkey as location_id, c_custkey % 6 - 1 as ev, case when c_custkey % 10 > 0 then c_custkey % 5 end as green, c_custkey % 4 as marital, c_custkey % 3 as kids, c_custkey % 9 as res, 20 + c_custkey % 60 as age, 800 + c_custkey % 1500 as sqft, ['1M', '5M', '5S', '5U'][c_custkey % 4 + 1] as mrtl, case when c_custkey % 7 > 0 then 10 + c_custkey % 12 * 10 end as income, case when c_custkey % 8 > 0 then [0, 11, 12, 13, 14, 15, 53][c_custkey % 7 + 1] end as edu from customer)"
TOU_SQL = DEMO_SQL + ", tou as (select location_id, case when ev between 0 and 2 then 10 else 0 end + case when green in (2, 3) then 6 else 0 end + case when marital in (1, 2) then 5 else 0 end + case when kids = 0 then 5 else 0 end + case when res <= 5 then 4 else 0 end + case when age between 40 and 70 then 3 else 0 end + case when sqft between 1000 and 1800 then 2 else 0 end as score from dem), toub as (select *, case when score >= 18 then 'high' when score >= 10 then 'medium' else 'low' end as propensity from tou)"


@query("C2_weighted_score", with_sql(TOU_SQL, " select location_id, score, propensity from toub"))
def c2(spark, d):
    return scores.weighted_score(demographics(spark, d)).select("location_id", "score", "propensity")


@query("C3_marketplace", with_sql(DEMO_SQL, " select * from (select location_id, case when green = 1 and mrtl in ('1M', '5M') then 'high' when green in (1, 2) and mrtl in ('1M', '5M', '5S') then 'medium' when green in (3, 4) and mrtl in ('1M', '5M', '5S') then 'low' end as propensity from dem) where propensity is not null"))
def c3(spark, d):
    return scores.decision_table(demographics(spark, d), scores.MARKETPLACE).select("location_id", "propensity")


@query("C4_green_energy", with_sql(DEMO_SQL, " select * from (select location_id, case when income >= 40 and income < 85 and coalesce(edu, 0) in (0, 13, 14, 53, 54) and green in (1, 2) then 'high' when income >= 30 and income < 100 and coalesce(green, 0) in (0, 1, 2) and coalesce(edu, 0) in (0, 12, 13, 14, 52, 53, 54) then 'medium' when (income >= 100 or income < 30) and green in (3, 4) and coalesce(edu, 0) in (0, 11, 15, 51, 55) then 'low' end as propensity from dem) where propensity is not null"))
def c4(spark, d):
    return scores.decision_table(demographics(spark, d), scores.GREEN_ENERGY).select("location_id", "propensity")


def mail(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    kind = F.when(F.col("event_type") == "click", "CLICK").when(F.col("event_type") == "purchase", "OPEN").when(F.col("event_type") == "signup", "DELIVERED").when(F.col("event_type") == "error", F.when(F.col("event_id") % 50 == 0, "UNSUBSCRIBE").otherwise("DELIVERED")).otherwise("DELIVERED")
    tag = F.element_at(F.array(*map(F.lit, ("xEHERx", "my_hba", "Production", "news"))), (F.col("event_id") % 4 + 1).cast("int"))
    return e.select(F.col("user_id").alias("user_uuid"), tag.alias("event_tag"), kind.alias("event_type"), F.col("event_id").alias("external_event_id"))


ENGAGEMENT_SQL = """m as (select user_id as u, ['EHER', 'HBA', 'CHALLENGE', 'OTHER'][event_id % 4 + 1] as tag, case event_type when 'click' then 'C' when 'purchase' then 'O' when 'signup' then 'D' when 'error' then case when event_id % 50 = 0 then 'U' else 'D' end else 'D' end as k, event_id from events),
c as (select u, tag, count(*) filter (k = 'O') as o, count(*) filter (k = 'C') as c, count(*) filter (k = 'D') as d, count(*) filter (k = 'U') as un from m group by 1, 2),
g as (select u, tag, o, c, un from c union all select u, 'GLOBAL', sum(o), sum(c), 0 from c where un = 0 group by u union all select u, 'GLOBAL', 0, 0, 1 from (select u, sum(nullif(un, 0)) as x, count(nullif(d, 0)) as y from c group by u) where x = y),
l as (select u, tag, un, case when un > 0 then 'unsub' when o + 10 * c = 0 then 'never' when o + 10 * c <= case tag when 'GLOBAL' then 10 else 1 end then 'low' when o + 10 * c <= case tag when 'HBA' then 4 when 'GLOBAL' then 80 when 'CHALLENGE' then 19 when 'EHER' then 11 else 3 end then 'medium' else 'high' end as lev from g),
b as (select u, tag, lev from l qualify row_number() over (partition by u, tag order by un desc, lev desc) = 1)"""


@query("C5_engagement", with_sql(ENGAGEMENT_SQL, " select u as user_uuid, " + ", ".join(f"coalesce(max(lev) filter (tag = '{t}'), 'NA') as {t.lower()}_engagement_level" for t in ("CHALLENGE", "EHER", "GLOBAL", "HBA", "OTHER")) + " from b group by u"))
def c5(spark, d):
    return scores.engagement(mail(spark, d))


@query("C6_seasonal_class", "select c_custkey, case when s in ('NC', 'FL', 'OH', 'NY') then case when k < k2 and r > r2 then 2 when k < k1 and k >= k2 and r > r1 and r <= r2 then 1 else 0 end else 0 end as is_seasonal from (select c_custkey, s, -(c_custkey % 20) / 10.0 as k, (c_custkey % 80) / 10.0 as r, case s when 'NC' then -1.4 when 'FL' then -1.6 else -1.5 end as k2, case s when 'NC' then -1.1 when 'FL' then -1.1 else -1.2 end as k1, case s when 'NC' then 5.0 when 'FL' then 4.0 when 'OH' then 5.5 else 6.5 end as r2, case s when 'NC' then 3.5 when 'FL' then 3.0 when 'OH' then 4.0 else 4.5 end as r1 from (select c_custkey, ['NC', 'FL', 'OH', 'NY', 'TX'][c_custkey % 5 + 1] as s from customer))")
def c6(spark, d):
    k = F.col("c_custkey")
    c = table(spark, d, "customer").select("c_custkey", F.element_at(F.array(*map(F.lit, ("NC", "FL", "OH", "NY", "TX"))), (k % 5 + 1).cast("int")).alias("state"), (-(k % 20) / 10.0).alias("kurtosis"), ((k % 80) / 10.0).alias("max_min_ratio"))
    return scores.seasonal_class(c).select("c_custkey", "is_seasonal")


@query("C7_C8_band_share", with_sql(TOU_SQL, " select propensity, count(*) as n, round(count(*) / (select count(*) from toub), 9) as share from toub group by 1"))
def c8(spark, d):
    return scores.band_share(scores.weighted_score(demographics(spark, d)), "propensity").withColumn("share", F.round("share", 9))


@query("C9_confusion", "with t as (select toxic as y, case when n_chars % 2 = 0 then 1 else 0 end as p from labels join documents using (doc_id)), c as (select count(*) filter (y = 1 and p = 1) as tp, count(*) filter (y = 1 and p = 0) as fn, count(*) filter (y <> 1 and p = 1) as fp, count(*) filter (y <> 1 and p = 0) as tn from t) select *, round(tp / (tp + fn), 6) as sensitivity, round(tn / (tn + fp), 6) as specificity from c")
def c9(spark, d):
    df = table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id").withColumn("p", (F.col("n_chars") % 2 == 0).cast("int"))
    return scores.confusion(df, "toxic", "p").withColumns({c: F.round(c, 6) for c in ("sensitivity", "specificity")})


@query("C10_compare", "select o_orderkey, case when o_orderkey % 5 = 0 or o_orderkey % 7 = 0 then 0 else 1 end as qc_status from orders")
def c10(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("a"), F.when(F.col("o_orderkey") % 7 > 0, F.col("o_totalprice") + F.when(F.col("o_orderkey") % 5 == 0, 0.01).otherwise(0.0)).alias("b"))
    return quality.compare(o, "a", "b").select("o_orderkey", "qc_status")


PROFILE_SQL = "w as (select user_id, hour(ts) as h, dayofweek(ts) as dw, value from events)"


@query("C11_peak_profile", with_sql(PROFILE_SQL, ", s as (select user_id, sum(value) filter (h between 6 and 11) as m, sum(value) filter (h between 12 and 16) as a, sum(value) filter (h between 17 and 21) as e, sum(value) filter (h >= 22 or h <= 5) as n from w group by 1), z as (select user_id, coalesce(m, 0) as m, coalesce(a, 0) as a, coalesce(e, 0) as e, coalesce(n, 0) as n from s) select user_id, cast(m = greatest(m, a, e, n) as integer) as morning_peak, cast(n = greatest(m, a, e, n) as integer) as night_peak, round(m / (m + a + e), 6) as morning_percent_of_day, round(n / (m + a + e + n), 6) as night_percent_of_total from z"))
def c11(spark, d):
    e = table(spark, d, "events")
    wide = e.groupBy("user_id").agg(*[F.sum(F.when(F.hour("ts") == h, F.col("value"))).alias(f"hod_{h}") for h in range(24)])
    return scores.peak_profile(wide).select("user_id", "morning_peak", "night_peak", r6("morning_percent_of_day").alias("morning_percent_of_day"), r6("night_percent_of_total").alias("night_percent_of_total"))


@query("T1_raw_bill_fields", with_sql(BILLS_SQL, " select bill_id, 'x' || account_id as external_account_id, bill_days, round(consumption / bill_days, 6) as bill_adc from bills join customer on account_id = c_custkey"))
def t1(spark, d):
    acc = table(spark, d, "customer").select(F.col("c_custkey").alias("account_id"), F.concat(F.lit("x"), F.col("c_custkey").cast("string")).alias("external_account_id"))
    return scores.raw_bill_fields(bills(spark, d), acc).select("bill_id", "external_account_id", "bill_days", r6("bill_adc").alias("bill_adc"))


@query("T2_clean_bills", with_sql(BILLS_SQL, " select account_id, fuel_type, strftime(bill_midpoint, '%Y-%m') as bill_yearmonth, cast(sum(bill_days) as bigint) as bill_days, round(sum(consumption) / sum(bill_days), 4) as bill_adc from billm where consumption >= 0 and bill_days > 0 and bill_id % 9 > 0 group by 1, 2, 3"))
def t2(spark, d):
    b = normalize.bill_metrics(bills(spark, d)).withColumn("bill_yearmonth", F.date_format("bill_midpoint", "yyyy-MM"))
    b = b.withColumn("consumption", F.when(F.col("bill_id") % 9 == 0, -1.0).otherwise(F.col("consumption")))
    return scores.clean_bills(b).select("account_id", "fuel_type", "bill_yearmonth", "bill_days", F.round("bill_adc", 4).alias("bill_adc"))


@query("T3_match_metrics", with_sql(LOCATIONS_SQL, ", n as (select * from locations where location_id % 3 > 0), m as (select *, case when location_id % 2 = 0 then 'FULL' else 'UNIQUE' end as q from locations where location_id % 4 > 0), a as (select count(*) as c from locations), r as (select 'All locations' as metric_name, coalesce(cast(tenant_id as varchar), 'Total') as breakdown, count(*) as n, false as p from locations group by grouping sets ((tenant_id), ()) union all select 'Normalized locations', coalesce(cast(tenant_id as varchar), 'Total'), count(*), true from n group by grouping sets ((tenant_id), ()) union all select 'Matched locations', coalesce(cast(tenant_id as varchar), q, 'Total'), count(*), true from m group by grouping sets ((tenant_id), (q), ())) select metric_name, breakdown, n, case when p then round(100.0 * n / c, 2) end as pct from r, a"))
def t3(spark, d):
    loc = locations(spark, d)
    m = loc.where("location_id % 4 > 0").withColumn("match_quality", F.when(F.col("location_id") % 2 == 0, "FULL").otherwise("UNIQUE"))
    return scores.match_metrics(loc, loc.where("location_id % 3 > 0"), m)


@query("T4_weekday_profile", with_sql(PROFILE_SQL, " select user_id, round(avg(value) filter (h = 0), 4) as hod_0, round(avg(value) filter (h = 13), 4) as hod_13 from w where dw between 1 and 5 group by 1"))
def t4(spark, d):
    return scores.weekday_profile(table(spark, d, "events"), ["user_id"], "ts", "value").select("user_id", F.round("hod_0", 4).alias("hod_0"), F.round("hod_13", 4).alias("hod_13"))


@query("T5_disagg_bills", with_sql(BILLS_SQL, ", t as (select account_id, fuel_type, bill_start, consumption, cast(40 + account_id % 50 as double) as temp from bills qualify row_number() over (partition by account_id, fuel_type, bill_start order by bill_id) = 1 and count(*) over (partition by account_id, fuel_type, bill_start) = 1), w as (select *, count(*) over p as n, min(consumption) over p as base, max(bill_start) over p as last from t window p as (partition by account_id, fuel_type)) select account_id, fuel_type, round(consumption, 2) as total, round(case when temp >= 65 then 0 else consumption - base end, 2) as heating, round(case when temp >= 65 then consumption - base else 0 end, 2) as cooling from w where n >= 3 and bill_start = last"))
def t5(spark, d):
    b = bills(spark, d).withColumn("temp_f", (40 + F.col("account_id") % 50).cast("double"))
    alone = b.groupBy("account_id", "fuel_type", "bill_start").count().where("count = 1").drop("count")
    out = scores.disagg_bills(b.join(alone, ["account_id", "fuel_type", "bill_start"], "left_semi"))
    return out.select("account_id", "fuel_type", *[F.round(c, 2).alias(c) for c in ("total", "heating", "cooling")])


@query("T6_disagg_hourly", "with h as (select user_id as l, date_trunc('hour', ts) as t, sum(value) as k from events group by 1, 2), w as (select l, t, k, cast(20 + (epoch(t) / 3600) % 80 as double) as f from h where (epoch(t) / 3600) % 7 > 0), m as (select *, avg(k) filter (f between 50 and 80) over (partition by l, hour(t)) as mild from w) select l as location_id, count(*) as n_hours, round(avg(k), 7) as total, round(min(k), 7) as always_on, round(coalesce(sum(greatest(k - mild, 0)) filter (f < 50 and mild is not null), 0) / count(*), 7) as heating, round(coalesce(sum(greatest(k - mild, 0)) filter (f > 80 and mild is not null), 0) / count(*), 7) as cooling from m group by 1")
def t6(spark, d):
    e = table(spark, d, "events").select(F.col("user_id").alias("location_id"), F.date_trunc("hour", "ts").alias("ts"), F.col("value").alias("consumption"))
    hour = (F.unix_timestamp("ts") / 3600).cast("long")
    w = e.select("location_id", "ts").distinct().where(hour % 7 > 0).withColumn("temp_f", (20 + hour % 80).cast("double"))
    out = scores.disagg_hourly(e, w)
    return out.select("location_id", "n_hours", *[F.round(c, 7).alias(c) for c in ("total", "always_on", "heating", "cooling")])


@query("T9_select_events", "select (select count(*) from events where cast(ts as date) = date '2024-01-10' and user_id % 10 < 8) as n_events, (select count(*) from (select unnest(generate_series(0, 7)) as t) where t not in (select user_id % 10 from events where cast(ts as date) = date '2024-01-10')) as n_without")
def t9(spark, d):
    e = table(spark, d, "events").select((F.col("user_id") % 10).alias("tenant"), F.col("ts").alias("start_time_utc"))
    day, without = scores.select_events(e, spark.range(8).withColumnRenamed("id", "tenant"), "2024-01-10")
    return day.agg(F.count(F.lit(1)).alias("n_events")).join(F.broadcast(without.agg(F.count(F.lit(1)).alias("n_without"))))


@query("Q2_evaluate", "select 1 as step, 2 as metric, case when a = b then 1 else 0 end as status, a - b as delta from (select sum(n_chars)::bigint as a, (select sum(n_chars)::bigint from documents where doc_id % 100 > 0) as b from documents)")
def q2(spark, d):
    t = table(spark, d, "documents")
    total = lambda df: df.agg(F.sum("n_chars").alias("value"))
    return quality.evaluate(total(t), total(t.where("doc_id % 100 > 0")), quality.CHECKS[1]).select("step", "metric", "status", "delta")


MANIFEST_SQL = FILES_SQL + ", m as (select cast(doc_id as varchar) as f, line_count as l, checksum as c from files), a as (select f, case when cast(f as bigint) % 5 = 0 then l - 1 else l end as l, case when cast(f as bigint) % 11 = 0 then null else c end as c from m where cast(f as bigint) % 7 > 0)"


@query("Q3_reconcile_manifest", with_sql(MANIFEST_SQL, " select m.f as file_name, case when a.f is null then 1 else 0 end as file_mismatch, case when a.l = m.l then 0 else 1 end as linecount_mismatch, case when a.c = m.c then 0 else 1 end as checksum_mismatch from m left join a using (f)"))
def q3(spark, d):
    m = files(spark, d).select(F.col("doc_id").cast("string").alias("file_name"), "line_count", "checksum")
    k = F.col("file_name").cast("long")
    a = m.where(k % 7 > 0).select("file_name", F.when(k % 5 == 0, F.col("line_count") - 1).otherwise(F.col("line_count")).alias("line_count"), F.when(k % 11 > 0, F.col("checksum")).alias("checksum"))
    return quality.reconcile_manifest(m, a).select("file_name", "file_mismatch", "linecount_mismatch", "checksum_mismatch")


@query("Q4_reconcile_files", "select doc_id as file_name, case when doc_id % 3 = 0 then 1 else 0 end as no_decrypt, case when doc_id % 4 = 0 then 1 else 0 end as no_audit from documents")
def q4(spark, d):
    f = table(spark, d, "documents").select(F.col("doc_id").alias("file_name"))
    return quality.reconcile_files(f, f.where("file_name % 3 > 0"), f.where("file_name % 4 > 0"))


@query("Q5_latest_audit", "select event_id from events where event_type = 'click' and cast(ts as date) = (select max(cast(ts as date)) from events)")
def q5(spark, d):
    e = table(spark, d, "events").select("event_id", F.to_date("ts").alias("ingest_date"), F.col("event_type").alias("status"))
    return quality.latest_audit(e, "click").select("event_id")


@query("Q6_reconcile_channels", "select c_custkey, case when c_custkey % 2 = 0 then 1 else 0 end as success, case when c_custkey % 5 = 0 then 1 else 0 end as error, case when c_custkey % 2 > 0 and c_custkey % 5 > 0 then 1 else 0 end as no_output, case when c_custkey % 2 = 0 and c_custkey % 3 = 0 then 1 else 0 end as uuid_match, false as is_multi from customer")
def q6(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    ok = c.where("c_custkey % 2 = 0").withColumn("channel_uuid", F.concat(F.lit("u"), F.col("c_custkey").cast("string")))
    known = c.withColumn("channel_uuid", F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("u"), F.col("c_custkey").cast("string"))).otherwise("other"))
    return quality.reconcile_channels(c, ok, c.where("c_custkey % 5 = 0"), known, ["c_custkey"]).select("c_custkey", "success", "error", "no_output", "uuid_match", "is_multi")


@query("Q7_reconcile_reads", "select user_id, count(*) as raw_count, count(*) filter (event_id % 3 > 0) as success_count, count(*) filter (event_id % 6 = 0) as error_count, count(*) = count(*) filter (event_id % 3 > 0) + count(*) filter (event_id % 6 = 0) as is_match from events group by 1")
def q7(spark, d):
    e = table(spark, d, "events")
    return quality.reconcile_reads(e, e.where("event_id % 3 > 0"), e.where("event_id % 6 = 0"), ["user_id"]).select("user_id", "raw_count", "success_count", "error_count", "is_match")


PART = StructType([StructField("p_partkey", StringType(), False, {"maxlength": 3}), StructField("p_size", IntegerType()), StructField("p_brand", IntegerType())])


@query("Q9_U2_conform", "select cast(p_partkey as varchar) as p_partkey, cast(p_size as integer) as p_size, cast(null as integer) as p_brand from part")
def q9(spark, d):
    return quality.conform(table(spark, d, "part"), PART)


@query("Q9_violations", "select 'p_partkey' as column_name, count(*) filter (length(cast(p_partkey as varchar)) > 3) as n from part union all select 'p_size', 0 union all select 'p_brand', 0")
def q9v(spark, d):
    return quality.violations(quality.conform(table(spark, d, "part"), PART), PART)


@query("Q12_profile_extract", "select count(*) filter (event_type <> 'error') as reads, count(*) filter (event_type = 'error') as errors, cast(min(ts) filter (event_type <> 'error') as date) as min_date, cast(max(ts) filter (event_type <> 'error') as date) as max_date, round(sum(value) filter (event_type <> 'error'), 2) as total from events")
def q12(spark, d):
    e = table(spark, d, "events").withColumn("error", F.when(F.col("event_type") == "error", "x"))
    return quality.profile_extract(e, "ts", "value", "error").withColumn("total", F.round("total", 2))


def qc_rows(spark: SparkSession, d: str) -> DataFrame:
    """Each check evaluated on the orders of a weekday: rows that match against rows that should."""
    o = table(spark, d, "orders").withColumn("step", (F.col("o_orderkey") % 7 + 1).cast("int"))
    per = o.groupBy("step").agg(F.count(F.lit(1)).alias("a"), F.count_if(F.col("o_orderkey") % 200 > 3).alias("b"))
    return per.select("step", F.lit(1).alias("metric"), F.lit("rows").alias("name"), F.col("a").cast("string").alias("left_value"), F.col("b").cast("string").alias("right_value"), (F.col("a") == F.col("b")).cast("int").alias("status"))


def qc(spark: SparkSession, d: str) -> DataFrame:
    return quality.qc_report(quality.as_metrics_json(qc_rows(spark, d)).withColumn("execution_date", F.lit("2024-01-31")))


QC_SQL = "s as (select cast(o_orderkey % 7 + 1 as integer) as step, count(*) as a, count(*) filter (o_orderkey % 200 > 3) as b from orders group by 1), q as (select '2024-01-31' as execution_date, step, step * 100 + 1 as ordering, case when step <= 4 then 'completeness' when step <= 6 then 'accuracy' else 'currency' end as service_class, 'rows' as name, case when a = b then 1 else 0 end as status, cast(a as varchar) as left_value, cast(b as varchar) as right_value from s)"


@query("Q13_qc_report", with_sql(QC_SQL, " select * from q"))
def q13(spark, d):
    return qc(spark, d)


@query("Q14_sla_report", with_sql(QC_SQL, " select execution_date, ordering, service_class, name, status, left_value, right_value from q union all select '2024-01-31', 999, 'completeness', 'uningestable reads', 1, '7', '0'"))
def q14(spark, d):
    return quality.sla_report(qc(spark, d), 7, "2024-01-31")


@query("Q15_sanity_checks", "with c as (select cast(ts as date) as day, count(*) as raw, count(*) filter (event_id % 10 > 0) as ing, count(*) filter (event_id % 10 = 0) as un, count(distinct user_id % 20) as f from events group by 1) select day, f >= 15 as files_ok, raw = ing + un as reads_ok from c")
def q15(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    counts = e.groupBy("day").agg(F.count(F.lit(1)).alias("raw"), F.count_if(F.col("event_id") % 10 > 0).alias("ingested"), F.count_if(F.col("event_id") % 10 == 0).alias("uningested"))
    return quality.sanity_checks(e.select("day", (F.col("user_id") % 20).alias("file_name")), counts).select("day", "files_ok", "reads_ok")


@query("Q16_fail_digest", with_sql(QC_SQL, " select ordering, name, '{' || left_value || ' : ' || right_value || '}' as detail, 'SLA' as kind from q where status = 0"))
def q16(spark, d):
    return quality.fail_digest(qc(spark, d))


@query("Q1_Q17_combine_results", with_sql(QC_SQL, " select step, 1 as metric, name, status from q"))
def q17(spark, d):
    rows = qc_rows(spark, d).select("step", "metric", "name", "status")
    return quality.combine_results(rows.where("step > 3"), rows.where("step <= 3"))
