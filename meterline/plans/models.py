"""Queries that fit models.

Labels follow a rule of the features that a model can find exactly, so that SQL can say what fitted models have to give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ml, scores, signature, windows
from ..operators.sample import assign_folds
from .catalogue import query
from .views import table

FEATURES = ["c_acctbal", "n_orders", "c_nationkey"]
BUSY = 10
CUSTOMERS_SQL = f"""with per as (select o_custkey, count(*) as n from orders group by 1),
c as (select c_custkey, c_acctbal, coalesce(n, 0) as n_orders, c_nationkey, c_mktsegment, coalesce(n, 0) > {BUSY} as busy, c_custkey % 5 > 0 as known, c_custkey % 3 * 15 + 15 as interval_minutes,
  cast('0x' || substr(md5(c_custkey || ':7'), 1, 13) as bigint) as h from customer left join per on c_custkey = o_custkey)"""


def customers(spark: SparkSession, d: str, noise: bool = False) -> DataFrame:
    """Customers with a label (unknown for a fifth): whether they are busy. With noise, every 13th label is turned round."""
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    per = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n_orders"))
    df = c.join(per, "c_custkey", "left").withColumn("n_orders", F.coalesce("n_orders", F.lit(0)).cast("double"))
    busy = F.col("n_orders") > BUSY
    label = (busy != (F.col("c_custkey") % 13 == 0) if noise else busy).cast("int")
    return df.select("c_custkey", F.col("c_acctbal").cast("double"), "n_orders", F.col("c_nationkey").cast("double"), "c_mktsegment", F.when(F.col("c_custkey") % 5 > 0, label).alias("label"), (F.col("c_custkey") % 3 * 15 + 15).alias("interval_minutes"))


def forest(depth: int = 5):
    """All features are open to each split and all their values to a threshold, so that the rule is within reach."""
    return ml.rf_pipeline("label", FEATURES, trees=20, depth=depth, featureSubsetStrategy="all", maxBins=128)


@query("M1_prepare_features", "select c_custkey, cast(c_acctbal as double) as c_acctbal, cast(n_orders as double) as n_orders, cast(dense_rank() over (order by c_mktsegment desc) - 1 as double) as c_mktsegment from (" + CUSTOMERS_SQL + " select * from c)")
def m1(spark, d):
    df = customers(spark, d)
    return ml.prepare_features(df, ["c_acctbal", "n_orders", "c_mktsegment"]).select("c_custkey", "c_acctbal", "n_orders", "c_mktsegment")


def _boosted(steps: int) -> str:
    """The score that boosting by a tenth gives the rows of a rule that its trees find: each step adds a tenth of the loss's
    slope to the margin."""
    margin = "1e0"
    for _ in range(steps - 1):
        margin = f"({margin} + 0.4e0 / (1e0 + exp(2e0 * {margin})))"
    return f"1e0 / (1e0 + exp(-2e0 * {margin}))"


@query("M2_M4_gbt_score", CUSTOMERS_SQL + f" select c_custkey, case when known then busy::int end as label, round(case when known then busy::int when busy then {_boosted(4)} else 1e0 - {_boosted(4)} end, 6) as score from c")
def m2(spark, d):
    df = customers(spark, d)
    model = ml.gbt_pipeline("label", FEATURES, maxIter=4, maxBins=128).fit(df.where("label is not null"))
    return ml.score(model, df, "label").select("c_custkey", "label", F.round("score", 6).alias("score"))


@query("M3_M9_forest", CUSTOMERS_SQL + " select c_custkey, busy::int::double as score from c")
def m3(spark, d):
    df = customers(spark, d)
    return ml.safe_score(ml.safe_fit(forest(), df, "label"), df, "label", keep_labels=False).select("c_custkey", F.round("score", 6).alias("score"))


@query("M3_split_metrics", CUSTOMERS_SQL + """, t as (select busy, busy <> (c_custkey % 13 = 0) as y from c where known and h % 10 < 3),
  m as (select count(*) filter (y and busy) / count(*) filter (y) as sens, count(*) filter (not y and not busy) / count(*) filter (not y) as spec, count(*) as n from t)
  select n, round(sens, 6) as sensitivity, round(spec, 6) as specificity, round((sens + spec) / 2, 6) as auc from m""")
def m3_metrics(spark, d):
    """A forest of single splits fitted on seven tenths of noisy labels; how well it does on the other three. Its scores have
    two values, so that the area under the curve is the mean of both shares."""
    df = assign_folds(customers(spark, d, noise=True).where("label is not null"), "c_custkey", 10)
    model = forest(1).fit(df.where("fold >= 3"))
    out = ml.predict(model, df.where("fold < 3"))
    share = scores.confusion(out.select("label", (F.col("score") > 0.5).cast("int").alias("predicted")), "label", "predicted")
    auc = windows.eval_metrics(out, "label", "score").select("n", F.round("auc", 6).alias("auc"))
    return share.select(F.round("sensitivity", 6).alias("sensitivity"), F.round("specificity", 6).alias("specificity"), F.lit(1).alias("one")).join(F.broadcast(auc.withColumn("one", F.lit(1))), "one").drop("one")


@query("M5_cross_val_predict", CUSTOMERS_SQL + " select c_custkey, cast(h % 3 as integer) as fold, busy::int::double as score from c where known")
def m5(spark, d):
    return ml.cross_val_predict(forest, customers(spark, d), "c_custkey", "label", 3).select("c_custkey", "fold", F.round("score", 6).alias("score"))


@query("M6_M7_ensembles", CUSTOMERS_SQL + " select c_custkey, interval_minutes, busy and interval_minutes < 45 as found, interval_minutes = 45 as without_model from c")
def m6(spark, d):
    """Two intervals have models, whose vote has to find the busy ones; a third has none and scores 0."""
    df = customers(spark, d).withColumn("busy", (F.col("n_orders") > BUSY).cast("double"))
    models = ml.fit_ensembles(df, "interval_minutes", [15, 30], "label", ["c_acctbal", "busy"])
    out = ml.score_ensembles(models, df, "interval_minutes")
    return out.select("c_custkey", "interval_minutes", (F.col("score") > 0.5).alias("found"), (F.col("score") == 0).alias("without_model"))


def loads(spark: SparkSession, d: str) -> DataFrame:
    """Hourly loads from events, four users to a channel. A third of the channels have a heater's cycle: next to nothing, 0.6 or 1.8 kWh by the
    event's kind; the others use what the event says."""
    e = table(spark, d, "events")
    channel = F.floor(F.col("user_id") / 4)
    base = (F.col("event_id") * 31 % 59) / 2000
    step = F.when(F.col("event_type") == "click", 0.6).when(F.col("event_type") == "signup", 1.8).otherwise(0.0)
    kwh = F.when(channel % 3 == 0, base + step).otherwise(F.col("value"))
    return e.select(channel.alias("channel_id"), "event_id", F.col("ts").cast("timestamp").alias("ts"), kwh.alias("kwh"))


@query("M8_signature")
def m8(spark, d):
    out = signature.signature_score(loads(spark, d), ["channel_id"], "event_id", "kwh")
    return out.select("channel_id", "windows", F.round("avg_score", 4).alias("avg_score"), F.round("avg_scaled", 4).alias("avg_scaled"), "is_heater")
