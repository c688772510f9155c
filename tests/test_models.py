"""Fits side by side, and fitted models as SQL that another engine scores with."""

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from meterline.operators import ml
from meterline.operators.model_sql import probability_sql
from meterline.operators.sample import assign_folds
from meterline.plans import models

D = "/root/testdata/sf0.001"
FEATURES = ["c_acctbal", "n_orders", "c_nationkey"]


@pytest.fixture(scope="module")
def noisy(spark):
    """Labels that no rule tells, and features with holes."""
    df = models.customers(spark, D, noise=True)
    kind = (F.col("c_custkey") % 3).cast("double")
    return df.withColumns({"c_acctbal": F.when(F.col("c_custkey") % 7 > 0, F.col("c_acctbal")), "n_orders": F.when(F.col("c_custkey") % 10 == 0, F.lit(float("nan"))).otherwise(F.col("n_orders")), "kind": kind})


def pipelines():
    lr = [*ml._assembly(FEATURES, (), ()), ml.LogisticRegression(labelCol="label", maxIter=20)]
    svc = [*ml._assembly(FEATURES, (), ()), ml.LinearSVC(labelCol="label", maxIter=10, rawPredictionCol="_margin", predictionCol="_side"), ml.LogisticRegression(labelCol="label", featuresCol="_margin")]
    return {
        "M2_M4": ml.gbt_pipeline("label", FEATURES, maxIter=8),
        "M3_M9": ml.rf_pipeline("label", FEATURES, trees=25, depth=6),
        "T7": ml.rf_pipeline("label", FEATURES, others=["kind"], trees=10, depth=7, categories=10),
        "M7 logistic": Pipeline(stages=lr),
        "M7 margin": Pipeline(stages=svc),
    }


@pytest.mark.parametrize("name", ["M2_M4", "M3_M9", "T7", "M7 logistic", "M7 margin"])
def test_sql_scores_as_spark_does(spark, noisy, name):
    model = pipelines()[name].fit(noisy.where("label is not null"))
    scored = ml.predict(model, noisy).select("c_custkey", *FEATURES, "kind", "score").toPandas()
    con = duckdb.connect()
    con.execute("create table t (c_custkey bigint, c_acctbal double, n_orders double, c_nationkey double, kind double)")
    con.executemany("insert into t values (?, ?, ?, ?, ?)", [tuple(None if c is None else c for c in r) for r in scored[["c_custkey", *FEATURES, "kind"]].astype(object).where(scored[["c_custkey", *FEATURES, "kind"]].notna(), None).values.tolist()])
    text = probability_sql(model)
    got = dict(con.execute(f"select c_custkey, {text} from t").fetchall())
    assert scored.score.nunique() > 5
    for k, want in zip(scored.c_custkey, scored.score, strict=True):
        assert got[k] == pytest.approx(want, abs=1e-12)
    assert noisy.select(F.expr(text).alias("s")).where("s is null or s < 0 or s > 1").count() == 0


def test_sql_of_unknown_stages(spark, noisy):
    model = Pipeline(stages=[StringIndexer(inputCol="c_mktsegment", outputCol="x")]).fit(noisy)
    with pytest.raises(ValueError, match="StringIndexerModel"):
        probability_sql(model)


def test_folds_read_their_input_once(spark, noisy):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    n = noisy.where("label is not null").count()
    rows = spark.createDataFrame(noisy.collect(), noisy.schema)
    df = rows.mapInArrow(touch, rows.schema)
    make = lambda: ml.gbt_pipeline("label", FEATURES, maxIter=4)
    out = ml.cross_val_predict(make, df, "c_custkey", "label", 3)
    got = {r["c_custkey"]: (r["fold"], r["score"]) for r in out.collect()}
    assert len(got) == n and seen.value == rows.count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 and "MapInArrow" not in plan
    folds = assign_folds(rows.where("label is not null"), "c_custkey", 3)
    for i in range(3):
        model = make().fit(folds.where(F.col("fold") != i))
        for r in ml.predict(model, folds.where(F.col("fold") == i)).collect():
            assert got[r["c_custkey"]] == (i, pytest.approx(r["score"], abs=1e-9))


def test_ensembles_read_their_input_once(spark, noisy):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.createDataFrame(noisy.collect(), noisy.schema)
    out = ml.fit_ensembles(rows.mapInArrow(touch, rows.schema), "interval_minutes", [15, 30, 60], "label", FEATURES)
    assert seen.value == rows.count() and set(out) == {15, 30}
    text = {k: probability_sql(m) for k, m in out[30].items()}
    vote = " + ".join(f"{ml.ENSEMBLES[30][k]} * ({t})" for k, t in text.items())
    scored = ml.score_ensembles(out, rows, "interval_minutes").where("interval_minutes = 30").withColumn("own", F.expr(f"({vote}) / 4"))
    assert scored.count() > 0 and scored.where("abs(own - score) > 1e-9").count() == 0


def test_a_group_with_one_class_has_no_models(spark):
    df = spark.createDataFrame([(15, 1, 1.0)] * 9 + [(30, i % 2, float(i)) for i in range(20)], "g int, label int, x double")
    assert set(ml.fit_ensembles(df, "g", [15, 30, 60], "label", ["x"])) == {30}
