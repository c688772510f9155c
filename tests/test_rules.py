"""Published numbers, daylight saving, dirty text, sinks, and invariants."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from meterline.functions import columns as C
from meterline.operators import dedup, linking, ml, normalize, quality, records, rollup, sample, scores, windows
from meterline.plans import customers
from meterline.sources import io
from meterline.streaming.rollup import hourly_stream


def test_income_per_occupant(spark):
    rows = [(1, "a", "A", 1, 0), (1, "b", "B", 2, 1), (1, "c", "D", 4, 3), (1, "d", "A", 0, 2), (1, "e", "U", 1, 0)]
    df = spark.createDataFrame(rows, "tenant_id long, location_id string, income_range string, number_of_adults long, number_of_children long")
    assert {r["location_id"]: r["income_per_occupant"] for r in scores.income_per_occupant(df).collect()} == {"a": 7500, "b": 6667, "c": 6071}


def test_time_of_use(spark):
    cols = "has_ev_bucket int, green_aware int, marital_model_1 int, total_children int, length_residence int, age_1 int, home_sq_footage int"
    df = spark.createDataFrame([(1, 2, 1, 0, 3, 50, 1500), (-1, 1, 4, 2, 9, 80, None), (None, 3, 1, 1, 9, 20, 900)], cols)
    assert [(r["score"], r["propensity"]) for r in scores.weighted_score(df).collect()] == [(35, "high"), (0, "low"), (11, "medium")]


def test_peak_profile_shares(spark):
    df = spark.createDataFrame([tuple([1.0] * 6 + [2.0] * 6 + [1.0] * 5 + [4.0] * 5 + [1.0] * 2)], ", ".join(f"hod_{h} double" for h in range(24)))
    r = scores.peak_profile(df).first()
    assert (r["morning_peak"], r["evening_peak"], r["night_peak"]) == (0, 1, 0)
    assert r["morning_percent_of_day"] + r["afternoon_percent_of_day"] + r["evening_percent_of_day"] == pytest.approx(1)
    assert r["night_percent_of_total"] == pytest.approx(8 / 45)


def test_engagement(spark):
    rows = [("u", "my EHER", "DELIVERED", 1), ("u", "my EHER", "OPEN", 2), ("u", "hba", "DELIVERED", 3), ("u", "hba", "CLICK", 4), ("v", "x", "DELIVERED", 5), ("w", "x", "DELIVERED", 6), ("w", "x", "UNSUBSCRIBE", 7)]
    got = {r["user_uuid"]: r for r in scores.engagement(spark.createDataFrame(rows, "user_uuid string, event_tag string, event_type string, external_event_id long")).collect()}
    assert (got["u"]["eher_engagement_level"], got["u"]["hba_engagement_level"], got["u"]["global_engagement_level"], got["u"]["other_engagement_level"]) == ("low", "high", "medium", "NA")
    assert got["v"]["other_engagement_level"] == "never" and got["w"]["global_engagement_level"] == "unsub"


def test_clean_bills(spark):
    rows = [("1", "E", "2020-01", 1550.0, 15, "2020-01-01", "2020-01-16"), ("1", "E", "2020-01", 1650.0, 17, "2020-01-16", "2020-02-02"), ("2", "E", "2020-01", -5.0, 30, "a", "b"), ("3", "E", "2020-01", 5.0, 0, "a", "b")]
    out = scores.clean_bills(spark.createDataFrame(rows, "account_id string, fuel_type string, bill_yearmonth string, consumption double, bill_days int, bill_start string, bill_end string")).collect()
    assert [(r["account_id"], r["bill_days"], r["bill_adc"]) for r in out] == [("1", 32, 100.0)]


def test_disagg_hourly_example(spark):
    """26 hours: lowest 0.8, one cold hour 3.9 over a mild 0.9, one hot hour 5.3 over a mild 1.3."""
    reads, weather = [], []
    for h in range(24):
        reads.append(("l", dt.datetime(2020, 1, 1, h), {0: 0.9, 1: 1.3, 2: 0.8}.get(h, 2.0)))
        weather.append(("l", dt.datetime(2020, 1, 1, h), 66.0))
    reads += [("l", dt.datetime(2020, 1, 2, 0), 3.9), ("l", dt.datetime(2020, 1, 2, 1), 5.3), ("l", dt.datetime(2020, 1, 3, 1), 200.0)]
    weather += [("l", dt.datetime(2020, 1, 2, 0), 12.0), ("l", dt.datetime(2020, 1, 2, 1), 92.0)]
    r = scores.disagg_hourly(spark.createDataFrame(reads, "location_id string, ts timestamp, consumption double"), spark.createDataFrame(weather, "location_id string, ts timestamp, temp_f double")).first()
    assert (r["n_hours"], r["always_on"]) == (26, 0.8) and r["heating"] == pytest.approx(3.0 / 26) and r["cooling"] == pytest.approx(4.0 / 26)


def test_daylight_saving_days(spark):
    hours = [(f"c{m}", dt.datetime(2024, m, d, h)) for m, days in ((3, (10, 11)), (11, (3, 4))) for d in days for h in range(24)]
    reads = spark.createDataFrame(hours, "channel_uuid string, interval_start_utc timestamp").withColumns({"direction": F.lit("D"), "time_zone": F.lit("US/Eastern"), "seconds_per_interval": F.lit(3600), "consumption": F.lit(1.0), "consumption_code": F.lit(1), "consumption_unit": F.lit("KWH")})
    hourly = rollup.finalize_rollup(rollup.hourly_rollup(reads))
    naive = {r["date_local"]: r for r in rollup.daily_rollup(hourly).collect()}
    true = {r["date_local"]: r["pct_complete"] for r in rollup.daily_rollup(hourly, true_day_length=True).collect()}
    assert naive[dt.date(2024, 3, 10)]["consumption_total"] == 23 and true[dt.date(2024, 3, 10)] == pytest.approx(100)
    assert naive[dt.date(2024, 11, 3)]["consumption_total"] == 25 and true[dt.date(2024, 11, 3)] == pytest.approx(100)


def test_latest_wins_both_ways(spark):
    df = spark.createDataFrame([("c", 1, 5, "old"), ("c", 1, 9, "new"), ("d", 1, None, "only")], "k string, t int, v int, x string")
    want = {("c", "new"), ("d", "only")}
    assert {(r["k"], r["x"]) for r in dedup.latest_wins(df, ["k", "t"], [F.col("v").desc_nulls_last()]).collect()} == want
    assert {(r["k"], r["x"]) for r in dedup.newest(df, ["k", "t"], ["v"]).collect()} == want


GOOD = ["00000001,sp,1,20240101000000,20240101010000,0,0", "00000002,0,0,0,0,0,0,900,0,0,0,0,0,US/Eastern", "00000003,acc,Doe, J", "00000004,0,A", "10000000,1.5,a,b,0-.5,a,b, ,a,b,4,a,b,9,a,b"]


@pytest.mark.parametrize(
    ("line", "text", "error"),
    [(0, None, None), (3, "00000004,x", "MALFORMED"), (0, "00000001,sp,2,20240101000000,20240101010000,0,0", "CHANNEL"), (4, "10000000,zz,a,b", "VALUE_ERROR"), (0, "00000001,sp,1,20240101000000,20240102000000,0,0", "RANGE")],
)
def test_records(spark, line, text, error):
    rows = list(GOOD)
    if text:
        rows[line] = text
    out = records.parse_records(spark.createDataFrame([(rows,)], "record array<string>")).collect()
    assert {r["error_type"] for r in out} == {error}
    if not error:
        assert [r["consumption"] for r in out] == [1.5, 0.0, None, 4.0] and out[1]["timestamp"] == dt.datetime(2024, 1, 1, 0, 15)


def test_records_from_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\n".join(GOOD * 40) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        out = io.read_records(spark, str(tmp_path))
        assert out.count() == 40 and out.where(F.size("record") == 5).count() == 40
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2024, 1, "a"), (2024, 2, "b"), (2024, 2, "c")], "year int, month int, v string")
    counts = {(r["year"], r["month"]): r["n"] for r in io.append_partitioned(df, f"{tmp_path}/t", ["year", "month"]).collect()}
    assert counts == {(2024, 1): 1, (2024, 2): 2}
    io.overwrite_days(df.where("month = 2").limit(1), f"{tmp_path}/t", ["year", "month"])
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2
    path = io.publish_version(df, f"{tmp_path}/v", "1a")
    assert spark.read.parquet(path).count() == 3
    io.write_buckets(df, f"{tmp_path}/b", "v", 4)
    assert spark.read.parquet(f"{tmp_path}/b").count() == 3
    io.save_errors(df.withColumnsRenamed({"year": "step", "month": "metric"}), f"{tmp_path}/e")
    io.append_audit(df, f"{tmp_path}/j", ["year"])
    io.save_report(df, f"{tmp_path}/r", "month")
    io.export_training(df, f"{tmp_path}/x", "month", ["v"])
    assert spark.read.json(f"{tmp_path}/j").count() == 3 and spark.read.option("header", True).csv(f"{tmp_path}/r").columns == ["year", "v"]


def test_csv_scan(spark, tmp_path):
    (tmp_path / "x.csv").write_text(" 12 , abc ,7\n,,oops\n")
    got = io.read_positional_csv(spark, str(tmp_path), io.PositionalCsv((("id", "string"), ("name", "string"), ("n", "int")), ids=("id",))).collect()
    assert got[0]["id"] == "0" * 18 + "12" and got[0]["name"] == "abc" and [r["n"] for r in got] == [7, None]


def test_uuid_round_trip(spark):
    df = spark.createDataFrame([(11, 2**40 + 7)], "p long, n long").select(C.uuid_from_parts(F.col("p"), F.col("n")).alias("u"))
    p, n = C.parts_from_uuid(F.col("u"))
    assert df.select("u", p, n).first()[:] == ("00000000-0000-000b-0000-010000000007", 11, 2**40 + 7)


def test_file_names(spark):
    df = spark.createDataFrame([("s3://b/x/meter.v1.csv",), ("",), (None,), ("plain",)], "p string").select(C.file_stem(F.col("p")))
    assert [r[0] for r in df.collect()] == ["meter", "UNKNOWN", "UNKNOWN", "plain"]


def test_error_precedence(spark):
    base = {"n_accounts": 1, "n_locations": 1, "n_channels": 1, "account_uuid": "a", "location_uuid": "l", "channel_uuid": "c", "is_inactive": False}
    cases = {5241: {"n_accounts": 2, "is_inactive": True}, 4041: {"account_uuid": None, "n_accounts": 0}, 5141: {"is_inactive": True}, 5242: {"n_locations": 3}, 4042: {"location_uuid": None}, 5243: {"n_channels": 2}, 4043: {"channel_uuid": None}, 5000: {}}
    schema = "n_accounts long, n_locations long, n_channels long, account_uuid string, location_uuid string, channel_uuid string, is_inactive boolean, want int"
    df = spark.createDataFrame([(*{**base, **c}.values(), k) for k, c in cases.items()], schema)
    out = linking.classify_errors(df).collect()
    assert [r["error_code"] for r in out] == [r["want"] for r in out] and "2 account matches" in {r["error_message"] for r in out}


def test_interval_join_meets_once(spark):
    left = spark.range(0, 500).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 97).alias("t"))
    starts = spark.range(0, 40).select(F.lit("k").alias("k"), F.timestamp_seconds(F.col("id") * 1201).alias("s"))
    got = linking.interval_join(left, starts, ["k"], "t", "s", 3600)
    want = sum(0 <= 97 * a - 1201 * b < 3600 for a in range(500) for b in range(40))
    assert got.count() == want == got.distinct().count()


def test_interval_join_plan_has_no_cross_join(spark):
    left = spark.range(5).select(F.lit("k").alias("k"), F.timestamp_seconds("id").alias("t"))
    plan = linking.interval_join(left, left.withColumnRenamed("t", "s"), ["k"], "t", "s", 60)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_metrics_sum_to_total(spark):
    df = spark.range(1000).select((F.col("id") % 2).cast("int").alias("y"), ((F.col("id") * 7919) % 1000 / 1000.0).alias("s"))
    m = windows.eval_metrics(df, "y", "s").first()
    assert m["n"] == 1000 and 0.4 < m["auc"] < 0.6
    per = windows.eval_metrics(df.withColumn("g", F.col("y") * 0), "y", "s", ["g"]).first()
    assert per["auc"] == pytest.approx(m["auc"])


def test_folds_are_disjoint_and_cover(spark):
    folds = sample.assign_folds(spark.range(500), "id", 5)
    assert folds.groupBy("fold").count().count() == 5 and folds.where("fold between 0 and 4").count() == 500


def test_conform_and_violations(spark):
    schema = StructType([StructField("a", IntegerType(), False), StructField("b", StringType(), True, {"maxlength": 2}), StructField("c", StringType())])
    out = quality.conform(spark.createDataFrame([("1", "xyz"), ("n", None)], "a string, b string"), schema)
    assert [tuple(r) for r in out.collect()] == [(1, "xyz", None), (None, None, None)]
    assert {r["column_name"]: r["n"] for r in quality.violations(out, schema).collect()} == {"a": 1, "b": 1, "c": 0}


def test_common_reads(spark):
    raw = spark.createDataFrame([("x", " delivered", "ACT ", None, "2024-01-01 01:00:00", "3600", "1.5", "kwh"), ("y", "NET", "E", "CST", "2024-01-01 01:00:00", "bad", "oops", "kwh")], "id string, direction string, code string, time_zone string, interval_end string, seconds_per_interval string, consumption string, consumption_unit string")
    out = normalize.common_reads(raw, normalize.CommonReads(policy=normalize.UtcPolicy("column_tz"))).collect()
    assert len(out) == 1 and out[0]["consumption_code"] == 1 and out[0]["interval_start_utc"] == dt.datetime(2024, 1, 1, 5) and out[0]["day"] == 1
    with pytest.raises(ValueError):
        normalize.UtcPolicy("guess").utc(F.lit(1))


def test_safe_score_without_a_class(spark):
    df = customers.id_tables(spark, "/root/testdata/sf0.001")[1].limit(5).withColumn("label", F.lit(1)).withColumn("x", F.lit(1.0))
    assert ml.safe_fit(ml.rf_pipeline("label", ["x"]), df, "label") is None
    assert ml.safe_score(None, df, "label").count() == 0 and ml.safe_score(None, df, "label", fallback="label").count() == 5


def test_stream(spark, tmp_path):
    spark.createDataFrame([("c", dt.datetime(2024, 1, 1, 0, 0), 1.0), ("c", dt.datetime(2024, 1, 1, 0, 15), 2.0), ("c", dt.datetime(2024, 1, 1, 0, 15), 2.0)], "channel_uuid string, interval_start_utc timestamp, consumption double").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("channel_uuid string, interval_start_utc timestamp, consumption double").parquet(f"{tmp_path}/in")
    q = hourly_stream(stream).writeStream.outputMode("update").format("memory").queryName("hours").option("checkpointLocation", f"{tmp_path}/cp").start()
    q.processAllAvailable()
    q.stop()
    assert [(r["num_reads"], r["consumption_total"]) for r in spark.table("hours").collect()] == [(2, 3.0)]


def test_scan_days_prunes_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    days = spark.sql("select explode(sequence(date'2023-12-20', date'2024-02-10')) as d")
    parts = days.select("d", F.year("d").alias("year"), F.month("d").alias("month"), F.dayofmonth("d").alias("day"))
    parts.repartition(1).write.partitionBy("year", "month", "day").parquet(f"{tmp_path}/t")
    df = io.scan_days(spark, f"{tmp_path}/t", "2024-01-01", "2024-01-03", 1)
    assert sorted(str(r["d"]) for r in df.collect()) == ["2023-12-31", "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = io.scan_days(spark, f"{tmp_path}/t", "2024-01-01", "2024-01-03", 1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "year" in filters and "make_date" in filters and "DataFilters: []" in plan


def test_database_is_read_in_ranges(spark):
    """The database that comes with Spark, in the memory of this process."""
    url = {"url": "jdbc:derby:memory:ranges;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    spark.createDataFrame([(i * 3 - 50, i % 7, f"v{i}") for i in range(200)], "id long, k int, v string").write.format("jdbc").options(**url, dbtable="t").mode("overwrite").save()
    query = 'select "id", "k" from t where "k" < 6'
    df = io.jdbc(spark, url, query, "id", rows=20)
    sizes = [len(p) for p in df.rdd.glom().collect()]
    assert len(sizes) == -(-172 // 20) and sum(sizes) == 172 and max(sizes) < 30
    assert io.jdbc(spark, url, query, "id", rows=20, most=3).rdd.getNumPartitions() == 3
    assert io.jdbc(spark, url, query + ' and "k" < 0', "id", rows=20).collect() == []
    assert io.jdbc(spark, url, query).count() == 172
    plan = df.where("k = 2").select("k")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [*IsNotNull(k), *EqualTo(k,2)]" in plan and "ReadSchema: struct<k:int>" in plan


def test_channel_map_by_hand(spark):
    url = {"url": "jdbc:derby:memory:map;create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    tables = {"channel": ([(1, 5, 10, 1, "0000"), (2, 6, 10, 2, "0042"), (9, 7, 11, 1, "x0")], "channel_id long, account_id long, location_id long, direction_code int, external_id string", "external_id varchar(20)"), "location": ([(10, 1, "home"), (12, 1, "none")], "location_id long, tenant_id long, name string", "name varchar(20)"), "tenant": ([(1, "t")], "tenant_id long, name string", "name varchar(20)")}
    for name, (rows, schema, types) in tables.items():
        spark.createDataFrame(rows, schema).write.format("jdbc").options(**url, dbtable=name, createTableColumnTypes=types).mode("overwrite").save()
    got = [tuple(r) for r in io.read_channel_map(spark, url, rows=1).orderBy("channel_id").collect()]
    assert got == [(1, 5, 10, "D", "0", "home", "t"), (2, 6, 10, "R", "42", "home", "t")]


def test_append_counts_come_from_footers(spark, tmp_path):
    """One job computes the rows; what is appended is counted without reading a column of it; a failed write leaves nothing."""
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(1000).select(F.col("id"), (F.col("id") % 3).cast("int").alias("p"), F.when(F.col("id") < 10, None).otherwise("a/b=c d").alias("q")).mapInArrow(touch, "id long, p int, q string")
    path = f"{tmp_path}/a table"
    counts = {(r["p"], r["q"]): r["n"] for r in io.append_partitioned(df, path, ["p", "q"]).collect()}
    assert seen.value == 1000 and sum(counts.values()) == 1000 and counts[(0, None)] == 4
    io.append_partitioned(df, path, ["p", "q"])
    assert spark.read.parquet(path).count() == 2000 and {tuple(r) for r in spark.read.parquet(path).select("p", "q").distinct().collect()} == set(counts)
    bad = df.withColumn("id", F.when(F.col("id") == 999, F.raise_error(F.lit("no")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        io.append_partitioned(bad, path, ["p"])
    assert spark.read.parquet(path).count() == 2000 and not [x for x in (tmp_path / "a table").iterdir() if x.name.startswith("_append")]


def test_pointers_and_versions(spark, tmp_path):
    import pytest

    pointers = f"{tmp_path}/pointers"
    assert io.read_pointers(spark, pointers).count() == 0
    new = lambda *rows: spark.createDataFrame(rows, "date_utc string, load_folder string")
    io.save_pointers(spark, pointers, new(("2024-01-01", "run=a"), ("2024-01-02", "run=a")))
    io.save_pointers(spark, pointers, new(("2024-01-02", "run=b")))
    assert [tuple(r) for r in io.read_pointers(spark, pointers).orderBy("date_utc").collect()] == [("2024-01-01", "run=a"), ("2024-01-02", "run=b")]
    for run in ("a", "b"):
        io.publish_version(spark.createDataFrame([("2024-01-02", run)], "date_utc string, v string"), str(tmp_path), run)
    assert io.resolve_version(spark, pointers, str(tmp_path), "2024-01-02").first()["v"] == "b"
    with pytest.raises(ValueError):
        io.resolve_version(spark, pointers, str(tmp_path), "2024-01-03")


def test_buckets_by_hand(spark):
    import zlib

    rows = [("c1",), ("c2",), ("",), ("é",)]
    got = {r["k"]: r["bucket"] for r in io.with_bucket(spark.createDataFrame(rows, "k string"), "k", 16).collect()}
    assert got == {k: zlib.crc32(k.encode()) % 16 for k, in rows}


def test_ensemble_members_by_interval(spark):
    from meterline.operators import ml

    rows = [(i, m, float(i % 7), float(i % 3), int(i % 7 > 3)) for m in (15, 30, 60) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, minutes int, a double, b double, y int")
    models = ml.fit_ensembles(df, "minutes", [15, 30, 60], "y", ["a", "b"])
    assert {m: set(own) for m, own in models.items()} == {15: {"lr", "gbt", "rf"}, 30: {"svc", "lr", "rf"}, 60: {"lr", "gbt", "rf"}}
    scored = ml.score_ensembles(models, df, "minutes").toPandas()
    assert scored.score.between(0, 1).all() and (scored[scored.y == 1].score.mean() > 0.7) and len(scored) == len(rows)
