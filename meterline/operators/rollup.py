"""Roll-ups of reads and other aggregates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

HOUR_KEYS = ["channel_uuid", "direction", "date_utc", "hour_utc", "time_zone"]
DAY_KEYS = ["channel_uuid", "direction", "time_zone", "date_local"]


def when_sum(test: Column, value: Column) -> Column:
    return F.sum(F.when(test, value))


def hourly_rollup(reads: DataFrame, unit: str = "KWH") -> DataFrame:
    """Per channel, direction, UTC hour and zone: interval lengths, and counts and sums by read code. Code 3 and above
    is 'other'; 0 or less, or none, is missing."""
    code, kwh = F.col("consumption_code"), F.col("consumption")
    kinds = {"actual": code == 1, "estimated": code == 2, "other": code >= 3}
    df = reads.where(F.col("consumption_unit") == unit).withColumns({"date_utc": F.to_date("interval_start_utc"), "hour_utc": F.hour("interval_start_utc")})
    return df.groupBy(*HOUR_KEYS).agg(
        F.min("seconds_per_interval").alias("min_seconds"),
        F.max("seconds_per_interval").alias("max_seconds"),
        *[F.count_if(t).alias(f"num_reads_{k}") for k, t in kinds.items()],
        F.count_if(code.isNull() | (code <= 0)).alias("num_reads_missing"),
        *[when_sum(t, kwh).alias(f"consumption_{k}") for k, t in kinds.items()],
    )


def finalize_rollup(df: DataFrame) -> DataFrame:
    """num_reads_total without the missing ones, consumption_total null where no read counts."""
    kinds = ("actual", "estimated", "other")
    total = sum((F.coalesce(f"num_reads_{k}", F.lit(0)) for k in kinds), F.lit(0))
    kwh = sum((F.coalesce(f"consumption_{k}", F.lit(0.0)) for k in kinds), F.lit(0.0))
    return df.withColumn("num_reads_total", total).withColumn("consumption_total", F.when(F.col("num_reads_total") > 0, kwh))


def with_completeness(df: DataFrame, seconds: int = 3600) -> DataFrame:
    whole = (F.col("num_reads_total") * F.col("max_seconds") == seconds) & (F.col("min_seconds") == F.col("max_seconds"))
    return df.withColumn("is_complete", F.coalesce(whole, F.lit(False)))


def daily_rollup(hourly: DataFrame, true_day_length: bool = False) -> DataFrame:
    """Sums per channel, direction, zone and local date. pct_complete counts the seconds of complete hours against 24
    hours, or against the local day's true length where daylight saving changes it."""
    ts = F.timestamp_seconds(F.unix_timestamp(F.col("date_utc").cast("timestamp")) + F.col("hour_utc").cast("long") * 3600)
    df = with_completeness(hourly).withColumn("date_local", F.to_date(F.from_utc_timestamp(ts, F.col("time_zone"))))
    kinds = ("actual", "estimated", "other", "missing", "total")
    out = df.groupBy(*DAY_KEYS).agg(
        F.min("min_seconds").alias("min_seconds"),
        F.max("max_seconds").alias("max_seconds"),
        *[F.sum(f"num_reads_{k}").alias(f"num_reads_{k}") for k in kinds],
        F.sum("consumption_total").alias("consumption_total"),
        (F.count_if("is_complete") * 3600).alias("complete_seconds"),
    )
    midnight = lambda d: F.unix_timestamp(F.to_utc_timestamp(d.cast("timestamp"), F.col("time_zone")))
    length = midnight(F.date_add("date_local", 1)) - midnight(F.col("date_local")) if true_day_length else F.lit(86400)
    return out.withColumn("pct_complete", 100.0 * F.col("complete_seconds") / length)


def affected_local_days(reads: DataFrame) -> DataFrame:
    """Local dates that the UTC range of reads touches in their zones."""
    span = reads.groupBy("time_zone").agg(F.min("interval_start_utc").alias("lo"), F.max("interval_start_utc").alias("hi"))
    day = lambda c: F.to_date(F.from_utc_timestamp(F.col(c), F.col("time_zone")))
    return span.select("time_zone", F.explode(F.sequence(day("lo"), day("hi"))).alias("date_local"))


def pivot_day(hourly: DataFrame, direction: str = "D") -> DataFrame:
    """One row per channel, zone and UTC date with kwh_h00 to kwh_h23 (null where the hour is incomplete), the latest
    complete hour and the share of complete hours; one pass."""
    df = with_completeness(hourly).where(F.col("direction") == direction)
    hours = [when_sum(F.col("is_complete") & (F.col("hour_utc") == h), F.col("consumption_total")).alias(f"kwh_h{h:02d}") for h in range(24)]
    return df.groupBy("channel_uuid", "time_zone", "date_utc").agg(*hours, F.max(F.when(F.col("is_complete"), F.col("hour_utc"))).alias("latest_hour"), (100.0 * F.count_if("is_complete") / 24).alias("pct_complete"))


def pivot_month(daily: DataFrame, min_pct: float = 95.0, direction: str = "D") -> DataFrame:
    """One row per channel, zone and local month with kwh_d01 to kwh_d31; a day counts from min_pct complete."""
    df = daily.where(F.col("direction") == direction).withColumn("month_start", F.trunc("date_local", "month"))
    days = [when_sum((F.col("pct_complete") >= min_pct) & (F.dayofmonth("date_local") == d), F.col("consumption_total")).alias(f"kwh_d{d:02d}") for d in range(1, 32)]
    return df.groupBy("channel_uuid", "time_zone", "month_start").agg(*days)


def touched_months(days: DataFrame, column: str) -> DataFrame:
    first = F.trunc(column, "month")
    return days.select(first.alias("month_start"), F.last_day(first).alias("month_end")).distinct()


def summarize_raw(df: DataFrame, keys: list[str], code: str = "consumption_code", kwh: str = "consumption") -> DataFrame:
    """Read counts and kWh by code 1, 2, 3, 0 and other, and totals; kWh as decimals, null sums as 0."""
    c, v = F.col(code), F.col(kwh).cast("decimal(16,3)")
    kinds = {"actual": c == 1, "estimated": c == 2, "prorated": c == 3, "missing": c == 0, "unknown": c.isNull() | ~c.isin(0, 1, 2, 3)}
    return df.groupBy(*keys).agg(
        *[F.count_if(t).alias(f"reads_{k}") for k, t in kinds.items()],
        *[F.coalesce(when_sum(t, v), F.lit(0)).cast("decimal(20,3)").alias(f"kwh_{k}") for k, t in kinds.items()],
        F.count(F.lit(1)).alias("reads_total"),
        F.coalesce(F.sum(v), F.lit(0)).cast("decimal(20,3)").alias("kwh_total"),
    )


def error_distribution(df: DataFrame, column: str) -> DataFrame:
    """One row: sorted 'type:count' of non-null errors."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.col(column).cast("string"), F.col("n").cast("string")))), ",").alias("distribution"))


def metric_counts(df: DataFrame, file: str, code: str) -> DataFrame:
    """Counts by file and code, by file, by code and over all, in one pass; null stands for 'any'."""
    return df.groupingSets([[file, code], [file], [code], []], file, code).agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("n"))


def audit_map(df: DataFrame, file: str, metric: str, value: str) -> DataFrame:
    """Per file a map of summed metrics, and rows in all."""
    sums = df.groupBy(file, metric).agg(F.sum(value).alias("v"))
    entries = F.array_sort(F.collect_list(F.struct(F.col(metric).alias("key"), F.col("v").alias("value"))))
    return sums.groupBy(file).agg(F.map_from_entries(entries).alias("metrics"), F.sum("v").alias("row_count"))


def file_severity(df: DataFrame, file: str, ok: Column) -> DataFrame:
    """Percent of good rows per file: from 100 info, from 95 warning, else error."""
    pct = 100.0 * F.count_if(ok) / F.count(F.lit(1))
    return df.groupBy(file).agg(pct.alias("pct_ok")).withColumn("severity", F.when(F.col("pct_ok") >= 100, "info").when(F.col("pct_ok") >= 95, "warning").otherwise("error"))


def file_inventory(files: DataFrame, expected: DataFrame, name: str, lines: str) -> DataFrame:
    """Expected names with how many files and lines came, zeros for none."""
    got = files.groupBy(name).agg(F.count(F.lit(1)).alias("file_count"), F.sum(lines).alias("line_count"))
    return expected.select(name).distinct().join(got, name, "left").na.fill(0, ["file_count", "line_count"])


def channel_metric(daily: DataFrame, channels: DataFrame, value: Column, name: str, grain: str = "location") -> DataFrame:
    """A metric per channel of `daily` (value: an aggregate), or the mean or, for booleans, any of a location's."""
    per = daily.groupBy("channel_uuid").agg(value.alias(name))
    out = channels.join(per, "channel_uuid", "left")
    if grain == "channel":
        return out
    boolean = dict(per.dtypes)[name] == "boolean"
    return out.groupBy("location_id").agg((F.coalesce(F.bool_or(name), F.lit(False)) if boolean else F.avg(name)).alias(name))


def has_data(daily: DataFrame, channels: DataFrame, grain: str = "location") -> DataFrame:
    return channel_metric(daily, channels, F.sum("num_reads_actual") > 0, "has_ami", grain)


def fill_rate(daily: DataFrame, channels: DataFrame, grain: str = "location") -> DataFrame:
    return channel_metric(daily, channels, F.avg(F.col("pct_complete") / 100), "fill_rate", grain)


def location_means(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def location_max(df: DataFrame, keys: list[str], score: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(score).alias(score))


def event_counts(events: DataFrame, keys: list[str], kind: str, kinds: list[str], event_id: str) -> DataFrame:
    """Distinct events by kind as columns; null (not 0) where there are none."""
    return events.where(F.col(kind).isin(kinds)).groupBy(*keys).pivot(kind, kinds).agg(F.count_distinct(event_id))


def widen(df: DataFrame, key: str, name: str, names: list[str], value: str, missing: str = "NA") -> DataFrame:
    """One row per key with a column for each name; unique cells."""
    return df.groupBy(key).pivot(name, names).agg(F.first(value)).na.fill(missing)


def pivot_months(bills: DataFrame, keys: list[str]) -> DataFrame:
    """Average daily consumption of the earliest bill of each midpoint month, as m01 to m12."""
    cells = [F.min_by(F.when(F.col("bill_month") == m, F.col("bill_adc")), F.when(F.col("bill_month") == m, F.col("bill_start"))).alias(f"m{m:02d}") for m in range(1, 13)]
    return bills.groupBy(*keys).agg(*cells)


def season_ratio(months: DataFrame) -> DataFrame:
    """Season sums, and the largest over the smallest that is known."""
    seasons = {"spring": (3, 4, 5), "summer": (6, 7, 8), "fall": (9, 10, 11), "winter": (12, 1, 2)}
    df = months.withColumns({s: sum((F.col(f"m{m:02d}") for m in ms[1:]), F.col(f"m{ms[0]:02d}")) for s, ms in seasons.items()})
    return df.withColumn("max_min_ratio", F.try_divide(F.greatest(*seasons), F.least(*seasons)))


def group_kurtosis(df: DataFrame, group: str, key: str, value: str) -> DataFrame:
    """Kurtosis per key of values standardised within their group."""
    stats = df.groupBy(group).agg(F.avg(value).alias("_mean"), F.stddev_samp(value).alias("_sd"))
    z = df.join(stats, group).withColumn("z", F.try_divide(F.col(value) - F.col("_mean"), F.col("_sd")))
    return z.groupBy(key).agg(F.kurtosis("z").alias("kurtosis"))


def weekly_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Kurtosis, skewness and peak; NaN becomes null."""
    real = lambda c: F.when(~F.isnan(c), c)
    return df.groupBy(*keys).agg(real(F.kurtosis(value)).alias("kurtosis"), real(F.skewness(value)).alias("skewness"), F.max(value).alias("peak"))


def mean_degree_days(daily: DataFrame, keys: list[str]) -> DataFrame:
    return daily.groupBy(*keys).agg(F.avg("hdd").alias("mean_hdd"), F.avg("cdd").alias("mean_cdd"), F.count(F.lit(1)).alias("n_days"))


def ols2(df: DataFrame, keys: list[str], y: str, x1: str, x2: str, min_n: int = 8) -> DataFrame:
    """Least squares of y on x1 and x2 per key: intercept, coef_1, coef_2, rsquare. From centred moments, so it is two
    aggregates and no Python; keys with fewer rows, no spread of x or no finite R2 are left out."""
    whole = df.where(F.col(y).isNotNull() & F.col(x1).isNotNull() & F.col(x2).isNotNull())
    means = whole.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(y).alias("my"), F.avg(x1).alias("m1"), F.avg(x2).alias("m2")).where(F.col("n") >= min_n)
    d = whole.join(means, keys).withColumns({"_y": F.col(y) - F.col("my"), "_1": F.col(x1) - F.col("m1"), "_2": F.col(x2) - F.col("m2")})
    pairs = {"s11": ("_1", "_1"), "s22": ("_2", "_2"), "s12": ("_1", "_2"), "s1y": ("_1", "_y"), "s2y": ("_2", "_y"), "syy": ("_y", "_y")}
    m = d.groupBy(*keys, "n", "my", "m1", "m2").agg(*[F.sum(F.col(a) * F.col(b)).alias(k) for k, (a, b) in pairs.items()])
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    m = m.withColumn("det", F.when(F.abs(det) > 1e-12 * F.col("s11") * F.col("s22"), det))
    m = m.withColumn("coef_1", F.try_divide(F.col("s1y") * F.col("s22") - F.col("s2y") * F.col("s12"), F.col("det")))
    m = m.withColumn("coef_2", F.try_divide(F.col("s2y") * F.col("s11") - F.col("s1y") * F.col("s12"), F.col("det")))
    m = m.withColumn("rsquare", F.try_divide(F.col("coef_1") * F.col("s1y") + F.col("coef_2") * F.col("s2y"), F.col("syy")))
    m = m.withColumn("intercept", F.col("my") - F.col("coef_1") * F.col("m1") - F.col("coef_2") * F.col("m2"))
    return m.where(F.col("rsquare").isNotNull() & ~F.isnan("rsquare")).select(*keys, "n", "intercept", "coef_1", "coef_2", "rsquare")


def digest(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Checksum of a group's checksums: MD5 of them sorted and joined; `n` counts all rows, null checksums add nothing.

    A group's checksums are sorted by Spark (on disk where they are many) and hashed as they stream by, so that a task needs
    constant memory whatever a group's size. MD5 takes its input in order: one group is one stream."""
    schema = StructType([*[df.schema[k] for k in keys], StructField("digest", StringType()), StructField("n", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, n, kinds = None, hashlib.md5(), 0, []

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*[pa.array([v], k) for v, k in zip(now, kinds, strict=True)], pa.array([state.hexdigest()]), pa.array([n], pa.int64())], names=schema.names)

        for batch in batches:
            kinds = [batch.column(k).type for k in keys]
            values = batch.column(column)
            rows = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True)) if keys else [()] * batch.num_rows
            at = 0
            while at < len(rows):
                end = at + 1
                while end < len(rows) and rows[end] == rows[at]:
                    end += 1
                if rows[at] != now:
                    if now is not None:
                        yield closed()
                    now, state, n = rows[at], hashlib.md5(), 0
                state.update("".join(v for v in values.slice(at, end - at).to_pylist() if v is not None).encode())
                n += end - at
                at = end
        if now is not None:
            yield closed()

    rows = df.select(*keys, F.col(column).cast("string").alias(column))
    return (rows.repartition(*keys) if keys else rows.repartition(1)).sortWithinPartitions(*keys, column).mapInArrow(run, schema)


def label_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def total_consumption(df: DataFrame, coefficients: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Total use beside fitted coefficients."""
    return coefficients.join(df.groupBy(*keys).agg(F.sum(value).alias("total_consumption")), keys)


