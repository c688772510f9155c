"""Operators over ordered rows: odometers, load boxes, ranks and curves."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import ROWS_A_RANGE, ranged

from .linking import interval_join


def odometer_to_interval(df: DataFrame, keys: list[str], ts: str, reading: str, max_seconds: int | None = 3600) -> DataFrame:
    """What was used until the next reading; a key's last reading and longer gaps go. Falling readings give negative
    use."""
    w = Window.partitionBy(*keys).orderBy(ts)
    df = df.withColumns({"consumption": F.lead(reading).over(w) - F.col(reading), "interval_seconds": F.unix_timestamp(F.lead(ts).over(w)) - F.unix_timestamp(ts)}).where("consumption is not null")
    return df if max_seconds is None else df.where(F.col("interval_seconds") <= max_seconds)


def with_prior_days(df: DataFrame, touched: DataFrame, date: str) -> DataFrame:
    """Rows of touched dates and of the day before each."""
    days = touched.select(F.explode(F.array(F.col(date), F.date_sub(date, 1))).alias(date)).distinct()
    return df.join(days, date, "left_semi")


@dataclass(frozen=True)
class Boxes:
    """Fixed values of the load-box rules by interval seconds."""

    start_jump: dict[int, float] = field(default_factory=lambda: {3600: 3.0, 1800: 0.8, 900: 0.4})
    min_length: dict[int, int] = field(default_factory=lambda: {3600: 2, 1800: 2, 900: 3})
    end_change: float = -0.2
    max_seconds: int = 14400
    missed_weeks: float = 0.5
    this_year: float = 0.5

    def by_interval(self, table: dict) -> Column:
        items = [F.lit(x) for kv in table.items() for x in kv]
        return F.try_element_at(F.create_map(*items), F.col("seconds_per_interval"))


WEEK = ["channel_uuid", "seconds_per_interval", "year", "week_of_year"]


def with_week(df: DataFrame, ts: str = "interval_start_utc") -> DataFrame:
    return df.withColumns({"year": F.year(ts), "week_of_year": F.weekofyear(ts)})


def box_starts(df: DataFrame, c: Boxes = Boxes()) -> DataFrame:
    """Reads that jump above the one before in their channel's week."""
    w = Window.partitionBy(*WEEK).orderBy("interval_start_utc")
    jump = F.col("consumption") - F.lag("consumption").over(w)
    return df.withColumn("jump", jump).where(F.col("jump") > c.by_interval(c.start_jump)).select(*WEEK, F.col("interval_start_utc").alias("box_start"), F.col("consumption").alias("start_consumption"))


def box_rows(df: DataFrame, c: Boxes = Boxes()) -> DataFrame:
    """Reads from each start until the first that falls, within the longest box."""
    pairs = interval_join(df.select(*WEEK, "interval_start_utc", "consumption"), box_starts(df, c), WEEK, "interval_start_utc", "box_start", c.max_seconds)
    w = Window.partitionBy(*WEEK, "box_start").orderBy("interval_start_utc").rowsBetween(Window.unboundedPreceding, 0)
    falls = F.coalesce(F.try_divide("consumption", "start_consumption") - 1 < c.end_change, F.lit(False)).cast("int")
    return pairs.withColumn("_over", F.max(falls).over(w)).where("_over = 0").drop("_over")


def box_stats(df: DataFrame, c: Boxes = Boxes()) -> DataFrame:
    """Per channel and week: mean length in intervals, mean use and number of boxes that are long enough."""
    boxes = box_rows(df, c).groupBy(*WEEK, "box_start").agg(F.count(F.lit(1)).alias("n"), F.max("interval_start_utc").alias("last"), F.sum("consumption").alias("kwh"))
    boxes = boxes.where(F.col("n") > c.by_interval(c.min_length)).withColumn("length", F.unix_timestamp("last") - F.unix_timestamp("box_start"))
    return boxes.groupBy(*WEEK).agg((F.avg("length") / F.col("seconds_per_interval")).alias("week_mean_duration"), F.avg("kwh").alias("week_mean_consumption"), F.count(F.lit(1)).alias("week_box_count"))


def ev_features(weekly: DataFrame, boxes: DataFrame, evaluation_year: int, c: Boxes = Boxes(), keep_empty_weeks: bool = False) -> DataFrame:
    """Per channel and interval: means over weeks and a heuristic score, detection frequency over history weight. weekly:
    WEEK, kurtosis, skewness, peak, week_start. Weeks without boxes go unless they are asked for."""
    df = weekly.join(boxes, WEEK, "left" if keep_empty_weeks else "inner")
    found, weeks = F.count("week_box_count"), F.count(F.lit(1))
    first = F.year(F.min("week_start"))
    frequency = F.when(found == weeks, found / c.missed_weeks).otherwise(found / (weeks - found))
    weight = F.when(first == evaluation_year, F.lit(c.this_year)).otherwise((evaluation_year - first).cast("double"))
    means = {"mean_duration": "week_mean_duration", "mean_consumption": "week_mean_consumption", "mean_box_count": "week_box_count", "mean_kurtosis": "kurtosis", "mean_skewness": "skewness", "mean_peak": "peak"}
    out = df.groupBy("channel_uuid", "seconds_per_interval").agg(*[F.avg(v).alias(k) for k, v in means.items()], F.try_divide(frequency, weight).alias("heuristic_score"))
    return out.withColumn("interval_minutes", F.col("seconds_per_interval") / 60).drop("seconds_per_interval")


def complete_channels(df: DataFrame, low: float = 0.6, high: float = 1.0) -> DataFrame:
    """Rows of channels that have more than `low` and at most `high` of the intervals between their first and last."""
    keys = ["channel_uuid", "seconds_per_interval"]
    per = df.select(*keys, "interval_start_utc").distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min("interval_start_utc").alias("lo"), F.max("interval_start_utc").alias("hi"))
    share = F.col("n") / ((F.unix_timestamp("hi") - F.unix_timestamp("lo")) / F.col("seconds_per_interval") + 1)
    return df.join(per.where((share > low) & (share <= high)).select(*keys), keys, "left_semi")


def complete_rollup_channels(daily: DataFrame, share: float = 0.9, days: int = 100) -> DataFrame:
    """Rows of channels with more than `share` actual reads over a span of more than `days`."""
    per = daily.groupBy("channel_uuid").agg(F.sum("num_reads_actual").alias("a"), F.sum("num_reads_total").alias("t"), F.datediff(F.max("date_local"), F.min("date_local")).alias("span"))
    return daily.join(per.where((F.try_divide("a", "t") > share) & (F.col("span") > days)).select("channel_uuid"), "channel_uuid", "left_semi")


def top_channel(df: DataFrame, keys: list[str], total: str) -> DataFrame:
    """Rows with the greatest total of their keys; ties stay."""
    best = df.groupBy(*keys).agg(F.max(total).alias("_best"))
    return df.join(best, keys).where(F.col(total) == F.col("_best")).drop("_best")


def bucketize(df: DataFrame, group: str, key: str, score: str, owner: str, n: int = 5, rows: int = ROWS_A_RANGE) -> DataFrame:
    """bucket: 1 (highest scores) to n of equal sizes within each group; -1 without a score, 0 for owners.

    Rows are written in ranges of group and score, about `rows` in each; a range is ranked by one task, and counts of the
    ranges say where each starts in its group."""
    flag = F.when(F.coalesce(F.col(owner), F.lit(False)), 0).when(F.col(score).isNull(), -1)
    dealt = ranged(df.where(flag.isNull()), [F.col(group), F.col(score).desc(), F.col(key)], rows)
    of = Window.partitionBy("_of")
    starts = dealt.groupBy(F.col(group).alias("_of"), F.col("_part").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(of.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = starts.select("_of", "_at", before.alias("_before"), F.sum("_n").over(of).alias("_total"))
    own = Window.partitionBy(group, "_part").orderBy(F.col(score).desc(), F.col(key))
    place = F.col("_before") + F.row_number().over(own)
    placed = dealt.join(starts, F.col(group).eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_at"))).withColumn("bucket", F.ceil(place * n / F.col("_total")).cast("int"))
    return placed.select(*df.columns, "bucket").unionByName(df.where(flag.isNotNull()).withColumn("bucket", flag))


def roc_curve(df: DataFrame, label: str, score: str, by: list[str] | None = None, rows: int = ROWS_A_RANGE) -> DataFrame:
    """tpr and fpr from the highest score down, one row for each distinct score, also of groups.

    Distinct scores are written in ranges of about `rows` of them: sums run within a range, and the ranges' own sums (a row
    for each range and group in it) say where each starts."""
    by = by or []
    points = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*by, score).agg(F.sum((F.col(label) == 1).cast("long")).alias("pos"), F.sum((F.col(label) != 1).cast("long")).alias("neg"))
    df = ranged(points, [*map(F.col, by), F.col(score).desc()], rows)
    of = Window.partitionBy(*[f"_of_{c}" for c in by])
    before = of.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*[F.col(c).alias(f"_of_{c}") for c in by], F.col("_part").alias("_at")).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    sums = sums.withColumns({"_p0": F.coalesce(F.sum("_p").over(before), F.lit(0)), "_n0": F.coalesce(F.sum("_n").over(before), F.lit(0)), "_pos": F.sum("_p").over(of), "_neg": F.sum("_n").over(of)})
    same = F.col("_part") == F.col("_at")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    w = Window.partitionBy(*by, "_part").orderBy(F.col(score).desc())
    df = df.join(sums, same).withColumns({"tp": F.sum("pos").over(w) + F.col("_p0"), "fp": F.sum("neg").over(w) + F.col("_n0")})
    return df.select(*by, score, "pos", "neg", "tp", "fp", F.try_divide(F.col("tp"), F.col("_pos")).alias("tpr"), F.try_divide(F.col("fp"), F.col("_neg")).alias("fpr"))


def eval_metrics(df: DataFrame, label: str, score: str, by: list[str] | None = None, fpr: float = 0.1, top: float = 0.1) -> DataFrame:
    """One row (for each group): n, Brier score over all, positives and negatives, AUC, tpr at an fpr, and precision of the
    `top` share of rows (ties of the last score included)."""
    by = by or []
    curve = roc_curve(df, label, score, by)
    # A positive beats the negatives below it and half of those at its score.
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    error = F.pow(F.col(score) - F.col(label), 2)
    brier = known.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(error).alias("brier"), F.avg(F.when(F.col(label) == 1, error)).alias("brier_pos"), F.avg(F.when(F.col(label) != 1, error)).alias("brier_neg"))
    total = curve.groupBy(*by).agg(F.max("tp").alias("P"), F.max("fp").alias("N"))
    on = (lambda a, b: a.join(b, by)) if by else (lambda a, b: a.withColumn("_one", F.lit(1)).join(F.broadcast(b.withColumn("_one", F.lit(1))), "_one").drop("_one"))
    c = on(curve, total)
    wins = F.sum(F.col("pos") * (F.col("N") - F.col("fp") + 0.5 * F.col("neg")))
    reach = F.col("tp") + F.col("fp") - F.col("pos") - F.col("neg") < F.ceil(top * (F.col("P") + F.col("N")))
    out = c.groupBy(*by).agg(
        F.try_divide(wins, F.max(F.col("P") * F.col("N")).cast("double")).alias("auc"),
        F.coalesce(F.max(F.when(F.col("fpr") <= fpr, F.col("tpr"))), F.lit(0.0)).alias("tpr_at_fpr"),
        F.try_divide(F.max(F.when(reach, F.col("tp"))), F.max(F.when(reach, F.col("tp") + F.col("fp")))).alias("precision_at_top"),
    )
    return on(brier, out)


def flag_multi(df: DataFrame, keys: list[str], name: str = "is_multi") -> DataFrame:
    return df.withColumn(name, F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1)
