"""Rules that bring deliveries of reads, bills and ids to common columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import lookup, pad_id

READ_CODES = {"A": 1, "ACT": 1, "M": 1, "E": 2, "EST": 2, "P": 2, "PRO": 3, "C": 3, "S": 3, "MIS": 0}
"""Fixed values: delivered read codes. 1 actual, 2 estimated, 3 other, 0 missing."""
QC_READ_CODES = {"A": 1, "E": 2, "C": 3, "S": 3}
"""Fixed values: the fewer codes that quality checks know."""
ZONES = {"EST": "US/Eastern", "EDT": "US/Eastern", "EST5EDT": "US/Eastern", "CST": "US/Central", "CDT": "US/Central", "CST6CDT": "US/Central", "MST": "US/Mountain", "MDT": "US/Mountain", "PST": "US/Pacific", "PDT": "US/Pacific"}
"""Fixed values: short zone names."""
DIRECTIONS = {"DELIVERED": "D", "RECEIVED": "R", "NET": "N"}


@dataclass(frozen=True)
class UtcPolicy:
    """How local times become UTC: 'fixed_offset' (zone), 'already_utc' or 'column_tz' (column)."""

    kind: str
    zone: str = "Etc/GMT+5"
    column: str = "time_zone"

    def utc(self, ts: Column) -> Column:
        if self.kind == "already_utc":
            return ts.cast("timestamp")
        if self.kind == "fixed_offset":
            return F.to_utc_timestamp(ts, self.zone)
        if self.kind == "column_tz":
            return F.to_utc_timestamp(ts, F.col(self.column))
        raise ValueError(f"unknown UTC policy {self.kind}")


@dataclass(frozen=True)
class CommonReads:
    """What a tenant's deliveries need to become common reads."""

    columns: dict[str, str] = field(default_factory=dict)
    policy: UtcPolicy = UtcPolicy("already_utc")
    default_zone: str = "US/Eastern"
    codes: dict[str, int] = field(default_factory=lambda: READ_CODES)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Only the mapped columns, under their common names; text is trimmed."""
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.select(*[(F.trim(old) if old in text else F.col(old)).alias(new) for old, new in mapping.items()])


def require_ids(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows whose ids are all non-empty after trimming."""
    keep = F.lit(True)
    for c in columns:
        keep &= F.length(F.trim(c)) > 0
    return df.where(keep)


def pad_ids(df: DataFrame, columns: list[str], width: int = 20) -> DataFrame:
    """Ids padded with zeros; the delivered ones stay as raw_<column>."""
    return df.withColumns({f"raw_{c}": F.col(c) for c in columns}).withColumns({c: pad_id(F.col(c), width) for c in columns})


def restore_ids(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.col(f"raw_{c}") for c in columns}).drop(*[f"raw_{c}" for c in columns])


def normalize_direction(df: DataFrame, column: str = "direction", keep: tuple[str, ...] = ("D", "R")) -> DataFrame:
    """Long names become letters; rows of other directions go."""
    d = F.upper(F.trim(column))
    return df.withColumn(column, F.coalesce(lookup(d, DIRECTIONS), d)).where(F.col(column).isin(*keep))


def read_code(code: Column, table: dict[str, int] | None = None, trim: bool = True) -> Column:
    return lookup(F.trim(code) if trim else code, table or READ_CODES)


def time_zone(zone: Column, default: str) -> Column:
    """Short names become full ones, null the default; other names stay."""
    return F.coalesce(lookup(zone, ZONES), zone, F.lit(default))


def interval_start(end: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_timestamp(end) - seconds)


def with_day_parts(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({"year": F.year(ts).cast("short"), "month": F.month(ts).cast("short"), "day": F.dayofmonth(ts).cast("short")})


def updated_time(file_name: Column, pattern: str, replacement: str, zone: str, now: Column) -> Column:
    """A delivery's time from its name: the pattern's match, rewritten; names that give no year 20xx have `now`."""
    text = F.regexp_replace(file_name, pattern, replacement)
    return F.when(text.like("20%"), F.to_utc_timestamp(F.try_to_timestamp(text), zone)).otherwise(now)


def cast_measures(df: DataFrame) -> DataFrame:
    """Measures as numbers; text that isn't one becomes null."""
    return df.withColumns({"seconds_per_interval": F.col("seconds_per_interval").try_cast("int"), "consumption": F.col("consumption").try_cast("double"), "consumption_unit": F.upper(F.trim("consumption_unit"))})


def breakout(df: DataFrame, ts: str, prefix: str) -> DataFrame:
    return df.withColumns({f"{prefix}_date": F.to_date(ts), f"{prefix}_hour": F.hour(ts).cast("short")})


def hour_start(date: Column, hour: Column) -> Column:
    """The timestamp of an hour of a date."""
    return F.timestamp_seconds(F.unix_timestamp(date.cast("timestamp")) + hour.cast("long") * 3600)


def local_date(ts_utc: Column, zone: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(ts_utc, zone))


def common_reads(raw: DataFrame, config: CommonReads) -> DataFrame:
    """Delivered reads with an end time, as common reads: ids, direction, code, zone, UTC start and its day."""
    df = rename_columns(raw, config.columns) if config.columns else raw
    df = cast_measures(normalize_direction(df))
    df = df.withColumn("time_zone", time_zone(F.col("time_zone"), config.default_zone))
    df = df.withColumn("interval_end_utc", config.policy.utc(F.col("interval_end")))
    df = df.withColumn("interval_start_utc", interval_start(F.col("interval_end_utc"), F.col("seconds_per_interval")))
    return with_day_parts(df.withColumn("consumption_code", read_code(F.col("code"), config.codes)), "interval_start_utc")


def history(df: DataFrame, evaluation: str, days: int | None, date: Column | None = None) -> DataFrame:
    """Rows of the days before a date: `evaluation - days <= date < evaluation`, all earlier ones without days. On tables
    partitioned by year, month and day the year bound is on the partition column itself, so that it prunes."""
    end = F.lit(evaluation).cast("date")
    day = F.make_date("year", "month", "day") if date is None else date
    keep = day < end
    if date is None:
        keep &= F.col("year") <= int(evaluation[:4])
    if days is not None:
        keep &= day >= F.date_sub(end, days)
        if date is None:
            keep &= F.col("year") >= F.year(F.date_sub(end, days))
    return df.where(keep)


def shoulder_weekdays(df: DataFrame, ts: str, months: tuple[int, ...] = (3, 4, 5, 9, 10, 11)) -> DataFrame:
    """Spring and autumn, Monday to Friday."""
    return df.where(F.month(ts).isin(*months) & F.dayofweek(ts).between(2, 6))


def split_labelled(df: DataFrame, label: str, features: list[str]) -> tuple[DataFrame, DataFrame]:
    """(labelled, unlabelled) rows that have at least one feature."""
    known = df.na.drop(how="all", subset=features)
    return known.where(F.col(label).isNotNull()), known.where(F.col(label).isNull())


def with_sentinel(df: DataFrame, columns: list[str], sentinel: str = "__none__") -> DataFrame:
    return df.withColumns({c: F.coalesce(c, F.lit(sentinel)) for c in columns})


def strip_sentinel(df: DataFrame, columns: list[str], sentinel: str = "__none__") -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(c), F.lit(sentinel)) for c in columns})


def explode_nested(df: DataFrame, outer: str, inner: str, name: str) -> DataFrame:
    """One row for each item of the arrays `inner` within the array `outer`."""
    return df.withColumn(name, F.explode(F.flatten(F.transform(outer, lambda x: x[inner]))))


def bill_metrics(df: DataFrame) -> DataFrame:
    """bill_days, bill_adc (average daily consumption; null for no days), bill_midpoint and its month."""
    days = F.datediff("bill_end", "bill_start")
    df = df.withColumn("bill_days", days).withColumn("bill_adc", F.try_divide(F.col("consumption").cast("double"), F.col("bill_days")))
    df = df.withColumn("bill_midpoint", F.expr("date_add(cast(bill_start as date), cast(floor(bill_days / 2) as int))"))
    return df.withColumn("bill_month", F.month("bill_midpoint"))


def explode_bill_days(df: DataFrame) -> DataFrame:
    """One row for each date from the day after bill_start to bill_end; bills without days have none."""
    first = F.date_add(F.col("bill_start").cast("date"), 1)
    return df.where(F.datediff("bill_end", "bill_start") >= 1).withColumn("bill_date", F.explode(F.sequence(first, F.col("bill_end").cast("date"))))
