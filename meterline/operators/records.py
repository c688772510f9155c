"""Records of five text lines that describe one meter's day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import once

TYPES = ("00000001", "00000002", "00000003", "00000004", "10000000")
"""Fixed values: the first field of each line."""
FIELDS = (7, 14, 2, 3)
STAMP = "yyyyMMddHHmmss"


def assemble_records(lines: DataFrame, key: str, order: str, text: str, name: str = "record") -> DataFrame:
    """Lines that are numbered within a record, as arrays in that order. Unnumbered text is read record by record
    (sources.io.read_records): line order is lost in any shuffle."""
    rows = F.array_sort(F.collect_list(F.struct(order, text)))
    return lines.groupBy(key).agg(F.transform(rows, lambda x: x[text]).alias(name))


def reading(text: Column) -> Column:
    """(value, ok): blank is no value, text that begins '0-.' is 0, other text that is no number isn't ok."""
    bare = F.trim(text)
    value = F.when(bare.startswith("0-."), F.lit(0.0)).otherwise(bare.try_cast("double"))
    blank = text.isNull() | (bare == "")
    return F.struct(F.when(~blank, value).alias("value"), (blank | value.isNotNull()).alias("ok"))


def parse_records(records: DataFrame, lines: str = "record") -> DataFrame:
    """One row per reading, or one with error_type: MALFORMED (lines, fields or types are wrong), CHANNEL (not 1),
    VALUE_ERROR (a reading is no number), RANGE (readings go beyond the end). Every third value is a reading, as many as
    intervals fit the part of the window that is below a day."""
    field = lambda line, i: F.get(F.get(line[0], F.lit(line[1])), F.lit(i))
    stamp = lambda x: F.unix_timestamp(F.try_to_timestamp(x, F.lit(STAMP)))

    def fields(cut: Column) -> Column:
        """What the lines' fields say, each computed once."""
        at = lambda line, i: field((cut, line - 1), i)
        size = lambda line: F.coalesce(F.size(F.get(cut, F.lit(line - 1))), F.lit(-1))
        whole = (size(1) == FIELDS[0]) & (size(2) == FIELDS[1]) & (size(3) >= FIELDS[2]) & (size(4) == FIELDS[3]) & (size(5) > 1)
        for i, t in enumerate(TYPES):
            whole &= at(i + 1, 0) == t
        return F.struct(
            at(1, 1).alias("service_point_id"),
            at(1, 2).try_cast("int").alias("channel"),
            stamp(at(1, 3)).alias("start"),
            stamp(at(1, 4)).alias("end"),
            at(2, 7).try_cast("int").alias("seconds"),
            at(2, 13).alias("time_zone"),
            at(3, 1).alias("account_id"),
            at(4, 2).alias("code"),
            F.get(cut, F.lit(4)).alias("last"),
            (whole & (F.size(cut) == 5)).alias("whole"),
        )

    def judged(p: Column) -> Column:
        whole = F.coalesce(p["whole"] & p["channel"].isNotNull() & p["start"].isNotNull() & p["end"].isNotNull() & (p["seconds"] > 0), F.lit(False))
        most = F.ceil(F.pmod(p["end"] - p["start"], F.lit(86400)) / p["seconds"]).cast("int")
        every = F.filter(F.slice(p["last"], F.lit(2), F.greatest(F.size(p["last"]) - 1, F.lit(0))), lambda x, i: i % 3 == 0)
        return once(F.when(whole, F.transform(F.slice(every, F.lit(1), most), reading)), lambda r: F.struct(p.alias("p"), r.alias("readings"), error(p, r).alias("error_type")))

    def error(p: Column, r: Column) -> Column:
        last = p["start"] + (F.size(r) - 1) * p["seconds"]
        return (
            F.when(r.isNull(), "MALFORMED")
            .when(p["channel"] != 1, "CHANNEL")
            .when(F.exists(r, lambda x: ~x["ok"]), "VALUE_ERROR")
            .when((F.size(r) == 0) | (last >= p["end"]), "RANGE")
        )

    parsed = once(F.transform(lines, lambda x: F.split(x, ",")), lambda cut: once(fields(cut), judged))
    df = records.select(F.col(lines).alias("record"), parsed.alias("x")).select("record", "x.*")
    none = F.array(F.lit(None).cast("struct<value:double,ok:boolean>"))
    out = df.select("*", F.posexplode(F.when(F.col("error_type").isNull(), F.col("readings")).otherwise(none)).alias("i", "r"))
    good = F.col("error_type").isNull()
    keep = lambda c, *but: F.when(good | F.col("error_type").isin(*but), F.col(f"p.{c}")) if but else F.when(good, F.col(f"p.{c}"))
    return out.select(
        keep("service_point_id", "CHANNEL", "VALUE_ERROR", "RANGE").alias("service_point_id"),
        keep("account_id", "VALUE_ERROR", "RANGE").alias("account_id"),
        F.when(good, F.timestamp_seconds(F.col("p.start") + F.col("i") * F.col("p.seconds"))).alias("timestamp"),
        F.col("r.value").alias("consumption"),
        F.when(good, "KWH").alias("consumption_unit"),
        keep("seconds").alias("seconds_per_interval"),
        keep("time_zone").alias("time_zone"),
        keep("code").alias("code"),
        "error_type",
        F.when(~good, F.array_join("record", "|")).alias("error_record"),
    )


def split_parsed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    return parsed.where("error_type is null"), parsed.where("error_type is not null")
