"""Linking external ids to accounts, locations and channels, and other joins."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_RULES: tuple[tuple[int, str, str], ...] = (
    (5241, "n_accounts > 1", "concat(n_accounts, ' account matches')"),
    (4041, "account_uuid is null", "'Unmatched account hub id'"),
    (5141, "is_inactive", "'Inactive account'"),
    (5242, "n_locations > 1", "concat(n_locations, ' location matches')"),
    (4042, "location_uuid is null", "'Unmatched external location/premise id'"),
    (5243, "n_channels > 1", "concat(n_channels, ' channel matches')"),
    (4043, "channel_uuid is null", "'Unmatched channel'"),
)
"""Fixed codes: (code, when, message), the first that holds counts."""
OTHER_ERROR = (5000, "Unknown error")


def resolve_channels(ids: DataFrame, accounts: DataFrame, locations: DataFrame, channels: DataFrame, quad: list[str]) -> DataFrame:
    """External ids to uuids by three left joins: account; location, also of that account; channel, also of that location
    and direction. Counts of distinct matches per quad come from one aggregate over it.

    ids: quad columns incl. external_account_id, external_location_id, direction. accounts: external_account_id,
    account_uuid, is_inactive. locations: external_location_id, account_uuid, location_uuid. channels: location_uuid,
    direction, channel_uuid."""
    df = ids.join(accounts, "external_account_id", "left").join(locations, ["external_location_id", "account_uuid"], "left").join(channels, ["location_uuid", "direction"], "left")
    parts = ("account", "location", "channel")
    counts = df.groupBy(*quad).agg(*[F.count_distinct(f"{p}_uuid").alias(f"n_{p}s") for p in parts])
    same = reduce(lambda a, b: a & b, [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in quad])
    return df.alias("l").join(counts.alias("r"), same).select("l.*", *[f"r.n_{p}s" for p in parts])


def resolve_via_alias(ids: DataFrame, aliases: DataFrame, accounts: DataFrame, locations: DataFrame, channels: DataFrame, quad: list[str]) -> DataFrame:
    """As resolve_channels, with accounts found by an alias (alias_id, external_account_id) of the delivered one."""
    named = ids.withColumnRenamed("external_account_id", "alias_id").join(aliases, "alias_id", "left")
    return resolve_channels(named.withColumn("external_account_id", F.coalesce("external_account_id", "alias_id")), accounts, locations, channels, quad)


def resolve_by_account(ids: DataFrame, tree: DataFrame, default_zone: str) -> DataFrame:
    """Ids with only an account: its location and channel if it has one of each, else counts tell what is ambiguous. The
    account's zone stands in where the delivered one is null or shorter than three letters."""
    per = tree.groupBy("external_account_id").agg(
        F.min("account_uuid").alias("account_uuid"),
        F.min("location_uuid").alias("location_uuid"),
        F.min("channel_uuid").alias("channel_uuid"),
        F.count_distinct("location_uuid").alias("n_locations"),
        F.count_distinct("channel_uuid").alias("n_channels"),
        F.min("time_zone").alias("known_zone"),
    )
    df = ids.join(per, "external_account_id", "left")
    own = F.when(F.length("time_zone") >= 3, F.col("time_zone"))
    single = (F.col("n_locations") == 1) & (F.col("n_channels") == 1)
    return df.withColumn("time_zone", F.coalesce(own, "known_zone", F.lit(default_zone))).withColumns({c: F.when(single, F.col(c)) for c in ("location_uuid", "channel_uuid")}).drop("known_zone")


def resolution(df: DataFrame) -> DataFrame:
    """status: 'ok' for one account and location, active, with a channel; 'incomplete' where only the channel lacks;
    else 'error'."""
    one = (F.col("n_accounts") == 1) & (F.col("n_locations") == 1) & ~F.coalesce("is_inactive", F.lit(False))
    return df.withColumn("status", F.when(one & (F.col("n_channels") == 1), "ok").when(one & (F.col("n_channels") == 0), "incomplete").otherwise("error"))


def split_resolved(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ok, incomplete, error): filters of one frame, which the caller may keep if it reads it more than once."""
    flagged = resolution(df)
    return tuple(flagged.where(F.col("status") == s) for s in ("ok", "incomplete", "error"))


def classify_errors(df: DataFrame, rules: tuple[tuple[int, str, str], ...] = ERROR_RULES) -> DataFrame:
    """error_code and error_message by the first rule that holds."""
    code, text = None, None
    for number, when, message in rules:
        test = F.expr(when)
        code = F.when(test, number) if code is None else code.when(test, number)
        text = F.when(test, F.expr(message)) if text is None else text.when(test, F.expr(message))
    return df.withColumns({"error_code": code.otherwise(OTHER_ERROR[0]), "error_message": text.otherwise(OTHER_ERROR[1])})


def attach_channel(reads: DataFrame, channel_map: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """(reads with their channel, reads without one). Sizes decide at run time whether the map is broadcast."""
    df = reads.join(channel_map, on, "left")
    return df.where("channel_uuid is not null"), df.where("channel_uuid is null")


def explain_unmatched(unmatched: DataFrame, errors: DataFrame, on: list[str]) -> DataFrame:
    """Unmatched reads with the least code that the ingest of their ids gave; 5000 without one."""
    known = errors.groupBy(*on).agg(F.min(F.struct("error_code", "error_message")).alias("_e"))
    df = unmatched.join(known, on, "left")
    return df.withColumns({"error_code": F.coalesce("_e.error_code", F.lit(OTHER_ERROR[0])), "error_message": F.coalesce("_e.error_message", F.lit(OTHER_ERROR[1]))}).drop("_e")


def link_documents(documents: DataFrame, linkage: DataFrame, channels: DataFrame, meter: str) -> DataFrame:
    """Documents to channels over a linkage of meters; unlinked meters go."""
    return documents.join(linkage, F.col(meter) == linkage["meter_id"]).join(channels, "linkage_id")


def interval_join(left: DataFrame, starts: DataFrame, keys: list[str], ts: str, start: str, seconds: int) -> DataFrame:
    """Pairs with equal keys and start <= ts < start + seconds. Both sides also meet on a time slot as long as the bound:
    a start covers its own slot and the next, so a pair meets once and no key's whole history does."""
    slot = lambda c: F.floor(F.unix_micros(c) / (seconds * 1_000_000))
    right = starts.withColumn("_slot", F.explode(F.array(slot(start), slot(start) + 1)))
    df = left.withColumn("_slot", slot(ts)).join(right, [*keys, "_slot"]).drop("_slot")
    age = F.unix_micros(ts) - F.unix_micros(start)
    return df.where((age >= 0) & (age < seconds * 1_000_000))


def join_bills_weather(bills: DataFrame, locations: DataFrame, weather: DataFrame) -> DataFrame:
    """Bill days with weather: a bill's place is its location, or its account's where it has no channel; then (date,
    postal code). bills has one row a day (bill_date)."""
    own = locations.select("location_id", "postal_code")
    by_account = locations.groupBy("account_id").agg(F.min("postal_code").alias("postal_code"))
    placed = bills.where("channel_id is not null").join(own, "location_id").unionByName(bills.where("channel_id is null").join(by_account, "account_id"))
    return placed.join(weather, (placed["bill_date"] == weather["date_local"]) & (placed["postal_code"] == weather["postal_code"])).drop(weather["postal_code"])


def label_participants(population: DataFrame, members: DataFrame, on: str, label: str = "label") -> DataFrame:
    """1 for members, 0 for the others."""
    flag = members.select(F.col(on)).distinct().withColumn("_in", F.lit(1))
    return population.join(flag, on, "left").withColumn(label, F.coalesce("_in", F.lit(0))).drop("_in")


def widen_fuels(df: DataFrame, keys: list[str], kind: str, names: dict[str, str], values: list[str]) -> DataFrame:
    """Two kinds of rows side by side; a key may lack either."""
    sides = [df.where(F.col(kind) == k).select(*keys, *[F.col(v).alias(f"{p}_{v}") for v in values]) for k, p in names.items()]
    return sides[0].join(sides[1], keys, "full")


def assemble_features(base: DataFrame, on: str, *tables: DataFrame) -> DataFrame:
    """base with the columns of tables that have one row for each key."""
    return reduce(lambda a, b: a.join(b, on, "left"), tables, base)


def reconcile_counts(a: DataFrame, b: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """Both sides' counts for each key of either, zeros where one lacks it, and the difference."""
    return a.join(b, keys, "full").withColumns({c: F.coalesce(c, F.lit(0)) for c in (left, right)}).withColumn("delta", F.col(left) - F.col(right))


@dataclass(frozen=True)
class Suppression:
    score: str = "score"
    multi_family: str = "multi_family"
    address: str = "address"
    truth: str = "truth"


def suppress_scores(df: DataFrame, c: Suppression = Suppression()) -> DataFrame:
    """-1 for multi-family homes, lots, missing scores and known truth."""
    hide: Column = F.coalesce(F.col(c.multi_family), F.lit(False)) | F.coalesce(F.upper(c.address).contains("LOT"), F.lit(False)) | F.col(c.score).isNull() | F.col(c.truth).isNotNull()
    return df.withColumn(c.score, F.when(hide, F.lit(-1.0)).otherwise(F.col(c.score)))


