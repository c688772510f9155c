"""Rule scores and classes of homes, customers and bills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import band, generalize_tag, lookup
from .rollup import event_counts, widen

# Midpoints of income ranges, point weights, thresholds and codes.
INCOMES = {"A": 7500, "B": 20000, "C": 30000, "D": 42500, "E": 62500, "F": 87500, "G": 112500, "H": 137500, "I": 162500, "J": 187500, "K": 225000, "L": 500000}
TIME_OF_USE = (
    ("has_ev_bucket between 0 and 2", 10),
    ("green_aware in (2, 3)", 6),
    ("marital_model_1 in (1, 2)", 5),
    ("total_children = 0", 5),
    ("length_residence <= 5", 4),
    ("age_1 between 40 and 70", 3),
    ("home_sq_footage between 1000 and 1800", 2),
)
TIME_OF_USE_BANDS = ((18, "high"), (10, "medium"))
MARKETPLACE = (
    ("high", "green_aware = 1 and mrtl_model_1 in ('1M', '5M')"),
    ("medium", "green_aware = 1 and mrtl_model_1 = '5S' or green_aware = 2 and mrtl_model_1 in ('1M', '5M', '5S')"),
    ("low", "green_aware in (3, 4) and mrtl_model_1 in ('1M', '5M', '5S')"),
)
GREEN_ENERGY = (
    ("high", "income >= 40 and income < 85 and coalesce(education, 0) in (0, 13, 14, 53, 54) and green_aware in (1, 2)"),
    ("medium", "income >= 30 and income < 100 and coalesce(green_aware, 0) in (0, 1, 2) and coalesce(education, 0) in (0, 12, 13, 14, 52, 53, 54)"),
    ("low", "(income >= 100 or income < 30) and green_aware in (3, 4) and coalesce(education, 0) in (0, 11, 15, 51, 55)"),
)
ENGAGEMENT = {"HBA": (4, 1), "GLOBAL": (80, 10), "CHALLENGE": (19, 1), "EHER": (11, 1), "OTHER": (3, 1)}
MAIL_EVENTS = ["OPEN", "DELIVERED", "CLICK", "UNSUBSCRIBE"]
REGIONS = {"NC": "NC-SC", "SC": "NC-SC", "FL": "FL", "OH": "MIDWEST", "KY": "MIDWEST", "IN": "MIDWEST", "MI": "MIDWEST", "IL": "MIDWEST", "IA": "MIDWEST", "PA": "PA-NY-NJ", "NY": "PA-NY-NJ", "NJ": "PA-NY-NJ"}
SEASONAL = {"NC-SC": (-1.4, -1.1, 5.0, 3.5), "FL": (-1.6, -1.1, 4.0, 3.0), "MIDWEST": (-1.5, -1.2, 5.5, 4.0), "PA-NY-NJ": (-1.5, -1.2, 6.5, 4.5)}
PROPENSITY_BANDS = ((0.6, "high"), (0.3, "medium"))
PERIODS = {"morning": range(6, 12), "afternoon": range(12, 17), "evening": range(17, 22), "night": (22, 23, 0, 1, 2, 3, 4, 5)}


def income_per_occupant(df: DataFrame) -> DataFrame:
    """Mid-range income over adults and children; homes without adults or with unknowns go."""
    d = df.select("tenant_id", "location_id", "number_of_adults", "number_of_children", lookup(F.col("income_range"), INCOMES).alias("income")).where("number_of_adults > 0").na.drop()
    return d.select("tenant_id", "location_id", F.round(F.col("income") / (F.col("number_of_adults") + F.col("number_of_children")), 0).alias("income_per_occupant"))


def weighted_score(df: DataFrame, rules: tuple[tuple[str, int], ...] = TIME_OF_USE, bands: tuple = TIME_OF_USE_BANDS, score: str = "score", name: str = "propensity") -> DataFrame:
    """Points of the rules that hold, and their band."""
    points = sum((F.when(F.expr(test), w).otherwise(0) for test, w in rules), F.lit(0))
    return df.withColumn(score, points).withColumn(name, band(F.col(score), bands, "low"))


def decision_table(df: DataFrame, rules: tuple[tuple[str, str], ...], name: str = "propensity") -> DataFrame:
    """The first outcome whose rule holds; rows without one go."""
    out: Column | None = None
    for outcome, test in rules:
        out = F.when(F.expr(test), outcome) if out is None else out.when(F.expr(test), outcome)
    return df.withColumn(name, out).where(F.col(name).isNotNull())


def engagement(events: DataFrame) -> DataFrame:
    """Engagement level per user and tag, and over all tags ('GLOBAL'), one column each; 'NA' without one. events:
    user_uuid, event_tag, event_type, external_event_id."""
    cells = event_counts(events.withColumn("tag", generalize_tag(F.col("event_tag"))), ["user_uuid", "tag"], "event_type", MAIL_EVENTS, "external_event_id")
    subscribed = cells.where("UNSUBSCRIBE is null").groupBy("user_uuid").agg(F.sum("OPEN").alias("OPEN"), F.sum("CLICK").alias("CLICK")).select("user_uuid", F.lit("GLOBAL").alias("tag"), "OPEN", "CLICK", F.lit(0).cast("long").alias("UNSUBSCRIBE"))
    gone = cells.groupBy("user_uuid").agg(F.sum("UNSUBSCRIBE").alias("u"), F.count("DELIVERED").alias("d")).where("u = d").select("user_uuid", F.lit("GLOBAL").alias("tag"), F.lit(0).cast("long").alias("OPEN"), F.lit(0).cast("long").alias("CLICK"), F.lit(1).cast("long").alias("UNSUBSCRIBE"))
    rows = cells.select("user_uuid", "tag", "OPEN", "CLICK", "UNSUBSCRIBE").unionByName(subscribed).unionByName(gone).na.fill(0)
    cut = lambda i: lookup(F.col("tag"), {k: v[i] for k, v in ENGAGEMENT.items()})
    score = F.col("OPEN") + 10 * F.col("CLICK")
    level = F.when(F.col("UNSUBSCRIBE") > 0, "unsub").when(score == 0, "never").when(score <= cut(1), "low").when(score <= cut(0), "medium").otherwise("high")
    # A user may both be gone from some tags' mails and subscribed to others; 'unsub' then wins by name order.
    best = rows.groupBy("user_uuid", "tag").agg(F.max(F.struct(F.col("UNSUBSCRIBE"), level.alias("level")))["level"].alias("level"))
    return widen(best, "user_uuid", "tag", sorted(ENGAGEMENT), "level").withColumnsRenamed({t: f"{t.lower()}_engagement_level" for t in ENGAGEMENT})


def seasonal_class(df: DataFrame, kurtosis: str = "kurtosis", ratio: str = "max_min_ratio", state: str = "state") -> DataFrame:
    """2 seasonal, 1 maybe, 0 not, by the thresholds of the state's region; 0 where the state has none."""
    region = lookup(F.col(state), REGIONS)
    k2, k1, r2, r1 = (lookup(region, {k: v[i] for k, v in SEASONAL.items()}) for i in range(4))
    k, r = F.col(kurtosis), F.col(ratio)
    yes = F.when((k < k2) & (r > r2), 2).when((k < k1) & (k >= k2) & (r > r1) & (r <= r2), 1).otherwise(0)
    return df.withColumn("is_seasonal", yes)


def band_share(df: DataFrame, name: str) -> DataFrame:
    """Rows and share of each band."""
    counts = df.groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One row of counts with sensitivity and specificity, 0 where undefined."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    cells = df.agg(F.count_if(y & p).alias("tp"), F.count_if(y & ~p).alias("fn"), F.count_if(~y & p).alias("fp"), F.count_if(~y & ~p).alias("tn"))
    ratio = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(a) + F.col(b)), F.lit(0.0))
    return cells.withColumns({"sensitivity": ratio("tp", "fn"), "specificity": ratio("tn", "fp")})


def peak_profile(wide: DataFrame, hour: str = "hod_") -> DataFrame:
    """Which period of the day uses most (flags; ties flag all), shares of the day without night, and night's share of
    all 24 hours. The periods were recovered from one published example."""
    use = {p: sum((F.coalesce(f"{hour}{h}", F.lit(0.0)) for h in hours), F.lit(0.0)) for p, hours in PERIODS.items()}
    df = wide.withColumns({f"_{p}": c for p, c in use.items()})
    most = F.greatest(*[F.col(f"_{p}") for p in PERIODS])
    day = F.col("_morning") + F.col("_afternoon") + F.col("_evening")
    flags = {f"{p}_peak": (F.col(f"_{p}") == most).cast("int") for p in PERIODS}
    shares = {f"{p}_percent_of_day": F.try_divide(F.col(f"_{p}"), day) for p in ("morning", "afternoon", "evening")}
    return df.withColumns(flags | shares | {"night_percent_of_total": F.try_divide(F.col("_night"), day + F.col("_night"))}).drop(*[f"_{p}" for p in PERIODS], *[f"{hour}{h}" for h in range(24)])


def raw_bill_fields(bills: DataFrame, accounts: DataFrame) -> DataFrame:
    """Bills with the account's external id, days and average daily consumption."""
    df = bills.join(accounts, "account_id").withColumn("bill_days", F.datediff("bill_end", "bill_start"))
    return df.withColumn("bill_adc", F.try_divide(F.col("consumption").cast("double"), F.col("bill_days")))


def clean_bills(bills: DataFrame) -> DataFrame:
    """Bills of a month as one: use over days. Bills with negative use or without days go."""
    good = bills.where((F.col("consumption") >= 0) & (F.col("bill_days") > 0))
    return good.groupBy("account_id", "fuel_type", "bill_yearmonth").agg(F.sum("consumption").alias("consumption"), F.sum("bill_days").alias("bill_days"), F.min("bill_start").alias("bill_start"), F.max("bill_end").alias("bill_end")).withColumn("bill_adc", F.col("consumption").cast("double") / F.col("bill_days"))


def match_metrics(locations: DataFrame, normalized: DataFrame, matches: DataFrame, names: tuple[str, str, str] = ("All locations", "Normalized locations", "Matched locations")) -> DataFrame:
    """Counts of locations, of normalised and of matched ones, in total, per tenant and (matches) per quality, with
    their share of all locations in percent."""
    total = locations.agg(F.count(F.lit(1)).alias("_all"))
    def rows(df: DataFrame, metric: str, sets: list[list[str]]) -> DataFrame:
        cols = sorted({c for s in sets for c in s})
        g = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols]).agg(F.count(F.lit(1)).alias("n"))
        return g.select(F.lit(metric).alias("metric_name"), F.coalesce(*[F.col(c).cast("string") for c in cols], F.lit("Total")).alias("breakdown"), "n")
    parts = [rows(locations, names[0], [["tenant_id"], []]), rows(normalized, names[1], [["tenant_id"], []]), rows(matches, names[2], [["tenant_id"], ["match_quality"], []])]
    out = parts[0].withColumn("base", F.lit(True)).unionByName(parts[1].withColumn("base", F.lit(False))).unionByName(parts[2].withColumn("base", F.lit(False)))
    return out.join(F.broadcast(total)).withColumn("pct", F.when(~F.col("base"), F.round(100.0 * F.col("n") / F.col("_all"), 2))).drop("base", "_all")


def weekday_profile(hourly: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Mean use of each hour of the day from Monday to Friday, as hod_0 to hod_23."""
    df = hourly.where(F.dayofweek(ts).between(2, 6))
    return df.groupBy(*keys).agg(*[F.avg(F.when(F.hour(ts) == h, F.col(value))).alias(f"hod_{h}") for h in range(24)])


def disagg_bills(bills: DataFrame, min_bills: int = 3, hot: float = 65.0) -> DataFrame:
    """The latest bill of an account and fuel against the least of its others: what is above is heating or, where the
    bill's mean temperature is at least `hot`, cooling. The rule is inferred from one published example. bills:
    account_id, fuel_type, bill_start, consumption, temp_f."""
    one = bills.dropDuplicates(["account_id", "fuel_type", "bill_start"])
    w = Window.partitionBy("account_id", "fuel_type")
    df = one.withColumns({"n": F.count(F.lit(1)).over(w), "base": F.min("consumption").over(w), "_last": F.max("bill_start").over(w)}).where((F.col("n") >= min_bills) & (F.col("bill_start") == F.col("_last")))
    above = F.greatest(F.col("consumption") - F.col("base"), F.lit(0.0))
    cool = F.when(F.col("temp_f") >= hot, above).otherwise(0.0)
    return df.select("account_id", "fuel_type", "bill_start", F.col("consumption").alias("total"), (above - cool).alias("heating"), cool.alias("cooling"), (F.col("consumption") - above).alias("other"), F.try_divide(above, F.col("consumption")).alias("weather_share"))


def disagg_hourly(reads: DataFrame, weather: DataFrame, cold: float = 50.0, hot: float = 80.0) -> DataFrame:
    """Per location, mean hourly use in parts: always on (the least hour), heating and cooling (above the mean of mild
    hours at the same hour of day, in cold and hot hours), other. Hours without weather go. reads: location_id, ts,
    consumption (one row per channel and hour); weather: location_id, ts, temp_f."""
    hours = reads.groupBy("location_id", "ts").agg(F.sum("consumption").alias("kwh")).join(weather, ["location_id", "ts"]).withColumn("hour", F.hour("ts"))
    mild = F.avg(F.when(F.col("temp_f").between(cold, hot), F.col("kwh"))).over(Window.partitionBy("location_id", "hour"))
    extra = F.greatest(F.col("kwh") - F.col("mild"), F.lit(0.0))
    df = hours.withColumn("mild", mild)
    out = df.groupBy("location_id").agg(F.count(F.lit(1)).alias("n_hours"), F.avg("kwh").alias("total"), F.min("kwh").alias("always_on"), F.coalesce(F.sum(F.when(F.col("temp_f") < cold, extra)), F.lit(0.0)).alias("_h"), F.coalesce(F.sum(F.when(F.col("temp_f") > hot, extra)), F.lit(0.0)).alias("_c"))
    out = out.withColumns({"heating": F.col("_h") / F.col("n_hours"), "cooling": F.col("_c") / F.col("n_hours")}).drop("_h", "_c")
    return out.withColumn("other", F.col("total") - F.col("always_on") - F.col("heating") - F.col("cooling"))


def select_events(events: DataFrame, tenants: DataFrame, date: str, start: str = "start_time_utc") -> tuple[DataFrame, DataFrame]:
    """(events of a date with their tenant's columns, tenants without one)."""
    day = events.where(F.to_date(start) == F.lit(date).cast("date")).join(tenants, "tenant")
    return day, tenants.join(day, "tenant", "left_anti")
