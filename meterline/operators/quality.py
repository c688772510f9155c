"""Data quality: checks, reconciliations and service reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Check:
    step: int
    metric: int
    name: str
    left: str
    right: str
    message: str
    errors: str


# The catalogue of checks.
CHECKS = (
    Check(1, 1, "file count", "manifest file count", "audit file count", "audit file count does not match manifest", "file_mismatch = 1"),
    Check(1, 2, "line count", "manifest line count", "audit line count", "audit line count does not match manifest", "linecount_mismatch = 1"),
    Check(1, 3, "checksums", "manifest checksums", "audit checksums", "checksum of audit checksum list does not match manifest", "checksum_mismatch = 1"),
    Check(2, 1, "all raw ami channels processed", "raw ami channel count", "channel ingest channel count", "raw ami channels missing from channel ingest output", "no_output = 1"),
    Check(2, 2, "no distinct raw ami channels mapped to multiple channel uuids", "multiple mapped channels expected", "multiple mapped channels count", "distinct raw ami channels mapped to multiple channel uuids", "is_multi"),
    Check(2, 3, "channel uuids in success output are mapped correctly", "channel ingest success count", "correctly mapped channels", "channel uuids in success output incorrectly mapped", "success = 1 AND uuid_match = 0"),
    Check(3, 1, "all raw ami reads processed", "raw ami read count", "extract total read count", "raw ami read count != extract total read count", "raw_count != out_count"),
    Check(4, 1, "all ingestable reads loaded", "extract success read count", "load metadata count", "extract success read count != load metadata count", "delta != 0"),
    Check(5, 1, "raw hourly totals match rollups", "raw hourly rollups", "hourly rollups", "raw hourly rollups != hourly rollups", "qc_status = 0"),
    Check(6, 1, "raw daily totals match rollups", "raw daily rollups", "daily rollups", "raw daily rollups != daily rollups", "qc_status = 0"),
    Check(7, 1, "ingest time under 24 hours", "ingest under 24 hours expected", "ingest under 24 hours actual", "ingest time is greater than 24 hours", "qc_status = 0"),
)
STEPS = {1: "Decrypt", 2: "Channel Ingest", 3: "Extract", 4: "Load", 5: "Hourly Rollup", 6: "Daily Rollup", 7: "Ingest Time"}
SERVICE_CLASS = {1: "completeness", 2: "completeness", 3: "completeness", 4: "completeness", 5: "accuracy", 6: "accuracy", 7: "currency"}


def catalogue(spark: SparkSession, checks: tuple[Check, ...] = CHECKS) -> DataFrame:
    return spark.createDataFrame([(c.step, STEPS[c.step], c.metric, c.name, c.message, c.errors) for c in checks], "step int, step_name string, metric int, metric_name string, message string, errors string")


def evaluate(left: DataFrame, right: DataFrame, check: Check) -> DataFrame:
    """One row from two one-row frames (column `value`): status 1 if they are equal, delta, and the message if not."""
    a, b = left.select(F.col("value").alias("left_value")), right.select(F.col("value").alias("right_value"))
    df = a.join(F.broadcast(b)).withColumns({"step": F.lit(check.step), "metric": F.lit(check.metric), "name": F.lit(check.name)})
    same = F.coalesce(F.col("left_value") == F.col("right_value"), F.lit(False))
    return df.withColumns({"status": same.cast("int"), "delta": F.col("left_value") - F.col("right_value"), "message": F.when(~same, check.message)})


def error_rows(df: DataFrame, check: Check) -> DataFrame:
    return df.where(check.errors)


def as_metrics_json(df: DataFrame) -> DataFrame:
    """Evaluated metrics of a step as one JSON text of name -> {status, left, right}, in the order of metrics."""
    item = F.struct("metric", F.struct("name", "status", "left_value", "right_value").alias("v"))
    return df.groupBy("step").agg(F.to_json(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["v"])).alias("metrics"))


def reconcile_manifest(manifest: DataFrame, audit: DataFrame, key: str = "file_name", header_lines: int = 0) -> DataFrame:
    """Files of the manifest beside the audit's, with mismatch flags; a missing checksum mismatches. Both: key,
    line_count, checksum; the manifest's counts may include header lines."""
    a = audit.select(key, F.col("line_count").alias("audit_lines"), F.col("checksum").alias("audit_checksum"), F.lit(True).alias("_in"))
    df = manifest.join(a, key, "left")
    off = F.coalesce(F.col("line_count") - header_lines != F.col("audit_lines"), F.lit(True))
    return df.withColumns({"file_mismatch": F.col("_in").isNull().cast("int"), "linecount_mismatch": off.cast("int"), "checksum_mismatch": F.coalesce(F.col("checksum") != F.col("audit_checksum"), F.lit(True)).cast("int")}).drop("_in")


def reconcile_files(encrypted: DataFrame, decrypted: DataFrame, audit: DataFrame, key: str = "file_name") -> DataFrame:
    """Encrypted files with flags: not decrypted, not audited."""
    df = encrypted.select(key).distinct()
    for name, other in (("decrypt", decrypted), ("audit", audit)):
        df = df.join(other.select(key).distinct().withColumn("_in", F.lit(1)), key, "left").withColumn(f"no_{name}", F.col("_in").isNull().cast("int")).drop("_in")
    return df


def latest_audit(audit: DataFrame, status: str = "DECRYPT_SUCCESS") -> DataFrame:
    """Rows of a status from the newest ingest date."""
    newest = audit.agg(F.max("ingest_date").alias("ingest_date"))
    return audit.where(F.col("status") == status).join(F.broadcast(newest), "ingest_date")


def reconcile_channels(raw: DataFrame, success: DataFrame, errors: DataFrame, known: DataFrame, quad: list[str]) -> DataFrame:
    """Raw quads with flags: success, error, no_output, uuid_match (as the known map has it) and is_multi."""
    df = raw.select(*quad).distinct()
    df = df.join(success.select(*quad, "channel_uuid").distinct(), quad, "left").join(errors.select(*quad).distinct().withColumn("_e", F.lit(1)), quad, "left")
    df = df.join(known.select(*quad, F.col("channel_uuid").alias("known_uuid")).distinct(), quad, "left")
    ok, bad = F.col("channel_uuid").isNotNull(), F.col("_e").isNotNull()
    many = F.count(F.lit(1)).over(Window.partitionBy(*quad)) > 1
    flags = {"success": ok.cast("int"), "error": bad.cast("int"), "no_output": (~ok & ~bad).cast("int"), "uuid_match": F.coalesce(F.col("channel_uuid") == F.col("known_uuid"), F.lit(False)).cast("int"), "is_multi": many}
    return df.withColumns(flags).drop("_e")


def reconcile_reads(raw: DataFrame, success: DataFrame, errors: DataFrame, keys: list[str]) -> DataFrame:
    """Read counts per key: raw beside what came out well or as errors; one shuffle."""
    kinds = {"raw_count": raw, "success_count": success, "error_count": errors}
    rows = None
    for name, df in kinds.items():
        one = df.select(*keys, F.lit(name).alias("_kind"))
        rows = one if rows is None else rows.unionByName(one)
    out = rows.groupBy(*keys).agg(*[F.count_if(F.col("_kind") == n).alias(n) for n in kinds])
    return out.withColumn("out_count", F.col("success_count") + F.col("error_count")).withColumn("is_match", F.col("raw_count") == F.col("out_count"))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in the schema's order and types; text that doesn't fit its type becomes null, missing columns are null."""
    return df.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name, metadata=f.metadata) for f in schema.fields])


def violations(df: DataFrame, schema: StructType) -> DataFrame:
    """One row per column with how many values break its nullability or maxlength."""
    rows = []
    for f in schema.fields:
        bad = F.lit(False) if f.nullable else F.col(f.name).isNull()
        if "maxlength" in (f.metadata or {}):
            bad |= F.coalesce(F.length(f.name) > f.metadata["maxlength"], F.lit(False))
        rows.append(F.struct(F.lit(f.name).alias("column_name"), F.count_if(bad).alias("n")))
    return df.agg(F.array(*rows).alias("r")).select(F.explode("r").alias("r")).select("r.*")


def compare(df: DataFrame, left: str, right: str, tolerance: float = 1e-5) -> DataFrame:
    """qc_status 1 where the values differ by less than the tolerance; 0 otherwise, also where one is null."""
    return df.withColumn("qc_status", F.coalesce((F.abs(F.col(left) - F.col(right)) < tolerance).cast("int"), F.lit(0)))


def unpivot_hours(wide: DataFrame, keys: list[str], prefix: str = "kwh_h", count: int = 24, first: int = 0, name: str = "hour_utc", value: str = "rollup_kwh") -> DataFrame:
    cells = ", ".join(f"{i}, {prefix}{i:02d}" for i in range(first, first + count))
    return wide.select(*keys, F.expr(f"stack({count}, {cells}) as ({name}, {value})"))


def check_rollup(raw: DataFrame, wide: DataFrame, keys: list[str], tolerance: float = 1e-5) -> DataFrame:
    """Raw sums (keys, hour_utc, raw_kwh) beside the wide table's hours; complete hours only."""
    long = unpivot_hours(wide, keys).where("rollup_kwh is not null")
    return compare(long.join(raw, [*keys, "hour_utc"], "left"), "raw_kwh", "rollup_kwh", tolerance)


def check_ingest_time(df: DataFrame, start: str, end: str, most: int = 86400) -> DataFrame:
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    return df.withColumn("ingest_seconds", seconds).withColumn("qc_status", F.coalesce((F.col("ingest_seconds") <= most).cast("int"), F.lit(0)))


def profile_extract(df: DataFrame, ts: str, value: str, error: str) -> DataFrame:
    """One row: reads, errors, first and last date, total."""
    good = F.col(error).isNull()
    return df.agg(F.count_if(good).alias("reads"), F.count_if(~good).alias("errors"), F.to_date(F.min(F.when(good, F.col(ts)))).alias("min_date"), F.to_date(F.max(F.when(good, F.col(ts)))).alias("max_date"), F.sum(F.when(good, F.col(value))).alias("total"))


METRIC = "array<struct<name:string,status:int,left_value:string,right_value:string>>"


def qc_report(results: DataFrame) -> DataFrame:
    """Step results (step, execution_date, metrics as JSON) as rows with an ordering key and a service class."""
    rows = results.select("step", "execution_date", F.posexplode(F.from_json("metrics", METRIC)).alias("pos", "m"))
    items = [F.lit(x) for kv in SERVICE_CLASS.items() for x in kv]
    return rows.select("execution_date", "step", (F.col("step") * 100 + F.col("pos") + 1).alias("ordering"), F.try_element_at(F.create_map(*items), F.col("step")).alias("service_class"), "m.*")


def sla_report(report: DataFrame, uningestable: Column | int, execution_date: str) -> DataFrame:
    """The report's accuracy, completeness and currency rows and one row that counts what can't be ingested."""
    extra = report.select(F.lit(execution_date).alias("execution_date")).limit(1).select("execution_date", F.lit(999).alias("ordering"), F.lit("completeness").alias("service_class"), F.lit("uningestable reads").alias("name"), F.lit(1).alias("status"), F.lit(uningestable).cast("string").alias("left_value"), F.lit("0").alias("right_value"))
    return report.select("execution_date", "ordering", "service_class", "name", "status", "left_value", "right_value").unionByName(extra)


def upsert_history(history: DataFrame, today: DataFrame, key: str) -> DataFrame:
    """The history without the keys that today's rows have, and today's rows."""
    return history.join(today.select(key).distinct(), key, "left_anti").unionByName(today)


def sanity_checks(files: DataFrame, counts: DataFrame, quota: int = 15) -> DataFrame:
    """Per day: enough files came, and raw reads are the ingested and uningested ones. counts: day, raw, ingested,
    uningested."""
    per = files.groupBy("day").agg(F.count_distinct("file_name").alias("file_count"))
    df = counts.join(per, "day", "left").withColumn("file_count", F.coalesce("file_count", F.lit(0)))
    return df.withColumns({"files_ok": F.col("file_count") >= quota, "reads_ok": F.col("raw") == F.col("ingested") + F.col("uningested")})


def fail_digest(report: DataFrame) -> DataFrame:
    """Failed metrics with '{left : right}', split in service and other ones."""
    detail = F.concat(F.lit("{"), F.col("left_value"), F.lit(" : "), F.col("right_value"), F.lit("}"))
    return report.where("status = 0").select("ordering", "name", detail.alias("detail"), F.when(F.col("service_class").isNotNull(), "SLA").otherwise("non-SLA").alias("kind"))


def combine_results(*steps: DataFrame) -> DataFrame:
    out = steps[0]
    for s in steps[1:]:
        out = out.unionByName(s)
    return out.orderBy("step", "metric")
