"""Atomic commits of a small table: numbered files, each of which holds the whole table and is made only if it is absent.

A commit is written beside the log first and then given its number in one step that fails if the number is taken: a hard
link on a local disk, else a rename that doesn't overwrite, which is atomic in HDFS and its like. (An object store whose
rename copies has no such step; there a log belongs in a store that has one.) A file under a number is thus always whole.
Readers take the newest number and no lock. A writer that dies leaves a hidden file or folder that nobody reads. Of two
writers that start from one state, one gets the next number, and the other reads what was committed and tries again, or
fails where both changed the same key.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NUMBERED = re.compile(r"v(\d{12})\.csv")
"""Fixed value: the name of a commit."""


class Conflict(RuntimeError):
    """Another run changed what this one wants to change, or was faster in each attempt."""


def _files(spark: SparkSession, path: str):
    """The path's file system and the path in Java."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, log: str) -> list[int]:
    """Numbers of the log's commits, oldest first."""
    fs, where = _files(spark, log)
    if not fs.exists(where):
        return []
    found = (NUMBERED.fullmatch(f.getPath().getName()) for f in fs.listStatus(where))
    return sorted(int(m[1]) for m in found if m)


def _name(log: str, version: int) -> str:
    return f"{log}/v{version:012d}.csv"


def read(spark: SparkSession, log: str, schema: str, version: int | None = None) -> tuple[int, DataFrame]:
    """The newest commit (or that version): its number and its rows. Number 0 without rows where there is none."""
    if version is None:
        version = (versions(spark, log) or [0])[-1]
    if not version:
        return 0, spark.createDataFrame([], schema)
    return version, spark.read.schema(schema).option("header", True).csv(_name(log, version))


def _claim(spark: SparkSession, source: str, target: str) -> bool:
    """Gives a finished file its final name in one step; False if the name is taken."""
    jvm = spark._jvm
    fs, to = _files(spark, target)
    if fs.getScheme() == "file":
        of = lambda p: jvm.java.nio.file.Paths.get(jvm.org.apache.hadoop.fs.Path(p).toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
        try:
            jvm.java.nio.file.Files.createLink(of(target), of(source))
            return True
        except Exception as e:
            if fs.exists(to):
                return False
            raise e
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(source), to, plain)
        return True
    except Exception as e:
        if fs.exists(to):
            return False
        raise e


def commit(spark: SparkSession, log: str, df: DataFrame, base: int) -> bool:
    """Makes df the commit after `base`; False if there is one already. Spark writes the rows (as one file), the driver only
    names it."""
    draft = f"{log}/_draft-{uuid.uuid4().hex}"
    fs, where = _files(spark, draft)
    df.coalesce(1).write.option("header", True).csv(draft)
    try:
        parts = [f.getPath().toString() for f in fs.listStatus(where) if f.getPath().getName().startswith("part-")]
        return _claim(spark, parts[0], _name(log, base + 1))
    finally:
        fs.delete(where, True)


def update(spark: SparkSession, log: str, schema: str, key: str, change: Callable[[DataFrame], DataFrame], keys: DataFrame | None = None, base: int | None = None, attempts: int = 20) -> int:
    """Commits change(rows of the newest commit) and returns the number. Where another run was faster, its rows are read and
    changed again. With `keys` (the keys that this run changes) and `base` (the commit that it started from), a key that has
    changed since then is a Conflict."""
    for _ in range(attempts):
        version, now = read(spark, log, schema)
        if base is not None and keys is not None and version > base:
            _, before = read(spark, log, schema, base)
            moved = now.exceptAll(before).select(key).union(before.exceptAll(now).select(key)).distinct().join(keys.select(key).distinct(), key, "left_semi")
            if lost := moved.limit(5).collect():
                raise Conflict(f"changed since commit {base}: {', '.join(str(r[0]) for r in lost)}")
        if commit(spark, log, change(now).orderBy(key), version):
            return version + 1
    raise Conflict(f"{attempts} other commits came first")


def prune(spark: SparkSession, log: str, keep: int) -> None:
    """Deletes all commits but the newest `keep`, of which there must be one."""
    if keep < 1:
        raise ValueError("the newest commit has to stay")
    for version in versions(spark, log)[:-keep]:
        fs, where = _files(spark, _name(log, version))
        fs.delete(where, False)


FOLDERS = "name string, folder string"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The rows of the version that the log below root names for a table; None where it names none."""
    _, folders = read(spark, f"{root}/log", FOLDERS)
    row = folders.where(F.col("name") == name).first()
    return None if row is None else spark.read.parquet(f"{root}/{row['folder']}")


def replace_table(spark: SparkSession, root: str, name: str, make: Callable[[DataFrame | None], DataFrame], attempts: int = 20) -> int:
    """Writes make(the present rows) to a new folder and commits it as the table's version. If another run commits the table
    meanwhile, the rows are made again from what it wrote, so no run's rows are lost."""
    for _ in range(attempts):
        base, folders = read(spark, f"{root}/log", FOLDERS)
        row = folders.where(F.col("name") == name).first()
        folder = f"{name}-{uuid.uuid4().hex}"
        make(None if row is None else spark.read.parquet(f"{root}/{row['folder']}")).write.parquet(f"{root}/{folder}")
        mine = spark.createDataFrame([(name, folder)], FOLDERS)
        try:
            return update(spark, f"{root}/log", FOLDERS, "name", lambda now, mine=mine: now.where(F.col("name") != name).union(mine), mine, base)
        except Conflict:
            fs, where = _files(spark, f"{root}/{folder}")
            fs.delete(where, True)
    raise Conflict(f"{name}: {attempts} other commits came first")
