"""Document fingerprints: threshold-scaled sketches.

A sketch keeps every shingle hash below a fixed fraction of the hash range, so sketches of documents of any size can be
compared and merged: shared hashes over one side's hashes estimate containment, over all hashes the Jaccard likeness.
Sketches of very unequal sides, such as a document and a whole source, compare by rows of hashes. Everything is built
from SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, documents, keyed, unkeyed
from .mixing import SPACES

SHINGLE = 5
SCALE = 4
"""One shingle hash in this many is kept."""


def words(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def sketch(text: Column, shingle: int = SHINGLE, scale: int = SCALE) -> Column:
    """Sorted, distinct hashes below the threshold. A text of fewer words than a shingle is one shingle; one without
    words has none."""
    limit = -(1 << 63) + (1 << 64) // scale
    hashes = F.transform(words(text), lambda w: F.xxhash64(w))

    def shingles(h: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(h) - shingle), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(shingle)]))
        return F.when(F.size(h) >= shingle, every).when(F.size(h) > 0, F.array(F.xxhash64(F.concat_ws(",", F.transform(h, lambda x: x.cast("string")))))).otherwise(F.array().cast("array<bigint>"))

    # A one-element array holds the hashes so that they are computed once.
    kept = F.flatten(F.transform(F.array(hashes), lambda h: F.filter(shingles(h), lambda x: x < F.lit(limit).cast("bigint"))))
    return F.sort_array(F.array_distinct(kept))


def fingerprint(text: Column, hashes: Column) -> Column:
    """A sketch as a string: the first 16 hex digits of the text's MD5, then each hash in hex."""
    return F.concat(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 16), F.lit(":"), F.array_join(F.transform(hashes, lambda x: F.lower(F.hex(x))), ","))


def likeness(a: Column, b: Column, same: Column) -> Column:
    """Jaccard likeness that two sketches estimate. Where both are empty it is 1 for equal texts, else 0."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(same, 1.0).when(union == 0, 0.0).otherwise(shared / union)


def containment(a: Column, b: Column) -> Column:
    """Share of a's shingles that b has too; null where a's sketch is empty."""
    return F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(a))


def merged(a: Column, b: Column) -> Column:
    """The sketch of both documents' shingles."""
    return F.sort_array(F.array_union(a, b))


def group_containment(docs: DataFrame, by: str = "source", text: str = "text") -> DataFrame:
    """doc_id, group, size, inside: for each document with a sketch, the share of its shingles that occurs in other
    documents of each group (a value of `by`) that shares any; `size` counts its sketch.

    The merged sketch of a group is a row for each hash of it, with the number of its documents; none is gathered. Null
    texts have no sketch; each row is a document of its own; null is a group; an
    empty table gives an empty table."""
    tagged = cut(docs.select("doc_id", F.col(by).alias("by"), F.col(text).alias("text")).withColumn("key", F.monotonically_increasing_id()))
    found = tagged.select("key", "by", sketch(F.col("text")).alias("s")).where(F.size("s") > 0)
    hashes = cut(found.select("key", "by", F.size("s").alias("size"), F.explode("s").alias("hash")))
    groups = hashes.groupBy("hash", "by").agg(F.count(F.lit(1)).alias("n"))
    shared = hashes.join(groups.select("hash", F.col("by").alias("group"), F.col("n").alias("others")), "hash")
    mine = F.col("by").eqNullSafe(F.col("group"))
    counted = shared.where(F.col("others") > mine.cast("int")).groupBy("key", "group", "size").agg((F.count(F.lit(1)) / F.first("size")).alias("inside"))
    return unkeyed(counted, tagged.select("key", "doc_id"))


def next_keys(rows: DataFrame) -> DataFrame:
    """(key, half, next): each key's next lower one (the lowest's is the highest), and half its text's length, from keys
    and lengths alone. Keys are sorted in ranges; a key's number is its range's and its place there, and one row for each
    range tells where the next begins."""
    ranked = cut(rows.select("key", F.floor(F.length("text") / 2).cast("int").alias("half")).repartitionByRange(F.col("key").desc()).sortWithinPartitions(F.col("key").desc()).withColumn("id", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("id", 33)
    last = ranked.groupBy(part.alias("part")).agg(F.min("id").alias("begin"), F.max("id").alias("last"))
    over = Window.orderBy("part")
    follow = last.select("last", F.coalesce(F.lead("begin").over(over), F.min("begin").over(Window.partitionBy())).alias("follow"))
    # `follow` has at most one row for each shuffle partition.
    numbered = ranked.join(F.broadcast(follow), F.col("id") == F.col("last"), "left").select("key", "half", F.coalesce("follow", F.col("id") + 1).alias("id"))
    return numbered.join(ranked.select("id", F.col("key").alias("next")), "id").select("key", "half", "next")


def edited(text: Column, following: Column) -> Column:
    """The last half of the code points gives way to as many from the start of the next text, or all it has."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(following, F.lit(1), half))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, in_edited, in_next for each
    row of docs; the last two: the share of its shingles that the edited text and the next document contain (null for an
    empty sketch).

    A null text is empty. doc_id null or repeated: see common.keyed, which gives the order. A lone row is its own next.
    An empty table gives an empty table; other columns are ignored."""
    rows, ids = keyed(docs, text)
    rows = rows.select("key", F.coalesce("text", F.lit("")).alias("text"))
    links = next_keys(rows)
    # Sketches are made where they are needed: shipping one with each text would cost more disk than making it again.
    made = rows.select("key", "text").repartition("key")
    # What a document's predecessor needs of it: the start of its text, its name and its sketch.
    start = F.substring(F.col("text"), F.lit(1), F.col("half"))
    ahead = made.join(links.select(F.col("key").alias("to"), "half", F.col("next").alias("key")), "key").select("to", start.alias("head"), F.md5("text").alias("next_name"), sketch(F.col("text")).alias("c"))
    pairs = made.join(ahead, F.col("key") == F.col("to")).withColumn("edited", edited(F.col("text"), F.col("head")))
    out = pairs.withColumns({"a": sketch(F.col("text")), "b": sketch(F.col("edited")), "name": F.md5("text")}).select(
        "key",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), F.col("a")).alias("fingerprint"),
        fingerprint(F.col("edited"), F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b"), F.col("text") == F.col("edited")).alias("near_edited"),
        likeness(F.col("a"), F.col("c"), F.col("name") == F.col("next_name")).alias("near_next"),
        containment(F.col("a"), F.col("b")).alias("in_edited"),
        containment(F.col("a"), F.col("c")).alias("in_next"),
    )
    return unkeyed(out, ids)


def op3_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))
