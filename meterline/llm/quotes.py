"""Chat formatting by quotation linking, in SQL functions only.

Lines that begin with '>' are quotes; the number of markers is their level. A passage is a run of lines of one level. Its
lines are normalised and hashed, and it is joined to the last message before, in its conversation, that wrote the same
lines in a row (runs are hashed only where a passage's first line occurs); where nobody did, each of its lines is joined
to the last message that wrote it. A message answers the
one that its shallowest level with links quotes most lines of (the latest of equals). Answers are followed to where
their thread begins, which with the turn gives the order to read in, and the bodies lose their quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, with_group
from .quality import once

BLOCK = 1024
"""Turns of a conversation that are sorted together, at most."""
EDGES = r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$"


def quote_level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, r"^([> \t]*>)?", 0), "[^>]", ""))


def normal(line: Column) -> Column:
    """A line without quote marks, case, punctuation or white space."""
    return F.regexp_replace(F.lower(F.regexp_replace(line, r"^[> \t]*>", "")), r"[^\p{L}\p{N}]+", "")


def lines(text: Column) -> Column:
    """(level, line, hash) of each line; the hash of a line without letters or digits is null."""

    def entry(x: Column) -> Column:
        return F.struct(quote_level(x).alias("level"), x.alias("line"), once(normal(x), lambda bare: F.when(bare != "", F.xxhash64(bare))).alias("hash"))

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), entry)


def hashes(found: Column) -> Column:
    return F.transform(F.filter(found, lambda x: x["hash"].isNotNull()), lambda x: x["hash"])


def passages(found: Column) -> Column:
    """(level, hashes) of each run of lines of one level above 0, from lines()."""
    places = F.sequence(F.lit(0), F.size(found) - 1)
    edge = lambda i, j: F.coalesce(F.get(found, i)["level"] != F.get(found, j)["level"], F.lit(True))
    starts = F.filter(places, lambda i: (F.get(found, i)["level"] > 0) & edge(i, i - 1))
    ends = F.filter(places, lambda i: (F.get(found, i)["level"] > 0) & edge(i, i + 1))
    runs = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda r: F.struct(F.get(found, r["s"])["level"].alias("level"), hashes(F.slice(found, r["s"] + 1, r["e"] - r["s"] + 1)).alias("hashes")))
    return F.filter(runs, lambda r: F.size(r["hashes"]) > 0)


def parsed(messages: DataFrame, text: str = "text") -> DataFrame:
    """conv_id, turn, own (hashes of the message's own lines), quotes (its passages), for rows with both keys."""
    both = once(lines(F.col(text)), lambda x: F.struct(hashes(F.filter(x, lambda y: y["level"] == 0)).alias("own"), passages(x).alias("quotes")))
    return messages.where("conv_id is not null and turn is not null").select("conv_id", F.col("turn").cast("long").alias("turn"), both.alias("found")).select("conv_id", "turn", "found.*")


def last_before(marks: DataFrame) -> DataFrame:
    """(conv_id, turn, hash, wrote) -> conv_id, turn, hash, source for rows that did not write: the last turn before that
    wrote the hash. Turns meet in blocks and blocks in one row each, so no task sorts all that share a hash."""
    marks = marks.distinct().withColumn("block", F.floor(F.col("turn") / BLOCK)).withColumn("at", F.when(F.col("wrote"), F.col("turn")))
    here = Window.partitionBy("conv_id", "hash", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = marks.withColumn("near", F.max("at").over(here)).where(~F.col("wrote"))
    ahead = Window.partitionBy("conv_id", "hash").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    far = marks.groupBy("conv_id", "hash", "block").agg(F.max("at").alias("at")).select("conv_id", "hash", "block", F.max("at").over(ahead).alias("far"))
    return near.join(far, ["conv_id", "hash", "block"]).select("conv_id", "turn", "hash", F.coalesce("near", "far").alias("source")).where("source is not null")


def wrote_runs(known: DataFrame, quoted: DataFrame) -> DataFrame:
    """conv_id, turn, hash of the runs of own lines that a passage of the conversation may quote: those that begin with the
    first line of a passage of two lines or more, and are as long. quoted: conv_id, hashes.

    A line meets the passages that begin with it as one row, which holds their different lengths; so what is made follows
    the lines that begin a passage, whatever other passages there are."""
    at = lambda c: F.xxhash64("conv_id", c).alias("at")
    firsts = quoted.where(F.size("hashes") > 1).groupBy(at(F.get("hashes", F.lit(0)))).agg(F.collect_set(F.size("hashes")).alias("sizes"))
    places = known.select("conv_id", "turn", F.posexplode("own").alias("place", "line")).select("conv_id", "turn", "place", at("line"))
    often = places.groupBy("at").agg(F.count(F.lit(1)).alias("n"))
    met = with_group(places, firsts.join(often, "at"), "at", "turn").groupBy("conv_id", "turn").agg(F.collect_list(F.struct("place", "sizes")).alias("met"))
    at_hand = known.join(met, ["conv_id", "turn"])
    run = lambda x: F.transform(F.filter(x["sizes"], lambda k: x["place"] + k <= F.size("own")), lambda k: F.xxhash64(F.slice("own", x["place"] + 1, k)))
    return at_hand.select("conv_id", "turn", F.explode(F.array_distinct(F.flatten(F.transform("met", run)))).alias("hash"))


def quote_links(known: DataFrame) -> DataFrame:
    """conv_id, turn, level, source, n: how many lines a message quotes at a level from a message before it; from
    parsed(). A line that a level quotes twice counts twice."""
    quoted = known.where(F.size("quotes") > 0).select("conv_id", "turn", F.posexplode("quotes").alias("no", "q")).select("conv_id", "turn", "no", "q.*", F.xxhash64("q.hashes").alias("hash"))
    parts = quoted.select("conv_id", "turn", "no", "level", "hash", F.size("hashes").alias("n"), F.explode("hashes").alias("line")).withColumn("line", F.xxhash64(F.array("line")))
    asked = parts.select("conv_id", "turn", F.explode(F.array("hash", "line")).alias("hash"), F.lit(False).alias("wrote"))
    talks = known.join(quoted.select("conv_id").distinct(), "conv_id", "left_semi")
    single = talks.select("conv_id", "turn", F.explode(F.array_distinct(F.transform("own", lambda x: F.xxhash64(F.array(x))))).alias("hash"))
    wrote = single.union(wrote_runs(talks, quoted)).withColumn("wrote", F.lit(True))
    found = cut(last_before(wrote.union(asked)))
    whole = found.select("conv_id", "turn", "hash", F.col("source").alias("whole"))
    single = found.select("conv_id", "turn", F.col("hash").alias("line"), F.col("source").alias("single"))
    linked = parts.join(whole, ["conv_id", "turn", "hash"], "left").join(single, ["conv_id", "turn", "line"], "left")
    return linked.withColumn("source", F.coalesce("whole", "single")).where("source is not null").groupBy("conv_id", "turn", "level", "source").agg(F.count(F.lit(1)).alias("n"))


def roots(tree: DataFrame) -> DataFrame:
    """conv_id, turn, root of each (conv_id, turn, parent), by pointer jumping; parents come before their children, so
    each round halves the way and the rounds end."""
    jumps = tree.withColumnRenamed("parent", "root")
    while True:
        up = jumps.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("further"))
        new = cut(jumps.join(up, ["conv_id", "root"], "left").select("conv_id", "turn", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        jumps = new.drop("moved")
        if not new.where("moved").head(1):
            return jumps


def link_quotes(messages: DataFrame, text: str = "text") -> DataFrame:
    """conv_id, turn, role, n_quoted, depth, parent_turn, root_turn, body for each row of messages.

    Sorted by conv_id, root_turn, turn, rows read as threads in which every reply follows what it answers. A message
    that quotes nothing known has no parent and begins a thread. Null texts are empty; rows with a null conv_id or turn
    have no parent; rows that share both are one message for linking and separate rows in the result; an empty table
    gives an empty table; other columns are ignored."""
    rows = messages.select("conv_id", "turn", "role", F.col(text).alias("text"))
    best = quote_links(cut(parsed(rows))).groupBy("conv_id", "turn").agg(F.max_by("source", F.struct(-F.col("level"), "n", "source")).alias("parent"))
    tree = cut(best.select("conv_id", "turn", "parent"))
    linked = tree.join(roots(tree), ["conv_id", "turn"])

    def shown(x: Column) -> Column:
        own = F.transform(F.filter(x, lambda y: y["level"] == 0), lambda y: y["line"])
        return F.struct(
            F.size(F.filter(x, lambda y: y["level"] > 0)).cast("long").alias("n_quoted"),
            F.array_max(F.transform(x, lambda y: y["level"])).alias("depth"),
            F.regexp_replace(F.array_join(own, "\n"), EDGES, "").alias("body"),
        )

    return rows.join(linked, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "role", once(lines(F.col("text")), shown).alias("shown"), F.col("parent").alias("parent_turn"), F.coalesce("root", "turn").alias("root_turn")
    ).select("conv_id", "turn", "role", "shown.n_quoted", "shown.depth", "parent_turn", "root_turn", "shown.body")


def op7_quote_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_quotes(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
