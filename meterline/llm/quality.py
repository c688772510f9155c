"""Quality rules as a short-circuit cascade, in SQL functions only.

Every rule computes what it needs from the text. How long that takes and how many rows it rejects are measured on a sample
chosen by hash, on the executors; rules then run in order of rejection per time, and a row that one rule rejects skips the
rest. A machine may measure another order than the next one; the order changes only the work, never a verdict
(`rejected_by` names the first rule of that order).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents
from .mixing import SPACES

SYMBOLS = "#*$%&|<>"
"""Fixed value: characters that count as symbols."""
SAMPLE = 1000
"""Rows that costs and selectivities are estimated on, about; no verdict depends on it."""


REPEATS = 5
"""Times that a rule is timed on a row of the sample; the least counts, so that compiling and pauses don't."""


@dataclass(frozen=True)
class Rule:
    """rejects: whether a row fails, never null."""

    name: str
    rejects: Column


@dataclass(frozen=True)
class Measured:
    """What a rule took on the sample, in nanoseconds, and how many rows it rejects."""

    rule: Rule
    cost: float
    rejected: int


def once(value: Column, use) -> Column:
    """use(value), with value computed a single time."""
    return F.element_at(F.transform(F.array(value), use), 1)


def repeat_words(hashes: Column) -> Column:
    """Words in windows of three that are found twice or more in the text, from the hashes of its words."""
    triples = F.transform(F.sequence(F.lit(0), F.size(hashes) - 3), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)))

    def covered(t: Column) -> Column:
        placed = F.sort_array(F.transform(t, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = F.flatten(F.transform(F.array(placed), lambda p: F.transform(F.filter(p, lambda x, j: (x["h"] == F.get(p, j - 1)["h"]) | (x["h"] == F.get(p, j + 1)["h"])), lambda x: x["i"])))
        width = F.flatten(F.transform(F.array(F.sort_array(twice)), lambda p: F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1) - x, F.lit(3))))))
        return F.aggregate(width, F.lit(0), lambda a, x: a + x)

    n = F.element_at(F.transform(F.array(triples), lambda t: F.when(F.size(F.array_distinct(t)) == F.size(t), 0).otherwise(covered(t))), 1)
    return F.when(F.size(hashes) >= 3, n).otherwise(0).cast("long")


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def word_chars(found: Column) -> Column:
    """Code points in words."""
    return F.length(F.array_join(found, "")).cast("long")


def n_symbols(text: Column) -> Column:
    symbol = f"[{''.join(chr(92) + c for c in SYMBOLS)}]"
    return F.when(text.rlike(symbol), F.length(text) - F.length(F.regexp_replace(text, symbol, ""))).otherwise(0).cast("long")


def lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def n_dup_lines(found: Column) -> Column:
    return (F.size(found) - F.size(F.array_distinct(found))).cast("long")


def measures(text: Column) -> tuple[Column, Column, Column]:
    """For a text that is not null: (n_words, word_chars, n_repeat_words) in one struct, n_symbols, n_dup_lines."""

    def of(found: Column) -> Column:
        repeated = once(F.transform(found, lambda w: F.xxhash64(w)), repeat_words)
        return F.struct(F.size(found).cast("long").alias("n_words"), word_chars(found).alias("word_chars"), repeated.alias("n_repeat_words"))

    return once(words(text), of), n_symbols(text), n_dup_lines(lines(text))


def base_failed(words: Column, repeated: Column) -> Column:
    return (words < 50) | (100 * repeated > 50 * words)


def rules(text: Column, known: bool = False) -> list[Rule]:
    """The rules for a text that is not null. Where the columns of quality_cascade are there (known), rules compare those;
    else they compute what they need."""
    n, chars = (F.col("n_words"), F.col("word_chars")) if known else (F.size(words(text)), word_chars(words(text)))
    symbols = F.col("n_symbols") if known else n_symbols(text)
    return [
        Rule("letters", 2 * F.length(F.regexp_replace(text, r"[^\p{L}\p{M}]+", "")) < chars),
        Rule("lines", once(lines(text), lambda x: (n_dup_lines(x) > 3) & (2 * n_dup_lines(x) > F.size(x)))),
        Rule("symbols", 10 * symbols > n),
        Rule("word_length", (chars < 2 * n) | (chars > 20 * n)),
    ]


def measure(docs: DataFrame, checks: list[Rule], by: Column, sample: int = SAMPLE, repeats: int = REPEATS) -> list[Measured]:
    """Each rule's time and rejections. The sample: rows whose hash of `by` is below a share of the range that about `sample`
    rows have (an action counts rows, another one times). The clock is read before and after a rule within one expression,
    which is evaluated from left to right; of a row's repeats the least time counts, and times of rows add up."""
    n = docs.count()
    share = min(1.0, sample / n) if n else 1.0
    few = docs.where(F.pmod(F.xxhash64(by), F.lit(1 << 30)) < int(share * (1 << 30)))
    clock = F.java_method(F.lit("java.lang.System"), F.lit("nanoTime")).cast("long")
    again = few.withColumn("_row", F.monotonically_increasing_id()).withColumn("_turn", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    timed = again.select("_row", *[F.struct(clock.alias("a"), c.rejects.alias("no"), clock.alias("b")).alias(f"_{i}") for i, c in enumerate(checks)])
    rows = timed.groupBy("_row").agg(*[F.min(F.col(f"_{i}.b") - F.col(f"_{i}.a")).alias(f"t{i}") for i in range(len(checks))], *[F.bool_or(f"_{i}.no").alias(f"r{i}") for i in range(len(checks))])
    found = rows.agg(*[F.sum(f"t{i}").alias(f"t{i}") for i in range(len(checks))], *[F.count_if(f"r{i}").alias(f"r{i}") for i in range(len(checks))]).first()
    return [Measured(c, float(found[f"t{i}"] or 0), found[f"r{i}"]) for i, c in enumerate(checks)]


def order_rules(docs: DataFrame, checks: list[Rule], by: Column, sample: int = SAMPLE) -> list[Rule]:
    """checks by rejection per cost as measured, most first; ties by cost and name."""
    ranked = sorted(measure(docs, checks, by, sample), key=lambda m: (-m.rejected / m.cost if m.cost else 0.0, m.cost, m.rule.name))
    return [m.rule for m in ranked]


def cascade(base: Column, checks: list[Rule]) -> Column:
    """'base', the name of the first rule that rejects, or null. Rules after that one are not evaluated."""
    verdict = F.when(base, "base")
    for rule in checks:
        verdict = verdict.when(rule.rejects, rule.name)
    return verdict


def quality_cascade(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept and rejected_by ('base', a
    rule's name, or null).

    A null text has no words, lines or symbols, so the base fails; each row is judged alone, so repeated rows agree; an
    empty table gives an empty table. Columns of docs named like the new ones are replaced."""
    new = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by")
    docs = docs.drop(*[c for c in new if c != text])
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    keep = [c for c in docs.columns if c not in new]
    of_words, symbols, dup_lines = measures(F.col("body"))
    # A struct keeps the caller's columns apart from the ones computed here.
    rows = docs.select(F.struct(*keep).alias("row"), body.alias("body"))
    measured = rows.select("row", "body", of_words.alias("w"), symbols.alias("n_symbols"), dup_lines.alias("n_dup_lines")).select("row", "body", "w.*", "n_symbols", "n_dup_lines")
    checks = order_rules(measured, rules(F.col("body"), True), F.col("body"), sample)
    out = measured.withColumn("base_failed", base_failed(F.col("n_words"), F.col("n_repeat_words"))).withColumn("rejected_by", cascade(F.col("base_failed"), checks))
    return out.withColumn("kept", F.col("rejected_by").isNull()).select("row.*", *[c for c in new if c != "rejected_by"], "rejected_by")


def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return quality_cascade(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
