"""Personal data by bootstrapped contextual extraction, in SQL functions only.

Four kinds have base patterns (email, ip, card, phone). Other identifiers are learned: words with several digits are
instances; an instance's neighbours on the left (one word or two), on the right, and its line up to it, each with its own
shape, and its left neighbour and its shape alone, are its lexical patterns. Instances that overlap base spans, and those
that a caller names, are seeds. Patterns are scored by the confidence of their instances and instances by the best of their
patterns, in turns; instances of high-confidence patterns become spans of kind `id` and are seeds of the next turns, with the
confidence they were found with, until no more are found (an action looks). Contexts that no seed has, directly or by way of
what was found, teach nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, documents, keyed, unkeyed, with_group, with_key
from .quality import once

KINDS = ("email", "ip", "card", "phone", "id")
"""Fixed order of kinds at one start."""
PATTERNS = {
    # The texts of the four base patterns, with look-behinds and possessive quantifiers that find the same matches without
    # trying a run of characters again from each of its places.
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9][0-9 -]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LONE = r"[ -](?![0-9])|(?<![0-9])[ -]"
"""A space or hyphen that isn't between two digits."""
WORD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
BLOCK = 256
"""Code points; words and spans meet by the blocks that they touch."""
ROUNDS = 3
SUPPORT = 3
CONFIDENCE = 0.5


def before_each(values: Column, start: int, add) -> Column:
    """What comes out before each element when `add` runs over values from the left. Two levels of blocks of 64 keep the
    work near to linear."""
    total = lambda part: F.aggregate(part, F.lit(start), add)
    blocks = lambda v: F.transform(F.filter(F.sequence(F.lit(0), F.size(v) - 1), lambda i: i % 64 == 0), lambda i: total(F.slice(v, i + 1, 64)))

    def each(v: Column, one: Column, two: Column) -> Column:
        far = lambda i: F.slice(two, F.lit(1), F.floor(i / 4096).cast("int"))
        mid = lambda i: F.slice(one, (F.floor(i / 4096) * 64 + 1).cast("int"), (F.floor(i / 64) % 64).cast("int"))
        near = lambda i: F.slice(v, (F.floor(i / 64) * 64 + 1).cast("int"), i % 64)
        return F.transform(v, lambda _, i: add(add(total(far(i)), total(mid(i))), total(near(i))))

    return F.when(F.size(values) > 0, once(values, lambda v: once(blocks(v), lambda one: once(blocks(one), lambda two: each(v, one, two))))).otherwise(F.array().cast("array<int>"))


NEAR = 64
"""Characters before and after a word that its context is made of."""


def found(text: Column, pattern: str, lead: bool = False) -> Column:
    """(s, e, hit, lead, tail) of all matches, in code points: lengths of what lies between the matches and of the matches
    add up. lead, tail: the NEAR characters before and after a match, to the start of the match before it and the end of
    the one after it at most."""
    none = F.array().cast("array<struct<s:int,e:int,hit:string,lead:string,tail:string>>")
    nothing = F.lit("")

    def placed(pieces: Column, hits: Column) -> Column:
        def entry(at: Column, i: Column) -> Column:
            piece, hit = F.get(pieces, i), F.get(hits, i)
            s = at + F.length(piece)
            ahead = F.substring(F.concat(F.coalesce(F.get(hits, i - 1), nothing), piece), -NEAR, NEAR) if lead else nothing
            after = F.substring(F.concat(F.coalesce(F.get(pieces, i + 1), nothing), F.coalesce(F.get(hits, i + 1), nothing)), 1, NEAR) if lead else nothing
            return F.struct(s.alias("s"), (s + F.length(hit)).alias("e"), hit.alias("hit"), ahead.alias("lead"), after.alias("tail"))

        sizes = F.transform(hits, lambda h, i: F.length(F.get(pieces, i)) + F.length(h))
        return F.transform(before_each(sizes, 0, lambda a, x: a + x), entry)

    parts = F.struct(F.split(text, pattern).alias("p"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("h"))
    return F.when(text.rlike(pattern), once(parts, lambda x: placed(x["p"], x["h"]))).otherwise(none)


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes: from the right, every second digit is doubled and its digits added."""

    def value(i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.transform(F.sequence(F.lit(0), F.length(number) - 1), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def base_spans(text: Column) -> dict[str, Column]:
    """Arrays of (s, e, hit) by kind."""
    ip = F.filter(found(text, PATTERNS["ip"]), lambda x: F.forall(F.split(x["hit"], r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$")))
    many = text.rlike("(?:[0-9][ -]?){14}")
    flat = F.when(many, F.regexp_replace(text, LONE, "x")).otherwise("")
    card = F.filter(found(flat, PATTERNS["card"]), lambda x: F.length(digits(x["hit"])).between(14, 19) & F.when(F.length(digits(x["hit"])).between(14, 19), luhn(digits(x["hit"]))).otherwise(False))
    phone = F.filter(found(text, PATTERNS["phone"]), lambda x: F.length(digits(x["hit"])).between(10, 15))
    return {"email": found(text, PATTERNS["email"]), "ip": ip, "card": card, "phone": phone}


CONTEXT = "s:int,e:int,core:string,before:string,two:string,after:string,line:string,shape:string"


def candidates(text: Column) -> Column:
    """(s, e, core, before, two, after, line, shape) of words with four digits or more; s and e without signs around them.
    before, two, after: one and two words on the left, one on the right. line: what stands before the word in its line, if
    the line begins within reach. Two is empty where there is one word only, and so on; contexts are in lower case."""
    core = lambda x: F.regexp_extract(x["hit"], r"[A-Za-z0-9](?:.*[A-Za-z0-9])?", 0)
    space, word = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"

    def entry(x: Column) -> Column:
        s = x["s"] + F.instr(x["hit"], core(x)) - 1
        lead = F.lower(x["lead"])
        part = lambda of, pattern: F.regexp_extract(of, pattern, 1)
        shape = F.when(core(x).rlike("^[0-9a-f]{16,}$"), "hex").otherwise(F.substring(F.regexp_replace(F.regexp_replace(core(x), "[0-9]+", "9"), r"\p{L}+", "a"), 1, 8))
        contexts = {"before": part(lead, f"({word}*){space}*$"), "two": part(lead, f"({word}+{space}+{word}+){space}*$"), "after": part(F.lower(x["tail"]), f"^{space}*({word}+)"), "line": part(lead, r"\n([^\n]+)$")}
        return F.struct(s.alias("s"), (s + F.length(core(x))).alias("e"), core(x).alias("core"), *[c.alias(n) for n, c in contexts.items()], shape.alias("shape"))

    own = F.filter(found(text, WORD, lead=True), lambda x: F.length(digits(x["hit"])) >= 4)
    return F.when(text.rlike("[0-9]"), F.transform(own, entry)).otherwise(F.array().cast(f"array<struct<{CONTEXT}>>"))


def tagged(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("kind"), x["e"].alias("e")))


def counted(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")


def scanned(rows: DataFrame) -> DataFrame:
    """(key, spans, words): base spans (s, kind, e) and candidate words of each text."""
    text = F.coalesce("text", F.lit(""))
    base = base_spans(text)
    spans = F.concat(*[tagged(base[k], i) for i, k in enumerate(KINDS[:4])])
    return rows.select("key", F.sort_array(spans).alias("spans"), candidates(text).alias("words"))


def learned(scan: DataFrame, rounds: int = ROUNDS, support: int = SUPPORT, confidence: float = CONFIDENCE, seeds: Sequence[str] = ()) -> DataFrame:
    """(key, s, e) of instances that high-confidence patterns discover, from scanned(). `rounds`: turns between two looks for
    new ones; what isn't found in them begins the next turns without confidence, so that patterns don't raise themselves.
    A shape alone is scored by what is known only, as it says little. `seeds`: identifiers that are known for sure, besides
    what base spans hold; they are found wherever they stand, and about a fourth of a context's instances teach the context.

    Equal identifiers are one instance, so ties and repeated rows don't matter; a table without candidates or seeds gives no
    rows; texts without candidates have none."""
    words = scan.select("key", F.explode("words").alias("w")).select("key", "w.*")
    blocks = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / BLOCK), F.floor((F.col(b) - 1) / BLOCK)))
    spans = scan.select("key", F.explode("spans").alias("x")).select("key", F.col("x.s").alias("from"), F.col("x.e").alias("to"), blocks("x.s", "x.e").alias("block"))
    met = words.withColumn("block", blocks("s", "e")).join(spans, ["key", "block"]).where((F.col("from") < F.col("e")) & (F.col("to") > F.col("s")))
    held = met.select("key", "s", F.lit(True).alias("met")).distinct()
    words = cut(words.join(held, ["key", "s"], "left").withColumn("covered", F.col("met").isNotNull()).drop("met"))
    sure = F.col("core").isin(*seeds) if seeds else F.lit(False)
    # A first letter keeps kinds of patterns apart. A context that isn't there makes none.
    named = lambda kind, *parts: F.concat_ws("\n", F.lit(kind), *parts)
    there = lambda c, x: F.when(F.col(c) != "", x)
    patterns = F.array(named("b", "before", "shape"), named("l", "before"), named("s", "shape"), there("two", named("t", "two", "shape")), there("after", named("r", "after", "shape")), there("line", named("n", "line", "shape")))
    graph = cut(words.select("core", F.explode(F.array_compact(patterns)).alias("pattern")).distinct())
    trust = cut(words.groupBy("core").agg(F.max((F.col("covered") | sure).cast("double")).alias("known")).withColumn("trust", F.col("known")))
    if not trust.where("known > 0").head(1):
        return words.limit(0).select("key", "s", "e")
    while True:
        for _ in range(rounds):
            scored = graph.join(trust, "core").groupBy("pattern").agg((F.sum(F.when(F.col("pattern").startswith("s"), F.col("known")).otherwise(F.col("trust"))) / (F.count(F.lit(1)) + 1)).alias("score"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("known") > 0).alias("seeds"))
            scored = scored.where((F.col("n") >= support) & (F.col("seeds") > 0))
            best = with_group(graph, scored, "pattern", "core").groupBy("core").agg(F.max("score").alias("score"))
            trust = trust.join(best, "core", "left").select("core", "known", F.greatest("known", F.coalesce("score", F.lit(0.0))).alias("trust"))
        trust = cut(trust.withColumns({"new": (F.col("known") == 0) & (F.col("trust") >= confidence), "known": F.when(F.col("trust") >= confidence, F.col("trust")).otherwise(0.0)}))
        more = bool(trust.where("new").head(1))
        trust = trust.select("core", "known", F.col("known").alias("trust"))
        if not more:
            break
    good = trust.where("known > 0").select("core")
    return words.where(~F.col("covered")).join(good, "core", "left_semi").select("key", "s", "e")


def find_spans(rows: DataFrame, seeds: Sequence[str] = ()) -> DataFrame:
    """(key, base, spans) of each row of (key, text): base spans and all spans, arrays of (s, kind, e) sorted by start and
    kind. Keys are unique; a null text is empty and has none; an empty table gives an empty one."""
    scan = cut(scanned(rows))
    more = learned(scan, seeds=seeds).groupBy("key").agg(F.collect_list(F.struct("s", F.lit(4).alias("kind"), "e")).alias("more"))
    nothing = F.array().cast("array<struct<s:int,kind:int,e:int>>")
    return scan.join(more, "key", "left").select("key", F.col("spans").alias("base"), F.sort_array(F.concat("spans", F.coalesce("more", nothing))).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def pii_spans(docs: DataFrame, text: str = "text", seeds: Sequence[str] = ()) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans for each row of docs. seeds: identifiers that
    are known, see learned().

    A null text is empty; doc_id null or repeated: see common.keyed; equal texts have equal base spans; an empty table
    gives an empty table; other columns are ignored."""
    rows, ids = keyed(docs, text)
    out = find_spans(rows, seeds)
    counts = [counted("base", i) for i in range(4)]
    return unkeyed(out.select("key", *counts, F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans")), ids)


def redacted(docs: DataFrame, text: str = "text", seeds: Sequence[str] = ()) -> DataFrame:
    """docs with every span replaced by its kind in brackets; overlapping spans become one, of the first's kind.

    A null text stays null and texts without spans stay as they are; doc_id null or repeated: see common.with_key;
    repeated rows stay; an empty table gives an empty table; all columns of docs keep their names and values."""
    columns = docs.columns
    rows, _ = with_key(docs.select(F.struct(*columns).alias("row"), "doc_id", F.col(text).alias("text")))
    spans = find_spans(rows.select("key", "text"), seeds).where(F.size("spans") > 0).select(F.col("key").alias("at"), "spans")
    labels = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def masked(wide: Column, x: Column) -> Column:
        # Code points have four bytes here, so a part is found without counting from the start.
        part = lambda a, b: F.decode(F.substring(wide, a * 4 + 1, (b - a) * 4), "UTF-32")
        reach = F.concat(before_each(F.transform(x, lambda y: y["e"]), 0, lambda a, y: F.greatest(a, y)), F.array(F.array_max(F.transform(x, lambda y: y["e"]))))
        heads = lambda e: F.filter(F.sequence(F.lit(0), F.size(x) - 1), lambda i: F.get(e, i) <= F.get(x, i)["s"])
        one = lambda e, i: F.concat(part(F.get(e, i), F.get(x, i)["s"]), F.get(labels, F.get(x, i)["kind"]))
        return once(reach, lambda e: F.concat(F.array_join(F.transform(heads(e), lambda i: one(e, i)), ""), part(F.element_at(e, -1), (F.length(wide) / 4).cast("int"))))

    done = once(F.encode("text", "UTF-32"), lambda wide: masked(wide, F.col("spans")))
    out = rows.join(spans, F.col("key") == F.col("at"), "left").select("row", F.when(F.col("spans").isNull(), F.col("text")).otherwise(done).alias("text"))
    return out.select(*[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in columns])


def op8_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_spans(documents(spark, sf_dir))
