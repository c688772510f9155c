"""Operators against brute force on small tables, and awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterline.llm import alignment, arrays, common, hard_negatives, jaccard_join, line_dedup, mixing, packing, pii, quality, quotes, sketches, substring_dedup, suffix_dedup, tokens, toxicity
from meterline.llm.tokens import Encoder

WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size int, key string, score string, spans string, kept string, n_words string, label string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), 1, "k", "x", "y", "z", "w", "l") for i, t, s in rows], SCHEMA).repartition(3)


def vocabulary(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghiÄéß漢") for _ in range(r.randint(1, 7))) for _ in range(n)]


def corpus(seed=1, n=60):
    """Texts with copies, near copies, shared passages, repeated words and white space of all kinds."""
    r = random.Random(seed)
    vocab = vocabulary(seed, 400)
    passage = " ".join(r.choice(vocab) for _ in range(45))
    rows = []
    for i in range(n):
        words = [r.choice(vocab) for _ in range(r.choice([0, 1, 3, 12, 60, 150]))]
        if i % 7 == 3 and rows:
            words = re.findall(WORD, rows[r.randrange(len(rows))][1])
            for _ in range(r.randint(0, 4)):
                if words:
                    words[r.randrange(len(words))] = r.choice(vocab)
        if i % 5 == 0:
            words[len(words) // 2 : len(words) // 2] = passage.split()
        if i % 11 == 0:
            words += ["ab"] * 70
        rows.append((i * 3, r.choice(["", " ", "\n"]) + "".join(w + r.choice([" ", "\n", "\t ", " ", " "]) for w in words), f"s{i % 3}"))
    return rows


ODD = [(None, "nothing here", "a"), (None, None, None), (5, None, "a"), (6, "", "a"), (7, "  \n\t ", "b"), (8, "same words twice " * 30, "b"), (9, "same words twice " * 30, "b"), (9, "same words twice " * 30, "b"), (9, "other words", None), (-4, "漢字 é ß" * 40, "c"), (10, "x" * 30000, "c"), (11, "ab " * 9000, "c")]

PER_ROW = {
    "substring_dedup": lambda d: substring_dedup.substring_dedup(d),
    "suffix_dedup": lambda d: suffix_dedup.suffix_dedup(d),
    "alignment": lambda d: alignment.align(d),
    "line_dedup": lambda d: line_dedup.line_dedup(d),
    "sketches": lambda d: sketches.fingerprints(d),
    "mixing": lambda d: mixing.mix(d),
    "quality": lambda d: quality.quality_cascade(d),
    "jaccard_join": lambda d: jaccard_join.jaccard_join(d),
    "pii": lambda d: pii.pii_spans(d),
    "pii_redacted": lambda d: pii.redacted(d),
    "toxicity": lambda d: toxicity.score(d, *toxicity.fit(d, d.select("doc_id", (F.col("doc_id") % 2).alias("toxic")))),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_awkward_rows(spark, name):
    docs = frame(spark, ODD)
    rows = PER_ROW[name](docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in rows) == sorted((i is None, i) for i, _, _ in ODD)
    assert PER_ROW[name](docs.limit(0)).collect() == []


@pytest.mark.parametrize("unit", ["words", "bytes"])
@pytest.mark.parametrize("hot, sample", [(None, 64), (1, 64), (1, 1), (6, 2)])
def test_repeats_brute_force(spark, unit, hot, sample, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "ROWS", 5)
    rows = corpus() + [(200, "ab " * 500, "s"), (201, "abcab" * 100, "s"), (202, None, "s"), (203, "", "s"), (204, "x " + "ab " * 400, "s")]
    width = 20 if unit == "words" else 100
    seen, want = set(), {}
    for i, t, _ in rows:
        u = re.findall(WORD, t or "") if unit == "words" else (t or "").encode()
        gone = [False] * len(u)
        for p in range(len(u) - width + 1):
            w = tuple(u[p : p + width])
            if w in seen:
                gone[p : p + width] = [True] * width
            seen.add(w)
        kept = [u[k] for k in range(len(u)) if not gone[k]]
        data = " ".join(kept).encode() if unit == "words" else bytes(kept)
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want[i] = (len(u), sum(gone), runs, hashlib.sha256(data).hexdigest())
    from meterline.llm.repeats import heavy_labels, remove_repeats

    one = substring_dedup.Words() if unit == "words" else suffix_dedup.Bytes()
    one.sample = sample
    if sample == 1:
        assert heavy_labels(frame(spark, rows).select(F.col("doc_id").cast("long").alias("key"), "text"), one, hot).count() > 0
    got = {r["doc_id"]: (r["size"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in remove_repeats(frame(spark, rows), one, hot=hot).collect()}
    assert got == want


def test_long_blocks_count_by_bytes():
    from meterline.llm import repeats

    unit = suffix_dedup.Bytes()
    batch = pa.RecordBatch.from_pydict({"key": [1, 2], "text": ["a" * 40_000, "a" * 150]})
    out = pa.Table.from_batches(repeats._label(unit)(iter([batch]))).to_pylist()
    assert len({r["label"] for r in out}) == 1
    assert [sum(r["key"] == k for r in out) for k in (1, 2)] == [1 + (40_000 - 100) // 400, 2]
    parts = list(repeats._singly(unit, 7, 3, 3 + 39_900, b"a" * 40_000, True))
    assert [(r[1], r[2], r[3], r[4]) for r in parts] == [(7, 3, 3, b"a" * 100), (7, 4, 39_903, None)]
    assert len(list(repeats._singly(unit, 7, 3, 53, b"a" * 150, False))) == 51


def test_repeats_of_numbered_lines(spark):
    # One label recurs in every line, with another number between: blocks that are long but don't repeat themselves.
    r = random.Random(11)
    piece = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    rows = []
    for k in range(40):
        line = piece(60)
        shared = "".join(f"{r.randrange(1000):03d} {line}" for _ in range(12))
        rows += [(3 * k + j, piece(200) + shared[64 * r.randrange(3) * (j == 2) :] + piece(200), "s") for j in range(3)]
    seen, want = set(), {}
    for i, t, _ in rows:
        gone = bytearray(len(t))
        for p in range(len(t) - 99):
            if t[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(t[p : p + 100])
        want[i] = (sum(gone), hashlib.sha256("".join(c for c, g in zip(t, gone, strict=True) if not g).encode()).hexdigest())
    got = {x["doc_id"]: (x["n_removed"], x["kept_sha256"]) for x in suffix_dedup.suffix_dedup(frame(spark, rows)).collect()}
    assert got == want


def test_interval_scan_and_tree():
    r = random.Random(2)
    for _ in range(200):
        words = sorted("".join(r.choice("ab") for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 9)))
        share = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        prefixes = [0] + [share(a, b) for a, b in zip(words, words[1:], strict=False)]
        rank = list(range(len(words)))
        r.shuffle(rank)
        got = dict.fromkeys(range(len(words)), 0) | dict(suffix_dedup.interval_scan(prefixes, rank, 2))
        for i, w in enumerate(words):
            best = max((share(w, v) for j, v in enumerate(words) if rank[j] < rank[i]), default=0)
            assert got[i] == (best if best >= 2 else 0)
        tree = {(n, tuple(m)) for n, m in suffix_dedup.interval_tree(prefixes, 2)}
        want = set()
        for n in range(2, 10):
            for w in words:
                own = tuple(i for i, v in enumerate(words) if v[:n] == w[:n] and len(w) >= n)
                if len(own) > 1 and min(share(words[a], words[b]) for a in own for b in own if a < b) == n:
                    want.add((n, own))
        assert tree == want


def test_maximal_repeats(spark):
    rows = corpus(12, 40)
    text = {i: (t or "").encode() for i, t, _ in rows}
    out = suffix_dedup.maximal_repeats(frame(spark, rows)).collect()
    groups = {}
    for r in out:
        groups.setdefault(r["repeat"], []).append((r["doc_id"], r["start"], r["length"]))
    covered = {i: bytearray(len(b)) for i, b in text.items()}
    for name, places in groups.items():
        assert len(places) > 1
        for i, s, n in places:
            assert n >= 100 and hashlib.sha256(text[i][s : s + n]).digest() == bytes(name)
            covered[i][s : s + n] = b"\1" * n
    count = Counter(b[p : p + 100] for b in text.values() for p in range(len(b) - 99))
    for i, b in text.items():
        want = bytearray(len(b))
        for p in range(len(b) - 99):
            if count[b[p : p + 100]] > 1:
                want[p : p + 100] = b"\1" * 100
        assert covered[i] == want


def test_jaccard_brute_force(spark):
    r = random.Random(3)
    rows = corpus(5, 80)
    base = [r.choice(vocabulary(9, 300)) for _ in range(120)]
    for k in range(40):
        words = list(base)
        for _ in range(k % 7):
            words[r.randrange(len(words))] = f"n{r.random()}"
        rows.append((1000 + k, " ".join(words).upper(), "s"))
    rows += [(2000, "one two", "s"), (2001, "ONE  two", "s"), (2002, None, "s"), (2003, " ", "s")]
    sets = {}
    for i, t, _ in rows:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a < b and n and 100 * n >= 85 * len(sets[a] | sets[b]) and find(a) != find(b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    # The smaller bounds split regions by Spark, down to pairs of blocks.
    for most in (jaccard_join.MOST, 20_000, 3_000):
        out = jaccard_join.jaccard_classes(common.keyed(frame(spark, rows))[0], most=most).collect()
        assert {r["key"]: (r["n_shingles"], r["component"]) for r in out} == {i: (len(s), find(i)) for i, s in sets.items()}


def test_region_links_brute_force():
    r = np.random.default_rng(4)
    for trial in range(12):
        base = [r.integers(0, 1 << 63, 120, np.uint64) for _ in range(r.integers(1, 6))]
        sets = []
        for _ in range(int(r.integers(2, 260))):
            own = base[r.integers(len(base))].copy()
            change = int(r.choice([0, 2, 8, 20, 60]))
            own[r.integers(0, 120, change)] = r.integers(0, 1 << 63, change, np.uint64)
            sets.append(np.unique(np.append(own, base[0][:10]))[: int(r.choice([130, 110, 60]))])
        united = int(r.integers(0, 5)) if trial % 3 == 0 else 0
        united = min(united, len(sets))
        root = [0 if i < united else i for i in range(len(sets))]

        def find(i, root=root):
            while root[i] != i:
                i = root[i]
            return i

        for i in range(len(sets)):
            for j in range(i):
                n = len(np.intersect1d(sets[i], sets[j]))
                if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n) and find(i) != find(j):
                    root[max(find(i), find(j))] = min(find(i), find(j))
        own = [0 if i < united else i for i in range(len(sets))]

        def top(i, own=own):
            while own[i] != i:
                i = own[i]
            return i

        for a, b in jaccard_join.region_links(list(range(len(sets))), sets, 85, united):
            n = len(np.intersect1d(sets[a], sets[b]))
            assert 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n)
            own[max(top(a), top(b))] = min(top(a), top(b))
        assert [top(i) for i in range(len(sets))] == [find(i) for i in range(len(sets))]


def test_one_of_each_keeps_columns(spark):
    docs = frame(spark, corpus(4, 40))
    out = jaccard_join.one_of_each(docs)
    assert out.columns == docs.columns and 0 < out.count() < docs.count()


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 300), (300, 200), (7, 7)]
    from meterline.llm.components import components

    got = {r["key"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 100, 300: 100}


def test_encoder_is_the_tokenizer():
    path = packing.default_tokenizer()
    texts = [t or "" for _, t, _ in corpus(2, 30)] + ["don't 's it's  we've'll  \n\n x 's\n's !'s''s 12 a1b2 ", " a 　b 漢字 x", "'", "a'", "he'rex'vey\r\n", "<|endoftext|> x"]
    encode = Encoder(path)
    assert [x.tolist() for x in encode(texts)] == [encode.slow.encode(t, add_special_tokens=False).ids for t in texts]


def test_packing_round_trip(spark):
    rows = corpus(6, 50) + [(900, "word " * 3000, "s"), (901, None, "s"), (902, "word " * 3000, "s"), (902, "word " * 3000, "s")]
    slow = Encoder(packing.default_tokenizer()).slow
    out = packing.pack(frame(spark, rows), length=256).toPandas()
    for i, t, _ in rows[:51]:
        ids = slow.encode(t or "", add_special_tokens=False).ids + [2]
        own = out[out.doc_id == i].sort_values("piece")
        assert own.length.sum() == len(ids) and (own.length.iloc[1:] == 256).all()
        for _, p in own.iterrows():
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    for _, s in out.sort_values("offset").groupby("sequence_id"):
        assert s.length.sum() <= 256 and s.offset.tolist() == [0, *np.cumsum(s.length)[:-1]]
    assert out.sequence_id.nunique() <= 1.05 * (out.length.sum() / 256) + 2
    assert packing.pack(frame(spark, rows).limit(0)).count() == 0


def test_mixing_meets_targets(spark):
    rows = [(i, "w " * (i % 9 * 7 + i % 5), ["a", "b", None, "c"][i % 4] if i % 10 else "a") for i in range(400)]
    out = mixing.mix(frame(spark, rows)).toPandas()
    again = mixing.mix(frame(spark, rows)).toPandas()
    key = ["doc_id", "copies"]
    assert out.sort_values(key)[key].values.tolist() == again.sort_values(key)[key].values.tolist()
    out["taken"] = out["size"] * out["copies"]
    per = out.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"), total=("source_size", "first"))
    assert (abs(per.taken - per.target) <= 1).all() and (per.target <= 3 * per.total + 1e-6).all()
    assert abs(per.target.sum() - per.total.sum()) < 1e-6 and out.copies.max() <= 3


def test_targets_stop_at_the_cap(spark):
    sizes = {"a": 100, "b": 1, "c": 10, "d": 50}
    weight, full = {"a": 1, "b": 2, "c": 3, "d": 1}, set()
    while True:
        room = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        t = {s: 3.0 * sizes[s] if s in full else room * weight[s] / sum(weight[x] for x in weight if x not in full) for s in sizes}
        over = {s for s in t if t[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(t)


def test_knapsack_is_exact():
    r = random.Random(1)
    for _ in range(50):
        sizes, counts = [r.randint(1, 30) for _ in range(5)], [r.randint(0, 4) for _ in range(5)]
        budget = r.randint(0, 120)
        sums = {0}
        for s, n in zip(sizes, counts, strict=True):
            sums = {x + s * k for x in sums for k in range(n + 1)}
        taken = mixing.knapsack(sizes, counts, budget)
        assert sum(a * b for a, b in zip(sizes, taken, strict=True)) == max(x for x in sums if x <= budget) and all(a <= b for a, b in zip(taken, counts, strict=True))


@pytest.mark.parametrize("budget", [10**5, 10**6, 10**7])
@pytest.mark.parametrize("step", [1, 6])
def test_fit_reaches_the_best_sum(budget, step):
    """Against all sums of the whole histogram, with lengths that share a divisor or not; the source is taken again in part."""
    import pandas as pd

    r = random.Random(budget + step)
    sizes = sorted(r.sample(range(step, 20_000, step), 300))
    counts = [r.randint(0, 2 * budget // (300 * s) + 1) for s in sizes]
    total = sum(s * n for s, n in zip(sizes, counts, strict=True))
    assert total > budget
    reach, mask = 1, (1 << budget + 1) - 1
    for s, n in zip(sizes, counts, strict=True):
        k = 1
        while n > 0:
            reach |= reach << s * min(k, n) & mask
            n, k = n - k, 2 * k
    out = mixing.fit(pd.DataFrame({"source": "s", "size": sizes, "n": counts, "source_size": total, "target": float(total + budget)}))
    left = dict(zip(sizes, counts, strict=True))
    assert (out.passes == 1).all() and all(0 <= m <= left[s] for s, m in zip(out["size"], out.more, strict=True))
    assert int((out["size"] * out.more).sum()) == reach.bit_length() - 1


def test_lengths_give_alike():
    r = random.Random(3)
    for _ in range(100):
        sizes = sorted({r.randint(1, 400) for _ in range(40)}, reverse=True)
        counts = [r.randint(0, 30) for _ in sizes]
        total = sum(s * n for s, n in zip(sizes, counts, strict=True))
        budget = r.randint(0, max(total - 1, 0))
        taken = seen = 0
        for s, n, k in zip(sizes, counts, mixing.shared_out(sizes, counts, budget) if total else [0] * len(sizes), strict=True):
            seen, taken = seen + s * n, taken + s * k
            assert 0 <= k <= n and 0 <= budget * seen // max(total, 1) - taken < sizes[0]


def test_quality_measures(spark):
    rows = corpus(8, 40) + [(500, "a b c a b c a b", "s"), (501, "%% x $\nfoo\n\nfoo\n foo", "s"), (502, None, "s")]
    got = {r["doc_id"]: r for r in quality.quality_cascade(frame(spark, rows)).collect()}
    for i, t, _ in rows:
        w = re.findall(WORD, t or "")
        lines = [x for x in (t or "").split("\n") if re.search(WORD, x)]
        n = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {k + j for k in range(len(w) - 2) if n[w[k], w[k + 1], w[k + 2]] > 1 for j in range(3)}
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)), i
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r["base_failed"] and r["kept"])


def test_fingerprints_and_next_document(spark):
    rows = corpus(9, 50)
    got = {r["doc_id"]: r for r in sketches.fingerprints(frame(spark, rows)).collect()}
    order = sorted(rows, reverse=True)
    for k, (i, t, _) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(t) // 2
        text = t[: len(t) - half] + following[:half]
        assert got[i]["n_chars"] == len(t) and got[i]["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    same = sketches.fingerprints(frame(spark, [(1, "a b c d e f", "s"), (2, "a b c d e f", "s")])).collect()
    assert same[0]["fingerprint"] == same[1]["fingerprint"] and same[0]["near_next"] == 1


def kept_shingles(spark, texts):
    """For each text the set of its five-word shingles whose hash a sketch keeps, by brute force over words."""
    out = []
    for t in texts:
        w = re.findall(WORD, t or "")
        parts = [w[k : k + 5] for k in range(len(w) - 4)] if len(w) >= 5 else []
        rows = spark.createDataFrame([(p,) for p in parts] or [([],)], "w array<string>")
        rows = rows.where("size(w) = 5").select("w", F.xxhash64(*[F.xxhash64(F.col("w")[k]) for k in range(5)]).alias("h"))
        out.append({tuple(r["w"]) for r in rows.where(F.col("h") < -(1 << 63) + (1 << 64) // sketches.SCALE).collect()})
    return out


def test_likeness_and_containment_brute_force(spark):
    rows = [x for x in corpus(10, 24) if len(re.findall(WORD, x[1])) != 3]
    order = sorted(rows, reverse=True)
    texts = [t for _, t, _ in order]
    edits = [t[: len(t) - len(t) // 2] + texts[(k + 1) % len(texts)][: len(t) // 2] for k, t in enumerate(texts)]
    own, other = kept_shingles(spark, texts), kept_shingles(spark, edits)
    got = {r["doc_id"]: r for r in sketches.fingerprints(frame(spark, rows)).collect()}
    for k, (i, t, _) in enumerate(order):
        n = len(re.findall(WORD, t))
        for b, text, near, inside in ((other[k], edits[k], "near_edited", "in_edited"), (own[(k + 1) % len(own)], texts[(k + 1) % len(own)], "near_next", "in_next")):
            if n < 5 or len(re.findall(WORD, text)) < 5:
                continue
            assert got[i][near] == pytest.approx(1.0 if t == text else len(own[k] & b) / len(own[k] | b) if own[k] | b else 0.0)
            assert got[i][inside] == (pytest.approx(len(own[k] & b) / len(own[k])) if own[k] else None)


def test_sketches_estimate_and_merge(spark):
    vocab = vocabulary(3, 3000)
    r = random.Random(4)
    a = [r.choice(vocab) for _ in range(4000)]
    b = a[:3000] + [r.choice(vocab) for _ in range(1000)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b))], "a string, b string").select("*", sketches.sketch(F.col("a")).alias("x"), sketches.sketch(F.col("b")).alias("y"))
    x, y = F.col("x"), F.col("y")
    got = df.select(sketches.likeness(x, y, F.lit(False)), sketches.containment(x, y), sketches.merged(x, y), sketches.containment(x, sketches.merged(x, y)), "x", "y").first()
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b)]
    assert got[0] == pytest.approx(len(sets[0] & sets[1]) / len(sets[0] | sets[1]), abs=0.06)
    assert got[1] == pytest.approx(len(sets[0] & sets[1]) / len(sets[0]), abs=0.06)
    assert got[2] == sorted({*got["x"], *got["y"]}) and got[3] == 1.0


def test_containment_in_sources(spark):
    vocab = vocabulary(5, 3000)
    r = random.Random(6)
    long = [r.choice(vocab) for _ in range(6000)]
    rows = [(1, " ".join(long[:3000]), "big"), (2, " ".join(long[3000:]), "big"), (3, " ".join(long[100:400]), "small"), (4, " ".join(long[2900:3100]), None), (5, None, "big"), (1, "few words", "big")]
    got = {(x["doc_id"], x["group"]): x for x in sketches.group_containment(frame(spark, rows)).collect()}
    assert got[3, "big"]["inside"] == 1.0 and got[4, "big"]["inside"] > 0.8 and got[1, "small"]["inside"] < 0.2
    assert (3, "small") not in got and (1, "big") not in got
    assert sketches.group_containment(frame(spark, rows).limit(0)).collect() == []


def luhn(s):
    return sum((int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10))) for k, c in enumerate(reversed(s))) % 10 == 0


def test_pii_brute_force(spark):
    r = random.Random(7)
    alphabet = "0123456789" * 3 + "ab@..--  +()%é"
    rows = [(i, "".join(r.choice(alphabet) for _ in range(300)), "s") for i in range(60)]
    rows += [(100, "mail a.b@c.d-e.f, x@y 4111 1111 1111 1111 or 4111-1111-1111-1112; 1.2.3.4.5.6.7.8 256.1.1.1 +1 (555) 123-4567", "s"), (101, "4111111111111111" + " 1" * 9000, "s")]
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    got = {x["doc_id"]: x for x in pii.pii_spans(frame(spark, rows)).collect()}
    for i, t, _ in rows:
        spans = []
        for k, p in enumerate(patterns):
            for m in re.finditer(p, t):
                d = re.sub("[^0-9]", "", m[0])
                if (k == 1 and max(map(int, m[0].split("."))) > 255) or (k == 2 and not (14 <= len(d) <= 19 and luhn(d))) or (k == 3 and not 10 <= len(d) <= 15):
                    continue
                spans.append((m.start(), k, m.end()))
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert got[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest(), (i, text, got[i]["spans"])
        assert set(filter(None, text.split(","))) <= set(got[i]["spans"].split(","))


def test_pii_learns_from_context(spark):
    rows = [(i, f"please write to account: {4111111111111111 if i < 6 else 4111111111111110 + i * 1000} today", "s") for i in range(9)] + [(50, "in the year: 123456 nothing", "s")]
    got = {r["doc_id"]: r["spans"] for r in pii.pii_spans(frame(spark, rows + [(60 + i, f"my account: 5500000000000004 and {i}", "s") for i in range(3)] + [(70 + i, "account: 340000000000009", "s") for i in range(2)])).collect()}
    assert "id:" in got[7] and got[50] == ""


def test_pii_learns_in_two_hops(spark):
    cards = [c for c in map(str, range(4111111111111111, 4111111111111191)) if luhn(c)]
    known = ["71234567", "72345678", "73456789", "74567890", "XK-4411", "XK-4422", "XK-4433", "XK-4444"]
    texts = [f"my account: {x} is" for x in cards + known]
    # No card stands after these; they have what the first hop found, and one word more.
    texts += [f"the ref: {x} is" for x in [*known[:4], "91234567"]] + [f"a badge: {x} is" for x in [*known[4:], "Q9911"]]
    texts += ["token = deadbeef00112233 is"] + [f"in year: {x} was" for x in range(20001, 20021)]
    got = {t: r for t, r in zip(texts, sorted(pii.pii_spans(frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect(), key=lambda r: r["doc_id"]), strict=True)}
    assert got["the ref: 91234567 is"]["spans"] == "id:9:17" and got["a badge: Q9911 is"]["spans"] == "id:9:14"
    assert got["token = deadbeef00112233 is"]["spans"] == "id:8:24"
    assert [t for t in texts if not got[t]["spans"]] == texts[-20:]


def test_redaction(spark):
    out = {r["doc_id"]: r["text"] for r in pii.redacted(frame(spark, [(1, "é mail a@b.cd and a@b.cd.", "s"), (2, "none", "s"), (3, None, "s")])).collect()}
    assert out == {1: "é mail [email] and [email].", 2: "none", 3: None}


def test_redaction_of_many_and_overlapping_spans(spark):
    import time

    r = random.Random(5)
    parts = ["a@b.cd", "1.2.3.4", "+1 (555) 123-4567", "4111 1111 1111 1111", "x1.2.3.4@b.cd", "+4111111111111111@b.cd", "漢字", "😀 é", "word"]
    rows = [(i, " ".join(r.choice(parts) for _ in range(r.choice([1, 3, 70, 300]))), "s") for i in range(40)]
    spans = {x["doc_id"]: x["spans"] for x in pii.pii_spans(frame(spark, rows)).collect()}
    got = {x["doc_id"]: x for x in pii.redacted(frame(spark, rows)).collect()}
    for i, t, _ in rows:
        out, at = "", 0
        for k, a, b in (x.split(":") for x in spans[i].split(",") if x):
            if int(a) >= at:
                out += t[at : int(a)] + f"[{k}]"
            at = max(at, int(b))
        assert got[i]["text"] == out + t[at:] and got[i]["spans"] == "y" and got[i]["key"] == "k"
    begun = time.perf_counter()
    many = pii.pii_spans(frame(spark, [(1, " ".join(f"item {k} of {k + 10000}" for k in range(16000)), "s"), (2, " ".join(f"u{k}2345@mail.example" for k in range(8000)), "s")])).collect()
    assert {x["doc_id"]: x["n_email"] for x in many} == {1: 0, 2: 8000} and time.perf_counter() - begun < 60


def test_pii_recall_of_planted_identifiers(spark):
    """Identifiers of three shapes in contexts that base kinds share; others in contexts that none does."""
    r = random.Random(6)
    cards = [c for c in map(str, range(4111111111111111, 4111111111114111)) if luhn(c)]
    rows, planted = [], {}
    for i in range(300):
        context = r.choice(["account no", "client id", "pay to"])
        kind = r.random()
        value = r.choice(cards) if kind < 0.5 else f"{r.randrange(10**7, 10**8)}" if kind < 0.75 else f"KX-{r.randrange(1000, 9999)}-{r.randrange(10)}"
        head = f"{r.choice(['hello', 'dear sir', 'note'])} {context} "
        rows.append((i, f"{head}{value} thanks, page {r.randrange(10000, 99999)} in {r.randrange(1000, 2100)}", "s"))
        if kind >= 0.5:
            planted[i] = f"id:{len(head)}:{len(head) + len(value)}"
    got = {x["doc_id"]: x["spans"].split(",") for x in pii.pii_spans(frame(spark, rows)).collect()}
    assert sum(planted[i] in got[i] for i in planted) >= 0.9 * len(planted)
    assert sum(x.startswith("id:") for v in got.values() for x in v) <= 1.1 * len(planted)


def test_cascade_skips_rejected_rows(spark):
    docs = frame(spark, [(i, "spam" if i % 3 else "ham " * 60, "s") for i in range(60)])
    text = F.col("text")
    boom = F.when(text == "spam", F.raise_error(F.lit("evaluated")).cast("boolean")).otherwise(F.lit(False))
    first = quality.Rule("cheap", text == "spam")
    out = docs.select(quality.cascade(F.lit(False), [first, quality.Rule("boom", boom)]).alias("by")).groupBy("by").count().collect()
    assert {r["by"]: r["count"] for r in out} == {"cheap": 40, None: 20}


def test_rules_are_ordered_by_measured_cost(spark):
    docs = frame(spark, [(i, ("spam " if i % 3 else "ham ") * 400, "s") for i in range(120)])
    text = F.col("text")
    # Both find the same rows; one sorts all pieces of the text many times before.
    slow = F.forall(F.transform(F.sequence(F.lit(1), F.lit(40)), lambda i: F.size(F.array_sort(F.split(F.concat(text, i.cast("string")), " "))) > 0), lambda x: x)
    checks = [quality.Rule("dear", slow & text.contains("spam")), quality.Rule("never", text == "x"), quality.Rule("cheap", text.contains("spam"))]
    found = {m.rule.name: m for m in quality.measure(docs, checks, text)}
    assert {k: m.rejected for k, m in found.items()} == {"dear": 80, "never": 0, "cheap": 80}
    assert found["dear"].cost > 20 * found["cheap"].cost > 0
    assert [x.name for x in quality.order_rules(docs, checks, text)][:2] == ["cheap", "dear"]
    assert [m.cost for m in quality.measure(docs.limit(0), checks, text)] == [0.0] * 3


def test_no_order_of_rules_changes_a_verdict(spark):
    import itertools

    bad = ["word " * 60 + "#" * 40, ("same line here\n" * 6 + "another one\n") + " ".join(f"w{i}" for i in range(80)), "a b " * 2 + " ".join("xyzab"[i % 5] for i in range(90)), " ".join(str(10**6 + i) for i in range(80)), " ".join(f"fine{'abcdefghij'[i % 10]} text" for i in range(90))]
    docs = frame(spark, [(i, bad[i % 5] + f" t{i}", "s") for i in range(40)])
    checks = quality.rules(F.col("text"))
    kept = [tuple(r["k"] for r in docs.select("doc_id", quality.cascade(F.lit(False), list(order)).isNull().alias("k")).orderBy("doc_id").collect()) for order in itertools.permutations(checks)]
    assert len(set(kept)) == 1 and True in kept[0] and False in kept[0]
    whole = {r["doc_id"]: r["kept"] for r in quality.quality_cascade(docs).collect()}
    assert set(whole) == set(range(40))


def test_real_rules_are_skipped(spark):
    """Where an earlier rule rejects, a later one of the four isn't evaluated: its text would fail to be read."""
    docs = frame(spark, [(i, "#" * 30 if i % 2 else "good words " * 30, "s") for i in range(20)])
    broken = F.when(F.col("text").startswith("#"), F.raise_error(F.lit("evaluated")).cast("string")).otherwise(F.col("text"))
    sound, spoiled = quality.rules(F.col("text")), quality.rules(broken)
    first = next(x for x in sound if x.name == "symbols")
    for later in spoiled:
        out = docs.select(quality.cascade(F.lit(False), [first, later]).alias("by")).where("by = 'symbols'").count()
        assert out == 10
    with pytest.raises(Exception, match="evaluated"):
        docs.select(quality.cascade(F.lit(False), [spoiled[0], first]).alias("by")).collect()


def test_field_marginals_are_exact():
    r = np.random.default_rng(1)
    k = len(toxicity.STEPS) + 1
    field = toxicity.Field(r.normal(size=k), r.normal(size=(2, 2)), np.zeros(3))
    level = np.array([0, 0, 3, 0, 5, 5, 0, 0, 0, 1], np.uint8)
    at, p = field.marginals(level)
    total, one = 0.0, np.zeros(len(level))
    for bits in range(1 << len(level)):
        y = [bits >> i & 1 for i in range(len(level))]
        w = np.exp(sum(field.weights[level[i]] for i in range(len(level)) if y[i]) + sum(field.transitions[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += w
        one += w * np.array(y)
    assert np.allclose(p, (one / total)[at])


def test_toxicity_scores_brute_force(spark):
    from meterline.llm.arrays import names

    r = np.random.default_rng(3)
    k = len(toxicity.STEPS) + 1
    field = toxicity.Field(r.normal(size=k), r.normal(size=(2, 2)), np.array([-1.0, 0.7, 1.5]))
    known = {"bad": 3, "awful": 5, "é": 1, ("terr", 4): 2, ("terri", 5): 6}
    hashes = {}
    for word, level in known.items():
        t = (word if isinstance(word, str) else word[0]).encode()
        h = names(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))[0]
        hashes[int(h if isinstance(word, str) else h ^ np.uint64(word[1]))] = level
    lexicon = toxicity.Lexicon(np.array(sorted(hashes), np.uint64), np.array([hashes[h] for h in sorted(hashes)], np.uint8))
    p = random.Random(5)
    vocab = ["bad", "Awful", "é", "terrible", "terr", "good", "day", "x1y", "badly"]
    rows = [(i, " ".join(p.choice(vocab) for _ in range(p.randint(0, 8))) or None, "s") for i in range(60)]
    got = {x["doc_id"]: x for x in toxicity.score(frame(spark, rows), lexicon, field).collect()}
    for i, t, _ in rows:
        own = re.findall("[a-z\x80-\U0010ffff]+", (t or "").lower())
        level = [max(known.get(w, 0), *(known.get((w[:n], n), 0) for n in (4, 5) if len(w) > n), 0) for w in own]
        total, one = 0.0, np.zeros(len(level))
        for bits in range(1 << len(level)):
            y = [bits >> j & 1 for j in range(len(level))]
            w = np.exp(sum(field.weights[level[j]] for j in range(len(level)) if y[j]) + sum(field.transitions[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            one += w * np.array(y)
        q = np.array([one[j] / total for j in range(len(level)) if level[j]])
        want = 1 / (1 + np.exp(-(np.array([1.0, np.log1p(q.sum()), q.max() if len(q) else 0.0]) @ field.curve)))
        assert got[i]["score"] == pytest.approx(want) and got[i]["predicted"] == int(want >= 0.3)
        assert got[i]["n_spans"] == (q >= 0.5).sum()


def test_field_is_fitted_to_weighted_stretches():
    r = np.random.default_rng(2)
    level = r.integers(0, 4, (40, toxicity.SEGMENT)) * (r.random((40, toxicity.SEGMENT)) < 0.3)
    state = (level > 1).astype(np.int64)
    weight = r.integers(1, 4, 40)
    one = toxicity.fit_field(level, state, weight.astype(float), 60)
    two = toxicity.fit_field(np.repeat(level, weight, 0), np.repeat(state, weight, 0), np.ones(weight.sum()), 60)
    assert np.allclose(one[0], two[0]) and np.allclose(one[1], two[1])
    assert one[0][3] > one[0][1]


def test_toxicity_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = common.documents(spark, d), spark.read.parquet(f"{d}/labels.parquet")
    out = toxicity.score(docs, *toxicity.fit(docs, labels)).join(labels.groupBy("doc_id").agg(F.max("toxic").alias("y")), "doc_id").where(toxicity.held_out(F.col("doc_id"))).toPandas()
    assert out[out.y == 1].score.mean() > 3 * out[out.y == 0].score.mean()
    assert out[out.y == 0].predicted.mean() < 0.1 and out[out.y == 1].predicted.mean() > 0.5
    bad = out[out.n_spans > 0].iloc[0]
    a, b = map(int, bad.spans.split(",")[0].split(":"))
    assert bad.text[a:b].isalpha()


def test_quotes(spark):
    rows = [(1, 1, "u", "Hello world\nhow are you"), (1, 2, "a", "> Hello world\nfine"), (1, 3, "u", "> > hello World!\n> fine\nok"), (1, 4, "a", "new topic"), (2, 1, "u", None), (2, 2, "u", "> Hello world\nx"), (None, 1, "u", "> fine"), (3, None, "u", "y"), (1, 4, "a", "new topic")]
    messages = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, body int")
    got = {(r["conv_id"], r["turn"]): r for r in quotes.link_quotes(messages).collect()}
    assert got[1, 3]["parent_turn"] == 2 and got[1, 3]["root_turn"] == 1 and got[1, 3]["depth"] == 2 and got[1, 3]["body"] == "ok"
    assert got[1, 2]["parent_turn"] == 1 and got[1, 4]["parent_turn"] is None and got[2, 2]["parent_turn"] is None
    assert quotes.link_quotes(messages).count() == len(rows) and quotes.link_quotes(messages.limit(0)).count() == 0


def test_quotes_nested_only(spark):
    rows = [("c", 1, "u", "first thing"), ("c", 2, "a", "> first thing\nsecond thing"), ("c", 3, "u", ">> first thing\nthird"), ("c", 4, "a", "> > second thing\n>>> first thing\n> unknown\nfourth"), ("c", 5, "u", ">> first thing\n> fourth\n>> second thing\nfifth")]
    messages = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {r["turn"]: (r["parent_turn"], r["root_turn"], r["body"]) for r in quotes.link_quotes(messages).collect()}
    assert got == {1: (None, 1, "first thing"), 2: (1, 1, "second thing"), 3: (1, 1, "third"), 4: (2, 1, "fourth"), 5: (4, 1, "fifth")}
    links = {tuple(r) for r in quotes.quote_links(quotes.parsed(messages)).select("turn", "level", "source", "n").collect()}
    assert links == {(2, 1, 1, 1), (3, 2, 1, 1), (4, 2, 2, 1), (4, 3, 1, 1), (5, 1, 4, 1), (5, 2, 1, 1), (5, 2, 2, 1)}


def test_quotes_link_to_who_wrote_the_passage(spark):
    rows = [("c", 1, "u", "one\ntwo\nthree\nfour"), ("c", 2, "a", "one\ntwo"), ("c", 3, "u", "> one\n> two\n> three\nyes"), ("c", 4, "u", "> two\n> one\nno")]
    got = {r["turn"]: r["parent_turn"] for r in quotes.link_quotes(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")).collect()}
    assert got == {1: None, 2: None, 3: 1, 4: 2}


def mirrored(rounds, a="a", b="b"):
    """A Thue-Morse word and its complement, which polynomial hashes modulo a power of two can't tell apart."""
    for _ in range(rounds):
        a, b = a + b, b + a
    return a, b


def test_mirrored_words_are_different(spark):
    x, y = mirrored(12)
    rows = [(1, "same " * 19 + x, "s"), (2, "same " * 19 + y, "s"), (3, "same " * 19 + x, "s")]
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.substring_dedup(frame(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 20}
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.suffix_dedup(frame(spark, [(1, x, "s"), (2, y, "s")])).collect()}
    want, seen = {}, set()
    for i, t in ((1, x), (2, y)):
        gone = bytearray(len(t))
        for p in range(len(t) - 99):
            if t[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(t[p : p + 100])
        want[i] = sum(gone)
    assert got == want
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_join(frame(spark, [(1, x, "s"), (2, y, "s"), (3, x.upper(), "s")])).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_names_tell_ranges_apart():
    from meterline.llm import arrays

    r = np.random.default_rng(1)
    for kind in (np.uint8, np.uint32, np.uint64):
        values = r.integers(0, 3, 3000).astype(kind)
        start = r.integers(0, 2900, 4000)
        end = np.minimum(start + r.integers(0, 90, 4000), 3000)
        for seed in (0, 1):
            by = {}
            for a, b, x in zip(start, end, arrays.names(values, start, end, seed).tolist(), strict=True):
                by.setdefault(values[a:b].tobytes(), set()).add(x)
            assert all(len(x) == 1 for x in by.values()) and len({x for own in by.values() for x in own}) == len(by)
            for width in (1, 3, 8, 9, 100):
                assert (arrays.sliding(values, width, seed) == arrays.names(values, np.arange(3001 - width), np.arange(3001 - width) + width, seed)).all()


def test_covers_are_equal_for_equal_windows_only():
    r = random.Random(4)
    texts = [" ".join(r.choice(["a", "b", "a", "c"]) for _ in range(r.randint(0, 300))).encode() for _ in range(30)] + [b"z " * 100]
    unit = substring_dedup.Words()
    which, one, two = unit.digests(texts)
    words = [t.split() for t in texts]
    want = [(k, tuple(w[p : p + 20])) for k, w in enumerate(words) for p in range(len(w) - 19)]
    assert [k for k, _ in want] == which.tolist()
    by = {}
    for (_, w), a, b in zip(want, one.tolist(), two.tolist(), strict=True):
        by.setdefault(w, set()).add((a, b))
    assert all(len(x) == 1 for x in by.values()) and len({x for own in by.values() for x in own}) == len(by)


def test_encoder_over_random_unicode_and_documents():
    import pyarrow.parquet as pq

    r = random.Random(3)
    alphabet = [chr(c) for c in [*range(1, 0x250), *range(0x2000, 0x2070), *range(0x3040, 0x30A0), 0x1F600, 0x10FFFF]] + list(" '\nstmdrevl") * 40
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 80))) for _ in range(1500)]
    texts += [t or "" for t in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()]
    encode = Encoder(packing.default_tokenizer())
    assert all(got.tolist() == want.ids for got, want in zip(encode(texts), encode.slow.encode_batch(texts, add_special_tokens=False), strict=True))


def lines_by_brute_force(rows, least_chars=40, least_docs=5):
    """rows: (doc_id, text) with unique doc_ids."""
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).translate({c: c + 32 for c in range(65, 91)})
    holders = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            holders.setdefault(key(line), set()).add(i)
    last = {k: max(d) for k, d in holders.items() if len(k) >= least_chars and len(d) >= least_docs}
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if last.get(key(x), i) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_line_dedup_brute_force(spark):
    r = random.Random(13)
    shared = ["".join(r.choice("abc ÄÉ漢XYZ") for _ in range(r.choice([38, 39, 40, 41, 60, 300]))) for _ in range(40)]
    dress = lambda x: r.choice(["", " ", "\t", "\r", "\x0b "]) + r.choice([x, x.swapcase(), x]) + r.choice(["", "  ", "\r", "\x85", "\xa0"])
    rows = []
    for i in range(120):
        lines = [dress(r.choice(shared)) if r.random() < 0.4 else r.choice(["", "short", f"a line of document {i} that no other one has at all {r.random()}"]) for _ in range(r.randint(0, 12))]
        rows.append((i * 7 - 50, "\n".join(lines) if r.random() > 0.03 else None))
    rows += [(5000 + k, "the very same line, forty code points and more\n" * (1 + k % 3) + "x") for k in range(300)] + [(9000, "y" * 200_000 + "\n" + shared[5] + "\n")]
    got = line_dedup.line_dedup(frame(spark, [(*x, "s") for x in rows])).collect()
    want = lines_by_brute_force(rows)
    assert sum(n for _, n, _ in want.values()) > 300
    assert {x["doc_id"]: (x["n_lines"], x["n_dropped"], x["kept"]) for x in got} == want


def test_line_dedup_with_a_full_filter(spark, monkeypatch):
    """Results are exact when the filter is far too small, and no key of two documents is missing from it."""
    rows = [(i, "\n".join(f"line number {(i * 7 + k) % (90 + 40 * k)} of the many long lines here, number {k}" for k in range(30))) for i in range(100)]
    docs = frame(spark, [(*x, "s") for x in rows])
    monkeypatch.setattr(line_dedup, "MOST_BITS", line_dedup.BOX)
    monkeypatch.setattr(line_dedup, "BITS_A_LINE", 1)
    got = line_dedup.line_dedup(docs, least_docs=2).collect()
    assert {x["doc_id"]: (x["n_lines"], x["n_dropped"], x["kept"]) for x in got} == lines_by_brute_force(rows, least_docs=2)
    texts = docs.select(F.col("doc_id").alias("key"), "text")
    for bits in (1 << 16, 1 << 18):
        found = {(bytes(x["name"]), x["key"]) for x in line_dedup.suspects(texts, bits).collect()}
        holders = {}
        for i, t in rows:
            for line in t.split("\n"):
                holders.setdefault(line_dedup.name(line.encode()), set()).add(i)
        assert {(n, i) for n, d in holders.items() if len(d) > 1 for i in d} <= found


def test_line_filter_leaves_single_lines(spark):
    texts = spark.createDataFrame([(i, "\n".join(f"only document {i} has this line, and it has it once: {k}" for k in range(50))) for i in range(400)], "key long, text string").repartition(8)
    assert line_dedup.suspects(texts, line_dedup.filter_bits(20_000)).count() < 20_000 * 0.04
    line = "x" * 37 + "ÄÖÜ"
    assert line_dedup.line_key((" " + line + "\r").encode()) == line.encode() and line_dedup.line_key(line[1:].encode()) is None
    assert [line_dedup.filter_bits(n) for n in (0, 4096, 4097, 10**12)] == [1 << 16, 1 << 16, 1 << 17, line_dedup.MOST_BITS]


def strange_texts(seed, n):
    r = random.Random(seed)
    pools = ["ab c", "  \t\n", "Hello, world's 12 don't", "éßÄ漢字🙂‍", "▁_  \x00\x85", "".join(map(chr, range(32, 700))), "<s></s><0x0A><|endoftext|>"]
    texts = []
    for _ in range(n):
        t = ""
        for _ in range(r.randint(0, 6)):
            pool = r.choice(pools)
            t += pool if r.random() < 0.3 else "".join(r.choice(pool) for _ in range(r.choice([1, 2, 5, 30])))
        texts.append(t)
    return texts


def tokenizers_themselves():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))


def test_piece_side_is_the_model():
    both = alignment.sides(alignment.default_tokenizer(), alignment.default_pieces())
    a, b = tokenizers_themselves()
    texts = [t for t in strange_texts(4, 3000) if t]
    for t, x, y in zip(texts, both.a([" " + t for t in texts]), both.b([" " + t for t in texts]), strict=True):
        assert y.tolist() == b.encode(t), t
        assert x.tolist() == a.encode(" " + t, add_special_tokens=False).ids, t


def test_alignment_brute_force(spark):
    a, b = tokenizers_themselves()
    texts = strange_texts(5, 150) + [None, "", "x" * 9000, "the cat sat on the mat " * 800, *[t for _, t, _ in corpus(3, 20)]]
    back = {alignment.sides(alignment.default_tokenizer(), alignment.default_pieces()).a.characters.get(i, chr(i)): i for i in range(256)}
    side_a = lambda t: [(i, bytes(back[c] for c in a.id_to_token(i))) for i in a.encode(" " + t, add_special_tokens=False).ids]
    piece = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    made, holders = [], Counter()
    for t in texts:
        x, y = (side_a(t), [(i, piece(i)) for i in b.encode(t)]) if t else ([], [])
        if not t or b"".join(v for _, v in x) != (" " + t).encode() or b"".join(v for _, v in y) != (" " + t).encode():
            made.append(([], [], [], ""))
            continue
        ranges = []
        for side in (x, y):
            at, own = 0, []
            for i, v in side:
                own.append((i, at, at + len(v)))
                at += len(v)
            ranges.append(own)
        links = [(p[0], q[0]) for p in ranges[0] for q in ranges[1] if p[1] < q[2] and q[1] < p[2]]
        ends = sorted({p[2] for p in ranges[0]} & {q[2] for q in ranges[1]})
        shown = ";".join("|".join(",".join(str(i) for i, _, e in side if lo < e <= hi) for side in ranges) for lo, hi in zip([0, *ends], ends, strict=False))
        holders.update(set(links))
        made.append((x, y, links, shown))
    highest = {}
    for (i, _), n in holders.items():
        highest[i] = max(n, highest.get(i, 0))
    want = {k: (len(x), len(y), shown.count(";") + bool(shown), len(links), sum(holders[p] == highest[p[0]] for p in links), sum(holders[p] for p in links), hashlib.sha256(shown.encode()).hexdigest() if shown else "") for k, (x, y, links, shown) in enumerate(made)}
    assert sum(not v[0] for v in want.values()) > 3 < sum(v[3] > v[2] for v in want.values())
    docs = frame(spark, [(k, t, "s") for k, t in enumerate(texts)])
    for block in (alignment.BLOCK, 2000):
        got = {r["doc_id"]: tuple(r[c] for c in alignment.OUT[1:]) for r in alignment.align(docs, block=block).collect()}
        assert got == want


def vectors(seed, n, dim=24):
    """Clusters, copies, ties, zero vectors, other dimensions, large components, and rows that take no part."""
    g = np.random.default_rng(seed)
    centres = g.standard_normal((6, dim))
    rows = []
    for i in range(n):
        label = int(g.integers(0, 4))
        v = (centres[int(g.integers(0, 6))] + g.standard_normal(dim) * g.choice([0, 0.3, 1, 3])).tolist()
        kind = i % 23
        if kind == 3:
            v = [0.0] * dim
        elif kind == 4:
            v = v[:7]
        elif kind == 5:
            v[2] = [None, float("nan"), float("inf")][i % 3]
        elif kind == 6:
            v = None if i % 2 else v
            label = label if i % 2 else None
        elif kind == 7:
            v = [x * 2e5 for x in v]
        elif kind == 8:
            v = []
        rows.append((i if i % 40 != 39 else i - 1, v, label))
    return rows


def negatives_by_brute_force(rows, every, scale=256):
    import math

    rows = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (i, v, label) in enumerate(rows):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, n, other) for n, (j, w, other) in enumerate(rows) if len(w) == len(v) and n != k)
        for p, j, _, _ in [x for x in scored if x[3] == label][:5]:
            band = [x for x in scored if x[3] != label and 30 * -p <= 100 * -x[0] <= 90 * -p]
            out += [(i, j, r, x[1], -p, -x[0]) for r, x in enumerate(band[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(16384, 1024), (60, 7)])
def test_hard_negatives_brute_force(spark, blocks):
    rows = vectors(12, 700)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, key string, rank int").repartition(3)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 20 == 0, n_rows=blocks[0], n_anchors=blocks[1])
    want = negatives_by_brute_force(rows, 20)
    assert len(want) > 500
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == want
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []


def test_code_intervals_hold_and_filter():
    import pyarrow as pa

    g = np.random.default_rng(3)
    x = np.floor(256 * (lambda v: v / np.linalg.norm(v, axis=1)[:, None])(g.standard_normal((3000, 64))))
    code, align, rest = hard_negatives.encode(x)
    bodies = [r.astype("<i4").tobytes() for r in x]
    codes = [b"".join(p[i].tobytes() for p in (code, align, rest)) for i in range(len(x))]
    block = hard_negatives.Block(pa.table({"key": np.arange(3000), "vec_id": np.arange(3000), "label": np.zeros(3000, np.int64), "dim": [64] * 3000, "body": bodies, "code": codes}))
    for q in x[:20]:
        at = np.arange(3000)
        true = x @ q
        levels = hard_negatives.intervals(q, block, at)
        low, high = next(levels)
        widths = [np.mean(high - low)]
        while True:
            assert (low <= true).all() and (true <= high).all()
            try:
                low, high = levels.send(at)
            except StopIteration:
                break
            widths.append(np.mean(high - low))
        assert widths[-1] < 0.15 * widths[0]
        found, scores = hard_negatives.nearest(q, block, at, 5)
        assert scores.tolist() == sorted(true.astype(int).tolist(), reverse=True)[:5]
        left = hard_negatives.survivors(q, block, at, lambda low, high: high >= hard_negatives._highest(low, 5), 20)
        assert len(left) < 0.1 * len(at)


def components_by_brute_force(rows, words=4, percent=85):
    sets = {}
    for i, t in rows:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + words]) for k in range(max(len(w) - words + 1, 1))}
    root = {i: i for i in sets}

    def of(i):
        while root[i] != i:
            i = root[i]
        return i

    by = {}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)
    seen = set()
    for own in by.values():
        for k, i in enumerate(own):
            for j in own[:k]:
                if (i, j) not in seen:
                    seen.add((i, j))
                    n = len(sets[i] & sets[j])
                    if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                        a, b = of(i), of(j)
                        root[max(a, b)] = min(a, b)
    return {i: of(i) for i in sets}


def boilerplate(seed, n, common, own, near=0):
    """Texts with words in common and words of their own; every near-th is a near copy of the one before."""
    r = random.Random(seed)
    shared = [f"c{r.randrange(10**6)}" for _ in range(common)]
    rows = []
    for i in range(n):
        mine = [f"w{r.randrange(10**9)}" for _ in range(own)]
        if near and i % near == 1:
            mine = rows[-1][1].split()[common:]
            mine[-1] = "other"
        rows.append((i, " ".join(shared + mine)))
    return rows


def sets_sent(monkeypatch, spark, rows, most):
    """How many sets the join sends to cells, and its components."""
    sent, seen = jaccard_join.sent, []

    def counted(texts, targets, words):
        seen.append(targets.count())
        return sent(texts, targets, words)

    with monkeypatch.context() as m:
        m.setattr(jaccard_join, "sent", counted)
        m.setattr(jaccard_join, "SAMPLE", 8)
        docs = spark.createDataFrame(rows, "key long, text string").repartition(4)
        out = {x["key"]: x["component"] for x in jaccard_join.jaccard_classes(docs, most=most).collect()}
    return sum(seen), out


@pytest.mark.parametrize("common, own", [(40, 20), (75, 15)])
def test_boilerplate_costs_in_proportion(spark, monkeypatch, common, own):
    """Documents that share most of their words without being near copies don't meet pair by pair."""
    cost = []
    for n in (400, 800):
        rows = boilerplate(5, n, common, own, near=50)
        sent, got = sets_sent(monkeypatch, spark, rows, 1 << 13)
        assert got == components_by_brute_force(rows[:1]) | {i: i - 1 if i % 50 == 1 else i for i, _ in rows}
        cost.append(sent)
    assert cost[1] < 2.6 * cost[0] + 50 and cost[1] < 12 * 800


@pytest.mark.parametrize("splits", [0, 1])
def test_division_of_unlike_regions(spark, monkeypatch, splits):
    """Families at all likenesses around the limit, divided by further shingles."""
    r = random.Random(9)
    rows = []
    for family in range(6):
        base = [f"f{family}x{r.randrange(10**6)}" for _ in range(60)]
        for _ in range(25):
            words = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 5, 8])):
                words[r.randrange(60)] = f"n{r.randrange(10**6)}"
            rows.append((len(rows), " ".join(words[: r.choice([60, 60, 55, 50])])))
    monkeypatch.setattr(jaccard_join, "SPLITS", splits)
    for most in (1 << 11, 1 << 13):
        docs = spark.createDataFrame(rows, "key long, text string").repartition(3)
        got = {x["key"]: x["component"] for x in jaccard_join.jaccard_classes(docs, most=most).collect()}
        assert got == components_by_brute_force(rows)


def test_order_has_frequent_shingles_last():
    g = np.random.default_rng(4)
    known = np.unique(g.integers(0, 2**63, 300).astype(np.uint64))
    counts = g.integers(2, 50, len(known))
    order = jaccard_join.Order(known, counts)
    of = dict(zip(known.tolist(), counts.tolist(), strict=True))
    texts = [np.unique(np.concatenate([g.choice(known, 20), g.integers(0, 2**63, 30).astype(np.uint64)])) for _ in range(40)] + [np.zeros(0, np.uint64)]
    at = np.cumsum([0, *map(len, texts)])
    got = order.sort(np.concatenate(texts), at, order.sieve())
    for k, own in enumerate(texts):
        assert got[at[k] : at[k + 1]].tolist() == sorted(own.tolist(), key=lambda x: (of.get(x, 0), x))
    empty = jaccard_join.Order(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    assert empty.sort(texts[0], np.array([0, len(texts[0])]), empty.sieve()).tolist() == texts[0].tolist()


def badge_rows(context, n=200, seed=8):
    """Badge numbers in one context, and numbers of their shape in others."""
    r = random.Random(seed)
    rows, planted = [], {}
    for i in range(n):
        value = f"B{r.randrange(10**5, 10**6)}"
        head, tail = context(r)
        rows.append((i, f"{head}{value}{tail}", "s"))
        planted[i] = (value, f"id:{len(head)}:{len(head) + len(value)}")
    rows += [(1000 + i, f"in room R{r.randrange(10**5, 10**6)} there were {r.randrange(1000, 9999)} of {r.choice(['them', 'us'])}", "s") for i in range(n)]
    return rows, planted


def recall(spark, rows, planted, **more):
    got = {x["doc_id"]: x["spans"].split(",") for x in pii.pii_spans(frame(spark, rows), **more).collect()}
    others = sum(x.startswith("id:") for k, v in got.items() for x in v) - sum(span in got[k] for k, (_, span) in planted.items())
    return sum(span in got[k] for k, (_, span) in planted.items()) / len(planted), others


def test_pii_recall_without_shared_contexts(spark):
    """A context that no base span has teaches nothing by itself; with a fourth of the badges known, the others are found."""
    rows, planted = badge_rows(lambda r: ("my badge number is ", " since " + r.choice(["May", "June"])))
    assert recall(spark, rows, planted) == (0.0, 0)
    some = [planted[i][0] for i in range(0, 200, 4)]
    found, others = recall(spark, rows, planted, seeds=some)
    assert found >= 0.9 and others == 0
    assert recall(spark, rows, planted, seeds=["nowhere-1234"]) == (0.0, 0)


@pytest.mark.parametrize("where", ["right", "two", "line"])
def test_pii_contexts_of_each_kind(spark, where):
    """Left neighbours differ (or are too common to tell anything); the right neighbour, two words, or the line's begin are
    shared with mail addresses of the same shape."""
    r = random.Random(10)
    heads = {"right": lambda r: (f"w{r.choice('abcdefghijklmnop')}{r.choice('qrstuv')} ", " (contact) and"), "two": lambda r: (f"{r.choice('uvw')} send to ", f" {r.choice('xyz')}q"), "line": lambda r: (f"{r.choice('uvw')} said\nMy own contact: ", f" {r.choice('xyz')}q")}
    context = heads[where]
    rows, planted = badge_rows(context)
    # A mail address has a shape of its own; an ip that is known as such shares the shape of other numbers with points.
    shape = lambda: ".".join(str(r.randrange(100, 1000)) for _ in range(4))
    rows, planted = [], {}
    for i in range(240):
        ip = i % 3 > 0
        value = ".".join(str(r.randrange(100, 250)) for _ in range(4)) if ip else shape()
        while not ip and all(int(x) < 256 for x in value.split(".")):
            value = shape()
        head, tail = context(r)
        rows.append((i, f"{head}{value}{tail}", "s"))
        if not ip:
            planted[i] = (value, f"id:{len(head)}:{len(head) + len(value)}")
    plain = {"right": lambda r: f"w{r.choice('abcdefghijklmnop')}{r.choice('qrstuv')} {shape()} of it", "two": lambda r: f"it goes to {shape()} {r.choice('xyz')}q", "line": lambda r: f"a contact: {shape()} {r.choice('xyz')}q"}
    rows += [(1000 + i, plain[where](r), "s") for i in range(600)]
    found, _ = recall(spark, rows, planted)
    assert found >= 0.9


def test_components_of_awkward_edges(spark):
    from meterline.llm.components import components

    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 2), (3, 2), (7, 7), (None, 5), (5, None), (9, 8), (9, 8), (10, 9)], "a long, b long")
    assert {r["key"]: r["component"] for r in components(edges).collect()} == {1: 1, 2: 1, 3: 1, 8: 8, 9: 8, 10: 8}
    assert components(edges.limit(0)).collect() == []


def test_maximal_repeats_of_awkward_rows(spark):
    text = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(80))
    docs = frame(spark, [(None, text, "s"), (None, None, "s"), (5, text, "s"), (5, "", "s"), (6, "short", "s"), (7, "x" + text[:150] + "y", "s")])
    got = {(r["doc_id"], r["start"], r["length"]) for r in suffix_dedup.maximal_repeats(docs).collect()}
    assert {(None, 0), (5, 0), (7, 1)} <= {(d, s) for d, s, _ in got} and all(d in (None, 5, 7) and n >= 100 for d, _, n in got)
    assert suffix_dedup.maximal_repeats(docs.where("doc_id = 6")).collect() == []


@pytest.mark.parametrize("name", ["toxicity", "sketches", "quality", "jaccard_join", "alignment", "line_dedup"])
def test_very_long_text_alone(spark, name):
    r = random.Random(20)
    known = vocabulary(20, 3000)
    long = " ".join(r.choice(known) for _ in range(60_000))
    rows = PER_ROW[name](frame(spark, [(1, long, "s"), (2, "a short one", "s"), (3, long + " end", "s"), (4, "x" * 400_000, "s")])).collect()
    assert {r["doc_id"] for r in rows} == {1, 2, 3, 4} and len(rows) == 4


def test_clashing_names_are_ignored(spark):
    """Columns of the caller that are named like the operators' own ones change nothing."""
    names = ["label", "score", "key", "n", "word", "doc", "block", "parent", "root", "source", "at", "rank", "conv", "hash", "number", "length", "piece"]
    texts = [(i, " ".join(random.Random(i).choice(["bad", "good", "fine", "awful"]) for _ in range(30))) for i in range(40)]
    plain = spark.createDataFrame(texts, "doc_id long, text string")
    odd = plain.select("*", *[F.lit("odd").alias(n) for n in names])
    labels = plain.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    shown = lambda df: sorted(tuple(r[c] for c in sorted(df.columns)) for r in df.collect())
    scored = lambda df: toxicity.score(df, *toxicity.fit(df, labels)).select("doc_id", "score", "predicted")
    assert shown(scored(odd)) == shown(scored(plain))
    assert shown(packing.pack(odd).select("doc_id", "piece", "start", "length", "ids_crc32")) == shown(packing.pack(plain).select("doc_id", "piece", "start", "length", "ids_crc32"))
    talk = spark.createDataFrame([(1, 0, "u", "hello there"), (1, 1, "a", "> hello there\nyes")], "conv_id long, turn long, role string, text string")
    assert shown(quotes.link_quotes(talk.select("*", *[F.lit("odd").alias(n) for n in names]))) == shown(quotes.link_quotes(talk))
    assert shown(alignment.align(odd)) == shown(alignment.align(plain)) and shown(line_dedup.line_dedup(odd)) == shown(line_dedup.line_dedup(plain))


def text_batch():
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(3000)])
    texts = [None, "", *(" ".join(words[rng.integers(0, 3000, 300)]) for _ in range(2500)), " ".join(words[rng.integers(0, 3000, 9000)])]
    cells = [[{"cell": i % 3, "region": 1, "role": 1}] * (i % 3) for i in range(len(texts))]
    return pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "text": texts, "cells": cells, "toxic": [i % 2 for i in range(len(texts))]})


def test_memory_of_texts():
    """Beside a batch, what is computed over its texts takes memory for a part of them."""
    import tracemalloc

    batch = text_batch()
    encoder, plain = tokens.Encoder(packing.default_tokenizer()), [t or "" for t in batch.column("text").to_pylist()]
    runs = {
        "digests": lambda: jaccard_join._digests(4)([batch]),
        "shingles": lambda: jaccard_join._all_shingles(4)([batch]),
        "send": lambda: jaccard_join._send(4)([batch]),
        "tokens": lambda: encoder(plain),
        "toxicity": lambda: toxicity._count([batch]),
    }
    most = {}
    for name, run in runs.items():
        tracemalloc.start()
        for _ in run():
            pass
        most[name] = round(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()
    assert max(most.values()) < 20, most


def test_parts_of_texts():
    batch = text_batch()
    texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
    parts = list(arrays.text_parts(batch))
    assert len(parts) > 5 and max(sum(map(len, t)) for _, t in parts) <= arrays.BLOCK
    assert [k for p, _ in parts for k in p.column("key").to_pylist()] == list(range(len(texts))) and [x for _, t in parts for x in t] == texts
    assert [k for p, _ in arrays.text_parts(batch.slice(1, 5), "cells", most=10) for k in p.column("key").to_pylist()] == [1, 2, 3, 4, 5]
    assert list(arrays.text_parts(batch.slice(0, 0))) == []
    name, at = jaccard_join.shingle_sets(texts)
    got = [r for b in jaccard_join._digests(4)([batch]) for r in b.to_pylist()]
    assert [r["key"] for r in got] == list(range(len(texts))) and [r["n"] for r in got] == np.diff(at).tolist()
    send = [r for b in jaccard_join._send(4)([batch]) for r in b.to_pylist()]
    assert [r["key"] for r in send] == [i for i in range(len(texts)) for _ in range(i % 3)]
    assert all(r["set"] == name[at[r["key"]] : at[r["key"] + 1]].tobytes() for r in send)
    encoder, plain = tokens.Encoder(packing.default_tokenizer()), [t.decode() for t in texts]
    assert [x.tolist() for x in encoder(plain)] == [encoder.slow.encode(t, add_special_tokens=False).ids for t in plain]
