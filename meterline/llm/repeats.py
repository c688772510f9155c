"""Removal of repeated windows, shared by substring dedup (words) and suffix-array dedup (bytes).

Every window has one *label* that depends on its content alone, so equal windows have equal labels. Neighbouring
windows of one label form a block. The plan is

1. documents are shuffled once by key; exact copies fall back on the first of them,
2. (label, key) of each block is shuffled by label; labels that occur once are unique text (a block that may repeat in
   itself counts twice, a long one once for each LONG windows, so that counts bound bytes). Labels that a sample finds
   very often are known to be repeated; their rows are dealt over all tasks and not counted,
3. documents with repeated labels ship the text of those blocks, by label,
4. where equal windows now meet, all but the first occurrence of each are marked,
5. marked ranges go back to the documents.

Nothing is compared outside of a label, each step streams over its partition, and a hot label keeps one hash for each
different window of its group only. Beyond `hot` blocks of one label, step 3 ships single windows under their own hash
instead: equal windows still meet, and a group then needs constant memory. What its own chunk has shown to be a repeat
is dealt by document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import as_bytes, chunks, signed
from .common import keyed, unkeyed, with_group

LONG = 4
"""Lengths of a window after which a block counts once more."""
HEAVY = 4096
"""Labels that are dealt over all tasks, at most: those that the sample finds most. Any other has at most about one row in
HEAVY."""

Blocks = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]
"""text number, label, first window, last window (in units from the text's start), whether it may repeat in itself"""


class Unit:
    """How texts are cut: `blocks` labels windows, `cuts` gives the byte limits of a text's units, and
    `digests` two hashes for each window of each context."""

    window: int
    hot: int
    """Blocks of one label beyond which its windows are dealt by their own hash."""
    sample = 64
    """One document in this many tells which labels are heavy. Results do not depend on it."""

    def blocks(self, texts: list[bytes]) -> Blocks:
        raise NotImplementedError

    def size(self, text: bytes) -> int:
        raise NotImplementedError

    def context(self, text: bytes, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        raise NotImplementedError

    def digests(self, contexts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For all windows: number of the context, two hashes."""
        raise NotImplementedError

    def marker(self) -> Callable:
        """What marks repeats where equal labels meet."""
        return _mark(self)

    def finish(self, text: bytes, spans: np.ndarray) -> tuple[int, int, int, str]:
        """size, removed, number of removed runs, SHA-256 of what is kept"""
        raise NotImplementedError


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted, joined half-open ranges."""
    if len(spans) < 2:
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    at = np.flatnonzero(new)
    return np.stack([spans[at, 0], reach[np.r_[at[1:] - 1, len(spans) - 1]]], 1)


def _label(unit: Unit) -> Callable:
    """(label, key) of each block; twice for one that may repeat in itself, more often for a long one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            texts = as_bytes(batch.column("text"))
            for a, b in chunks([len(t) for t in texts]):
                which, label, first, last, loops = unit.blocks(texts[a:b])
                times = 1 + np.maximum(loops, (last - first) // (LONG * unit.window)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(signed(np.repeat(label, times))), pa.array(keys[a:b][np.repeat(which, times)])], names=["label", "key"])

    return run


def _singly(unit: Unit, key: int, first: int, last: int, context: bytes, shrink: bool) -> Iterator[tuple]:
    """The windows of a block under their own hashes; with shrink, those that occur in it before go as ranges without a
    context."""
    _, one, _ = unit.digests([context])
    inner = np.arange(last - first + 1)
    seen: set[bytes] = set()
    since = None
    for at, (name, text) in enumerate(zip(signed(one).tolist(), unit.context(context, inner, inner), strict=True), first):
        if shrink and text in seen:
            since = at if since is None else since
            continue
        if since is not None:
            yield key, key, since, at - 1, None
            since = None
        seen.add(text)
        yield name, key, at, at, text
    if since is not None:
        yield key, key, since, last, None


def _ship(unit: Unit, shrink: bool = True) -> Callable:
    """(label, key, first, last, context): the text of repeated blocks. With shrink, of equal contexts in one chunk only
    the first is shipped; the others, whose windows all start earlier elsewhere, go without one and are dealt by key, as
    they have to meet nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy()
            texts = as_bytes(batch.column("text"))
            wanted, hot = batch.column("labels").to_pylist(), batch.column("hot").to_pylist()
            for a, b in chunks([len(t) for t in texts]):
                order = sorted(range(a, b), key=lambda i: keys[i])
                which, label, first, last, _ = unit.blocks([texts[i] for i in order])
                label = signed(label)
                limit = np.searchsorted(which, np.arange(len(order) + 1))
                seen: set[tuple[int, bytes]] = set()
                out: tuple[list, ...] = ([], [], [], [], [])
                for k, i in enumerate(order):
                    own = slice(limit[k], limit[k + 1])
                    use = np.isin(label[own], np.asarray(wanted[i]))
                    names, s, e = label[own][use], first[own][use], last[own][use]
                    key = int(keys[i])
                    for name, s_, e_, context in zip(names.tolist(), s.tolist(), e.tolist(), unit.context(texts[i], s, e), strict=True):
                        known = shrink and (name, context) in seen
                        seen.add((name, context))
                        if known:
                            rows = [(key, key, s_, e_, None)]
                        elif hot[i] and name in hot[i]:
                            rows = _singly(unit, key, s_, e_, context, shrink)
                        else:
                            rows = [(name, key, s_, e_, context)]
                        for row in rows:
                            for o, v in zip(out, row, strict=True):
                                o.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int32()), pa.array(out[3], pa.int32()), pa.array(out[4], pa.binary())],
                    names=["label", "key", "first", "last", "context"],
                )

    return run


def _mark(unit: Unit) -> Callable:
    """Rows come sorted by label, key and first window. Each window whose content was met under the same label
    before is marked; neighbours are marked as one range."""
    pair = np.dtype([("a", "u8"), ("b", "u8")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_label, seen = None, np.zeros(0, pair)
        for batch in batches:
            labels, keys, firsts, lasts = (batch.column(n).to_numpy() for n in ("label", "key", "first", "last"))
            contexts = batch.column("context").to_pylist()
            for a, b in chunks([len(c or b"") + 1 for c in contexts], 1 << 20):
                kept = [i for i in range(a, b) if contexts[i] is not None]
                bare = [i for i in range(a, b) if contexts[i] is None]
                out_key, out_from, out_to = [keys[bare]], [firsts[bare]], [lasts[bare] + unit.window]
                if kept:
                    kept_at = np.asarray(kept)
                    which, one, two = unit.digests([contexts[i] for i in kept])
                    start = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])
                    place = np.arange(len(which)) - np.repeat(start, np.diff(np.r_[start, len(which)])) + firsts[kept_at[which]]
                    group = labels[kept_at[which]]
                    if open_label is not None and group[0] == open_label and len(seen):
                        own = group == open_label
                        old = np.zeros(len(group), bool)
                        mine = np.empty(int(own.sum()), pair)
                        mine["a"], mine["b"] = one[own], two[own]
                        old[own] = np.isin(mine, seen) if len(mine) < 64 else _in_sorted(mine, seen)
                    else:
                        old = np.zeros(len(group), bool)
                        if group[0] != open_label:
                            seen = np.zeros(0, pair)
                    order = np.lexsort((np.arange(len(group)), two, one, group))
                    again = np.r_[False, (group[order][1:] == group[order][:-1]) & (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])]
                    repeat = old.copy()
                    repeat[order] |= again
                    tail = group == group[-1]
                    fresh = np.empty(int((tail & ~repeat).sum()), pair)
                    fresh["a"], fresh["b"] = one[tail & ~repeat], two[tail & ~repeat]
                    if group[-1] != open_label:
                        open_label, seen = group[-1], np.zeros(0, pair)
                    seen = np.sort(np.concatenate([seen, fresh]), order=["a", "b"]) if len(fresh) else seen
                    hit = np.flatnonzero(repeat)
                    if len(hit):
                        new = np.r_[True, (hit[1:] != hit[:-1] + 1) | (which[hit[1:]] != which[hit[:-1]])]
                        head = np.flatnonzero(new)
                        foot = np.r_[head[1:] - 1, len(hit) - 1]
                        out_key.append(keys[kept_at[which[hit[head]]]])
                        out_from.append(place[hit[head]])
                        out_to.append(place[hit[foot]] + unit.window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(out_key).astype(np.int64)), pa.array(np.concatenate(out_from).astype(np.int32)), pa.array(np.concatenate(out_to).astype(np.int32))],
                    names=["key", "s", "e"],
                )

    return run


def _in_sorted(mine: np.ndarray, seen: np.ndarray) -> np.ndarray:
    at = np.searchsorted(seen["a"], mine["a"])
    hit = np.zeros(len(mine), bool)
    for step in range(4):
        i = np.minimum(at + step, len(seen) - 1)
        hit |= (seen["a"][i] == mine["a"]) & (seen["b"][i] == mine["b"])
    return hit


def _finish(unit: Unit) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies = batch.column("copy").to_numpy(zero_copy_only=False)
            found = batch.column("spans").to_pylist()
            rows = []
            for text, copy, spans in zip(as_bytes(batch.column("text")), copies, found, strict=True):
                n = unit.size(text)
                if copy:
                    cuts = np.array([[0, n]]) if n >= unit.window else np.zeros((0, 2), np.int64)
                else:
                    cuts = merged(np.array([(x["s"], x["e"]) for x in spans], np.int64)) if spans else np.zeros((0, 2), np.int64)
                rows.append(unit.finish(text, cuts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *(pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string())))],
                names=["key", "size", "n_removed", "n_spans", "kept_sha256"],
            )

    return run


def shared_texts(rows: DataFrame) -> DataFrame:
    """(key, text), shuffled once by key for all that reads it.

    The filter drops nothing. It keeps the optimiser from adding one below some of the uses of this shuffle, which would
    then not be shared."""
    return rows.where("key is not null").select("key", F.coalesce("text", F.lit("")).alias("text")).repartition("key")


def heavy_labels(rows: DataFrame, unit: Unit, hot: int) -> DataFrame:
    """Labels whose number of blocks, by a sample of documents, is above `hot`: HEAVY at most. Each was seen twice at
    least, so it is repeated, whatever its true number."""
    some = rows.where(F.pmod(F.xxhash64("key"), F.lit(unit.sample)) == 0).select("key", F.coalesce("text", F.lit("")).alias("text"))
    seen = some.mapInArrow(_label(unit), "label long, key long").groupBy(F.col("label").alias("heavy")).count()
    return seen.where((F.col("count") > 1) & (F.col("count") * unit.sample > hot)).orderBy(F.desc("count"), "heavy").limit(HEAVY).select("heavy")


def contexts_by_label(own: DataFrame, texts: DataFrame, heavy: DataFrame, unit: Unit, hot: int, shrink: bool = True) -> DataFrame:
    """(label, key, first, last, context) of own's repeated blocks, sorted within partitions of the label."""
    dealt = F.when(F.col("heavy").isNotNull(), F.pmod(F.hash("key"), F.lit(1 << 20)) + 1).otherwise(0)
    repeated = (
        own.mapInArrow(_label(unit), "label long, key long")
        .join(F.broadcast(heavy), F.col("label") == F.col("heavy"), "left")
        .select("label", "key", dealt.alias("part"))
        .repartition("label", "part")
        .withColumn("n", F.when(F.col("part") > 0, hot + 1).otherwise(F.count(F.lit(1)).over(Window.partitionBy("label", "part"))))
        .where("part > 0 or n > 1")
    )
    per_doc = repeated.groupBy(F.col("key").alias("block_key")).agg(F.collect_set("label").alias("labels"), F.collect_set(F.when(F.col("n") > hot, F.col("label"))).alias("hot"))
    shipped = (
        texts.join(per_doc.hint("shuffle_hash"), F.col("key") == F.col("block_key"))
        .select("key", "text", "labels", "hot")
        .mapInArrow(_ship(unit, shrink), "label long, key long, first int, last int, context binary")
    )
    return shipped.repartition("label").sortWithinPartitions("label", "key", "first")


def shipped_contexts(rows: DataFrame, unit: Unit, shrink: bool = True) -> DataFrame:
    """contexts_by_label of all rows (key, text)."""
    texts = shared_texts(rows)
    return contexts_by_label(texts, texts, heavy_labels(rows, unit, unit.hot), unit, unit.hot, shrink)


def remove_repeats(docs: DataFrame, unit: Unit, text: str = "text", hot: int | None = None) -> DataFrame:
    """doc_id, size, n_removed, n_spans, kept_sha256 of each row of docs, without what occurs earlier.

    Null texts are empty; an empty table gives an empty table; other columns are ignored. doc_id null or repeated: see
    common.with_key. Texts shorter than a window lose nothing."""
    rows, ids = keyed(docs, text)
    texts = shared_texts(rows)
    named = rows.select("key", F.md5(F.coalesce("text", F.lit(""))).alias("name"))
    groups = named.groupBy("name").agg(F.min("key").alias("first_key"), F.count(F.lit(1)).alias("n")).where("n > 1")
    copies = (
        with_group(named, groups, "name", "key")
        .where("key > first_key")
        .select(F.col("key").alias("copy_key"))
        .repartition("copy_key")
    )
    flagged = texts.join(copies.hint("shuffle_hash"), F.col("key") == F.col("copy_key"), "left")
    own = flagged.where("copy_key is null").select("key", "text")
    hot = unit.hot if hot is None else hot
    marked = contexts_by_label(own, texts, heavy_labels(rows, unit, hot), unit, hot).mapInArrow(unit.marker(), "key long, s int, e int")
    spans = marked.groupBy(F.col("key").alias("span_key")).agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    out = (
        flagged.join(spans.hint("shuffle_hash"), F.col("key") == F.col("span_key"), "left")
        .select("key", "text", F.col("copy_key").isNotNull().alias("copy"), "spans")
        .mapInArrow(_finish(unit), "key long, size long, n_removed long, n_spans long, kept_sha256 string")
    )
    return unkeyed(out, ids)


def blocks_of(label: np.ndarray, valid: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window of each stretch of valid windows that share a label and a text."""
    if not len(label):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.r_[True, (label[1:] != label[:-1]) | (text[1:] != text[:-1]) | ~valid[:-1]] & valid
    first = np.flatnonzero(new)
    stop = np.r_[new[1:], True] | np.r_[~valid[1:], True]
    return first, np.flatnonzero(stop & valid)


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
