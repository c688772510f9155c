"""N-gram Jaccard join in metric space.

One minus the Jaccard likeness is a metric, but unrelated documents are all at distance 1, so pivots chosen over a whole
corpus would replicate everything. Regions are therefore first found where documents can be near at all, and the metric
takes over inside them:

1. Documents with equal shingle sets become one class; its least key stands for it.
2. In a fixed order of all shingles, two sets with likeness t share at least l of their first n - ceil(t n) + l shingles.
   Those prefixes are shuffled by shingle. A set that does not share as many shingles as any partner would need is out.
   The order has shingles last that a sample of documents finds often (most frequent ones at the end, see Order), so that
   what very many documents have in common stays out of prefixes.
3. The least key among the sets that share a shingle is a pivot; its region holds all sets that share a shingle with it
   there. A set may stay out of regions with few of its shared shingles (see regions_of); every link still lies whole
   within a region.
4. A region of more than `most` bytes is split by Spark (see split_regions): all its sets are measured against its pivot,
   in blocks. Those near enough are linked to it and need not meet each other; those further off than twice the distance
   of a link can't link with them, and become a region of their own, with a new pivot; those between meet them. What
   stays large, of sets unlike their pivots, is divided once more by shared prefix shingles, in an order by how often
   those regions have them and with prefixes as short as the sizes of partners allow (see divided).
5. A region within one task is a Voronoi recursion (see region_links): pivots far from each other, each set in the cell of
   its nearest one and, by the triangle inequality, in every cell that a partner may have; cells recurse, and what is
   left is verified on the whole sets, unless the two are known to be connected.
6. Links become components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .arrays import CHUNK, LOWER, SEEDS, U64, both, joined, mix, names, signed, text_parts, unsigned, word_limits
from .common import LARGEST, cut, documents, keyed, with_group, with_key
from .components import components

WORDS = 4
PERCENT = 85
CLASSES = 64
SPARE = 16
"""One shingle in this many is added to prefixes, and is what partners must share at least."""
MOST = 1 << 24
"""Bytes of sets that are joined in one task, at most (twice that for two blocks)."""
SPLITS = 4
"""Pivots in turn that a large region is split by; what is still large then is divided by further shingles."""
FREQUENT = 1 << 18
"""Shingles, at most, whose place in the order follows how often they were found; 12 bytes each are broadcast."""
STEP = 0.7
"""Ratio of neighbouring size classes."""
SAMPLE = 64
"""One document in this many is looked at for shingles that very many share."""
LEAF = 24
PIVOTS = 8


def shingle_sets(texts: list[bytes], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and each text's place. A text of fewer words is one shingle."""
    buf, at = joined(texts)
    buf = LOWER[buf]
    start, end = word_limits(buf)
    doc = np.searchsorted(at, start, "right") - 1
    count = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), np.int64)
    begin = np.cumsum(count) - count
    own = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    which = np.repeat(np.arange(len(texts)), own)
    first = np.arange(len(which)) - np.repeat(np.cumsum(own) - own, own) + begin[which]
    word = np.append(names(buf, start, end), U64(0))
    name = word[first]
    for k in range(1, words):
        name = both(name, word[np.where(k < count[which], first + k, len(word) - 1)])
    order = np.lexsort((name, which))
    name, which = name[order], which[order]
    new = np.r_[True, (name[1:] != name[:-1]) | (which[1:] != which[:-1])] if len(name) else np.zeros(0, bool)
    name, which = name[new], which[new]
    return name, np.searchsorted(which, np.arange(len(texts) + 1))


def _digests(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_parts(batch):
                name, at = shingle_sets(texts, words)
                sums = [np.r_[U64(0), np.cumsum(mix(name ^ U64(k)))] for k in SEEDS]
                one, two = (s[at[1:]] - s[at[:-1]] for s in sums)
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(np.diff(at).astype(np.int64)), pa.array(signed(one)), pa.array(signed(two))], names=["key", "n", "d1", "d2"])

    return run


def _all_shingles(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_parts(batch):
                found, n = np.unique(shingle_sets(texts, words)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(n)], names=["shingle", "n"])

    return run


class Order:
    """An order of all shingles: those of a table come last, by how often they were found; the others go by their hash.
    Any fixed order gives right results; this one keeps what many documents share out of prefixes."""

    SIEVE = 1 << 22

    def __init__(self, shingles: np.ndarray, counts: np.ndarray):
        at = np.argsort(shingles)
        self.known = shingles[at]
        rank = np.empty(len(at), np.int32)
        rank[np.lexsort((shingles, counts))] = np.arange(1, len(at) + 1)
        self.rank = rank[at]

    @classmethod
    def of(cls, texts: DataFrame, words: int, most: int = FREQUENT) -> Order:
        """From the texts (a column `text`) whose shingles are counted; the `most` frequent ones that two have."""
        counted = texts.select("text").mapInArrow(_all_shingles(words), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
        found = counted.where("n > 1").orderBy(F.desc("n"), "shingle").limit(most).toPandas()
        return cls(unsigned(found["shingle"].to_numpy(np.int64)), found["n"].to_numpy(np.int64))

    def sieve(self) -> np.ndarray:
        """Which low bits the known shingles have: most others are told apart by one look."""
        out = np.zeros(self.SIEVE, bool)
        out[(self.known & U64(self.SIEVE - 1)).astype(np.int64)] = True
        return out

    def sort(self, name: np.ndarray, at: np.ndarray, sieve: np.ndarray) -> np.ndarray:
        """name, sorted by hash within each text, in this order within each text."""
        hit = np.flatnonzero(sieve[(name & U64(self.SIEVE - 1)).astype(np.int64)]) if len(self.known) else np.zeros(0, np.int64)
        slot = np.minimum(np.searchsorted(self.known, name[hit]), max(len(self.known) - 1, 0))
        same = self.known[slot] == name[hit]
        if not same.any():
            return name
        rank = np.zeros(len(name), np.int32)
        rank[hit[same]] = self.rank[slot[same]]
        return name[np.lexsort((rank, np.repeat(np.arange(len(at) - 1), np.diff(at))))]


def prefix_length(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    return np.minimum(n, n - (-(-percent * n // 100)) + 1 + n // SPARE)


def _prefixes(words: int, percent: int, order: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = order.value.sieve()
        for batch in batches:
            for part, texts in text_parts(batch):
                name, at = shingle_sets(texts, words)
                name = order.value.sort(name, at, sieve)
                n = np.diff(at)
                take = prefix_length(n, percent)
                which = np.repeat(np.arange(len(texts)), take)
                place = np.arange(len(which)) - np.repeat(np.cumsum(take) - take, take) + at[which]
                yield pa.RecordBatch.from_arrays([pa.array(signed(name[place])), pa.array(part.column("key").to_numpy()[which]), pa.array(n[which].astype(np.int32))], names=["shingle", "key", "n"])

    return run


def _short_prefixes(words: int, percent: int, order: Broadcast):
    """(region, shingle, key, n, first) of each region that a set is in. Of two linked sets, the smaller has a common shingle
    among its first n - ceil(2 t n / (1 + t)) + 1 (`first`), which the larger has among its first n - ceil(t n) + 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = order.value.sieve()
        for batch in batches:
            for part, texts in text_parts(batch, "regions"):
                keys, regions = part.column("key").to_numpy(), part.column("regions").to_pylist()
                name, at = shingle_sets(texts, words)
                name = order.value.sort(name, at, sieve)
                n = np.diff(at)
                take = n - (-(-percent * n // 100)) + 1
                first = n - (-(-2 * percent * n // (100 + percent))) + 1
                times = np.array([len(r) for r in regions])
                which = np.repeat(np.arange(len(texts)), take * times)
                step = np.arange(len(which)) - np.repeat(np.cumsum(take * times) - take * times, take * times)
                inner = step % np.maximum(take[which], 1)
                region = np.array([r for own, k in zip(regions, take.tolist(), strict=True) for r in own for _ in range(k)], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(region), pa.array(signed(name[at[which] + inner])), pa.array(keys[which]), pa.array(n[which]), pa.array(inner < first[which])], names=["region", "shingle", "key", "n", "first"])

    return run


def regions_of(n: int, pivots: list[tuple[int, int]], percent: int = PERCENT) -> list[int]:
    """The regions that a set of n shingles joins, from (shared shingles, pivot).

    Partners share `need` shingles of their prefixes at least, so a set may stay out of regions as long as those hold
    fewer than half of that in all: whatever two sets stay out of, they still meet."""
    free = (percent * n // 100) // SPARE // 2
    out = []
    for c, pivot in sorted(pivots):
        if c <= free:
            free -= c
        else:
            out.append(pivot)
    return out


def _members(percent: int):
    """(region, key, n) of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes = batch.column("key").to_numpy(), batch.column("n").to_numpy()
            found = [regions_of(int(n), [(x["c"], x["pivot"]) for x in p], percent) for n, p in zip(sizes, batch.column("pivots").to_pylist(), strict=True)]
            times = [len(f) for f in found]
            yield pa.RecordBatch.from_arrays([pa.array([r for f in found for r in f], pa.int64()), pa.array(np.repeat(keys, times)), pa.array(np.repeat(sizes, times).astype(np.int64))], names=["region", "key", "n"])

    return run


def _send(words: int):
    """(cell, region, role, key, set) for each cell that a document is sent to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_parts(batch, "cells"):
                keys, cells = part.column("key").to_pylist(), part.column("cells").to_pylist()
                name, at = shingle_sets(texts, words)
                rows = []
                for i in range(len(texts)):
                    own = name[at[i] : at[i + 1]].tobytes()
                    rows += [(c["cell"], c["region"], c["role"], keys[i], own) for c in cells[i]]
                    if len(rows) * len(own) > CHUNK:
                        yield _batch(rows)
                        rows = []
                yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["cell", "region", "role", "key", "set"])


def sent(texts: DataFrame, targets: DataFrame, words: int) -> DataFrame:
    """The sets of targets (key, cell, region, role), sorted by cell, role within partitions of the cell."""
    cells = targets.groupBy(F.col("key").alias("member")).agg(F.collect_list(F.struct("cell", "region", "role")).alias("cells"))
    rows = texts.join(cells.hint("shuffle_hash"), F.col("key") == F.col("member")).select("key", "text", "cells")
    return rows.mapInArrow(_send(words), "cell long, region long, role int, key long, set binary").repartition("cell").sortWithinPartitions("cell", "role", "key")


class Forest:
    """Which sets are known to be connected."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def of(self, at: np.ndarray) -> np.ndarray:
        up = self.root[at]
        while (up != self.root[up]).any():
            up = self.root[up]
        self.root[at] = up
        return up

    def join(self, i: int, j: int) -> bool:
        a, b = self.of(np.array([i, j]))
        self.root[max(a, b)] = min(a, b)
        return bool(a != b)


class Region:
    """Sets within one task and the links found among them (a spanning forest of what links connect)."""

    def __init__(self, keys: list[int], sets: list[np.ndarray], percent: int):
        self.keys, self.sets, self.percent = keys, sets, percent
        self.size = np.array([len(x) for x in sets])
        self.begin = np.cumsum(self.size) - self.size
        self.flat = np.concatenate(sets)
        where = np.repeat(np.arange(len(sets)), self.size) * CLASSES + (self.flat >> U64(58)).astype(np.int64)
        self.vectors = np.bincount(where, minlength=len(sets) * CLASSES).reshape(-1, CLASSES).astype(np.int32)
        self.forest = Forest(len(sets))
        self.links: list[tuple[int, int]] = []
        self.reach = 1 - percent / 100 + 1e-9

    def link(self, i: int, j: int) -> None:
        if self.forest.join(i, j):
            self.links.append((self.keys[i], self.keys[j]))

    def shared(self, p: int, at: np.ndarray) -> np.ndarray:
        """How many shingles each of the sets `at` shares with set p."""
        n = self.size[at]
        head = np.cumsum(n) - n
        values = self.flat[np.repeat(self.begin[at] - head, n) + np.arange(int(n.sum()))]
        own = self.sets[p]
        hit = own[np.minimum(np.searchsorted(own, values), len(own) - 1)] == values
        return np.add.reduceat(hit, head, dtype=np.int64)

    def far(self, p: int, at: np.ndarray) -> np.ndarray:
        """Distances of the sets `at` to set p; those near enough are linked to it."""
        n = self.shared(p, at)
        union = self.size[at] + self.size[p] - n
        for i in at[(100 * n >= self.percent * union) & (at != p)].tolist():
            self.link(p, i)
        return 1 - n / union

    def pairs(self, a: np.ndarray, b: np.ndarray, near: np.ndarray) -> None:
        """Verifies the pairs of a and b that `near` marks, where sizes and counts by class allow a link."""
        size, most = self.size, (100 - self.percent) / (100 + self.percent)
        small, large = np.minimum(size[a][:, None], size[b]), np.maximum(size[a][:, None], size[b])
        i, j = np.nonzero(near & (small * 100 >= self.percent * large) & (self.forest.of(a)[:, None] != self.forest.of(b)))
        for k in range(0, len(i), 8192):
            x, y = a[i[k : k + 8192]], b[j[k : k + 8192]]
            ok = np.abs(self.vectors[x] - self.vectors[y]).sum(1) <= most * (size[x] + size[y]) + 1e-9
            for p, q in zip(x[ok].tolist(), y[ok].tolist(), strict=True):
                if p != q and self.forest.root[p] != self.forest.root[q]:
                    n = len(np.intersect1d(self.sets[p], self.sets[q], assume_unique=True))
                    if 100 * n >= self.percent * (size[p] + size[q] - n):
                        self.link(p, q)

    def windows(self, at: np.ndarray, far: np.ndarray, block: int = 256) -> None:
        """Pairs whose distances to one pivot differ by no more than a link's."""
        order = np.argsort(far, kind="stable")
        at, far = at[order], far[order]
        for a in range(0, len(at), block):
            b = min(a + block, len(at))
            last = int(np.searchsorted(far, far[b - 1] + self.reach, "right"))
            for c in range(a, last, block):
                d = min(c + block, last)
                near = np.abs(far[a:b, None] - far[None, c:d]) <= self.reach
                self.pairs(at[a:b], at[c:d], near)

    def cell(self, at: np.ndarray) -> None:
        """Finds the links among the sets `at`: pivots more than two links apart; a set goes to the cell of its nearest
        pivot and to each cell whose pivot is at most two links further. Of two linked sets each so comes to the other's
        cell. Cells that hardly shrink are searched by windows."""
        if len(at) <= LEAF:
            self.pairs(at, at, np.ones((len(at), len(at)), bool))
            return
        far = [self.far(int(at[0]), at)]
        nearest = far[0]
        while len(far) < PIVOTS and nearest.max() > 2 * self.reach:
            far.append(self.far(int(at[np.argmax(nearest)]), at))
            nearest = np.minimum(nearest, far[-1])
        for own in far:
            inside = own <= nearest + 2 * self.reach
            home = own <= nearest
            if (self.forest.of(at[inside]) == self.forest.root[at[inside][0]]).all() or not home.any():
                continue
            if len(far) > 1 and inside.sum() <= 0.7 * len(at):
                self.cell(at[inside])
            else:
                self.windows(at[inside], own[inside])


def region_links(keys: list[int], sets: list[np.ndarray], percent: int = PERCENT, united: int = 0) -> list[tuple[int, int]]:
    """Links that connect whatever is connected within the region (a spanning forest of them). The first `united` sets are
    known to be connected from elsewhere."""
    region = Region(keys, sets, percent)
    region.forest.root[:united] = 0
    region.cell(np.arange(len(keys)))
    return region.links


def _join(percent: int):
    """Links of cells. Rows come sorted by cell and role; sets of role 0 are known to be connected."""

    def flush(rows: list[tuple]) -> list[tuple[int, int]]:
        own = {key: (role, values) for role, key, values in reversed(rows)}
        order = sorted(own, key=lambda k: (own[k][0], k))
        united = sum(own[k][0] == 0 for k in order)
        return region_links(order, [own[k][1] for k in order], percent, united) if len(order) > max(united, 1) else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []
        for batch in batches:
            out = []
            for c, role, k, x in zip(*(batch.column(n).to_pylist() for n in ("cell", "role", "key", "set")), strict=True):
                if c != cell:
                    out += flush(rows)
                    cell, rows = c, []
                rows.append((role, k, np.frombuffer(x, U64)))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
        out = flush(rows)
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return run


def _measure(percent: int):
    """(region, key, n, pivot, star, near): each set against its cell's pivot, which comes first (role 0). Nothing but the
    pivot's set is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = pivot = own = None
        for batch in batches:
            rows = []
            for c, region, role, k, x in zip(*(batch.column(n).to_pylist() for n in ("cell", "region", "role", "key", "set")), strict=True):
                values = np.frombuffer(x, U64)
                if not role:
                    cell, pivot, own = c, k, values
                elif c != cell:
                    raise ValueError(f"cell {c} has no pivot")
                else:
                    n = len(np.intersect1d(own, values, assume_unique=True))
                    union = len(own) + len(values) - n
                    rows.append((region, k, len(values), pivot, 100 * n >= percent * union, union - n <= (2 - percent / 50 + 1e-9) * union))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["region", "key", "n", "pivot", "star", "near"])

    return run


def sized(members: DataFrame) -> DataFrame:
    """members (region, key, n) with the bytes of their region and its least key."""
    groups = members.groupBy("region").agg((8 * F.sum("n")).alias("bytes"), F.min("key").alias("pivot"), F.count(F.lit(1)).alias("n"))
    return with_group(members.select("region", "key", F.col("n").alias("size")), groups, "region", "key").select("region", "key", F.col("size").alias("n"), "bytes", "pivot")


def named(*parts) -> Column:
    """A name for whole numbers; hashes of one number differ by type, so all are made one."""
    return F.xxhash64(*[(F.col(p) if isinstance(p, str) else p if isinstance(p, Column) else F.lit(p)).cast("long") for p in parts])


def numbers(n: Column) -> Column:
    return F.sequence(F.lit(0), (n - 1).cast("int"))


def split_regions(members: DataFrame, texts: DataFrame, words: int, percent: int, most: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Links and cells (key, cell, region, role) of large regions, from members (region, key, n, bytes, pivot).

    Each turn measures all sets of a region against its pivot, in blocks of `most` bytes that the pivot's set is sent to.
    Sets within a link's distance (the star) are linked to the pivot. A set outside of it can link with one inside only
    within two such distances: those meet the star's blocks. The sets outside then are a region of their own. So a group
    of near copies costs what it holds, not its square. Regions that stay large after SPLITS turns, whose sets are
    unlike their pivots, are divided; a part of them that still is large, though few of its shingles are shared by many,
    is joined by size classes and pairs of blocks."""
    links, cells = [], []
    blocks = lambda b: F.ceil(F.col(b) / most).cast("int")
    deal = lambda b: F.pmod(F.xxhash64("key", F.lit(7)), blocks(b))
    for turn in range(SPLITS):
        own = members.select("key", named("region", turn, deal("bytes")).alias("cell"), "region", F.lit(1).alias("role"))
        heads = members.where("key = pivot").select("key", "region", F.explode(numbers(blocks("bytes"))).alias("i")).select("key", named("region", turn, "i").alias("cell"), "region", F.lit(0).alias("role"))
        measured = cut(sent(texts, own.union(heads), words).mapInArrow(_measure(percent), "region long, key long, n long, pivot long, star boolean, near boolean"))
        links.append(measured.where("star and key <> pivot").select(F.col("pivot").alias("a"), F.col("key").alias("b")))
        star_bytes, near_bytes = (8 * F.sum(F.when(F.expr(c), F.col("n")).otherwise(0)) for c in ("star", "near and not star"))
        counts = measured.groupBy("region").agg(star_bytes.alias("stars"), near_bytes.alias("nears"), F.count(F.lit(1)).alias("n"))
        between = with_group(measured.where("near").select("region", "key", "star"), counts.where("nears > 0"), "region", "key")
        across = between.select("key", "region", "star", F.when(F.col("star"), deal("stars")).otherwise(deal("nears")).alias("own"), F.explode(numbers(F.when(F.col("star"), blocks("nears")).otherwise(blocks("stars")))).alias("other"))
        pair = named("region", turn, F.when(F.col("star"), F.col("own")).otherwise(F.col("other")), F.when(F.col("star"), F.col("other")).otherwise(F.col("own")))
        cells.append(across.select("key", pair.alias("cell"), "region", F.when(F.col("star"), 0).otherwise(1).alias("role")))
        rest = cut(sized(measured.where("not star").select("region", "key", "n")))
        cells.append(rest.where(F.col("bytes") <= most).select("key", named("region", turn, -1).alias("cell"), "region", F.lit(1).alias("role")))
        members = rest.where(F.col("bytes") > most)
        if not members.head(1):
            return links, cells
    members = cut(divided(members, texts, words, percent))
    cells.append(members.where(F.col("bytes") <= most).select("key", named("region", SPLITS, -1).alias("cell"), "region", F.lit(1).alias("role")))
    members = members.where(F.col("bytes") > most)
    # Two sets of one class or of neighbouring ones, where the larger reaches down to the smaller's class, meet.
    k = F.floor(F.log(F.col("n").cast("double")) / -float(np.log(STEP)) + 1e-9)
    joins = F.col("n") * 100 >= percent * F.pow(F.lit(1 / STEP), k + 1) - 1e-6
    classed = members.select("key", "region", "bytes", deal("bytes").alias("own"), F.explode(F.when(joins, F.array(k, k + 1)).otherwise(F.array(k))).alias("class"), F.col("n"))
    grid = classed.select("key", "region", "class", "own", F.explode(numbers(blocks("bytes"))).alias("other"))
    cells.append(grid.select("key", named("region", SPLITS, "class", F.least("own", "other"), F.greatest("own", "other")).alias("cell"), "region", F.lit(1).alias("role")))
    return links, cells


def divided(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """members (region, key, n, bytes, pivot) of regions that are large and unlike, as members of smaller ones.

    Shingles are ordered by how often the sets of these regions have them (counted over all of them), so prefixes hold what
    sets have for themselves. Sets meet where one has a shared shingle among its first ones (see _short_prefixes): all that
    share a shingle join the region of the least key that does so. What the whole family has in common is among nobody's
    first ones as long as sets differ by more than linked ones may; such a family falls apart."""
    inside = members.groupBy(F.col("key").alias("member")).agg(F.collect_list("region").alias("regions"))
    own = texts.join(inside.hint("shuffle_hash"), F.col("key") == F.col("member")).select("key", "text", "regions")
    order = texts.sparkSession.sparkContext.broadcast(Order.of(own, words))
    prefixes = own.mapInArrow(_short_prefixes(words, percent, order), "region long, shingle long, key long, n long, first boolean")
    found = cut(prefixes.select(named("region", "shingle").alias("at"), "region", "key", "n", "first").withColumnRenamed("n", "size"))
    groups = found.groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("first"), F.col("key"))).alias("head")).where("n > 1 and head is not null")
    met = with_group(found, groups, "at", "key").select(named("region", "head").alias("region"), "key", F.col("size").alias("n")).distinct()
    return sized(met).where("bytes > 8 * n")


def jaccard_classes(rows: DataFrame, words: int = WORDS, percent: int = PERCENT, most: int = MOST) -> DataFrame:
    """(key, n_shingles, component) for each row of (key, text)."""
    if percent < 100 * STEP:
        raise ValueError(f"percent must be {100 * STEP:.0f} or more")
    rows = rows.where("key is not null").select("key", F.coalesce("text", F.lit("")).alias("text"))
    known = cut(rows.mapInArrow(_digests(words), "key long, n long, d1 long, d2 long"))
    classes = known.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("key").alias("rep"))
    reps = classes.select("rep").repartition("rep")
    texts = rows.repartition("key")
    flagged = texts.join(reps.hint("shuffle_hash"), F.col("key") == F.col("rep"), "left")
    sample = rows.where(F.pmod(F.xxhash64("key", F.lit(3)), F.lit(SAMPLE)) == 0)
    order = rows.sparkSession.sparkContext.broadcast(Order.of(sample, words))
    prefixes = lambda df: df.select("key", "text").mapInArrow(_prefixes(words, percent, order), "shingle long, key long, n int").withColumnRenamed("n", "size")
    # Shingles that a sample of documents finds often are dealt over many tasks. They are shared for sure; the rest counts.
    few = prefixes(sample).groupBy("shingle").agg(F.count_distinct("key").alias("n"))
    often = few.where("n > 1").orderBy(F.desc("n"), "shingle").limit(LARGEST).select(F.col("shingle").alias("often"))
    dealt = prefixes(flagged.where("rep is not null")).join(F.broadcast(often), F.col("shingle") == F.col("often"), "left")
    dealt = dealt.withColumn("part", F.when(F.col("often").isNotNull(), 1 + F.pmod(F.xxhash64("key"), F.lit(1 << 20))).otherwise(0)).select("shingle", "part", "key", "size").repartition("shingle", "part")
    shared = dealt.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("shingle", "part"))).where("n > 1 or part > 0")
    need = 1 + F.floor(F.floor(F.col("size") * percent / 100) / SPARE)
    lists = shared.groupBy("key", "size").agg(F.collect_list("shingle").alias("shingles"))
    found = cut(lists.where(F.size("shingles") >= need).select("key", "size", F.explode("shingles").alias("shingle")))
    again = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("pivot")).where("n > 1")
    counted = with_group(found, again, "shingle", "key").groupBy("key", "size", "pivot").agg(F.count(F.lit(1)).cast("int").alias("c"))
    pivots = counted.groupBy("key", F.col("size").alias("n")).agg(F.collect_list(F.struct("c", "pivot")).alias("pivots"))
    members = cut(sized(pivots.mapInArrow(_members(percent), "region long, key long, n long")))
    cells = [members.where(F.col("bytes") <= most).select("key", F.col("region").alias("cell"), "region", F.lit(1).alias("role"))]
    links: list[DataFrame] = []
    large = members.where(F.col("bytes") > most)
    if large.head(1):
        links, more = split_regions(large, texts, words, percent, most)
        cells += more
    linked = components(reduce(DataFrame.union, [*links, sent(texts, reduce(DataFrame.union, cells), words).mapInArrow(_join(percent), "a long, b long")]))
    reps_of = classes.join(linked, F.col("rep") == F.col("key"), "left").select("d1", "d2", F.col("n").alias("m"), F.coalesce("component", "rep").alias("component"))
    return known.join(reps_of.withColumnRenamed("m", "n"), ["d1", "d2", "n"], "left").select("key", F.col("n").alias("n_shingles"), F.coalesce("component", "key").alias("component"))


def jaccard_join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs; component_id is the least doc_id that links reach.

    A text that is null or has no words has an empty set and links with nothing. doc_id null or repeated: see
    common.keyed; a component's id is then its first row's doc_id. An empty table gives an empty table; other columns
    are ignored."""
    rows, ids = keyed(docs, text)
    out = jaccard_classes(rows, words, percent)
    if ids is None:
        return out.select(F.col("key").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
    names = ids.select(F.col("key").alias("component"), F.col("doc_id").alias("component_id"))
    return out.join(ids, "key").join(names, "component").select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text") -> DataFrame:
    """The rows of docs without near copies: the first row of each component stays, with the columns of docs.

    Rows without words are linked with nothing and stay; of repeated rows one stays; null and repeated doc_ids: see
    common.with_key; an empty table gives an empty table; all columns keep their names and values."""
    rows, _ = with_key(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.col(text).alias("text")))
    first = jaccard_classes(rows.select("key", "text"), words, percent).where("key = component").select(F.col("key").alias("first"))
    return rows.select("key", "row").join(first.hint("shuffle_hash"), F.col("key") == F.col("first"), "left_semi").select("row.*")


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(documents(spark, sf_dir))
