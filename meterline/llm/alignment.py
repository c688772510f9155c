"""Alignment of two tokenizers' tokens over the same texts.

Both sides' tokens are laid out by their first byte, document after document, so that a place tells its document. In each
batch pandas' merge_asof, keyed by document, finds for each token's start the other side's token that covers it. The pairs
of both directions are all overlaps (of two tokens that overlap, the later start lies in the other token), and a place where
both sides start a token cuts the text into groups.

How many documents hold a pair of ids linked is counted over the corpus. Documents are dealt with in blocks of neighbours
(BLOCK characters). A block lists its different pairs once, with how many of its documents hold each; its documents refer to
places in that list. Blocks are written to the shared folder once, so that texts are tokenized once. Spark adds the lists up,
finds the highest count of each A id, and joins both back to the lists; documents then read counts from their block's list.
A pair that all documents hold has one row for each block, so no key is hot.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import chunks
from .common import documents, shared_folder
from .packing import default_tokenizer
from .tokens import KNOWN, LETTER, SPACE, Encoder

STEP = 1 << 20
"""Characters that are aligned at once; a longer document is taken whole."""
BLOCK = 12 << 20
"""Characters of documents that share one list of pairs."""
MARK = 0x2581
"""Fixed value: the sign that pieces have for a space."""


def default_pieces() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


class Side(Encoder):
    """An encoder whose new pieces come from `_ids`."""

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _learn(self, name: np.ndarray, pieces: list[str]) -> None:
        new = self._ids(pieces)
        size = np.fromiter(map(len, new), np.int64, len(new))
        at = np.cumsum(size) - size + len(self.ids)
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(new), np.uint32, int(size.sum()))])
        place = np.searchsorted(self.names, name)
        self.names, self.at, self.size = (np.insert(old, place, x) for old, x in ((self.names, name), (self.at, at), (self.size, size)))


class ByteSide(Side):
    """Side A: byte-level BPE."""

    def __init__(self, path: str):
        super().__init__(path)
        back = {self.characters.get(b, chr(b)): b for b in range(256)}
        tokens = [self.slow.id_to_token(i) or "" for i in range(self.slow.get_vocab_size())]
        self.token_bytes = [bytes(back[c] for c in t) if back.keys() >= set(t) else t.encode() for t in tokens]
        self.sign = np.array([ord(self.characters.get(b, chr(b))) for b in range(256)], "<u4")

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        each = [p.encode() for p in pieces]
        signs = self.sign[np.frombuffer(b"".join(each), np.uint8)].tobytes().decode("utf-32-le")
        to = list(accumulate(map(len, each)))
        tokenize = self.slow.model.tokenize
        return [[t.id for t in tokenize(signs[a:b])] for a, b in zip([0, *to[:-1]], to, strict=True)]


class PieceSide(Side):
    """Side B: pieces with byte fallback, of texts that begin with the space that the model adds.

    A piece has its spaces at its front only, so no merge reaches across the start of a run of spaces; what stands between
    two such starts is encoded once and kept. A vocabulary with other pieces is refused."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        mark = chr(MARK)
        if any(mark in p.lstrip(mark) for p in pieces):
            raise ValueError("pieces with spaces behind other signs need whole texts")
        self.space = self.model.piece_to_id(mark)
        self.token_bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) or self.model.is_unknown(i) else p.replace(mark, " ").encode() for i, p in enumerate(pieces)]
        self.classes = np.full(KNOWN + 1, LETTER, np.uint8)
        self.classes[[0x20, MARK]] = SPACE
        self._clear()

    def _ids(self, pieces: list[str]) -> list[list[int]]:
        return [ids or [self.space] for ids in self.model.encode([p[1:] for p in pieces], num_threads=1)]

    def limits(self, points: np.ndarray, kind: np.ndarray, begin: np.ndarray) -> np.ndarray:
        edge = np.zeros(len(points) + 1, bool)
        edge[1:-1] = (kind[1:] == SPACE) & (kind[:-1] != SPACE)
        edge[begin] = edge[-1] = True
        return np.flatnonzero(edge)


class Sides:
    """Both encoders and, for each id, the bytes of its token and its decimal form with each mark that may follow."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteSide(path_a), PieceSide(path_b)
        self.bytes_a, self.bytes_b = (np.array(x.token_bytes, object) for x in (self.a, self.b))
        self.len_a, self.len_b = (np.fromiter(map(len, x.token_bytes), np.int64, len(x.token_bytes)) for x in (self.a, self.b))
        self.n_a, self.n_b = len(self.len_a), len(self.len_b)
        self.shown = np.array([f"{i}{mark}".encode() for n, marks in ((self.n_a, ",|"), (self.n_b, ",;")) for mark in marks for i in range(n)], object)


_sides: dict[tuple[str, str], Sides] = {}


def sides(path_a: str, path_b: str) -> Sides:
    return _sides.get((path_a, path_b)) or _sides.setdefault((path_a, path_b), Sides(path_a, path_b))


def covering(starts: np.ndarray, doc: np.ndarray, other: np.ndarray, other_doc: np.ndarray) -> np.ndarray:
    """For each start the number of the other side's last token of the document that starts there or before."""
    left = pd.DataFrame({"at": starts, "doc": doc})
    right = pd.DataFrame({"at": other, "doc": other_doc, "token": np.arange(len(other))})
    return pd.merge_asof(left, right, on="at", by="doc")["token"].to_numpy()


class Aligned:
    """Tokens of some documents and how they overlap. Arrays: id and doc of each token, its start in the joined bytes; the
    covering token of the other side; whether both sides start a token there."""

    def __init__(self, both: Sides, texts: list[str]):
        given = [f" {t}" for t in texts]
        self.a, self.b = list(both.a(given)), list(both.b(given))
        for i, t in enumerate(given):
            want = t.encode("utf-8", "surrogatepass") if texts[i] else None
            if want is None or b"".join(both.bytes_a[self.a[i]].tolist()) != want or b"".join(both.bytes_b[self.b[i]].tolist()) != want:
                self.a[i] = self.b[i] = np.zeros(0, np.uint32)
        self.n_a, self.n_b = (np.fromiter(map(len, x), np.int64, len(texts)) for x in (self.a, self.b))
        self.id_a, self.id_b = (np.concatenate([np.zeros(0, np.uint32), *x]).astype(np.int64) for x in (self.a, self.b))
        self.doc_a, self.doc_b = (np.repeat(np.arange(len(texts)), n) for n in (self.n_a, self.n_b))
        size_a, size_b = both.len_a[self.id_a], both.len_b[self.id_b]
        self.start_a, self.start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
        self.cover_a = covering(self.start_a, self.doc_a, self.start_b, self.doc_b)
        self.cover_b = covering(self.start_b, self.doc_b, self.start_a, self.doc_a)
        self.same_a = self.start_b[self.cover_a] == self.start_a
        self.same_b = self.start_a[self.cover_b] == self.start_b

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the A and B tokens of each link: those of both directions, once each."""
        late = np.flatnonzero(~self.same_b)
        return np.concatenate([np.arange(len(self.id_a)), self.cover_b[late]]), np.concatenate([self.cover_a, late])

    def groups(self, both: Sides) -> list[bytes]:
        """The groups of each document, as `a1,a2|b1;a3|b2,b3`."""
        first_a, first_b = np.flatnonzero(self.same_a), np.flatnonzero(self.same_b)
        group_a, group_b = np.cumsum(self.same_a) - 1, np.cumsum(self.same_b) - 1
        code = np.empty(len(self.id_a) + len(self.id_b), np.int64)
        ends = np.append(self.same_a[1:], True)
        code[np.arange(len(self.id_a)) + first_b[group_a]] = self.id_a + both.n_a * ends
        ends = np.append(self.same_b[1:], True)
        code[np.arange(len(self.id_b)) + np.append(first_a[1:], len(self.id_a))[group_b]] = 2 * both.n_a + self.id_b + both.n_b * ends
        to = np.cumsum(self.n_a + self.n_b).tolist()
        return [b"".join(both.shown[code[a:b]].tolist())[:-1] for a, b in zip([0, *to[:-1]], to, strict=True)]


def planes(values: np.ndarray) -> bytes:
    """Four-byte numbers, all first bytes first: small numbers then compress well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4")[:, 0].astype(np.int64)


ROW = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, refs binary, times binary, a binary, b binary, holders binary"
"""A document, or (doc_id aside) a block's list: its pairs, and how many of its documents hold each."""


def _align(path_a: str, path_b: str, block: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = sides(path_a, path_b)
        at = TaskContext.get().partitionId() << 32
        open_rows: list[tuple] = []
        found: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def close() -> pa.RecordBatch:
            doc = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
            pairs = np.concatenate([np.zeros(0, np.int64), *[p for p, _ in found]])
            listed, ref, holders = np.unique(pairs, return_inverse=True, return_counts=True)
            limit = np.searchsorted(doc, np.arange(len(found) + 1)).tolist()
            rows = [(at, *row, planes(np.diff(ref[a:b], prepend=0)), planes(times), None, None, None) for row, (_, times), a, b in zip(open_rows, found, limit, limit[1:], strict=False)]
            rows.append((at, None, None, None, None, None, None, None, None, planes(listed // both.n_b), planes(listed % both.n_b), planes(holders)))
            kinds = [pa.int64()] * 6 + [pa.string()] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=re.findall(r"(\w+) \w+", ROW))

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), [t or "" for t in batch.column("text").to_pylist()]
            for lo, hi in chunks([len(t) for t in texts], STEP):
                part = Aligned(both, texts[lo:hi])
                link_a, link_b = part.links()
                width = both.n_a * both.n_b
                keyed, times = np.unique(part.doc_a[link_a] * width + part.id_a[link_a] * both.n_b + part.id_b[link_b], return_counts=True)
                limit = np.searchsorted(keyed, np.arange(hi - lo + 1) * width).tolist()
                n_links = np.bincount(part.doc_a[link_a], minlength=hi - lo).tolist()
                n_groups = np.bincount(part.doc_a[part.same_a], minlength=hi - lo).tolist()
                for k, shown in enumerate(part.groups(both)):
                    own = slice(limit[k], limit[k + 1])
                    open_rows.append((ids[lo + k], int(part.n_a[k]), int(part.n_b[k]), n_groups[k], n_links[k], hashlib.sha256(shown).hexdigest() if shown else ""))
                    found.append((keyed[own] - k * width, times[own]))
                    size += len(texts[lo + k])
                if size >= block:
                    yield close()
                    at, open_rows, found, size = at + 1, [], [], 0
        if open_rows:
            yield close()

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, place, a, b, holders) of each block's list."""
    for batch in batches:
        for block, *lists in zip(*(batch.column(c).to_pylist() for c in ("block", "a", "b", "holders")), strict=True):
            a, b, holders = (from_planes(x).astype(np.int32) for x in lists)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), block)), pa.array(np.arange(len(a), dtype=np.int32)), pa.array(a), pa.array(b), pa.array(holders)], names=["block", "place", "a", "b", "holders"])


def _read_counts(left: pa.Table, right: pa.Table) -> pa.Table:
    """doc_id, n_best, count_sum of a block's documents; right: the counts of its list."""
    place = right.column("place").to_numpy()
    count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    count[place], best[place] = right.column("count").to_numpy(), right.column("best").to_numpy()
    rows: tuple[list, list] = ([], [])
    for refs, times in zip(left.column("refs").to_pylist(), left.column("times").to_pylist(), strict=True):
        ref, n = np.cumsum(from_planes(refs)), from_planes(times)
        rows[0].append(int(n @ best[ref]))
        rows[1].append(int(n @ count[ref]))
    return pa.table({c: left.column(c) for c in OUT[:5]} | {"n_best": pa.array(rows[0], pa.int64()), "count_sum": pa.array(rows[1], pa.int64()), "groups_sha256": left.column("groups_sha256")})


OUT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, text: str = "text", block: int = BLOCK) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row of docs.

    Texts that are null or empty, or that either side's tokens don't spell, have no tokens: zeros, and an empty digest.
    Each row is a document of its own, also where doc_id is null or repeated; of equal counts all are highest; an empty
    table gives an empty one; other columns are ignored. One block's folder is written to the shared folder and stays
    there, as the result reads it."""
    spark = docs.sparkSession
    path_a, path_b = path_a or default_tokenizer(), path_b or default_pieces()
    folder = f"{shared_folder(spark)}/aligned-{uuid.uuid4().hex}"
    docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_align(path_a, path_b, block), ROW).write.parquet(folder)
    rows = spark.read.parquet(folder)
    listed = rows.where("holders is not null").select("block", "a", "b", "holders").mapInArrow(_listed, "block long, place int, a int, b int, holders int")
    counts = listed.groupBy("a", "b").agg(F.sum("holders").alias("count"))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    known = counts.join(highest, "a").select("a", "b", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))
    back = listed.drop("holders").join(known, ["a", "b"]).select("block", "place", "count", "best")
    own = rows.where("holders is null").select("block", *OUT[:5], "groups_sha256", "refs", "times")
    return own.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(_read_counts, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(documents(spark, sf_dir))
