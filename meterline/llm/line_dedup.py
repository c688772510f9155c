"""Removal of lines that many documents share.

Two Bloom filters over 64-bit hashes of line keys tell what was seen once and what was seen twice. Each task fills its own
pair and ships the bits in containers of 65,536 bits (a sorted list of 16-bit places while that is smaller, else the bits
themselves), so a line costs about four bytes. Where containers of one place meet, a bit that two tasks have set counts as
seen twice; a key of two documents thus always has all its bits there. Only keys that the second filter holds are
suspected: their occurrences are shuffled by a 128-bit name, counted exactly, and their last document is found. Every other
line stays where it is.

The second filter is broadcast; its size follows the number of lines and has a bound (MOST_BITS, 128 MB). Above 67 million
lines it gets denser: more single lines are then suspected and shuffled, and results stay exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import as_bytes
from .common import cut, documents, keyed, unkeyed, with_group

LEAST_CHARS, LEAST_DOCS = 40, 5
BITS_A_LINE = 16
MOST_BITS = 1 << 30
BOX = 1 << 16
"""Bits of one container."""
WHITE = b" \t\n\x0b\x0c\r"
INNER_BYTES = bytes(range(0x80, 0xC0))
"""Bytes that continue a code point."""


def line_key(line: bytes, least_chars: int = LEAST_CHARS) -> bytes | None:
    """The line without white space at its ends and with A-Z lower-cased; None if it has fewer code points than asked."""
    key = line.strip(WHITE)
    if len(key) < least_chars or not key.isascii() and len(key.translate(None, INNER_BYTES)) < least_chars:
        return None
    return key.lower()


def name(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The two bits of each hash in a filter of `bits` bits, a power of two."""
    return np.stack([hashes & np.uint64(bits - 1), (hashes >> np.uint64(32)) & np.uint64(bits - 1)]).astype(np.int64)


def _keys(text: bytes, least_chars: int) -> set[bytes]:
    return {k for line in text.split(b"\n") if (k := line_key(line, least_chars))}


def _box(bits: np.ndarray) -> bytes:
    """A container: a list of places while that is shorter than the bits."""
    at = np.flatnonzero(bits)
    return at.astype("<u2").tobytes() if 2 * len(at) < BOX // 8 else np.packbits(bits).tobytes()


def _bits(box: bytes) -> np.ndarray:
    if len(box) == BOX // 8:
        return np.unpackbits(np.frombuffer(box, np.uint8)).view(bool)
    out = np.zeros(BOX, bool)
    out[np.frombuffer(box, "<u2")] = True
    return out


def _boxes(places_set: np.ndarray) -> dict[int, np.ndarray]:
    """Sorted distinct places by container."""
    box = places_set // BOX
    start = np.flatnonzero(np.r_[True, box[1:] != box[:-1]]) if len(box) else np.zeros(0, np.int64)
    return {int(box[a]): places_set[a:b] % BOX for a, b in zip(start, np.r_[start[1:], len(box)], strict=True)}


def _fill(bits: int, least_chars: int):
    """(box, once, twice) of a task: bits of the keys that it met once, and of those that it met in two documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in batches:
            met = [xxhash.xxh3_64_intdigest(k) for t in as_bytes(batch.column("text")) for k in _keys(t, least_chars)]
            hashes, times = np.unique(np.asarray(met, np.uint64), return_counts=True)
            sides = [(at >> 3, np.left_shift(1, 7 - (at & 7)).astype(np.uint8)) for at in places(hashes, bits)]
            again = times > 1
            again |= np.logical_and.reduce([once[byte] & mask > 0 for byte, mask in sides])
            for byte, mask in sides:
                np.bitwise_or.at(twice, byte[again], mask[again])
                np.bitwise_or.at(once, byte, mask)
        rows: tuple[list, list, list] = ([], [], [])
        for b in range(bits // BOX):
            own = slice(b * BOX // 8, (b + 1) * BOX // 8)
            if once[own].any():
                for r, v in zip(rows, (b, _box(np.unpackbits(once[own])), _box(np.unpackbits(twice[own]))), strict=True):
                    r.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())], names=["box", "once", "twice"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(box, twice) from rows sorted by box: what any task met twice, and what two tasks met."""
    now, once, twice = None, None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([_box(twice)], pa.binary())], names=["box", "twice"])

    for batch in batches:
        for box, a, b in zip(*(batch.column(n).to_pylist() for n in ("box", "once", "twice")), strict=True):
            if box != now:
                if now is not None and twice.any():
                    yield done()
                now, once, twice = box, np.zeros(BOX, bool), np.zeros(BOX, bool)
            own = _bits(a)
            twice |= _bits(b)
            twice |= once & own
            once |= own
    if now is not None and twice.any():
        yield done()


def filter_bits(lines: int) -> int:
    """A power of two with BITS_A_LINE bits a line, within its bounds."""
    return min(max(BOX, 1 << (max(1, BITS_A_LINE * lines) - 1).bit_length()), MOST_BITS)


def twice_seen(texts: DataFrame, bits: int, least_chars: int = LEAST_CHARS) -> np.ndarray:
    """The second filter, as packed bits: it holds each key that two documents have. texts: a column `text`."""
    boxes = texts.select("text").mapInArrow(_fill(bits, least_chars), "box int, once binary, twice binary")
    merged = boxes.repartition("box").sortWithinPartitions("box").mapInArrow(_merge, "box int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():
        out[row["box"] * BOX // 8 : (row["box"] + 1) * BOX // 8] = np.packbits(_bits(bytes(row["twice"])))
    return out


def suspects(texts: DataFrame, bits: int, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(name, key): each document of each key that the second filter holds."""
    held = texts.sparkSession.sparkContext.broadcast(twice_seen(texts, bits, least_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = held.value
        for batch in batches:
            keys, owners = [], []
            for doc, text in zip(batch.column("key").to_pylist(), as_bytes(batch.column("text")), strict=True):
                own = _keys(text, least_chars)
                keys.extend(own)
                owners.extend([doc] * len(own))
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
            known = np.ones(len(keys), bool)
            for at in places(hashes, bits):
                known &= (twice[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0
            hit = np.flatnonzero(known).tolist()
            yield pa.RecordBatch.from_arrays([pa.array([name(keys[i]) for i in hit], pa.binary()), pa.array([owners[i] for i in hit], pa.int64())], names=["name", "key"])

    return texts.select("key", "text").mapInArrow(run, "name binary, key long")


def _drop(least_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, list, list] = ([], [], [])
            for text, gone in zip(as_bytes(batch.column("text")), batch.column("gone").to_pylist(), strict=True):
                lines = text.split(b"\n")
                if gone:
                    names = set(gone)
                    kept = [x for x in lines if (k := line_key(x, least_chars)) is None or name(k) not in names]
                    text = b"\n".join(kept)
                else:
                    kept = lines
                for r, v in zip(rows, (len(lines), len(lines) - len(kept), text), strict=True):
                    r.append(v)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.binary()).cast(pa.string())], names=["key", "n_lines", "n_dropped", "kept"])

    return run


def line_dedup(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, kept for each row of docs.

    A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of at least `least_chars` code
    points in at least `least_docs` documents lose all their lines but those in the document with the largest doc_id. A
    null text is one empty line. Where doc_id is null or repeated each row is a document of its own, in the order of
    common.with_key (null first, then doc_id, then MD5 of the text), whose last row keeps its lines; an empty table gives an
    empty one; other columns are ignored."""
    rows, ids = keyed(docs, text)
    lines = rows.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    found = cut(suspects(rows, filter_bits(lines), least_chars))
    shared = found.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.max("key").alias("keep")).where(F.col("n") >= least_docs)
    gone = with_group(found, shared, "name", "key").where("key <> keep").groupBy("key").agg(F.collect_list("name").alias("gone"))
    return unkeyed(rows.join(gone.hint("shuffle_hash"), "key", "left").select("key", "text", "gone").mapInArrow(_drop(least_chars), "key long, n_lines long, n_dropped long, kept string"), ids)


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
