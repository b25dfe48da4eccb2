"""Line dedup: lines that many documents share go, found by probing a sharded minimal perfect hash.

Documents are read twice and no line is ever shuffled or joined.  The first pass hashes every long line to 128 bits
and counts documents per hash, summed within each batch before it moves.  The hashes that enough documents hold are
split into shards by their leading bits; each shard is a minimal perfect hash (levels of bit arrays: a key stands
where it is alone, the others go on to the next level) that numbers its keys from 0 without gaps, next to arrays in
that order: a fingerprint, the count of documents and the largest doc_id.  In the second pass documents probe the
arrays: the number that a line gets means nothing unless the fingerprint agrees.  Shard and number come from the
first 64 bits of the hash and the fingerprint is the other 64, so a line is taken for another only if all 128 agree.

Arrays reach the tasks as broadcasts of at most ``PROBE_BYTES``.  Their exact size is known when they are written; if
they are larger, they are probed one bundle of shards after another, with the lines to drop noted as bits, so memory
stays bounded at any size and nothing is left out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import materialise

MIN_CHARS, MIN_DOCUMENTS = 40, 5
#: Keys of a shard: about 6 MB of arrays.
SHARD_KEYS = 1 << 18
#: Bytes of arrays that a task holds at a time.
PROBE_BYTES = 96 << 20
#: Bits of a level for each key that is left.
GAMMA = 2
#: Stands for a null doc_id, below all others.
NO_ID = -(1 << 63)
_NUMBERS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # splitmix64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _NUMBERS[1]
    h = (h ^ (h >> np.uint64(27))) * _NUMBERS[2]
    return h ^ (h >> np.uint64(31))


def _at(keys: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Where keys stand in a level of so many bits."""
    with np.errstate(over="ignore"):
        return (_mix(keys + np.uint64(level + 1) * _NUMBERS[0]) % np.uint64(bits)).astype(np.int64)


@dataclass
class PerfectHash:
    """Levels as bytes of bits, and how many keys stand before each byte."""

    levels: list[np.ndarray]
    before: list[np.ndarray]

    @classmethod
    def of(cls, levels: list[np.ndarray]) -> PerfectHash:
        before, n = [], 0
        for level in levels:
            counts = np.bitwise_count(level).cumsum(dtype=np.int64)
            before.append(np.concatenate([[0], counts[:-1]]) + n)
            n += int(counts[-1])
        return cls(levels, before)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct 64-bit keys."""
        levels = []
        while len(keys):
            size = -(-max(8, GAMMA * len(keys)) // 8)
            at = _at(keys, len(levels), 8 * size)
            alone = np.bincount(at, minlength=8 * size) == 1
            levels.append(np.packbits(alone, bitorder="little"))
            keys = keys[~alone[at]]
        return cls.of(levels)

    def number(self, keys: np.ndarray) -> np.ndarray:
        """0, 1, ... for the keys it was built from; for others any such number or -1."""
        found = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for i, (level, before) in enumerate(zip(self.levels, self.before)):
            at = _at(keys[left], i, 8 * len(level))
            byte, bit = level[at >> 3], (at & 7).astype(np.uint8)
            hit = (byte >> bit) & 1 == 1
            below = np.bitwise_count(byte & ((np.uint8(1) << bit) - np.uint8(1)))
            found[left[hit]] = (before[at >> 3] + below)[hit]
            left = left[~hit]
        return found


def line_digests(text: bytes, min_chars: int = MIN_CHARS) -> tuple[int, list[int], list[bytes]]:
    """Lines of a text; which of them (from 0) have a key of enough code points; the keys' hashes."""
    import xxhash

    digest = xxhash.xxh3_128_digest
    lines = text.split(b"\n")
    at, found = [], []
    for i, line in enumerate(lines):
        key = line.strip(b" \t\n\v\f\r")
        if len(key) < min_chars or (not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars):
            continue
        at.append(i)
        found.append(digest(key.lower()))
    return len(lines), at, found


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">u8").astype(np.uint64).reshape(-1, 2)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def _count(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, owners = _ids(batch.column("_id")), [], []
            for owner, text in zip(ids, batch.column("_text")):
                distinct = set(line_digests(text.as_py() or b"", min_chars)[2])
                keys += distinct
                owners += [owner] * len(distinct)
            if keys:
                frame = pd.DataFrame(_halves(keys).view(np.int64), columns=["_h", "_f"])
                frame["_last"] = owners
                summed = frame.groupby(["_h", "_f"], sort=False)["_last"].agg(["size", "max"]).reset_index()
                yield pa.RecordBatch.from_pandas(summed.set_axis(["_h", "_f", "_n", "_last"], axis=1), preserve_index=False)

    return run


def shared_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``_h, _f, _n, _last``: hashes (two longs) of the lines that enough documents hold, how many, and the largest id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("binary").alias("_text"))
    each = rows.mapInArrow(_count(min_chars), "_h long, _f long, _n long, _last long")
    return each.groupBy("_h", "_f").agg(F.sum("_n").alias("_n"), F.max("_last").alias("_last")).where(F.col("_n") >= min_documents)


def _shard(frame: pd.DataFrame) -> pd.DataFrame:
    """The arrays of a shard: levels, then fingerprints, counts and largest ids in the order of the numbers."""
    h, f = (frame[c].to_numpy(np.int64).view(np.uint64) for c in ("_h", "_f"))
    index = PerfectHash.build(h)
    number = index.number(h)
    order = np.empty(len(h), np.int64)
    order[number] = np.arange(len(h))
    arrays = [f[order], frame["_n"].to_numpy(np.int64)[order], frame["_last"].to_numpy(np.int64)[order]]
    sizes = np.array([len(level) for level in index.levels], np.int64).tobytes()
    blobs = [sizes, b"".join(level.tobytes() for level in index.levels), *[a.tobytes() for a in arrays]]
    return pd.DataFrame({"_shard": [frame["_shard"].iloc[0]], "_twin": [frame["_twin"].iloc[0]], **{f"_b{i}": [b] for i, b in enumerate(blobs)}})


def build_index(shared: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int]:
    """A row per shard with its arrays, and the number of bits that tell shards apart."""
    keys = shared.count()
    bits = max(0, (max(1, keys) - 1) // shard_keys).bit_length()
    shard = F.when(F.lit(bits) == 0, F.lit(0)).otherwise(F.shiftrightunsigned("_h", 64 - max(1, bits))).cast("long")
    # Keys with an equal first half would collide for ever: they are numbered, and each number has its own shards.
    twins = shared.groupBy(F.col("_h").alias("_g")).agg(F.count(F.lit(1)).alias("_k"), F.sort_array(F.collect_list("_f")).alias("_all")).where("_k > 1")
    twin = F.coalesce(F.array_position("_all", F.col("_f")) - 1, F.lit(0)).cast("long")
    placed = shared.join(twins, F.col("_h") == F.col("_g"), "left").select(shard.alias("_shard"), twin.alias("_twin"), "_h", "_f", "_n", "_last")
    schema = "_shard long, _twin long, _b0 binary, _b1 binary, _b2 binary, _b3 binary, _b4 binary"
    return placed.groupBy("_shard", "_twin").applyInPandas(_shard, schema), bits


class Index:
    """Shards, which a worker sets up when it first probes them."""

    def __init__(self, bits: int, rows: list[tuple]):
        self.bits, self.rows = bits, rows

    @functools.cached_property
    def shards(self) -> dict[int, list[tuple]]:
        found: dict[int, list[tuple]] = {}
        for shard, _, sizes, levels, *arrays in self.rows:
            sizes, raw = np.frombuffer(sizes, np.int64), np.frombuffer(levels, np.uint8)
            index = PerfectHash.of(np.split(raw, np.cumsum(sizes)[:-1]))
            columns = [np.frombuffer(a, t) for a, t in zip(arrays, (np.uint64, np.int64, np.int64))]
            found.setdefault(shard, []).append((index, *columns))
        return found

    def probe(self, hashes: np.ndarray, owner: int) -> np.ndarray:
        """Whether each line (hashes in two columns) of the document ``owner`` is to be dropped."""
        drop = np.zeros(len(hashes), bool)
        shard = (hashes[:, 0] >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(hashes), np.int64)
        for s in np.unique(shard).tolist():
            mine = np.flatnonzero(shard == s)
            for index, fingerprints, _, last in self.shards.get(s, ()):
                number = index.number(hashes[mine, 0])
                rows, number = mine[number >= 0], number[number >= 0]
                same = fingerprints[number] == hashes[rows, 1]
                drop[rows[same]] = last[number[same]] != owner
        return drop


def _probe(shared_index, min_chars: int, last: bool):
    """Notes a document's lines to drop as bits; on the last pass writes the text without them."""

    def run(ids: pa.Array, texts: pa.Array, marks: pa.Array) -> pa.Array:
        index = shared_index.value
        ids = _ids(ids)
        out: list[tuple] = []
        for owner, text, mark in zip(ids, texts, marks):
            raw = text.as_py() or b""
            n, at, digests = line_digests(raw, min_chars)
            drop = np.zeros(n, bool)
            if mark.is_valid:
                drop |= np.unpackbits(np.frombuffer(mark.as_py(), np.uint8), count=n).astype(bool)
            drop[at] |= index.probe(_halves(digests), owner)
            dropped = int(drop.sum())
            if not last:
                out.append((np.packbits(drop).tobytes() if dropped else None, None, n, dropped))
            elif dropped:
                out.append((None, b"\n".join(line for line, gone in zip(raw.split(b"\n"), drop) if not gone), n, dropped))
            else:
                out.append((None, raw, n, 0))
        types = [pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        columns = [pa.array([row[i] for row in out], t) for i, t in enumerate(types)]
        return pa.StructArray.from_arrays(columns, ["marks", "text", "n_lines", "n_dropped"])

    return F.arrow_udf(run, "struct<marks: binary, text: binary, n_lines: long, n_dropped: long>")


def dedupe_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, shard_keys: int = SHARD_KEYS, probe_bytes: int = PROBE_BYTES
) -> DataFrame:
    """All columns of ``docs`` with ``text`` replaced by its kept lines, and ``_n_lines`` (before) and ``_n_dropped``.

    A line's key is the line without white space at both ends, A-Z lower-cased.  Keys of at least ``min_chars`` code
    points in at least ``min_documents`` documents lose their lines in all documents but the one of largest doc_id.
    Needs doc_id and text; columns called like an added one are replaced.  A null or empty text is one empty line and
    becomes empty.  Every row is a document: repeated rows count, and rows that share the largest doc_id all keep the
    line; a null doc_id is below all others.  Blank and short lines always stay.  An empty table gives no row.
    """
    spark = docs.sparkSession
    shared = materialise(shared_lines(docs, min_chars, min_documents), "shared-lines")
    arrays, bits = build_index(shared, shard_keys)
    arrays = materialise(arrays, "line-index")
    blobs = [f"_b{i}" for i in range(5)]
    sizes = arrays.select("_shard", "_twin", sum(F.octet_length(c) for c in blobs).alias("_bytes")).orderBy("_shard", "_twin")
    # Bundles of consecutive shards; this walk is over one row per shard.
    bundles, room = [[]], probe_bytes
    for row in sizes.toLocalIterator():
        if bundles[-1] and row["_bytes"] > room:
            bundles.append([])
            room = probe_bytes
        bundles[-1].append((row["_shard"], row["_twin"]))
        room -= row["_bytes"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    work = docs.select(row.alias("_doc"), F.lit(None).cast("binary").alias("_marks"))
    for i, bundle in enumerate(bundles):
        last = i == len(bundles) - 1
        if bundle:
            low, high = bundle[0], bundle[-1]
            key = F.struct("_shard", "_twin")
            place = lambda p: F.struct(F.lit(p[0]).cast("long").alias("_shard"), F.lit(p[1]).cast("long").alias("_twin"))
            held = [tuple(r) for r in arrays.where((key >= place(low)) & (key <= place(high))).select("_shard", "_twin", *blobs).collect()]
        else:
            held = []
        probe = _probe(spark.sparkContext.broadcast(Index(bits, held)), min_chars, last)
        found = probe(F.col("_doc.doc_id").cast("long"), F.col("_doc.text").cast("binary"), F.col("_marks"))
        work = work.select("_doc", found.alias("_lines"))
        if not last:
            work = materialise(work.select("_doc", F.col("_lines.marks").alias("_marks")), "line-marks")
    text = F.col("_lines.text").cast("string").alias("text")
    kept = [text if c == "text" else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns if c not in ("_n_lines", "_n_dropped")]
    return work.select(*kept, F.col("_lines.n_lines").alias("_n_lines"), F.col("_lines.n_dropped").alias("_n_dropped"))
