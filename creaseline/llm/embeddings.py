"""Near-duplicate embeddings by cross-polytope hashing.

Each table rotates a vector pseudo-randomly ``FUNCTIONS`` times (three rounds of random signs and a fast Hadamard
transform); a rotation's hash is the nearest signed axis.  Multiprobe: a vector goes to the ``PROBES`` combinations
of near axes with the highest scores, not just to the best.  Vectors that share a bucket are candidates and are
verified by their cosine in double precision.

Equal vectors are one class with a count.  A bucket of more than ``BLOCK`` classes is split into blocks and every
pair of blocks is a group of its own, so no task holds a bucket; a group returns link counts and spanning links,
never its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from creaseline.llm.common import materialise, number_within, partitions
from creaseline.llm.components import connected_components

MIN_COSINE = 0.9
#: The least setting; at cosine 0.9 in 64 dimensions it finds over 98 of 100 pairs.
TABLES, FUNCTIONS, PROBES, NEAR_AXES = 4, 2, 3, 3
#: A bucket should hold about so many unrelated vectors at most; see :func:`setting`.
BUCKET_ROWS = 1000
#: With very short vectors buckets may hold more: they are split into blocks, which costs time, not links.
MAX_FUNCTIONS = 5
BLOCK = 512
SEED = 20240501

HASHED = "struct<class: binary, keys: array<long>>"
FOUND = "node long, links long, root long"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x


def width(dimension: int) -> int:
    return max(2, 1 << (dimension - 1).bit_length())


def setting(rows: int, dimension: int) -> tuple[int, int, int]:
    """Tables, functions and probes for a number of vectors.

    Each function divides the buckets by twice the width, so their number grows with the vectors; each costs recall,
    which more tables and probes give back.  The tests measure it for every number of functions.
    """
    functions = FUNCTIONS
    while functions < MAX_FUNCTIONS and rows * (functions + 1) > BUCKET_ROWS * (2 * width(dimension)) ** functions:
        functions += 1
    return TABLES * (functions - 1), functions, PROBES + functions - FUNCTIONS


def bucket_keys(
    vectors: np.ndarray, tables: int, functions: int, probes: int, near: int = NEAR_AXES, seed: int = SEED
) -> np.ndarray:
    """Buckets of each vector (rows x tables * probes); the table and the dimension are part of a key."""
    n, d = vectors.shape
    axes_ = width(d)
    padded = np.zeros((n, axes_))
    padded[:, :d] = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    random = np.random.default_rng([seed, axes_])
    near = min(near, 2 * axes_)
    out = []
    for table in range(tables):
        axes, scores = [], []
        for _ in range(functions):
            y = padded
            for _ in range(3):
                y = hadamard(y * random.choice([-1.0, 1.0], axes_)) / np.sqrt(axes_)
            both = np.concatenate([y, -y], axis=1)
            best = np.argsort(-both, axis=1, kind="stable")[:, :near]
            axes.append(best)
            scores.append(np.take_along_axis(both, best, axis=1))
        total, code = [], []
        for pick in product(range(near), repeat=functions):
            total.append(sum(s[:, i] for s, i in zip(scores, pick)))
            key = np.full(n, table * 4096 + d, np.int64)
            for a, i in zip(axes, pick):
                key = key * (2 * axes_) + a[:, i]
            code.append(key)
        first = np.argsort(-np.stack(total, axis=1), axis=1, kind="stable")[:, :probes]
        out.append(np.take_along_axis(np.stack(code, axis=1), first, axis=1))
    return np.concatenate(out, axis=1)


def _usable(value: list | None) -> bool:
    return bool(value) and None not in value and all(map(np.isfinite, value)) and any(value)


def _hash_vectors(count: int, chosen: tuple[int, int, int] | None):
    def run(column: pa.Array) -> pa.Array:
        values = column.to_pylist()
        out: list = [None] * len(values)
        by_size: dict[int, list[int]] = {}
        for i, value in enumerate(values):
            if _usable(value):
                by_size.setdefault(len(value), []).append(i)
        for size, rows in by_size.items():
            tables, functions, probes = chosen or setting(count, size)
            vectors = np.array([values[i] for i in rows], np.float64) + 0.0
            vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
            for i, vector, keys in zip(rows, vectors, bucket_keys(vectors, tables, functions, probes)):
                digest = hashlib.blake2b((np.array(values[i], np.float64) + 0.0).tobytes(), digest_size=16)
                out[i] = {"class": digest.digest(), "keys": sorted(set(keys.tolist()))}
        return pa.array(out, pa.struct([("class", pa.binary()), ("keys", pa.list_(pa.int64()))]))

    return F.arrow_udf(run, HASHED)


def group_links(
    ids: np.ndarray, counts: np.ndarray, keys: list, vectors: np.ndarray, key: int, side: np.ndarray, pair: bool,
    min_cosine: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Links within a group: rows of other classes linked to each class, and its least class reachable here.

    A link counts only in the least bucket that both classes share.  ``side`` tells the block of each row; with
    ``pair`` only links between the two blocks count.
    """
    unit = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    a, b = np.nonzero(np.triu(unit @ unit.T >= min_cosine, 1))
    if pair:
        a, b = a[side[a] != side[b]], b[side[a] != side[b]]
    links = np.zeros(len(ids), np.int64)
    root = np.arange(len(ids))
    if len(a):
        width = max(map(len, keys))
        table = np.full((len(ids), width), -1, np.int64)
        for i, row in enumerate(keys):
            table[i, : len(row)] = row
        for at in range(0, len(a), 4096):
            x, y = a[at : at + 4096], b[at : at + 4096]
            shared = np.where((table[x][:, :, None] == table[y][:, None, :]).any(axis=2), table[x], np.iinfo(np.int64).max)
            shared = np.where(table[x] < 0, np.iinfo(np.int64).max, shared).min(axis=1)
            x, y = x[shared == key], y[shared == key]
            np.add.at(links, x, counts[y])
            np.add.at(links, y, counts[x])
        while True:
            before = root.copy()
            low = np.minimum(root[a], root[b])
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            root = root[root]
            if np.array_equal(root, before):
                break
    return links, root


def _verify_batches(min_cosine: float):
    def group(table: pa.Table) -> list[tuple[int, int, int]]:
        ids = table["node"].to_numpy()
        if len(ids) < 2:
            return []
        order = np.argsort(ids)
        table, ids = table.take(order), ids[order]
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        vectors = np.array(table["embedding"].to_pylist(), np.float64)
        links, root = group_links(
            ids, table["copies"].to_numpy(), table["keys"].to_pylist(), vectors, table["key"][0].as_py(),
            table["block"].to_numpy(), low != high, min_cosine,
        )
        some = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
        return list(zip(ids[some].tolist(), links[some].tolist(), ids[root[some]].tolist()))

    def emit(rows):
        columns = list(zip(*rows)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None else table
            mark = np.stack([table[c].to_numpy() for c in ("key", "low", "high")])
            cuts = np.flatnonzero((mark[:, 1:] != mark[:, :-1]).any(axis=0)) + 1
            rows, start = [], 0
            for end in cuts.tolist():
                rows += group(table.slice(start, end - start))
                start = end
            rest = table.slice(start)
            yield emit(rows)
        if rest is not None and rest.num_rows:
            yield emit(group(rest))

    return run


def near_duplicate_vectors(
    vectors: DataFrame, min_cosine: float = MIN_COSINE, hashing: tuple[int, int, int] | None = None
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``vectors``.

    Needs vec_id and embedding (array of numbers); other columns are ignored.  ``hashing`` is tables, functions and
    probes; by default :func:`setting` takes them from the number of vectors.  n_links counts the other rows whose
    cosine is at least ``min_cosine``, as far as hashing finds them; equal vectors always link.  Vectors that are
    null, empty, zero, or hold null or non-finite components link with nothing; vectors of different lengths don't
    link.  component_id is the least vec_id reachable.  A null vec_id links like others but names a component only if
    no other id is in it (then null, and kept).  Repeated rows are rows of their own that link.  A cosine of exactly
    ``min_cosine`` links; rows with equal vec_id that name a component are all kept.  An empty table gives no row.
    """
    hashed = _hash_vectors(vectors.count(), hashing)
    # A vector moves once per bucket, so single-precision components move as they are and become doubles in the group.
    given = vectors.schema["embedding"].dataType
    components = given if given == ArrayType(FloatType()) or given == ArrayType(FloatType(), False) else ArrayType(DoubleType())
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(components).alias("embedding"))
    rows = materialise(
        rows.withColumn("_h", hashed("embedding")).select("vec_id", "embedding", "_h.class", "_h.keys"), "vectors"
    )
    usable = rows.where(F.col("class").isNotNull())
    classes = usable.groupBy("class").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
        F.first("keys").alias("keys"), F.first("embedding").alias("embedding"),
    )
    # Written at once, so these ids stay what they are.
    classes = materialise(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    spread = classes.select("node", F.explode("keys").alias("key"))
    numbered = number_within(spread, ["key"], ["node"], "rank")
    sizes = spread.groupBy("key").agg(F.floor((F.count(F.lit(1)) - 1) / BLOCK).alias("last"))
    block = numbered.join(sizes, "key").select("node", "key", F.floor(F.col("rank") / BLOCK).alias("block"), "last")
    pairs = block.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))).select(
        "node", "key", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    groups = (
        pairs.join(classes, "node")
        .select("key", "low", "high", "block", "node", "copies", "keys", "embedding")
        .repartition(partitions(vectors.sparkSession), "key", "low", "high")
        .sortWithinPartitions("key", "low", "high")
    )
    found = materialise(groups.mapInArrow(_verify_batches(min_cosine), FOUND), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    spanning = connected_components(found.select("node", "root"))
    joined = (
        classes.select("class", "node", "copies", "first_id")
        .join(links, "node", "left")
        .join(spanning, F.col("node") == F.col("id"), "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    least = joined.groupBy("component").agg(F.min("first_id").alias("_component"))
    least = joined.join(least, "component").select(
        F.col("class").alias("_class"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"),
        "_component",
    )
    out = rows.join(least, rows["class"] == F.col("_class"), "left")
    component = F.coalesce("_component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
