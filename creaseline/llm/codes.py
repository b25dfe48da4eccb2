"""Vector code compression: product codes by rounds of nearest entries, with norm-of-sum bounds.

A vector becomes whole numbers and is cut into equal parts; each part position has a codebook, and a part's code is
the index of its nearest entry.  Each round assigns all parts and then moves every entry to the mean of its parts.

Most parts keep their entry from round to round, and bounds prove it without looking at the codebook.  A part holds
an upper bound on the distance to its own entry and a lower bound on the distance to any other, each with the round
that it was measured in.  The codebooks of all rounds are kept, so a bound of round s is brought to round t by how
far entries lie from where they were in round s: the norm of the summed moves, which is never more than the sum of
their norms, and much less where an entry swings back.  Only where the bounds overlap is the own distance measured
again, and only where they still overlap are all entries scanned.

A round is one pass over a table of vectors and bounds that writes the next one; the sums of the new entries are
rows of the same files, so a task that runs again counts once.  The driver holds codebooks alone, whose size follows
from their number of entries and the dimension.  All decisions are on whole numbers, so results are exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from creaseline.llm.common import materialise
from creaseline.sources.scratch import scratch_path

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors of a scan of all entries at a time.
SCAN_ROWS = 1024
#: What a stored bound gives way to cover that it is kept in 32 bits.
SLACK = 1e-6


@dataclass
class Codebooks:
    """``history[r]``: the entries (part, entry, component) that round r assigns with; the last are the final ones.

    ``scanned[r]``: parts whose entries were all scanned in round r.
    """

    history: list[np.ndarray]
    scanned: list[int] = field(default_factory=list)

    @property
    def final(self) -> np.ndarray:
        return self.history[-1]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(v) for v in self.final.ravel().tolist()).encode()).hexdigest()


def state_type(parts: int) -> np.dtype:
    """What a vector carries from round to round, for each part."""
    return np.dtype(
        [("code", "u1", parts), ("upper_round", "<u2", parts), ("lower_round", "<u2", parts), ("upper", "<f4", parts), ("lower", "<f4", parts)]
    )


def component_limit(dimension: int) -> int:
    """Components count as at most this, so that a vector's squared distance fits in 64 bits."""
    return math.isqrt((1 << 61) // max(1, dimension))


def moves(history: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(round, part, entry): how far an entry is now from where it was then, and the most that any *other* entry is."""
    now = history[-1].astype(np.float64)
    own = np.stack([np.sqrt(((now - then) ** 2).sum(-1)) for then in history])
    others = np.zeros_like(own)
    for j in range(own.shape[2]):
        rest = np.delete(own, j, axis=2)
        others[:, :, j] = rest.max(-1) if rest.shape[2] else 0
    return own, others


def _scan(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the nearest entry (of ties the lowest), its squared distance, and that of the next nearest."""
    squared = ((x[:, None, :] - books) ** 2).sum(-1)
    code = squared.argmin(1)
    rows = np.arange(len(x))
    best = squared[rows, code]
    squared[rows, code] = np.iinfo(np.int64).max
    return code, best, squared.min(1)


def assign(x: np.ndarray, state: np.ndarray | None, history: list[np.ndarray], moved: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, int]:
    """The state of vectors ``x`` (row, part, component) after assigning with the last codebooks, and parts scanned.

    Without ``state`` every part is scanned.
    """
    now, books = len(history) - 1, history[-1]
    rows, parts = x.shape[:2]
    scanned = 0
    new = np.zeros(rows, state_type(parts)) if state is None else state.copy()
    for p in range(parts):
        if state is None:
            open_ = np.arange(rows)
        else:
            code = new["code"][:, p]
            upper = new["upper"][:, p].astype(np.float64) + moved[0][new["upper_round"][:, p], p, code]
            lower = new["lower"][:, p].astype(np.float64) - moved[1][new["lower_round"][:, p], p, code]
            doubtful = np.flatnonzero(~(upper < lower))
            measured = np.sqrt(((x[doubtful, p] - books[p, code[doubtful]]) ** 2).sum(-1).astype(np.float64))
            new["upper"][doubtful, p] = measured * (1 + SLACK)
            new["upper_round"][doubtful, p] = now
            open_ = doubtful[~(measured < lower[doubtful])]
        scanned += len(open_)
        for at in range(0, len(open_), SCAN_ROWS):
            some = open_[at : at + SCAN_ROWS]
            code, best, second = _scan(x[some, p], books[p])
            new["code"][some, p] = code
            new["upper"][some, p] = np.sqrt(best.astype(np.float64)) * (1 + SLACK)
            new["lower"][some, p] = np.sqrt(second.astype(np.float64)) * (1 - SLACK) if books.shape[1] > 1 else np.inf
            new["upper_round"][some, p] = new["lower_round"][some, p] = now
    return new, scanned


def sums(x: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """(part, entry, component, and last the count) summed over the vectors; exact, for at most 2**24 of them."""
    rows, parts, width = x.shape
    total = np.zeros((parts, entries, width + 1), np.int64)
    for p in range(parts):
        cells = code[:, p].astype(np.int64)
        at = (cells[:, None] * width + np.arange(width)).ravel()
        total[p, :, :width] = np.bincount(at, x[:, p].ravel(), entries * width).reshape(entries, width)
        total[p, :, width] = np.bincount(cells, minlength=entries)
    return total


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of equal size as binary values."""
    data = np.ascontiguousarray(rows)
    size = data.nbytes // max(1, len(data))
    offsets = np.arange(len(data) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _raw(column: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def _whole(vectors: pa.Array, dimension: int, scale: int) -> np.ndarray:
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    limit = component_limit(dimension)
    return np.clip(np.floor(values * scale), -limit, limit).astype(np.int64)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is there, not empty, and has finite components only."""
    finite = F.forall("_vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vectors.where(F.col("_vector").isNotNull() & (F.size("_vector") > 0)).where(finite)


def first_entries(kept: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray | None:
    """Parts of the vectors of smallest id as (part, entry, component); fewer if there are fewer, None without any."""
    order = [F.asc_nulls_last("_id"), F.col("_vector")]
    fitting = kept.where(F.size("_vector") % parts == 0).select("_id", "_vector")
    top = [r["_vector"] for r in fitting.orderBy(*order).limit(entries).collect()]
    if not top:
        return None
    dimension = len(top[0])
    if any(len(v) != dimension for v in top):
        top = [r["_vector"] for r in fitting.where(F.size("_vector") == dimension).orderBy(*order).limit(entries).collect()]
    whole = _whole(pa.array(top, pa.list_(pa.float64())), dimension, scale)
    return np.ascontiguousarray(whole.reshape(len(top), parts, dimension // parts).transpose(1, 0, 2))


def _round(history: list[np.ndarray], first: bool, scale: int):
    """A round over batches of ids, labels and vectors: the same rows with their state, then the sums as rows."""
    moved = moves(history)
    parts, entries, width = history[-1].shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, scanned = np.zeros((parts, entries, width + 1), np.int64), 0
        labels = None
        for batch in batches:
            labels = batch.column("_label").type
            if not batch.num_rows:
                continue
            if first:
                x, state = _whole(batch.column("_vector"), parts * width, scale), None
            else:
                x, state = _raw(batch.column("_x"), "<i4").astype(np.int64), _raw(batch.column("_state"), state_type(parts))
            x = x.reshape(-1, parts, width)
            state, n = assign(x, state, history, moved)
            scanned += n
            total += sums(x, state["code"], entries)
            empty = [pa.nulls(len(x), t) for t in (pa.int32(), pa.int64())]
            columns = [batch.column("_id"), batch.column("_label"), _binary(x.astype("<i4").reshape(len(x), -1)), _binary(state), *empty]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_label", "_x", "_state", "_cell", "_sum"])
        if labels is not None:
            values = np.append(total.ravel(), scanned)
            nothing = [pa.nulls(len(values), t) for t in (pa.int64(), labels, pa.binary(), pa.binary())]
            columns = [*nothing, pa.array(np.arange(len(values)), pa.int32()), pa.array(values)]
            yield pa.RecordBatch.from_arrays(columns, ["_id", "_label", "_x", "_state", "_cell", "_sum"])

    return run


def _final(history: list[np.ndarray]):
    """The last assignment: codes as hex digits and exact errors; sums are not needed any more."""
    moved, books = moves(history), history[-1]
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _raw(batch.column("_x"), "<i4").astype(np.int64).reshape(-1, parts, width)
            state, _ = assign(x, _raw(batch.column("_state"), state_type(parts)), history, moved)
            code = state["code"]
            nearest = books[np.arange(parts), code]
            error = ((x - nearest) ** 2).sum((1, 2))
            text = pa.array([row.tobytes().hex() for row in code], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_label"), text, pa.array(error)], ["_id", "_label", "_code", "_error"])

    return run


def next_books(table: DataFrame, before: np.ndarray) -> tuple[np.ndarray, int]:
    """Entries moved to the floor of their parts' mean, and the parts scanned; unused entries stay."""
    cells = table.where("_cell is not null").groupBy("_cell").agg(F.sum(F.col("_sum").cast("decimal(38,0)")).alias("_sum")).collect()
    found = {r["_cell"]: int(r["_sum"]) for r in cells}  # as many as the codebooks have components
    parts, entries, width = before.shape
    after = before.copy()
    for p in range(parts):
        for j in range(entries):
            at = (p * entries + j) * (width + 1)
            count = found.get(at + width, 0)
            if count:
                after[p, j] = [found[at + i] // count for i in range(width)]
    return after, found.get(parts * entries * (width + 1), 0)


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, Codebooks | None]:
    """``vec_id, label, code, error`` for the kept rows of ``vectors``, and the codebooks (None if no row is kept).

    Needs vec_id, embedding and label; other columns are ignored.  Left out are vectors that are null, empty or hold
    null or non-finite components, and vectors whose length is not that of the kept vector of smallest vec_id whose
    length the parts divide.  Repeated rows count and stay; a null vec_id stays and comes last in the order of ids;
    of equal ids the smaller vector is first.  With fewer rows than entries the codebooks are shorter.  Components
    beyond :func:`component_limit` count as that.  An empty table gives no row.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    spark = vectors.sparkSession
    named = vectors.select(F.col("vec_id").cast("long").alias("_id"), F.col("label").alias("_label"), F.col("embedding").cast("array<double>").alias("_vector"))
    kept = usable(named)
    start = first_entries(kept, parts, entries, scale)
    label = named.schema["_label"].dataType
    ends = StructType([StructField("_id", LongType()), StructField("_label", label), StructField("_code", StringType()), StructField("_error", LongType())])
    if start is None:
        coded, books = spark.createDataFrame([], ends), None
    else:
        books = Codebooks([start])
        schema = StructType(
            [StructField("_id", LongType()), StructField("_label", label), StructField("_x", BinaryType()), StructField("_state", BinaryType()),
             StructField("_cell", IntegerType()), StructField("_sum", LongType())]
        )
        table, old = kept.where(F.size("_vector") == parts * start.shape[2]), None
        for r in range(rounds):
            path = scratch_path(spark, f"codes-{r}")
            table.mapInArrow(_round(books.history, r == 0, scale), schema).write.parquet(path)
            if old is not None:  # the round before is read no more
                where = spark._jvm.org.apache.hadoop.fs.Path(old)
                where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
            written, old = spark.read.schema(schema).parquet(path), path
            after, scanned = next_books(written, books.final)
            books.history.append(after)
            books.scanned.append(scanned)
            table = written.where("_cell is null").select("_id", "_label", "_x", "_state")
        if rounds == 0:
            raise ValueError("at least one round")
        coded = materialise(table.mapInArrow(_final(books.history), ends), "codes")
    return coded.select(F.col("_id").alias("vec_id"), F.col("_label").alias("label"), F.col("_code").alias("code"), F.col("_error").alias("error")), books


def decode(code: str, books: Codebooks, scale: int = SCALE) -> list[float]:
    """The vector that a code stands for."""
    picked = bytes.fromhex(code)
    return [float(v) / scale for p, j in enumerate(picked) for v in books.final[p, j]]


def compressed_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: a row per kept row, see :func:`compress`.

    label_error is the error summed over rows of the same label, rows without a label together.
    """
    coded, books = compress(vectors, parts, entries, rounds, scale)
    # A struct is never null, so null labels meet; sums are a row per label, and Spark splits a hot label's join.
    sums_ = coded.groupBy(F.struct("label").alias("_of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    joined = coded.join(materialise(sums_, "label-errors"), F.struct("label") == F.col("_of"))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))
