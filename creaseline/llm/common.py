"""What several corpus operators share: reading, scratch tables, global numbering, bounded chunks of texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creaseline.sources.scratch import scratch_path

#: Numbering splits every group into this many ranges of hashes for each shuffle partition, so that a group which
#: holds a third of all rows is spread over all tasks.
BUCKETS_PER_PARTITION = 8
#: Bytes of text that one numpy step works on; larger texts are worked on alone.
CHUNK_BYTES = 1 << 20
_SPACE, _SPACE_BYTES = re.compile(r"\s"), re.compile(rb"[\x20\x09-\x0D]")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cuts lineage with a table in the shared folder: later steps survive lost executors and run nothing twice."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def number_within(df: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... without gaps within each group, by a hash of ``order``, then ``order``.

    Two levels: rows are numbered inside (group, bucket), and the pre-aggregated bucket counts give each bucket its
    start.  No task holds a group.  A bucket is a range of hashes, so the numbers are the same for any number of
    buckets.  ``order`` should tell the rows of a group apart; rows that it does not tell apart are numbered in any
    order, and equal rows share a bucket.  Rows are carried as one struct, so no column's name can clash; a column
    that is called ``name`` already is replaced.  Null groups and order values count as values.
    """
    buckets = BUCKETS_PER_PARTITION * partitions(df.sparkSession)
    mixed = F.xxhash64(*[F.col(f"`{c}`") for c in order])
    high = F.shiftrightunsigned(mixed, 32)
    bucket = F.shiftright(high * buckets, 32).cast("int")
    # One struct as key: it is never null itself, so window and join share an exchange even where a group is null.
    key = F.struct(*[F.col(f"`{c}`").alias(f"g{i}") for i, c in enumerate(group)], bucket.alias("bucket"))
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    rows = df.select(row.alias("_row"), key.alias("_key"), mixed.alias("_mixed"))
    before = Window.partitionBy(*[f"_key.g{i}" for i in range(len(group))]).orderBy("_key.bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.select(key.alias("_key")).groupBy("_key").count()
    starts = counts.select(F.col("_key").alias("_of"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_key").orderBy(F.shiftrightunsigned("_mixed", 32), "_mixed", *[F.col(f"_row.`{c}`") for c in order])
    ranked = rows.withColumn("_rank", F.row_number().over(inside) - 1)
    joined = ranked.join(starts, F.col("_key") == F.col("_of"))
    kept = [F.col(f"_row.`{c}`").alias(c) for c in df.columns if c != name]
    return joined.select(*kept, (F.col("_rank") + F.col("_start")).alias(name))


def in_sample(mixed: Column, wanted: int | Column, rows: int | Column) -> Column:
    """Whether a row belongs to a sample of about ``wanted`` of ``rows``, by a 64-bit hash of it.

    The hash counts as a fraction of 53 bits, so a share of one in 10**12 is still hit as often as it should be.
    """
    fraction = F.shiftrightunsigned(mixed, 11).cast("double") * 2.0**-53
    return fraction * (rows if isinstance(rows, Column) else F.lit(float(rows))) < wanted


def label_share(doc_id: Column, modulo: int) -> Column:
    """crc32 of the id's decimal text, modulo; decides which rows a model may learn from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulo)


def runs_by_bytes(sizes: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """[start, end) ranges of consecutive values that hold about ``limit`` bytes or one value."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, end
        start = end


def pieces(text, size: int = CHUNK_BYTES):
    """``text`` (str or bytes) in parts of about ``size`` that end before white space, so that no word is cut."""
    space = _SPACE_BYTES if isinstance(text, bytes) else _SPACE
    start = 0
    while start < len(text):
        found = space.search(text, start + size) if start + size < len(text) else None
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end


def flat_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (int64, from 0) and the bytes of a string or binary array; nulls count as empty."""
    array = array.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw[off[0] : off[-1]]
