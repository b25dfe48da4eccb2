"""Sharding by longest processing time: groups that must stay together go, largest first, to the least loaded shard.

Rows with equal texts are a group.  Groups that are large against a shard (``1 / LARGE_SHARE`` of its fair share or
more) are at most ``shards * LARGE_SHARE``, whatever the corpus; one heap places them first.  The level to which the
shards then have to be filled follows by arithmetic.  All other groups are dealt by a hash into buckets; each bucket
has its own heap, which begins with the shards' remaining room in proportion to the bucket's bytes and places the
bucket's groups, largest first, on the shard with most room.  A bucket ends uneven by its smallest groups only, so
the shards' sizes come out near equal without any task seeing all groups.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import materialise, number_within

SHARDS = 16
LARGE_SHARE = 64
#: A bucket has about this many groups: enough for even shards, few enough for one heap.
BUCKET_GROUPS = 4000
#: Bytes that a row takes besides its text.
ROW_BYTES = 1


def longest_first(sizes: list[int], loads: list[float]) -> list[int]:
    """The shard of each group: sizes in descending order, each to the least loaded shard (the first of equals)."""
    heap = [(load, shard) for shard, load in enumerate(loads)]
    heapq.heapify(heap)
    out = []
    for size in sizes:
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        out.append(shard)
    return out


def room(loads: list[int], rest: int) -> list[float]:
    """How much of ``rest`` each shard takes so that all that take any end at one level."""
    order = sorted(range(len(loads)), key=lambda s: loads[s])
    level, total = 0.0, 0
    for n, shard in enumerate(order, 1):
        total += loads[shard]
        level = (total + rest) / n
        if n == len(order) or level <= loads[order[n]]:
            break
    return [max(0.0, level - load) for load in loads]


def _bucket(quota: list[float]):
    whole = sum(quota) or 1.0

    def run(groups: pa.Table) -> pa.Table:
        groups = groups.sort_by([("bytes", "descending"), ("group", "ascending")])
        sizes = groups["bytes"].to_pylist()
        mine = sum(sizes)
        shard = longest_first(sizes, [-q / whole * mine for q in quota])
        return pa.table({"group": groups["group"], "shard": pa.array(shard, pa.int32())})

    return run


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard``: one row per row of ``docs``.

    size is the UTF-8 length of the text plus 1; a null text has length 0, checksum 0 and is in one group with the
    other null texts.  Equal texts share a shard.  slot counts from 0 within a shard.  The law is ``bytes``: sizes
    near equal, as far as the largest group allows; so grown_shard is null.  Needs doc_id and text; other columns
    are ignored.  Repeated rows, and those with equal or null doc_id, have slots of their own, in any order among
    themselves.  Texts of any length move as their size and hashes only.  An empty table gives no row.
    """
    text = F.col("text").cast("binary")
    sized = docs.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("group"),
    )
    sized = materialise(sized, "sizes")
    groups = materialise(sized.groupBy("group").agg(F.sum("size").alias("bytes")), "groups")
    number, total = groups.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    limit = max(1.0, total / shards / LARGE_SHARE)
    # Every large group holds 1 / (shards * LARGE_SHARE) of all bytes, so these are shards * LARGE_SHARE rows at most.
    large = groups.where(F.col("bytes") >= limit).orderBy(F.desc("bytes"), "group").collect()
    chosen = longest_first([r["bytes"] for r in large], [0.0] * shards)
    loads = [0] * shards
    for row, shard in zip(large, chosen):
        loads[shard] += row["bytes"]
    placed = docs.sparkSession.createDataFrame([(r["group"], s) for r, s in zip(large, chosen)], "group binary, shard int")
    quota = room(loads, total - sum(loads))
    buckets = -(-number // BUCKET_GROUPS) or 1
    small = (
        groups.where(F.col("bytes") < limit)
        .withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInArrow(_bucket(quota), "group binary, shard int")
    )
    homes = small.unionByName(placed).withColumnRenamed("group", "_group")
    homed = materialise(
        sized.join(homes, F.col("group") == F.col("_group")).select("doc_id", "size", "text_crc32", "shard"), "homes"
    )
    slotted = number_within(homed, ["shard"], ["doc_id", "text_crc32"], "slot")
    return slotted.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
