"""Tables in buckets of one key, so that aggregates and joins by that key, or by it and more, move nothing.

A table is hashed once when it is written: each bucket is a file of its own, sorted by the key.  Tables of the same key
type and number of buckets fit each other.  Which key and how many is noted beside the files; a session learns of it
through a catalog entry over the same folder, made when the table is first read.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from creaseline.sources.tables import read_text, write_text

NOTE = "_buckets"
#: Spark plans a join without a shuffle where both sides are hashed by a part of its keys only if this is off.
ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def store(df: DataFrame, path: str, key: str, buckets: int, placed: bool = False) -> None:
    """Writes a new table below ``path`` in so many buckets of ``key``; a hot key is one bucket, so keys should be fine.

    Rows that came by ``repartition(buckets, key)`` already are ``placed``: their tasks are the buckets, and nothing moves.
    The note comes last: without it the table is not there, so a run that breaks off leaves nothing to read.
    """
    spark, name = df.sparkSession, f"colocated_{uuid.uuid4().hex}"
    spread = df if placed else df.repartition(buckets, key)
    spread.write.bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    note = {"key": key, "buckets": buckets, "schema": json.loads(df.schema.json())}
    write_text(spark, f"{path}/{NOTE}", json.dumps(note))


def load(spark: SparkSession, path: str) -> DataFrame:
    """The table, with its buckets known to the planner."""
    note = json.loads(read_text(spark, f"{path}/{NOTE}"))
    name = f"colocated_{hashlib.sha256(path.encode()).hexdigest()[:32]}"
    if not spark.catalog.tableExists(name):
        schema = StructType.fromJson(note["schema"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{note['key']}`) SORTED BY (`{note['key']}`) INTO {note['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(name)


@contextmanager
def by_part_of_keys(spark: SparkSession):
    """Within, joins count as co-located where both sides are in buckets of one of the join's keys.

    Plans are made when a frame is run, so run it inside.
    """
    before = spark.conf.get(ALL_KEYS, "true")
    spark.conf.set(ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(ALL_KEYS, before)
