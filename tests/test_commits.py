"""Micro-batches by app: replays, two writers, merging; the same table as a stream of its commits."""

from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from creaseline.sources import commits, tables

SHAPE = "id long, part string"


def rows(spark, ids, part="a"):
    return spark.createDataFrame([(i, part) for i in ids], SHAPE)


def held(spark, path, *columns):
    return sorted(tuple(r) for r in tables.read(spark, path).select(*(columns or ("id", "part", tables.BATCH))).collect())


def test_replay_with_other_partition_values(spark, tmp_path):
    """A repeated batch is skipped whole or replaced whole, though its rows now belong to another partition."""
    path = str(tmp_path / "t")
    assert tables.append_batch(rows(spark, [1, 2]), path, 0, ["part"])
    assert not tables.append_batch(rows(spark, [1, 2, 3], "b"), path, 0, ["part"])
    assert held(spark, path) == [(1, "a", 0), (2, "a", 0)]
    assert tables.append_batch(rows(spark, [1, 2, 3], "b"), path, 0, ["part"], replay="replace")
    assert held(spark, path) == [(1, "b", 0), (2, "b", 0), (3, "b", 0)]
    tables.append_batch(rows(spark, [9]), path, 1, ["part"])
    with pytest.raises(ValueError, match="closed"):
        tables.append_batch(rows(spark, [1]), path, 0, ["part"], replay="replace")
    tables.append_batch(rows(spark, []), path, 1, ["part"], replay="replace")
    assert held(spark, path) == [(1, "b", 0), (2, "b", 0), (3, "b", 0)]
    with pytest.raises(ValueError, match="skip or replace"):
        tables.append_batch(rows(spark, [1]), path, 2, replay="merge")


def test_two_apps_on_one_table(spark, tmp_path):
    """A query with a fresh checkpoint is another writer: its batch 0 does not erase the first one's."""
    path = str(tmp_path / "t")
    apps = [tables.app_id(spark, str(tmp_path / f"checkpoint-{i}")) for i in (0, 1)]
    assert apps[0] != apps[1] and apps[0] == tables.app_id(spark, str(tmp_path / "checkpoint-0"))
    for app, ids in zip(apps, ([1, 2], [3])):
        for _ in range(2):
            tables.append_batch(rows(spark, ids), path, 0, ["part"], app)
    assert held(spark, path) == [(1, "a", 0), (2, "a", 0), (3, "a", 0)]
    assert tables.committed(spark, path, 0, apps[1]) and not tables.committed(spark, path, 1, apps[1]) and not tables.committed(spark, path, 0, "other")


@pytest.mark.parametrize("replay", ["skip", "replace"])
def test_a_broken_off_append_leaves_the_batch_before(spark, tmp_path, monkeypatch, replay):
    path = str(tmp_path / "t")
    tables.append_batch(rows(spark, [1]), path, 0, ["part"])

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(tables, "_publish", lost)
        tables.append_batch(rows(spark, [7], "b"), path, 0 if replay == "replace" else 1, ["part"], replay=replay)
    assert held(spark, path) == [(1, "a", 0)]
    assert tables.append_batch(rows(spark, [7], "b"), path, 0 if replay == "replace" else 1, ["part"], replay=replay)
    assert [r[0] for r in held(spark, path)] == ([7] if replay == "replace" else [1, 7])


def test_a_writer_that_was_overtaken_appends_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.append_batch(rows(spark, [1]), path, 0, app="x")
    store, raced = tables._store, []

    def overtaken(df, where, partition_by):
        found = store(df, where, partition_by)
        if not raced:
            raced.append(True)
            tables.append_batch(rows(spark, [2]), path, 0, app="y")
        return found

    monkeypatch.setattr(tables, "_store", overtaken)
    assert tables.append_batch(rows(spark, [3]), path, 1, app="x")
    assert [r[0] for r in held(spark, path)] == [1, 2, 3]


def test_columns_that_come_later(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.append_batch(spark.range(2), path, 0)
    tables.append_batch(spark.range(1).withColumn("more", F.lit("x")), path, 1)
    got = {(r.id, r.more) for r in tables.read(spark, path).collect()}
    assert got == {(0, None), (1, None), (0, "x")}


def test_two_hundred_batches_list_as_much_as_few(spark, tmp_path):
    """What a micro-batch lists of its own bucket stays bounded, and each row is written again once a tier at most."""
    path = str(tmp_path / "t")
    frame = spark.range(2).select(F.col("id"), (F.col("id") % 2).cast("int").alias("bucket")).coalesce(1).persist()
    listed = []
    for n in range(200):
        tables.append_batch(frame, path, n, ["bucket"])
        found = tables.state(spark, path)
        listed.append(max(len(tables.within(found.folders, [{"bucket": b}])) for b in (0, 1)))
    assert max(listed) <= 3 * tables.MERGE_AT and max(listed[100:]) <= max(listed[:100]) + tables.MERGE_AT
    assert max(found.levels.values()) <= 2 and len(found.text()) < 30_000
    assert tables.read(spark, path).count() == 400
    assert tables.read(spark, path, only=[{"bucket": 1}]).agg(F.countDistinct(tables.BATCH)).first()[0] == 200
    folders = {p.name for p in (tmp_path / "t").glob("_v=*")}
    assert len(folders) <= 3 * tables.MERGE_AT + 2 * tables.MERGE_AT  # superseded ones are gone


def test_folders_of_a_partition_are_merged_on_replacement(spark, tmp_path):
    """New rows stand beside the others of their partition until its folders are many."""
    path = str(tmp_path / "t")
    for n in range(30):
        new = spark.createDataFrame([(n, "a")], SHAPE)
        tables.replace_ids(spark, new, new, path, "id", ["part"])
        assert len(tables.state(spark, path).folders) <= tables.MERGE_AT
    assert tables.read(spark, path).count() == 30


# ---------------------------------------------------------------- stream of commits
class Feed:
    """A running consumer that keeps what it was given, by micro-batch."""

    def __init__(self, spark, path, checkpoint, schema=f"{SHAPE}, {tables.BATCH} long"):
        self.spark, self.path, self.checkpoint, self.schema, self.given = spark, path, checkpoint, StructType.fromDDL(schema), {}

    def drain(self):
        def keep(batch, n):
            self.given[n] = sorted(tuple(r) for r in batch.collect())

        stream = commits.stream(self.spark, self.path, self.schema)
        query = stream.writeStream.option("checkpointLocation", self.checkpoint).foreachBatch(keep).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(row for batch in self.given.values() for row in batch)


def test_stream_gives_each_batch_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MERGE_AT", 3)
    path = str(tmp_path / "t")
    feed, late = (Feed(spark, path, str(tmp_path / name)) for name in ("c1", "c2"))
    tables.ensure(spark, path, rows(spark, []).schema)
    assert feed.drain() == []
    expected = []
    for n in range(8):
        part = f"p {n % 2}/%"
        tables.append_batch(rows(spark, [n, n + 100], part), path, n, ["part"], "x")
        tables.append_batch(rows(spark, [n, n + 100], part), path, n, ["part"], "x")  # a replay
        expected += [(n, part, n), (n + 100, part, n)]
        if n % 2:
            assert feed.drain() == sorted(expected)  # merges of folders give nothing again
    # The last batch is replaced after it was given: it is not given again; who comes later gets the new rows.
    tables.append_batch(rows(spark, [777], "other"), path, 7, ["part"], "x", replay="replace")
    tables.append_batch(rows(spark, [55], None), path, 0, ["part"], "y")
    assert feed.drain() == sorted([*expected, (55, None, 0)], key=lambda r: (r[0], str(r[1])))
    assert late.drain() == sorted([r for r in expected if r[2] != 7] + [(777, "other", 7), (55, None, 0)])
    assert [r for r in held(spark, path) if r[0] == 777]


def test_stream_does_not_see_what_was_not_committed(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    feed = Feed(spark, path, str(tmp_path / "c"))
    tables.append_batch(rows(spark, [1]), path, 0, ["part"])

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched, pytest.raises(RuntimeError):
        patched.setattr(tables, "_publish", lost)
        tables.append_batch(rows(spark, [2]), path, 1, ["part"])
    assert len(list(Path(path).glob("_v=*"))) == 2
    assert feed.drain() == [(1, "a", 0)]


def test_stream_of_another_table_is_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(rows(spark, [1]), path)
    with pytest.raises(StreamingQueryException, match="not a table of micro-batches"):
        Feed(spark, path, str(tmp_path / "c")).drain()


def test_stream_keeps_types(spark, tmp_path):
    """Nested values, dates, times and decimals arrive as they were written; a partition column has its type."""
    frame = spark.sql("""select 1L as id, named_struct('a', array(1, null), 'b', map('k', 2.5D)) as s, timestamp'2020-01-02 03:04:05.678901' as t,
        date'2020-05-06' as d, cast(1.25 as decimal(10,2)) as x, cast(null as string) as none, true as flag""")
    path = str(tmp_path / "t")
    tables.append_batch(frame, path, 0, ["d", "flag"])
    seen = []
    stream = commits.stream(spark, f"file:{path}", tables.read(spark, path).schema)
    stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(lambda b, _: seen.extend(b.collect())).trigger(availableNow=True).start().awaitTermination()
    expected = tables.read(spark, path).first()
    assert [r.asDict(recursive=True) for r in seen] == [expected.asDict(recursive=True)]
