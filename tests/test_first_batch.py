"""A batch of the scorecard: Spark reads its files, and where nothing was held before, balls are not joined with the table."""

import random

import pytest
from pyspark.sql import functions as F
from test_streaming import card, expected, feed_rows, written

from creaseline import schemas
from creaseline.queries import matches
from creaseline.sources import tables
from creaseline.streaming import live


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def drain(spark, root, rows):
    spark.createDataFrame(rows, schemas.FEED).coalesce(1).write.mode("append").parquet(f"{root}/feed")
    live.ensure_tables(spark, root)
    live.start_ingest(live.file_source(spark, f"{root}/feed"), root).awaitTermination()
    live.start_scores(spark, root).awaitTermination()


def test_first_batch_then_matches_beside_it(spark, tmp_path, monkeypatch):
    docs = {1: written.plain(), 2: written.tie_with_super_over(), 5: written.nine_and_absent()}
    rows, root, seen = feed_rows(spark, docs), str(tmp_path), []
    monkeypatch.setattr(live, "BUCKETS", 1)  # all matches share a bucket
    score, alone = live.score_batch, live.batch_alone

    def scored(batch, *rest):
        seen.append(plan(batch))
        return score(batch, *rest)

    def first(*given):
        seen.append((found := alone(*given)) is not None)
        return found

    monkeypatch.setattr(live, "score_batch", scored)
    monkeypatch.setattr(live, "batch_alone", first)
    drain(spark, root, [r for r in rows if r[0] == "1"])
    drain(spark, root, [r for r in rows if r[0] == "2"])
    drain(spark, root, [r for r in rows if r[0] == "5"] + random.Random(1).sample(rows, 20))
    assert card(spark, root) == expected(spark, docs)
    assert tables.read(spark, f"{root}/live_scorecard").count() == len(card(spark, root))
    assert [s for s in seen if isinstance(s, bool)] == [True, False, False]
    scans = [s for s in seen if isinstance(s, str)]
    assert len(scans) == 3 and all("FileScan parquet" in s and "MicroBatchScan" not in s for s in scans)


def test_batch_alone(spark, tmp_path):
    path, rows = str(tmp_path), spark.range(4).select("id", (F.col("id") % 2).cast("int").alias("part"))
    assert tables.append_batch(rows.where("part = 0"), path, 0, ["part"], "a")
    assert tables.append_batch(rows, path, 0, ["part"], "b")
    assert tables.batch_alone(spark, path, 0, "b", [{"part": 0}, {"part": 1}]) is None
    assert tables.batch_alone(spark, path, 1, "b", [{"part": 1}]) is None
    assert sorted(r["id"] for r in tables.batch_alone(spark, path, 0, "b", [{"part": 1}]).collect()) == [1, 3]


@pytest.mark.parametrize("merge_at", [2, 8])
def test_rows_between_pointers(spark, tmp_path, monkeypatch, merge_at):
    monkeypatch.setattr(tables, "MERGE_AT", merge_at)
    path = str(tmp_path)
    for n in range(5):
        tables.append_batch(spark.range(n, n + 1), path, n, app="a")
    tables.append_batch(spark.range(40, 41), path, 4, app="a", replay="replace")
    ids = lambda a, b: sorted(r["id"] for r in tables.between(spark, path, a, b).collect())
    assert ids(0, 5) == [0, 1, 2, 3, 40] and ids(1, 3) == [1, 2] and ids(5, 6) == []


def test_nothing_is_joined_with_an_empty_table(spark):
    found = plan(spark.range(5).join(tables._scan(spark, "/nothing", spark.range(1).schema, []).hint("merge"), "id", "left_anti"))
    assert "Join" not in found and "Exchange" not in found


def test_feed_is_made_from_documents_in_buckets(spark, small):
    from creaseline.queries import warehouse

    made = []
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(warehouse.ev, "envelopes", lambda documents, balls: made.append(plan(balls)) or 1 / 0)
        with pytest.raises(ZeroDivisionError):
            warehouse.stream_scorecard(spark, small)
    assert "Exchange" not in made[0] and matches.Data(spark, small).placed.count() > 0
