"""A batch build over documents that lie in buckets of their match: balls and scorecards are written where they are, overs move instead of balls."""

import pytest
from pyspark.sql import functions as F

from creaseline import shaped
from creaseline.plans import batch, marts, quality, silver
from creaseline.queries import matches
from creaseline.sources import tables


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def data(spark, small):
    return matches.Data(spark, small)


@pytest.fixture(scope="module")
def built(data, spark, tmp_path_factory):
    spread, before = [], tables._spread
    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(tables, "_spread", lambda df, by: spread.append(set(df.columns)) or before(df, by))
        root = str(tmp_path_factory.mktemp("placed"))
        found = batch.build(spark, data.placed, data.venues, data.teams, data.adjustments, root, stop_on_error=False, placed=True)
    return root, found, spread


def rows(frame, columns):
    return sorted(map(str, frame.select(*columns).collect()))


def test_balls_of_placed_documents_move_nothing(data, small):
    buckets = shaped.buckets(data.spark, small, 8)
    assert len(data.placed.inputFiles()) <= buckets
    assert "Exchange" not in plan(silver.deliveries(data.placed))
    assert rows(silver.deliveries(data.placed), ["delivery_id", "ball_label", "team_runs_after"]) == rows(data.balls, ["delivery_id", "ball_label", "team_runs_after"])


def test_lines_move_once_to_the_buckets(spark, small, monkeypatch):
    moved = plan(shaped.documents(spark, small, 5))
    assert moved.count("Exchange ") == 1 and ", 5), REPARTITION_BY_NUM" in moved, moved
    monkeypatch.setattr(shaped, "LINE_BYTES", 1000)
    assert shaped.buckets(spark, small, 8) > 8


def test_same_tables_as_from_ranges(data, spark, built, tmp_path):
    ranged = batch.build(spark, data.documents, data.venues, data.teams, data.adjustments, str(tmp_path), stop_on_error=False, parts=5)
    for name, frame in ranged.items():
        columns = [c for c in frame.columns if c != "silver_built_at"]
        assert rows(frame, columns) == rows(built[1][name], columns), name
    checks = ["check", "table", "severity", "violations", "sample"]
    results = [spark.read.parquet(f"{root}/{batch.RESULTS}") for root in (built[0], str(tmp_path))]
    assert rows(results[0].where("table <> 'matches'"), checks) == rows(results[1].where("table <> 'matches'"), checks)
    assert rows(results[0], checks[:4]) == rows(results[1], checks[:4])


def test_large_tables_are_written_where_they_are(built):
    # Balls, wickets and scorecards do not move for their files.
    assert built[2] and not [c for c in built[2] if c & {"ball_label", "batting_position", "bowling_order"}]


def test_overs_move_instead_of_balls(spark, tmp_path):
    balls = spark.range(3000).select(
        (F.col("id") % 7).cast("string").alias("match_id"), (F.col("id") % 2).cast("int").alias("innings_number"), (F.col("id") % 19).cast("int").alias("over_index"),
        F.when(F.col("id") % 5 > 0, F.col("id") * 7919 % 1013 % 23).cast("int").alias("delivery_seq"), (F.col("id") % 5 > 0).alias("is_legal"),
        (F.col("id") % 900 == 0).alias("umpire_miscount"), (F.col("id") % 6).cast("int").alias("runs_total"),
    )
    # One of them stands alone, and so do some places without a number.
    balls = balls.unionByName(balls.limit(1).withColumn("match_id", F.lit("alone")).withColumn("delivery_seq", F.lit(None).cast("int")))
    balls.write.parquet(str(tmp_path / "balls"))
    stored, over = spark.read.parquet(str(tmp_path / "balls")), [*silver.INNINGS_KEY, "over_index"]
    facts = quality.over_facts(stored)
    assert "REPARTITION" not in plan(facts) and "partial_sum" in plan(facts).split("Exchange")[1]
    keys = stored.groupBy(*over, "delivery_seq").count()
    expected = keys.groupBy(*over).agg(F.count_if(F.col("count") > 1).alias("repeated"))
    assert rows(facts, [*over, "repeated"]) == rows(expected, [*over, "repeated"])
    assert 0 < facts.where("repeated = 0").count() < facts.count()
    sums = stored.groupBy(*over).agg(F.count_if("is_legal").alias("legal_balls"), F.bool_or("umpire_miscount").alias("umpire_miscount"), F.sum("runs_total").alias("runs_total"))
    assert rows(facts, sums.columns) == rows(sums, sums.columns)


def test_gathered_parts_follow_the_balls(built, monkeypatch):
    monkeypatch.setattr(marts, "GATHERED_BYTES", 1000)
    t = built[1]
    balls = t["deliveries"]
    for card in marts.scorecards(t, gathered=True).values():
        parts = marts.parts_for(balls, 1000, 8)
        assert parts > 8 and "hashpartitioning(match_id#" in plan(card) and f", {parts}), REPARTITION_BY_NUM" in plan(card)
