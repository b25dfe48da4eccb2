"""What a batch build moves: documents once, for balls; sums twice, for scorecards."""

import pytest
from pyspark.sql import functions as F

from creaseline.plans import batch, marts, silver
from creaseline.queries import matches
from creaseline.sources import colocated, tables


def exchanges(frame, kind="Exchange "):
    return frame._jdf.queryExecution().executedPlan().toString().count(kind)


@pytest.fixture(scope="module")
def data(spark, small):
    return matches.Data(spark, small)


@pytest.fixture(scope="module")
def built(data, spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("batch"))
    found = batch.build(spark, data.documents, data.venues, data.teams, data.adjustments, root, stop_on_error=False, parts=5)
    return root, found


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_only_documents_move_for_balls(data):
    moved = silver.deliveries(silver.in_seasons(data.documents, 5))
    assert exchanges(moved) == exchanges(moved, "Exchange rangepartitioning") == 1
    assert same(moved, data.balls)


def test_balls_are_written_where_they_are(built, data):
    root, found = built
    files = tables.read(data.spark, f"{root}/silver/deliveries").inputFiles()
    # A part holds a range of seasons: at most a file for each part and one more for each season.
    assert len(files) <= 5 + data.matches.select("season").distinct().count()
    assert same(found["deliveries"], data.balls)


def test_wickets_of_stored_balls_move_nothing(data, tmp_path):
    data.balls.write.parquet(str(tmp_path / "balls"))
    wickets = silver.wickets(data.spark.read.parquet(str(tmp_path / "balls")))
    assert exchanges(wickets) == 0
    counted = wickets.where("counts_as_team_wicket").groupBy("match_id", "innings_number").agg(F.count("*").alias("n"), F.countDistinct("team_wicket_number").alias("d"), F.max("team_wicket_number").alias("m"))
    assert counted.where("n <> d or n <> m").count() == 0


def test_line_ups_move_as_one_row_a_team(data):
    plan = data.players._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("posexplode") < plan.index("Join")


def test_scorecards_gather_their_sums_once(built):
    t = built[1]
    plain = marts.scorecards(t)
    with colocated.by_part_of_keys(t["deliveries"].sparkSession):
        gathered = marts.scorecards(t, gathered=True)
        # Sums, these by match, line-ups; for batters their wickets too.
        assert exchanges(gathered["bowling_scorecard"], "Exchange hashpartitioning") <= 3
        assert exchanges(gathered["batting_scorecard"], "Exchange hashpartitioning") <= 4
        assert all(same(gathered[n], plain[n]) for n in plain)
