"""What keeps queries over match documents as large as their input: parts that follow it, one move of lines, one parse."""

import pytest
from pyspark.sql import functions as F

from creaseline import shaped
from creaseline.operators import keyed
from creaseline.plans import silver
from creaseline.queries import matches
from creaseline.streaming import events as ev
from creaseline.streaming import live


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def data(spark, small):
    return matches.Data(spark, small)


def test_lines_move_once(data):
    """To their match; documents and balls with running totals are made where the lines arrive."""
    for frame in (data.once, data.balls_once):
        assert plan(frame).count("Exchange hashpartitioning") == 1


def test_parts_follow_the_input(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(20000).selectExpr("cast(id as string) as match_id", "sha2(cast(id as string), 256) as x").write.parquet(path)
    rows = spark.read.parquet(path)
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert keyed.parts_for(rows, 1 << 30, 3) == 3 and keyed.parts_for(rows, 50_000, 3) >= 20
    assert keyed.in_parts(rows, "match_id", 50_000).rdd.getNumPartitions() >= 20 > usual
    assert keyed.input_bytes(rows.join(rows.withColumn("y", F.lit(1)), "match_id")) < 10 * keyed.input_bytes(rows)


def test_envelopes_join_nothing(data):
    assert "Join" not in plan(data.events)
    # A ball of a match without a document is no event.
    some = data.documents.where("match_id <> '3'")
    got = ev.envelopes(some, data.balls).select("event_id", "sequence", "event_time", "payload")
    assert sorted(map(str, got.collect())) == sorted(map(str, data.events.where("match_id <> '3'").select(*got.columns).collect()))


def test_live_cards_parse_once(data):
    assert "from_json" not in plan(matches._live_cards(data))


def test_substitutions_read_replacements_only(data):
    read = plan(silver.substitutions(data.documents))
    assert "replacements" in read and "non_striker" not in read.split("ReadSchema")[1]


def test_buckets_follow_the_documents(data, monkeypatch):
    monkeypatch.setattr(shaped, "DOCUMENT_BYTES", 1_000)
    found = matches._colocated(data)["deliveries"]
    assert len(found.inputFiles()) > 8  # a file a bucket


def test_scores_read_no_raw_text(spark, tmp_path):
    live.ensure_tables(spark, str(tmp_path))
    assert set(live.events_stream(spark, str(tmp_path), live.SCORED).columns) == set(live.SCORED)
    assert not live.KEPT.useMemory


def test_documents_are_nested_in_one_pass(spark, small):
    """Lines are sorted once; a match's balls are collected as they come, without a hash table or another sort."""
    assert plan(shaped.documents(spark, small)).count("ObjectHashAggregate") == 2
    with keyed.sorted_groups(spark):
        nested = plan(shaped.documents(spark, small))
    assert "ObjectHashAggregate" not in nested and nested.count("Sort [") == 1 and nested.count("SortAggregate") == 1


def test_venues_read_innings_once(data):
    """Documents are read for matches, for heads of innings and for balls, and only sums of balls move."""
    read = plan(matches.marts.venue_stats(data.matches, data.innings))
    assert read.count("ReadSchema: struct<match_id") == 3
    assert "Window" not in read
