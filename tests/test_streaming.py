"""The live feed with a folder as topic: duplicates, dead letters, restart, replay, late events, impossible overs."""

import random
import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import documents as written  # noqa: E402

from creaseline import schemas  # noqa: E402
from creaseline.plans import silver  # noqa: E402
from creaseline.sources import tables  # noqa: E402
from creaseline.streaming import events as ev  # noqa: E402
from creaseline.streaming import live  # noqa: E402


def feed_rows(spark, docs):
    frame = written.frame(spark, docs)
    rows = ev.to_feed(ev.envelopes(frame, silver.deliveries(frame))).orderBy("key", "offset").collect()
    return [tuple(r) for r in rows]


def drain(spark, root, batches, **kw):
    for rows in batches:
        spark.createDataFrame(rows, schemas.FEED).coalesce(1).write.mode("append").parquet(f"{root}/feed")
        live.ensure_tables(spark, root) if not Path(f"{root}/events").exists() else None
        live.start_ingest(live.file_source(spark, f"{root}/feed"), root).awaitTermination()
        live.start_scorecard(live.events_stream(spark, root), root, **kw).awaitTermination()


def card(spark, root):
    rows = tables.read(spark, f"{root}/live_scorecard").collect()
    return {(r.match_id, r.innings_number): (r.runs, r.wickets, r.legal_balls, r.match_status) for r in rows}


def expected(spark, docs):
    frame = written.frame(spark, docs)
    rows = silver.innings(frame, silver.deliveries(frame)).collect()
    return {(r.match_id, r.innings_number): (r.delivery_runs, r.wickets, r.legal_balls, "completed") for r in rows}


def test_first_part_then_rest_duplicates_and_bad_events(spark, tmp_path):
    docs = {1: written.plain(), 2: written.tie_with_super_over()}
    rows, root = feed_rows(spark, docs), str(tmp_path)
    at = datetime(2020, 4, 1)
    bad = [("1", v, "t", 0, 900 + i, at) for i, v in enumerate(['{"a": ', '{"schema_version": 7}', '{"schema_version": 1, "event_id": "x"}', "[]"])]
    live_part = [r for r in rows if r[0] == "1"][:18]
    drain(spark, root, [live_part])
    partial = card(spark, root)
    assert partial[("1", 2)][3] == "live"
    board = tables.read(spark, f"{root}/live_scorecard").where("innings_number = 2").first()
    assert (board.target_runs, board.runs_required, board.balls_remaining) == (19, 19 - board.runs, 120 - board.legal_balls)
    drain(spark, root, [rows + random.Random(1).sample(rows, 10) + bad])
    assert card(spark, root) == expected(spark, docs)
    letters = [r.error_reason for r in spark.read.parquet(f"{root}/dead_letters").collect()]
    assert sorted(letters) == ["malformed_json", "missing_required_field", "unsupported_schema_version", "unsupported_schema_version"]
    drain(spark, root, [rows[:0] + rows])  # a full replay changes nothing
    assert card(spark, root) == expected(spark, docs)
    balls = spark.read.parquet(f"{root}/stream_deliveries")
    assert balls.count() == balls.select("event_id").distinct().count()


def test_order_and_repeats_do_not_matter(spark, tmp_path):
    docs = {5: written.nine_and_absent()}
    rows = feed_rows(spark, docs) * 2
    random.Random(3).shuffle(rows)
    drain(spark, str(tmp_path), [rows[:9], rows[9:]])
    assert card(spark, str(tmp_path)) == expected(spark, docs)


def test_replayed_batch_keeps_its_rows(spark, tmp_path):
    docs, root = {1: written.plain()}, str(tmp_path)
    batch = ev.valid(ev.parse(spark.createDataFrame(feed_rows(spark, docs), schemas.FEED)))
    for _ in range(2):
        live.score_batch(batch, 0, root)
    assert card(spark, root) == expected(spark, docs)


def test_impossible_over_stops_the_stream(spark, tmp_path):
    doc = written.plain()
    doc["innings"][0]["overs"][0]["deliveries"] += [written.ball("Reds 1", "Blues 9", 0)] * 2
    rows = feed_rows(spark, {1: doc})
    with pytest.raises(StreamingQueryException):
        drain(spark, str(tmp_path), [rows])
    assert tables.current(spark, f"{tmp_path}/live_scorecard") is None


@pytest.mark.parametrize("change, reason", [
    ({"schema_version": 2}, "unsupported_schema_version"), ({"event_time": None}, "missing_required_field"), ({"event_type": "tea"}, "unknown_event_type"),
    ({"match_id": "other"}, "key_mismatch"), ({"payload": {}}, "invalid_delivery_payload"),
    ({"payload": {"innings": 1, "over": 0, "ball_seq": 1, "batting_team": "A", "runs": {"batter": 1, "extras": 0, "total": 2}}}, "runs_inconsistent"),
])
def test_reasons(spark, change, reason):
    import json

    event = {"schema_version": 1, "event_id": "e", "event_type": "delivery", "match_id": "1", "event_time": "2020-01-01T00:00:00Z", "payload": {}} | change
    row = spark.createDataFrame([("1", json.dumps(event), "t", 0, 0, datetime(2020, 1, 1))], schemas.FEED)
    assert ev.parse(row).first().error_reason == reason


def test_late_event_is_dropped_from_windows_only(spark, tmp_path):
    start = datetime(2020, 1, 1)
    shape = spark.range(0).select(
        F.lit("").alias("event_id"), F.lit("").alias("event_type"), F.lit("").alias("match_id"), F.current_timestamp().alias("event_time"),
        F.expr("named_struct('runs', named_struct('total', 1), 'wickets', cast(null as array<struct<player_out:string,kind:string,fielders:array<string>>>))").alias("payload")).schema

    def write(rows):
        data = [(i, "delivery", "m", t, ((1,), None)) for i, t in rows]
        spark.createDataFrame(data, shape).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        query = live.start_activity(spark.readStream.schema(shape).parquet(f"{tmp_path}/in"), str(tmp_path), "10 minutes", "1 minute")
        query.awaitTermination()
        return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])

    write([("a", start), ("a", start), ("b", start + timedelta(hours=1))])
    assert run() == 0
    write([("late", start + timedelta(seconds=5)), ("c", start + timedelta(hours=2))])
    assert run() >= 1
    got = {r.window_start: r.events for r in spark.read.parquet(f"{tmp_path}/activity").collect()}
    assert got[start] == 1


def test_activity_feed_is_spread(spark, small, monkeypatch):
    """The feed has a file for each task, and all of them are one micro-batch."""
    from creaseline.queries import warehouse

    seen, start = [], live.start_activity
    monkeypatch.setattr(live, "start_activity", lambda *a, **b: seen.append((a[1], start(*a, **b))) or seen[-1][1])
    warehouse.stream_activity(spark, small).count()
    root, query = seen[0]
    assert len(spark.read.parquet(f"{root}/feed").inputFiles()) > 1
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 1


def test_kafka_options():
    assert live.kafka_options("h:1") == {"kafka.bootstrap.servers": "h:1", "kafka.security.protocol": "PLAINTEXT"}
    got = live.kafka_options("h:1", "SASL_SSL", "SCRAM-SHA-512", "me", 'a"b\\c')
    assert got["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert got["kafka.sasl.jaas.config"] == 'org.apache.kafka.common.security.scram.ScramLoginModule required username="me" password="a\\"b\\\\c";'
    with pytest.raises(ValueError, match="GSSAPI"):
        live.kafka_options("h:1", "SASL_SSL", "GSSAPI")


def test_kafka_source_sets_its_options():
    class Reader:
        def __init__(self):
            self.seen = {}

        def format(self, name):
            self.seen["format"] = name
            return self

        def option(self, key, value):
            self.seen[key] = value
            return self

        def options(self, **more):
            self.seen |= more
            return self

        def load(self):
            return self

        def select(self, *columns):
            self.seen["columns"] = columns
            return self

    class Spark:
        readStream = Reader()  # noqa: N815

    got = live.kafka_source(Spark, "h:1", "balls", per_trigger=7, options=live.kafka_options("h:1", "SSL")).seen
    assert (got["format"], got["subscribe"], got["maxOffsetsPerTrigger"], got["kafka.security.protocol"]) == ("kafka", "balls", 7, "SSL")
    assert (got["startingOffsets"], got["failOnDataLoss"]) == ("earliest", "true")


def test_continuous_mode_stops_all_when_one_fails(spark, tmp_path):
    """Queries run on a trigger, progress rows are kept, and a failed check ends every query."""
    import threading
    import time

    root, good = str(tmp_path), feed_rows(spark, {1: written.plain()})
    spark.createDataFrame(good, schemas.FEED).coalesce(1).write.mode("append").parquet(f"{root}/feed")
    listener = live.Progress(spark, f"{root}/progress")
    spark.streams.addListener(listener)
    failed = []

    def serve():
        try:
            live.run(spark, live.file_source(spark, f"{root}/feed"), root, every="1 second")
        except StreamingQueryException as error:
            failed.append(error)

    runner = threading.Thread(target=serve)
    runner.start()
    try:
        end = time.time() + 120
        while tables.current(spark, f"{root}/live_scorecard") is None and time.time() < end and runner.is_alive():
            time.sleep(0.5)
        assert card(spark, root) == expected(spark, {1: written.plain()})
        doc = written.plain()
        doc["innings"][0]["overs"][0]["deliveries"] += [written.ball("Reds 1", "Blues 9", 0)] * 2
        spark.createDataFrame(feed_rows(spark, {2: doc}), schemas.FEED).coalesce(1).write.mode("append").parquet(f"{root}/feed")
        runner.join(120)
        assert not runner.is_alive() and failed and not spark.streams.active
    finally:
        for query in spark.streams.active:
            query.stop()
        spark.streams.removeListener(listener)
    assert set(card(spark, root)) == {("1", 1), ("1", 2)}
    rows = spark.read.parquet(f"{root}/progress").collect()
    assert {"ingest", "scorecard"} <= {r.query for r in rows} and sum(r.input_rows for r in rows if r.query == "ingest") >= len(good)


def test_a_batch_writes_only_the_buckets_of_its_matches(spark, tmp_path):
    root, docs = str(tmp_path), {k: written.plain() for k in (1, 2, 3)}
    drain(spark, root, [feed_rows(spark, {k: docs[k] for k in (1, 2)})])
    files = lambda name: set(tables.read(spark, f"{root}/{name}").inputFiles())
    before = {n: files(n) for n in ("stream_matches", "live_scorecard")}
    drain(spark, root, [feed_rows(spark, {3: docs[3]})])
    assert all(before[n] <= files(n) and len(files(n)) > len(before[n]) for n in before)
    assert card(spark, root) == expected(spark, docs)
