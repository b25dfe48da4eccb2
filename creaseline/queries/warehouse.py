"""Queries of the keyed, landing, streaming and sink operators over the warehouse tables, and SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creaseline import shaped
from creaseline.operators import keyed, ranges
from creaseline.plans import quality, serve, silver
from creaseline.queries import matches
from creaseline.queries.flat import flat
from creaseline.shaped import LINE_ORDER, table
from creaseline.sources import commits, landing, tables
from creaseline.sources.scratch import scratch_path
from creaseline.streaming import events as ev
from creaseline.streaming import live

# Fixed values of the queries.
WATERMARK, WINDOW = "2 hours", "1 hour"


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


def latest_per_key(spark, sf_dir):
    rows = keyed.latest_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")])
    return flat(rows, "o_custkey", "o_orderkey", "o_orderstatus")


def dedupe_first(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.lit(0).alias("copy"))
    again = events.where("event_id % 7 = 0").withColumn("copy", F.lit(1))
    return flat(keyed.dedupe_first(again.unionByName(events), ["event_id"], [F.col("copy")]))


def pending_versions(spark, sf_dir):
    current = _orders(spark, sf_dir).select("o_orderkey", F.sha2(F.concat_ws("|", "o_orderkey", "o_orderstatus"), 256).alias("sha256"))
    held = current.where("o_orderkey % 3 = 0").withColumn("sha256", F.when(F.col("o_orderkey") % 2 == 0, "old").otherwise(F.col("sha256")))
    return flat(keyed.pending_versions(current, held, ["o_orderkey", "sha256"]))


def replace_for_ids(spark, sf_dir):
    orders = _orders(spark, sf_dir)
    ids = table(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("o_custkey"))
    new = orders.where("o_custkey % 20 = 0").withColumn("o_orderstatus", F.lit("N"))
    return flat(keyed.replace_for_ids(orders, ids, new, "o_custkey"), "o_orderkey", "o_custkey", "o_orderstatus")


def _two_sides(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    return orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("S"))


def merge_insert_only(spark, sf_dir):
    return flat(keyed.merge_insert_only(*_two_sides(spark, sf_dir), ["o_orderkey"]))


def merge_upsert(spark, sf_dir):
    return flat(keyed.merge_upsert(*_two_sides(spark, sf_dir), ["o_orderkey"]))


def merge_coalesce(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").alias("version"))
    target = c.where("c_custkey % 2 = 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 8 != 0, F.col("c_mktsegment")))
    source = c.where("c_custkey % 3 = 0").withColumn("c_name", F.when(F.col("c_custkey") % 9 != 0, F.lower("c_name"))).withColumn("version", F.lit(12))
    return flat(keyed.merge_coalesce(target, source, "c_custkey", "version"))


def first_appearance_order(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return flat(keyed.first_appearance(lines, ["l_orderkey"], "l_suppkey", [c for c in LINE_ORDER if c != "l_orderkey"], "place"))


def partition_count(spark, sf_dir):
    suppliers = F.count(F.lit(1)).over(Window.partitionBy("s_nationkey"))
    return flat(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", suppliers.alias("suppliers")))


def landing_classify(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    known = docs.where("doc_id % 2 = 0").select("doc_id", F.when(F.col("doc_id") % 6 == 0, "old").otherwise(F.sha2(F.col("text").cast("binary"), 256)).alias("sha256"))
    return flat(landing.classify(docs, known, "doc_id", "text"), "doc_id", "sha256", "change_type")


def landing_lineage(spark, sf_dir):
    return flat(serve.counts_by(landing_classify(spark, sf_dir), "change_type", "versions"))


def landing_problems(spark, sf_dir):
    """Match documents as JSON text, a slice of them damaged; what landing says about each."""
    docs = shaped.documents(spark, sf_dir)
    text = F.to_json(F.struct("meta", F.struct(F.col("info.dates").alias("dates"), F.col("info.teams").alias("teams"), F.col("info.outcome").alias("outcome"), F.col("info.season").alias("season")).alias("info"), F.array().alias("innings")))
    kind = F.col("match_id").cast("bigint") % 5
    damaged = F.when(kind == 0, F.lit('{"meta": ')).when(kind == 1, F.lit("[1, 2]")).when(kind == 2, F.lit('{"meta": {}, "info": {"dates": [], "teams": [], "season": "1"}}')).when(
        kind == 3, F.regexp_replace(text, '"teams":\\[[^]]*]', '"teams":["one"]')).otherwise(text)
    return flat(docs.select("match_id", landing.problem(damaged).alias("problem")))


def dq_unique_key(spark, sf_dir):
    return flat(quality.duplicated("lineitem", "l_orderkey", "l_linenumber")({"lineitem": table(spark, sf_dir, "lineitem")}))


def dq_orphans(spark, sf_dir):
    parents = table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0")
    return flat(quality.orphans("orders", "o_custkey", "customer", "c_custkey")({"orders": table(spark, sf_dir, "orders"), "customer": parents}))


def dq_parent_reconcile_orders(spark, sf_dir):
    """Customers whose orders do not sum to their balance in whole units: all but a few."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.floor("o_totalprice").alias("price"))
    run = quality.sums_differ("customer", ["c_custkey"], "orders", "price", "cast(floor(c_acctbal) as bigint)", op=">")
    return flat(run({"customer": table(spark, sf_dir, "customer"), "orders": orders}), "c_custkey")


def live_board(spark, sf_dir):
    return flat(serve.live_board(table(spark, sf_dir, "events"), [F.desc("ts"), F.desc("event_id")]), "event_id", "ts", "user_id", "event_type")


def latest_run_rows(spark, sf_dir):
    return flat(serve.latest_run(table(spark, sf_dir, "events"), "user_id", "ts"), "event_id", "user_id")


def activity_windows(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    grouped = events.groupBy(F.window("ts", WINDOW).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users"))
    return flat(grouped.select(F.col("w.start").alias("window_start"), "event_type", "events", "users"))


def feed_activity(spark, sf_dir):
    return flat(activity_windows(spark, sf_dir).groupBy("window_start").agg(F.sum("events").alias("events")))


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a feed of deliveries; one row in twenty breaks each of the seven rules."""
    kind = F.col("event_id") % 20
    payload = F.struct(
        F.when(kind != 5, F.lit(1)).alias("innings"), F.lit(0).alias("over"), (kind + 1).alias("ball_seq"), F.lit("T1").alias("batting_team"),
        F.struct(F.lit(1).alias("batter"), F.lit(0).alias("extras"), F.when(kind == 6, 2).otherwise(1).alias("total")).alias("runs"),
    )
    event = F.struct(
        F.when(kind == 1, 2).otherwise(ev.SCHEMA_VERSION).alias("schema_version"), F.col("event_id").cast("string").alias("event_id"),
        F.when(kind == 3, "tea_break").otherwise(ev.BALL).alias("event_type"), F.col("user_id").cast("string").alias("match_id"),
        F.when(kind != 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("event_time"), payload.alias("payload"),
    )
    return table(spark, sf_dir, "events").select(
        F.when(kind == 4, "other").otherwise(F.col("user_id").cast("string")).alias("key"), F.when(kind == 0, '{"broken": ').otherwise(F.to_json(event)).alias("value"),
        F.lit("events").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), F.col("ts").cast("timestamp").alias("timestamp"),
    )


def dlq_by_reason(spark, sf_dir):
    return flat(serve.counts_by(ev.dead_letters(ev.parse(_feed(spark, sf_dir))), "error_reason", "events"))


def _streamed(spark: SparkSession, feed: DataFrame, name: str) -> tuple[str, DataFrame]:
    root = scratch_path(spark, name)
    feed.write.parquet(f"{root}/feed")
    return root, live.file_source(spark, f"{root}/feed")


def stream_reject_reasons(spark, sf_dir):
    """The feed through the streaming ingest; dead letters by reason and the number of valid events."""
    root, feed = _streamed(spark, _feed(spark, sf_dir), "stream-reject")
    live.ensure_tables(spark, root)
    live.start_ingest(feed, root).awaitTermination()
    reasons = spark.read.parquet(f"{root}/dead_letters").select("error_reason")
    valid = spark.read.parquet(f"{root}/events").select(F.lit("valid").alias("error_reason"))
    return flat(serve.counts_by(reasons.unionByName(valid), "error_reason", "events"))


def stream_scorecard(spark, sf_dir):
    """All matches as a feed in which every fifth event comes twice, through ingest and scorecard queries."""
    documents = matches.Data(spark, sf_dir).placed
    copies = F.when(F.col("offset") % 5 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    feed = ev.to_feed(ev.envelopes(documents, silver.deliveries(documents))).select("*", F.explode(copies).alias("_copy")).drop("_copy")
    root, source = _streamed(spark, feed, "stream-score")
    live.ensure_tables(spark, root)
    live.start_ingest(source, root).awaitTermination()
    live.start_scores(spark, root, stop_on_error=False).awaitTermination()
    card = tables.read(spark, f"{root}/live_scorecard")
    return flat(card, *silver.INNINGS_KEY, "runs", "wickets", "legal_balls", "deliveries", "score_text", "last_event_id", "match_status")


def stream_activity(spark, sf_dir):
    """Windows that the watermark closed; every seventh event comes twice and counts once."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", live.STATE_STORE)
    root = scratch_path(spark, "stream-activity")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"), F.lit(ev.BALL).alias("event_type"), F.col("event_type").alias("match_id"), F.col("ts").cast("timestamp").alias("event_time"),
        F.expr("named_struct('runs', named_struct('total', cast(event_id % 7 as int)), 'wickets', cast(null as array<struct<player_out:string,kind:string,fielders:array<string>>>))").alias("payload"))
    again = events.where("event_id % 7 = 0")
    # All files of a folder are one micro-batch, so no event is late.
    events.unionByName(again).write.parquet(f"{root}/feed")
    source = spark.readStream.schema(events.schema).parquet(f"{root}/feed")
    live.start_activity(source, root, WATERMARK, WINDOW).awaitTermination()
    return flat(spark.read.parquet(f"{root}/activity"), "window_start", "match_id", "events", "deliveries", "runs")


def sink_replace_ids(spark, sf_dir):
    """A partitioned table, then some customers' orders replaced and some removed; the table as read back."""
    path, orders = scratch_path(spark, "orders"), _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus")
    tables.overwrite(orders, path, ["o_orderstatus"])
    ids = table(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("o_custkey"))
    tables.replace_ids(spark, orders.where("o_custkey % 20 = 0").withColumn("o_orderstatus", F.lit("N")), ids, path, "o_custkey", ["o_orderstatus"])
    return flat(tables.read(spark, path), "o_orderkey", "o_custkey", "o_orderstatus")


def sink_append_batches(spark, sf_dir):
    """Two micro-batches, the second written twice: its rows count once."""
    path, orders = scratch_path(spark, "batches"), _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    for batch_id, remainder in ((0, 0), (1, 1), (1, 1)):
        tables.append_batch(orders.where(f"o_orderkey % 3 = {remainder}"), path, batch_id)
    return flat(spark.read.parquet(path), "o_orderkey", "o_orderstatus", "ingest_batch_id")


def sink_append_all(spark, sf_dir):
    """All orders as four micro-batches, the third written twice: its rows count once."""
    path, orders = scratch_path(spark, "batches"), _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", F.pmod("o_custkey", F.lit(4)).alias("part"))
    for batch_id in (0, 1, 2, 2, 3):
        tables.append_batch(orders.where(F.col("part") == batch_id).drop("part"), path, batch_id)
    return flat(spark.read.parquet(path), "o_orderkey", "o_orderstatus", "ingest_batch_id")


def sink_batch_replay(spark, sf_dir):
    """All orders as four micro-batches in partitions by status; a closed batch comes again with another status and is skipped, the last one is replaced whole."""
    path, orders = scratch_path(spark, "batches"), _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", F.pmod("o_custkey", F.lit(4)).alias("part"))
    mine = lambda n: orders.where(F.col("part") == n).drop("part")
    for n in range(4):
        tables.append_batch(mine(n), path, n, ["o_orderstatus"], "feed")
    tables.append_batch(mine(2).withColumn("o_orderstatus", F.lit("R")), path, 2, ["o_orderstatus"], "feed")
    tables.append_batch(mine(3).withColumn("o_orderstatus", F.lit("N")), path, 3, ["o_orderstatus"], "feed", replay="replace")
    return flat(tables.read(spark, path), "o_orderkey", "o_orderstatus", "ingest_batch_id")


def sink_two_apps(spark, sf_dir):
    """Two queries write their batches 0 and 1 to one table, each batch twice; none erases the other's."""
    path, orders = scratch_path(spark, "batches"), _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", F.pmod("o_custkey", F.lit(4)).alias("part"))
    for n in range(4):
        for _ in range(2):
            tables.append_batch(orders.where(F.col("part") == n).drop("part"), path, n // 2, app=f"app-{n % 2}")
    return flat(tables.read(spark, path), "o_orderkey", "o_orderstatus", "ingest_batch_id")


def stream_commits(spark, sf_dir):
    """A table of micro-batches as a stream, drained while batches are added, repeated and merged; every row as often as it was given."""
    path, orders = scratch_path(spark, "commits"), _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus", F.pmod("o_custkey", F.lit(12)).alias("part"))
    tables.ensure(spark, f"{path}/table", orders.drop("part").schema)
    schema = tables.state(spark, f"{path}/table").schema

    def drain() -> None:
        writer = commits.stream(spark, f"{path}/table", schema).writeStream.format("parquet").option("path", f"{path}/given")
        writer.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()

    for n in range(12):
        for _ in range(1 + n % 2):
            tables.append_batch(orders.where(F.col("part") == n).drop("part"), f"{path}/table", n, app="feed")
        if n % 4 == 3:
            drain()
    return flat(spark.read.schema(schema).parquet(f"{path}/given"), "o_orderkey", "o_orderstatus", "ingest_batch_id")


def merge_all(spark, sf_dir):
    """All customers: two in three are held, and two in three come with an upsert, so each is on a side or on both."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    news = c.where("c_custkey % 3 <> 1").withColumn("c_mktsegment", F.lower("c_mktsegment"))
    return flat(keyed.merge_upsert(c.where("c_custkey % 3 <> 2"), news, ["c_custkey"]))


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as windows of time, from an instant to almost six hours, which overlap."""
    low = F.timestamp_add("SECOND", (F.col("c_custkey") * 7919) % 2592000, F.lit("2024-01-01").cast("timestamp"))
    size = F.col("c_custkey") % 13
    windows = table(spark, sf_dir, "customer").select("c_custkey", F.pmod("c_nationkey", F.lit(5)).alias("kind"), low.alias("low"), (size * size * size * size).alias("size"))
    return windows.select("c_custkey", "kind", "low", F.timestamp_add("SECOND", F.col("size"), F.col("low")).alias("high"))


def _instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.pmod("user_id", F.lit(5)).alias("kind"), F.col("ts").cast("timestamp").alias("ts"))


def in_ranges_table(spark, sf_dir):
    """Events with the number of windows of their kind that they fall into."""
    return flat(ranges.covered(_instants(spark, sf_dir), _windows(spark, sf_dir), "ts", "low", "high", ["event_id"], ["kind"]), "event_id", "in_ranges")


def range_join(spark, sf_dir):
    """Windows with the events that fall into them: how many, and the first and last."""
    found = ranges.range_extremes(_instants(spark, sf_dir), _windows(spark, sf_dir), "ts", "low", "high", ["c_custkey"], "event_id", ["kind"])
    found = found.select("c_custkey", F.col("n").alias("events"), F.col("least").alias("least_id"), F.col("largest").alias("largest_id"))
    return flat(found)


def dq_audit(spark, sf_dir):
    """Checks on lines with their counts and five least rows: conditions in one scan, repeated keys in one pass."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.col("l_quantity").cast("int").alias("quantity"))
    suite = [
        quality.Check("at_most_49", "lines", quality.rows_where("quantity > 49"), "warn", "fewer than fifty of a part"),
        quality.Check("some", "lines", quality.rows_where("quantity < 1")),
        quality.Check("one_line_a_supplier", "lines", quality.duplicated("lines", "l_orderkey", "l_suppkey")),
    ]
    results = quality.results_frame(spark, quality.audit(suite, {"lines": lines}))
    return flat(results, "check", "table", "severity", "description", "passed", "violations", "sample")


def _halves(spark, sf_dir):
    """All orders: two in three are held, and two in three come, so each is on a side or on both."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderstatus")
    return orders.where("o_orderkey % 3 <> 2"), orders.where("o_orderkey % 3 <> 1").withColumn("o_orderstatus", F.lit("S"))


def merge_insert_only_all(spark, sf_dir):
    return flat(keyed.merge_insert_only(*_halves(spark, sf_dir), ["o_orderkey"]))


def merge_coalesce_all(spark, sf_dir):
    """All customers: names of every other one and segments of the others are unknown to the table, the news know some of both."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").alias("version"))
    even = F.col("c_custkey") % 2 == 0
    target = c.where("c_custkey % 3 <> 2").withColumn("c_name", F.when(even, F.col("c_name"))).withColumn("c_mktsegment", F.when(~even, F.col("c_mktsegment")))
    source = c.where("c_custkey % 3 <> 1").withColumn("c_name", F.when(F.col("c_custkey") % 5 != 0, F.lower("c_name"))).withColumn("version", F.lit(12))
    return flat(keyed.merge_coalesce(target, source, "c_custkey", "version"))


def people_register(spark, sf_dir):
    """A register of all parts and suppliers against who is seen in lines, as players and as those out: the register's rows that are seen."""
    lines = table(spark, sf_dir, "lineitem")
    register = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), "p_partkey").alias("player_id"), F.col("p_name").alias("name")).unionByName(
        table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("player_id"), F.col("s_name").alias("name")))
    players = lines.where("l_returnflag = 'R'").select(F.concat(F.lit("p"), "l_partkey").alias("player_id"))
    out = lines.where("l_quantity > 45").select(F.concat(F.lit("s"), "l_suppkey").alias("player_out_id"))
    return flat(silver.people(register, players, out), "player_id", "name")


def adhoc_sql(spark, sf_dir):
    tables.views(spark, {n: table(spark, sf_dir, n) for n in ("orders", "customer")})
    return flat(spark.sql("""SELECT c_mktsegment, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders) GROUP BY c_mktsegment"""))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        latest_per_key, dedupe_first, pending_versions, replace_for_ids, merge_insert_only, merge_upsert, merge_coalesce, first_appearance_order, partition_count, landing_classify,
        landing_lineage, landing_problems, dq_unique_key, dq_orphans, dq_parent_reconcile_orders, live_board, latest_run_rows, activity_windows, feed_activity, dlq_by_reason,
        stream_reject_reasons, stream_scorecard, stream_activity, sink_replace_ids, sink_append_batches, sink_append_all, sink_batch_replay, sink_two_apps, stream_commits, in_ranges_table, range_join, dq_audit, merge_all,
        merge_insert_only_all, merge_coalesce_all, people_register, adhoc_sql,
    )
}

_TIME = "strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start"
_CLASSIFIED = """SELECT doc_id, sha256(text) AS sha256, CASE WHEN doc_id % 2 <> 0 THEN 'new' WHEN doc_id % 6 = 0 THEN 'changed' ELSE 'unchanged' END AS change_type FROM documents"""
_REASONS = """CASE event_id % 20 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'unsupported_schema_version' WHEN 2 THEN 'missing_required_field' WHEN 3 THEN 'unknown_event_type'
    WHEN 4 THEN 'key_mismatch' WHEN 5 THEN 'invalid_delivery_payload' WHEN 6 THEN 'runs_inconsistent' ELSE 'valid' END"""

_WINDOWS = """SELECT *, low + to_seconds((c_custkey % 13) ** 4) AS high FROM (SELECT c_custkey, c_nationkey % 5 AS kind,
    TIMESTAMP '2024-01-01' + to_seconds(c_custkey * 7919 % 2592000) AS low FROM customer)"""
_PAIRS = f"SELECT event_id, c_custkey FROM events JOIN ({_WINDOWS}) w ON user_id % 5 = kind AND ts BETWEEN low AND high"

ORACLE_SQL = {
    "latest_per_key": "SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "dedupe_first": "SELECT event_id, user_id, event_type, 0 AS copy FROM events",
    "pending_versions": "SELECT o_orderkey, sha256(o_orderkey || '|' || o_orderstatus) AS sha256 FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 0",
    "replace_for_ids": """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey % 10 <> 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT o_orderkey, o_custkey, 'N' FROM orders WHERE o_custkey % 20 = 0""",
    "merge_insert_only": "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'S' END AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0",
    "merge_upsert": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'S' ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0",
    "merge_coalesce": """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_name WHEN c_custkey % 9 <> 0 THEN lower(c_name) WHEN c_custkey % 2 = 0 THEN c_name END AS c_name,
        CASE WHEN c_custkey % 3 = 0 OR c_custkey % 8 <> 0 THEN c_mktsegment END AS c_mktsegment,
        CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey WHEN c_custkey % 2 = 0 THEN greatest(12, c_nationkey) ELSE 12 END AS version FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0""",
    "first_appearance_order": f"""SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY p) AS place FROM (SELECT l_orderkey, l_suppkey, min(p) AS p FROM (
        SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY {", ".join(LINE_ORDER[1:])}) AS p FROM lineitem) GROUP BY ALL)""",
    "partition_count": "SELECT s_suppkey, s_nationkey, count(*) OVER (PARTITION BY s_nationkey) AS suppliers FROM supplier",
    "landing_classify": _CLASSIFIED,
    "landing_lineage": f"SELECT change_type, count(*) AS versions FROM ({_CLASSIFIED}) GROUP BY ALL",
    "landing_problems": """SELECT DISTINCT (l_orderkey // 40)::VARCHAR AS match_id, CASE (l_orderkey // 40) % 5 WHEN 0 THEN 'invalid JSON' WHEN 1 THEN 'document is not an object'
        WHEN 2 THEN 'missing: innings info.outcome' WHEN 3 THEN 'teams are not two' END AS problem FROM lineitem""",
    "dq_unique_key": "SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "dq_orphans": "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0)",
    "dq_parent_reconcile_orders": """SELECT c_custkey FROM customer LEFT JOIN (SELECT o_custkey, sum(floor(o_totalprice)) AS x FROM orders GROUP BY ALL) ON o_custkey = c_custkey
        WHERE coalesce(x, 0) > floor(c_acctbal)""",
    "live_board": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 40",
    "latest_run_rows": "SELECT event_id, user_id FROM events WHERE user_id = (SELECT user_id FROM events ORDER BY ts DESC, user_id DESC LIMIT 1)",
    "activity_windows": f"SELECT {_TIME}, event_type, count(*) AS events, count(DISTINCT user_id) AS users FROM events GROUP BY ALL",
    "feed_activity": f"SELECT {_TIME}, count(*) AS events FROM events GROUP BY ALL",
    "dlq_by_reason": f"SELECT error_reason, count(*) AS events FROM (SELECT {_REASONS} AS error_reason FROM events) WHERE error_reason <> 'valid' GROUP BY error_reason",
    "stream_reject_reasons": f"SELECT error_reason, count(*) AS events FROM (SELECT {_REASONS} AS error_reason FROM events) GROUP BY error_reason",
    "stream_activity": f"""SELECT {_TIME}, event_type AS match_id, count(*) AS events, count(*) AS deliveries, sum(event_id % 7)::BIGINT AS runs FROM events
        WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR GROUP BY ALL""",
    "sink_replace_ids": """SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey % 10 <> 0 OR o_custkey NOT IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT o_orderkey, o_custkey, 'N' FROM orders WHERE o_custkey % 20 = 0""",
    "sink_append_batches": "SELECT o_orderkey, o_orderstatus, o_orderkey % 3 AS ingest_batch_id FROM orders WHERE o_orderkey % 3 < 2",
    "sink_append_all": "SELECT o_orderkey, o_orderstatus, o_custkey % 4 AS ingest_batch_id FROM orders",
    "sink_batch_replay": "SELECT o_orderkey, CASE WHEN o_custkey % 4 = 3 THEN 'N' ELSE o_orderstatus END AS o_orderstatus, o_custkey % 4 AS ingest_batch_id FROM orders",
    "sink_two_apps": "SELECT o_orderkey, o_orderstatus, (o_custkey % 4) // 2 AS ingest_batch_id FROM orders",
    "stream_commits": "SELECT o_orderkey, o_orderstatus, o_custkey % 12 AS ingest_batch_id FROM orders",
    "in_ranges_table": f"SELECT e.event_id, count(c_custkey) AS in_ranges FROM events e LEFT JOIN ({_PAIRS}) p ON e.event_id = p.event_id GROUP BY ALL",
    "range_join": f"SELECT c_custkey, count(*) AS events, min(event_id) AS least_id, max(event_id) AS largest_id FROM ({_PAIRS}) GROUP BY ALL",
    "dq_audit": """WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, trunc(l_quantity)::INT AS quantity FROM lineitem),
        bad AS (SELECT 'at_most_49' AS "check", '{"l_orderkey": ' || l_orderkey || ', "l_linenumber": ' || l_linenumber || ', "l_suppkey": ' || l_suppkey || ', "quantity": ' || quantity || '}' AS t FROM l WHERE quantity > 49
            UNION ALL SELECT 'one_line_a_supplier', '{"l_orderkey": ' || l_orderkey || ', "l_suppkey": ' || l_suppkey || ', "count": ' || count(*) || '}' FROM l GROUP BY l_orderkey, l_suppkey HAVING count(*) > 1),
        few AS (SELECT *, count(*) OVER (PARTITION BY "check") AS n FROM bad QUALIFY row_number() OVER (PARTITION BY "check" ORDER BY t) <= 5),
        found AS (SELECT "check", any_value(n) AS n, '[' || string_agg(t, ', ' ORDER BY t) || ']' AS sample FROM few GROUP BY "check")
        SELECT c."check", 'lines' AS "table", severity, description, n IS NULL AS passed, coalesce(n, 0) AS violations, coalesce(sample, '[]') AS sample
        FROM (VALUES ('at_most_49', 'warn', 'fewer than fifty of a part'), ('some', 'error', ''), ('one_line_a_supplier', 'error', '')) c("check", severity, description) LEFT JOIN found f ON f."check" = c."check" """,
    "merge_insert_only_all": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 'S' ELSE o_orderstatus END AS o_orderstatus FROM orders",
    "merge_coalesce_all": """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 1 AND c_custkey % 5 <> 0 THEN lower(c_name) WHEN c_custkey % 3 <> 2 AND c_custkey % 2 = 0 THEN c_name END AS c_name,
        CASE WHEN c_custkey % 3 <> 1 OR c_custkey % 2 <> 0 THEN c_mktsegment END AS c_mktsegment,
        CASE c_custkey % 3 WHEN 1 THEN c_nationkey WHEN 2 THEN 12 ELSE greatest(12, c_nationkey) END AS version FROM customer""",
    "people_register": """SELECT * FROM (SELECT 'p' || p_partkey AS player_id, p_name AS name FROM part UNION ALL SELECT 's' || s_suppkey, s_name FROM supplier)
        WHERE player_id IN (SELECT 'p' || l_partkey FROM lineitem WHERE l_returnflag = 'R' UNION SELECT 's' || l_suppkey FROM lineitem WHERE l_quantity > 45)""",
    "merge_all": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE lower(c_mktsegment) END AS c_mktsegment FROM customer",
    "adhoc_sql": """SELECT c_mktsegment, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders) GROUP BY c_mktsegment""",
}
