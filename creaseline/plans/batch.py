"""The batch dataflow: documents to conformed tables, then marts; whole or for changed matches only.

Each layer is written, audited and only then published.  Row conditions are counted while the rows are written, the
other checks read what was written, and a failed error-level check leaves the tables that readers see as they were.
What is used more than once is read back from its table, not cached: nothing grows on executors' disks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.plans import marts, quality, silver
from creaseline.sources import colocated, landing, tables

#: Tables that are split by season; the others are small.
BY_SEASON = {
    "deliveries", "wickets", "innings", "substitutions", "match_players", "matches", "innings_summary", "match_summary", "batting_scorecard",
    "bowling_scorecard", "player_season_batting", "player_season_bowling", "team_phase_stats", "points_table", "venue_parts", "head_to_head_parts",
}
#: Marts whose rows of a season come from that season's matches and adjustments alone; the others fold these.
SEASONAL = {n for n in BY_SEASON if n not in silver.TABLES}
#: Marts that only other marts read.
PARTS = {source for source, _ in marts.FOLDS.values()}
#: Logs below ``ops``: seasons that a run changes in the conformed tables, runs whose marts are written, and the
#: adjustments that these were written with.
TOUCHED, SETTLED, ADJUSTED = "ops/touched", "ops/settled", "ops/adjustments"
RESULTS = "ops/results"
Tables = dict[str, DataFrame]


def split(name: str) -> list[str]:
    return ["season"] if name in BY_SEASON else []


def stored(spark: SparkSession, root: str, layer: str, names) -> Tables:
    return {n: tables.read(spark, f"{root}/{layer}/{n}") for n in names}


def release(
    spark: SparkSession, root: str, layer: str, suite: list[quality.Check], staged: dict[str, tables.Staged], others: Tables, run_id: str, stop_on_error: bool
) -> None:
    """Audits staged tables, stores the results, and publishes the tables in their order, or drops them and raises."""
    rows = {n: tables.staged_rows(s) for n, s in staged.items()}
    counts = {name: int(n) for s in staged.values() for name, n in s.counts.items()}
    results = quality.audit(suite, rows | others, counts)
    marked = quality.results_frame(spark, results).select("*", F.lit(layer).alias("layer"), F.lit(run_id).alias("run_id"), F.current_timestamp().alias("checked_at"))
    marked.coalesce(1).write.mode("append").parquet(f"{root}/{RESULTS}")
    if stop_on_error and quality.failures(results):
        for s in staged.values():
            tables.abandon(s)
        quality.stop(results)
    for s in staged.values():
        tables.publish(s)


def write_silver(
    spark: SparkSession, documents: DataFrame, venues: DataFrame, teams: DataFrame, root: str, changed: DataFrame | None = None, run_id: str = "",
    stop_on_error: bool = True, parts: int | None = None, placed: bool = False,
) -> None:
    """Writes, audits and publishes the conformed tables; with ``changed`` (match_id) only rows of those matches are replaced.

    Matches come last: a run that breaks off leaves them pending, and the next run does them again.  The files of balls
    hold their wickets as well, so that wickets and innings read balls back instead of computing them again.  Documents
    move to ranges of season and match (``parts`` of them), and their balls are written there.  Documents that are read
    from buckets of their match are ``placed`` and do not move: a bucket writes a file of balls for each of its seasons.
    """

    def put(name: str, frame: DataFrame, hidden: tuple[str, ...] = (), spread: bool = True) -> tables.Staged:
        path, counts = f"{root}/silver/{name}", quality.counting(quality.CONFORMED, name)
        if changed is None:
            return tables.stage_overwrite(frame, path, split(name), counts, hidden, spread)
        return tables.stage_replace_ids(spark, frame, changed, path, "match_id", split(name), counts, hidden)

    ranged = documents if placed else silver.in_seasons(documents, parts)
    staged = {"deliveries": put("deliveries", silver.deliveries(ranged), ("_wickets",), spread=False)}
    ball = tables.written_rows(staged["deliveries"])
    if changed is not None:
        ball = ball.join(changed, "match_id", "left_semi")
    replaced = silver.substitutions(documents)
    frames = {
        "wickets": silver.wickets(ball), "innings": silver.innings(documents, ball), "substitutions": replaced,
        "match_players": silver.match_players(documents, replaced), "matches": silver.matches(documents, venues, teams),
    }
    with colocated.by_part_of_keys(spark):
        # Wickets are written where their balls are read.
        staged |= {name: put(name, frames[name], spread=name != "wickets") for name in silver.TABLES if name in frames}
    release(spark, root, "silver", quality.CONFORMED, staged, {"venues": venues, "teams": teams}, run_id, stop_on_error)


def touch(spark: SparkSession, root: str, run_id: str, documents: DataFrame, changed: DataFrame | None) -> None:
    """Notes, before anything is replaced, the seasons whose marts a run makes out of date; without ``changed``, all of them.

    Without a log of earlier runs nothing is known of the marts, so that all count as out of date.
    """
    if changed is None or not tables.exists(spark, f"{root}/{TOUCHED}"):
        seasons = spark.range(1).select(F.lit(None).cast("int").alias("season"), F.lit(True).alias("whole"))
    else:
        held = tables.read(spark, f"{root}/silver/matches").join(changed, "match_id", "left_semi").select("season")
        seasons = held.unionByName(documents.select(silver.season().alias("season"))).distinct().select("season", F.lit(False).alias("whole"))
    seasons.withColumn("run_id", F.lit(run_id)).coalesce(1).write.mode("append").parquet(f"{root}/{TOUCHED}")


def adjusted(spark: SparkSession, root: str, adjustments: DataFrame) -> bool:
    """Whether the adjustments differ from those that the marts were written with."""
    if tables.current(spark, f"{root}/{ADJUSTED}") is None:
        return True
    held = tables.read(spark, f"{root}/{ADJUSTED}").select(*adjustments.columns)
    return bool(held.exceptAll(adjustments).union(adjustments.exceptAll(held)).limit(1).count())


def out_of_date(spark: SparkSession, root: str, adjustments: DataFrame) -> tuple[list[dict] | None, list[str]]:
    """Seasons whose marts are out of date, as partitions (None: all), and the runs that left them so.

    A run that broke off before its marts were written left its seasons here for the next one.  New adjustments may
    name any match, so they put all seasons out of date.
    """
    open_ = spark.read.parquet(f"{root}/{TOUCHED}")
    if tables.exists(spark, f"{root}/{SETTLED}"):
        open_ = open_.join(spark.read.parquet(f"{root}/{SETTLED}"), "run_id", "left_anti")
    rows = open_.distinct().collect()  # a season of an unfinished run each
    runs = sorted({r["run_id"] for r in rows})
    whole = any(r["whole"] for r in rows) or any(tables.current(spark, f"{root}/gold/{n}") is None for n in SEASONAL)
    if whole or adjusted(spark, root, adjustments):
        return None, runs
    return [{"season": s} for s in {r["season"] for r in rows}], runs


def write_marts(spark: SparkSession, conformed: Tables, adjustments: DataFrame, root: str, run_id: str = "", stop_on_error: bool = True) -> list[str]:
    """Writes, audits and publishes the marts; the names of those for readers.

    Only seasons that are out of date are read and replaced; marts over all seasons are folded from what the seasons
    add, which is stored.  Season marts read the scorecards back from where they were written.
    """
    seasons, runs = out_of_date(spark, root, adjustments)
    narrowed = conformed
    if seasons is not None:
        # The conformed tables are split by season; folders of other seasons are not even listed.
        narrowed = {n: tables.read(spark, f"{root}/silver/{n}", only=seasons) for n in silver.TABLES}

    def put(name: str, frame: DataFrame, spread: bool = True) -> tables.Staged:
        path, counts = f"{root}/gold/{name}", quality.counting(quality.MARTS, name)
        if seasons is None or name not in SEASONAL:
            return tables.stage_overwrite(frame, path, split(name), counts, spread=spread)
        return tables.stage_replace_partitions(spark, frame, seasons, path, split(name), counts)

    with colocated.by_part_of_keys(spark):
        # Written where their sums were gathered: a part writes a file for each season.
        staged = {name: put(name, frame, spread=False) for name, frame in marts.scorecards(narrowed, gathered=True).items()}
    cards = {name: tables.written_rows(s) for name, s in staged.items()}
    staged |= {name: put(name, frame) for name, frame in marts.by_season(narrowed, cards, adjustments).items()}
    staged |= {name: put(name, fold(tables.staged_rows(staged[source]))) for name, (source, fold) in marts.FOLDS.items()}
    release(spark, root, "gold", quality.MARTS, staged, {}, run_id, stop_on_error)
    if seasons is None:
        tables.overwrite(adjustments, f"{root}/{ADJUSTED}")
    if runs:
        done = spark.createDataFrame([(r,) for r in runs], "run_id string")
        done.coalesce(1).write.mode("append").parquet(f"{root}/{SETTLED}")
    return [name for name in staged if name not in PARTS]


def build(
    spark: SparkSession, documents: DataFrame, venues: DataFrame, teams: DataFrame, adjustments: DataFrame, root: str,
    changed: DataFrame | None = None, stop_on_error: bool = True, parts: int | None = None, placed: bool = False,
) -> Tables:
    """Everything below ``root``; returns the stored tables of both layers.  Marts are built from stored tables.

    ``parts`` is the number of ranges that balls are written in; without it, that of the session's shuffles.  Balls of
    documents that are ``placed`` in buckets of their match are written by bucket instead.
    """
    run_id = uuid.uuid4().hex
    touch(spark, root, run_id, documents, changed)
    write_silver(spark, documents, venues, teams, root, changed, run_id, stop_on_error, parts, placed)
    conformed = stored(spark, root, "silver", silver.TABLES)
    return conformed | stored(spark, root, "gold", write_marts(spark, conformed, adjustments, root, run_id, stop_on_error))


def refresh(
    spark: SparkSession, manifest: DataFrame, bronze: str, venues: DataFrame, teams: DataFrame, adjustments: DataFrame, root: str, stop_on_error: bool = True
) -> Tables:
    """Brings the tables up to the manifest: only matches whose latest version is not stored are read and replaced."""
    known = tables.current(spark, f"{root}/silver/matches") is not None
    if known:
        held = tables.read(spark, f"{root}/silver/matches").select("match_id", "source_sha256")
    else:
        held = spark.createDataFrame([], "match_id string, source_sha256 string")
    # Written down first: the tables that decide what is pending are replaced below.
    path = f"{root}/ops/pending-{uuid.uuid4().hex}"
    landing.pending(manifest, held).select("match_id", "sha256", "ingested_at").write.parquet(path)
    waiting = spark.read.parquet(path)
    documents = landing.landed_documents(spark, bronze, waiting)
    return build(spark, documents, venues, teams, adjustments, root, waiting.select("match_id") if known else None, stop_on_error)
