"""Queries over match documents that are shaped from lineitem, orders, customer, nation and region."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline import shaped
from creaseline.functions import rules
from creaseline.operators.keyed import in_parts, parts_for, reconcile, sorted_groups
from creaseline.plans import batch, marts, quality, serve, silver
from creaseline.queries.flat import flat
from creaseline.sources import colocated
from creaseline.sources.scratch import scratch_path
from creaseline.streaming import events as ev

K = silver.INNINGS_KEY
BALL = [*K, "over_index", "delivery_seq"]


class Data:
    """The frames of a query, built on first use.

    ``documents`` are written once to the shared folder, as landed documents would be, for queries that read them
    more than once; ``once`` is the same without that step, for queries of a single pass.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def once(self) -> DataFrame:
        return shaped.documents(self.spark, self.sf_dir)

    @cached_property
    def documents(self) -> DataFrame:
        path = scratch_path(self.spark, "documents")
        with sorted_groups(self.spark):
            self.once.write.parquet(path)
        return self.spark.read.schema(self.once.schema).parquet(path)

    @cached_property
    def placed(self) -> DataFrame:
        """Documents written once as buckets of their match, where their lines came together; balls of them need not move."""
        path, buckets = scratch_path(self.spark, "documents"), shaped.buckets(self.spark, self.sf_dir, 8)
        with sorted_groups(self.spark):
            colocated.store(shaped.documents(self.spark, self.sf_dir, buckets), path, "match_id", buckets, placed=True)
        return colocated.load(self.spark, path)

    @cached_property
    def balls_once(self) -> DataFrame:
        return silver.deliveries(self.once)

    @cached_property
    def venues(self) -> DataFrame:
        return shaped.venues(self.spark, self.sf_dir)

    @cached_property
    def teams(self) -> DataFrame:
        return shaped.teams(self.spark, self.sf_dir)

    @cached_property
    def adjustments(self) -> DataFrame:
        return shaped.adjustments(self.spark, self.sf_dir)

    @cached_property
    def balls(self) -> DataFrame:
        # Documents move to parts of matches, which is less than their balls.
        return silver.deliveries(in_parts(self.documents, "match_id", shaped.DOCUMENT_BYTES))

    @cached_property
    def wickets(self) -> DataFrame:
        return silver.wickets(self.balls)

    @cached_property
    def innings(self) -> DataFrame:
        # Sums of balls as they stand in their documents: no running totals, and only the sums move.
        return silver.innings(self.documents, silver.ball_facts(self.documents))

    @cached_property
    def substitutions(self) -> DataFrame:
        return silver.substitutions(self.documents)

    @cached_property
    def players(self) -> DataFrame:
        return silver.match_players(self.documents, self.substitutions)

    @cached_property
    def matches(self) -> DataFrame:
        return silver.matches(self.documents, self.venues, self.teams)

    @cached_property
    def matches_once(self) -> DataFrame:
        return silver.matches(self.once, self.venues, self.teams)

    @cached_property
    def batting(self) -> DataFrame:
        return marts.batting_scorecard(self.balls, self.wickets, self.players)

    @cached_property
    def bowling(self) -> DataFrame:
        return marts.bowling_scorecard(self.balls, self.players)

    @cached_property
    def points(self) -> DataFrame:
        return marts.points_table(self.matches, self.innings, self.adjustments)

    @cached_property
    def summary(self) -> DataFrame:
        return marts.match_summary(self.matches, self.innings)

    @cached_property
    def season_batting(self) -> DataFrame:
        return marts.season_batting(self.batting, self.players)

    @cached_property
    def season_bowling(self) -> DataFrame:
        return marts.season_bowling(self.bowling, self.players)

    @cached_property
    def events(self) -> DataFrame:
        return ev.envelopes(self.documents, self.balls)


def _innings_explode(d: Data) -> DataFrame:
    return flat(silver.innings_rows(d.once), *K, "season", "batting_team", "bowling_team", "is_super_over", "scheduled_overs")


def _deliveries_explode(d: Data) -> DataFrame:
    return flat(silver.balls(d.once).select(*BALL, F.col("d.batter").alias("batter"), F.col("d.bowler").alias("bowler"), F.col("d.runs.total").alias("total")))


def _ball_facts(d: Data) -> DataFrame:
    return flat(
        silver.ball_facts(d.once), "delivery_id", "runs_batter", "runs_extras", "runs_total", "is_wide", "is_noball", "is_legal", "batter_faced",
        "is_four", "is_six", "is_dot", "bowler_runs", "team_wickets", "bowler_wickets", "is_wicket", "players_out", "wicket_kinds",
    )


def _map_fold(d: Data) -> DataFrame:
    return flat(d.innings.where("official_balls <> legal_balls"), *K, "legal_balls", "official_balls")


def _overs_notation(d: Data) -> DataFrame:
    both = d.balls_once.select(*BALL, "legal_ball_number", rules.balls_to_overs("legal_ball_number").alias("overs"))
    return flat(both.withColumn("balls_again", rules.overs_to_balls(F.col("overs").cast("double"))))


def _nrr(d: Data) -> DataFrame:
    return flat(marts.credits(d.matches, d.innings).where("i1 is not null and i2 is not null").select("match_id", "credit.*"))


def _parsed(d: Data) -> DataFrame:
    return ev.valid(ev.parse(ev.to_feed(d.events)))


def _live_cards(d: Data) -> DataFrame:
    """Events are written down once parsed, since balls and states of matches both read them."""
    parsed, path = _parsed(d).drop("raw_value"), scratch_path(d.spark, "parsed")
    parsed.write.parquet(path)
    held = d.spark.read.schema(parsed.schema).parquet(path)
    return ev.live_scorecard(ev.delivery_facts(held), ev.match_state(held))


def _live(d: Data) -> DataFrame:
    return flat(
        _live_cards(d), *K, "season", "batting_team", "runs", "wickets", "legal_balls", "extras", "fours", "sixes", "target_runs", "target_balls", "deliveries",
        "score_text", "run_rate", "runs_required", "balls_remaining", "required_run_rate", "last_event_id", "last_ball", "striker", "match_status", "match_winner",
    )


def _match_state(d: Data) -> DataFrame:
    return flat(ev.match_state(_parsed(d)), "match_id", "last_event_time", "season", "stage", "teams", "toss_winner", "started_at", "winner", "result", "completed_at")


def _reconcile(d: Data) -> DataFrame:
    """Batch innings against live cards; penalty runs are in the batch total only, and so show as differences."""
    compared = ["batting_team", "runs", "wickets", "legal_balls"]
    return flat(reconcile(d.innings, _live_cards(d), K, compared))


def _check_tables(d: Data) -> dict[str, DataFrame]:
    return {
        "deliveries": d.balls.drop("_wickets"), "innings": d.innings, "matches": d.matches, "match_players": d.players, "venues": d.venues, "teams": d.teams,
        "points_table": d.points, "batting_scorecard": d.batting, "bowling_scorecard": d.bowling, "innings_summary": marts.innings_summary(d.matches, d.innings),
    }


def _batch(d: Data) -> tuple[str, dict[str, DataFrame]]:
    root = scratch_path(d.spark, "batch")
    return root, batch.build(d.spark, d.placed, d.venues, d.teams, d.adjustments, root, stop_on_error=False, placed=True)


def _batch_build(d: Data) -> DataFrame:
    """The whole batch dataflow into tables; rows of each."""
    out = None
    for name, frame in _batch(d)[1].items():
        row = frame.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), "rows")
        out = row if out is None else out.unionByName(row)
    return flat(out)


def _dq(d: Data) -> DataFrame:
    """Check results that the gates of a batch build stored."""
    root, _ = _batch(d)
    return flat(d.spark.read.parquet(f"{root}/ops/results"), "check", "table", "severity", "violations")


def _check(name: str) -> Callable[[Data], DataFrame]:
    def run(d: Data) -> DataFrame:
        check = next(c for c in quality.CONFORMED + quality.MARTS if c.name == name)
        return check.violations({n: t.alias(n) for n, t in _check_tables(d).items()})

    return run


def _colocated(d: Data) -> dict[str, DataFrame]:
    """Balls, wickets and line-ups stored in buckets of their match, as read back."""
    root, found = scratch_path(d.spark, "colocated"), {}
    buckets = parts_for(d.documents, shaped.DOCUMENT_BYTES, 8)
    for name, frame in {"deliveries": d.balls.drop("_wickets"), "wickets": d.wickets, "match_players": d.players}.items():
        colocated.store(frame, f"{root}/{name}", "match_id", buckets)
        found[name] = colocated.load(d.spark, f"{root}/{name}")
    return found


def _colocated_scorecards(d: Data) -> DataFrame:
    """Batting scorecards from stored tables in buckets of their match: joins and aggregates move nothing, so the sums are written where they are."""
    cards = marts.scorecards(_colocated(d))["batting_scorecard"]
    path = scratch_path(d.spark, "scorecards")
    with colocated.by_part_of_keys(d.spark):
        cards.write.parquet(path)
    return flat(d.spark.read.schema(cards.schema).parquet(path), *K, "batter", "batting_position", "runs", "balls", "fours", "sixes", "dots", "dismissal_kind", "is_out", "player_id")


def _people(d: Data) -> DataFrame:
    seen = silver.people(d.players.select("player_id").where("player_id is not null").distinct(), d.players.where("lineup_order < 3"), d.wickets)
    return flat(seen)


LEADERS = ["player_id", "player_name", "runs", "strike_rate", "highest_score_text", "fifties", "hundreds"]
SEASON = 1998
SUMS = ["season", "player_id", "player_name", "teams", "innings", "matches"]

_BUILT: dict[str, Callable[[Data], DataFrame]] = {
    "match_header": lambda d: flat(d.matches_once, "match_id", "season", "match_date", "match_days", "match_number", "stage", "is_playoff", "team1", "team2", "toss_winner",
                                   "toss_decision", "result_type", "winner", "loser", "super_over_winner", "win_by_runs", "win_by_wickets", "result_method", "player_of_match", "umpires"),
    "canonicalise": lambda d: flat(d.matches_once, "match_id", "venue", "city", "team1_franchise", "team2_franchise", "winner_franchise"),
    "innings_explode": _innings_explode,
    "deliveries_explode": _deliveries_explode,
    "ball_facts": _ball_facts,
    "overs_notation": _overs_notation,
    "phase_bucket": lambda d: flat(silver.ball_facts(d.once).groupBy("season", "phase").agg(F.count(F.lit(1)).alias("balls"), F.sum("runs_total").alias("runs"))),
    "in_any_range": lambda d: flat(d.balls_once, *BALL, "in_powerplay"),
    "map_membership": lambda d: flat(silver.ball_facts(d.once).where("umpire_miscount"), *BALL, "umpire_miscount"),
    "map_fold": _map_fold,
    "wickets_explode": lambda d: flat(silver.wickets(d.balls_once), *BALL, "wicket_seq", "player_out", "kind", "fielders", "fielder_is_substitute", "credited_bowler", "player_out_id"),
    "lineups": lambda d: flat(d.players, "match_id", "team", "lineup_order", "player_name", "player_id", "is_impact_substitute"),
    "substitutions": lambda d: flat(silver.substitutions(d.once), *BALL, "team", "player_in", "player_out", "reason"),
    "people_semi": _people,
    "running_totals": lambda d: flat(d.balls_once, *BALL, "legal_ball_in_over", "legal_ball_number", "team_runs_after", "team_wickets_after"),
    "ball_label": lambda d: flat(d.balls_once, *BALL, "ball_label"),
    "running_conditional": lambda d: flat(silver.wickets(d.balls_once), *BALL, "wicket_seq", "counts_as_team_wicket", "team_wicket_number", "team_runs_at_fall"),
    "over_ball_counts": lambda d: flat(quality.over_ball_counts(silver.ball_facts(d.once))),
    "innings_totals": lambda d: flat(d.innings, *K, "deliveries", "runs", "wickets", "legal_balls", "extras", "wides", "noballs", "byes", "legbyes", "fours", "sixes", "dot_balls",
                                     "all_out", "official_balls", "overs", "run_rate", "target_runs", "target_balls", "penalty_runs_pre"),
    "safe_rates": lambda d: flat(d.innings.select(*K, rules.rate("runs", "wickets").alias("per_wicket"), rules.rate("fours", "sixes", 100, 1).alias("four_six_pct"))),
    "innings_summary": lambda d: flat(marts.innings_summary(d.matches, d.innings), *K, "season", "match_date", "stage", "venue", "score_text", "all_out"),
    "match_summary": lambda d: flat(d.summary, "match_id", "season", "first_batting_team", "first_innings_score", "second_batting_team", "second_innings_score"),
    "result_text": lambda d: flat(d.summary, "match_id", "result_type", "winner", "result_text", "player_of_match"),
    "innings_flags": lambda d: flat(d.innings, *K, "target_overs", "declared", "forfeited", "scheduled_overs", "scheduled_balls", "delivery_runs", "penalty_runs_post"),
    "innings_summary_all": lambda d: flat(marts.innings_summary(d.matches, d.innings), *K, "season", "match_date", "stage", "venue", "is_super_over", "batting_team", "bowling_team", "runs", "wickets",
                                          "legal_balls", "official_balls", "overs", "run_rate", "extras", "wides", "noballs", "byes", "legbyes", "fours", "sixes", "dot_balls", "all_out",
                                          "target_runs", "target_balls", "score_text"),
    "match_summary_all": lambda d: flat(d.summary),
    "batting_scorecard": lambda d: flat(d.batting, *K, "batter", "batting_position", "runs", "balls", "fours", "sixes", "dots", "dismissal_kind", "dismissal_bowler",
                                        "dismissal_fielders", "is_out", "fall_of_wicket_number", "fall_of_wicket_score", "fall_of_wicket_ball", "strike_rate", "player_id"),
    "colocated_scorecards": _colocated_scorecards,
    "bowling_scorecard": lambda d: flat(d.bowling, *K, "bowler", "bowling_order", "balls", "runs_conceded", "wickets", "dots", "maidens", "wides", "noballs", "overs", "economy", "player_id"),
    "appearances": lambda d: flat(marts.appearances(d.players)),
    "season_batting": lambda d: flat(d.season_batting, *SUMS, "runs", "balls", "outs", "fifties", "hundreds", "ducks", "highest_score_text", "average", "strike_rate"),
    "season_bowling": lambda d: flat(d.season_bowling, *SUMS, "balls", "runs_conceded", "wickets", "maidens", "best_figures", "four_wickets", "five_wickets", "average", "economy"),
    "nrr_credits": _nrr,
    "points_table": lambda d: flat(d.points),
    "venue_stats": lambda d: flat(marts.venue_stats(d.matches, d.innings)),
    "phase_stats": lambda d: flat(marts.phase_stats(d.balls_once)),
    "head_to_head": lambda d: flat(marts.head_to_head(d.matches_once, d.adjustments)),
    "event_envelopes": lambda d: flat(d.events, "match_id", "event_id", "event_type", "sequence", "offset_seconds", "event_time"),
    "live_scorecard": _live,
    "match_state": _match_state,
    "reconcile": _reconcile,
    "batch_build": _batch_build,
    "dq_violation_counts": _dq,
    "dq_parent_reconcile": lambda d: flat(_check("batting_runs_reconcile")(d), *K),
    "standings": lambda d: flat(serve.standings(d.points, SEASON)),
    "top_run_scorers": lambda d: flat(serve.top_run_scorers(d.season_batting, SEASON), *LEADERS),
    "top_wicket_takers": lambda d: flat(serve.top_wicket_takers(d.season_bowling, SEASON), "player_id", "player_name", "wickets", "runs_conceded", "economy", "best_figures"),
    "recent_results": lambda d: flat(serve.recent_results(d.summary, SEASON), "match_id", "match_date", "stage", "venue", "result_text"),
    "champions": lambda d: flat(serve.champions(d.summary)),
    "all_time_batting": lambda d: flat(serve.all_time_batting(d.season_batting)),
    "all_time_bowling": lambda d: flat(serve.all_time_bowling(d.season_bowling)),
    "dataset_summary": lambda d: flat(serve.dataset_summary(d.matches_once, F.col("match_date"), F.col("season"))),
}


def _query(build: Callable[[Data], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Data(spark, sf_dir))


QUERIES = {name: _query(build) for name, build in _BUILT.items()}
