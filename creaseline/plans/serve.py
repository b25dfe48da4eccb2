"""Serving queries over the marts: leaders, results, champions, boards; all are plain frames, limits are the feature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creaseline.functions import rules

TOP = 10
BOARD = 40


def of_season(df: DataFrame, season: int | None) -> DataFrame:
    return df if season is None else df.where(F.col("season") == season)


def standings(points_table: DataFrame, season: int) -> DataFrame:
    kept = ["position", "team", "played", "won", "lost", "tied", "no_result", "points", "net_run_rate"]
    return of_season(points_table, season).select(*kept, (F.col("position") <= 4).alias("highlight")).orderBy("position")


def top_run_scorers(batting: DataFrame, season: int | None = None, n: int = TOP) -> DataFrame:
    return of_season(batting, season).orderBy(F.desc("runs"), F.desc("strike_rate"), "player_name", "player_id").limit(n)


def top_wicket_takers(bowling: DataFrame, season: int | None = None, n: int = TOP) -> DataFrame:
    return of_season(bowling, season).where("wickets > 0").orderBy(F.desc("wickets"), F.asc("economy"), "player_name", "player_id").limit(n)


def recent_results(summary: DataFrame, season: int | None = None, n: int = TOP) -> DataFrame:
    return of_season(summary, season).orderBy(F.desc("match_date"), F.desc(F.col("match_id").cast("long"))).limit(n)


def champions(summary: DataFrame) -> DataFrame:
    """The latest final of each season, in one pass."""
    latest = Window.partitionBy("season").orderBy(F.desc("match_date"), F.desc(F.col("match_id").cast("long")))
    finals = summary.where("stage = 'Final'").withColumn("_nth", F.row_number().over(latest)).where("_nth = 1")
    return finals.select("season", "match_date", "venue", "winner", "result_text", "player_of_match")


def _career(seasons: DataFrame, sums: list[str]) -> DataFrame:
    return seasons.groupBy("player_id").agg(
        F.max("player_name").alias("player_name"), F.count(F.lit(1)).alias("seasons"), *[F.sum(c).alias(c) for c in sums]
    )


def all_time_batting(batting: DataFrame, n: int = TOP) -> DataFrame:
    rows = _career(batting, ["innings", "runs", "balls", "outs", "fifties", "hundreds"])
    rated = rows.select("*", rules.rate("runs", "outs").alias("average"), rules.rate("runs", "balls", 100).alias("strike_rate"))
    return rated.orderBy(F.desc("runs"), "player_name", "player_id").limit(n)


def all_time_bowling(bowling: DataFrame, n: int = TOP) -> DataFrame:
    rows = _career(bowling, ["wickets", "runs_conceded", "balls"])
    rated = rows.select("*", rules.rate("runs_conceded", "balls", 6).alias("economy"), rules.rate("runs_conceded", "wickets").alias("average"))
    return rated.orderBy(F.desc("wickets"), F.asc("runs_conceded"), "player_name", "player_id").limit(n)


def dataset_summary(df: DataFrame, day: Column, season: Column) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("matches"), F.max(day).alias("as_of"), F.min(season).alias("first_season"), F.max(season).alias("last_season"),
        F.countDistinct(season).alias("seasons"),
    )


def live_board(card: DataFrame, order: list[Column], n: int = BOARD) -> DataFrame:
    return card.orderBy(*order).limit(n)


def latest_run(results: DataFrame, run: str, at: str) -> DataFrame:
    """Rows of the run that was checked last; of runs at one time the greatest id."""
    last = results.agg(F.max(F.struct(F.col(at), F.col(run))).alias("_last")).select(F.col(f"_last.{run}").alias(run))
    return results.join(F.broadcast(last), run, "left_semi")


def counts_by(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))
