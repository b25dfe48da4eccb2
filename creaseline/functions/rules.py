"""The game's rules as Columns; no UDF, so every rule stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
BALLS_PER_OVER = 6
WICKETS, SUPER_OVER_WICKETS = 10, 2
BOWLER_KINDS = ("bowled", "caught", "caught and bowled", "hit wicket", "lbw", "stumped")
NOT_OUT_KINDS = ("retired hurt", "retired not out")
LAST_POWERPLAY_OVER, LAST_MIDDLE_OVER = 6, 15


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def count_if(condition: Column) -> Column:
    """Rows where the condition holds, as int; 0 without such rows."""
    return F.count(F.when(condition, 1)).cast("int")


def total(value: Column | str) -> Column:
    return F.sum(col(value)).cast("int")


def overs_to_balls(overs: Column | str) -> Column:
    """Over notation to balls: 9.2 is 9 overs and 2 balls, 56 balls."""
    overs = col(overs)
    whole = F.floor(overs)
    return (whole * BALLS_PER_OVER + F.round((overs - whole) * 10)).cast("int")


def balls_to_overs(balls: Column | str) -> Column:
    """Balls to over notation: 118 is "19.4"."""
    balls = col(balls)
    return F.concat_ws(".", F.floor(balls / BALLS_PER_OVER).cast("string"), (balls % BALLS_PER_OVER).cast("string"))


def phase(over_number: Column | str, super_over: Column | str) -> Column:
    """Phase of an over counted from 1; a super over is its own phase."""
    over_number = col(over_number)
    return (
        F.when(col(super_over), "super_over")
        .when(over_number <= LAST_POWERPLAY_OVER, "powerplay")
        .when(over_number <= LAST_MIDDLE_OVER, "middle")
        .otherwise("death")
    )


def rate(numerator: Column | str, denominator: Column | str, scale: int = 1, digits: int = 2) -> Column:
    """``numerator * scale / denominator``, rounded; null unless the denominator is above 0."""
    denominator = col(denominator)
    return F.when(denominator > 0, F.round(col(numerator) * scale / denominator, digits))


def score_text(runs: Column | str, wickets: Column | str, overs: Column | str) -> Column:
    """``190/9 (20.0)``; null if a part is null."""
    return F.concat(col(runs).cast("string"), F.lit("/"), col(wickets).cast("string"), F.lit(" ("), col(overs), F.lit(")"))


def counted(number: Column | str, noun: str) -> Column:
    """``1 run``, ``2 runs``."""
    number = col(number)
    return F.concat(number.cast("string"), F.when(number == 1, f" {noun}").otherwise(f" {noun}s"))


def result_text() -> Column:
    """The result sentence of a match row; a recorded method marks it as decided by revised target."""
    method = F.when(F.col("result_method").isNull(), "").otherwise(" (DLS)")
    margin = F.when(F.col("win_by_runs").isNotNull(), counted("win_by_runs", "run")).otherwise(
        counted("win_by_wickets", "wicket")
    )
    return (
        F.when(
            F.coalesce("win_by_runs", "win_by_wickets").isNotNull(),
            F.concat(F.col("winner"), F.lit(" won by "), margin, method),
        )
        .when(F.col("result_type") == "tie", F.concat(F.lit("Match tied ("), "super_over_winner", F.lit(" won the super over)")))
        .when(F.col("result_type") == "no_result", "No result")
        .otherwise(F.coalesce("winner", "result_type"))
    )


def stage(recorded: Column | str) -> Column:
    """A match without a named stage belongs to the league."""
    return F.coalesce(col(recorded), F.lit("League"))


def winner_of(outright: Column | str, super_over: Column | str, bowl_out: Column | str) -> Column:
    """Who won, in play or by what decides a tie."""
    return F.coalesce(col(outright), col(super_over), col(bowl_out))


def loser(winner: Column, first: Column, second: Column) -> Column:
    """The side that did not win; null without a winner."""
    return F.when(winner.isNotNull(), F.when(winner == first, second).otherwise(first))


def result_kind(outright: Column | str, recorded: Column | str) -> Column:
    """``win`` with an outright winner, else the recorded result in one word (``tie``, ``no_result``), or ``unknown``."""
    return F.when(col(outright).isNotNull(), "win").otherwise(F.coalesce(F.replace(col(recorded), F.lit(" "), F.lit("_")), F.lit("unknown")))


def is_kind(kinds: tuple[str, ...]):
    return lambda wicket: wicket["kind"].isin(*kinds)


def team_wickets(wickets: Column | str) -> Column:
    return F.size(F.filter(col(wickets), lambda w: ~is_kind(NOT_OUT_KINDS)(w)))


def bowler_wickets(wickets: Column | str) -> Column:
    return F.size(F.filter(col(wickets), is_kind(BOWLER_KINDS)))


def all_out(super_over: Column | str, wickets: Column | str, out_or_absent: Column) -> Column:
    """Ten dismissed or absent; in a super over two wickets."""
    return F.when(col(super_over), col(wickets) >= SUPER_OVER_WICKETS).otherwise(out_or_absent >= WICKETS)


def wicket_limit(super_over: Column | str) -> Column:
    return F.when(col(super_over), SUPER_OVER_WICKETS).otherwise(WICKETS)


def net_run_rate_credit(first: Column, second: Column) -> Column:
    """Runs and balls that net run rate credits to both sides, from the structs of both innings.

    A recorded target counts as revised: the first side then gets one run less than it, off the balls of the chase.
    A side that is all out is charged its full quota.
    """
    revised = second["target_runs"].isNotNull() & second["target_balls"].isNotNull()
    quota = F.when(revised, second["target_balls"]).otherwise(first["scheduled_balls"])
    faced = lambda side: F.when(side["all_out"], quota).otherwise(side["official_balls"])
    return F.struct(
        F.when(revised, second["target_runs"] - 1).otherwise(first["runs"]).alias("first_runs"),
        F.when(revised, quota).otherwise(faced(first)).alias("first_balls"),
        second["runs"].alias("second_runs"),
        faced(second).alias("second_balls"),
    )
