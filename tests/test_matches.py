"""Rules, conformed tables, marts and checks on hand-written documents."""

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import documents as written  # noqa: E402

from creaseline import schemas  # noqa: E402
from creaseline.functions import rules  # noqa: E402
from creaseline.plans import marts, quality, silver  # noqa: E402


@pytest.fixture(scope="module")
def t(spark):
    docs = written.frame(spark, {k: f() for k, f in written.ALL.items()})
    venues = spark.createDataFrame([("Old Ground", "The Ground", "City", "Land")], schemas.VENUES)
    teams = spark.createDataFrame([("Reds", "Red Club", "R", "R"), ("Blues", "Blues", "B", "B")], schemas.TEAMS)
    built = silver.build(docs, venues, teams)
    adjustments = spark.createDataFrame(
        [("3", "2020", None, None, None, None, None, "void", None, None), ("9", "2020", None, "Reds", "Blues", None, None, "abandoned_no_ball", None, None)],
        schemas.ADJUSTMENTS,
    )
    return {n: d.cache() for n, d in built.items()} | {"adjustments": adjustments, "venues": venues, "teams": teams}


def one(df, condition):
    rows = df.where(condition).collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_overs_notation(spark):
    row = spark.range(1).select(
        rules.overs_to_balls(F.lit(9.2)).alias("a"), rules.balls_to_overs(F.lit(118)).alias("b"), rules.overs_to_balls(F.lit(19.5)).alias("c"), rules.rate(F.lit(1), F.lit(0)).alias("d")
    ).first()
    assert (row.a, row.b, row.c, row.d) == (56, "19.4", 119, None)


@pytest.mark.parametrize("over, expected", [(1, "powerplay"), (6, "powerplay"), (7, "middle"), (15, "middle"), (16, "death")])
def test_phase(spark, over, expected):
    assert spark.range(1).select(rules.phase(F.lit(over), F.lit(False))).first()[0] == expected


def test_innings(t):
    first = one(t["innings"], "match_id = 1 and innings_number = 1")
    assert (first.runs, first.wickets, first.legal_balls, first.wides, first.fours, first.sixes, first.overs, first.all_out) == (18, 1, 12, 1, 1, 1, "2.0", False)
    out = one(t["innings"], "match_id = 5 and innings_number = 1")
    assert (out.all_out, out.runs, out.official_balls, out.legal_balls) == (True, 5, 15, 16)
    hurt = one(t["innings"], "match_id = 5 and innings_number = 2")
    assert (hurt.wickets, hurt.all_out) == (0, False)
    over = one(t["innings"], "match_id = 2 and innings_number = 4")
    assert (over.is_super_over, over.all_out, over.bowling_team) == (True, True, "Blues")
    assert one(t["innings"], "match_id = 3 and innings_number = 2").target_balls == 90


def test_balls(t):
    labels = [r.ball_label for r in t["deliveries"].where("match_id = 1 and innings_number = 1 and over_index = 0").orderBy("delivery_seq").collect()]
    assert labels == ["0.1", "0.2", "0.3", "0.3", "0.4", "0.5", "0.6"]
    assert t["deliveries"].where("match_id = 1 and innings_number = 2 and in_powerplay").count() == 6
    assert t["deliveries"].where("match_id = 5 and umpire_miscount").count() == 7
    two = t["wickets"].where("match_id = 1 and innings_number = 2").orderBy("wicket_seq").collect()
    assert [(w.team_wicket_number, w.credited_bowler) for w in two] == [(1, "Reds 8"), (2, None)]
    assert one(t["wickets"], "kind = 'retired hurt'").team_wicket_number is None


def test_matches(t):
    m = one(t["matches"], "match_id = 1")
    assert (m.venue, m.city, m.team1_franchise, m.winner_franchise, m.loser, m.result_type, m.season) == ("The Ground", "City", "Red Club", "Blues", "Reds", "win", 2020)
    text = {r.match_id: r.result_text for r in marts.match_summary(t["matches"], t["innings"]).collect()}
    assert text["1"] == "Blues won by 8 wickets" and text["3"] == "Blues won by 10 wickets (DLS)"
    assert text["2"] == "Match tied (Blues won the super over)" and text["4"] == "No result"


def test_scorecards(t):
    batting = marts.batting_scorecard(t["deliveries"], t["wickets"], t["match_players"])
    opener = one(batting, "match_id = 1 and innings_number = 1 and batter = 'Reds 1'")
    assert (opener.batting_position, opener.runs, opener.balls, opener.fours, opener.is_out, opener.player_id) == (1, 17, 12, 1, True, "id-Reds 1")
    bowling = marts.bowling_scorecard(t["deliveries"], t["match_players"])
    assert one(bowling, "match_id = 1 and bowler = 'Reds 9'").maidens == 1
    season = marts.season_batting(batting, t["match_players"])
    assert one(season, "player_id = 'id-Reds 1'").innings == 6
    assert one(t["match_players"], "match_id = 6 and player_name = 'Blues 11'").is_impact_substitute
    assert t["match_players"].where("match_id = 6").count() == 22


def test_net_run_rate_credit(t):
    c = {r.match_id: r.credit for r in marts.credits(t["matches"], t["innings"]).collect()}
    assert (c["3"].first_runs, c["3"].first_balls, c["3"].second_runs, c["3"].second_balls) == (30, 90, 36, 6)
    assert (c["5"].first_runs, c["5"].first_balls) == (5, 120)


def test_points_table(t):
    table = {r.team: r for r in marts.points_table(t["matches"], t["innings"], t["adjustments"]).collect()}
    blues, reds = table["Blues"], table["Reds"]
    assert (blues.played, blues.won, blues.tied, blues.no_result, blues.points, blues.position) == (6, 4, 1, 2, 10, 1)
    assert (reds.won, reds.lost, reds.points) == (0, 4, 2)
    pair = marts.head_to_head(t["matches"], t["adjustments"]).collect()
    assert [(p.franchise_a, p.matches, p.no_results) for p in pair] == [("Blues", 5, 1)]


def test_checks_pass_then_fail(spark, t):
    counts = {r.check: r.violations for r in quality.violation_counts(quality.CONFORMED, t).collect()}
    assert not any(counts[c.name] for c in quality.CONFORMED if c.severity == "error"), counts
    broken = t | {"deliveries": t["deliveries"].withColumn("runs_total", F.col("runs_total") + F.when(F.col("delivery_id") == "1-1-0-1", 1).otherwise(0))}
    results = quality.violation_counts(quality.CONFORMED, broken).cache()
    found = {r.check for r in results.where("violations > 0").collect()}
    assert {"deliveries_runs_total_consistent", "innings_runs_reconcile"} <= found
    with pytest.raises(quality.QualityError):
        quality.enforce(results)
    orphan = t | {"matches": t["matches"].where("match_id <> '1'")}
    assert {r.check: r.violations for r in quality.violation_counts(quality.CONFORMED, orphan).collect()}["deliveries_belong_to_a_match"] == 1


def test_windows_share_one_exchange(spark):
    docs = written.frame(spark, {1: written.plain()})
    plan = silver.deliveries(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_innings_flags_and_audit_columns(spark):
    doc = written.plain()
    doc["innings"][0] |= {"declared": True, "miscounted_overs": {"1": {"balls": 5, "umpire": "U"}}}
    doc["innings"].append({"team": "Reds", "overs": [], "forfeited": True})
    frame = written.frame(spark, {1: doc})
    rows = {r.innings_number: r for r in silver.innings(frame, silver.deliveries(frame)).collect()}
    assert (rows[1].declared, rows[1].forfeited, rows[3].forfeited, rows[3].runs) == (True, False, True, 0)
    assert rows[1].miscounted_overs["1"].balls == 5 and rows[2].target_overs == 20.0
    assert [(p["from"], p["to"]) for p in rows[2].powerplays] == [(0.1, 0.6)]
    venues = spark.createDataFrame([("Old Ground", "The Oval", "City", "Land")], schemas.VENUES)
    head = silver.matches(frame, venues, spark.createDataFrame([], schemas.TEAMS)).first()
    assert (head.venue, head.country, head.silver_built_at is not None) == ("The Oval", "Land", True)


def test_result_rules(spark):
    from creaseline.functions import rules

    rows = [("A", None, None, None), (None, "tie", "B", None), (None, "tie", None, "A"), (None, "no result", None, None), (None, None, None, None)]
    frame = spark.createDataFrame(rows, "winner string, result string, eliminator string, bowl_out string")
    won = rules.winner_of("winner", "eliminator", "bowl_out")
    got = frame.select(rules.result_kind("winner", "result"), won, rules.loser(won, F.lit("A"), F.lit("B")), rules.stage(F.lit(None).cast("string")))
    assert [tuple(r) for r in got.collect()] == [
        ("win", "A", "B", "League"), ("tie", "B", "A", "League"), ("tie", "A", "B", "League"), ("no_result", None, None, "League"), ("unknown", None, None, "League"),
    ]


def test_row_checks_of_a_table_share_one_scan(spark, t, tmp_path):
    t["deliveries"].write.parquet(str(tmp_path / "d"))
    frame = spark.read.parquet(str(tmp_path / "d"))
    suite = [c for c in quality.CONFORMED if c.table == "deliveries" and isinstance(c.violations, quality.RowsWhere)]
    broken = frame.withColumn("source_ball_label", F.when(F.col("delivery_id") == "1-1-0-1", "9.9"))
    counts = quality.violation_counts(suite, {"deliveries": broken})
    assert len(suite) == 3 and counts._jdf.queryExecution().executedPlan().toString().count("Scan parquet") == 1
    rows = {r.check: r for r in counts.collect()}
    bad = rows.pop("deliveries_ball_label_matches_source")
    assert (bad.table, bad.severity) == ("deliveries", "warn") and bad.violations == 1 and '"9.9"' in bad.sample
    assert {(r.violations, r.sample) for r in rows.values()} == {(0, None)}
