"""DuckDB SQL that gives the rows of the registered queries, written on its own from the shape of the data.

Rates get 1e-9 before they are rounded, since Spark rounds the decimal form of a double and DuckDB its binary value.
``_SHAPE`` is the common chain of the match queries: lines as balls, wickets, innings and matches without documents.
"""

from __future__ import annotations

from creaseline.queries.warehouse import ORACLE_SQL as _WAREHOUSE

_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"

_SHAPE = f"""
l0 AS (SELECT l_orderkey // 40 AS m, CASE WHEN (l_orderkey // 40) % 37 = 5 AND l_linenumber = 7 THEN 3 ELSE 1 + (l_orderkey // 20) % 2 END AS inn,
    l_partkey AS pk, l_suppkey AS sk, floor(l_quantity)::BIGINT AS q, l_returnflag = 'R' AND l_partkey % 5 = 0 AS is_wide, * FROM lineitem),
l1 AS (SELECT *, row_number() OVER (PARTITION BY m, inn ORDER BY {_ORDER}) - 1 AS pos, CASE WHEN m % 50 = 7 THEN 7 ELSE 6 END AS osz,
    'T' || (m % 8) AS t1, 'T' || (CASE WHEN (m * 3 + 1) % 8 = m % 8 THEN (m * 3 + 2) % 8 ELSE (m * 3 + 1) % 8 END) AS t2,
    NOT is_wide AND pk % 17 = 0 AS is_noball, dense_rank() OVER (PARTITION BY m ORDER BY inn) AS innings_number FROM l0),
l2 AS (SELECT *, pos // osz AS over_index, pos % osz + 1 AS delivery_seq, CASE WHEN inn = 1 THEN t1 ELSE t2 END AS batting_team,
    CASE WHEN inn = 1 THEN t2 ELSE t1 END AS bowling_team, inn = 3 AS is_super_over, 1995 + m % 7 AS season, CASE WHEN is_wide THEN 0 ELSE q % 7 END AS hit,
    NOT is_wide AND NOT is_noball AS is_legal FROM l1),
l3 AS (SELECT *, (is_wide)::BIGINT AS wides, (is_noball)::BIGINT AS noballs, (is_legal AND sk % 19 = 0)::BIGINT AS byes,
    (is_legal AND sk % 19 <> 0 AND sk % 23 = 0)::BIGINT AS legbyes, CASE WHEN pk % 997 = 0 THEN 5 ELSE 0 END AS penalty,
    batting_team || '-b' || (sk % 11) AS batter, batting_team || '-b' || ((sk % 11 + 1 + pk % 10) % 11) AS non_striker,
    bowling_team || '-p' || ((over_index + m + (pk % 101 = 0)::BIGINT) % 6) AS bowler,
    (['bowled', 'caught', 'caught and bowled', 'lbw', 'stumped', 'hit wicket', 'run out', 'retired hurt', 'obstructing the field'])[sk % 9 + 1] AS kind FROM l2),
d AS (SELECT *, m::VARCHAR AS match_id, wides + noballs + byes + legbyes + penalty AS extras, hit + wides + noballs + byes + legbyes + penalty AS total,
    hit = 4 AND pk % 10 <> 0 AS is_four, hit = 6 AS is_six, (pk % 13 = 0 AND kind <> 'retired hurt')::BIGINT + (pk % 169 = 0)::BIGINT AS team_wickets,
    (pk % 13 = 0 AND kind IN ('bowled', 'caught', 'caught and bowled', 'lbw', 'stumped', 'hit wicket'))::BIGINT AS bowler_wickets,
    hit + wides + noballs AS bowler_runs, over_index = 2 AND m % 100 = 7 AND inn = 1 AS umpire_miscount,
    CASE WHEN is_super_over THEN 'super_over' WHEN over_index < 6 THEN 'powerplay' WHEN over_index < 15 THEN 'middle' ELSE 'death' END AS phase,
    is_legal AND hit + wides + noballs + byes + legbyes + penalty = 0 AS is_dot FROM l3),
r AS (SELECT *, sum(is_legal::BIGINT) OVER (PARTITION BY m, inn, over_index ORDER BY delivery_seq)::BIGINT AS in_over,
    sum(is_legal::BIGINT) OVER w::BIGINT AS in_innings, sum(total) OVER w::BIGINT AS runs_after, sum(team_wickets) OVER w::BIGINT AS wickets_after FROM d
    WINDOW w AS (PARTITION BY m, inn ORDER BY pos)),
rl AS (SELECT *, in_over + (NOT is_legal)::BIGINT AS ball, over_index || '.' || (in_over + (NOT is_legal)::BIGINT) AS ball_label FROM r),
w0 AS (SELECT rl.*, 1 AS wicket_seq, CASE WHEN kind = 'run out' AND pk % 2 = 0 THEN non_striker ELSE batter END AS player_out, kind AS wkind,
    CASE WHEN kind = 'caught' THEN bowling_team || '-p' || (sk % 6) ELSE '' END AS fielders, kind = 'caught' AND sk % 5 = 0 AS fielder_is_substitute FROM rl WHERE pk % 13 = 0
    UNION ALL SELECT rl.*, 2, non_striker, 'run out', '', false FROM rl WHERE pk % 169 = 0),
w AS (SELECT *, wkind <> 'retired hurt' AS counts, CASE WHEN wkind IN ('bowled', 'caught', 'caught and bowled', 'lbw', 'stumped', 'hit wicket') THEN bowler END AS credited_bowler,
    CASE WHEN wkind <> 'retired hurt' THEN sum((wkind <> 'retired hurt')::BIGINT) OVER (PARTITION BY m, inn ORDER BY pos, wicket_seq)::BIGINT END AS nth FROM w0),
tot AS (SELECT m, sum(total) FILTER (inn = 1) + CASE WHEN m % 53 = 0 THEN 5 ELSE 0 END AS r1, sum(total) FILTER (inn = 2) AS r2, sum(team_wickets) FILTER (inn = 2) AS w2, any_value(t1) AS t1, any_value(t2) AS t2
    FROM d GROUP BY m),
i0 AS (SELECT m, inn, match_id, innings_number, season, batting_team, bowling_team, is_super_over, count(*) AS deliveries, sum(total)::BIGINT AS ball_runs, sum(team_wickets)::BIGINT AS wickets,
    sum(is_legal::BIGINT)::BIGINT AS legal_balls, sum(extras)::BIGINT AS extras, sum(wides)::BIGINT AS wides, sum(noballs)::BIGINT AS noballs, sum(byes)::BIGINT AS byes,
    sum(legbyes)::BIGINT AS legbyes, sum(is_four::BIGINT)::BIGINT AS fours, sum(is_six::BIGINT)::BIGINT AS sixes, sum(is_dot::BIGINT)::BIGINT AS dot_balls
    FROM d GROUP BY ALL),
i AS (SELECT i0.*, CASE WHEN m % 53 = 0 AND inn = 1 THEN 5 ELSE 0 END AS penalty_runs_pre, ball_runs + CASE WHEN m % 53 = 0 AND inn = 1 THEN 5 ELSE 0 END AS runs,
    legal_balls - (m % 100 = 7 AND inn = 1)::BIGINT AS official_balls, CASE WHEN inn = 2 THEN CASE WHEN m % 9 = 0 THEN 150 ELSE r1 + 1 END END::BIGINT AS target_runs,
    CASE WHEN inn = 2 THEN CASE WHEN m % 9 = 0 THEN 90 ELSE 120 END END AS target_balls,
    CASE WHEN is_super_over THEN wickets >= 2 ELSE coalesce(gone, 0) + (m % 41 = 0 AND inn = 2)::BIGINT >= 10 END AS all_out
    FROM i0 JOIN tot USING (m) LEFT JOIN (SELECT m, inn, count(DISTINCT player_out) AS gone FROM w GROUP BY ALL) g USING (m, inn)),
ix AS (SELECT *, (official_balls // 6) || '.' || (official_balls % 6) AS overs, runs || '/' || wickets || ' (' || (official_balls // 6) || '.' || (official_balls % 6) || ')' AS score_text,
    CASE WHEN official_balls > 0 THEN round(runs * 6 / official_balls + 1e-9, 2) END AS run_rate FROM i),
m0 AS (SELECT *, m::VARCHAR AS match_id, 1995 + m % 7 AS season, make_date((1995 + m % 7)::INT, 4, 1) + (m % 60)::INT AS match_date,
    coalesce(CASE WHEN m % 24 = 23 THEN 'Final' WHEN m % 12 = 11 THEN 'Qualifier' END, 'League') AS stage, m % 12 = 11 AS is_playoff,
    CASE WHEN m % 3 < 2 THEN t1 ELSE t2 END AS toss_winner, CASE WHEN m % 2 = 0 THEN 'field' ELSE 'bat' END AS toss_decision,
    m % 23 = 0 OR r1 IS NULL OR r2 IS NULL AS open_ FROM tot),
m1 AS (SELECT *, NOT open_ AND r1 <> r2 AS settled, CASE WHEN NOT open_ AND r1 = r2 AND m % 2 = 0 THEN t1 END AS super_over_winner,
    CASE WHEN open_ THEN 'no_result' WHEN r1 = r2 THEN 'tie' ELSE 'win' END AS result_type FROM m0),
m2 AS (SELECT *, CASE WHEN settled THEN CASE WHEN r1 > r2 THEN t1 ELSE t2 END ELSE super_over_winner END AS winner,
    CASE WHEN settled AND r1 > r2 THEN (r1 - r2)::BIGINT END AS win_by_runs, CASE WHEN settled AND r2 > r1 THEN greatest(10 - w2, 1)::BIGINT END AS win_by_wickets,
    CASE WHEN m % 9 = 0 THEN 'D/L' END AS result_method, CASE WHEN m % 5 = 0 THEN '' ELSE t1 || '-b' || (m % 11) END AS player_of_match FROM m1),
mt AS (SELECT m2.*, coalesce(n_name, 'ground-' || (m % 25)) AS venue, coalesce(r_name, 'city-' || (m % 25)) AS city,
    CASE t1 WHEN 'T7' THEN 'T7' WHEN 'T6' THEN 'F0' ELSE replace(t1, 'T', 'F') END AS f1, CASE t2 WHEN 'T7' THEN 'T7' WHEN 'T6' THEN 'F0' ELSE replace(t2, 'T', 'F') END AS f2,
    CASE winner WHEN 'T7' THEN 'T7' WHEN 'T6' THEN 'F0' ELSE replace(winner, 'T', 'F') END AS fw
    FROM m2 LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 5 <> 3) ON n_nationkey = m % 25),
void AS (SELECT DISTINCT o_orderkey // 40 AS m FROM orders WHERE (o_orderkey // 40) % 29 = 0),
ab AS (SELECT 1995 + c_custkey % 7 AS season, 'T' || (c_custkey % 8) AS t1, 'T' || ((c_custkey + 3) % 8) AS t2 FROM customer WHERE c_custkey % 31 = 1),
f AS (SELECT * FROM i WHERE innings_number = 1 AND NOT is_super_over),
s AS (SELECT * FROM i WHERE innings_number = 2 AND NOT is_super_over),
cr AS (SELECT mt.m, f.batting_team AS bat1, s.batting_team AS bat2, f.runs AS fr, s.runs AS sr, s.target_balls AS tb, f.m IS NOT NULL AND s.m IS NOT NULL AS both_,
    CASE WHEN s.target_runs IS NOT NULL THEN s.target_runs - 1 ELSE f.runs END AS first_runs,
    CASE WHEN s.target_runs IS NOT NULL THEN s.target_balls WHEN f.all_out THEN CASE WHEN f.m IS NOT NULL THEN 120 END ELSE f.official_balls END AS first_balls, s.runs AS second_runs,
    CASE WHEN s.all_out THEN CASE WHEN s.target_runs IS NOT NULL THEN s.target_balls WHEN f.m IS NOT NULL THEN 120 END ELSE s.official_balls END AS second_balls
    FROM mt LEFT JOIN f USING (m) LEFT JOIN s USING (m)),
pl AS (SELECT m, match_id, season, team, k + 1 AS lineup_order, team || CASE WHEN k < 11 THEN '-b' || k ELSE '-p' || (k - 11) END AS player_name,
    CASE WHEN k <> 10 THEN 'id-' || team || CASE WHEN k < 11 THEN '-b' || k ELSE '-p' || (k - 11) END END AS player_id
    FROM mt, (SELECT unnest([1, 2]) AS side), (SELECT unnest(range(17)) AS k), LATERAL (SELECT CASE side WHEN 1 THEN t1 ELSE t2 END AS team)),
cz AS (SELECT m, inn, match_id, innings_number, season, is_super_over, batting_team, batter, pos, 0 AS slot, hit AS runs, NOT is_wide AS faced, is_four AS four, is_six AS six FROM d
    UNION ALL SELECT m, inn, match_id, innings_number, season, is_super_over, batting_team, non_striker, pos, 1, 0, false, false, false FROM d),
bt0 AS (SELECT m, inn, match_id, innings_number, season, is_super_over, batting_team, batter, min(pos * 2 + slot) AS first_at, sum(runs)::BIGINT AS runs, sum(faced::BIGINT)::BIGINT AS balls,
    sum(four::BIGINT)::BIGINT AS fours, sum(six::BIGINT)::BIGINT AS sixes, sum((faced AND runs = 0)::BIGINT)::BIGINT AS dots FROM cz GROUP BY ALL),
bt AS (SELECT bt0.*, row_number() OVER (PARTITION BY bt0.m, bt0.inn ORDER BY first_at) AS batting_position, wkind AS dismissal_kind, credited_bowler AS dismissal_bowler, fielders AS dismissal_fielders,
    coalesce(counts, false) AS is_out, nth AS fall_of_wicket_number, runs_after AS fall_of_wicket_score, ball_label AS fall_of_wicket_ball,
    CASE WHEN balls > 0 THEN round(runs * 100 / balls + 1e-9, 2) END AS strike_rate, CASE WHEN batter NOT LIKE '%-b10' THEN 'id-' || batter END AS player_id
    FROM bt0 LEFT JOIN (SELECT m, inn, player_out, wkind, credited_bowler, fielders, counts, nth, runs_after, ball_label FROM w
      QUALIFY row_number() OVER (PARTITION BY m, inn, player_out ORDER BY pos DESC, wicket_seq DESC) = 1) x ON bt0.m = x.m AND bt0.inn = x.inn AND batter = player_out),
bo AS (SELECT m, inn, match_id, innings_number, season, is_super_over, bowling_team, bowler, min(pos) AS first_at, sum(is_legal::BIGINT)::BIGINT AS balls, sum(bowler_runs)::BIGINT AS runs_conceded,
    sum(bowler_wickets)::BIGINT AS wickets, sum((is_legal AND bowler_runs = 0)::BIGINT)::BIGINT AS dots, sum(is_wide::BIGINT)::BIGINT AS wides, sum(is_noball::BIGINT)::BIGINT AS noballs FROM d GROUP BY ALL),
md AS (SELECT m, inn, any_value(bowler) AS bowler, count(*) AS n FROM (SELECT m, inn, over_index, min(bowler) AS bowler FROM d GROUP BY ALL
    HAVING count(DISTINCT bowler) = 1 AND sum(is_legal::BIGINT) >= 6 AND sum(bowler_runs) = 0) GROUP BY m, inn, bowler),
bw AS (SELECT bo.*, row_number() OVER (PARTITION BY bo.m, bo.inn ORDER BY first_at) AS bowling_order, coalesce(n, 0) AS maidens, (balls // 6) || '.' || (balls % 6) AS overs,
    CASE WHEN balls > 0 THEN round(runs_conceded * 6 / balls + 1e-9, 2) END AS economy, 'id-' || bo.bowler AS player_id FROM bo LEFT JOIN md ON bo.m = md.m AND bo.inn = md.inn AND bo.bowler = md.bowler),
ap AS (SELECT season, player_id, count(DISTINCT m) AS matches FROM pl WHERE player_id IS NOT NULL GROUP BY ALL),
sb AS (SELECT season, player_id, max_by(batter, (m, innings_number, batter)) AS player_name, array_to_string(list_sort(list(DISTINCT batting_team)), ',') AS teams, count(*) AS innings, sum(runs)::BIGINT AS runs,
    sum(balls)::BIGINT AS balls, sum(is_out::BIGINT)::BIGINT AS outs, count(*) FILTER (runs BETWEEN 50 AND 99) AS fifties, count(*) FILTER (runs >= 100) AS hundreds,
    count(*) FILTER (runs = 0 AND is_out) AS ducks, max(runs * 2 + (NOT is_out)::BIGINT) AS best FROM bt WHERE NOT is_super_over AND player_id IS NOT NULL GROUP BY ALL),
sbx AS (SELECT *, (best // 2) || CASE WHEN best % 2 = 1 THEN '*' ELSE '' END AS highest_score_text, CASE WHEN outs > 0 THEN round(runs / outs + 1e-9, 2) END AS average,
    CASE WHEN balls > 0 THEN round(runs * 100 / balls + 1e-9, 2) END AS strike_rate FROM sb LEFT JOIN ap USING (season, player_id)),
so AS (SELECT season, player_id, max_by(bowler, (m, innings_number, bowler)) AS player_name, array_to_string(list_sort(list(DISTINCT bowling_team)), ',') AS teams, count(*) AS innings, sum(balls)::BIGINT AS balls,
    sum(runs_conceded)::BIGINT AS runs_conceded, sum(wickets)::BIGINT AS wickets, sum(maidens)::BIGINT AS maidens, max(wickets * 100000 + 99999 - runs_conceded) AS best,
    count(*) FILTER (wickets = 4) AS four_wickets, count(*) FILTER (wickets >= 5) AS five_wickets FROM bw WHERE NOT is_super_over AND player_id IS NOT NULL GROUP BY ALL),
sox AS (SELECT *, (best // 100000) || '/' || (99999 - best % 100000) AS best_figures, CASE WHEN wickets > 0 THEN round(runs_conceded / wickets + 1e-9, 2) END AS average,
    CASE WHEN balls > 0 THEN round(runs_conceded * 6 / balls + 1e-9, 2) END AS economy FROM so LEFT JOIN ap USING (season, player_id)),
sm AS (SELECT mt.*, f.batting_team AS first_batting_team, f.score_text AS first_innings_score, s.batting_team AS second_batting_team, s.score_text AS second_innings_score,
    CASE WHEN win_by_runs IS NOT NULL THEN winner || ' won by ' || win_by_runs || CASE WHEN win_by_runs = 1 THEN ' run' ELSE ' runs' END || CASE WHEN result_method IS NOT NULL THEN ' (DLS)' ELSE '' END
      WHEN win_by_wickets IS NOT NULL THEN winner || ' won by ' || win_by_wickets || CASE WHEN win_by_wickets = 1 THEN ' wicket' ELSE ' wickets' END || CASE WHEN result_method IS NOT NULL THEN ' (DLS)' ELSE '' END
      WHEN result_type = 'tie' THEN 'Match tied (' || super_over_winner || ' won the super over)' ELSE 'No result' END AS result_text
    FROM mt LEFT JOIN (SELECT * FROM ix WHERE innings_number = 1 AND NOT is_super_over) f USING (m) LEFT JOIN (SELECT * FROM ix WHERE innings_number = 2 AND NOT is_super_over) s USING (m)),
side AS (SELECT mt.m, season, team, result_type, winner, result_type <> 'no_result' AS decided, team = coalesce(bat1, t1) AS is_first, first_runs, first_balls, second_runs, second_balls
    FROM mt JOIN cr USING (m), (SELECT unnest([1, 2]) AS k), LATERAL (SELECT CASE k WHEN 1 THEN t1 ELSE t2 END AS team) WHERE NOT is_playoff AND m NOT IN (SELECT m FROM void)),
pr AS (SELECT season, team, decided AND coalesce(winner = team, false) AS won, decided AND coalesce(winner <> team, false) AS lost, result_type = 'tie' AS tied, NOT decided AS no_result,
    CASE WHEN decided AND winner = team THEN 2 WHEN NOT decided OR winner IS NULL THEN 1 ELSE 0 END AS points,
    CASE WHEN decided THEN CASE WHEN is_first THEN first_runs ELSE second_runs END END AS rf, CASE WHEN decided THEN CASE WHEN is_first THEN first_balls ELSE second_balls END END AS bf,
    CASE WHEN decided THEN CASE WHEN is_first THEN second_runs ELSE first_runs END END AS ra, CASE WHEN decided THEN CASE WHEN is_first THEN second_balls ELSE first_balls END END AS ba FROM side
    UNION ALL SELECT season, t1, false, false, false, true, 1, NULL, NULL, NULL, NULL FROM ab UNION ALL SELECT season, t2, false, false, false, true, 1, NULL, NULL, NULL, NULL FROM ab),
pt0 AS (SELECT season, team, count(*) AS played, sum(won::BIGINT)::BIGINT AS won, sum(lost::BIGINT)::BIGINT AS lost, sum(tied::BIGINT)::BIGINT AS tied, sum(no_result::BIGINT)::BIGINT AS no_result,
    sum(points)::BIGINT AS points, coalesce(sum(rf), 0)::BIGINT AS runs_for, coalesce(sum(bf), 0)::BIGINT AS balls_for, coalesce(sum(ra), 0)::BIGINT AS runs_against, coalesce(sum(ba), 0)::BIGINT AS balls_against
    FROM pr GROUP BY ALL),
pt1 AS (SELECT *, CASE WHEN balls_for > 0 AND balls_against > 0 THEN round(runs_for * 6 / balls_for - runs_against * 6 / balls_against, 3) END AS net_run_rate,
    (balls_for // 6) || '.' || (balls_for % 6) AS overs_for, (balls_against // 6) || '.' || (balls_against % 6) AS overs_against FROM pt0),
pt AS (SELECT *, row_number() OVER (PARTITION BY season ORDER BY points DESC, net_run_rate DESC NULLS LAST, won DESC, team) AS "position" FROM pt1),
ev0 AS (SELECT m, match_id, match_id || '-' || innings_number || '-' || lpad(over_index::VARCHAR, 2, '0') || '-' || lpad(delivery_seq::VARCHAR, 2, '0') AS event_id, 'delivery' AS event_type,
    row_number() OVER (PARTITION BY m ORDER BY inn, pos) AS sequence, 35 * row_number() OVER (PARTITION BY m ORDER BY inn, pos) + 1200 * (innings_number - 1) AS offset_seconds FROM d),
ev AS (SELECT * FROM ev0 UNION ALL SELECT m, match_id, match_id || '-match_started', 'match_started', 0, 0 FROM mt
    UNION ALL SELECT m, match_id, match_id || '-match_completed', 'match_completed', max(sequence) + 1, max(offset_seconds) + 35 FROM ev0 GROUP BY m, match_id),
lv AS (SELECT i.*, (target_runs - ball_runs) AS need, target_balls - legal_balls AS left_, x.event_id AS last_event_id, x.ball_label AS last_ball, x.batter AS striker
    FROM i JOIN (SELECT rl.m, rl.inn, ball_label, batter, innings_number, match_id || '-' || innings_number || '-' || lpad(over_index::VARCHAR, 2, '0') || '-' || lpad(delivery_seq::VARCHAR, 2, '0') AS event_id
      FROM rl QUALIFY row_number() OVER (PARTITION BY m, inn ORDER BY pos DESC) = 1) x USING (m, inn)),
subs AS (SELECT *, batting_team AS team, batting_team || '-b10' AS player_in, batter AS player_out, CASE WHEN sk % 2 = 0 THEN 'impact_player' ELSE 'concussion_substitute' END AS reason FROM d WHERE pk % 211 = 0)
"""

_BALL = "match_id, innings_number, over_index, delivery_seq"
_K = "match_id, innings_number"

_SELECT = {
    "match_header": """SELECT match_id, season, match_date::VARCHAR AS match_date, 1 AS match_days, m AS match_number, stage, is_playoff, t1 AS team1, t2 AS team2, toss_winner, toss_decision, result_type, winner,
        CASE WHEN winner = t1 THEN t2 WHEN winner IS NOT NULL THEN t1 END AS loser, super_over_winner, win_by_runs, win_by_wickets, result_method, player_of_match,
        CASE WHEN m % 3 = 0 THEN 'U1,U2' ELSE '' END AS umpires FROM mt""",
    "canonicalise": "SELECT match_id, venue, city, f1 AS team1_franchise, f2 AS team2_franchise, fw AS winner_franchise FROM mt",
    "innings_explode": f"SELECT {_K}, season, batting_team, bowling_team, is_super_over, 20 AS scheduled_overs FROM i",
    "deliveries_explode": f"SELECT {_BALL}, batter, bowler, total FROM d",
    "ball_facts": """SELECT match_id || '-' || innings_number || '-' || over_index || '-' || delivery_seq AS delivery_id, hit AS runs_batter, extras AS runs_extras, total AS runs_total, is_wide, is_noball, is_legal,
        NOT is_wide AS batter_faced, is_four, is_six, is_dot, bowler_runs, team_wickets, bowler_wickets, pk % 13 = 0 AS is_wicket,
        CASE WHEN pk % 13 = 0 THEN CASE WHEN kind = 'run out' AND pk % 2 = 0 THEN non_striker ELSE batter END || CASE WHEN pk % 169 = 0 THEN ',' || non_striker ELSE '' END ELSE '' END AS players_out,
        CASE WHEN pk % 13 = 0 THEN kind || CASE WHEN pk % 169 = 0 THEN ',run out' ELSE '' END ELSE '' END AS wicket_kinds FROM d""",
    "overs_notation": f"SELECT {_BALL}, in_innings AS legal_ball_number, (in_innings // 6) || '.' || (in_innings % 6) AS overs, in_innings AS balls_again FROM r",
    "phase_bucket": "SELECT season, phase, count(*) AS balls, sum(total)::BIGINT AS runs FROM d GROUP BY ALL",
    "in_any_range": f"SELECT {_BALL}, inn < 3 AND (over_index * 10 + ball BETWEEN 1 AND 56 OR over_index * 10 + ball BETWEEN 151 AND 166) AS in_powerplay FROM rl",
    "map_membership": f"SELECT {_BALL}, umpire_miscount FROM d WHERE umpire_miscount",
    "map_fold": f"SELECT {_K}, legal_balls, official_balls FROM i WHERE official_balls <> legal_balls",
    "wickets_explode": f"""SELECT {_BALL}, wicket_seq, player_out, wkind AS kind, fielders, fielder_is_substitute, credited_bowler,
        CASE WHEN player_out NOT LIKE '%-b10' THEN 'id-' || player_out END AS player_out_id FROM w""",
    "lineups": """SELECT pl.match_id, pl.team, lineup_order, player_name, player_id, x.m IS NOT NULL AS is_impact_substitute
        FROM pl LEFT JOIN (SELECT DISTINCT m, team, player_in FROM subs WHERE reason = 'impact_player') x ON pl.m = x.m AND pl.team = x.team AND player_name = player_in""",
    "substitutions": f"SELECT {_BALL}, team, player_in, player_out, reason FROM subs",
    "people_semi": """SELECT DISTINCT player_id FROM pl WHERE player_id IN (SELECT player_id FROM pl WHERE lineup_order < 3 UNION SELECT 'id-' || player_out FROM w WHERE player_out NOT LIKE '%-b10')""",
    "running_totals": f"SELECT {_BALL}, in_over AS legal_ball_in_over, in_innings AS legal_ball_number, runs_after AS team_runs_after, wickets_after AS team_wickets_after FROM r",
    "ball_label": f"SELECT {_BALL}, ball_label FROM rl",
    "running_conditional": f"SELECT {_BALL}, wicket_seq, counts AS counts_as_team_wicket, nth AS team_wicket_number, runs_after AS team_runs_at_fall FROM w",
    "over_ball_counts": f"SELECT {_K}, over_index, sum(is_legal::BIGINT)::BIGINT AS legal_balls, bool_or(umpire_miscount) AS umpire_miscount FROM d GROUP BY ALL",
    "innings_totals": f"""SELECT {_K}, deliveries, runs, wickets, legal_balls, extras, wides, noballs, byes, legbyes, fours, sixes, dot_balls, all_out, official_balls, overs, run_rate, target_runs, target_balls,
        penalty_runs_pre FROM ix""",
    "safe_rates": f"SELECT {_K}, CASE WHEN wickets > 0 THEN round(runs / wickets + 1e-9, 2) END AS per_wicket, CASE WHEN sixes > 0 THEN round(fours * 100 / sixes + 1e-9, 1) END AS four_six_pct FROM i",
    "innings_summary": """SELECT ix.match_id, innings_number, ix.season, match_date::VARCHAR AS match_date, stage, venue, score_text, all_out FROM ix JOIN mt USING (m)""",
    "match_summary": "SELECT match_id, season, first_batting_team, first_innings_score, second_batting_team, second_innings_score FROM sm",
    "result_text": "SELECT match_id, result_type, winner, result_text, player_of_match FROM sm",
    "innings_flags": f"""SELECT {_K}, (target_balls // 6)::DOUBLE AS target_overs, false AS declared, false AS forfeited, 20 AS scheduled_overs, 120 AS scheduled_balls, ball_runs AS delivery_runs,
        0 AS penalty_runs_post FROM ix""",
    "innings_summary_all": """SELECT ix.match_id, innings_number, ix.season, match_date::VARCHAR AS match_date, stage, venue, is_super_over, batting_team, bowling_team, runs, wickets, legal_balls, official_balls,
        overs, run_rate, extras, wides, noballs, byes, legbyes, fours, sixes, dot_balls, all_out, target_runs, target_balls, score_text FROM ix JOIN mt USING (m)""",
    "match_summary_all": """SELECT sm.match_id, sm.season, mt.match_date::VARCHAR AS match_date, mt.m AS match_number, mt.stage, mt.is_playoff, mt.venue, mt.city, mt.t1 AS team1, mt.t2 AS team2, mt.toss_winner,
        mt.toss_decision, first_batting_team, first_innings_score, second_batting_team, second_innings_score, mt.result_type, mt.winner, mt.result_method, result_text, sm.player_of_match
        FROM sm JOIN mt ON sm.match_id = mt.match_id""",
    "batting_scorecard": f"""SELECT {_K}, batter, batting_position, runs, balls, fours, sixes, dots, dismissal_kind, dismissal_bowler, dismissal_fielders, is_out, fall_of_wicket_number, fall_of_wicket_score,
        fall_of_wicket_ball, strike_rate, player_id FROM bt""",
    "colocated_scorecards": f"SELECT {_K}, batter, batting_position, runs, balls, fours, sixes, dots, dismissal_kind, is_out, player_id FROM bt",
    "bowling_scorecard": f"SELECT {_K}, bowler, bowling_order, balls, runs_conceded, wickets, dots, maidens, wides, noballs, overs, economy, player_id FROM bw",
    "appearances": "SELECT * FROM ap",
    "season_batting": "SELECT season, player_id, player_name, teams, innings, matches, runs, balls, outs, fifties, hundreds, ducks, highest_score_text, average, strike_rate FROM sbx",
    "season_bowling": """SELECT season, player_id, player_name, teams, innings, matches, balls, runs_conceded, wickets, maidens, best_figures, four_wickets, five_wickets, average, economy FROM sox""",
    "nrr_credits": "SELECT m::VARCHAR AS match_id, first_runs, first_balls, second_runs, second_balls FROM cr WHERE both_",
    "points_table": "SELECT * FROM pt",
    "venue_stats": """SELECT * EXCLUDE (toss_, field_), CASE WHEN decided > 0 THEN round(chasing_wins * 100 / decided + 1e-9, 1) END AS chasing_win_pct, CASE WHEN decided > 0 THEN round(toss_ * 100 / decided + 1e-9, 1) END AS toss_winner_win_pct,
        CASE WHEN matches > 0 THEN round(field_ * 100 / matches + 1e-9, 1) END AS field_first_pct FROM (SELECT venue, min(city) AS city, count(*) AS matches, min(season) AS first_season, max(season) AS last_season,
        count(*) FILTER (settled) AS decided, count(*) FILTER (settled AND winner = bat1) AS bat_first_wins, count(*) FILTER (settled AND winner = bat2) AS chasing_wins,
        round(avg(fr) FILTER (tb = 120) + 1e-9, 1) AS avg_first_innings_runs, round(avg(sr) FILTER (tb = 120) + 1e-9, 1) AS avg_second_innings_runs, count(*) FILTER (settled AND toss_winner = winner) AS toss_,
        count(*) FILTER (toss_decision = 'field') AS field_ FROM mt JOIN cr USING (m) GROUP BY venue)
        LEFT JOIN (SELECT venue, max(runs) AS highest_total, max_by(batting_team, (runs, batting_team, i.season)) AS highest_total_team, max_by(i.season, (runs, batting_team, i.season)) AS highest_total_season,
        min(runs) FILTER (all_out) AS lowest_all_out_total, min_by(batting_team, (runs, batting_team, i.season)) FILTER (all_out) AS lowest_all_out_team
        FROM i JOIN mt USING (m) WHERE NOT is_super_over GROUP BY venue) USING (venue)""",
    "phase_stats": """SELECT *, CASE WHEN legal_balls > 0 THEN round(runs * 6 / legal_balls + 1e-9, 2) END AS run_rate, CASE WHEN legal_balls > 0 THEN round((fours + sixes) * 100 / legal_balls + 1e-9, 1) END AS boundary_pct,
        CASE WHEN legal_balls > 0 THEN round(dot_balls * 100 / legal_balls + 1e-9, 1) END AS dot_pct, CASE WHEN wickets > 0 THEN round(runs / wickets + 1e-9, 2) END AS runs_per_wicket
        FROM (SELECT season, team, phase, perspective, count(DISTINCT m * 10 + inn) AS innings, sum(total)::BIGINT AS runs, sum(is_legal::BIGINT)::BIGINT AS legal_balls, sum(team_wickets)::BIGINT AS wickets,
        sum(is_four::BIGINT)::BIGINT AS fours, sum(is_six::BIGINT)::BIGINT AS sixes, sum(is_dot::BIGINT)::BIGINT AS dot_balls
        FROM (SELECT *, batting_team AS team, 'batting' AS perspective FROM d UNION ALL SELECT *, bowling_team, 'bowling' FROM d) WHERE NOT is_super_over GROUP BY ALL)""",
    "head_to_head": """SELECT least(f1, f2) AS franchise_a, greatest(f1, f2) AS franchise_b, count(*) AS matches, count(*) FILTER (fw = least(f1, f2)) AS franchise_a_wins,
        count(*) FILTER (fw = greatest(f1, f2)) AS franchise_b_wins, count(*) FILTER (result_type = 'tie') AS super_over_finishes, count(*) FILTER (result_type = 'no_result') AS no_results,
        min(match_date)::VARCHAR AS first_match_date, max(match_date)::VARCHAR AS last_match_date, (list(fw ORDER BY match_date DESC, m DESC))[1] AS last_winner
        FROM mt WHERE m NOT IN (SELECT m FROM void) GROUP BY ALL""",
    "event_envelopes": """SELECT ev.match_id, event_id, event_type, sequence, offset_seconds, strftime(match_date::TIMESTAMP + to_seconds(offset_seconds), '%Y-%m-%d %H:%M:%S') AS event_time FROM ev JOIN mt USING (m)""",
    "live_scorecard": """SELECT lv.match_id, innings_number, lv.season, batting_team, ball_runs AS runs, wickets, legal_balls, extras, fours, sixes, target_runs, CASE WHEN target_runs IS NOT NULL THEN target_balls END AS target_balls, deliveries,
        ball_runs || '/' || wickets || ' (' || (legal_balls // 6) || '.' || (legal_balls % 6) || ')' AS score_text, CASE WHEN legal_balls > 0 THEN round(ball_runs * 6 / legal_balls + 1e-9, 2) END AS run_rate,
        CASE WHEN need IS NOT NULL THEN greatest(need, 0) END AS runs_required, CASE WHEN target_runs IS NOT NULL THEN greatest(left_, 0) END AS balls_remaining, CASE WHEN need > 0 AND left_ > 0 THEN round(need * 6 / left_ + 1e-9, 2) END AS required_run_rate, last_event_id, last_ball, striker,
        'completed' AS match_status, winner AS match_winner FROM lv JOIN mt USING (m)""",
    "match_state": """SELECT mt.match_id, strftime(match_date::TIMESTAMP + to_seconds(z), '%Y-%m-%d %H:%M:%S') AS last_event_time, season, stage, t1 || ',' || t2 AS teams, toss_winner,
        strftime(match_date::TIMESTAMP, '%Y-%m-%d %H:%M:%S') AS started_at, winner, CASE result_type WHEN 'no_result' THEN 'no result' ELSE result_type END AS result,
        strftime(match_date::TIMESTAMP + to_seconds(z), '%Y-%m-%d %H:%M:%S') AS completed_at FROM mt JOIN (SELECT m, max(offset_seconds) AS z FROM ev GROUP BY m) USING (m)""",
    "reconcile": f"SELECT {_K}, 'runs' AS problem, runs::VARCHAR AS expected, ball_runs::VARCHAR AS actual FROM i WHERE runs <> ball_runs",
    "batch_build": """SELECT * FROM (VALUES ('deliveries', (SELECT count(*) FROM d)), ('wickets', (SELECT count(*) FROM w)), ('innings', (SELECT count(*) FROM i)),
        ('substitutions', (SELECT count(*) FROM subs)), ('match_players', (SELECT count(*) FROM pl)), ('matches', (SELECT count(*) FROM mt)), ('innings_summary', (SELECT count(*) FROM ix)),
        ('match_summary', (SELECT count(*) FROM sm)), ('batting_scorecard', (SELECT count(*) FROM bt)), ('bowling_scorecard', (SELECT count(*) FROM bw)),
        ('player_season_batting', (SELECT count(*) FROM sbx)), ('player_season_bowling', (SELECT count(*) FROM sox)), ('points_table', (SELECT count(*) FROM pt)),
        ('venue_stats', (SELECT count(DISTINCT venue) FROM mt)), ('team_phase_stats', (SELECT count(DISTINCT (season, team, phase, p)) FROM
          (SELECT season, batting_team AS team, phase, 1 AS p FROM d WHERE NOT is_super_over UNION ALL SELECT season, bowling_team, phase, 2 FROM d WHERE NOT is_super_over))),
        ('head_to_head', (SELECT count(DISTINCT (least(f1, f2), greatest(f1, f2))) FROM mt WHERE m NOT IN (SELECT m FROM void)))) t("name", "rows")""",
    "dq_violation_counts": """SELECT * FROM (VALUES
        ('deliveries_runs_total_consistent', 'deliveries', 'error', (SELECT count(*) FROM d WHERE total <> hit + extras)),
        ('deliveries_extras_breakdown', 'deliveries', 'error', (SELECT count(*) FROM d WHERE extras <> wides + noballs + byes + legbyes + penalty)),
        ('deliveries_unique_key', 'deliveries', 'error', (SELECT count(*) FROM (SELECT 1 FROM d GROUP BY m, inn, over_index, delivery_seq HAVING count(*) > 1))),
        ('deliveries_max_six_legal_balls_per_over', 'deliveries', 'error', (SELECT count(*) FROM (SELECT 1 FROM d GROUP BY m, inn, over_index HAVING sum(is_legal::BIGINT) > 6 AND NOT bool_or(umpire_miscount)))),
        ('deliveries_belong_to_a_match', 'deliveries', 'error', (SELECT count(DISTINCT m) FROM d WHERE m NOT IN (SELECT m FROM mt))),
        ('innings_max_wickets', 'innings', 'error', (SELECT count(*) FROM i WHERE wickets > CASE WHEN is_super_over THEN 2 ELSE 10 END)),
        ('innings_runs_reconcile', 'innings', 'error', (SELECT count(*) FROM i JOIN (SELECT m, inn, sum(total) AS x FROM d GROUP BY ALL) USING (m, inn) WHERE x + penalty_runs_pre <> runs)),
        ('innings_chase_target_reconciles', 'innings', 'error', (SELECT count(*) FROM s JOIN f USING (m) WHERE m % 9 <> 0 AND s.target_balls = 120 AND s.target_runs <> f.runs + 1)),
        ('matches_unique_id', 'matches', 'error', (SELECT count(*) FROM (SELECT 1 FROM mt GROUP BY m HAVING count(*) > 1))),
        ('matches_winner_is_a_participant', 'matches', 'error', (SELECT count(*) FROM mt WHERE winner NOT IN (t1, t2))),
        ('matches_venue_mapped', 'matches', 'warn', (SELECT count(DISTINCT m % 25) FROM mt WHERE (m % 25) % 5 = 3)),
        ('matches_teams_mapped', 'matches', 'warn', (SELECT count(*) FROM mt WHERE 'T7' IN (t1, t2))),
        ('deliveries_ball_label_matches_source', 'deliveries', 'warn', 0),
        ('match_players_have_ids', 'match_players', 'warn', (SELECT count(*) FROM pl WHERE player_id IS NULL)),
        ('points_wins_equal_losses', 'points_table', 'error', (SELECT count(*) FROM (SELECT 1 FROM pt GROUP BY season HAVING sum(won) <> sum(lost)))),
        ('points_formula', 'points_table', 'error', (SELECT count(*) FROM pt WHERE points <> 2 * won + no_result OR played <> won + lost + no_result)),
        ('points_one_row_per_team', 'points_table', 'error', (SELECT count(*) FROM (SELECT 1 FROM pt GROUP BY season, team HAVING count(*) > 1))),
        ('points_positions_valid', 'points_table', 'error', (SELECT count(*) FROM (SELECT "position" AS p, count(*) OVER (PARTITION BY season) AS n FROM pt) WHERE p < 1 OR p > n)),
        ('batting_runs_reconcile', 'batting_scorecard', 'error', (SELECT count(*) FROM i JOIN (SELECT m, inn, sum(runs) AS x FROM bt GROUP BY ALL) USING (m, inn) WHERE x <> runs - extras)),
        ('bowler_wickets_within_team_wickets', 'bowling_scorecard', 'error', (SELECT count(*) FROM i JOIN (SELECT m, inn, sum(wickets) AS x FROM bw GROUP BY ALL) USING (m, inn) WHERE x > wickets)))
        t("check", "table", severity, violations)""",
    "dq_parent_reconcile": f"SELECT {_K} FROM i JOIN (SELECT m, inn, sum(runs) AS x FROM bt GROUP BY ALL) USING (m, inn) WHERE x <> runs - extras",
    "standings": 'SELECT "position", team, played, won, lost, tied, no_result, points, net_run_rate, "position" <= 4 AS highlight FROM pt WHERE season = 1998',
    "top_run_scorers": """SELECT player_id, player_name, runs, strike_rate, highest_score_text, fifties, hundreds FROM sbx WHERE season = 1998 ORDER BY runs DESC, strike_rate DESC NULLS LAST, player_name, player_id LIMIT 10""",
    "top_wicket_takers": """SELECT player_id, player_name, wickets, runs_conceded, economy, best_figures FROM sox WHERE season = 1998 AND wickets > 0 ORDER BY wickets DESC, economy NULLS FIRST, player_name, player_id LIMIT 10""",
    "recent_results": """SELECT match_id, match_date::VARCHAR AS match_date, stage, venue, result_text FROM sm WHERE season = 1998 ORDER BY sm.match_date DESC, m DESC LIMIT 10""",
    "champions": """SELECT season, match_date::VARCHAR AS match_date, venue, winner, result_text, player_of_match FROM sm WHERE stage = 'Final' QUALIFY row_number() OVER (PARTITION BY season ORDER BY sm.match_date DESC, m DESC) = 1""",
    "all_time_batting": """SELECT player_id, max(player_name) AS player_name, count(*) AS seasons, sum(innings)::BIGINT AS innings, sum(runs)::BIGINT AS runs, sum(balls)::BIGINT AS balls, sum(outs)::BIGINT AS outs,
        sum(fifties)::BIGINT AS fifties, sum(hundreds)::BIGINT AS hundreds, CASE WHEN sum(outs) > 0 THEN round(sum(runs)::BIGINT / sum(outs)::BIGINT + 1e-9, 2) END AS average,
        CASE WHEN sum(balls) > 0 THEN round(sum(runs)::BIGINT * 100 / sum(balls)::BIGINT + 1e-9, 2) END AS strike_rate FROM sbx GROUP BY player_id ORDER BY runs DESC, player_name, player_id LIMIT 10""",
    "all_time_bowling": """SELECT player_id, max(player_name) AS player_name, count(*) AS seasons, sum(wickets)::BIGINT AS wickets, sum(runs_conceded)::BIGINT AS runs_conceded, sum(balls)::BIGINT AS balls,
        CASE WHEN sum(balls) > 0 THEN round(sum(runs_conceded)::BIGINT * 6 / sum(balls)::BIGINT + 1e-9, 2) END AS economy, CASE WHEN sum(wickets) > 0 THEN round(sum(runs_conceded)::BIGINT / sum(wickets)::BIGINT + 1e-9, 2) END AS average
        FROM sox GROUP BY player_id ORDER BY wickets DESC, runs_conceded, player_name, player_id LIMIT 10""",
    "stream_scorecard": f"""SELECT {_K}, ball_runs AS runs, wickets, legal_balls, deliveries,
        ball_runs || '/' || wickets || ' (' || (legal_balls // 6) || '.' || (legal_balls % 6) || ')' AS score_text, last_event_id, 'completed' AS match_status FROM lv""",
    "dataset_summary": "SELECT count(*) AS matches, max(match_date)::VARCHAR AS as_of, min(season) AS first_season, max(season) AS last_season, count(DISTINCT season) AS seasons FROM mt",
}

ORACLE_SQL: dict[str, str] = {name: f"WITH {_SHAPE}\n{select}" for name, select in _SELECT.items()} | _WAREHOUSE
