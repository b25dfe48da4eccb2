"""Match documents shaped from the warehouse tables, so that every dataflow runs on data whose size grows with them.

Orders of lineitem become matches (forty orders each), lines become balls.  The result has the declared document
schema; the conformed tables are then built from it exactly as from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creaseline.operators.keyed import in_parts, parts_for

#: Bytes of lineitem and of document files that make a part, some 300,000 balls each.
LINE_BYTES, DOCUMENT_BYTES = 4 << 20, 2 << 20
# Fixed values of the shape.
OVER_SIZE = "if(m % 50 = 7, 7, 6)"
KINDS = ("bowled", "caught", "caught and bowled", "lbw", "stumped", "hit wicket", "run out", "retired hurt", "obstructing the field")
#: All columns of lineitem: the only total order, since no smaller key is unique.
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def buckets(spark: SparkSession, sf_dir: str, least: int) -> int:
    """In how many buckets of their match documents go, so that a bucket stays as large as it is."""
    return parts_for(table(spark, sf_dir, "lineitem"), LINE_BYTES, least)


def lines(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """Balls with their match, innings and place; a match in fifty has overs of seven balls, and super overs occur.

    Lines move once, as they are, to their match, in so many parts or as many as are usual; nothing that is built from
    them moves again.
    """
    match = "l_orderkey div 40"
    match_id = f"cast({match} as string)"
    whole = table(spark, sf_dir, "lineitem")
    moved = whole.repartition(parts, F.expr(match_id)) if parts else in_parts(whole, F.expr(match_id), LINE_BYTES)
    raw = moved.selectExpr(
        f"{match_id} as match_id", f"{match} as m", "l_partkey as pk", "l_suppkey as sk", "cast(l_quantity as bigint) as q", "l_returnflag as rf",
        f"case when ({match}) % 37 = 5 and l_linenumber = 7 then 3 else 1 + (l_orderkey div 20) % 2 end as inn", *LINE_ORDER,
    )
    place = F.row_number().over(Window.partitionBy("match_id", "inn").orderBy(*LINE_ORDER)) - 1
    size = F.expr(OVER_SIZE)
    return raw.withColumn("at", place).select(
        "match_id", "m", "inn", "pk", "sk", "q", "rf", F.floor(F.col("at") / size).alias("over"), (F.col("at") % size + 1).alias("seq"),
        F.concat(F.lit("T"), F.expr("m % 8")).alias("t1"),
        F.concat(F.lit("T"), F.expr("case when (m * 3 + 1) % 8 = m % 8 then (m * 3 + 2) % 8 else (m * 3 + 1) % 8 end")).alias("t2"),
    )


def _balls(rows: DataFrame) -> DataFrame:
    wide, noball = "rf = 'R' and pk % 5 = 0", "pk % 17 = 0 and not (rf = 'R' and pk % 5 = 0)"
    clean = f"not ({wide}) and not ({noball})"
    extras = {
        "wides": f"if({wide}, 1, 0)", "noballs": f"if({noball}, 1, 0)", "byes": f"if({clean} and sk % 19 = 0, 1, 0)",
        "legbyes": f"if({clean} and sk % 19 <> 0 and sk % 23 = 0, 1, 0)", "penalty": "if(pk % 997 = 0, 5, 0)",
    }
    kinds = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    sides = rows.selectExpr(
        "*", "if(inn = 1, t1, t2) as bat", "if(inn = 1, t2, t1) as bowl", f"if({wide}, 0, q % 7) as hit", *[f"{e} as {n}" for n, e in extras.items()]
    )
    named = sides.selectExpr(
        "*", "wides + noballs + byes + legbyes + penalty as extra", "concat(bat, '-b', sk % 11) as striker",
        "concat(bat, '-b', (sk % 11 + 1 + pk % 10) % 11) as other", "concat(bowl, '-p', (over + m + if(pk % 101 = 0, 1, 0)) % 6) as bowler",
        f"element_at({kinds}, cast(sk % 9 + 1 as int)) as kind",
    )
    fielders = "if(kind = 'caught', array(named_struct('name', concat(bowl, '-p', sk % 6), 'substitute', sk % 5 = 0)), null)"
    first = f"named_struct('player_out', if(kind = 'run out' and pk % 2 = 0, other, striker), 'kind', kind, 'fielders', {fielders})"
    second = "named_struct('player_out', other, 'kind', 'run out', 'fielders', cast(null as array<struct<name:string,substitute:boolean>>))"
    ball = f"""named_struct(
      'actual_delivery', cast(null as string), 'batter', striker, 'bowler', bowler, 'non_striker', other,
      'runs', named_struct('batter', hit, 'extras', cast(extra as bigint), 'total', hit + extra, 'non_boundary', if(hit = 4 and pk % 10 = 0, true, null)),
      'extras', named_struct({", ".join(f"'{n}', cast(nullif({n}, 0) as bigint)" for n in extras)}),
      'wickets', case when pk % 169 = 0 then array({first}, {second}) when pk % 13 = 0 then array({first}) end,
      'review', if(pk % 97 = 0, named_struct('by', bowl, 'umpire', 'U1', 'batter', striker, 'decision', if(sk % 2 = 0, 'struck down', 'upheld'), 'umpires_call', sk % 4 = 0, 'type', 'wicket'), null),
      'replacements', if(pk % 211 = 0, named_struct('match', array(named_struct('in', concat(bat, '-b10'), 'out', striker, 'team', bat,
        'reason', if(sk % 2 = 0, 'impact_player', 'concussion_substitute'))), 'role', cast(null as array<struct<`in`:string,`out`:string,reason:string,role:string>>)), null))"""
    return named.selectExpr("match_id", "m", "inn", "over", "seq", "t1", "t2", "bat", "hit + extra as total", "pk % 13 = 0 and kind <> 'retired hurt' as w1", "pk % 169 = 0 as w2", f"{ball} as d")


def documents(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    """One document per match, with ``match_id``; balls, overs and innings are nested in their order.

    Balls are collected once, by match; innings and overs, which lie one after the other there, are cut from that.
    """
    collected = _balls(lines(spark, sf_dir, parts)).groupBy("match_id").agg(
        *[F.first(c).alias(c) for c in ("m", "t1", "t2")],
        F.sort_array(F.collect_list(F.struct("inn", "over", "seq", "bat", "d"))).alias("b"),
        F.expr("sum(if(inn = 1, total, null)) + if(first(m) % 53 = 0, 5, 0) as r1"), F.expr("sum(if(inn = 2, total, null)) as r2"),
        F.expr("sum(if(inn = 2, cast(w1 as int) + cast(w2 as int), null)) as w2"),
    )
    opened = "transform(filter(transform(array(1, 2, 3), n -> filter(b, x -> x.inn = n)), a -> size(a) > 0), a -> named_struct('inn', a[0].inn, 'bat', a[0].bat, 'ds', a.d))"
    over = f"named_struct('over', o, 'deliveries', slice(x.ds, cast(o as int) * {OVER_SIZE} + 1, {OVER_SIZE}))"
    overs = f"transform(sequence(0L, cast((size(x.ds) - 1) div {OVER_SIZE} as bigint)), o -> {over})"
    by_match = collected.selectExpr("match_id", "m", "t1", "t2", "r1", "r2", "w2", f"{opened} as a").selectExpr(
        "match_id", "m", "t1", "t2", "r1", "r2", "w2", f"transform(a, x -> named_struct('inn', x.inn, 'bat', x.bat, 'overs', {overs})) as i"
    )
    target = "case when x.inn = 2 and m % 9 = 0 then named_struct('overs', 15.0D, 'runs', 150L) when x.inn = 2 then named_struct('overs', 20.0D, 'runs', r1 + 1) end"
    innings = f"""transform(i, x -> named_struct(
      'team', x.bat, 'overs', x.overs,
      'powerplays', if(x.inn < 3, array(named_struct('from', 0.1D, 'to', 5.6D, 'type', 'mandatory'), named_struct('from', 15.1D, 'to', 16.6D, 'type', 'batting')), null),
      'target', {target}, 'super_over', if(x.inn = 3, true, null), 'absent_hurt', if(m % 41 = 0 and x.inn = 2, array(concat(x.bat, '-b10')), null),
      'penalty_runs', if(m % 53 = 0 and x.inn = 1, named_struct('pre', 5L, 'post', cast(null as bigint)), null), 'declared', cast(null as boolean), 'forfeited', cast(null as boolean),
      'miscounted_overs', if(m % 100 = 7 and x.inn = 1, map('2', named_struct('balls', 7L, 'umpire', 'U2')), null)))"""
    names = lambda team: f"transform(sequence(0, 16), k -> concat({team}, if(k < 11, concat('-b', k), concat('-p', k - 11))))"
    settled, open_ = "r1 is not null and r2 is not null and r1 <> r2 and m % 23 <> 0", "m % 23 = 0 or r1 is null or r2 is null"
    info = f"""named_struct(
      'balls_per_over', 6L, 'city', concat('city-', m % 25), 'dates', array(cast(date_add(make_date(cast(1995 + m % 7 as int), 4, 1), cast(m % 60 as int)) as string)),
      'event', named_struct('name', 'Cup', 'match_number', m, 'stage', case when m % 24 = 23 then 'Final' when m % 12 = 11 then 'Qualifier' end, 'group', cast(null as string)),
      'gender', 'x', 'match_type', 'T20', 'match_type_number', m,
      'officials', if(m % 3 = 0, named_struct('umpires', array('U1', 'U2'), 'tv_umpires', array('U3'), 'match_referees', array('R1'), 'reserve_umpires', cast(null as array<string>)), null),
      'outcome', named_struct('winner', case when {settled} then if(r1 > r2, t1, t2) end,
        'by', case when {settled} then named_struct('runs', if(r1 > r2, r1 - r2, null), 'wickets', if(r2 > r1, greatest(10 - w2, 1L), null), 'innings', cast(null as bigint)) end,
        'result', case when {open_} then 'no result' when r1 = r2 then 'tie' end, 'method', if(m % 9 = 0, 'D/L', null),
        'eliminator', case when not ({open_}) and r1 = r2 and m % 2 = 0 then t1 end, 'bowl_out', cast(null as string)),
      'overs', 20L, 'player_of_match', if(m % 5 = 0, null, array(concat(t1, '-b', m % 11))), 'players', map(t1, {names("t1")}, t2, {names("t2")}),
      'registry', named_struct('people', map_from_arrays(filter(concat({names("t1")}, {names("t2")}), n -> n not like '%-b10'),
        transform(filter(concat({names("t1")}, {names("t2")}), n -> n not like '%-b10'), n -> concat('id-', n)))),
      'season', cast(1995 + m % 7 as string), 'team_type', 'club', 'teams', array(t1, t2),
      'toss', named_struct('decision', if(m % 2 = 0, 'field', 'bat'), 'winner', if(m % 3 < 2, t1, t2)), 'venue', concat('ground-', m % 25))"""
    meta = "named_struct('data_version', '1.0.0', 'created', '2024-01-01', 'revision', 1L)"
    return by_match.selectExpr("match_id", f"{meta} as meta", f"{info} as info", f"{innings} as innings")


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as grounds; every fifth is missing from the register."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.where("n_nationkey % 5 <> 3").join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "concat('ground-', n_nationkey) as venue_raw", "n_name as venue", "r_name as city", "'land' as country")


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Team names that nations give: two teams share a franchise and one is missing."""
    nation = table(spark, sf_dir, "nation").where("n_nationkey < 7")
    return nation.selectExpr("concat('T', n_nationkey) as team", "concat('F', if(n_nationkey = 6, 0, n_nationkey)) as franchise")


def adjustments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 29th match is void; customers whose key leaves 1 by 31 stand for fixtures abandoned without a ball."""
    matches = table(spark, sf_dir, "orders").selectExpr("o_orderkey div 40 as m").distinct().where("m % 29 = 0")
    void = matches.selectExpr("cast(m as string) as match_id", "cast(1995 + m % 7 as string) as season", "'x' as team1", "'x' as team2", "'void' as adjustment")
    absent = table(spark, sf_dir, "customer").where("c_custkey % 31 = 1").selectExpr(
        "concat('c', c_custkey) as match_id", "cast(1995 + c_custkey % 7 as string) as season", "concat('T', c_custkey % 8) as team1",
        "concat('T', (c_custkey + 3) % 8) as team2", "'abandoned_no_ball' as adjustment")
    return void.unionByName(absent)
