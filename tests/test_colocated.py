"""Tables in buckets of a key: what Spark moves, and who learns of the buckets; times at which documents were ingested."""

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import documents as written  # noqa: E402

from creaseline import schemas  # noqa: E402
from creaseline.plans import batch, marts, silver  # noqa: E402
from creaseline.sources import colocated, landing, tables  # noqa: E402


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(frame):
    return [line.strip() for line in frame._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange" in line]


def test_batting_scorecard_moves_nothing(spark, tmp_path, no_broadcast):
    docs = {i: doc for i, doc in enumerate([written.plain(), written.revised(), written.tie_with_super_over(), written.nine_and_absent()])}
    none = [spark.createDataFrame([], s) for s in (schemas.VENUES, schemas.TEAMS)]
    built = silver.build(written.frame(spark, docs), *none)
    expected = sorted(map(str, marts.scorecards(built)["batting_scorecard"].collect()))
    for name in ("deliveries", "wickets", "match_players"):
        colocated.store(built[name], f"{tmp_path}/{name}", "match_id", 4)
    stored = {name: colocated.load(spark, f"{tmp_path}/{name}") for name in ("deliveries", "wickets", "match_players")}
    assert stored["deliveries"].schema.names == built["deliveries"].schema.names
    with colocated.by_part_of_keys(spark):
        card = marts.scorecards(stored)["batting_scorecard"]
        assert exchanges(card) == []
        assert sorted(map(str, card.select(*marts.scorecards(built)["batting_scorecard"].columns).collect())) == expected
    assert spark.conf.get(colocated.ALL_KEYS, "true") == "true"
    assert len(exchanges(marts.scorecards(built)["batting_scorecard"])) > 2


def test_tables_of_one_key_join_in_place(spark, tmp_path, no_broadcast):
    left, right = spark.range(1000).selectExpr("id % 97 as k", "id as a"), spark.range(50).selectExpr("id as k", "id * 2 as b")
    colocated.store(left, f"{tmp_path}/l", "k", 6)
    colocated.store(right, f"{tmp_path}/r", "k", 6)
    joined = colocated.load(spark, f"{tmp_path}/l").join(colocated.load(spark, f"{tmp_path}/r"), "k")
    assert exchanges(joined) == []
    assert joined.agg(F.count("*"), F.sum("b")).first() == left.join(right, "k").agg(F.count("*"), F.sum("b")).first()
    # Another session learns of the buckets from the note.
    other = spark.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    assert exchanges(colocated.load(other, f"{tmp_path}/l").groupBy("k").count()) == []
    with pytest.raises(Exception, match="_buckets"):
        colocated.load(spark, str(tmp_path / "nothing"))


def test_matches_know_when_they_were_ingested(spark, tmp_path):
    incoming, bronze, root = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "lake")
    incoming.mkdir()
    for k, doc in ((1, written.plain()), (2, written.revised())):
        (incoming / f"{k}.json").write_text(json.dumps(doc))
    manifest = landing.land(spark, str(incoming), spark.createDataFrame([], schemas.MANIFEST), bronze, "r1").cache()
    none = [spark.createDataFrame([], s) for s in (schemas.VENUES, schemas.TEAMS, schemas.ADJUSTMENTS)]
    batch.refresh(spark, manifest, bronze, *none, root)
    expected = {(r.match_id, r.sha256, r.ingested_at) for r in manifest.collect()}
    got = {(r.match_id, r.source_sha256, r.source_ingested_at) for r in tables.read(spark, f"{root}/silver/matches").collect()}
    assert got == expected and None not in {t for _, _, t in got}
    # From files as well, where the manifest has the version.
    sha = manifest.where("match_id = '1'").first()
    folder = tmp_path / "b" / "match_id=1"
    folder.mkdir(parents=True)
    (folder / f"{sha.sha256}.json").write_text(json.dumps(written.plain()))
    (folder / f"{'0' * 64}.json").write_text(json.dumps(written.plain()))
    docs = landing.read_documents(spark, f"{tmp_path}/b/*/*.json", manifest).collect()
    assert {r.source_sha256: r.source_ingested_at for r in docs} == {sha.sha256: sha.ingested_at, "0" * 64: None}
