"""Raw match files: hash-versioned landing, the manifest of versions, and documents of chosen versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline import schemas
from creaseline.operators.keyed import latest_per_key, pending_versions


def latest_manifest(manifest: DataFrame) -> DataFrame:
    """The latest version of each match; of versions landed together the first by hash."""
    return latest_per_key(manifest, ["match_id"], [F.desc("ingested_at"), F.asc("sha256")])


def pending(manifest: DataFrame, held: DataFrame) -> DataFrame:
    """Latest versions that the matches table (match_id, source_sha256) does not hold."""
    have = held.select("match_id", F.col("source_sha256").alias("sha256"))
    return pending_versions(latest_manifest(manifest), have, ["match_id", "sha256"])


def problem(text: Column) -> Column:
    """Why a file is no match document, or null.  Bad JSON gives a problem, not an error."""
    doc = F.try_parse_json(text)
    part = lambda path, kind: F.try_variant_get(doc, path, kind)
    there = lambda path: part(path, "variant").isNotNull()
    missing = F.concat(
        *[F.when(~there(f"$.{k}"), f" {k}").otherwise("") for k in ("meta", "info", "innings")],
        *[F.when(there("$.info") & ~there(f"$.info.{k}"), f" info.{k}").otherwise("") for k in ("dates", "teams", "outcome", "season")],
    )
    return (
        F.when(doc.isNull(), "invalid JSON")
        .when(part("$", "map<string,variant>").isNull(), "document is not an object")
        .when(missing != "", F.concat(F.lit("missing:"), missing))
        .when(part("$.info.teams", "array<variant>").isNull() | (F.size(part("$.info.teams", "array<variant>")) != 2), "teams are not two")
        .when(part("$.innings", "array<variant>").isNull(), "innings is not a list")
    )


def classify(files: DataFrame, latest: DataFrame, key: str, content: str) -> DataFrame:
    """Adds ``sha256`` and ``change_type`` (new, changed, unchanged) against the latest known (key, sha256)."""
    hashed = files.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256))
    known = latest.select(F.col(key).alias("_key"), F.col("sha256").alias("_sha256"))
    change = F.when(F.col("_sha256").isNull(), "new").when(F.col("_sha256") == F.col("sha256"), "unchanged").otherwise("changed")
    return hashed.join(known, F.col(key) == F.col("_key"), "left").withColumn("change_type", change).drop("_key", "_sha256")


def land(spark: SparkSession, folder: str, manifest: DataFrame, bronze: str, run_id: str, source_url: str | None = None) -> DataFrame:
    """Lands ``folder`` of ``<digits>.json`` files: valid new versions as text rows below ``bronze``, others below
    ``bronze/quarantine``; returns the new manifest rows."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load(folder)
        .select(F.regexp_extract("path", r"(\d+)\.json$", 1).alias("match_id"), F.col("content").cast("string").alias("value"), F.col("length").alias("size_bytes"))
        .where("match_id <> ''")
    )
    marked = classify(files, latest_manifest(manifest), "match_id", "value").where("change_type <> 'unchanged'").withColumn("problem", problem(F.col("value")))
    target = lambda part: f"{bronze}/{part}/run_id={run_id}"
    keep = ["match_id", "sha256", "size_bytes", "change_type", "value"]
    marked.where("problem is not null").select(*keep, "problem").write.mode("overwrite").parquet(target("quarantine"))
    marked.where("problem is null").select(*keep).write.mode("overwrite").parquet(target("matches"))
    landed = spark.read.parquet(target("matches"))
    doc = F.from_json("value", schemas.MATCH)
    columns = {
        "bronze_path": F.lit(target("matches")), "data_version": doc["meta"]["data_version"], "season": F.year(F.to_date(F.get(doc["info"]["dates"], F.lit(0)))),
        "match_date": F.get(doc["info"]["dates"], F.lit(0)), "source_url": F.lit(source_url).cast("string"), "source_archive_sha256": F.lit(None).cast("string"),
        "source_last_modified": F.lit(None).cast("string"), "ingest_run_id": F.lit(run_id), "ingested_at": F.current_timestamp(),
    }
    names = [c.split()[0] for c in schemas.MANIFEST.replace("\n", " ").split(",")]
    return landed.withColumns(columns).select(*names)


def landed_documents(spark: SparkSession, bronze: str, wanted: DataFrame) -> DataFrame:
    """Documents of the wanted (match_id, sha256) versions, with their ``ingested_at`` as source_ingested_at if ``wanted`` has it.

    A value that breaks the schema stops the job.
    """
    version = ["match_id", "sha256"]
    times = [F.min("ingested_at").alias("source_ingested_at")] if "ingested_at" in wanted.columns else []
    once = wanted.groupBy(*version).agg(*times) if times else wanted.select(*version).distinct()
    rows = spark.read.parquet(f"{bronze}/matches").select(*version, "value").join(once, version).dropDuplicates(version)
    doc = F.from_json("value", schemas.MATCH, {"mode": "FAILFAST"})
    kept = ["source_ingested_at"] if times else []
    return rows.select("match_id", F.col("sha256").alias("source_sha256"), *kept, doc.alias("d")).select("match_id", "source_sha256", *kept, "d.*")


def read_documents(spark: SparkSession, paths: str | list[str], manifest: DataFrame | None = None) -> DataFrame:
    """Documents from ``match_id=<digits>/<64 hex>.json`` files with the declared schema; drift stops the job.

    With a manifest each version has the time at which it was ingested as source_ingested_at, null for unknown ones.
    """
    path = F.col("_metadata.file_path")
    found = (
        spark.read.schema(schemas.MATCH).option("multiLine", True).option("mode", "FAILFAST").json(paths)
        .withColumn("match_id", F.regexp_extract(path, r"match_id=(\d+)/", 1)).withColumn("source_sha256", F.regexp_extract(path, r"([0-9a-f]{64})\.json$", 1))
    )
    if manifest is None:
        return found
    times = manifest.groupBy("match_id", F.col("sha256").alias("source_sha256")).agg(F.min("ingested_at").alias("source_ingested_at"))
    return found.join(times, ["match_id", "source_sha256"], "left")


def read_register(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV register with header: people, teams, venues or adjustments, all strings."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_people(spark: SparkSession, path: str) -> DataFrame:
    """The people register; columns beyond the declared ones are ignored."""
    wanted = [c.split()[0] for c in schemas.PEOPLE.split(",")]
    return spark.read.option("header", True).csv(path).select(F.col("identifier").alias("player_id"), *wanted[1:])
