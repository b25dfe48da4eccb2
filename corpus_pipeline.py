"""A corpus pipeline from operators of ``creaseline.llm``.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; its result is written as
Parquet and read again for the next one.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creaseline.llm import langid, mixing, packing, simhash, toxicity
from creaseline.llm.common import materialise, read

#: The toxic documents that go: those whose calibrated score is at least this.
TOXIC_SCORE = 0.5


def wrapped(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns next to the whole row as ``doc``, so that no other column's name can clash."""
    return docs.select(*columns, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below ``TOXIC_SCORE``.

    A null or empty text is scored as an empty one.  Repeated rows have equal scores and go or stay together; rows
    stay whatever their other columns hold, a null doc_id included.  Without labels of both kinds all have one score,
    the share of toxic labels.  Texts of any length are scored whole; no documents give none.
    """
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(wrapped(docs, "text"), model).where(F.col("_toxicity") < TOXIC_SCORE).select("doc.*")


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known with a score above the calibrated threshold.

    A text that is null or has no letter goes, and where no document has a label to learn from, all go.  Repeated rows
    go or stay together; other columns, a null doc_id included, do not count.  Texts of any length are read whole; no
    documents give none.
    """
    model = langid.fit(docs)
    return langid.languages(wrapped(docs, "text"), model).where(~F.col("_language.rejected")).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group, that with the least doc_id; of rows with equal doc_id in a group one stays.

    Null, empty and wordless texts are one group.  A null doc_id comes before others.  Of rows that tie in a group any
    one stays; they may differ in other columns.  Texts of any length are read whole; no documents give none.
    """
    # Rows get ids of their own, written once: a doc_id may stand on several rows, whose texts may differ.
    rows = materialise(wrapped(docs).withColumn("_row", F.monotonically_increasing_id()), "rows")
    groups = simhash.near_duplicates(rows.select(F.col("_row").alias("doc_id"), F.col("doc.text").alias("text")))
    members = groups.select(F.col("doc_id").alias("_member"), "component_id")
    owners = rows.select("_row", F.col("doc.doc_id").alias("_doc_id")).join(members, F.col("_row") == F.col("_member"))
    kept = owners.groupBy("component_id").agg(F.min_by("_row", F.struct("_doc_id", "_row")).alias("_kept"))
    return rows.join(kept, F.col("_row") == F.col("_kept"), "left_semi").select("doc.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture in its order: every document once, those of sources below their weight repeatedly.

    A null source is one of its own.  Rows with equal doc_id, or none, are rows of their own, in any order among
    themselves.  Texts are carried as they are, null or of any length; no documents give none.
    """
    return mixing.in_order(mixing.mix(wrapped(docs, "doc_id", "source"))).select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 1024 tokens: a row per piece, with its place.

    A null or empty text is the separator alone.  Each row, repeated ones and those without doc_id included, is a
    document of its own; pieces of one length may change places.  Longer texts are cut; no documents give no row.
    """
    return packing.packed_documents(docs, match_added=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: SQL can express neither the trained models nor the tokenizer; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies ``STAGES`` to ``documents``; the tables between stages go to the shared folder."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
