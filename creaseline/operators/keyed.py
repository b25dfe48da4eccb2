"""Keyed table operators for any DataFrame: latest versions, replacement, merges, first occurrences, comparison.

Each is a composition of joins, windows and unions on the given key columns; nothing is collected.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Inputs above this have no known size.
UNKNOWN = 2**50
#: Spark sums sorted groups through a hash table, and sorts large groups once more, unless this is on.
SORTED_GROUPS = "spark.sql.execution.replaceHashWithSortAgg"


def input_bytes(df: DataFrame) -> int | None:
    """Bytes of what a frame reads, by Spark's statistics of its sources; None where a source has none."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return size if size < UNKNOWN else None


def usual_parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def parts_for(df: DataFrame, part_bytes: int, least: int) -> int:
    """Into how many parts a frame goes if a part stands for so many bytes of input."""
    return max(least, -(-(input_bytes(df) or 0) // part_bytes))


def in_parts(df: DataFrame, key: str | Column, part_bytes: int) -> DataFrame:
    """Rows of a key in one part, of which there are more as the input grows, so that a task stays as large as it is.

    Windows, groups and explodes by the key, or by it and more, then move nothing.  A key that is computed need not move.
    """
    return to_parts(df, key, parts_for(df, part_bytes, usual_parts(df)))


def to_parts(df: DataFrame, key: str | Column, parts: int) -> DataFrame:
    """Rows of a key in one of so many parts, or of the usual number if that is more."""
    # Spark may put parts of the usual number together where they are small.
    return df.repartition(parts, key) if parts > usual_parts(df) else df.repartition(key)


def merged(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the input: it is sorted and merged with the other, never broadcast.

    Spark broadcasts a side by the bytes of its files, of which a row of short, repeated values takes less than one; the
    driver would then gather all rows.
    """
    return df.hint("merge")


@contextmanager
def sorted_groups(spark: SparkSession):
    """Within, groups whose rows arrive in the order of their keys are summed one after the other, without a hash table.

    Plans are made when a frame is run, so run it inside.
    """
    before = spark.conf.get(SORTED_GROUPS, "false")
    spark.conf.set(SORTED_GROUPS, "true")
    try:
        yield
    finally:
        spark.conf.set(SORTED_GROUPS, before)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``."""
    ranked = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_nth = 1").drop("_nth")


def dedupe_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by an aggregate over structs: map-side combined, no sort of the input."""
    first = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_row")).select("_row.*")


def pending_versions(current: DataFrame, held: DataFrame, version: list[str]) -> DataFrame:
    """Versions that ``held`` does not have yet."""
    return current.join(held.select(*version), version, "left_anti")


def replace_for_ids(existing: DataFrame, ids: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``existing`` with all rows of ``ids`` replaced by ``new``; an id without new rows disappears."""
    kept = existing.join(ids.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def merge_insert_only(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Adds source rows with new keys; rows already there stay as they are."""
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti"))


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows replace target rows with the same key and are added otherwise."""
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def merge_coalesce(target: DataFrame, source: DataFrame, key: str, newest: str) -> DataFrame:
    """One row a key: the source's value where it has one, else the target's; ``newest`` never goes back."""
    t, s = target.alias("t"), source.alias("s")
    value = lambda c: (
        F.greatest(f"s.{c}", f"t.{c}") if c == newest else F.coalesce(f"s.{c}", f"t.{c}")
    )
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    return joined.select(*[value(c).alias(c) for c in target.columns])


def semi(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key).distinct(), key, "left_semi")


def reconcile(expected: DataFrame, actual: DataFrame, keys: list[str], compared: list[str]) -> DataFrame:
    """A row per difference: keys, ``problem`` (missing, unexpected or a column's name), expected and actual value."""
    mark = F.lit(True)
    e = expected.select(*keys, *compared, mark.alias("_there")).alias("e")
    a = actual.select(*keys, *compared, mark.alias("_there")).alias("a")
    both = e.join(a, [F.col(f"e.{k}").eqNullSafe(F.col(f"a.{k}")) for k in keys], "full")
    text = lambda side, c: F.col(f"{side}.{c}").cast("string")
    problem = lambda name, x, y: F.struct(name.alias("problem"), x.alias("expected"), y.alias("actual"))
    none = F.lit(None).cast("string")
    differing = [
        F.when(~F.col(f"e.{c}").eqNullSafe(F.col(f"a.{c}")), problem(F.lit(c), text("e", c), text("a", c)))
        for c in compared
    ]
    found = (
        F.when(F.col("a._there").isNull(), F.array(problem(F.lit("missing"), none, none)))
        .when(F.col("e._there").isNull(), F.array(problem(F.lit("unexpected"), none, none)))
        .otherwise(F.filter(F.array(*differing), lambda p: p.isNotNull()))
    )
    named = [F.coalesce(f"e.{k}", f"a.{k}").alias(k) for k in keys]
    return both.select(*named, F.explode(found).alias("p")).select(*keys, "p.*")


def running(keys: list[str], order: list[str]):
    """The window from a group's first row to the current one."""
    return Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def first_appearance(df: DataFrame, group: list[str], member: str, order: list[str], name: str) -> DataFrame:
    """Members of each group numbered from 1 by where they first appear."""
    seen = df.groupBy(*group, member).agg(F.min(F.struct(*order)).alias("_first"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy("_first", member))
    return seen.withColumn(name, place).drop("_first")


def in_any_range(position: Column, ranges: Column, low: str, high: str) -> Column:
    """Whether ``position`` lies in one of an array of closed ranges; false without ranges."""
    return F.coalesce(F.exists(ranges, lambda r: position.between(r[low], r[high])), F.lit(False))
