"""Tables on a columnar path: scans, full refresh, partition-wise replacement, idempotent micro-batches.

``fmt`` is ``parquet``, or ``delta`` where its jar is on the class path.  A Parquet table never changes a file.  Each
write goes to a version folder of its own, and then a numbered pointer is renamed into place, which lists the folders
of all live partitions and the schema; the highest number is the table.  So a run that breaks off leaves the table as
it was, and a replacement carries over the folders of partitions that it does not touch.  The last pointer but one and
its files stay for readers that began before; older ones go.  A table has one writer at a time.

A write can stop in between: ``stage_*`` write the folders and count what is asked for in the same pass, the result
can be read and checked, and only :func:`publish` makes it the table.

Micro-batches come from an *app*, a query with a checkpoint of its own.  The pointer says how far each app has come,
so a repeated batch is known, and two apps on one table do not meet.  Folders of a partition are merged when they are
many, so that neither a pointer nor what a micro-batch lists grows with the history.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import date
from functools import reduce
from operator import and_, or_
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from creaseline.operators.keyed import replace_for_ids

#: Rows of a file; keeps files readable by one task without forcing a partition into one file.
FILE_ROWS = 5_000_000
POINTERS, VERSION = "_pointers", "_v"
#: Pointers that stay: the table and the state before it.
KEPT = 2
#: Folders of a partition that stand side by side before they are merged.
MERGE_AT = 8
#: Columns of micro-batches: the batch in the table, and in its files the pointer that first held the batch.
BATCH, COMMIT = "ingest_batch_id", "_commit"
#: Attempts of an append whose pointer another writer took.
ATTEMPTS = 5
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class Taken(OSError):
    """Another writer has published meanwhile."""


@dataclass(frozen=True)
class State:
    """What a pointer says.

    Of folders of micro-batches: which hold one batch of which app, from the first to the last pointer whose rows they
    hold, and how often their rows were merged.  Of each app its last batch and the pointer that first held it.
    """

    number: int
    schema: StructType
    folders: tuple[str, ...]
    batches: dict[str, list] = field(default_factory=dict)
    commits: dict[str, list[int]] = field(default_factory=dict)
    levels: dict[str, int] = field(default_factory=dict)
    last: dict[str, list[int]] = field(default_factory=dict)

    def text(self) -> str:
        of_folders = {n: {f: v for f, v in getattr(self, n).items() if f in self.folders} for n in ("batches", "commits", "levels")}
        return json.dumps({"schema": json.loads(self.schema.json()), "folders": self.folders, **of_folders, "last": self.last})


@dataclass(frozen=True)
class Staged:
    """A state that is written but not yet the table, what was counted while it was written, and all columns of its files."""

    spark: SparkSession
    path: str
    state: State
    written: tuple[str, ...]
    counts: dict[str, object] = field(default_factory=dict)
    whole: StructType | None = None


def _hadoop(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _hadoop(spark, path)
    return fs.exists(jvm_path)


def delete(spark: SparkSession, path: str) -> None:
    jvm_path, fs = _hadoop(spark, path)
    fs.delete(jvm_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, without a job."""
    jvm_path, fs = _hadoop(spark, path)
    stream = fs.open(jvm_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole: it is written aside and renamed.  An existing one is an error."""
    target, fs = _hadoop(spark, path)
    aside, _ = _hadoop(spark, f"{target.getParent()}/_aside-{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    stream = fs.create(aside)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise Taken(f"{path} is there already")


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    jvm_path, fs = _hadoop(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(jvm_path) or [])


def _pointers(spark: SparkSession, path: str) -> list[str]:
    """Pointers from the oldest to the newest."""
    return _matching(spark, f"{path}/{POINTERS}/n*")


def _load(spark: SparkSession, pointer: str) -> State:
    found = json.loads(read_text(spark, pointer))
    number = int(pointer.rpartition("/n")[2])
    return State(number, **found | {"schema": StructType.fromJson(found["schema"]), "folders": tuple(found["folders"])})


def current(spark: SparkSession, path: str) -> str | None:
    """The pointer of a table's current state, or None without one."""
    found = _pointers(spark, path)
    return found[-1] if found else None


def state(spark: SparkSession, path: str) -> State | None:
    pointer = current(spark, path)
    return _load(spark, pointer) if pointer else None


def _scan(spark: SparkSession, path: str, schema: StructType, folders: Sequence[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema).limit(0)  # Spark sees that it is empty, and leaves out joins with it
    return spark.read.schema(schema).option("basePath", path).parquet(*[f"{path}/{f}" for f in folders])


def _rows(spark: SparkSession, path: str, found: State, folders: Sequence[str] | None = None) -> DataFrame:
    names = [F.col(f"`{c}`") for c in found.schema.names]
    return _scan(spark, path, found.schema, found.folders if folders is None else folders).select(*names)


def partition_values(folder: str) -> dict[str, str | None]:
    """Partition columns of a folder with their values as text."""
    pairs = [part.split("=", 1) for part in folder.split("/")[1:]]
    return {unquote(k): None if v == NULL_PARTITION else unquote(v) for k, v in pairs}


def within(folders: Sequence[str], values: Sequence[dict]) -> list[str]:
    """The folders whose partitions are among ``values``, column to value; all of them where values have no plain text."""
    known = (str, int, bool, date, type(None))

    def text(value) -> str | None:
        return str(value).lower() if isinstance(value, bool) else None if value in (None, "") else str(value)

    if not all(type(v) in known for row in values for v in row.values()):
        return list(folders)
    wanted = {tuple(sorted((k, text(v)) for k, v in row.items())) for row in values}
    columns = {k for row in values for k in row}
    return [f for f in folders if tuple(sorted((k, v) for k, v in partition_values(f).items() if k in columns)) in wanted]


def read(spark: SparkSession, path: str, fmt: str = "parquet", only: Sequence[dict] | None = None) -> DataFrame:
    """The table; with ``only``, values of partition columns, the folders of other partitions are not even listed."""
    found = state(spark, path) if fmt != "delta" else None
    if found is None:
        return spark.read.format(fmt).load(path)
    return _rows(spark, path, found, None if only is None else within(found.folders, only))


def _publish(spark: SparkSession, path: str, new: State) -> None:
    """Makes a state the table: the pointer is written aside and renamed, so a reader sees the old or the new."""
    before = _pointers(spark, path)
    if before and int(before[-1].rpartition("/n")[2]) >= new.number:
        raise Taken(f"can't publish pointer {new.number} of {path}")
    target, _ = _hadoop(spark, f"{path}/{POINTERS}/n{new.number:012d}")
    write_text(spark, str(target), new.text())
    _forget(spark, path, before[: len(before) + 1 - KEPT], [*before[len(before) + 1 - KEPT :], str(target)])


def _forget(spark: SparkSession, path: str, old: list[str], kept: list[str]) -> None:
    """Deletes old pointers and the folders that only they name."""
    if not old:
        return
    live = {f for p in kept for f in _load(spark, p).folders}
    versions = {f.split("/")[0] for f in live}
    for pointer in old:
        gone = set(_load(spark, pointer).folders) - live
        # A version goes whole once none of its partitions is live.
        for folder in {f if f.split("/")[0] in versions else f.split("/")[0] for f in gone}:
            delete(spark, f"{path}/{folder}")
        delete(spark, pointer)


def publish(staged: Staged) -> None:
    """Makes a staged state the table."""
    _publish(staged.spark, staged.path, staged.state)


def abandon(staged: Staged) -> None:
    """Deletes what was staged; the table stays as it is."""
    for version in {f.split("/")[0] for f in staged.written}:
        delete(staged.spark, f"{staged.path}/{version}")


def staged_rows(staged: Staged) -> DataFrame:
    """The table as it would be."""
    return _rows(staged.spark, staged.path, staged.state)


def written_rows(staged: Staged) -> DataFrame:
    """What was written now, with the columns that the table hides."""
    names = [F.col(f"`{c}`") for c in staged.whole.names]
    return _scan(staged.spark, staged.path, staged.whole, staged.written).select(*names)


def _store(df: DataFrame, path: str, partition_by: Sequence[str]) -> list[str]:
    """Writes a version folder; the folders of its partitions."""
    spark, version = df.sparkSession, f"{VERSION}={uuid.uuid4().hex}"
    writer = df.write.option("maxRecordsPerFile", FILE_ROWS)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{version}")
    if not partition_by:
        return [version]
    found = _matching(spark, f"{path}/{version}" + "/*=*" * len(partition_by))
    if not found:
        delete(spark, f"{path}/{version}")  # no rows
    return [version + f.rpartition(f"/{version}")[2] for f in found]


def _spread(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition value meet in as few tasks as their size asks for."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def _counted(df: DataFrame, path: str, partition_by: Sequence[str], counts: dict[str, Column] | None, spread: bool = True) -> tuple[list[str], dict]:
    """Writes the rows, spread or where they are, and evaluates aggregates over them on the way.

    The aggregates stand in the last stage, whose tasks count once even if they or earlier stages run again.
    """
    rows = _spread(df, partition_by) if spread else df
    if not counts:
        return _store(rows, path, partition_by), {}
    seen = Observation()
    folders = _store(rows.observe(seen, *[c.alias(n) for n, c in counts.items()]), path, partition_by)
    return folders, dict(seen.get)


def _next(before: State | None) -> int:
    return before.number + 1 if before else 1


def _stage(
    before: State | None, kept: Sequence[str], df: DataFrame, path: str, partition_by: Sequence[str], counts: dict[str, Column] | None, hidden: Sequence[str],
    spread: bool = True,
) -> Staged:
    folders, found = _counted(df, path, partition_by, counts, spread)
    new = State(_next(before), df.drop(*hidden).schema, (*kept, *folders))
    return Staged(df.sparkSession, path, new, tuple(folders), found, df.schema)


def stage_overwrite(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), counts: dict[str, Column] | None = None, hidden: Sequence[str] = (), spread: bool = True
) -> Staged:
    """A full refresh to be published; ``hidden`` columns are in the files but not in the table.

    Rows whose tasks hold few partition values each already are written where they are, without ``spread``.
    """
    return _stage(state(df.sparkSession, path), (), df, path, partition_by, counts, hidden, spread)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Full refresh.  Rows of a partition value meet in as few files as their size allows, not in one."""
    if fmt == "delta":
        writer = df.write.format("delta").mode("overwrite").option("overwriteSchema", "true")
        (writer.partitionBy(*partition_by) if partition_by else writer).save(path)
        return
    publish(stage_overwrite(df, path, partition_by))


def _equals(values: dict) -> Column:
    return reduce(and_, [F.col(f"`{name}`").eqNullSafe(F.lit(value)) for name, value in values.items()])


def _inside(depth: int) -> Column:
    """The folder of a row's file as ``_in``, for a table of so many partition columns."""
    return F.regexp_extract("_metadata.file_path", f"/({VERSION}=[^/]*" + "/[^/]*=[^/]*" * depth + ")/[^/]*$", 1).alias("_in")


def _names(rows: DataFrame) -> set[str]:
    """The folders in ``_in``: at most a row for each partition.  file_path is a URI, whose signs are encoded once more."""
    return {unquote(r[0]) for r in rows.select("_in").distinct().collect()}


def _crowded(folders: Sequence[str], least: int = MERGE_AT) -> dict[str, list[str]]:
    """Partitions with many folders, and these."""
    found: dict[str, list[str]] = {}
    for folder in folders:
        found.setdefault(folder.partition("/")[2], []).append(folder)
    return {p: f for p, f in found.items() if len(f) >= least}


def stage_replace_partitions(
    spark: SparkSession, new: DataFrame, values: Sequence[dict], path: str, partition_by: Sequence[str], counts: dict[str, Column] | None = None
) -> Staged:
    before = state(spark, path)
    named = reduce(or_, [_equals(value) for value in values], F.lit(False))
    near = within(before.folders, values) if values else []
    touched = _names(_scan(spark, path, before.schema, near).where(named).select(_inside(len(partition_by)))) if near else set()
    kept = [f for f in before.folders if f not in touched]
    return _stage(before, kept, new.where(named), path, partition_by, counts, ())


def replace_partitions(spark: SparkSession, new: DataFrame, values: Sequence[dict], path: str, partition_by: Sequence[str]) -> None:
    """Replaces the partitions of ``values``, column to value, by the rows of ``new`` in them; the others keep their files.

    A partition without new rows goes.  A null value names the partition of nulls.  The table must exist.
    """
    publish(stage_replace_partitions(spark, new, values, path, partition_by))


def stage_replace_ids(
    spark: SparkSession, new: DataFrame, ids: DataFrame, path: str, key: str, partition_by: Sequence[str] = (), counts: dict[str, Column] | None = None,
    hidden: Sequence[str] = (),
) -> Staged:
    before = state(spark, path)
    if before is None:
        return stage_overwrite(new, path, partition_by, counts, hidden)
    near, keys = list(before.folders), [key, *[c for c in partition_by if c in ids.columns]]
    values = None
    if len(keys) > 1:
        # As many values as there are touched partitions; folders of others are not listed.
        values = [row.asDict() for row in ids.select(*keys[1:]).distinct().collect()]
        near = within(near, values)
    touched: set[str] = set()
    if near:
        held = _scan(spark, path, before.schema, near)
        if values is not None:
            held = held.where(reduce(or_, [_equals(v) for v in values], F.lit(False)))
        touched = _names(held.select(*keys, _inside(len(partition_by))).join(ids.select(*keys).distinct(), keys, "left_semi"))
    # A partition whose folders became many is written again as one.
    touched |= {f for folders in _crowded(near).values() for f in folders}
    kept = [f for f in before.folders if f not in touched]
    again = _rows(spark, path, before, [f for f in before.folders if f in touched])
    return _stage(before, kept, replace_for_ids(again, ids, new, key), path, partition_by, counts, hidden)


def replace_ids(spark: SparkSession, new: DataFrame, ids: DataFrame, path: str, key: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Replaces all rows of ``ids`` in a table, also of ids that now have no rows; makes the table if it is missing.

    Only partitions that hold rows of ``ids`` are written again; the others keep their files, and new rows of a
    partition stand beside them until its folders are ``MERGE_AT``.  If ``ids`` has the partition columns as well, an
    id's rows are looked for there only.
    """
    if fmt == "delta":
        there = exists(spark, path)
        overwrite(replace_for_ids(read(spark, path, fmt), ids, new, key) if there else new, path, partition_by, fmt)
        return
    publish(stage_replace_ids(spark, new, ids, path, key, partition_by))


def app_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the query with that checkpoint: it stays with the folder, and a fresh checkpoint gets a new one."""
    marker = f"{checkpoint}/_app"
    if not exists(spark, marker):
        write_text(spark, marker, uuid.uuid4().hex)
    return read_text(spark, marker)


def ensure(spark: SparkSession, path: str, schema: StructType) -> None:
    """An empty table for micro-batches, if there is none."""
    if current(spark, path) is None:
        publish(Staged(spark, path, State(1, StructType([*schema, *([] if BATCH in schema.names else [StructField(BATCH, LongType())])]), ()), ()))


def committed(spark: SparkSession, path: str, batch_id: int, app: str = "") -> bool:
    """Whether the table holds that batch of the app."""
    found = state(spark, path)
    return found is not None and app in found.last and batch_id <= found.last[app][0]


def batch_alone(spark: SparkSession, path: str, batch_id: int, app: str, only: Sequence[dict]) -> DataFrame | None:
    """The rows of some partitions if that batch of the app brought all of them, else None."""
    found = state(spark, path)
    near = within(found.folders, only)
    return _rows(spark, path, found, near) if all(found.batches.get(f) == [app, batch_id] for f in near) else None


def between(spark: SparkSession, path: str, after: int, up_to: int) -> DataFrame:
    """The rows of micro-batches that pointers after ``after`` and up to ``up_to`` brought, from the folders that are live now."""
    found = state(spark, path)
    near = [f for f in found.folders if found.commits[f][1] > after and found.commits[f][0] <= up_to]
    rows = _scan(spark, path, StructType([*found.schema, StructField(COMMIT, LongType())]), near)
    return rows.where((F.col(COMMIT) > after) & (F.col(COMMIT) <= up_to)).select(*[F.col(f"`{c}`") for c in found.schema.names])


def append_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (), app: str = "", replay: str = "skip") -> bool:
    """Adds a micro-batch of an app, once; whether it was written.  Batches of an app come in ascending order.

    A batch that the table holds is skipped whole, whatever its rows are now, or with ``replay="replace"`` replaced
    whole, in all partitions; only the app's last batch can be replaced.  Another app's batch of the same number is
    another batch.  A run that breaks off leaves the table as it was.  Other writers may append meanwhile.
    """
    if replay not in ("skip", "replace"):
        raise ValueError(f"replay is skip or replace, not {replay}")
    spark = df.sparkSession
    for attempt in range(ATTEMPTS):
        before = state(spark, path)
        last = before.last[app][0] if before and app in before.last else None
        if last is not None and batch_id <= last:
            if replay == "skip":
                return False
            if batch_id < last:
                raise ValueError(f"batch {batch_id} is closed, the last one is {last}")
        staged = _stage_batch(df, path, batch_id, partition_by, app, before)
        try:
            publish(staged)
            return True
        except Taken:
            abandon(staged)
            if attempt == ATTEMPTS - 1:
                raise
    return False


def _stage_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str], app: str, before: State | None) -> Staged:
    spark, number = df.sparkSession, _next(before)
    before = before or State(0, StructType(), ())
    again = [f for f in before.folders if before.batches.get(f) == [app, batch_id]]
    last = before.last.get(app)
    # A batch keeps the pointer that first held it, so a stream that has seen it does not see it again.
    commit = last[1] if last and last[0] == batch_id else number
    rows = df.drop(BATCH).withColumn(BATCH, F.lit(batch_id).cast("bigint"))
    schema = StructType([*before.schema, *[f for f in rows.schema if f.name not in before.schema.names]])
    written = _store(_spread(rows.withColumn(COMMIT, F.lit(commit).cast("bigint")), partition_by), path, partition_by)
    batches, levels = before.batches | {f: [app, batch_id] for f in written}, dict(before.levels)
    commits = before.commits | {f: [commit, commit] for f in written}
    ends = before.last | {app: [batch_id, commit]}
    live = [f for f in before.folders if f not in again] + written
    # An app repeats its last batch only, so earlier ones can be merged.  Folders are merged with those that were merged
    # as often: a row is written again once for each power of MERGE_AT, and a partition has MERGE_AT folders for each.
    touched = {f.partition("/")[2] for f in written}
    closed = [f for f in live if f.partition("/")[2] in touched and (f not in batches or batches[f][1] < ends[batches[f][0]][0])]
    tiers = [_crowded([f for f in closed if levels.get(f, 0) == n]) for n in sorted({levels.get(f, 0) for f in closed})]
    for tier in tiers:
        whole = StructType([*schema, StructField(COMMIT, LongType())])
        old = [f for folders in tier.values() for f in folders]
        if not old:
            continue
        merged = _store(_spread(_scan(spark, path, whole, old).select(*[F.col(f"`{c}`") for c in whole.names]), partition_by), path, partition_by)
        for folder in merged:
            parts = tier[folder.partition("/")[2]]
            commits[folder] = [min(commits[f][0] for f in parts), max(commits[f][1] for f in parts)]
            levels[folder] = levels.get(parts[0], 0) + 1
        live, written = [f for f in live if f not in old] + merged, written + merged
    new = replace(before, number=number, schema=schema, folders=tuple(live), batches=batches, commits=commits, levels=levels, last=ends)
    return Staged(spark, path, new, tuple(written))


def views(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Every table as a temporary view, for ad-hoc ``spark.sql``."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
