"""A table of micro-batches as a stream: every committed batch once, whatever is replayed, replaced or merged meanwhile.

The offset is the number of a pointer (see ``sources.tables``).  A micro-batch from pointer ``a`` to ``b`` reads, from
the folders that are live when it is planned, the rows that pointers after ``a`` and up to ``b`` brought.  Rows carry that
number, so merging folders neither hides nor repeats them; a batch that is written again keeps the number that it
had, so who has seen it does not see it again; folders that no pointer names, left by a run that broke off, are never
seen.  Superseded files stay until the next pointer but one, and a micro-batch that loses its files is planned anew.

Pointers and files are read with ``pyarrow.fs`` (local, HDFS and object stores), in parallel by file.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Python workers may not have the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "creaseline-commits"
# As in ``sources.tables``; stated here since workers get this module alone.
POINTERS, COMMIT, NULL_PARTITION = "_pointers", "_commit", "__HIVE_DEFAULT_PARTITION__"
#: Rows of an Arrow batch on its way to Spark.
BATCH_ROWS = 10_000


def file_system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    # Hadoop writes file:/x where others write file:///x.
    scheme, colon, rest = path.partition(":/")
    if colon and not rest.startswith("/"):
        path = f"{scheme}:///{rest}"
    return fs.FileSystem.from_uri(path)


@dataclass
class Part(InputPartition):
    """A file, its partition values as text, and the pointers whose rows are asked for: after ``start``, up to ``end``."""

    file: str
    values: tuple[tuple[str, str | None], ...]
    start: int
    end: int


@dataclass
class Span(InputPartition):
    """The pointers of a micro-batch, instead of its rows."""

    start: int
    end: int


class Commits(DataSource):
    """``spark.readStream.format(FORMAT).schema(...).option("path", table)``; with ``spans`` a row for each micro-batch that names its pointers."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return CommitReader(self.options["path"], schema, "spans" in self.options)


class CommitReader(DataSourceStreamReader):
    def __init__(self, path: str, schema: StructType, spans: bool = False):
        self.path, self.schema, self.spans = path, schema, spans

    def _newest(self) -> tuple[int, dict]:
        from pyarrow import fs

        system, root = file_system(self.path)
        found = system.get_file_info(fs.FileSelector(f"{root}/{POINTERS}", allow_not_found=True))
        names = sorted(f.path for f in found if f.base_name.startswith("n"))
        if not names:
            return 0, {"folders": [], "commits": {}}
        with system.open_input_stream(names[-1]) as stream:
            return int(names[-1].rpartition("/n")[2]), json.loads(stream.read())

    def initialOffset(self) -> dict:  # noqa: N802
        return {"pointer": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"pointer": self._newest()[0]}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        from urllib.parse import unquote

        from pyarrow import fs

        low, high = start["pointer"], end["pointer"]
        number, state = self._newest()
        if number < high:
            raise ValueError(f"{self.path} is at pointer {number}, before {high}: it is not the table that the stream began with")
        missing = [f for f in state["folders"] if f not in state["commits"]]
        if missing:
            raise ValueError(f"{self.path} is not a table of micro-batches: {missing[0]}")
        if self.spans:
            return [Span(low, high)]
        system, root = file_system(self.path)
        parts: list[InputPartition] = []
        for folder in state["folders"]:
            first, last = state["commits"][folder]
            if last <= low or first > high:
                continue
            pairs = [p.split("=", 1) for p in folder.split("/")[1:]]
            values = tuple((unquote(k), None if v == NULL_PARTITION else unquote(v)) for k, v in pairs)
            for info in system.get_file_info(fs.FileSelector(f"{root}/{folder}")):
                if info.is_file and info.base_name[:1] not in "_.":
                    parts.append(Part(info.path, values, low, high))
        return parts

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        target = to_arrow_schema(self.schema)
        if self.spans:
            yield pa.RecordBatch.from_pylist([{"after": partition.start, "up_to": partition.end}], schema=target)
            return
        part: Part = partition
        system, _ = file_system(self.path)
        fixed = dict(part.values)
        with system.open_input_file(part.file) as source:
            # Row groups hold whole batches or many small ones; they are read one by one, so memory stays bounded.
            file = pq.ParquetFile(source, coerce_int96_timestamp_unit="us")
            held = set(file.schema_arrow.names)
            wanted = [f.name for f in target if f.name in held]
            for batch in file.iter_batches(BATCH_ROWS, columns=[*wanted, COMMIT]):
                number = batch.column(COMMIT)
                batch = batch.filter(pc.and_(pc.greater(number, part.start), pc.less_equal(number, part.end)))
                columns = []
                for f in target:
                    if f.name in held:
                        columns.append(batch.column(f.name).cast(f.type))
                    else:  # a partition column, or one that came to the table later
                        value = pa.scalar(fixed.get(f.name), pa.string()).cast(f.type)
                        columns.append(pa.repeat(value, batch.num_rows))
                if batch.num_rows:
                    yield pa.RecordBatch.from_arrays(columns, schema=target)

    def commit(self, end: dict) -> None:
        """Nothing to do: the table keeps its rows."""


def stream(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The micro-batches of a table, from its beginning; ``schema`` names the columns that are read."""
    spark.dataSource.register(Commits)
    return spark.readStream.format(FORMAT).schema(schema).option("path", path).load()


def spans(spark: SparkSession, path: str) -> DataFrame:
    """The micro-batches as their pointers, a row each: ``after, up_to``; ``tables.between`` reads their rows."""
    spark.dataSource.register(Commits)
    return spark.readStream.format(FORMAT).schema("after bigint, up_to bigint").option("path", path).option("spans", "true").load()
