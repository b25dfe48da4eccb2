"""Token counts of documents in flat token files without an index, by separator scan.

A flat file is one run of token ids (little-endian unsigned 16-bit, which a vocabulary below 65,536 allows); an end-of-document id closes each document.
Files of any size are read in ranges of bytes, each of which is a row and so work for any task.  The scan cuts a
range into blocks and searches each block for separators with vectorised comparisons, whatever documents begin or
end there.  A block yields its segments: token runs that a separator or the block's end closes.  A prefix sum of
closed segments, over a range's blocks and then over a file's ranges, numbers the documents; segments with one
number, which are the parts of a document that crosses blocks or ranges, add up.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creaseline.llm.common import materialise, partitions, runs_by_bytes
from creaseline.llm.packing import encoder, text_ids, tokenizer_files
from creaseline.sources.commits import file_system
from creaseline.sources.scratch import scratch_path

#: ``<|endoftext|>`` of the public 50k byte-level BPE; no ordinary text has this id.
END_OF_DOCUMENT = 50256
#: Type of an id in a file.
ID = "<u2"
ID_BYTES = np.dtype(ID).itemsize
BLOCK_TOKENS = 1 << 16
#: Bytes of a file that one row stands for and a task holds at a time.
RANGE_BYTES = 1 << 24
#: A file is closed once it holds so many bytes.
FILE_BYTES = 1 << 28

WRITTEN = "doc_id long, file string, ordinal long"
SEGMENTS = "file string, start long, nth long, tokens long, closed long"


def _write_batches(path: str, separator: int, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(path)
        system.create_dir(root, recursive=True)
        encoding, end = encoder(*tokenizer_files()), np.array(separator, ID).tobytes()
        # An attempt of a task has files of its own; only those that the written rows name count.
        attempt, chunk, out = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}", 0, None
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for first, last in runs_by_bytes(pc.binary_length(texts).to_numpy(), 1 << 22):
                files, ordinals = [], []
                for text in texts.slice(first, last - first).to_pylist():
                    if out is None:
                        name, written, ordinal = f"{attempt}-c{chunk:03d}", 0, 0
                        out = system.open_output_stream(f"{root}/{name}")
                    data = text_ids(encoding, text, ID).tobytes() + end
                    out.write(data)
                    files.append(name)
                    ordinals.append(ordinal)
                    written, ordinal = written + len(data), ordinal + 1
                    if written >= file_bytes:
                        out.close()
                        chunk, out = chunk + 1, None
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), pa.array(files), pa.array(ordinals, pa.int64())],
                    ["doc_id", "file", "ordinal"],
                )
        if out is not None:
            out.close()

    return run


def write_token_files(
    docs: DataFrame, path: str, separator: int = END_OF_DOCUMENT, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Writes flat token files below ``path``; returns ``doc_id, file, ordinal``, the place of each row of ``docs``.

    A null text is written as one without tokens.  A file that the result does not name is what an attempt of a
    task left that was lost or overtaken.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return materialise(rows.mapInArrow(_write_batches(path, separator, file_bytes), WRITTEN), "token-places")


def scan_block(tokens: np.ndarray, separator: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each segment of a block, without separators, and whether a separator closes it.

    The last segment is the open rest; it is left out if it is empty.
    """
    at = np.flatnonzero(tokens == separator)
    ends = np.append(at, len(tokens))
    lengths = np.diff(ends, prepend=-1) - 1
    closed = np.append(np.ones(len(at), np.int64), 0)
    return (lengths, closed) if lengths[-1] else (lengths[:-1], closed[:-1])


def scan_range(tokens: np.ndarray, separator: int, block_tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, tokens and closing of each document, or part of one, in a range that is scanned block by block."""
    found = [scan_block(tokens[at : at + block_tokens], separator) for at in range(0, len(tokens), block_tokens)]
    lengths, closed = (np.concatenate([f[i] for f in found]) for i in (0, 1))
    # Closed segments before each one, over all blocks of the range.
    numbers = np.cumsum(closed) - closed
    starts = np.flatnonzero(np.diff(numbers, prepend=-1))
    return numbers[starts], np.add.reduceat(lengths, starts), np.maximum.reduceat(closed, starts)


def _scan_batches(separator: int, block_tokens: int, range_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, length in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "length"))):
                system, name = file_system(path)
                with system.open_input_file(name) as file:
                    data = file.read_at(min(range_bytes, length - start), start)
                tokens = np.frombuffer(data, ID, count=len(data) // ID_BYTES)
                numbers, lengths, closed = scan_range(tokens, separator, block_tokens)
                n = len(numbers)
                columns = [pa.array([path] * n, pa.string()), pa.array(np.full(n, start)), *map(pa.array, (numbers, lengths, closed))]
                yield pa.RecordBatch.from_arrays(columns, ["file", "start", "nth", "tokens", "closed"])

    return run


def count_tokens(
    spark: SparkSession, path: str, separator: int = END_OF_DOCUMENT, block_tokens: int = BLOCK_TOKENS,
    range_bytes: int = RANGE_BYTES, names: DataFrame | None = None,
) -> DataFrame:
    """``file, ordinal, n_tokens, closed``: one row per document of the flat files below ``path``.

    Files are those called ``part-...``, or of these the ones in ``names`` (column ``file``).  ordinal counts from 0 in
    a file.  A document may be empty and may cross any number of blocks and ranges.  Tokens after the last separator
    are a document with ``closed`` false; bytes beyond the last whole id are ignored; a file without tokens gives no
    row.  ``range_bytes`` must be a whole number of ids.
    """
    if range_bytes < ID_BYTES or range_bytes % ID_BYTES:
        raise ValueError(f"a range must be a multiple of {ID_BYTES} bytes, not {range_bytes}")
    # Spark lists the files; their content is not asked for, so their size has no limit.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "length")
    if names is not None:
        files = files.join(names, F.element_at(F.split("path", "/"), -1) == F.col("file"), "left_semi")
    whole = files.withColumn("length", F.col("length") - F.col("length") % ID_BYTES).where("length > 0")
    ranges = whole.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(range_bytes).cast("long"))).alias("start"), "length")
    ranges = ranges.repartition(partitions(spark), "path", "start")
    segments = materialise(ranges.mapInArrow(_scan_batches(separator, block_tokens, range_bytes), SEGMENTS), "segments")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    totals = segments.groupBy("file", "start").agg(F.sum("closed").alias("total"))
    firsts = totals.select("file", "start", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("first"))
    numbered = segments.join(firsts, ["file", "start"]).select("file", (F.col("first") + F.col("nth")).alias("ordinal"), "nth", "tokens", "closed")
    # Only what lies at an end of a range can be a part of a document.
    inner = (F.col("nth") > 0) & (F.col("closed") == 1)
    stitched = numbered.where(~inner).groupBy("file", "ordinal").agg(
        F.sum("tokens").alias("n_tokens"), (F.max("closed") == 1).alias("closed")
    )
    complete = numbered.where(inner).select("file", "ordinal", F.col("tokens").alias("n_tokens"), F.lit(True).alias("closed"))
    return complete.unionByName(stitched)


def count_document_tokens(
    docs: DataFrame, block_tokens: int = BLOCK_TOKENS, range_bytes: int = RANGE_BYTES, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Writes the token files of ``docs`` to the shared folder and counts them: ``doc_id, file, ordinal, n_tokens, closed``.

    One row per row of ``docs``, repeated rows and those with a null doc_id included; null and empty texts have no
    tokens; texts of any length; an empty table gives no row.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    places = write_token_files(docs, path, file_bytes=file_bytes)
    names = places.select("file").distinct()
    if names.isEmpty():
        return places.selectExpr("doc_id", "file", "ordinal", "0L AS n_tokens", "true AS closed")
    counted = count_tokens(spark, path, block_tokens=block_tokens, range_bytes=range_bytes, names=names)
    counted = counted.withColumn("file", F.element_at(F.split("file", "/"), -1))
    return places.join(counted, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens", "closed")
