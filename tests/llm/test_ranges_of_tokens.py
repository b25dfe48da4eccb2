"""Token files in ranges of bytes: documents across ranges and tasks, files without a limit, counts by document."""

import collections

import numpy as np
import pytest

from creaseline.llm import tokencount
from creaseline.llm.common import read
from creaseline.llm.queries import QUERIES
from test_operators import TEXTS, odd_docs, tokenizer

END = tokencount.END_OF_DOCUMENT


def brute_counts(tokens, separator=END):
    """(tokens, closed) of each document of a file."""
    out, size = [], 0
    for token in tokens:
        if token == separator:
            out.append((size, True))
            size = 0
        else:
            size += 1
    return out + [(size, False)] * (size > 0)


@pytest.mark.parametrize("range_bytes,block", [(2, 1), (10, 3), (64, 7), (1 << 24, 1 << 16)])
def test_documents_across_ranges(spark, tmp_path, range_bytes, block):
    random_ = np.random.default_rng(range_bytes)
    files = {
        "part-a": np.where(random_.random(300) < 0.2, END, random_.integers(0, 60000, 300)),
        "part-long": np.append(np.full(400, 7), [END, END, 3]),
        "part-ends": np.array([1, 2, 3, 4, END]),
        "part-separators": np.full(11, END),
        "part-empty": np.array([], int),
        "other": np.array([1, END]),
    }
    for name, tokens in files.items():
        tokens.astype("<u2").tofile(tmp_path / name)
    (tmp_path / "part-odd").write_bytes(np.array([9, END, 8], "<u2").tobytes() + b"\x01")
    files["part-odd"] = [9, END, 8]
    got = collections.defaultdict(dict)
    for r in tokencount.count_tokens(spark, str(tmp_path), block_tokens=block, range_bytes=range_bytes).collect():
        name = r.file.rsplit("/", 1)[1]
        assert r.ordinal not in got[name]
        got[name][r.ordinal] = (r.n_tokens, r.closed)
    expected = {name: dict(enumerate(brute_counts(tokens))) for name, tokens in files.items() if name != "other" and len(tokens)}
    assert dict(got) == expected


def test_one_file_is_read_by_several_tasks(spark, tmp_path):
    np.full(5000, 7).astype("<u2").tofile(tmp_path / "part-0")
    rows = tokencount.count_tokens(spark, str(tmp_path), range_bytes=1000).collect()
    assert [(r.ordinal, r.n_tokens, r.closed) for r in rows] == [(0, 5000, False)]
    # Ranges are rows that a hash of (file, start) deals to the tasks.
    places = spark.createDataFrame([(0,)], "x int").selectExpr("explode(sequence(0, 9000, 1000)) AS start", "'part-0' AS path")
    assert places.repartition(8, "path", "start").selectExpr("spark_partition_id() AS p").distinct().count() > 2


@pytest.mark.parametrize("range_bytes,file_bytes", [(6, 40), (1 << 24, 1)])
def test_counts_by_document(spark, range_bytes, file_bytes):
    encode = tokenizer()
    docs = odd_docs(spark)
    rows = tokencount.count_document_tokens(docs, 5, range_bytes, file_bytes).collect()
    size = lambda t: len(encode.encode(t or "", add_special_tokens=False).ids)
    expected = collections.Counter((r.doc_id, size(r.text)) for r in docs.collect())
    assert collections.Counter((r.doc_id, r.n_tokens) for r in rows) == expected and all(r.closed for r in rows)
    assert len({(r.file, r.ordinal) for r in rows}) == len(rows) and len({r.file for r in rows}) > len(TEXTS) // 4


def test_files_of_lost_attempts_do_not_count(spark, tmp_path):
    for name in ("part-0", "part-1"):
        np.array([1, 2, END], "<u2").tofile(tmp_path / name)
    names = spark.createDataFrame([("part-1",)], "file string")
    rows = tokencount.count_tokens(spark, str(tmp_path), names=names).collect()
    assert [(r.file.rsplit("/", 1)[1], r.n_tokens) for r in rows] == [("part-1", 2)]


def test_ranges_hold_whole_ids(spark, tmp_path):
    with pytest.raises(ValueError):
        tokencount.count_tokens(spark, str(tmp_path), range_bytes=3)


def test_query_by_document(spark, small):
    encode = tokenizer()
    docs = read(spark, small, "documents").select("doc_id", "text").collect()
    expected = {r.doc_id: len(encode.encode(r.text or "", add_special_tokens=False).ids) for r in docs}
    rows = QUERIES["op6_token_counts"](spark, small).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == expected and len(rows) == len(docs)
