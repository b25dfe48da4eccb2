"""Operators 11 to 13 against brute force and SQL, and on odd inputs."""

import collections
import functools
import hashlib
import random
import re
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from creaseline.llm import codes, linededup, variants
from creaseline.llm.common import read
from creaseline.llm.queries import ORACLE_SQL, QUERIES

VECTORS = "vec_id long, embedding array<float>, label int, code string, _x int, error int"
DOCS = "doc_id long, text string, _n_lines int, _doc string, n int, word string"


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_line_dedup"])
def test_rows_match_sql(spark, small, name):
    duck = duckdb.connect()
    for file in Path(small).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got = QUERIES[name](spark, small)
    expected = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


# ---------------------------------------------------------------- 11 codes
def brute_codes(rows, parts, entries, rounds, scale):
    """``rows``: (id, label, vector) of the kept vectors.  Whole numbers of Python throughout."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    whole = [[int(np.floor(float(v) * scale)) for v in r[2]] for r in rows]
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[cut[i][p] for i in range(min(entries, len(cut)))] for p in range(parts)]
    distance = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda part, p: min(range(len(books[p])), key=lambda j: (distance(part, books[p][j]), j))
    for _ in range(rounds):
        taken = [[nearest(v[p], p) for p in range(parts)] for v in cut]
        for p in range(parts):
            for j in range(len(books[p])):
                mine = [v[p] for v, t in zip(cut, taken) if t[p] == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    taken = [[nearest(v[p], p) for p in range(parts)] for v in cut]
    errors = [sum(distance(v[p], books[p][j]) for p, j in enumerate(t)) for v, t in zip(cut, taken)]
    by_label = collections.Counter()
    for r, e in zip(rows, errors):
        by_label[r[1]] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return sorted(((r[0], bytes(t).hex(), e, by_label[r[1]], digest) for r, t, e in zip(rows, taken, errors)), key=str)


def coded(frame, **how):
    return sorted(map(tuple, codes.compressed_vectors(frame, **how).collect()), key=str)


@pytest.mark.parametrize("kind", ["spread", "clusters", "grid"])
def test_codes_against_brute_force(spark, kind):
    """A grid has many equal distances and equal vectors."""
    rnd = np.random.default_rng(len(kind))
    centres = rnd.normal(size=(12, 16))
    draw = {
        "spread": lambda: rnd.normal(size=16), "clusters": lambda: centres[rnd.integers(12)] + rnd.normal(size=16) / 20, "grid": lambda: rnd.integers(-1, 2, 16) / 2
    }[kind]
    rows = [(i, int(rnd.integers(3)) if i % 5 else None, [float(np.float32(v)) for v in draw()]) for i in range(400)]
    frame = spark.createDataFrame([(i, v, label, "c", 1, 2) for i, label, v in rows], VECTORS).repartition(5)
    assert coded(frame) == brute_codes(rows, 8, 16, 6, 4096)
    assert coded(frame, parts=4, entries=5, rounds=3, scale=7) == brute_codes(rows, 4, 5, 3, 7)


def test_codes_odd_vectors(spark):
    vector = [0.5, -0.25] * 4
    rows = [  # id, label, vector
        (5, 1, vector), (5, 1, vector), (3, None, [v + 1 for v in vector]), (None, None, [v - 1 for v in vector]), (9, 2, [0.0] * 8),
        (1, 1, None), (2, 1, []), (4, 1, [1.0] * 7 + [float("nan")]), (6, 1, [1.0] * 7 + [float("inf")]), (7, 1, [1.0] * 7 + [None]), (8, 1, [1.0] * 16), (10, 1, [1.0] * 9),
        (0, 1, [1.0] * 3),
    ]
    got = coded(spark.createDataFrame([(a, c, b, "x", 1, 2) for a, b, c in rows], VECTORS))
    assert got == brute_codes(rows[:5], 8, 16, 6, 4096)
    assert coded(spark.createDataFrame([], VECTORS)) == []
    assert coded(spark.createDataFrame([(1, None, 1, "x", 1, 2)], VECTORS)) == []
    far = codes.compressed_vectors(spark.createDataFrame([(i, [3e38 * (-1) ** i] * 8, 1, "x", 1, 2) for i in range(20)], VECTORS))
    assert far.count() == 20 and far.where("error < 0").count() == 0


def test_bounds_save_scans_and_use_net_moves(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(size=(16, 32)) * 4
    rows = [(i, [float(v) for v in centres[i % 16] + rnd.normal(size=32) / 50], 0, "c", 1, 2) for i in range(800)]
    frame, books = codes.compress(spark.createDataFrame(rows, VECTORS))
    assert books.scanned[0] == 800 * codes.PARTS and max(books.scanned[2:]) < 400  # clusters settle at once
    one = frame.first()
    back = codes.decode(one.code, books)
    assert sum((a - b) ** 2 for a, b in zip(back, rows[one.vec_id][1])) < 0.1
    # An entry that swings back has moved by nothing, though each step was long.
    here, there = np.zeros((1, 2, 3), np.int64), np.full((1, 2, 3), 9)
    own, others = codes.moves([here, there, here])
    assert own[0].max() == 0 and others[0].max() == 0 and own[1].min() > 15


# ---------------------------------------------------------------- 12 line dedup
def brute_lines(rows, min_chars=40, min_documents=5):
    low = lambda k: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)
    key = lambda line: low(line.strip(" \t\n\v\f\r"))
    holders = collections.defaultdict(list)
    for doc_id, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(doc_id if doc_id is not None else linededup.NO_ID)
    last = {k: max(ids) for k, ids in holders.items() if len(ids) >= min_documents}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        own = doc_id if doc_id is not None else linededup.NO_ID
        kept = [line for line in lines if last.get(key(line), own) == own]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def deduped(frame, **how):
    return sorted(map(tuple, linededup.dedupe_lines(frame, **how).select("doc_id", "_n_lines", "_n_dropped", "text").collect()), key=str)


LONG = "This line is held by many documents, again and again"
ODD = [None, "", "\n", "\n\n \n", "short", LONG, f"  {LONG.upper()}\t", f"{LONG}\n{LONG}\nown words", f"\n{LONG}\r\n", "é" * 40, "É" * 40, "é" * 39, " " * 80, "x" * 50_000]


def test_line_dedup_odd_documents(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, f"{LONG}\n{'é' * 40}\n{'é' * 39}\n{i}") for i in range(6)]
    rows += [(None, LONG), (105, LONG), (3, ODD[3]), (200, "é" * 40), (200, "é" * 40)]
    frame = spark.createDataFrame([(*r, 1, "d", 2, "w") for r in rows], DOCS).repartition(3)
    assert deduped(frame) == brute_lines(rows)
    assert set(linededup.dedupe_lines(frame).columns) == {*frame.columns, "_n_dropped"}
    # Many shards, a bundle for each, and other thresholds give the same.
    assert deduped(frame, shard_keys=1, probe_bytes=1) == brute_lines(rows)
    assert deduped(frame, min_chars=1, min_documents=2, shard_keys=4, probe_bytes=300) == brute_lines(rows, 1, 2)
    empty = spark.createDataFrame([], DOCS)
    assert deduped(empty) == []
    assert deduped(spark.createDataFrame([(None, None, 1, "d", 2, "w")] * 7, DOCS)) == [(None, 1, 0, "")] * 7


@given(st.sets(st.integers(0, 2**64 - 1), max_size=300), st.sets(st.integers(0, 2**64 - 1), max_size=50))
@settings(max_examples=60, deadline=None)
def test_perfect_hash_numbers_keys_without_gaps(keys, others):
    held = np.array(sorted(keys), np.uint64)
    index = linededup.PerfectHash.build(held)
    assert sorted(index.number(held).tolist()) == list(range(len(held)))
    assert all(-1 <= n < len(held) for n in index.number(np.array(sorted(others), np.uint64)).tolist())


def test_hashes_with_an_equal_half_stay_apart(spark):
    """Keys that agree in the 64 bits that number them are told apart by the other 64."""
    rows = [(7, f, 5, 10 + f) for f in range(4)] + [(-9, 2, 6, 3), (8, 1, 7, 4)]
    shared = spark.createDataFrame(rows, "_h long, _f long, _n long, _last long")
    arrays, bits = linededup.build_index(shared, shard_keys=2)
    index = linededup.Index(bits, [tuple(r) for r in arrays.collect()])
    hashes = np.array([[r[0], r[1]] for r in rows] + [[7, 9], [8, 2], [-1, 1]], np.int64).view(np.uint64)
    assert index.probe(hashes, -5).tolist() == [True] * 6 + [False] * 3
    assert index.probe(hashes, 11).tolist() == [True, False, True, True, True, True] + [False] * 3


def test_line_dedup_shuffles_no_line(spark, small):
    plan = linededup.dedupe_lines(read(spark, small, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


# ---------------------------------------------------------------- 13 spelling variants
def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    return a[p + 1 :] == b[p + 1 :] or a[p:] == b[p + 1 :] or a[p + 1 :] == b[p:]


def brute_groups(counts):
    partners = {w: [v for v in counts if near(w, v)] for w in counts}
    form = {}
    for w, found in partners.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 2 * counts[w]:
            form[w] = best
    end = lambda w: end(form[w]) if w in form else w
    return sorted((w, form.get(w), end(w), counts[w], len(partners[w]), counts[form[w]] if w in form else None) for w in counts)


def brute_words(docs, damage=97):
    counts = collections.Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def test_variants_query(spark, small):
    docs = [tuple(r) for r in read(spark, small, "documents").select("doc_id", "text").collect()]
    counts = brute_words(docs)
    got = sorted(map(tuple, QUERIES["op13_spelling_variants"](spark, small).collect()))
    assert {(r[0], r[3]) for r in got} == set(counts.items())
    # Brute force over neighbours: words of other lengths or without a common half can't be near.
    halves = collections.defaultdict(set)
    for w in counts:
        for n in (len(w) - 1, len(w), len(w) + 1):
            halves[n, 0, w[: n // 2]].add(w)
            halves[n, 1, w[len(w) - n // 2 :]].add(w)
    partners = collections.defaultdict(set)
    for group in halves.values():
        for a in group:
            partners[a] |= {b for b in group if near(a, b)}
    assert {r[0]: r[4] for r in got} == {w: len(partners[w]) for w in counts}
    for word, form, _, n, _, form_n in got:
        best = min(partners[word], key=lambda v: (-counts[v], v), default=None)
        expected = best if best is not None and counts[best] >= 2 * n else None
        assert (form, form_n) == (expected, counts.get(expected))


def test_variants_against_brute_force(spark):
    """Few letters: bigrams that repeat inside a word, words of one letter, chains and ties."""
    rnd = random.Random(5)
    words = {"".join(rnd.choice("abé") for _ in range(rnd.randint(4, 8))) for _ in range(500)}
    words |= {"z" * n for n in (5, 6, 7, 8, 200, 201, 1999, 2000)} | {"word" + "y" * n for n in range(1, 12)}
    counts = {w: rnd.choice([3, 3, 4, 8, 20, 50, 200]) for w in words} | {"word" + "y" * n: 3 ** n for n in range(1, 12)}
    frame = spark.createDataFrame([(w, n, "x", 1) for w, n in counts.items()], "word string, n long, root string, key int").repartition(4)
    got = sorted(map(tuple, variants.group_variants(frame).collect()))
    assert got == brute_groups(counts)
    assert next(r for r in got if r[0] == "wordy")[2] == "word" + "y" * 11


def test_pivots_are_disjoint_and_cheapest():
    rnd = random.Random(2)
    for _ in range(300):
        places = sorted(rnd.sample(range(12), rnd.randint(3, 8)))
        cost = [rnd.randint(1, 9) for _ in places]
        a, b = variants.pivots(places, cost)
        of = dict(zip(places, cost))
        assert b - a >= 2 and of[a] + of[b] == min(of[x] + of[y] for x in places for y in places if y - x >= 2)


def test_word_counts_odd_documents(spark):
    texts = [None, "", "  ", "Straße STRASSE strasse Àà×÷ÿ", "hello " * 3000, "x" * 70_000, "l'été naïve naïve naïve", "don't stop-words 12abcde34", "漢字hello漢字", "q", "İstanbul ﬁnding"]
    rows = [(i, t) for i, t in enumerate(texts)] * 3 + [(None, "nothing nothing nothing")]
    frame = spark.createDataFrame([(*r, 1, "d", 2, "w") for r in rows], DOCS)
    for damage in (97, 2, 1):
        got = {r.word: r.n for r in variants.word_counts(frame, damage=damage).collect()}
        assert got == brute_words(rows, damage)
    plain = {r.word: r.n for r in variants.word_counts(frame).collect()}
    assert plain["hello"] == 9003 and plain["x" * 70_000] == 3
    empty = spark.createDataFrame([], DOCS)
    assert variants.group_variants(variants.word_counts(empty)).count() == 0


def test_words_of_long_texts_in_parts(monkeypatch):
    text = ("one two Three fours\tfives\n" * 50).encode()

    def count(damage):
        words = collections.Counter()
        variants.count_runs(words, 1, text, damage)
        return +words

    whole = count(3)
    monkeypatch.setattr(variants, "pieces", functools.partial(variants.pieces, size=11))
    assert count(3) == whole
    assert sum(count(None).values()) == 250 and count(None)[b"fives"] == 50
