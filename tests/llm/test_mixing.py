"""Operator 3 against earliest deadline first with a heap, its bound, and what it does without UDFs."""

import collections
import heapq
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creaseline.llm import mixing


def heap_schedule(parts, slots):
    """Earliest deadline first in whole numbers, for parts in the order of sources."""
    total, done, out, ready = sum(parts), [0] * len(parts), [], []
    coming = [(0, i) for i in range(len(parts))]
    for slot in range(slots):
        while coming and coming[0][0] <= slot:
            i = heapq.heappop(coming)[1]
            heapq.heappush(ready, (-(-(done[i] + 1) * total // parts[i]), i))
        i = heapq.heappop(ready)[1]
        out.append((i, done[i]))
        done[i] += 1
        heapq.heappush(coming, (done[i] * total // parts[i], i))
    return out


def deviation(order, weights):
    """The most that a source is away from its weight in a prefix of the source names ``order``."""
    total, slots = sum(weights.values()), np.arange(1, len(order) + 1)
    order = np.array(order)
    return max(np.abs(np.cumsum(order == s) - w / total * slots).max() for s, w in weights.items())


@pytest.mark.parametrize("sources", [3, 20, 300, 3000])
def test_schedule_is_earliest_deadline_first(spark, sources):
    rnd, slots = random.Random(sources), 100_000
    parts = [int(rnd.paretovariate(1) * 1000) for _ in range(sources)]
    shares = spark.createDataFrame([(f"{i:05d}", q) for i, q in enumerate(parts)], "source string, parts long").repartition(3)
    rows = mixing.schedule(shares, F.lit(slots)).collect()
    expected = heap_schedule(parts, slots)
    assert [(int(r.source), r.nth) for r in sorted(rows, key=lambda r: r.slot)] == expected
    largest = sorted(range(sources), key=lambda i: -parts[i])[:50]
    at, counts = np.array([i for i, _ in expected]), np.arange(1, slots + 1)
    assert max(np.abs(np.cumsum(at == i) - parts[i] / sum(parts) * counts).max() for i in largest) < 1


@pytest.mark.parametrize("seed", range(4))
def test_mixture_stays_within_a_block(spark, seed):
    rnd = random.Random(seed)
    sizes = {f"s{i}": rnd.choice([1, 3, 40, rnd.randint(1, 900)]) for i in range(rnd.choice([2, 7, 20]))}
    weights = {s: rnd.paretovariate(0.7) + n / 30 for s, n in sizes.items()}
    rows = [(i, s) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    frame = spark.createDataFrame(rows, "doc_id long, source string").repartition(4)
    wanted = spark.createDataFrame(list(weights.items()), "source string, weight double")
    mixed = mixing.mix(frame, wanted, block_rows=1).collect()
    order = {r._slot: r.source for r in mixed}
    assert len(order) == len(mixed) == max(order) + 1 and {r.doc_id for r in mixed} == set(range(len(rows)))
    assert deviation([order[i] for i in range(len(order))], weights) < 1
    # Each source goes through its rows again and again, and no epoch repeats a row.
    for source, n in sizes.items():
        turns = collections.Counter(r._epoch for r in mixed if r.source == source)
        assert all(turns[e] == n for e in range(max(turns)))


def test_blocks_grow_where_the_plan_would_be_long(spark):
    frame = spark.range(5000).selectExpr("id as doc_id", "if(id % 5 = 0, 'a', 'b') as source")
    mixed = mixing.mix(frame, block_rows=1, slots=40).collect()
    assert {r.doc_id for r in mixed} == set(range(5000))
    slots = collections.Counter(r._slot for r in mixed)
    assert len(slots) <= 40 and len({r._position for r in mixed}) == len(mixed)
    order = {r._slot: r.source for r in mixed}
    assert deviation([order[i] for i in sorted(order)], {"a": 1000**0.9, "b": 4000**0.9}) < 1


def test_sources_without_a_block_in_the_plan_come_last(spark):
    frame = spark.range(403).selectExpr("id as doc_id", "if(id < 3, 'tiny' || id, 'big') as source")
    wanted = spark.createDataFrame([("big", 1.0), *[(f"tiny{i}", 1e-6) for i in range(3)]], "source string, weight double")
    mixed = mixing.mix(frame, wanted, block_rows=4, slots=110).collect()
    assert {r.doc_id for r in mixed} == set(range(403))
    tiny = sorted(r._slot for r in mixed if r.source != "big")
    assert len(tiny) == 3 and len({r._slot for r in mixed}) == max(r._slot for r in mixed) + 1
    with pytest.raises(ValueError, match="more sources than slots"):
        mixing.mix(frame, wanted, slots=3)


def test_mixing_is_native(spark):
    """Neither the plan nor the placing has Python in it, and no row is collected but counts and weights."""
    shares = spark.createDataFrame([("a", 3), ("b", 5)], "source string, parts long")
    frame = spark.range(100).selectExpr("id as doc_id", "'s' || id % 3 as source")
    for made in (mixing.schedule(shares), mixing.mix(frame)):
        text = made._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
