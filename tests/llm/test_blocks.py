"""Any number of blocks finds the same pairs; it follows the number of fingerprints."""

import random

import pytest

from creaseline.llm import simhash


@pytest.mark.parametrize("blocks", [5, 6, 7])
def test_every_number_of_blocks_loses_none(spark, blocks):
    draw = random.Random(blocks)
    values = {0, 2**64 - 1}
    for _ in range(50):
        base = draw.getrandbits(64)
        values.add(base)
        # Up to two bits more than are linked, all in one block's neighbourhood or anywhere.
        for bits in (1, 2, 3, 4, 5):
            values.add(base ^ sum(1 << b for b in draw.sample(range(64), bits)))
            at = draw.randrange(59)
            values.add(base ^ sum(1 << b for b in draw.sample(range(at, at + 5), min(bits, 5))))
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    for most in (1, 3):
        expected = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= most}
        got = [(r.a, r.b) for r in simhash.close_pairs(frame, most, blocks).collect()]
        assert len(got) == len(set(got)) and set(got) == expected and expected


def test_blocks_follow_the_number_of_fingerprints():
    assert [sum(simhash.widths(n)) for n in (5, 6, 7)] == [64, 64, 64]
    assert [simhash.blocks_for(n) for n in (0, 10**6, 3 * 10**9, 10**11, 10**12, 10**14)] == [5, 5, 5, 6, 7, 7]
    for rows in (10**6, 10**9, 10**11, 10**12):
        blocks = simhash.blocks_for(rows)
        intact = sorted(simhash.widths(blocks))[: blocks - simhash.MAX_BITS]
        assert rows / 2 ** sum(intact) <= simhash.KEY_ROWS
