"""Limits that say so, and languages that a bounded sample must not lose."""

import pytest

from creaseline.llm import langid, simhash


def test_blocks_refuse_more_bits_than_they_find(spark):
    prints = spark.createDataFrame([(0,), (1,)], "fingerprint long")
    assert simhash.close_pairs(prints, 1).count() == 1
    with pytest.raises(ValueError, match="up to 3 bits"):
        simhash.close_pairs(prints, 4)


def test_every_language_takes_part(spark, monkeypatch):
    """With far more languages than the bytes of the sample allow, each still has a row."""
    monkeypatch.setattr(langid, "TRAIN_TOTAL_BYTES", 2000)
    words = ("stone", "river", "cloud", "lamp", "paper", "garden")
    rows = [(i, " ".join(f"{w}{i % 150}" for w in words), f"l{i % 150}") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    assert set(langid.fit(frame).languages) == {f"l{n}" for n in range(150)}
