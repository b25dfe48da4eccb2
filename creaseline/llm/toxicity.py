"""Toxicity by gradient-boosted trees over dense features of a text, calibrated by isotonic regression.

Features: densities of a lexicon of words and of word stems, strength of the strongest entries, how close entries
stand to second-person words, capitals, punctuation, and signs of obfuscation.  The lexicon is learnt: words and
stems whose share among toxic texts is far above their share elsewhere.  Trees and calibration are Spark's own;
features are computed in Arrow batches.

All labels come from rows that are not :func:`held_out`.  They are divided in three by a hash: one part finds the
lexicon, one grows the trees, one calibrates, so that no part flatters the next.
"""

from __future__ import annotations

import math
import re
from collections import deque
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import in_sample, label_share, materialise, pieces

#: Bounds of the training sample, about: labelled rows, and bytes of one of their texts.
TRAIN_ROWS, TRAIN_BYTES = 20_000, 1 << 17
LEXICON_SIZE, LEXICON_SUPPORT, LEXICON_RATIO = 1000, 4, 8.0
STEM = 5
TREES, DEPTH, SEED = 20, 3, 11
NEAR_WORDS = 6
#: Characters of a text that are looked at together.
PART = 1 << 16

#: Second-person words of English, German, French and Spanish.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos "
    "tú usted ustedes vosotros"
).split()
#: What digits and signs stand for in obfuscated words.
LOOKALIKE = str.maketrans("013457@$!|", "oieastasil")
EDGES = ".,;:!?\"'()[]{}<>-–—…«»¿¡*#%&$|_~`/\\"

FEATURES = [
    "log_words", "lexicon_share", "lexicon_hits", "lexicon_top", "stem_share", "stem_hits", "stem_top", "weight_share",
    "hits_near_second_person", "second_person_share", "capital_share", "shouted_share", "exclamation_share",
    "punctuation_share", "repeated_marks", "obfuscated_share", "obfuscated_hits",
]
_MARKS = re.compile(r"[!?]{2,}")


@dataclass
class Model:
    lexicon: dict[str, float]
    stems: dict[str, float]
    trees: GBTClassificationModel | None
    isotonic: IsotonicRegressionModel | None
    prior: float


def words_of(text: str) -> list[str]:
    return [w.strip(EDGES) for w in text.lower().split()]


def stem_of(word: str) -> str:
    return word[:STEM] if len(word) > STEM else ""


def revealed(word: str) -> str:
    """The word without what hides it: look-alike signs read as letters, separators inside dropped."""
    return "".join(c for c in word.translate(LOOKALIKE) if c.isalpha())


class _Seen:
    """What the parts of a text add up to; words are numbered through all parts."""

    def __init__(self, lexicon: dict[str, float], stems: dict[str, float]):
        self.lexicon, self.stems = lexicon, stems
        self.words = self.found = self.stemmed = self.strange = self.hidden = self.spoken = self.near = 0
        self.found_sum = self.found_top = self.stem_sum = self.stem_top = 0.0
        self.shouted = self.capitals = self.alpha = self.exclamations = self.marks = self.runs = self.stops = 0
        self.last_spoken, self.waiting = -NEAR_WORDS - 1, deque(maxlen=NEAR_WORDS)

    def hit(self, i: int) -> None:
        if i - self.last_spoken <= NEAR_WORDS:
            self.near += 1
        else:
            self.waiting.append(i)

    def second_person(self, i: int) -> None:
        self.spoken += 1
        self.near += sum(i - p <= NEAR_WORDS for p in self.waiting)
        self.waiting.clear()
        self.last_spoken = i

    def add(self, part: str) -> None:
        lower = part.lower()
        words = [w.strip(EDGES) for w in lower.split()]
        lexicon, stems = self.lexicon, self.stems
        for i, word in enumerate(words, self.words):
            if word in lexicon:
                self.found += 1
                self.found_sum += lexicon[word]
                self.found_top = max(self.found_top, lexicon[word])
                self.hit(i)
            elif word[:STEM] in stems and len(word) > STEM:
                self.stemmed += 1
                self.stem_sum += stems[word[:STEM]]
                self.stem_top = max(self.stem_top, stems[word[:STEM]])
                self.hit(i)
            elif word in _SECOND:
                self.second_person(i)
            elif word and not word.isalpha() and any(map(str.isalpha, word)):
                self.strange += 1
                self.hidden += revealed(word) in lexicon
        self.words += len(words)
        self.alpha += sum(map(len, words))
        self.shouted += sum(1 for w in part.split() if len(w) > 2 and w.isupper())
        self.capitals += capitals(part, lower)
        bangs, asks = part.count("!"), part.count("?")
        self.exclamations += bangs
        self.marks += bangs + asks
        self.stops += part.count(",") + part.count(".")
        # A run of marks has no white space, so none is cut.
        self.runs += len(_MARKS.findall(part)) if bangs + asks > 1 else 0


def capitals(text: str, lower: str) -> int:
    """Characters that lower-casing changes."""
    if len(text) != len(lower):
        return sum(map(str.isupper, text))
    if text.isascii():
        return int(np.count_nonzero(np.frombuffer(text.encode(), np.uint8) != np.frombuffer(lower.encode(), np.uint8)))
    before, after = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (text, lower))
    return int(np.count_nonzero(before != after))


def features(text: str, lexicon: dict[str, float], stems: dict[str, float]) -> list[float]:
    """The values named in ``FEATURES``, in that order; the text is read in parts, so its length costs no memory."""
    t = _Seen(lexicon, stems)
    for part in pieces(text, PART):
        t.add(part)
    n = max(1, t.words)
    return [
        math.log1p(t.words), t.found / n, float(t.found), t.found_top, t.stemmed / n, float(t.stemmed), t.stem_top,
        (t.found_sum + t.stem_sum) / n, float(t.near), t.spoken / n, t.capitals / (t.alpha or 1), t.shouted / n,
        t.exclamations / n, (t.marks + t.stops) / max(1, len(text)), t.runs / n, t.strange / n, float(t.hidden),
    ]


_SECOND = frozenset(SECOND_PERSON)


def feature_column(text: Column, lexicon: dict[str, float], stems: dict[str, float]) -> Column:
    def run(texts: pa.Array) -> pa.Array:
        # One text at a time: a batch of long ones is never held as Python strings.
        values = [features(t.as_py() or "", lexicon, stems) for t in texts]
        return pa.array(values, pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>")(text.cast("string"))


def held_out(doc_id: Column) -> Column:
    return label_share(doc_id, 5) == 0


def _terms(part: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems with their log ratio; the strongest ``LEXICON_SIZE`` of each."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts:
            words = {w for w in words_of(text.as_py() or "") if w}
            stems = {"^" + w[:STEM] for w in words if len(w) > STEM}
            out.append(sorted(words | stems))
        return pa.array(out, pa.list_(pa.string()))

    totals = {bool(r["toxic"]): r["n"] for r in part.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = totals.get(True, 0), totals.get(False, 0)
    if not bad or not good:
        return {}, {}
    counts = (
        part.select("toxic", F.explode(F.arrow_udf(run, "array<string>")("text")).alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    )
    ratio = F.col("bad") / F.lit(bad) / ((F.col("good") + 0.5) / F.lit(good + 1))
    strong = counts.withColumn("ratio", ratio).where(
        (F.col("bad") >= LEXICON_SUPPORT) & (F.col("ratio") >= LEXICON_RATIO)
    )
    is_stem = F.col("term").startswith("^")
    out = []
    for some in (strong.where(~is_stem), strong.where(is_stem)):
        best = some.orderBy(F.desc("bad"), "term").limit(LEXICON_SIZE).select("term", F.log("ratio").alias("w")).collect()
        out.append({r["term"].removeprefix("^"): r["w"] for r in best})
    return out[0], out[1]


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from labelled rows that are not held out; about ``TRAIN_ROWS`` of them, chosen by a hash of the id.

    Without both kinds of labels the model scores every text with the share of toxic labels (0 without labels).
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .withColumn("mix", F.xxhash64("doc_id"))
    )
    rows = known.count()
    chosen = known.where(in_sample(F.col("mix"), TRAIN_ROWS, rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        F.col("text").isNotNull() & (F.octet_length("text") <= TRAIN_BYTES)
    )
    part = F.pmod(F.xxhash64("mix"), F.lit(10))  # a hash of its own: the sample fixes the high bits of mix
    # The chosen ids are bounded by TRAIN_ROWS, so they can be broadcast.
    sample = materialise(texts.join(F.broadcast(chosen), "doc_id").withColumn("part", part), "toxicity-sample")
    lexicon, stems = _terms(sample.where("part < 4"))
    totals = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    prior = totals.get(1, 0) / max(1, sum(totals.values()))
    dense = materialise(
        sample.select("part", F.col("toxic").cast("double").alias("label"), feature_column(F.col("text"), lexicon, stems).alias("f")),
        "toxicity-features",
    ).withColumn("features", array_to_vector("f"))
    grow, check = dense.where("part between 4 and 7"), dense.where("part > 7")
    if grow.select("label").distinct().count() < 2 or check.select("label").distinct().count() < 2:
        return Model(lexicon, stems, None, None, prior)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED, maxBins=64, minInstancesPerNode=2).fit(
        grow.coalesce(4)
    )
    scored = trees.transform(check).select("label", vector_to_array("probability")[1].alias("raw"))
    isotonic = IsotonicRegression(featuresCol="raw").fit(scored)
    return Model(lexicon, stems, trees, isotonic, prior)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``_toxicity`` (0 to 1), from the text alone; null texts count as empty.

    Rows are carried as one struct, so no column's name can clash; a column that is called ``_toxicity`` already is
    replaced.  Repeated rows stay, with equal scores; an empty table gives no row.  Texts of any length are read in
    parts.
    """
    kept = [F.col(f"_doc.`{c}`").alias(c) for c in docs.columns if c != "_toxicity"]
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    if model.trees is None or model.isotonic is None:
        return docs.select(row).select(*kept, F.lit(float(model.prior)).alias("_toxicity"))
    dense = docs.select(row, array_to_vector(feature_column(F.col("text"), model.lexicon, model.stems)).alias("_features"))
    trees, isotonic = model.trees.copy(), model.isotonic.copy()
    trees.setFeaturesCol("_features").setRawPredictionCol("_margin").setProbabilityCol("_raw").setPredictionCol("_label")
    isotonic.setFeaturesCol("_p").setPredictionCol("_toxicity")
    raw = trees.transform(dense).withColumn("_p", vector_to_array("_raw")[1])
    scored = isotonic.transform(raw)
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("_toxicity")))
    return scored.select(*kept, bounded.alias("_toxicity"))


def detect(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted``: one row per row of ``docs``.

    Needs doc_id and text of ``docs``, doc_id and toxic of ``labels``; other columns are ignored.  Null and empty
    texts are scored like any other; a null doc_id is not held out; repeated rows get equal scores; of several
    labels of a doc_id one toxic one counts; an empty table gives no row.
    """
    out = score(docs.select("doc_id", "text"), fit(docs, labels))
    return out.select(
        F.col("doc_id").cast("long"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("_toxicity").alias("score"), (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"),
    )
