"""Language identification with averaged hashed subword embeddings and a linear softmax.

Features are the byte n-grams of the lower-cased text with digits and ASCII punctuation as spaces, hashed into
``BUCKETS`` rows of an embedding table.  A text is the mean of its rows; a linear layer and a softmax give
languages.  Both are trained by stochastic gradient descent (with per-coordinate step sizes) in numpy, in one task,
on a bounded sample.  A temperature fitted on rows kept out of the descent calibrates the score; a text whose score
is below the calibrated threshold is rejected.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import flat_bytes, in_sample, label_share, materialise, runs_by_bytes

BUCKET_BITS = 15
BUCKETS = 1 << BUCKET_BITS
GRAMS = (3, 4)
DIMENSION = 8
EPOCHS, BATCH, RATE = 4, 16, 0.3
SEED = 7
#: Bounds of the training sample: about this many rows a language, of texts up to this many bytes, and about this many
#: bytes in all, of which each language has an equal part.
ROWS_PER_LANGUAGE, TRAIN_BYTES, TRAIN_TOTAL_BYTES = 400, 1 << 16, 1 << 26
#: Bytes whose n-grams are looked at together.
WINDOW = 1 << 20
#: Of the correct predictions kept for calibration, this share may fall below the threshold, which is at most 0.5.
REJECTED_SHARE, MAX_THRESHOLD = 0.002, 0.5
UNKNOWN = "und"

#: ASCII bytes that are no letters become spaces; bytes of other letters stay.
_SPACED = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # BUCKETS x dimension
    layer: np.ndarray  # dimension x languages
    temperature: float
    threshold: float


def folded(table: np.ndarray, layer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as one table of logits, since the mean is linear, where that is no wider than the embedding."""
    return (table @ layer, np.eye(layer.shape[1])) if layer.shape[1] <= layer.shape[0] else (table, layer)


def gram_buckets(data: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each byte; the last n - 1 bytes begin none."""
    length = max(0, len(data) - n + 1)
    h = np.full(length, n, np.uint32)
    for i in range(n):
        h = (h ^ data[i : i + length]) * np.uint32(0x01000193)
    return ((h * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int32)


def text_grams(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For runs of texts: their range, and for their n-grams the text's number in the run and the bucket.

    A run of one very long text comes in several parts with the same range, each with some of its n-grams.
    """
    for start, end in runs_by_bytes(pc.binary_length(texts).fill_null(0).to_numpy()):
        # Only a run's texts are copied.  A space on both sides; n-grams across texts are left out.
        offsets, data = flat_bytes(pc.utf8_lower(texts.slice(start, end - start)))
        sizes = np.diff(offsets) + 2
        edges = np.cumsum(sizes)
        padded = np.full(int(edges[-1]), 32, np.uint8)
        inner = np.ones(len(padded), bool)
        inner[edges - 1] = inner[edges - sizes] = False
        padded[inner] = _SPACED[data]
        for at in range(0, len(padded), WINDOW):
            part = padded[at : at + WINDOW + max(GRAMS) - 1]
            stop = at + len(part)
            # Owners of the bytes of this window alone, so that a long text needs no array of its length.
            low, high = np.searchsorted(edges, [at, stop - 1], side="right")
            owner = np.repeat(np.arange(low, high + 1, dtype=np.int32), np.diff(np.minimum(edges[low : high + 1], stop), prepend=at))
            owners, buckets = [], []
            for n in GRAMS:
                b = gram_buckets(part[: WINDOW + n - 1], n)
                same = owner[: len(b)] == owner[n - 1 : n - 1 + len(b)]
                owners.append(owner[: len(b)][same])
                buckets.append(b[same])
            yield start, end, np.concatenate(owners), np.concatenate(buckets)


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(texts.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)


def mean_logits(model: Model, texts: pa.Array) -> np.ndarray:
    means, counts = np.zeros((len(texts), model.table.shape[1])), np.zeros(len(texts))
    for start, end, owner, bucket in text_grams(texts):
        n = end - start
        counts[start:end] += np.bincount(owner, minlength=n)
        for k in range(means.shape[1]):
            means[start:end, k] += np.bincount(owner, weights=model.table[:, k][bucket], minlength=n)
    return means / np.maximum(counts, 1)[:, None] @ model.layer


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def predict(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and whether the text is rejected."""
    known = has_letter(texts)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    p = softmax(mean_logits(model, texts) / model.temperature)
    best = p.argmax(axis=1)
    score = np.where(known, p[np.arange(len(best)), best], 0.0)
    return [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)], score, ~known | (score < model.threshold)


def train(texts: list[str], languages: list[str]) -> Model:
    """Fits a model; every fifth row calibrates it and takes no part in the descent."""
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((0, 0)), 1.0, 0.0)
    number = {name: i for i, name in enumerate(names)}
    label = np.array([number[x] for x in languages])
    random = np.random.default_rng(SEED)
    grams: list = []
    for (start, end), parts in groupby(text_grams(pa.array(texts, pa.string())), key=lambda g: g[:2]):
        marks = np.concatenate([owner.astype(np.int64) * BUCKETS + bucket for _, _, owner, bucket in parts])
        keys, counts = np.unique(marks, return_counts=True)
        cuts = np.searchsorted(keys // BUCKETS, np.arange(end - start + 1))
        grams += [(keys[a:b] % BUCKETS, counts[a:b] / max(1, counts[a:b].sum())) for a, b in zip(cuts, cuts[1:])]
    held = np.arange(len(texts)) % 5 == 4
    rows = np.flatnonzero(~held)
    table = random.normal(0, 0.1, (BUCKETS, DIMENSION))
    layer = random.normal(0, 0.1, (DIMENSION, len(names)))
    table_sum, layer_sum = np.full(table.shape, 1e-8), np.full(layer.shape, 1e-8)
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        random.shuffle(rows)
        for at in range(0, len(rows), BATCH):
            some = rows[at : at + BATCH]
            size = [len(grams[i][0]) for i in some]
            owner = np.repeat(np.arange(len(some)), size)
            ids = np.concatenate([grams[i][0] for i in some])
            share = np.concatenate([grams[i][1] for i in some])
            mean = np.zeros((len(some), DIMENSION))
            np.add.at(mean, owner, table[ids] * share[:, None])
            error = softmax(mean @ layer)
            error[np.arange(len(some)), label[some]] -= 1
            back = (error @ layer.T)[owner] * share[:, None]
            step = mean.T @ error
            layer_sum += step**2
            layer -= rate * step / np.sqrt(layer_sum)
            unique, inverse = np.unique(ids, return_inverse=True)
            total = np.stack([np.bincount(inverse, weights=back[:, d]) for d in range(DIMENSION)], axis=1)
            table_sum[unique] += total**2
            table[unique] -= rate * total / np.sqrt(table_sum[unique])
    model = Model(names, *folded(table, layer), 1.0, 0.0)
    check = np.flatnonzero(held)
    if len(check):
        z = mean_logits(model, pa.array([texts[i] for i in check], pa.string()))
        loss = lambda t: -np.log(softmax(z / t)[np.arange(len(check)), label[check]] + 1e-12).mean()
        model.temperature = min(np.geomspace(0.1, 10, 41), key=loss)
        p = softmax(z / model.temperature)
        right = np.sort(p.max(axis=1)[p.argmax(axis=1) == label[check]])
        if len(right):
            model.threshold = min(MAX_THRESHOLD, float(right[int(REJECTED_SHARE * len(right))]))
    return model


def _train_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted(r for b in batches for r in zip(*(b.column(c).to_pylist() for c in ("mix", "doc_id", "text", "lang"))))
    model = train([r[2] for r in rows], [r[3] for r in rows])
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model.__dict__)], pa.binary())], ["model"])


def held_out(doc_id: Column) -> Column:
    return label_share(doc_id, 4) == 2


def fit(docs: DataFrame) -> Model:
    """Learns from text and non-null lang of rows that are not :func:`held_out`; the sample is bounded, see above.

    Every language takes part, however rare or frequent; texts over ``TRAIN_BYTES`` are predicted but not learnt from.
    """
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(held_out(F.col("doc_id")), F.lit(True))
        & (F.octet_length("text") <= TRAIN_BYTES)
    ).select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"), F.xxhash64("doc_id").alias("mix"))
    low = F.shiftrightunsigned("mix", 11)  # the order in which :func:`in_sample` takes rows
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"), F.min(low).alias("first"))
    # Written, so that its size is known and Spark broadcasts it if it is small: a corpus may have any number of names.
    sizes = materialise(sizes, "languages")
    each = TRAIN_TOTAL_BYTES / max(1, sizes.count())
    wanted = F.least(F.lit(float(ROWS_PER_LANGUAGE)), F.lit(each) * F.col("n") / F.greatest("bytes", F.lit(1)))
    shares = sizes.select(F.col("lang").alias("_of"), "n", wanted.alias("wanted"), "first")
    # The first row of each language always, however many languages share the bytes.
    taken = in_sample(F.col("mix"), F.col("wanted"), F.col("n")) | (low == F.col("first"))
    sample = usable.join(shares, F.col("lang") == F.col("_of")).where(taken)
    sample = sample.select("mix", "doc_id", "text", "lang").repartition(1)
    rows = sample.mapInArrow(_train_batches, "model binary").collect()
    return Model(**pickle.loads(rows[0]["model"])) if rows else train([], [])


def languages(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` and ``_language`` (lang, score, rejected), predicted from the text alone.

    A column that is called ``_language`` already is replaced; repeated rows stay, with equal predictions; an empty
    table gives no row.  Texts of any length are read in windows.
    """

    def run(texts: pa.Array) -> pa.Array:
        lang, score, rejected = predict(model, texts)
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
            ["lang", "score", "rejected"],
        )

    udf = F.arrow_udf(run, "struct<lang: string, score: double, rejected: boolean>")
    return docs.withColumn("_language", udf(F.col("text").cast("string")))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected``: one row per row of ``docs``.

    Needs doc_id, text and lang (lang only for learning); other columns are ignored.  Null texts and texts without
    a letter get ``und``, score 0 and are rejected.  If no row can be learnt from, all get ``und``.
    """
    out = languages(docs.select("doc_id", "text"), fit(docs))
    return out.select(
        F.col("doc_id").cast("long"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        F.col("_language.lang").alias("lang_pred"), F.col("_language.score").alias("score"),
        F.col("_language.rejected").alias("rejected"),
    )
