"""Spelling variant grouping: words one edit apart, found by pivotal bigrams.

Bigrams are ordered by how many words hold them, rare ones first.  A word's *prefix* is its three rarest bigrams and
all others as rare as the third; from it two disjoint *pivots* of least total frequency are chosen by dynamic
programming.  One inserted, deleted or replaced letter touches only one of two disjoint bigrams, so a pivot of each
word stands unharmed in the other, and of two near words the one whose prefix ends first has it in the other's prefix.
So pivots are looked up among prefixes only.

Positions limit what is looked up.  If a pivot is unharmed, the edit lies on one side of it: on the other side the
words agree to the end.  Where few letters must agree so, the side with the edit is halved, since the edit spares one
half; a word then asks for partners of its own length and of one more and one less.  Keys are hashes of the kind, the
place and the letters that must agree.  Every pair that keys bring together is verified by its edit distance, so
hashing can't give a wrong pair.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import materialise, pieces

MIN_CHARS, MIN_COUNT = 5, 3
#: A form is at least so many times as frequent.
RATIO = 2
#: One edit harms at most two bigrams, so the prefix has one more than two.
PREFIX = 3
#: UTF-8 of runs of a-z and U+00C0 to U+00FF.
RUN = re.compile(rb"[a-z]+(?:\xc3[\x80-\xbf][a-z]*)*|(?:\xc3[\x80-\xbf][a-z]*)+")
#: Letters that agree beside an edit from which on that side is not halved.
AGREEING = 5
#: Letters of the longest words that travel with their keys; longer ones are looked up again.
CARRIED = 64
_BASE, _PRIME = 1_000_003, (1 << 61) - 1


def count_runs(words: Counter, doc_id: int | None, text: bytes, damage: int | None) -> None:
    """Adds how often each run of letters (UTF-8, A-Z lower-cased) stands in a text.

    With ``damage``, a run loses a letter where the crc32 of its document's id and itself is a multiple of that.
    """
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    crc = zlib.crc32
    for piece in pieces(text.lower()):
        runs = RUN.findall(piece)
        words.update(runs)
        hurt = {run for run in set(runs) if not crc(run, start) % damage} if damage is not None else ()
        for run, n in Counter(run for run in runs if run in hurt).items() if hurt else ():
            letters = run.decode()
            at = crc(run, start) % len(letters)
            words[run] -= n
            words[(letters[:at] + letters[at + 1 :]).encode()] += n


def word_counts(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, damage: int | None = None) -> DataFrame:
    """``word, n``: words of enough code points that occur often enough in all texts together.

    Needs doc_id and text; other columns are ignored.  A null text has no word; repeated rows count; a null doc_id
    reads as empty in the rule of ``damage``.  Texts are read in parts.  An empty table gives no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Counter()
            for doc_id, text in zip(batch.column("_id").to_pylist(), batch.column("_text")):
                if text.is_valid:
                    count_runs(words, doc_id, text.as_py(), damage)
            found = [(w, n) for w, n in words.items() if n and len(w) >= min_chars]  # never more letters than bytes
            found = [(w, n) for w, n in found if w.isascii() or len(w.decode()) >= min_chars]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.binary()).cast(pa.string()), pa.array([n for _, n in found], pa.int64())], ["word", "n"])

    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("binary").alias("_text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def bigram_counts(words: DataFrame) -> dict[str, int]:
    """How often each bigram stands in the words: at most 90 x 90 entries, as there are 90 letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = Counter()
            for word in batch.column("word"):
                word = word.as_py()
                grams.update(map("".join, zip(word, word[1:])))
            yield pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], ["gram", "n"])

    rows = words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in rows.collect()}


def pivots(places: list[int], cost: list[int]) -> tuple[int, int]:
    """Two of the ascending ``places`` at least 2 apart whose costs sum to the least."""
    single = pair = None  # the cheapest place so far that is far enough behind, the cheapest pair so far
    behind = 0
    for i, place in enumerate(places):
        while places[behind] <= place - 2:
            if single is None or cost[behind] < cost[single]:
                single = behind
            behind += 1
        if single is not None and (pair is None or cost[single] + cost[i] < cost[pair[0]] + cost[pair[1]]):
            pair = single, i
    return places[pair[0]], places[pair[1]]


def prefix_and_pivots(word: str, counts: dict[str, int]) -> tuple[list[int], tuple[int, int]]:
    """Places of the prefix bigrams of a word of at least four letters, ascending, and its two pivots."""
    ranks = [(counts[word[i : i + 2]], word[i : i + 2]) for i in range(len(word) - 1)]
    last = sorted(ranks)[PREFIX - 1]
    places = [i for i, rank in enumerate(ranks) if rank <= last]
    return places, pivots(places, [ranks[i][0] for i in places])


def keys(word: str, places: Sequence[int], lengths: Sequence[int]) -> set[int]:
    """Keys of the bigrams at ``places`` for partners of these lengths: what must agree if the edit is behind or before.

    Parts are hashed in constant time each, by differences of running sums.
    """
    n = len(word)
    sums = list(accumulate(map(ord, word), lambda h, c: (h * _BASE + c) % _PRIME, initial=1))
    powers = list(accumulate(range(n), lambda p, _: p * _BASE % _PRIME, initial=1))
    out = set()
    for place in places:
        front, back = place + 2, n - place
        tail = (sums[n] - sums[place] * powers[back]) % _PRIME
        if front >= AGREEING:
            out.add(hash((0, front, sums[front])))
        if back >= AGREEING:
            out.add(hash((3, back, tail)))
        for length in lengths:
            if front < AGREEING and length >= front:
                half = (length - front) // 2
                out.add(hash((1, length, front, sums[front + half])))
                out.add(hash((2, length, front, sums[front], (sums[n] - sums[n - half] * powers[half]) % _PRIME)))
            if back < AGREEING and length >= back:
                half = (length - back) // 2
                out.add(hash((4, length, back, (sums[n] - sums[place - half] * powers[back + half]) % _PRIME)))
                out.add(hash((5, length, back, sums[half], tail)))
    return out


def _keyed(counts: dict[str, int], asking: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, owners = [], []
            for row, word in enumerate(batch.column("word").to_pylist()):
                prefix, chosen = prefix_and_pivots(word, counts)
                n = len(word)
                mine = keys(word, chosen, (n - 1, n, n + 1)) if asking else keys(word, prefix, (n,))
                found += mine
                owners += [row] * len(mine)
            rows = batch.select(["_id", "_carried", "n"]).take(pa.array(owners, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), *rows.columns], ["key", "id", "w", "n"])

    return run


def near_words(words: DataFrame) -> DataFrame:
    """``a, a_n, b, b_n`` (a < b): all pairs of words at edit distance one; ``words`` (word, n) are distinct, of at least 4 letters."""
    counts = bigram_counts(words)
    carried = F.when(F.length("word") <= CARRIED, F.col("word"))
    named = words.select("word", "n", F.xxhash64("word").alias("_id"), carried.alias("_carried"))
    keyed = lambda asking: named.mapInArrow(_keyed(counts, asking), "key long, id long, w string, n long")
    asked, held = keyed(True).alias("x"), keyed(False).alias("y")
    unlike = (F.col("x.key") == F.col("y.key")) & (F.col("x.id") != F.col("y.id"))
    close = F.coalesce(F.levenshtein("x.w", "y.w", 1) == 1, F.lit(True))  # of words that are not carried, below
    first = F.coalesce(F.col("x.w") < F.col("y.w"), F.col("x.id") < F.col("y.id"))
    side = lambda c: F.struct(F.col(f"{c}.w").alias("w"), F.col(f"{c}.n").alias("n"), F.col(f"{c}.id").alias("id"))
    pick = lambda yes, a, b: F.when(yes, a).otherwise(b)
    met = asked.join(held, unlike & close).select(pick(first, side("x"), side("y")).alias("a"), pick(first, side("y"), side("x")).alias("b"))
    pairs = materialise(met.distinct(), "met-words")
    short = F.col("a.w").isNotNull() & F.col("b.w").isNotNull()
    named = words.where(F.length("word") >= CARRIED).select("word", "n", F.xxhash64("word").alias("_id"))
    left, right = (named.select(F.col("_id").alias(f"_{c}"), F.col("word").alias(c), F.col("n").alias(f"{c}_n")) for c in "ab")
    looked = pairs.where(~short).select(F.col("a.id").alias("_a"), F.col("b.id").alias("_b")).join(left, "_a").join(right, "_b").where(F.levenshtein("a", "b", 1) == 1)
    first = F.col("a") < F.col("b")
    looked = looked.select(pick(first, F.col("a"), F.col("b")), pick(first, F.col("a_n"), F.col("b_n")), pick(first, F.col("b"), F.col("a")), pick(first, F.col("b_n"), F.col("a_n")))
    return pairs.where(short).select("a.w", "a.n", "b.w", "b.n").union(looked).toDF("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: where following forms ends.  A step doubles how far each word has looked."""
    up = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = up.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        step = up.join(further, F.col("root") == F.col("_at"), "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        step = materialise(step, "roots")
        if not step.where("_moved").limit(1).count():
            return step.select("word", "root")
        up = step.select("word", "root")


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each of ``words`` (word, n), which are distinct and of at least 4 letters.

    n_near counts the words at edit distance one.  Of those the most frequent (of ties the smallest) is the form if it
    is at least ``ratio`` times as frequent; the root is where forms lead, the word itself without one.  Forms are
    more frequent than their words for any ratio above 1, so there is no circle.  An empty table gives no row.
    """
    if ratio <= 1:
        raise ValueError("forms must be more frequent than their words")
    words = materialise(words.select("word", "n"), "words")
    near = materialise(near_words(words), "near-words")
    both = near.select(F.inline(F.array(
        F.struct(F.col("a").alias("_word"), F.col("a_n").alias("_own"), (-F.col("b_n")).alias("_less"), F.col("b").alias("_other")),
        F.struct(F.col("b").alias("_word"), F.col("b_n").alias("_own"), (-F.col("a_n")).alias("_less"), F.col("a").alias("_other")),
    )))
    best = both.groupBy("_word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct("_less", "_other")).alias("_best"), F.min("_own").alias("_own"))
    enough = -F.col("_best._less") >= F.col("_own") * ratio
    best = materialise(best.select("_word", "n_near", F.when(enough, F.col("_best._other")).alias("form"), F.when(enough, -F.col("_best._less")).alias("form_n")), "forms")
    ends = roots(best.where("form is not null").select(F.col("_word").alias("word"), "form")).select(F.col("word").alias("_end"), "root")
    found = words.join(best, F.col("word") == F.col("_word"), "left").join(ends, F.col("word") == F.col("_end"), "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
