"""Quality rules as a short-circuit cascade; DataFrame operations only.

Base statistics are computed for every text.  A text that the base conditions keep then meets the cascade's rules.
Each rule's cost and share of rejections are measured on a sample, and the rules run in the order of rejections per
cost; a CASE expression ends at the first rule that rejects.  The order changes the time, never the verdict.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import in_sample, materialise

#: Rows that a rule's cost and rejections are measured on, about.
SAMPLE_ROWS = 2000
#: A rule's cost is measured over so many evaluations a row, in so many runs, and counts as this at least.
REPEATS, RUNS, LEAST_SECONDS = 4, 2, 1e-3
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SPACE = r"[ \t-\r]+"
EDGES = " \t\n\x0b\f\r"
WORD = r"[^ \t-\r]"
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """Rejects a text when ``rejects`` is true; it may use the text and the base columns."""

    name: str
    rejects: Column


def rules() -> list[Rule]:
    """The production rules; each aims at one kind of junk and leaves ordinary prose alone."""
    words, chars = F.col("n_words"), F.col("word_chars")
    text = F.col("text")
    return [
        Rule("symbols", F.col("n_symbols") * 5 > words),
        Rule("word_length", (chars > 25 * words) | (chars < 2 * words)),
        Rule("repeated_words", F.col("n_repeat_words") * 20 > 9 * words),
        Rule("repeated_lines", F.col("n_dup_lines") * 10 > 6 * F.size(F.split(text, "\n"))),
        Rule("exclamations", F.regexp_count(text, F.lit("!")) * 5 > words),
        Rule("capitals", F.regexp_count(text, F.lit(r"\p{Lu}")) * 10 > 4 * chars),
        Rule("digits", F.regexp_count(text, F.lit("[0-9]")) * 10 > 3 * chars),
    ]


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where body uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    trimmed = F.trim(text, F.lit(EDGES))
    return F.when(trimmed != "", F.split(trimmed, SPACE)).otherwise(F.array().cast("array<string>"))


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more.

    Windows are compared by a 64-bit hash.  Sorting (hash, position) brings equal windows together; their positions,
    sorted, cover 3 words each less what they share with the one before.
    """
    one_each = F.transform(words, lambda w: F.xxhash64(w))

    def windows(h: Column) -> Column:
        n = F.size(h)
        return F.slice(
            F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))), 1, F.greatest(n - 2, F.lit(0))
        )

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, i: F.when(i == 0, 3).otherwise(F.least(F.lit(3), x - F.get(p, i - 1))))
        return F.aggregate(gaps, F.lit(0), lambda a, x: a + x)

    def positions(z: Column) -> Column:
        same = lambda i, s: F.coalesce(F.get(z, i)["h"] == s["h"], F.lit(False))
        hit = F.transform(
            z, lambda s, i: F.when(((i > 0) & same(i - 1, s)) | same(i + 1, s), s["p"]).otherwise(F.lit(-1))
        )
        return F.sort_array(F.filter(hit, lambda p: p >= 0))

    def count(w: Column) -> Column:
        marked = F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("p")))
        found = let(F.sort_array(marked), lambda z: let(positions(z), covered))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(found)

    return F.coalesce(let(let(one_each, windows), count), F.lit(0)).cast("long")


def with_base(docs: DataFrame) -> DataFrame:
    """``docs`` (text not null) with word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words and base_failed."""
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    staged = docs.withColumn("_words", words_of(F.col("text"))).withColumn("_lines", lines)
    counted = staged.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def rule_seconds(candidates: list[Rule], sample: DataFrame) -> dict[str, float]:
    """Seconds that each rule takes on ``sample``: the least of some runs, less that of a rule that looks at nothing.

    A run evaluates the rule ``REPEATS`` times for each row, so that a job's own time does not decide.
    """
    rows = sample.select("*", F.explode(F.sequence(F.lit(1), F.lit(REPEATS))).alias("_again"))

    def timed(condition: Column) -> float:
        began = time.perf_counter()
        rows.agg(F.count(F.when(condition, 1))).collect()
        return time.perf_counter() - began

    idle = min(timed(F.col("_again") < 0) for _ in range(RUNS))
    return {r.name: max(LEAST_SECONDS, min(timed(r.rejects) for _ in range(RUNS)) - idle) for r in candidates}


def order_rules(candidates: list[Rule], sample: DataFrame) -> list[Rule]:
    """Rules by rejections per second on ``sample``, which has the text and base columns; ties by name.

    Each rule is judged by what the rules before it leave: the rule with the best ratio comes first, its rejections
    leave the sample, and so on.  Without a rejection the cheaper rule comes first.
    """
    verdicts = sample.groupBy(*[F.coalesce(r.rejects, F.lit(False)).alias(r.name) for r in candidates]).count().collect()
    cost, left, out = rule_seconds(candidates, sample), list(candidates), []
    while left:
        rejected = {r.name: sum(v["count"] for v in verdicts if v[r.name]) for r in left}
        best = min(left, key=lambda r: (-rejected[r.name] / cost[r.name], cost[r.name], r.name))
        verdicts = [v for v in verdicts if not v[best.name]]
        left.remove(best)
        out.append(best)
    return out


def first_rejection(ordered: list[Rule]) -> Column:
    """Name of the first rule that rejects, else null; later rules aren't evaluated."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        verdict = F.when(rule.rejects, rule.name).otherwise(verdict)
    return verdict


def assess(docs: DataFrame, candidates: list[Rule] | None = None) -> DataFrame:
    """``doc_id``, the base columns, ``kept`` and ``rejected_by``: one row per row of ``docs``.

    Needs doc_id and text; other columns are ignored.  A null text has no words and fails the base.  kept is false
    if the base failed or a rule rejects; rejected_by is ``base`` or the rule.  Repeated rows and a null doc_id stay.
    A text of any length becomes one array of words in its row.  An empty table gives no row.
    """
    candidates = rules() if candidates is None else candidates
    narrow = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    rows = narrow.count()
    # The picked texts are written first, so that nothing is computed for the others.
    picked = materialise(narrow.where(in_sample(F.xxhash64("doc_id"), SAMPLE_ROWS, rows)), "quality-picked")
    sample = materialise(with_base(picked).where(~F.col("base_failed")), "quality-sample")
    ordered = order_rules(candidates, sample)
    verdict = F.when(F.col("base_failed"), "base").otherwise(first_rejection(ordered))
    return with_base(narrow).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        verdict.isNull().alias("kept"), verdict.alias("rejected_by"),
    )
