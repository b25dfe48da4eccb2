"""Mixing sources to target weights by Pfair scheduling; DataFrame operations only.

A source's documents are dealt into blocks, and each slot of the output takes one block.  A source of weight w has
for its block j (from 0) a release time floor(j / w) and a deadline ceil((j + 1) / w), and every slot goes to the
released block of earliest deadline (of ties the first source).  So in every prefix of the output each source is
less than one block away from its weight times the prefix.

Who is next depends on all slots before, so the schedule is made once, from the weights alone, in one task: a *plan* of
at most ``MAX_SLOTS`` slots; blocks get more rows as the corpus grows.  The plan is a table of (slot, source, block),
and documents find their slots by joining it on source and block, which no key can skew: a block has its rows and no more.

The plan is worked out in chunks of slots.  Only the released blocks of earliest deadlines, as many as the chunk has
slots, and the blocks that are released inside it can be taken, so a slot costs the same for any number of sources,
and a chunk looks at each source once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creaseline.llm.common import materialise, number_within, partitions

#: Rows of a block at least; more where the plan would be too long.
BLOCK_ROWS = 32
#: Slots of a repeating period of rounded weights, and of a plan at most.
SLOTS, MAX_SLOTS = 1000, 1 << 18
#: Slots that are worked out together.
CHUNK = 32
#: Weights are integers of about this sum; no source has less than 1.
WEIGHT_SUM = 1 << 40
#: Weights by default: the source's share of rows to this power, so that large sources count a little less.
TEMPERING = 0.9
#: Repetitions of a source that is smaller than its weight asks for; None: as many as its weight asks for.  With a
#: number its later slots stay empty, so the mixture leaves its weights.
MAX_EPOCHS = None
#: Blocks of a source that are listed together.
STRIDE = 64
#: Columns that :func:`mix` adds.
PLACE = ("_epoch", "_block", "_slot", "_position")


def tempered_weights(docs: DataFrame, power: float = TEMPERING) -> DataFrame:
    """``source, weight``: rows of each source to a power."""
    return docs.groupBy("source").agg(F.pow(F.count(F.lit(1)).cast("double"), F.lit(power)).alias("weight"))


def parts(weights: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``source, parts``: positive weights as integers that sum to ``slots``, at least 1, by largest remainder.

    Sources without a positive finite weight are left out.  More than ``slots`` sources are an error.  These
    are the shares of a :func:`period`; :func:`mix` schedules exact weights.
    """
    everyone = Window.partitionBy()
    usable = weights.where((F.col("weight") > 0) & (F.col("weight") < float("inf")))
    share = F.col("weight") / F.sum("weight").over(everyone) * (F.lit(slots) - F.count(F.lit(1)).over(everyone))
    shared = usable.select("source", share.alias("share")).withColumn("whole", F.floor("share"))
    rest = F.lit(slots) - F.count(F.lit(1)).over(everyone) - F.sum("whole").over(everyone)
    ranked = shared.withColumn("rest", rest).withColumn(
        "rank", F.row_number().over(Window.orderBy((F.col("whole") - F.col("share")), F.col("source")))
    )
    whole = (1 + F.col("whole") + (F.col("rank") <= F.col("rest")).cast("long")).cast("int")
    return ranked.select(
        "source",
        F.when(
            F.count(F.lit(1)).over(everyone) > slots, F.raise_error(F.lit("more sources than slots in a period"))
        )
        .otherwise(whole)
        .alias("parts"),
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _block(j: Column, i: Column, q: Column, total: Column) -> Column:
    """Block j of source i as (deadline, source, release, j); in that order blocks are taken."""
    return F.struct(
        _div((j + 1) * total + q - 1, q).alias("d"), i.cast("int").alias("i"), _div(j * total, q).alias("r"), j.alias("j")
    )


def _candidates(done: Column, q: Column, total: Column, start: Column, end: Column) -> Column:
    """The blocks that slots from ``start`` to before ``end`` may take, by deadline."""
    heads = F.transform(q, lambda w, i: _block(done[i], i, w, total))
    waiting = F.slice(F.array_sort(F.filter(heads, lambda x: x["r"] <= start)), 1, CHUNK)
    # Of the blocks released after the first slot: from the first that is not done and released then, to the last.
    low = lambda w, i: F.greatest(done[i], _div((start + 1) * w + total - 1, total))
    high = lambda w: _div(end * w + total - 1, total) - 1
    spans = F.filter(F.transform(q, lambda w, i: F.struct(i.alias("i"), w.alias("w"), low(w, i).alias("a"), high(w).alias("b"))), lambda x: x["a"] <= x["b"])
    fresh = F.flatten(F.transform(spans, lambda x: F.transform(F.sequence(x["a"], x["b"]), lambda j: _block(j, x["i"], x["w"], total))))
    return F.array_sort(F.concat(waiting, fresh))


def _take(blocks: Column, start: Column, end: Column) -> Column:
    """Earliest deadline first: for each slot the source and block that it takes."""
    none = F.array().cast("array<struct<i: int, j: bigint>>")

    def slot(state: Column, at: Column) -> Column:
        first = F.filter(state["left"], lambda x: x["r"] <= at)[0]
        return _let(first, lambda x: F.struct(
            F.filter(state["left"], lambda y: (y["d"] != x["d"]) | (y["i"] != x["i"])).alias("left"),
            F.concat(state["taken"], F.array(F.struct(x["i"].alias("i"), x["j"].alias("j")))).alias("taken"),
        ))

    return F.aggregate(F.sequence(start, end - 1), F.struct(blocks.alias("left"), none.alias("taken")), slot, lambda state: state["taken"])


def schedule(shares: DataFrame, slots: Column | None = None) -> DataFrame:
    """``source, parts, nth, slot``: which block of which source each slot takes, by earliest deadline.

    ``shares`` has source and parts, its weight as a positive integer; ``slots`` is how many slots to fill, an aggregate
    over ``shares``, by default the sum of parts.  Nobody is more than a block ahead or behind in any prefix.
    """
    ends = F.sum("parts") if slots is None else slots
    listed = shares.agg(
        F.array_sort(F.collect_list(F.struct(F.struct("source").alias("of"), F.col("parts").cast("long").alias("q")))).alias("s"),
        F.sum(F.col("parts").cast("long")).alias("total"), ends.cast("long").alias("slots"),
    ).where("slots > 0").select("*", F.col("s.q").alias("q"))
    q, total, end = F.col("q"), F.col("total"), F.col("slots")
    none = F.array().cast("array<array<struct<i: int, j: bigint>>>")

    def chunk(state: Column, start: Column) -> Column:
        stop = F.least(start + CHUNK, end)

        def after(taken: Column) -> Column:
            count = lambda i: F.size(F.filter(taken, lambda x: x["i"] == i)).cast("long")
            done = F.transform(state["done"], lambda n, i: n + F.when(F.array_contains(taken["i"], i), count(i)).otherwise(F.lit(0).cast("long")))
            return F.struct(done.alias("done"), F.concat(state["out"], F.array(taken)).alias("out"))

        blocks = _candidates(state["done"], q, total, start, stop)
        return _let(blocks, lambda found: _let(_take(found, start, stop), after))

    start = F.struct(F.transform(q, lambda _: F.lit(0).cast("long")).alias("done"), none.alias("out"))
    run = F.aggregate(F.sequence(F.lit(0).cast("long"), end - 1, F.lit(CHUNK).cast("long")), start, chunk, lambda state: F.flatten(state["out"]))
    taken = listed.select("s", F.posexplode(run).alias("slot", "x")).select("slot", "x.j", F.get("s", F.col("x.i")).alias("of"))
    return taken.select(F.col("of.of.source").alias("source"), F.col("of.q").alias("parts"), F.col("j").alias("nth"), "slot")


def period(shares: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``source, parts, nth, slot``: the slots of one period, for ``parts`` that sum to ``slots``."""
    return schedule(shares, F.lit(slots))


def whole_weights(weights: DataFrame) -> DataFrame:
    """``source, parts``: weights as integers of about ``WEIGHT_SUM`` in all, at least 1.

    Sources without a positive finite weight are left out; weights of rows with the same source add up.
    """
    usable = weights.where((F.col("weight") > 0) & (F.col("weight") < float("inf"))).groupBy("source").agg(F.sum("weight").alias("weight"))
    whole = usable.agg(F.sum("weight").alias("_sum"))  # a single row
    share = F.round(F.col("weight") / F.col("_sum") * WEIGHT_SUM)
    return usable.crossJoin(whole).select("source", F.greatest(F.lit(1), share).cast("long").alias("parts"))


def plan(counts: DataFrame, weights: DataFrame, block_rows: int = BLOCK_ROWS, slots: int = MAX_SLOTS) -> tuple[DataFrame, int]:
    """``source, blocks, nth, slot`` and the rows of a block, for ``counts`` (source, n) and weights.

    Slots end with the deadline by which every source has placed all its blocks once.  A block has ``block_rows`` rows, or as many more as
    bring the end to within ``slots``.  A source whose weight asks for less than a block in so many slots can't be
    placed by its deadline; it comes at the end.
    """
    known = counts.select(F.struct("source").alias("_of"), "n")
    parts_ = whole_weights(weights)
    sized = materialise(parts_.join(known, F.struct("source") == F.col("_of")).select("source", "parts", "n"), "shares")
    total = sized.agg(F.sum("parts").alias("total"), F.count(F.lit(1)).alias("sources")).first()
    if not total["sources"]:
        none = [F.lit(1).cast("long").alias(c) for c in ("blocks", "nth", "slot")]
        return sized.select("source", *none), block_rows  # no rows
    if total["sources"] > slots:
        raise ValueError(f"more sources than slots in a plan: {total['sources']}")
    # A source has so many slots of the plan; its last block may be a short one, so one slot is spare.
    own = F.col("parts") / F.lit(float(total["total"])) * slots
    needed = sized.where(F.col("n") > block_rows).agg(F.max(F.when(own >= 2, F.col("n") / (own - 1)).otherwise(F.col("n")))).first()[0]
    rows = max(block_rows, -int(-(needed or 0) // 1))
    blocks = F.ceil(F.col("n") / rows)
    # A hair less, since weights are rounded; a block that misses by it comes at the end.
    deadline = F.ceil(blocks * F.lit(float(total["total"])) / F.col("parts") * (1 - 1e-9))
    last = F.least(F.lit(slots), F.max(deadline))
    made = materialise(schedule(sized, last), "plan")
    sizes = sized.select(F.struct("source").alias("_of"), blocks.alias("blocks"))
    placed = made.join(sizes, F.struct("source") == F.col("_of")).select("source", "blocks", "nth", F.col("slot").cast("long").alias("slot"))
    placed = materialise(placed, "placed")
    counted = placed.groupBy(F.struct("source").alias("_of")).agg(F.max("nth").alias("_last"))
    late = sized.select("source", blocks.alias("blocks")).join(counted, F.struct("source") == F.col("_of"), "left").withColumn("_next", F.coalesce(F.col("_last") + 1, F.lit(0)))
    late = late.where("_next < blocks").select("source", "blocks", F.explode(F.sequence("_next", F.col("blocks") - 1, F.lit(STRIDE).cast("long"))).alias("_run"))
    late = late.select("source", "blocks", F.explode(F.sequence("_run", F.least(F.col("_run") + STRIDE, "blocks") - 1)).alias("nth"))
    if not late.limit(1).count():
        return placed, rows
    end = placed.agg(F.max("slot")).first()[0]
    after = F.row_number().over(Window.orderBy("nth", "source")) + F.lit(end)  # fewer than sources and slots
    return placed.unionByName(late.withColumn("slot", after.cast("long"))), rows


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    block_rows: int = BLOCK_ROWS,
    slots: int = MAX_SLOTS,
    max_epochs: int | None = MAX_EPOCHS,
) -> DataFrame:
    """All columns of ``docs`` and ``_epoch, _block, _slot, _position``; sort by ``_position`` for the mixture.

    The mixture ends with the deadline by which every row was placed once; until then sources that ran out are repeated, up to
    ``max_epochs`` times (None: as often as their weight asks), so no row is dropped.  Needs doc_id and source; a
    null source is a source of its own; sources without a weight are left out.  Rows of a source come in a
    pseudo-random order that depends on doc_id alone; rows with equal doc_id, or none, are rows of their own.  Columns
    of ``docs`` may have any names; one that is called like an added column is replaced.  An empty table gives no row.
    Blocks have ``block_rows`` rows, or more where the plan would have more than ``slots`` slots.
    """
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    weights = tempered_weights(docs) if weights is None else weights
    placed, rows = plan(counts, weights, block_rows, slots)
    if max_epochs is not None:
        placed = placed.where(F.col("nth") < F.col("blocks") * max_epochs)
    # A slot of the plan asks for a block of the source's rows, which are gone through again and again.
    asked = materialise(
        placed.select(F.struct("source", (F.col("nth") % F.col("blocks")).alias("block")).alias("_asked"), _div(F.col("nth"), F.col("blocks")).alias("_turn"), "nth", "slot"), "slots"
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    ranked = number_within(docs.select(row, F.col("source").alias("of"), F.col("doc_id").alias("id")), ["of"], ["id"], "rank")
    held = ranked.select("doc", "rank", F.struct(F.col("of").alias("source"), F.floor(F.col("rank") / rows).alias("block")).alias("_held"))
    # As many slots as the plan has: the tables' sizes decide how they are joined.
    joined = held.join(asked, F.col("_held") == F.col("_asked"))
    kept = [F.col(f"doc.`{c}`").alias(c) for c in docs.columns if c not in PLACE]
    return joined.select(
        *kept, F.col("_turn").alias("_epoch"), F.col("nth").alias("_block"), F.col("slot").alias("_slot"),
        (F.col("slot") * rows + F.col("rank") % rows).alias("_position"),
    )


def in_order(mixed: DataFrame) -> DataFrame:
    """The mixture laid out in its order: contiguous ranges of positions, sorted inside."""
    return mixed.repartitionByRange(partitions(mixed.sparkSession), "_position").sortWithinPartitions("_position")
