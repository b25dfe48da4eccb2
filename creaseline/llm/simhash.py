"""SimHash near-duplicate detection with pigeonhole blocks.

A text's fingerprint has 64 bits; texts link when their fingerprints differ in at most three.  The fingerprint is
split into five blocks; three differing bits leave two blocks intact, so linked fingerprints agree on one of the
ten pairs of blocks (25 or 26 bits).  Distinct fingerprints are joined on each pair of blocks and candidates are
verified by their Hamming distance.  Copies share a fingerprint and are one row of that join.  From some billions of
fingerprints on there are six or seven blocks, of which three or four stay intact: more keys, of more bits each.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import materialise, pieces
from creaseline.llm.components import connected_components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
#: Bytes of a text that are looked at together.
PART = 1 << 17
#: A fingerprint has at least so many blocks, and at most; see :func:`blocks_for`.
LEAST_BLOCKS, MOST_BLOCKS = 5, 7
#: So many unrelated fingerprints may share a key: comparing these costs about what one more key to shuffle does.
KEY_ROWS = 100


def text_fingerprint(text: bytes | None, words_per_shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of the word shingles of a text, A-Z lower-cased.

    Words are runs of bytes other than space and tab to carriage return.  A text of fewer words than a shingle
    counts as one shingle; one without words, or null, has fingerprint 0.
    """
    import xxhash

    digest = xxhash.xxh64_intdigest
    ones, total, words = np.zeros(64, np.int64), 0, []
    for part in pieces(text or b"", PART):
        # The last words of a part begin the shingles that go on in the next.
        words = words[max(0, len(words) - words_per_shingle + 1) :] + part.lower().split()
        n = len(words) - words_per_shingle + 1
        if n < 1:
            continue
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(sizes + 1) - 1
        spans = zip((ends - sizes)[:n].tolist(), ends[words_per_shingle - 1 :].tolist())
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), "<u8", n)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += n
    if not total:
        return digest(b" ".join(words), seed) if words else 0
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _fingerprints(texts: pa.Array) -> pa.Array:
    values = [text_fingerprint(text.as_py()) for text in texts.cast(pa.large_binary())]
    return pa.array(np.array(values, np.uint64).view(np.int64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (its 64 bits as a long): one row per row of ``docs``.

    Null, empty and wordless texts have fingerprint 0; repeated rows and a null doc_id stay; an empty table gives no
    row.  Texts are read in parts, so that a very long one costs little more memory than its own bytes.
    """
    fingerprint = F.arrow_udf(_fingerprints, "long")
    return docs.select(F.col("doc_id").cast("long"), fingerprint("text").alias("fingerprint"))


def widths(blocks: int) -> list[int]:
    """Widths of the blocks of a fingerprint, from its low end; they differ by one bit at most."""
    return [64 // blocks + (i < 64 % blocks) for i in range(blocks)]


def blocks_for(rows: int) -> int:
    """Blocks for a number of distinct fingerprints: the fewest that leave about ``KEY_ROWS`` unrelated ones to a key.

    Every choice finds all pairs; they differ in cost alone.
    """
    for blocks in range(LEAST_BLOCKS, MOST_BLOCKS):
        if rows <= KEY_ROWS << sum(sorted(widths(blocks))[: blocks - MAX_BITS]):
            return blocks
    return MOST_BLOCKS


def close_pairs(distinct: DataFrame, max_bits: int = MAX_BITS, blocks: int = LEAST_BLOCKS) -> DataFrame:
    """``a, b`` (a < b): all pairs of distinct fingerprints within ``max_bits``, which is at most three: more would escape the blocks."""
    if max_bits > MAX_BITS:
        raise ValueError(f"blocks find pairs of up to {MAX_BITS} bits, not {max_bits}")
    sizes = widths(blocks)

    def block(i: int) -> Column:
        return F.shiftrightunsigned("fingerprint", sum(sizes[:i])).bitwiseAND(F.lit((1 << sizes[i]) - 1))

    def key(number: int, intact: tuple[int, ...]) -> Column:
        start = F.lit(number).cast("long")
        return reduce(lambda value, i: F.shiftleft(value, sizes[i]).bitwiseOR(block(i)), intact, start)

    keys = F.array(*[key(n, intact) for n, intact in enumerate(combinations(range(blocks), blocks - MAX_BITS))])
    keyed = distinct.select(F.explode(keys).alias("key"), "fingerprint")
    left = keyed.withColumnRenamed("fingerprint", "a")
    right = keyed.withColumnRenamed("fingerprint", "b").withColumnRenamed("key", "other")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    return left.join(right, (F.col("key") == F.col("other")) & (F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per row of ``docs``.

    component_id is the least doc_id reachable over links of at most ``max_bits`` differing bits.  Needs doc_id
    and text; other columns are ignored; null, empty and wordless texts have fingerprint 0 and link like others.
    Rows with a null doc_id link like others and name no component unless a group has no other id (then null).
    Repeated rows stay; equal ids are one member.  An empty table gives no row.  The number of distinct fingerprints
    sets the blocks of the search, which finds the same pairs with any.
    """
    marked = materialise(fingerprints(docs), "fingerprints")
    classes = materialise(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")), "classes")
    pairs = close_pairs(classes.select("fingerprint"), max_bits, blocks_for(classes.count()))
    groups = connected_components(pairs)
    linked = classes.join(groups, classes["fingerprint"] == groups["id"])
    least = linked.groupBy("component").agg(F.min("first_id").alias("least_id"))
    # Only linked fingerprints are joined; the others stay their own component.
    moved = linked.join(least, "component").select(F.col("fingerprint").alias("_f"), "least_id")
    owners = classes.join(moved, classes["fingerprint"] == F.col("_f"), "left").select(
        F.col("fingerprint").alias("_f"), F.coalesce("least_id", "first_id").alias("component_id")
    )
    # A table of its own, so that the join below is a plain one whose skewed fingerprints Spark can split.
    owners = materialise(owners, "owners")
    return marked.join(owners, marked["fingerprint"] == F.col("_f")).select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )
