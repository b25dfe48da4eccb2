"""Best-fit packing of documents into sequences of a fixed number of tokens.

Large-item matching.  Documents longer than a sequence are cut; all that is left to place are pieces of 1 to
``capacity`` tokens.  Pieces above one third of the capacity go at most two to a bin, so a greedy matching pairs
each with the largest partner that fits.  Smaller pieces then go, largest first, to the bin with the least gap
that still takes them.

A piece matters only by its length, so the matching runs on the histogram of lengths, which has ``capacity`` rows
at most whatever the corpus; its plan says which ranks of each length go to which bins.  Pieces get their rank
within a length in parallel and look up their place.  So the packing is best-fit over the whole corpus, while no
task sees more than its share of pieces.
"""

from __future__ import annotations

import base64
import json
import re
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creaseline.llm.common import materialise, number_within, runs_by_bytes

CAPACITY = 1024
SEPARATOR = 2

#: Characters of a text that are encoded together; a longer text is cut at spaces between words, which no token crosses.
PART = 1 << 20
BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: Runs of the split pattern's white space that are encoded apart: the splitter tracks back through a run, and its
#: stack ends between 500,000 and 1,000,000 characters.
LONG_BLANK = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{100000,}")

PIECES = "doc_id long, piece int, start long, length long, ids binary"
PLAN = "length long, rank_from long, rank_to long, per_bin long, bin_from long, at long"


def encoder(ranks_path: str, pattern: str, added: dict[str, int] | None = None):
    """The byte-level BPE of a rank file; gives the ids of the tokenizer file with the same vocabulary.

    ``added`` are the tokens that ``encode(text, allowed_special="all")`` finds inside texts.
    """
    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added or {})


def tokenizer_files() -> tuple[str, str]:
    """Rank file and split pattern of the public 50k byte-level BPE, as installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def added_tokens() -> dict[str, int]:
    """The added tokens of the public tokenizer file, which it finds literally inside texts before any split."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    if any(t[flag] for t in tokens for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError("an added token is not matched literally")
    return {t["content"]: t["id"] for t in tokens}


def _part_ids(encoding, text: str) -> list[int]:
    """Ids of a part; of a long run of white space all but the last character are one piece where a word follows."""
    added = encoding.special_tokens_set

    def encode(part: str) -> list[int]:
        return encoding.encode(part, allowed_special="all") if added else encoding.encode_ordinary(part)

    ids, start = [], 0
    for run in LONG_BLANK.finditer(text):
        end = run.end()
        if end < len(text) and not any(text.startswith(token, end) for token in added):
            end -= 1
        ids += encode(text[start : run.start()])
        ids += encoding._encode_single_piece(text[run.start() : end])
        start = end
    return ids + encode(text[start:])


def text_ids(encoding, text: str, dtype: str = "<u4") -> np.ndarray:
    """Ids of a text of any length, with the added tokens of ``encoding``; about four bytes an id are held."""
    found, start = [], 0
    while len(text) - start > PART and (space := BETWEEN.search(text, start + PART)):
        found.append(np.array(_part_ids(encoding, text[start : space.start()]), dtype))
        start = space.start()
    found.append(np.array(_part_ids(encoding, text[start:]), dtype))
    return np.concatenate(found)


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` tokens; only the first may be shorter."""
    first = total % capacity or capacity
    return [(0, first), *((start, capacity) for start in range(first, total, capacity))]


def _tokenise_batches(capacity: int, separator: int, match_added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(*tokenizer_files(), added_tokens() if match_added else None)
        for batch in batches:
            docs, texts = batch.column("doc_id"), batch.column("text").fill_null("")
            sizes = pc.binary_length(texts).to_numpy()
            for begin, end in runs_by_bytes(sizes, 1 << 22):
                doc, piece, start, length, ids = [], [], [], [], []
                part = zip(docs.slice(begin, end - begin).to_pylist(), texts.slice(begin, end - begin).to_pylist())
                for doc_id, text in part:
                    tokens = np.append(text_ids(encoding, text), np.array([separator], "<u4")).tobytes()
                    for n, (at, size) in enumerate(cut(len(tokens) // 4, capacity)):
                        doc.append(doc_id)
                        piece.append(n)
                        start.append(at)
                        length.append(size)
                        ids.append(tokens[4 * at : 4 * (at + size)])
                columns = [(doc, pa.int64()), (piece, pa.int32()), (start, pa.int64()), (length, pa.int64()), (ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(*c) for c in columns], ["doc_id", "piece", "start", "length", "ids"]
                )

    return run


def tokenise(
    docs: DataFrame, capacity: int = CAPACITY, separator: int = SEPARATOR, match_added: bool = False
) -> DataFrame:
    """Pieces with their token ids (little-endian unsigned 32-bit): ``doc_id, piece, start, length, ids``.

    Needs doc_id and text; other columns are ignored.  A null or empty text is the separator alone.  Rows with
    the same doc_id are documents of their own.  An empty table gives no row.  ``match_added`` gives the tokenizer
    file's added tokens inside texts their own ids, as the file itself does; else they are ordinary text.
    """
    narrow = docs.select(F.col("doc_id").cast("long"), "text")
    return narrow.mapInArrow(_tokenise_batches(capacity, separator, match_added), PIECES)


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Places for ``counts[length]`` pieces of each length, as rows of ``PLAN``.

    Pieces of ``length`` with ``rank_from <= rank < rank_to`` go ``per_bin`` to a bin, beginning in bin
    ``bin_from``, the first of each bin at offset ``at``.
    """
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    rows, bins = [], 0
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first bin, number of bins), each at one filling
    order: list[int] = []  # gaps that have bins, ascending

    def place(length: int, number: int, per_bin: int, first: int, at: int) -> None:
        rows.append((length, used[length], used[length] + number, per_bin, first, at))
        used[length] += number
        left[length] -= number
        if not left[length]:
            del left[length]

    def offer(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append((first, number))

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if a not in left:
            large.pop()
            continue
        fits = bisect_left(large, capacity - a + 1) - 1
        while fits >= 0 and large[fits] not in left:
            large.pop(fits)
            fits -= 1
        b = large[fits] if fits >= 0 else None
        if b is None or b == a and left[a] == 1:
            smaller = next((n for n in reversed(large[:fits]) if n in left), None) if b == a else None
            if smaller is None:
                number = left[a] if b is None else 1
                place(a, number, 1, bins, 0)
                offer(capacity - a, bins, number)
                bins += number
                continue
            b = smaller
        number = left[a] // 2 if a == b else min(left[a], left[b])
        place(a, number, 1, bins, 0)
        place(b, number, 1, bins, a)
        offer(capacity - a - b, bins, number)
        bins += number
    for length in sorted(left, reverse=True):
        while length in left:
            k = bisect_left(order, length)
            if k == len(order):
                gap, (first, number) = capacity, (bins, -(-left[length] // (capacity // length)))
                bins += number
            else:
                gap = order[k]
                first, number = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(k)
            per_bin = gap // length
            full = min(number, left[length] // per_bin)
            if full:
                place(length, full * per_bin, per_bin, first, capacity - gap)
                offer(gap - per_bin * length, first, full)
            if full < number and length in left:
                some = left[length]
                place(length, some, some, first + full, capacity - gap)
                offer(gap - some * length, first + full, 1)
                full += 1
            offer(gap, first + full, number - full)
    return rows


def _plan_batches(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            for length, number in zip(batch.column("length").to_pylist(), batch.column("count").to_pylist()):
                counts[length] = counts.get(length, 0) + number
        rows = plan_bins(counts, capacity)
        names = [c.split()[0] for c in PLAN.split(", ")]
        columns = list(zip(*rows)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces with doc_id, piece and length (1 to ``capacity``).

    Every piece is placed once, whatever ties or repeated rows there are; the pieces of a sequence lie from
    offset 0 without gaps.  No piece gives no sequence.  ``pieces`` is read twice: pass a written table.
    """
    histogram = pieces.groupBy("length").count().coalesce(1)  # ``capacity`` rows at most
    plan = histogram.mapInArrow(_plan_batches(capacity), PLAN)
    ranges = plan.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("rank_from", "rank_to", "per_bin", "bin_from", "at"))).alias("_ranges")
    )
    keys = ["doc_id", "piece"] + [c for c in ("start", "ids_crc32") if c in pieces.columns]
    ranked = number_within(pieces, ["length"], keys, "_rank_in_length")
    # The plan is bounded by the capacity alone, so it can be broadcast.
    found = ranked.join(F.broadcast(ranges), "length").withColumn(
        "_place",
        F.try_element_at(
            F.filter(
                "_ranges",
                lambda r: (F.col("_rank_in_length") >= r["rank_from"]) & (F.col("_rank_in_length") < r["rank_to"]),
            ),
            F.lit(1),
        ),
    )
    step = F.col("_rank_in_length") - F.col("_place.rank_from")
    return found.select(
        *[F.col(c) for c in pieces.columns],
        (F.col("_place.bin_from") + F.floor(step / F.col("_place.per_bin"))).cast("long").alias("sequence_id"),
        (F.col("_place.at") + (step % F.col("_place.per_bin")) * F.col("length")).cast("long").alias("offset"),
    )


def packed_documents(
    docs: DataFrame, capacity: int = CAPACITY, separator: int = SEPARATOR, match_added: bool = False
) -> DataFrame:
    """Tokenises and packs: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Texts are tokenised once; the narrow piece table is written to the shared folder and the ids, which only
    :func:`tokenise` returns in full, are reduced to their checksum before any shuffle.

    Needs doc_id and text; other columns are ignored.  A null or empty text is the separator alone.  Repeated rows and
    those with a null doc_id are documents of their own.  Which of the pieces of one length takes which place is of no
    account.  Texts of any length are encoded in parts; an empty table gives no row.
    """
    pieces = tokenise(docs, capacity, separator, match_added).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return pack(materialise(pieces, "pieces"), capacity)
