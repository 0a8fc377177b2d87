"""Packing token sequences into windows: non-negative least squares over length combinations."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.operators.numbering import number_rows

WINDOW = 2048
END = 1  # the id after each document
VOCABULARY = "byte_bpe_50k.tiktoken"  # the ranks of byte_bpe_50k.json
SPECIAL = {"<|endoftext|>": 50256}
SLACK = 4  # a window that lacks this many ids at most counts as full
SWEEPS = 40
PIECE = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, part_crcs array<long>"


def load_encoder(vocabulary: str = VOCABULARY):
    """``text -> list of ids`` for a file of ranks: a path, or the name of a public vocabulary.

    The strings of special tokens in a text give the special ids, as the JSON file's tokenizer does.
    """
    import base64
    import os

    import public_tokenizers
    import tiktoken

    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(
        "public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
    )

    def encode(text: str) -> list[int]:
        if any(name in text for name in SPECIAL):
            return encoding.encode(text, allowed_special="all")
        return encoding.encode_ordinary(text)

    return encode


def binary_parts(length: int) -> list[int]:
    """The powers of two that sum up to ``length``, largest first."""
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


def tokenized_pieces(docs: DataFrame, key: str, text: str, window: int, vocabulary: str) -> DataFrame:
    """Each document's ids and the end id, cut at multiples of ``window``; checksums, no ids.

    The last piece of a document also carries the checksum of each of its power-of-two parts, so
    that a later cut into those parts needs no second look at the text.
    """

    def each(batches: Iterator) -> Iterator:
        from zlib import crc32

        import numpy as np
        import pyarrow as pa

        encode = load_encoder(vocabulary)
        for batch in batches:
            keys, starts, lengths, sums, totals, parts = [], [], [], [], [], []
            for row, body in enumerate(batch.column(1).to_pylist()):
                ids = np.array([*encode(body or ""), END], dtype="<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    cuts = np.cumsum(binary_parts(len(piece)))[:-1] if len(piece) < window else ()
                    keys.append(row)
                    starts.append(start)
                    lengths.append(len(piece))
                    sums.append(crc32(piece.tobytes()))
                    totals.append(len(ids))
                    parts.append([crc32(p.tobytes()) for p in np.split(piece, cuts)] if len(cuts) else sums[-1:])
            columns = [batch.column(0).take(pa.array(keys, pa.int32()))]
            columns += [pa.array(x, pa.int64()) for x in (starts, lengths, sums, totals)]
            columns.append(pa.array(parts, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(
                columns, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part_crcs"]
            )

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(each, PIECE.format(rows.schema["doc_id"].dataType.simpleString()))


@dataclass(frozen=True)
class Pattern:
    """``repeats`` windows that hold pieces of these lengths, in this order."""

    lengths: tuple[int, ...]
    repeats: int


def combinations(lengths: list[int], window: int) -> list[tuple[int, ...]]:
    """Shallow combinations of occurring lengths that fill a window: all pairs, and for each
    length the threes that split the rest near fixed shares."""
    have, found = set(lengths), set()
    for a in lengths:
        rest = window - a
        if rest in have:
            found.add(tuple(sorted((a, rest), reverse=True)))
        for share in (2, 3, 4, 5, 8, 16):
            for b in range(rest // share, rest // share + 3):
                if b in have and rest - b in have:
                    found.add(tuple(sorted((a, b, rest - b), reverse=True)))
    return sorted(found, reverse=True)


def non_negative_counts(columns: list[tuple[int, ...]], counts: dict[int, int], sweeps: int = SWEEPS) -> list[float]:
    """Repeat counts ``x >= 0`` that minimise the squared gap between the pieces used and ``counts``.

    Coordinate descent: each step sets one count to its best value, given the others.
    """
    import numpy as np

    if not columns:
        return []
    gap = {length: float(n) for length, n in counts.items()}
    uses = [tuple((n, c.count(n)) for n in dict.fromkeys(c)) for c in columns]
    weight = [sum(m * m for _, m in u) for u in uses]
    x = np.zeros(len(columns)).tolist()
    for _ in range(sweeps):
        moved = 0.0
        for j, u in enumerate(uses):
            step = max(-x[j], sum(m * gap[n] for n, m in u) / weight[j])
            if step:
                x[j] += step
                moved = max(moved, abs(step))
                for n, m in u:
                    gap[n] -= m * step
        if moved < 0.25:
            break
    return x


def plan(counts: dict[int, int], window: int = WINDOW) -> tuple[list[Pattern], dict[int, int]]:
    """Patterns of full windows, and how many pieces of each length none of them takes.

    Works on the histogram alone: its size and time are bounded by the window, not by the data.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    patterns = []

    def take(lengths: tuple[int, ...], wanted: int) -> None:
        repeats = min([wanted, *(left.get(n, 0) // lengths.count(n) for n in set(lengths))])
        if repeats > 0:
            patterns.append(Pattern(lengths, repeats))
            for n in lengths:
                left[n] -= repeats

    take((window,), left.get(window, 0))
    columns = combinations(sorted(n for n in left if n < window), window)
    solved = non_negative_counts(columns, left)
    for j in sorted(range(len(columns)), key=lambda j: -solved[j]):
        take(columns[j], round(solved[j]))
    # what rounding and an uneven histogram leave: longest first, then whatever still fits best
    parked: dict[int, int] = {}
    lengths = sorted((n for n in left if left[n] > 0), reverse=True)
    while lengths:
        used, space = {}, window
        for n in lengths:
            fit = min(left[n], space // n)
            if fit > 0:
                used[n] = fit
                space -= n * fit
        if space <= SLACK:
            take(tuple(n for n in used for _ in range(used[n])), min(left[n] // used[n] for n in used))
        else:  # nothing fills up the window of the longest length: its pieces are cut later
            parked[lengths[0]] = left.pop(lengths[0])
        lengths = [n for n in lengths if left.get(n, 0) > 0]
    return patterns, parked


def plan_parts(counts: dict[int, int], window: int = WINDOW) -> list[Pattern]:
    """Patterns for pieces whose lengths are powers of two: full windows, then powers of two."""
    left, patterns = {n: c for n, c in counts.items() if c > 0}, []
    while total := sum(n * c for n, c in left.items()):
        space, used = min(window, 1 << (total.bit_length() - 1)), {}
        for n in sorted(left, reverse=True):
            fit = min(left[n], space // n)
            if fit > 0:
                used[n] = fit
                space -= n * fit
        repeats = min(left[n] // used[n] for n in used)
        if sum(n * used[n] for n in used) < window:
            repeats = 1
        patterns.append(Pattern(tuple(n for n in used for _ in range(used[n])), repeats))
        left = {n: rest for n in left if (rest := left[n] - repeats * used.get(n, 0))}
    return patterns


def slots_of(patterns: list[Pattern], base: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """``(length, first rank, end rank, first sequence, offset)`` of each place; the next sequence."""
    slots, ranks = [], {}
    for pattern in patterns:
        offset = 0
        for n in pattern.lengths:
            rank = ranks.get(n, 0)
            slots.append((n, rank, rank + pattern.repeats, base, offset))
            ranks[n] = rank + pattern.repeats
            offset += n
        base += pattern.repeats
    return slots, base


SLOT = "length long, low long, high long, first_sequence long, offset long"
RESULT = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _ranked(pieces: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Pieces with their rank among those of their length, and the histogram of lengths."""
    numbered = number_rows(pieces, ["length"], name="number", start=0)
    firsts = numbered.groupBy("length").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    bounded = firsts.collect()  # a row per length, at most as many as a window has places
    table = pieces.sparkSession.createDataFrame([(r["length"], r["first"]) for r in bounded], "length long, first long")
    ranked = numbered.join(F.broadcast(table), "length").withColumn("rank", F.col("number") - F.col("first"))
    return ranked, {r["length"]: r["n"] for r in bounded}


def _placed(ranked: DataFrame, slots: list) -> DataFrame:
    """Pieces in the places for their length; those beyond the last place have none and are left out."""
    places = F.broadcast(ranked.sparkSession.createDataFrame(slots, SLOT)).alias("s")
    here = (F.col("p.length") == F.col("s.length")) & F.col("p.rank").between(F.col("s.low"), F.col("s.high") - 1)
    return ranked.alias("p").join(places, here).select(
        "p.*", (F.col("s.first_sequence") + F.col("p.rank") - F.col("s.low")).alias("sequence_id"), "s.offset"
    )


def pack(
    docs: DataFrame, key: str, text: str, *, window: int = WINDOW, vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    Documents are cut at multiples of the window; whole windows stand alone. The histogram of the
    other lengths (at most ``window`` numbers) goes to the driver, which enumerates combinations
    that fill a window, solves their repeat counts by non-negative least squares, rounds, and packs
    the residual greedily. Lengths that fill no window are cut into powers of two, which fill windows
    exactly; the few sequences after the last full one have a power of two as length. So windows
    lack ``SLACK`` ids at most. Pieces find their place by their rank among pieces of their length;
    the table of places is bounded by the window as well.

    A NULL or empty text is the end id alone; a NULL key is kept as it is; rows with equal keys are
    packed each for itself; an empty table gives no rows; further columns are ignored.
    """
    if window < 2 or window & (window - 1):
        raise ValueError("the window must be a power of two")
    # written down: texts are tokenized once, however often the pieces are read
    pieces = stage(tokenized_pieces(docs, key, text, window, vocabulary), "pieces")
    ranked, counts = _ranked(pieces)
    patterns, parked = plan(counts, window)
    slots, base = slots_of(patterns, 0)
    whole = _placed(ranked, slots).select(RESULT)
    if not parked:
        return whole.withColumnRenamed("doc_id", key)

    # ranks from `counts - parked` on have no place: the same rows as in the plan, cut into parts
    cut = [(n, counts[n] - c) for n, c in parked.items()]
    border = F.broadcast(docs.sparkSession.createDataFrame(cut, "length long, low long"))
    powers = F.filter(
        F.transform(F.sequence(F.lit(window.bit_length() - 1), F.lit(0)), lambda k: F.pow(F.lit(2), k).cast("long")),
        lambda p: F.col("length").bitwiseAND(p) != 0,
    )
    parts = (
        ranked.join(border, "length")
        .where("rank >= low")
        .select("doc_id", "start", "doc_tokens", F.explode(F.arrays_zip(powers.alias("length"), F.col("part_crcs").alias("crc"))).alias("part"), F.col("length").alias("of"))
        .select(
            "doc_id",
            # the parts before this one are the larger powers of two in the piece's length
            (F.col("start") + F.col("of") - F.col("of") % (F.col("part.length") * 2)).alias("start"),
            F.col("part.length").alias("length"),
            F.col("part.crc").alias("ids_crc32"),
            "doc_tokens",
        )
    )
    ranked_parts, part_counts = _ranked(stage(parts, "parts"))
    part_slots, _ = slots_of(plan_parts(part_counts, window), base)
    return whole.unionByName(_placed(ranked_parts, part_slots).select(RESULT)).withColumnRenamed("doc_id", key)
