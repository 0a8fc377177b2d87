"""Line dedup by an exact set-similarity join; DataFrame operations only."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.operators.numbering import number_rows

# Jaccard similarity of 4/5 or more, in whole numbers: 9 * overlap >= 4 * (size of x + size of y).
BLANKS = r"[\x20\x09-\x0D]+"
#: Cells of the table of token counts that orders tokens by rarity, and of the filter of line hashes.
RARITY_CELLS = 1 << 18
CELLS_A_ROW = 4
FILTER_WORDS = 1 << 14


def words(low: Column) -> Column:
    """The words of a line in lower case, with empty ones between neighbouring blanks.

    ``low`` is read several times: it is to be a column that was made before.
    """
    # looking for one plain character, or parting at it, needs no regular expression; few lines hold other blanks
    others = [F.contains(low, F.lit(blank)) for blank in "\t\v\f\r"]
    return F.when(functools.reduce(Column.__or__, others), F.split(low, BLANKS)).otherwise(F.split(low, " "))


def word_set(low: Column) -> Column:
    """The set of the words of a line in lower case, as hashes: distinct words of one line have distinct hashes."""
    return F.array_remove(F.array_distinct(F.transform(words(low), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def by_sign(hashes: Column) -> Column:
    """The hashes in order; one zero more marks where the negative ones end, so that each word is handled once.

    Joined as arrays and not appended, as no item may be NULL for the array to be sorted as plain numbers.
    """
    return F.sort_array(F.concat(hashes, F.array(F.lit(0).cast("long"))))


def ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + F.lit(b - 1)) / F.lit(b)).cast("int")


def rarity(docs: DataFrame, text: str) -> Column:
    """An array literal: how frequent the words of each hash cell are in all texts, on a log scale.

    Any fixed order of tokens keeps the join exact; this one puts rare words first. The table has
    ``RARITY_CELLS`` numbers however many texts and words there are.
    """
    low = docs.select(F.lower(F.replace(F.col(text), F.lit("\n"), F.lit(" "))).alias("low"))
    hashes = low.select(F.explode(words(F.col("low"))).alias("word")).select(F.xxhash64("word").alias("h"))
    # cells side by side are counted in one row: few groups stay in the fast map of an aggregation
    rows = RARITY_CELLS // CELLS_A_ROW
    place = F.shiftright("h", rows.bit_length() - 1).bitwiseAND(F.lit(CELLS_A_ROW - 1))
    counts = [F.count(F.when(place == i, 1)).alias(f"of_{i}") for i in range(CELLS_A_ROW)]
    levels = [0] * RARITY_CELLS
    for row in hashes.groupBy(F.col("h").bitwiseAND(F.lit(rows - 1)).alias("cell")).agg(*counts).collect():
        for i in range(CELLS_A_ROW):
            levels[i * rows + row["cell"]] = int(3 * math.log2(1 + row[f"of_{i}"]))
    return F.split(F.lit(",".join(map(str, levels))), ",").cast("array<int>")


def occurrences(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, th, pos, line``: the lines of every text that have a word. ``th`` tells apart the texts of equal keys."""
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    lines = rows.select("key", "th", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return lines.where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def line_ids() -> tuple[Column, Column]:
    """A line's identity: 128 bits of two hashes."""
    return F.xxhash64("line").alias("id"), F.xxhash64(F.lit(1), "line").alias("id2")


def line_sets(lines: DataFrame, levels: Column) -> DataFrame:
    """``id, id2, n, low, high, prefix``: size, bits and rarest tokens of each different line.

    A set of n tokens and a longer or equal one with Jaccard 4/5 share a token among the first
    ``n - ceil(8 n / 9) + 1`` of the shorter and the first ``n - ceil(4 n / 5) + 1`` of the longer.
    ``low`` and ``high`` are the parity of the words per hash bit, of 64 for the negative hashes and 64
    for the others: two sets differ in at least as many words as their bits differ.
    """
    def ranked(h: Column) -> Column:
        level = F.get(levels, h.bitwiseAND(F.lit(RARITY_CELLS - 1)).cast("int"))
        # never NULL, which lets the array be sorted as plain numbers
        return F.shiftleft(F.coalesce(level, F.lit(0)).cast("long"), 48).bitwiseOR(h.bitwiseAND(F.lit((1 << 48) - 1)))

    def parity(hashes: Column) -> Column:
        # a shift goes by the last six bits of its distance
        def flip(bits: Column, h: Column) -> Column:
            return bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 33).cast("int")))

        return F.aggregate(hashes, F.lit(0).cast("long"), flip)

    # columns that are read more than once are computed once, by generated code, below those that read them
    made = lines.select(*line_ids(), F.lower("line").alias("low"))
    made = made.select("id", "id2", word_set(F.col("low")).alias("words"))
    ranks = F.sort_array(F.transform("words", ranked)).alias("ranks")
    signed = by_sign(F.col("words")).alias("signed")
    made = made.select("id", "id2", F.size("words").alias("n"), ranks, signed)
    made = made.select("*", F.array_position("signed", F.lit(0).cast("long")).cast("int").alias("zero"))
    n, zero = F.col("n"), F.col("zero")
    sets = made.select(
        "id",
        "id2",
        F.struct(
            n,
            parity(F.slice("signed", F.lit(1), zero - 1)).alias("low"),
            parity(F.slice("signed", zero + 1, n + 1 - zero)).alias("high"),
            F.transform(
                F.slice("ranks", 1, n - ceil_div(n * 4, 5) + 1),
                lambda t: t.bitwiseAND(F.lit((1 << 31) - 1)).cast("int"),
            ).alias("prefix"),
        ).alias("set"),
    )
    return sets.groupBy("id", "id2").agg(F.any_value("set").alias("set")).select("id", "id2", "set.*")


def prefix_rows(sets: DataFrame) -> DataFrame:
    """One row ``token, at`` per rare token of a line, with the line's other columns."""
    others = [c for c in sets.columns if c != "prefix"]
    # outer, or the optimizer tests the size of the array first and so computes it twice
    return sets.select(*others, F.posexplode_outer("prefix").alias("at", "token"))


#: Prefix filter: the common token is among the first ninth of the shorter line's.
OF_SHORTER = "9 * at <= n"
#: Whether two lines with a common token may be similar. Length filter: the smaller set has 4/5 of the
#: larger's tokens at least. Positional filter: what can stand before the common token on both sides, and
#: from it on, makes up the needed overlap. First of all, as it settles most pairs, the bits must not differ
#: in more places than the sets may.
MAY_MATCH = (
    "9 * (bit_count(x.low ^ y.low) + bit_count(x.high ^ y.high)) <= x.n + y.n"
    " AND 5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)"
    " AND 9 * (least(x.at, y.at) + least(x.n - x.at, y.n - y.at)) >= 4 * (x.n + y.n)"
)
#: Earlier lines with a common token that a line is compared with first: the first one, and so many just before.
BEFORE = 2


def first_candidates(rows: DataFrame) -> DataFrame:
    """``x, y``: each line with few earlier lines that share one of its rarest tokens, never more than ``1 + BEFORE`` a token."""
    of_token = Window.partitionBy("token").orderBy("line")
    whole = of_token.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = F.struct("line", "n", "low", "high", "at")
    earlier = [F.nth_value(seen, 1).over(whole), *(F.lag(seen, k + 1).over(of_token) for k in range(BEFORE))]
    names = [f"x{i}" for i in range(len(earlier))]
    met = rows.where(OF_SHORTER).select(seen.alias("y"), *(e.alias(x) for x, e in zip(names, earlier)))
    may = {x: F.expr(f"{x}.line < y.line AND {MAY_MATCH.replace('x.', f'{x}.')}") for x in names}
    # rows are repeated only where there is a pair
    met = met.where(functools.reduce(Column.__or__, may.values()))
    found = F.array(*(F.when(may[x], F.col(f"{x}.line")) for x in names))
    return met.select(F.explode(found).alias("x"), F.col("y.line").alias("y")).where("x IS NOT NULL").distinct()


def candidates(rows: DataFrame) -> DataFrame:
    """``x, y``: every earlier and later line that may be similar, where the later is not ``gone`` yet.

    The shorter line of a pair, or the earlier of two equally long ones, is met by its rarest tokens only.
    """
    shorter, longer = rows.where(OF_SHORTER).alias("x"), rows.alias("y")
    met = F.expr(
        "x.token = y.token AND (x.n < y.n OR (x.n = y.n AND x.line < y.line))"
        f" AND {MAY_MATCH} AND NOT CASE WHEN x.line < y.line THEN y.gone ELSE x.gone END"
    )
    pairs = shorter.join(longer, met)
    return pairs.select(F.least("x.line", "y.line").alias("x"), F.greatest("x.line", "y.line").alias("y")).distinct()


def bit_table(hashes: DataFrame, h: str) -> Callable[[Column], Column]:
    """A test of fixed size that all of the hashes pass, and most others only where there are very many."""
    def word(of: Column) -> Column:
        return of.bitwiseAND(F.lit(FILTER_WORDS - 1)).cast("int")

    def bit(of: Column) -> Column:
        return F.shiftright(of, 14).bitwiseAND(F.lit(63)).cast("int")

    one = F.lit(1).cast("long")
    mask = F.bit_or(F.call_function("shiftleft", one, bit(F.col(h)))).alias("mask")
    table = [0] * FILTER_WORDS
    for row in hashes.groupBy(word(F.col(h)).alias("word")).agg(mask).collect():
        table[row["word"]] = row["mask"]
    filled = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
    return lambda of: F.call_function("shiftright", F.get(filled, word(of)), bit(of)).bitwiseAND(one) == 1


def repeats(pairs: DataFrame, docs: DataFrame, key: str, text: str, numbers: DataFrame) -> DataFrame:
    """``line``: the later lines of the pairs whose Jaccard similarity is 4/5 or more, by their words.

    Only texts that hold the first place of a line that occurs in a pair are parted, and only such lines
    shuffled: bit tables of fixed size, built from hashes, keep most others out before the exact join.
    Words are compared by 64-bit hashes.
    """
    ends = pairs.select(F.explode(F.array("x", "y")).alias("line")).distinct()
    known = stage(ends.join(numbers.select("id", "id2", "line", F.xxhash64("first.key").alias("of")), "line"), "line-ends")
    has_end, is_end = bit_table(known, "of"), bit_table(known, "id")
    lines = occurrences(docs.where(has_end(F.xxhash64(key))), key, text)
    bodies = lines.select(*line_ids(), F.col("line").alias("body")).where(is_end(F.col("id")))
    chosen = bodies.join(known.drop("of"), ["id", "id2"]).groupBy("line").agg(F.min("body").alias("body"))
    sets = stage(chosen.select("line", F.lower("body").alias("low")).select("line", word_set(F.col("low")).alias("words")), "line-words")
    left = sets.select(F.col("line").alias("x"), F.col("words").alias("xs"))
    right = sets.select(F.col("line").alias("y"), F.col("words").alias("ys"))
    enough = 9 * F.size(F.array_intersect("xs", "ys")) >= 4 * (F.size("xs") + F.size("ys"))
    return pairs.join(left, "x").join(right, "y").where(enough).select(F.col("y").alias("line")).distinct()


def dedup_lines(docs: DataFrame, key: str, text: str, removed: str = "n_removed_lines") -> DataFrame:
    """``docs`` with repeated lines taken out of the text and their number in column ``removed``.

    Lines are parted at line feeds and ordered by (key, hash of the text, position), NULL keys first.
    A line goes if an earlier line is equal to it, or has a set of lower-cased words with Jaccard
    similarity 4/5 or more, whether or not that earlier line goes too. Lines without a word stay.

    The place of a line's first occurrence is found by a minimum combined in the tasks, and different
    lines are numbered in that order. As it is enough to find one earlier line, each line is first
    compared with few earlier lines per rare token, which settles most variants of a line in large
    groups of near copies; only lines still standing are then joined with all earlier ones.

    A NULL text stays NULL and an empty one empty; rows equal in key and text hold the same places,
    so neither repeats the other; an empty table gives no rows; other columns stay as they are (one
    named like ``removed`` is replaced).
    """
    lines = occurrences(docs, key, text)
    places = stage(
        lines.select(
            *line_ids(), F.struct("key", "th", "pos").alias("place")
        ),
        "places",
    )
    firsts = places.groupBy("id", "id2").agg(F.min("place").alias("first"))
    numbers = stage(number_rows(firsts, ["first"], name="line"), "first-places")
    sets = line_sets(lines, rarity(docs, text)).join(numbers.select("id", "id2", "line"), ["id", "id2"]).drop("id", "id2")
    sets = stage(sets, "line-sets")
    pairs = stage(first_candidates(prefix_rows(sets)), "first-pairs")
    gone = stage(repeats(pairs, docs, key, text, numbers).withColumn("gone", F.lit(True)), "first-gone")
    open_sets = sets.join(gone, "line", "left").withColumn("gone", F.coalesce("gone", F.lit(False)))
    open_sets = stage(open_sets, "open-sets")
    # one half of the tokens after the other: only the shuffles of one are on the disks at a time
    halves = [prefix_rows(open_sets).where(F.col("token").bitwiseAND(F.lit(1)) == half) for half in range(2)]
    pairs = functools.reduce(DataFrame.union, [stage(candidates(half), "line-pairs") for half in halves]).distinct()
    gone = gone.union(repeats(pairs, docs, key, text, numbers).withColumn("gone", F.lit(True)))
    verdict = stage(numbers.join(gone, "line", "left").select("id", "id2", "first", "gone"), "line-verdicts")
    goes = F.coalesce(F.col("gone"), F.lit(False)) | (F.col("place") != F.col("first"))
    gone = places.join(verdict, ["id", "id2"]).where(goes).select("place.*")
    per_text = gone.groupBy("key", "th").agg(F.collect_set("pos").alias("gone"))

    # the rows of docs as one struct, so that none of their names meets one from here
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    held = docs.select(row, F.col(key).alias("of"), F.xxhash64(text).alias("hash"))
    met = held.join(per_text, F.col("of").eqNullSafe(F.col("key")) & (F.col("hash") == F.col("th")), "left")
    body = F.col("row").getField(next(c for c in docs.columns if c.lower() == text.lower()))
    # once per text, not once per line
    met = met.withColumn("parts", F.when(F.col("gone").isNotNull(), F.split(body, "\n", -1)))
    left = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.col("gone"))
    kept = F.array_join(F.transform(left, lambda i: F.get(F.col("parts"), i)), "\n")
    columns = {c: F.col("row").getField(c) for c in docs.columns if c.lower() != removed.lower()}
    columns[next(c for c in columns if c.lower() == text.lower())] = F.when(F.col("gone").isNull(), body).otherwise(kept)
    count = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone"))
    return met.select(*(c.alias(n) for n, c in columns.items()), count.cast("long").alias(removed))
