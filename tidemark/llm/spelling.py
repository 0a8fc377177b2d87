"""Words of a corpus that differ by one letter, found by scans of sorted lists with a banded edit matrix."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

#: Runs of letters that count as words, after A-Z has been lower-cased.
LETTERS = "a-zA-ZÀ-ÿ"
LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A word is a variant of a near word that is so many times as frequent.
TIMES = 5
#: Lists with more words are parted again; a memory bound, nothing is left out.
LIST_WORDS = 1024
#: Distinct words that a task counts before it hands the counts on, and characters it cuts from a text at once.
COUNTED = 200_000
PIECE = 1 << 20


def words_of(body: str) -> Iterator[list[str]]:
    """The runs of letters of a text with A-Z lower-cased, a list for each piece of a long text."""
    runs = re.compile(f"[{LETTERS}]+")
    plain = body.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A-Z only
    if len(plain) <= PIECE:
        yield runs.findall(plain)
        return
    at = 0
    while at < len(plain):
        end = min(len(plain), at + PIECE)
        if open_run := runs.match(plain, end):  # no run is cut
            end = open_run.end()
        yield runs.findall(plain, at, end)
        at = end


def vocabulary(
    docs: DataFrame, key: str, text: str, *,
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip_every: int | None = None,
) -> DataFrame:
    """``word, n``: the words of all whole texts with so many letters and occurrences.

    With ``slip_every``, a letter is struck out of some words first: where that number divides the
    checksum h of ``<key>:<word>`` (a NULL key is empty), the code point at h modulo the length.
    Tasks hand on counts of distinct words; a NULL text has no words.
    """

    def each(batches: Iterator) -> Iterator:
        import pyarrow as pa

        totals: Counter = Counter()

        def flushed():
            made = pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array(list(totals.values()), pa.int64())], ["word", "n"])
            totals.clear()
            return made

        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed = zlib.crc32(f"{'' if name is None else name}:".encode())
                for words in words_of(body or ""):
                    for word, n in Counter(words).items():
                        if slip_every and (h := zlib.crc32(word.encode(), seed)) % slip_every == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        if len(word) >= least_length:
                            totals[word] += n
                    if len(totals) > COUNTED:
                        yield flushed()
        yield flushed()

    rows = docs.select(F.col(key).cast("string"), F.col(text)).where(F.col(text).isNotNull())
    counted = rows.mapInArrow(each, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def lists(words: DataFrame, ranges) -> DataFrame:
    """``list, longest, start, stop, word, n``: each word in the lists of its ranges.

    A list holds words of ``longest`` letters or one less that agree before ``start`` and from
    ``stop`` on, counted in the longer word: any pair whose one edit lies in the range is together in it.
    """
    placed = words.select("word", "n", F.explode(ranges).alias("r")).select("word", "n", "r.*")
    head = F.expr("substring(word, 1, start)")
    tail = F.expr("right(word, longest - stop)")
    return placed.select(F.concat_ws("|", "longest", "start", "stop", head, tail).alias("list"), "longest", "start", "stop", "word", "n")


def halves(longest, start, stop):
    """The two halves of a range of letters as an array of structs."""
    middle = F.floor((start + stop) / 2).cast("int")
    parts = [
        F.struct(longest.alias("longest"), a.cast("int").alias("start"), b.cast("int").alias("stop"))
        for a, b in ((start, middle), (middle, stop))
    ]
    return F.array(*parts)


def near_in_sorted(words: Sequence[str], longest: int, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """Positions of the pairs at one edit whose longer word has ``longest`` letters and whose first
    differing letter lies in the range.

    Each word goes down the sorted list after it. Rows of the edit matrix, three cells around the
    diagonal, are kept for the letters that neighbours share; where a row is above one edit, all
    words that share those letters are skipped at once.
    """
    count = len(words)
    shared = [0] * (count + 1)  # letters shared with the word before
    for j in range(1, count):
        a, b, k = words[j - 1], words[j], 0
        most = min(len(a), len(b))
        while k < most and a[k] == b[k]:
            k += 1
        shared[j] = k
    shared[count] = -1
    later, stack = [count] * (count + 1), []  # where a smaller number of shared letters comes next
    for j in range(count + 1):
        while stack and shared[stack[-1]] > shared[j]:
            later[stack.pop()] = j
        stack.append(j)

    for i in range(count - 1):
        size = len(words[i])
        own = words[i] + "\0\0\0"  # cells beyond the word never lead back into it
        rows = [(2, 0, 1)] + [(1, 0, 1)] * size  # its own prefixes
        alike, j = size, i + 1
        while j < count:
            word, depth = words[j], shared[j]
            alike = min(alike, depth)
            if alike < start:  # sorted: so are all that follow
                break
            depth = min(depth, len(rows) - 1)
            del rows[depth + 1 :]
            a, b, c = rows[depth]
            k, dead = depth, False
            for letter in word[depth:]:
                k += 1
                x = min(a + (letter != own[k - 2]), b + 1) if k > 1 else min(a, b + 1)
                y = min(b + (letter != own[k - 1]), c + 1, x + 1)
                c = min(c + (letter != own[k]) if k <= size else 2, y + 1)
                a, b = x, y
                rows.append((a, b, c))
                if a > 1 and b > 1 and c > 1 or k > size + 1:
                    dead = True
                    break
            if dead:
                j += 1
                while shared[j] >= k:
                    j = later[j]
                continue
            if -1 <= size - k <= 1 and (a, b, c)[size - k + 1] == 1 and max(size, k) == longest and start <= alike < stop:
                yield i, j
            j += 1


def near_pairs(placed: DataFrame) -> DataFrame:
    """``word, near, near_n`` of both words of each pair, each once, from the rows of ``lists``."""

    def each(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def found(bounds, words, counts):
            for i, j in near_in_sorted(words, *bounds):
                yield words[i], words[j], counts[j]
                yield words[j], words[i], counts[i]

        def packed(rows):
            kinds = (pa.string(), pa.string(), pa.int64())
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays(columns, ["word", "near", "near_n"])

        now, bounds, words, counts, rows = None, (0, 0, 0), [], [], []
        for batch in batches:
            for name, longest, start, stop, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if name != now:
                    rows.extend(found(bounds, words, counts))
                    now, bounds, words, counts = name, (longest, start, stop), [], []
                words.append(word)
                counts.append(n)
                if len(rows) >= 10_000:
                    yield packed(rows)
                    rows = []
        rows.extend(found(bounds, words, counts))
        yield packed(rows)

    tasks = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartition(tasks, "list").sortWithinPartitions("list", "word")
    return ordered.mapInArrow(each, "word string, near string, near_n long")


def group_variants(words: DataFrame, *, times: int = TIMES, list_words: int = LIST_WORDS) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for the rows ``word, n`` of a vocabulary.

    Two words are near at exactly one inserted, deleted or replaced code point. ``form`` is the near
    word of largest ``n`` (ties: smallest in code-point order) if that is at least ``times`` the
    word's own; ``root`` is what following forms leads to, the word itself without a form.

    One edit leaves one half of the longer word as it is, so a word goes to one sorted list for
    each half that it keeps. Lists longer than ``list_words`` are parted by quarters, eighths and so
    on, down to a single letter, where the alphabet bounds them; no list is cut. A pair counts in
    the list of the range that holds its first differing letter, so it is found once.

    Words are distinct and not NULL; an empty vocabulary gives no rows, further columns are ignored.
    """
    words = stage(words.select("word", "n"), "vocabulary")
    size = F.length("word")
    whole = F.concat(*(halves(m, F.lit(0), m) for m in (size, size + 1)))
    open_lists, pairs = lists(words, whole), None
    while True:
        most = open_lists.groupBy("list").agg(F.count(F.lit(1)).alias("rows"), F.first(F.col("stop") - F.col("start")).alias("letters"))
        long = stage(most.where((F.col("rows") > list_words) & (F.col("letters") > 1)).select("list"), "long-lists")
        done = long.isEmpty()
        found = near_pairs(open_lists if done else open_lists.join(long, "list", "left_anti"))
        pairs = found if pairs is None else pairs.union(found)
        if done:
            break
        again = open_lists.join(long, "list")
        open_lists = stage(lists(again, halves(F.col("longest"), F.col("start"), F.col("stop"))), "lists")
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("form"))).alias("best")
    nearest = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    form_n = -F.col("best.order")
    strong = form_n >= F.lit(times) * F.col("n")
    known = words.join(nearest, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(strong, F.col("best.form")).alias("form"), F.when(strong, form_n).alias("form_n"),
    )
    known = stage(known, "forms")
    roots = follow(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def follow(links: DataFrame) -> DataFrame:
    """``word, root`` for links that lead to larger counts, so never in a circle; the steps double."""
    known = stage(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = known.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        known = stage(further, "roots")
        if known.where("moved").isEmpty():
            return known.select("word", "root")
        known = known.select("word", "root")
