"""Quality rules: every rule is evaluated once into a bitmask ledger; policies read the bits."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from unicodedata import category

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shingle_bounds

SYMBOLS = "#*$%&|<>"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_letters", "n_upper", "n_exclaims", "n_distinct_words", "n_chars",
)

#: A rule's place is its bit in the ledger: rules are appended, never moved or reused. A rule names
#: what fails a text; all are integer comparisons of measures, so equal texts fail alike anywhere.
RULES = {
    "short": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "shouting": "10 * n_upper > 3 * n_letters",
    "exclaims": "10 * n_exclaims > n_words",
    "few_letters": "2 * n_letters < n_chars",
    "repeated_lines": "5 * n_dup_lines > 2 * n_lines",
    "few_distinct_words": "n_words >= 50 AND 10 * n_distinct_words < 2 * n_words",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 12 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A version of what is kept: texts that fail none of ``rules``."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << list(RULES).index(rule) for rule in self.rules)


BASE = Policy("base", ("short", "repeated_windows"))
POLICIES = {p.version: p for p in (BASE, Policy("v1", tuple(RULES)))}


@cache
def letter_tables():
    """Whether each code point is part of a letter (a letter or a combining mark) and whether it is a capital."""
    import numpy as np

    points = [chr(c) for c in range(0x110000)]
    is_letter = np.array([c.isalpha() or category(c)[0] == "M" for c in points])
    return is_letter, np.array([c.isupper() for c in points])


def measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and a long per measure for every whole text. A NULL text measures as an empty one."""

    def each(batches: Iterator) -> Iterator:
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        is_letter, is_upper = letter_tables()

        def measure(body: str) -> tuple[int, ...]:
            raw = body.encode("utf-8", "surrogatepass")
            words = raw.split()  # parts at exactly the six ASCII white spaces of the rules
            blanks = sum(body.count(c) for c in " \t\n\v\f\r")
            repeated = 0
            if len(words) > 3:
                joined = b" ".join(words)
                windows = [joined[i:j] for i, j in zip(*shingle_bounds(words, 3), strict=True)]
                seen = Counter(windows)
                if len(seen) < len(windows):
                    starts = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
                    inside = np.zeros(len(words), bool)
                    for shift in range(3):
                        inside[shift : shift + len(starts)] |= starts
                    repeated = int(inside.sum())
            lines = [line for line in raw.split(b"\n") if not line.isspace() and line]
            points = np.frombuffer(body.encode("utf-32-le", "surrogatepass"), "<u4")
            return (
                len(words), len(body) - blanks, sum(body.count(c) for c in SYMBOLS),
                len(lines) - len(set(lines)), repeated, len(lines),
                int(is_letter[points].sum()), int(is_upper[points].sum()),
                body.count("!"), len(set(words)), len(body) - blanks,
            )

        for batch in batches:
            rows = [measure(body or "") for body in batch.column(1).to_pylist()]
            columns = zip(*rows, strict=True) if rows else [[]] * len(MEASURES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["key", *MEASURES]
            )

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    made = rows.mapInArrow(each, ", ".join([f"key {kind}", *(f"{m} long" for m in MEASURES)]))
    return made.withColumnRenamed("key", key)


def failure_bits() -> Column:
    """The ledger's long: bit ``i`` is set where rule ``i`` fails."""
    bits = [F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES.values())]
    return reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")


def ledger(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, all measures and ``failed``, the bitmask of failed rules: one row per row of ``docs``.

    A NULL or empty text has measures 0 and fails ``short``; NULL or repeated keys stay as they
    are; an empty table gives no rows; further columns of ``docs`` are ignored.
    """
    return measured(docs, key, text).withColumn("failed", failure_bits())


def passes(policy: Policy) -> Column:
    """Whether a ledger row passes a policy; no text is read again."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of a policy: texts that fail it, that fail it alone, and that would pass without it.

    One bitwise aggregation over the ledger; each task sends one row.
    """
    sums = [F.count(F.lit(1)).alias("total"), F.count_if(passes(policy)).alias("kept")]
    failed = F.col("failed").bitwiseAND(F.lit(policy.mask))
    for rule in policy.rules:
        bit = 1 << list(RULES).index(rule)
        sums += [
            F.count_if(failed.bitwiseAND(F.lit(bit)) != 0).alias(f"{rule}_failed"),
            F.count_if(failed == bit).alias(f"{rule}_alone"),
        ]
    one = rows.agg(*sums)
    each = [
        F.struct(
            F.lit(policy.version).alias("policy"), F.lit(rule).alias("rule"), F.col(f"{rule}_failed").alias("failed"),
            F.col(f"{rule}_alone").alias("alone"), (F.col("kept") + F.col(f"{rule}_alone")).alias("kept_without"),
        )
        for rule in policy.rules
    ]
    return one.select(F.inline(F.array(*each)))
