"""Personal data by candidate gradient boosting; DataFrame operations only.

Generators propose spans, a small boosted forest scores them by format and context, and a threshold
calibrated on held-out rows selects what is redacted beside the rule-based spans.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

KINDS = ("email", "ip", "card", "phone")

# The rules' patterns, written so that Java's engine neither recurses nor starts twice in one run:
# a run of local-part or digit characters can only match from its start or from a match's end.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: More candidates, of high recall: written-out addresses, groups of four inside longer numbers,
#: national phone numbers with parting marks.
MORE = {
    "email": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}+"
    r"(?:\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}+){1,4}+",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20-]?[0-9]{4}){3}(?![0-9])",
    "phone": r"(?<![0-9+.])(?:\([0-9]{2,5}\)|0[0-9]{1,4})[\x20.-][0-9]{2,5}(?:[\x20.-][0-9]{2,5}){1,3}(?![0-9])",
}
#: What a text must have for a pattern to be tried at all.
NEEDS = {"email": "@", "ip": "[0-9]", "card": "[0-9]", "phone": r"\+[0-9]"}
MORE_NEEDS = {"email": r"(?i)[(\[\x20]dot[)\]\x20]", "card": "[0-9]{4}", "phone": r"[0-9][\x20.)-]{1,2}[0-9]"}
#: Words before a span that speak for a kind of personal data, or against any.
WORDS_NEAR = {
    "email": r"(?i)\b(?:mail|e-mail|contact|write|address)\b", "ip": r"(?i)\b(?:ip|host|server|address|login)\b",
    "card": r"(?i)\b(?:card|visa|account|credit|payment)\b", "phone": r"(?i)\b(?:tel|phone|call|mobile|fax|contact)\b",
    "other": r"(?i)\b(?:ref|no|nr|id|version|order|item|page|total|isbn|invoice)\b",
}
#: Format and context. What the rules judge by (digits, checksum, octets) is left out, so that the forest learns
#: from how and where accepted spans are written, not the rules themselves.
FEATURES = ("kind", "marks", "groups", "lead", "before", "after", "near")

#: Matches whose places are worked out in one run.
RUN = 256
ROUNDS, DEPTH, RATE, LEAST_WEIGHT = 24, 3, 0.4, 4.0
#: Share of valid spans among the held-out ones of a kind from its threshold on, one invalid span added for caution:
#: a kind with fewer than 19 held-out valid spans has no threshold, and nothing is added of it.
PRECISION = 0.95


def matches(docs: DataFrame, patterns: dict[str, str], needs: dict[str, str], source: str) -> DataFrame:
    """Columns ``<source>_<kind>``: arrays of ``(start, text, before, after)`` in code points, leftmost first."""
    hits, gaps, body = {}, {}, F.col("text")
    for kind, pattern in patterns.items():
        name = f"{source}_{kind}"
        found = F.regexp_extract_all(body, F.lit(pattern), F.lit(0))
        hits[f"{name}_hits"] = F.when(body.rlike(needs[kind]), found)
        gaps[f"{name}_gaps"] = F.when(F.size(f"{name}_hits") > 0, F.split("text", pattern, -1))
    docs = docs.withColumns(hits).withColumns(gaps)
    for kind in patterns:
        name = f"{source}_{kind}"
        docs = docs.withColumn(name, positions(F.col(f"{name}_hits"), F.col(f"{name}_gaps")))
    return docs.drop(*hits, *gaps)


def positions(hits: Column, gaps: Column) -> Column:
    """Where the matches stand, from their texts and the texts between them.

    An array grows by a copy, so the spots are gathered in short runs and the runs joined up: a text
    with very many matches costs little more than in proportion to them.
    """
    spot_type = "struct<start:int,body:string,before:string,after:string>"
    empty = F.array().cast(f"array<{spot_type}>")

    def walk(state: Column, i: Column) -> Column:
        start = state["at"] + F.length(F.get(gaps, i))
        spot = F.struct(
            start.alias("start"), F.get(hits, i).alias("body"),
            F.right(F.get(gaps, i), F.lit(24)).alias("before"), F.substring(F.get(gaps, i + 1), 1, 1).alias("after"),
        )
        return F.struct((start + F.length(F.get(hits, i))).alias("at"), F.concat(state["out"], F.array(spot)).alias("out"))

    def run(runs: Column, number: Column) -> Column:
        first = number * RUN
        steps = F.sequence(first, F.least(first + (RUN - 1), F.size(hits) - 1))
        at = F.coalesce(F.try_element_at(runs, F.lit(-1))["at"], F.lit(0))
        return F.concat(runs, F.array(F.aggregate(steps, F.struct(at.alias("at"), empty.alias("out")), walk)))

    numbers = F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / RUN).cast("int"))
    none = F.array().cast(f"array<struct<at:int,out:array<{spot_type}>>>")
    spots = F.flatten(F.transform(F.aggregate(numbers, none, run), lambda r: r["out"]))
    return F.when(F.size(hits) > 0, spots).otherwise(empty)


def luhn(digits: Column) -> Column:
    """Whether the checksum of a string of digits holds."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
    ))
    total = F.aggregate(places, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))
    return total % 10 == 0


def character(c: Column) -> Column:
    """0 none, 1 white space, 2 letter, 3 digit, 4 other."""
    return (
        F.when(c.isNull() | (c == ""), 0)
        .when(c.rlike(r"\s"), 1)
        .when(c.rlike(r"\p{L}"), 2)
        .when(c.rlike("[0-9]"), 3)
        .otherwise(4)
    )


def described(spot: Column, kind: int, base: bool) -> Column:
    """A candidate: its span, features, and whether it is a span by the rules (``valid``)."""
    body = spot["body"]
    digits = F.regexp_replace(body, "[^0-9]", "")
    count = F.length(digits)
    octets = body.rlike(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$")
    checksum = F.when((count >= 12) & (count <= 24), luhn(digits)).otherwise(False)
    in_range = {
        "email": F.lit(True), "ip": octets, "card": count.between(14, 19) & checksum, "phone": count.between(10, 15),
    }[KINDS[kind]]
    return F.struct(
        spot["start"].alias("start"),
        F.lit(kind).alias("kind"),
        (spot["start"] + F.length(body)).alias("end"),
        F.lit(base).alias("base"),
        in_range.alias("in_range"),
        F.least(F.length(body) - count, F.lit(6)).alias("marks"),
        F.least(F.regexp_count(body, F.lit("[0-9]+")), F.lit(8)).alias("groups"),
        lead(body).alias("lead"),
        character(F.right(spot["before"], F.lit(1))).alias("before"),
        character(spot["after"]).alias("after"),
        near(spot["before"], kind).alias("near"),
    )


def lead(body: Column) -> Column:
    """How a span begins: 0 zero, 1 another digit, 2 plus, 3 parenthesis, 4 other."""
    first = F.left(body, F.lit(1))
    return F.when(first == "0", 0).when(first.rlike("[1-9]"), 1).when(first == "+", 2).when(first == "(", 3).otherwise(4)


def near(before: Column, kind: int) -> Column:
    """1 with a word for the span's own kind before it, 2 for another kind, 3 for none of them, 0 without any."""
    own = WORDS_NEAR[KINDS[kind]]
    others = "|".join(WORDS_NEAR[k].removeprefix("(?i)") for k in KINDS if k != KINDS[kind])
    return F.when(before.rlike(own), 1).when(before.rlike(f"(?i){others}"), 2).when(before.rlike(WORDS_NEAR["other"]), 3).otherwise(0)


def each_described(spots: Column, kind: int, base: bool) -> Column:
    return F.transform(spots, lambda spot: described(spot, kind, base))


def candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, spans``: every proposed span of every whole text, overlapping ones included."""
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = matches(matches(rows, BASE, NEEDS, "base"), MORE, MORE_NEEDS, "more")
    parts = [
        each_described(F.col(f"{source}_{kind}"), KINDS.index(kind), source == "base")
        for source, patterns in (("base", BASE), ("more", MORE))
        for kind in patterns
    ]
    return found.select("key", F.concat(*parts).alias("spans"))


def of_kind(spans: Column, kind: str) -> Column:
    """The spans of one kind."""
    return F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))


@dataclass(frozen=True)
class Forest:
    """Trees as nested tuples ``(feature, at_most, low, high)`` or leaf values, a bias, a threshold a kind."""

    trees: tuple
    bias: float
    thresholds: tuple[float, ...]


def grow(rows, gradient, weight, depth: int):
    """A regression tree on small whole-number features; ``weight`` is the second derivative."""
    import numpy as np

    total, mass = gradient.sum(), weight.sum()
    best = (1e-6, None)
    for f in range(rows.shape[1]) if depth else ():
        for at in np.unique(rows[:, f])[:-1]:
            low = rows[:, f] <= at
            a, b = weight[low].sum(), weight[~low].sum()
            if min(a, b) < LEAST_WEIGHT / 16:
                continue
            gain = gradient[low].sum() ** 2 / (a + 1) + gradient[~low].sum() ** 2 / (b + 1) - total**2 / (mass + 1)
            if gain > best[0]:
                best = (gain, (f, int(at), low))
    if best[1] is None:
        return float(total / (mass + 1) * RATE)
    f, at, low = best[1]
    return (f, at, grow(rows[low], gradient[low], weight[low], depth - 1), grow(rows[~low], gradient[~low], weight[~low], depth - 1))


def value(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def boost(table: list[tuple[tuple[int, ...], bool, int, int]]) -> Forest:
    """Boosted trees with logistic loss, from rows ``(features, held out, spans, valid spans)``.

    The threshold of a kind lies half-way below the lowest score from which on its held-out spans are
    valid with ``PRECISION``, one invalid span added; infinite where there is no such score.
    """
    import numpy as np

    learn = [r for r in table if not r[1]]
    if not learn or not sum(r[3] for r in learn):
        return Forest((), 0.0, (float("inf"),) * len(KINDS))
    x = np.array([r[0] for r in learn])
    n, y = (np.array([r[i] for r in learn], float) for i in (2, 3))
    share = (y.sum() + 1) / (n.sum() + 2)
    bias = math.log(share / (1 - share))
    score, trees = np.full(len(x), bias), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        tree = grow(x, y - n * p, n * p * (1 - p), DEPTH)
        trees.append(tree)
        score += [value(tree, row) for row in x]
    thresholds = []
    for kind in range(len(KINDS)):
        own = [r for r in table if r[1] and r[0][0] == kind]
        held = sorted(((bias + sum(value(t, r[0]) for t in trees), r[2], r[3]) for r in own), reverse=True)
        threshold, spans, valid = float("inf"), 1, 0
        for at, (s, count, good) in enumerate(held):
            spans, valid = spans + count, valid + good
            lower = held[at + 1][0] if at + 1 < len(held) else s - 1.0
            if lower < s and valid >= PRECISION * spans:
                threshold = (s + lower) / 2
        thresholds.append(threshold)
    return Forest(tuple(trees), bias, tuple(thresholds))


def train(spans: DataFrame) -> Forest:
    """A forest from all rule candidates, counted per combination of features.

    The table that reaches the driver is bounded by the features' ranges, not by the data. A span's
    label is whether the rules accept it; one key in five is held out for the threshold.
    """
    each = spans.select(
        F.coalesce(F.crc32(F.col("key").cast("string").cast("binary")) % 5 == 0, F.lit(False)).alias("held"),
        F.explode(F.filter("spans", lambda s: s["base"])).alias("s"),
    )
    counted = each.groupBy("held", *(F.col(f"s.{f}").alias(f) for f in FEATURES)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("s.in_range")).alias("valid")
    )
    rows = [(tuple(r[f] for f in FEATURES), r["held"], r["n"], r["valid"]) for r in counted.collect()]
    return boost(sorted(rows))


def scored(forest: Forest, span: Column) -> Column:
    """The forest as one expression over a span's features."""

    def tree(node) -> Column:
        if not isinstance(node, tuple):
            return F.lit(node)
        f, at, low, high = node
        return F.when(span[FEATURES[f]] <= at, tree(low)).otherwise(tree(high))

    total = F.lit(forest.bias)
    for node in forest.trees:
        total = total + tree(node)
    return total


def listed(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    texts = F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(F.array_distinct(texts), ",")


def find_pii(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key, base, added``: arrays of spans ``(start, kind, end, ...)`` for every row.

    ``base`` are the rules' spans. ``added`` are candidates of the wider generators that the forest
    scores at or above the threshold of their kind and that overlap no base span; a match that its rule
    has refused is not proposed again. Positions are in code points, ends exclusive. Candidates are
    written down once; texts are read once.

    NULL and empty texts have no spans; NULL and repeated keys stay as they are; an empty table
    gives no rows; further columns are ignored.
    """
    spans = stage(candidates(docs, key, text), "pii-candidates")
    forest = train(spans)
    split = spans.withColumn("base", F.filter("spans", lambda s: s["base"] & s["in_range"]))
    admitting = [k for k, threshold in enumerate(forest.thresholds) if not math.isinf(threshold)]
    if not admitting:
        added = F.filter("spans", lambda s: F.lit(False))
    else:
        thresholds = F.array(*map(F.lit, forest.thresholds))
        added = F.filter(
            "spans",
            lambda s: ~s["base"]
            & s["kind"].isin(admitting)
            & (scored(forest, s) >= F.get(thresholds, s["kind"]))
            & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
        )
    return split.select(F.col("key").alias(key), "base", added.alias("added"))


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by ``<kind>``; overlapping spans become one."""
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        new = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("<"), F.get(names, s["kind"]), F.lit(">"))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"), F.when(s["start"] >= state["at"], new).otherwise(state["out"]).alias("out")
        )

    return F.aggregate(ordered, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
