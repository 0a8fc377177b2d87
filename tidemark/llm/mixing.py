"""Mixing sources to target weights: token weights are raked to marginals, then documents are drawn."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_rows, place_of, rows_and, slices, stage

ROUNDS = 100
TOLERANCE = 1e-9
#: Cells (combinations of values that occur) that may go to the driver; more is an error, never a cut.
MOST_CELLS = 1_000_000

#: Topics are clusters of texts by their words: how many, and the numbers a text is summed up in.
TOPICS = 8
PARTS = 64
#: Words in no more than one of so many texts weigh alike; those in more are listed, each with its own weight.
RARE = 1000
#: Rounds of fitting, and the whole number that stands for 1 in a text's vector, so that sums are exact.
FITTINGS = 25
UNIT = 1 << 30
#: Texts nearer to a centre than this (1 - cosine) are no new centre.
NEARBY = 1e-6
#: Different words that a task counts before it hands them on.
MOST_HELD = 200_000
#: The topic of texts without a word.
NO_TOPIC = "none"


@dataclass(frozen=True)
class Topics:
    """Hashes of the listed words in order, their weights, the weight of any other word, and the centres."""

    hashes: object
    weights: object
    rarest: float
    centres: object


def hashes_of(words):
    """64-bit hashes of words."""
    import numpy as np
    import xxhash

    return np.frombuffer(b"".join(map(xxhash.xxh64_digest, words)), ">u8").astype(np.uint64)


def words_and_counts(raw: bytes):
    """Hashes of the different words of a text, how often each occurs, and the number of words."""
    import numpy as np

    found = raw.lower().split()  # parts at exactly the six ASCII white spaces
    counts = Counter(found)
    return hashes_of(counts), np.fromiter(counts.values(), np.int64, len(counts)), len(found)


def summed_up(hashes, counts, model_hashes, model_weights, rarest: float):
    """A unit vector: each word's hash gives a direction of +-1, its weight and frequency the length; or None."""
    import numpy as np

    if not len(hashes):
        return None
    weights = np.full(len(hashes), rarest)
    if len(model_hashes):
        at = np.minimum(np.searchsorted(model_hashes, hashes), len(model_hashes) - 1)
        weights = np.where(model_hashes[at] == hashes, model_weights[at], rarest)
    lengths = weights * np.log1p(counts)
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.float64)
    vector = 2 * (lengths @ bits) - lengths.sum()
    length = np.linalg.norm(vector)
    return vector / length if length else None


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``word, n``: how many texts have the word of each hash; the row of NULL counts the texts that have any."""

    def each(batches: Iterator) -> Iterator:
        import numpy as np

        def handed_on() -> pa.RecordBatch:
            words = pa.array(hashes_of(held).view(np.int64), pa.int64())
            return pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])

        held, texts = Counter(), 0
        for batch in slices(batches):
            for raw in batch.column(0).to_pylist():
                found = set(raw.lower().split())
                texts += bool(found)
                held.update(found)
                if len(held) >= MOST_HELD:
                    yield handed_on()
                    held.clear()
        yield handed_on()
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([texts], pa.int64())], ["word", "n"])

    bodies = docs.select(F.col(text).cast("binary").alias("text")).where("text IS NOT NULL")
    return bodies.mapInArrow(each, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def weigh_words(docs: DataFrame, text: str) -> Topics:
    """The weights of words, without centres: the less, the more of all texts have them.

    Only words in more than one of ``RARE`` texts go to the driver: no more than ``RARE`` times the
    different words of a text on average, however many texts there are.
    """
    import numpy as np

    counts = stage(word_counts(docs, text), "word-counts")
    texts = counts.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
    rare = max(1, texts // RARE)
    listed = counts.where(F.col("word").isNotNull() & (F.col("n") > rare)).toArrow()
    hashes, n = (listed[c].to_numpy() for c in ("word", "n"))
    hashes = hashes.astype(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    weights = np.log((1 + texts) / (1 + n[order].astype(np.float64)))
    return Topics(hashes[order], weights, float(np.log((1 + texts) / (1 + rare))), np.zeros((0, PARTS)))


def with_vector(docs: DataFrame, text: str, model: Topics, name: str = "form") -> DataFrame:
    """``docs`` and a struct ``name`` with ``vector`` (whole numbers of 4 bytes) and ``tokens`` of each whole text."""

    def each(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow.compute as pc

        for batch in slices(batches):
            vectors, sizes = [], []
            for body in pc.struct_field(batch.column(0), at).to_pylist():
                hashes, counts, size = words_and_counts((body or "").encode("utf-8", "replace"))
                vector = summed_up(hashes, counts, model.hashes, model.weights, model.rarest)
                vectors.append(None if vector is None else np.rint(vector * UNIT).astype("<i4").tobytes())
                sizes.append(size)
            columns = [pa.array(vectors, pa.binary()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", "vector", "tokens"])

    rows, at = as_rows(docs), place_of(docs, text)
    found = rows.mapInArrow(each, rows_and(rows, "vector binary, tokens long"))
    return found.select("row.*", F.struct("vector", "tokens").alias(name))


def read_vectors(column):
    """Vectors as rows of whole numbers; no NULLs."""
    import numpy as np

    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, PARTS).astype(np.int64)


def next_centre(points: DataFrame, centres):
    """One of all vectors, drawn by chance in proportion to its squared distance to the centres; or None.

    Each vector waits a time that its hash draws, the shorter the farther it is; the first one is taken.
    """
    import numpy as np

    def each(batches: Iterator) -> Iterator:
        best = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = read_vectors(batch.column(0))
            far = np.clip(1 - (x @ centres.T).max(axis=1) / UNIT, 0, None) if len(centres) else np.ones(len(x))
            chance = ((batch.column(1).to_numpy().view(np.uint64) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
            wait = np.where(far > NEARBY, -np.log(chance) / np.maximum(far, NEARBY) ** 2, np.inf)
            first = int(wait.argmin())
            if np.isfinite(wait[first]):
                found = (float(wait[first]), batch.column(0)[first].as_py())
                best = found if best is None else min(best, found)
        if best is not None:
            yield pa.RecordBatch.from_arrays([pa.array([best[0]]), pa.array([best[1]], pa.binary())], ["wait", "vector"])

    drawn = points.select("vector", F.xxhash64(F.lit(f"topic{len(centres)}"), "vector").alias("drawn"))
    found = drawn.mapInArrow(each, "wait double, vector binary").agg(F.min(F.struct("wait", "vector")).alias("first")).first()["first"]
    if found is None:
        return None
    vector = np.frombuffer(found["vector"], "<i4").astype(np.float64)
    return vector / np.linalg.norm(vector)


def sums_by_centre(points: DataFrame, centres):
    """Sums of the vectors nearest to each centre, and in a last column how many they are; whole numbers."""
    import numpy as np

    def each(batches: Iterator) -> Iterator:
        sums = np.zeros((len(centres), PARTS + 1), np.int64)
        for batch in batches:
            x = read_vectors(batch.column(0))
            nearest = (x @ centres.T).argmax(axis=1)
            for k in range(len(centres)):
                mine = x[nearest == k]
                sums[k, :PARTS] += mine.sum(axis=0)
                sums[k, PARTS] += len(mine)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])

    parts = points.select("vector").mapInArrow(each, "sums binary").collect()
    total = np.zeros((len(centres), PARTS + 1), np.int64)
    for part in parts:
        total += np.frombuffer(part["sums"], np.int64).reshape(total.shape)
    return total


def fit_centres(vectors: DataFrame, topics: int = TOPICS):
    """Centres of the different vectors among all rows of column ``vector``: spherical k-means.

    Every round goes over all of them in Spark; the driver holds the centres. Sums are whole numbers
    and draws are hashes, so the same rows give the same centres, however they are partitioned.
    """
    import numpy as np

    points = stage(vectors.where("vector IS NOT NULL").select("vector").distinct(), "topic-vectors")
    centres = np.zeros((0, PARTS))
    while len(centres) < topics and (found := next_centre(points, centres)) is not None:
        centres = np.vstack([centres, found])
    before = None
    for _ in range(FITTINGS if len(centres) else 0):
        sums = sums_by_centre(points, centres)
        if before is not None and (sums == before).all():
            break  # no vector has changed its centre
        lengths = np.linalg.norm(sums[:, :PARTS].astype(np.float64), axis=1, keepdims=True)
        centres = np.where(lengths > 0, sums[:, :PARTS] / np.maximum(lengths, 1), centres)
        before = sums
    return centres


def learn_topics(docs: DataFrame, key: str, text: str, topics: int = TOPICS) -> Topics:
    """Clusters of all texts by all their words; the ``key`` of a text plays no part in it."""
    model = weigh_words(docs, text)
    vectors = with_vector(docs.select(F.col(text).alias("text")), "text", model).select("form.vector")
    return replace(model, centres=fit_centres(vectors, topics))


def nearest_topic(vector: Column, model: Topics) -> Column:
    """The topic of a text's vector."""
    centres = model.centres

    @F.arrow_udf("string")
    def nearest(vectors: pa.Array) -> pa.Array:
        there = vectors.drop_null()
        if not len(centres) or not len(there):
            return pa.array([NO_TOPIC] * len(vectors), pa.string())
        found = iter((read_vectors(there) @ centres.T).argmax(axis=1).tolist())
        return pa.array([f"topic{next(found)}" if one else NO_TOPIC for one in vectors.is_valid().to_pylist()], pa.string())

    return nearest(vector)


def topic_in_place(formed: DataFrame, model: Topics, name: str) -> DataFrame:
    """The struct ``name`` of ``with_vector`` with ``topic`` and ``tokens`` instead."""
    form = F.col(name)
    return formed.withColumn(name, F.struct(nearest_topic(form["vector"], model).alias("topic"), form["tokens"].alias("tokens")))


def with_topic(docs: DataFrame, text: str, model: Topics, name: str = "form") -> DataFrame:
    """``docs`` and a struct ``name`` with ``topic`` and ``tokens`` of each whole text; NULL has no words."""
    return topic_in_place(with_vector(docs, text, model, name), model, name)


def with_own_topic(docs: DataFrame, text: str, name: str = "form", *, topics: int = TOPICS, without: tuple[str, ...] = ()) -> DataFrame:
    """``with_topic`` by the topics that ``learn_topics`` finds in the same texts, each summed up but once.

    Columns in ``without`` are left behind. What is returned reads from a staged table.
    """
    model = weigh_words(docs, text)
    formed = stage(with_vector(docs, text, model, name).drop(*without), "topics")
    model = replace(model, centres=fit_centres(formed.select(F.col(name)["vector"].alias("vector")), topics))
    return topic_in_place(formed, model, name)


def rake(
    cells: Mapping[tuple, float], targets: list[Mapping], *, rounds: int = ROUNDS, tolerance: float = TOLERANCE
) -> tuple[dict[tuple, float], float]:
    """Iterative proportional fitting: a factor per cell, and the largest gap left in any marginal.

    ``targets[d]`` gives the wanted share of each value of dimension ``d``; values it does not name,
    or that no cell has, are left out and the rest is scaled to 1. Cells whose value in some
    dimension has target 0 or none get factor 0. Factors are a product of one number per value.
    """
    wanted = []
    for d, shares in enumerate(targets):
        there = {c[d] for c, weight in cells.items() if weight > 0}
        named = {v: float(s) for v, s in shares.items() if v in there and s > 0}
        total = sum(named.values())
        wanted.append({v: s / total for v, s in named.items()} if total else {})
    live = {c: w for c, w in cells.items() if w > 0 and all(v in wanted[d] for d, v in enumerate(c))}
    factors: list[dict] = [dict.fromkeys(w, 1.0) for w in wanted]

    def mass(cell: tuple) -> float:
        out = live[cell]
        for d, value in enumerate(cell):
            out *= factors[d][value]
        return out

    gap = 0.0
    for _ in range(rounds if live else 0):
        gap = 0.0
        for d, shares in enumerate(wanted):
            sums = dict.fromkeys(shares, 0.0)
            for cell in live:
                sums[cell[d]] += mass(cell)
            total = sum(sums.values())
            gap = max([gap, *(abs(sums[v] / total - s) for v, s in shares.items())])
            for v, s in shares.items():
                if sums[v] > 0:
                    factors[d][v] *= s / (sums[v] / total)
        if gap < tolerance:
            break
    found = {c: 0.0 for c in cells}
    found |= {c: mass(c) / live[c] for c in live}
    return found, gap


def tempered(cells: Mapping[tuple, float], d: int, temperature: float) -> dict:
    """Targets for dimension ``d``: its own token shares to the power ``temperature`` (0: equal shares)."""
    sums: dict = {}
    for cell, weight in cells.items():
        sums[cell[d]] = sums.get(cell[d], 0.0) + weight
    return {v: w**temperature for v, w in sums.items() if w > 0}


def scale_to(cells: Mapping[tuple, float], factors: Mapping[tuple, float], budget: float) -> float:
    """The ``c`` at which ``sum(weight * min(1, c * factor))`` is ``budget`` of all weight.

    Infinite if the cells with a factor weigh no more than the budget.
    """
    live = sorted((1.0 / f, w * f) for c, f in factors.items() if f > 0 and (w := cells[c]) > 0)
    wanted, full, slope = budget * sum(cells.values()), 0.0, sum(wf for _, wf in live)
    for limit, wf in live:  # cells reach probability 1 in the order of their factors
        if full + limit * slope >= wanted:
            return (wanted - full) / slope
        full += limit * wf
        slope -= wf
    return float("inf")


def mix(
    docs: DataFrame,
    key: str,
    dimensions: Mapping[str, Column],
    weight: Column,
    targets: Mapping[str, Mapping] | None = None,
    *,
    budget: float = 0.7,
    temperature: float = 0.7,
    seed: str = "mix",
    only_drawn: bool = False,
) -> DataFrame:
    """``docs`` with ``cell_factor``, ``probability`` and ``drawn`` for every row; or the drawn rows as they are.

    Token weights are summed per cell of ``dimensions`` (in the tasks first; a cell per combination
    that occurs reaches the driver) and raked to ``targets`` (default for a dimension: its own shares
    to the power ``temperature``). A cell's probability is its factor times one scale, calibrated so
    that the expected tokens drawn are ``budget`` of all; cells that would pass 1 are kept whole and
    the others make up for it. A row is drawn if a hash of its key, uniform in [0, 1), is below its
    probability: a rerun draws the same rows, and equal keys are drawn together.

    A NULL in a dimension is a value of its own; rows of weight 0 take their cell's probability
    (cells of weight 0 alone are never drawn); a NULL key is drawn by the hash of its cell; an empty
    table gives no rows; columns of ``docs`` stay, whatever they are called; where one is named like
    a new column, ``only_drawn`` is the way to avoid two of that name.
    """
    names = list(dimensions)
    values = {f"d{i}": column.cast("string") for i, column in enumerate(dimensions.values())}
    # the rows of docs as one struct, so that none of their names meets one from here
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    marked = docs.select(row, F.col(key).alias("key"), *(c.alias(n) for n, c in values.items()), weight.alias("weight"))
    sums = marked.groupBy(*values).agg(F.sum("weight").alias("w"))
    rows = sums.limit(MOST_CELLS + 1).collect()
    if len(rows) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} cells; use coarser dimensions")
    cells = {tuple(r)[:-1]: float(r["w"] or 0) for r in rows}
    chosen = [(targets or {}).get(n) or tempered(cells, i, temperature) for i, n in enumerate(names)]
    factors, _ = rake(cells, chosen)
    scale = scale_to(cells, factors, budget)
    table = docs.sparkSession.createDataFrame(
        [(*c, f, min(1.0, scale * f) if f > 0 else 0.0) for c, f in factors.items()],
        ", ".join([*(f"{n} string" for n in values), "cell_factor double", "probability double"]),
    ).alias("cells")
    same = [F.col(f"rows.{n}").eqNullSafe(F.col(f"cells.{n}")) for n in values]
    met = marked.alias("rows").join(F.broadcast(table) if len(rows) <= 10_000 else table, same, "left")
    cell_if_no_key = [F.when(F.col("key").isNull(), F.col(f"rows.{n}")) for n in values]
    drawn_by = F.xxhash64(F.lit(seed), F.col("key").cast("string"), *cell_if_no_key)
    uniform = F.shiftrightunsigned(drawn_by, 11) / F.lit(float(1 << 53))
    drawn = uniform < F.col("probability")
    if only_drawn:
        return met.where(drawn).select("row.*")
    return met.select("row.*", "cell_factor", "probability", drawn.alias("drawn"))
