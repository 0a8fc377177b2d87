"""Near-duplicate vectors by randomised-rotation binary codes with correction factors."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, stage

COSINE = 0.9
RECALL = 0.98  # of pairs exactly at the threshold to share a band; more for closer pairs
SIGMAS = 5.0  # half width of the confidence interval of an estimate, in standard errors
SEED = 20240
#: Sign bits that are compared where two vectors meet in a band.
HEAD = 256
#: Members of a band that make its first vector a centre, and the cosine to a centre that makes a member: two
#: members of one centre are at most twice that angle apart, so at 2 * MEMBER^2 - 1 > 0.9 or more.
DENSE, MEMBER = 8, 0.9748


def band_plan(classes: int, cosine: float = COSINE, recall: float = RECALL) -> tuple[int, int]:
    """Bits per band and number of bands.

    A rotated coordinate's sign differs for a share ``angle / pi`` of the bits. Bits grow with the
    logarithm of the number of vectors, so that chance meetings stay in proportion to it; bands
    follow from the wanted recall.
    """
    agree = 1.0 - math.acos(cosine) / math.pi
    bits = max(6, math.ceil(math.log2(max(2, classes))) - 1)
    return bits, math.ceil(math.log(1.0 - recall) / math.log1p(-(agree**bits)))


def rotations(dimension: int, count: int):
    """``count`` random orthogonal matrices, the same for the same dimension wherever they are made."""
    import numpy as np

    rng = np.random.default_rng([SEED, dimension])
    return np.stack([np.linalg.qr(rng.standard_normal((dimension, dimension)))[0] for _ in range(count)])


def by_dimension(column):
    """``(rows, matrix of doubles)`` for each length of vector in an Arrow list column."""
    import numpy as np

    lengths = np.asarray(column.value_lengths())
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        yield rows, np.asarray(column.take(rows).flatten(), dtype=np.float64).reshape(len(rows), n)


def unit(matrix):
    """Rows over their length, scaled by their largest part first so that no square overflows."""
    import numpy as np

    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def differing_bits(cosine: float) -> int:
    """The most of ``HEAD`` sign bits in which vectors at ``cosine`` differ, ``SIGMAS`` standard errors up.

    A bit differs with probability ``angle / pi``; bits of one rotation vary less than independent ones.
    """
    p = math.acos(cosine) / math.pi
    return math.floor(HEAD * p + SIGMAS * math.sqrt(HEAD * p * (1 - p)))


def codes(classes: DataFrame, bits: int, bands: int) -> DataFrame:
    """``c, keys, head, code, factors``: band keys, the first sign bits in longs, the sign bits of every
    rotation, and per rotation the inner product of the vector with its own code, by which estimates
    are corrected."""

    def each(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        made: dict = {}
        for batch in batches:
            keys, head, code, factors = ([None] * len(batch) for _ in range(4))
            for rows, x in by_dimension(batch.column(1)):
                n = x.shape[1]
                if n not in made:
                    made[n] = rotations(n, -(-max(HEAD, bits * bands) // n))
                turned = np.einsum("rij,kj->kri", made[n], unit(x))
                signs = turned >= 0
                own = np.abs(turned).sum(axis=2) / math.sqrt(n)
                flat = signs.reshape(len(rows), -1)
                groups = flat[:, : bits * bands].reshape(len(rows), bands, bits)
                # vectors of different lengths never meet
                numbers = groups @ (1 << np.arange(bits, dtype=np.int64)) + (n << 40)
                first = np.packbits(flat[:, :HEAD], axis=1).view(">i8").astype(np.int64)
                for i, row in enumerate(rows):
                    keys[row], head[row], code[row], factors[row] = numbers[i], first[i], np.packbits(flat[i]).tobytes(), own[i]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(keys, pa.list_(pa.int64())), pa.array(head, pa.list_(pa.int64())),
                    pa.array(code, pa.binary()), pa.array(factors, pa.list_(pa.float64())),
                ],
                ["c", "keys", "head", "code", "factors"],
            )

    schema = "c long, keys array<long>, head array<long>, code binary, factors array<double>"
    return classes.select("c", "vector").mapInArrow(each, schema)


def members(entries: DataFrame, classes: DataFrame, cosine: float) -> DataFrame:
    """``c, centre``: vectors of dense groups, each at the centre that it shares the most bands with,
    where its exact cosine to it is ``MEMBER`` or more (a centre is its own member).

    Members of one centre are certain to link with each other, so no pair of them is looked at.
    """
    if 2 * MEMBER**2 - 1 <= cosine:
        return classes.select("c", F.col("c").alias("centre")).limit(0)
    dense = entries.groupBy("band", "value").agg(F.min("c").alias("centre"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= DENSE)
    met = entries.join(dense, ["band", "value"]).groupBy("c", "centre").agg(F.count(F.lit(1)).alias("bands"))
    nearest = met.groupBy("c").agg(F.min(F.struct((-F.col("bands")).alias("order"), "centre"))["centre"].alias("centre"))
    nearest = stage(nearest, "nearest-centres")
    x = classes.select("c", F.col("vector").alias("x"))
    y = classes.select(F.col("c").alias("centre"), F.col("vector").alias("y"))
    pairs = nearest.where("c <> centre").join(x, "c").join(y, "centre").select(F.col("c").alias("a"), F.col("centre").alias("b"), "x", "y")
    # a centre that is a member elsewhere would tie two groups that need not link throughout
    sure = stage(verified(pairs, MEMBER), "sure")
    centres = sure.join(sure.select(F.col("a").alias("other")), F.col("b") == F.col("other"), "left_anti")
    held = centres.select(F.col("a").alias("c"), F.col("b").alias("centre"))
    return held.union(held.select(F.col("centre").alias("c"), "centre").distinct())


def possible(pairs: DataFrame, cosine: float) -> DataFrame:
    """``a, b`` of the rows ``a, code, factors, b, vector`` whose inner product may reach ``cosine``.

    For a rotation, ``<code of a, rotated b> / factor`` is an unbiased estimate of ``<a, b>`` with
    variance at most ``(1 - factor^2) / (factor^2 (n - 1))``; rotations are independent, so their
    mean is taken. Only pairs whose upper confidence bound is below the threshold are ruled out.
    """

    def each(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        made: dict = {}
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for rows, y in by_dimension(batch.column(4)):
                n = y.shape[1]
                own = np.asarray(batch.column(2).take(rows).flatten()).reshape(len(rows), -1)
                count = own.shape[1]
                if n not in made:
                    made[n] = rotations(n, count)
                packed = np.frombuffer(b"".join(batch.column(1).take(rows).to_pylist()), np.uint8).reshape(len(rows), -1)
                for at in range(0, len(rows), 1024):  # bounds the memory of the rotated vectors
                    part = slice(at, at + 1024)
                    signs = np.unpackbits(packed[part], axis=1, count=n * count).reshape(-1, count, n) * 2.0 - 1.0
                    turned = np.einsum("rij,kj->kri", made[n], unit(y[part]))
                    guess = ((signs * turned).sum(axis=2) / math.sqrt(n) / own[part]).mean(axis=1)
                    spread = np.sqrt(((1 - own[part] ** 2) / own[part] ** 2 / max(1, n - 1)).clip(0).sum(axis=1)) / count
                    keep[rows[part]] = guess + SIGMAS * spread + 1e-9 >= cosine
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3)], ["a", "b"]).filter(pa.array(keep))

    return pairs.select("a", "code", "factors", "b", "vector").mapInArrow(each, "a long, b long")


def verified(pairs: DataFrame, cosine: float) -> DataFrame:
    """``a, b`` of the rows ``a, b, x, y`` whose cosine, in double precision, is ``cosine`` or more."""

    def each(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = np.zeros(len(batch), bool)
            others = {tuple(rows): y for rows, y in by_dimension(batch.column(3))}
            for rows, x in by_dimension(batch.column(2)):
                keep[rows] = np.einsum("ij,ij->i", unit(x), unit(others[tuple(rows)])) >= cosine
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    return pairs.select("a", "b", "x", "y").mapInArrow(each, "a long, b long")


def vector_links(df: DataFrame, key: str, vector: str, *, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """``key, n_links, component, kept`` for every row.

    Equal vectors form a class with a count and its smallest key. Classes that share a band of sign
    bits meet; there their codes alone rule most pairs out, unbiased estimates with the correction
    factors more of them, and the cosine of the rest is computed in doubles, so no reported link is
    below ``cosine``. Vectors close to one centre link with certainty and are counted by membership,
    so a large group of near copies makes no pairs within. A pair at exactly the threshold is found
    with probability ``recall``; at 0.95, by the plan of bands, with 0.9987 among 500 vectors and more
    than 0.9999 from some 200,000 on.

    A vector that is NULL, empty or zero, or has NULL or non-finite parts, links with nothing, as
    does a row with a NULL key; vectors of different lengths never link. Repeated rows count as
    vectors of their own. An empty table gives no rows; further columns are ignored.
    """
    parts = F.col("vector")
    finite = F.forall(parts, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.coalesce(finite & F.exists(parts, lambda v: v != 0) & F.col("key").isNotNull(), F.lit(False))
    whole = F.when(usable, F.concat(F.hex(F.xxhash64(parts)), F.lit("-"), F.hex(F.xxhash64(F.lit(SEED), parts))))
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("vector")).withColumn("same", whole)
    classes = stage(
        rows.where("same IS NOT NULL")
        .groupBy("same")
        .agg(F.min("key").alias("least"), F.count(F.lit(1)).alias("n"), F.first("vector").alias("vector"))
        .withColumn("c", F.monotonically_increasing_id()),  # frozen by the written table
        "vector-classes",
    )
    bits, bands = band_plan(classes.count(), cosine, recall)
    coded = stage(codes(classes, bits, bands), "codes")
    entries = coded.select("c", F.posexplode("keys").alias("band", "value"))
    grouped = stage(members(entries, classes, cosine), "members")
    words = [F.get("head", F.lit(i)).alias(f"h{i}") for i in range(HEAD // 64)]
    marked = coded.join(grouped, "c", "left").select("c", "centre", *words, F.posexplode("keys").alias("band", "value"))
    left, right = marked.alias("l"), marked.alias("r")
    differ = " + ".join(f"bit_count(l.h{i} ^ r.h{i})" for i in range(HEAD // 64))
    # codes decide where two vectors meet; only pairs that they leave open are written down
    met = F.expr(
        "l.band = r.band AND l.value = r.value AND l.c < r.c"
        f" AND {differ} <= {differing_bits(cosine)} AND NOT coalesce(l.centre = r.centre, false)"
    )
    candidates = stage(left.join(right, met).select(F.col("l.c").alias("a"), F.col("r.c").alias("b")).distinct(), "candidates")
    code_of = coded.select(F.col("c").alias("a"), "code", "factors")
    x = classes.select(F.col("c").alias("a"), F.col("vector").alias("x"))
    y = classes.select(F.col("c").alias("b"), F.col("vector").alias("y"))
    likely = stage(possible(candidates.join(code_of, "a").join(y.withColumnRenamed("y", "vector"), "b"), cosine), "likely")
    links = stage(verified(likely.join(x, "a").join(y, "b"), cosine), "links")

    sizes = classes.select(F.col("c").alias("b"), "n")
    both = links.union(links.select("b", "a"))
    linked = both.join(sizes, "b").groupBy("a").agg(F.sum("n").alias("others"))
    # members of one centre link with each other: counted by membership
    sized = grouped.join(classes.select("c", "n"), "c")
    together = sized.groupBy("centre").agg(F.sum("n").alias("all"))
    inside = sized.join(together, "centre").select(F.col("c").alias("m"), (F.col("all") - F.col("n")).alias("inside"))
    ties = links.union(grouped.where("c <> centre").select(F.col("c").alias("a"), F.col("centre").alias("b")))
    roots = components(ties, "a", "b", label="root").withColumnRenamed("node", "c")
    least = roots.join(classes.select("c", "least"), "c").groupBy("root").agg(F.min("least").alias("component"))
    final = stage(
        classes.select("c", "same", "least", "n")
        .join(linked.withColumnRenamed("a", "c"), "c", "left")
        .join(inside, F.col("c") == F.col("m"), "left")
        .join(roots.join(least, "root").select("c", "component"), "c", "left")
        .select(
            F.col("same").alias("of"),
            (F.coalesce("others", F.lit(0)) + F.coalesce("inside", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "least").alias("component"),
        ),
        "vector-groups",
    )
    slim = rows.select("key", "same")
    return slim.join(final, F.col("same") == F.col("of"), "left").select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "key").alias("component"),
        F.coalesce("component", "key").eqNullSafe(F.col("key")).alias("kept"),
    )
