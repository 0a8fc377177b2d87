"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import scratch_path
from tidemark.session import stage as _stage

#: Bytes that part words: the space and the ASCII control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


#: Spark's switch to remove an execution's shuffle files when it has ended.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and scan it; its shuffle files go at once.

    What was written needs them no more, and operators of several steps would else hold the shuffles
    of all steps on the executors' disks. The session's setting is put back.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEAN, None)
    try:
        spark.conf.set(CLEAN, "true")
        return _stage(df, label)
    finally:
        if before is None:
            spark.conf.unset(CLEAN)
        else:
            spark.conf.set(CLEAN, before)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with lines added until no column of ``df`` is called so; names are matched without case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def as_rows(df: DataFrame) -> DataFrame:
    """``df`` with each row as one struct ``row``, so that none of its names meets one of the caller's."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def rows_and(rows: DataFrame, more: str) -> StructType:
    """The schema of ``rows`` with further columns; no name goes through a parser."""
    return StructType([*rows.schema.fields, *StructType.fromDDL(more).fields])


def place_of(df: DataFrame, column: str) -> int:
    """Where a column stands; names are matched without case."""
    return next(i for i, c in enumerate(df.columns) if c.lower() == column.lower())


def slices(batches: Iterable, rows: int = 1000) -> Iterator:
    """Arrow batches in slices of few rows: a worker holds the texts of one slice as Python strings at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def shingle_bounds(words: list[bytes], k: int):
    """Starts and ends of the k-word windows of the words joined by single spaces."""
    import numpy as np

    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    return (ends - lengths)[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()


def components(edges: DataFrame, a: str, b: str, *, label: str = "component") -> DataFrame:
    """``(node, <label>)`` for every node of an edge list: the smallest node it can reach.

    Each round gives a node the smallest label among its neighbours, then lets labels follow
    themselves, so the rounds grow with the logarithm of a component's diameter. Each round is
    written to the shared scratch folder. A busy node costs one row per task (partial minimum) in
    the aggregation, and its join is an ordinary one that adaptive execution can split. Edges with
    a NULL end are ignored; an empty edge list gives no rows.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x IS NOT NULL AND y IS NOT NULL AND x <> y")
    both = stage(pairs.union(pairs.select("y", "x")).distinct(), "edges")
    first = both.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("node"), F.least("x", "y").alias("root"))
    labels = stage(first, "labels")
    while True:
        roots = labels.select(F.col("node").alias("y"), F.col("root").alias("seen"))
        near = both.join(roots, "y").groupBy("x").agg(F.min("seen").alias("seen"))
        met = labels.join(near.withColumnRenamed("x", "node"), "node", "left").select("node", F.col("root").alias("old"), F.least("root", "seen").alias("root"))
        # a label is a node itself: take that node's label
        hop = met.select(F.col("node").alias("root"), F.col("root").alias("next"))
        labels = stage(met.join(hop, "root", "left").select("node", "old", F.least("root", "next").alias("root")), "labels")
        if labels.where("old <> root").isEmpty():
            return labels.select("node", F.col("root").alias(label))


__all__ = ["WORD", "as_rows", "components", "fresh", "place_of", "rows_and", "scratch_path", "shingle_bounds", "slices", "stage"]
