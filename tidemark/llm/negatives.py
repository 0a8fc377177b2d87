"""Hard negatives by score windows: blocks along a Hilbert curve, and zone maps that tell which of them to read."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.operators.numbering import number_rows

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Rows of a block, blocks whose anchors are handled together, and zone maps that one task compares with them.
BLOCK_ROWS = 1024
CHUNK_BLOCKS = 25
SHEET_BLOCKS = 1024
#: The curve: bits of a component, and how many components it follows; only the order of rows depends on them.
CURVE_BITS = 4
CURVE_PARTS = 64
#: Scores stay below this, so sums of products fit a long.
LARGEST = float(2**62)
LEAST_SCORE, TOP_SCORE = -(2**62), 2**62


def hilbert_keys(cells, bits: int):
    """The place along the Hilbert curve of each row of cells (rows, parts), as rows of bytes that sort like it.

    The cells' bit planes are turned and exchanged from the highest plane down, so that the curve
    enters each sub-cube next to where it left the one before, and then Gray-coded.
    """
    import numpy as np

    x = np.ascontiguousarray(np.asarray(cells, dtype=np.uint32).T)
    for plane in range(bits - 1, 0, -1):
        high, low = np.uint32(1 << plane), np.uint32((1 << plane) - 1)
        for part in x:
            turned = (part & high) != 0
            change = np.where(turned, low, (x[0] ^ part) & low)
            part ^= np.where(turned, np.uint32(0), change)
            x[0] ^= change
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    carry = np.zeros(x.shape[1], np.uint32)
    for plane in range(bits - 1, 0, -1):
        carry ^= np.where((x[-1] & np.uint32(1 << plane)) != 0, np.uint32((1 << plane) - 1), np.uint32(0))
    x ^= carry
    planes = [((x >> np.uint32(plane)) & np.uint32(1)).T for plane in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes, axis=1).astype(np.uint8), axis=1)


def matrix(column):
    """A list column whose lists are of one length as a matrix."""
    import numpy as np
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def quantised(df: DataFrame) -> DataFrame:
    """``id, label, q, size, square`` of the rows ``id, label, vector`` that take part."""

    def each(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.float64()]
        for batch in batches:
            ids, labels, vectors = (batch.column(k) for k in range(3))
            lengths = np.asarray(vectors.value_lengths())
            for n in np.unique(lengths):
                at = np.flatnonzero(lengths == n)
                x = np.asarray(vectors.take(at).flatten(), dtype=np.float64).reshape(len(at), n)
                with np.errstate(over="ignore", invalid="ignore"):
                    whole = np.floor(x * SCALE)
                    square = (whole * whole).sum(axis=1)
                fits = square < LARGEST  # not for NaN
                at, square, whole = at[fits], square[fits], whole[fits].astype(np.int64)
                q = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * n), pa.array(whole.ravel()))
                columns = [ids.take(at), labels.take(at), q, pa.array(np.full(len(at), n), kinds[3]), pa.array(square)]
                yield pa.RecordBatch.from_arrays([c.cast(k) for c, k in zip(columns, kinds)], ["id", "label", "q", "size", "square"])

    known = df.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(~F.exists("vector", lambda v: v.isNull()))
    return known.select("id", "label", "vector").mapInArrow(each, "id long, label long, q array<long>, size int, square double")


def along_curve(rows: DataFrame) -> DataFrame:
    """``rows`` numbered by length, label and place on the curve, with their block and chunk."""
    shape = rows.agg(F.sum("square"), F.sum(F.col("size").cast("double"))).first()
    spread = (shape[0] / shape[1]) ** 0.5 if shape[0] and shape[1] else 1.0

    def each(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            curve: list = [b""] * len(batch)
            sizes = np.asarray(batch.column(3))
            for n in np.unique(sizes):
                at = np.flatnonzero(sizes == n)
                x = matrix(batch.column(2).take(at)).reshape(len(at), n)[:, :CURVE_PARTS]
                if n:
                    steps = np.clip(np.floor((x / (4.0 * spread) + 0.5) * (1 << CURVE_BITS)), 0, (1 << CURVE_BITS) - 1)
                    for i, key in zip(at, hilbert_keys(steps, CURVE_BITS)):
                        curve[i] = key.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(curve, pa.binary())], ["id", "label", "q", "size", "curve"])

    placed = rows.select("id", "label", "q", "size").mapInArrow(each, "id long, label long, q array<long>, size int, curve binary")
    numbered = number_rows(placed, ["size", "label", "curve", "id"], name="row", start=0).drop("curve")
    block = F.floor(F.col("row") / BLOCK_ROWS)
    return numbered.withColumn("block", block).withColumn("chunk", F.floor(F.col("block") / CHUNK_BLOCKS))


def zone_maps(rows: DataFrame) -> DataFrame:
    """``size, block, sheet, least, most, label_least, label_most``: smallest and largest components of each block."""

    def each(block):
        import pyarrow as pa
        import pyarrow.compute as pc

        x, labels = matrix(block["q"]), block["label"]
        ends = [x.min(axis=0).tolist(), x.max(axis=0).tolist()] if len(x) and x.shape[1] else [[], []]
        size, number = block["size"][0].as_py(), block["block"][0].as_py()
        row = [size, number, number // SHEET_BLOCKS, *ends, pc.min(labels).as_py(), pc.max(labels).as_py()]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64()]
        return pa.table([pa.array([v], k) for v, k in zip(row, kinds)], names=["size", "block", "sheet", "least", "most", "label_least", "label_most"])

    schema = "size int, block long, sheet long, least array<long>, most array<long>, label_least long, label_most long"
    return rows.select("size", "block", "label", "q").groupBy("size", "block").applyInArrow(each, schema)


def by_cell(left: DataFrame, right: DataFrame, *cell: str):
    """Both sides grouped by cell; fresh names tell them apart where they stem from the same table."""
    return left.toDF(*left.columns).groupBy(*cell).cogroup(right.toDF(*right.columns).groupBy(*cell))


def may_hold(asks: DataFrame, zones: DataFrame, same: bool) -> DataFrame:
    """``row, size, chunk, block, low, high``: the blocks whose scores with an anchor may lie in one of
    its windows, with the bounds of these scores by interval arithmetic."""

    def each(anchors, maps):
        import numpy as np
        import pyarrow as pa

        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        names = ["row", "size", "chunk", "block", "low", "high"]
        if not len(anchors) or not len(maps):
            return pa.table([pa.array([], k) for k in kinds], names=names)
        n = len(maps)
        least, most = (matrix(maps[c]).reshape(n, -1).astype(np.float64) for c in ("least", "most"))
        first, last, block = (np.asarray(maps[c]) for c in ("label_least", "label_most", "block"))
        made = []
        for at in range(0, len(anchors), 512):  # bounds the memory of a slice
            part = anchors.slice(at, 512)
            a = matrix(part["q"]).reshape(len(part), -1).astype(np.float64)
            up, down = np.maximum(a, 0), np.minimum(a, 0)
            room = 1e-12 * (np.abs(a) @ np.maximum(np.abs(least), np.abs(most)).T)  # rounding of large sums
            low = np.floor(up @ least.T + down @ most.T - room)
            high = np.ceil(up @ most.T + down @ least.T + room)
            label = np.asarray(part["label"])[:, None]
            fits = (first <= label) & (label <= last) if same else (first != label) | (last != label)
            for_window = np.zeros(fits.shape, bool)
            for lo, hi in zip(matrix(part["lo"]).T, matrix(part["hi"]).T):
                for_window |= (high >= lo[:, None]) & (low <= hi[:, None])
            i, j = np.nonzero(fits & for_window)
            ends = [np.clip(v[i, j], LEAST_SCORE, TOP_SCORE).astype(np.int64) for v in (low, high)]
            columns = [np.asarray(part["row"])[i], np.asarray(part["size"])[i], np.asarray(part["chunk"])[i], block[j], *ends]
            made.append(pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names))
        return pa.concat_tables(made)

    cells = asks.select("size", "chunk").distinct().join(zones.select("size", "sheet").distinct(), "size")
    left = asks.select("row", "size", "chunk", "label", "q", "lo", "hi").join(cells, ["size", "chunk"])
    right = zones.join(cells, ["size", "sheet"])
    pairs = by_cell(left, right, "size", "chunk", "sheet")
    return pairs.applyInArrow(each, "row long, size int, chunk long, block long, low long, high long")


def read_blocks(asks: DataFrame, wanted: DataFrame, rows: DataFrame, same: bool, count: int) -> DataFrame:
    """``row, place, score, id, other``: for each window of an anchor the best rows of each block wanted for it."""

    def each(anchors, block):
        import numpy as np
        import pyarrow as pa

        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        names = ["row", "place", "score", "id", "other"]
        made = [pa.table([pa.array([], k) for k in kinds], names=names)]
        if not len(anchors) or not len(block):
            return made[0]
        b = matrix(block["q"]).reshape(len(block), -1)
        ids, others, theirs = (np.asarray(block[c]) for c in ("id", "row", "label"))
        exact = float((b.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0))
        for at in range(0, len(anchors), 512):  # bounds the memory of a slice
            part = anchors.slice(at, 512)
            a = matrix(part["q"]).reshape(len(part), -1)
            own = np.asarray(part["row"])
            if exact * float((a.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)) < 2.0**104:
                scores = (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
            else:
                scores = a @ b.T
            fits = (np.asarray(part["label"])[:, None] == theirs) == same
            fits &= own[:, None] != others
            for place, (lo, hi) in enumerate(zip(matrix(part["lo"]).T, matrix(part["hi"]).T)):
                i, j = np.nonzero(fits & (scores >= lo[:, None]) & (scores <= hi[:, None]))
                order = np.lexsort((others[j], ids[j], -scores[i, j], i))
                i, j = i[order], j[order]
                rank = np.arange(len(i)) - np.searchsorted(i, i)
                i, j = i[rank < count], j[rank < count]
                columns = [own[i], np.full(len(i), place), scores[i, j], ids[j], others[j]]
                made.append(pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=names))
        return pa.concat_tables(made)

    cell = ("size", "chunk", "block")
    left = wanted.select("row", *cell).join(asks.select("row", "label", "q", "lo", "hi"), "row")
    right = wanted.select(*cell).distinct().join(rows.select("size", "block", "row", "id", "label", "q"), ["size", "block"])
    pairs = by_cell(left, right, *cell)
    return pairs.applyInArrow(each, "row long, place int, score long, id long, other long")


def best(found: DataFrame, count: int) -> DataFrame:
    """The first ``count`` of each window, with their rank."""
    order = Window.partitionBy("row", "place").orderBy(F.desc("score"), "id", "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def search(asks: DataFrame, zones: DataFrame, rows: DataFrame, *, same: bool, count: int) -> DataFrame:
    """The first ``count`` rows by score in each window of each anchor, with their rank.

    ``asks`` has ``row, label, q, size, chunk, target`` and the windows' ends ``lo, hi``. A block
    near the target is read first; the scores found there raise the lower ends of windows, and only
    the blocks whose bounds still reach into a window are read after it.
    """
    asks = stage(asks, "asks")
    wanted = stage(may_hold(asks, zones, same), "blocks-wanted")
    gap = F.abs((F.col("low") / 2 + F.col("high") / 2) - F.col("target"))
    nearest = wanted.join(asks.select("row", "target"), "row").groupBy("row").agg(F.min(F.struct(gap.alias("gap"), "block")).alias("near"))
    nearest = nearest.select("row", F.col("near.block").alias("first"))
    marked = stage(wanted.join(nearest, "row"), "blocks-first")
    begun = stage(best(read_blocks(asks, marked.where("block = first"), rows, same, count), count), "found-first")
    floors = begun.where(F.col("rank") == count).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("place", "score"))).alias("floor"))
    raised = F.transform("lo", lambda v, i: F.greatest(v, F.coalesce(F.try_element_at("floor", i), v)))
    asks = stage(asks.join(floors, "row", "left").withColumn("lo", raised).drop("floor"), "asks-raised")
    reaches = F.exists(F.arrays_zip("lo", "hi"), lambda w: (F.col("high") >= w["lo"]) & (F.col("low") <= w["hi"]))
    rest = marked.where("block <> first").join(asks.select("row", "lo", "hi"), "row").where(reaches).drop("lo", "hi")
    rest = stage(rest.select("row", "size", "chunk", "block"), "blocks-rest")
    more = read_blocks(asks, rest, rows, same, count)
    return stage(best(begun.drop("rank").unionByName(more), count), "found")


def hard_negatives(
    df: DataFrame, key: str, vector: str, label: Column, anchor: Column, *,
    positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Components become ``floor(256 x)``, x as a double; a score is the integer inner product. An
    anchor's positives are its first ``positives`` other rows of its label by score (ties: smaller
    key). For each positive come the first ``negatives`` rows of other labels whose score is at
    least 50 % and at most 95 % of the positive's.

    ``label`` and ``anchor`` are expressions over the columns of ``df``. Rows lie in blocks along a
    Hilbert curve within their label; zone maps bound the scores of an anchor with a whole block, so
    that it reads only blocks that can reach into its windows. Nothing is capped: all rows are
    candidates, and the result is exact.

    A row takes no part if its key, label or vector is NULL, if a component is NULL or not finite, or
    if its squares sum up to 2^62 or more, as scores would not fit a long. Vectors of different
    lengths do not meet; those of length 0 score 0. Repeated rows count each; an anchor never meets
    itself but does meet its copies. An empty table gives no rows; further columns are ignored.
    """
    given = df.select(
        F.col(key).alias("id"), label.cast("long").alias("label"), F.col(vector).alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor")
    )
    anchors_of = given.where("anchor AND id IS NOT NULL").select("id").distinct()
    rows = stage(along_curve(stage(quantised(given), "quantised")), "curve")
    zones = stage(zone_maps(rows), "zones")
    anchors = stage(rows.join(anchors_of, "id", "left_semi"), "anchors")

    own = F.aggregate("q", F.lit(0).cast("long"), lambda s, v: s + v * v).cast("double")
    everything = F.array(F.lit(LEAST_SCORE).cast("long")), F.array(F.lit(TOP_SCORE).cast("long"))
    first = anchors.select("row", "label", "q", "size", "chunk", own.alias("target"), everything[0].alias("lo"), everything[1].alias("hi"))
    near = search(first, zones, rows, same=True, count=positives)

    score = F.col("score")
    windows = near.where("score >= 0").select(  # a negative score has no window
        "row", "rank", F.col("id").alias("positive_id"), score.alias("positive_score"),
        (F.expr("score div 2") + score % 2).alias("lo"), (score - F.expr("(score + 19) div 20")).alias("hi"),
    )
    # as many windows for each anchor; the missing ones are empty
    of_rank = F.map_from_entries(F.collect_list(F.struct("rank", F.struct("lo", "hi"))))
    none = F.struct(F.lit(1).cast("long").alias("lo"), F.lit(0).cast("long").alias("hi"))
    every = windows.groupBy("row").agg(of_rank.alias("w"), F.max("hi").cast("double").alias("target"))
    every = every.withColumn("w", F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda r: F.coalesce(F.try_element_at("w", r), none)))
    asks = anchors.join(every, "row").select("row", "label", "q", "size", "chunk", "target", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    far = search(asks, zones, rows, same=False, count=negatives)

    found = far.select("row", (F.col("place") + 1).alias("of"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    of = windows.select("row", F.col("rank").alias("of"), "positive_id", "positive_score")
    names = anchors.select("row", F.col("id").alias("anchor_id"))
    return found.join(of, ["row", "of"]).join(names, "row").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
