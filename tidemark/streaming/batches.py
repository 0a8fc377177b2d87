"""The batches of an append stream as a log of folders, folded into few as it grows.

Below the path of a log: ``batches/batch_id=N`` for the batches that came last, ``folded`` with the
rows of earlier ones in parts, and ``state`` with the pointer that tells what counts: the parts, and the
batch up to which they reach.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import if_present, remove_folder

BatchWriter = Callable[[DataFrame, int], None]

BATCH = "batch_id"
#: Parts of one level that are joined to one of the next.
FAN = 8
_STATE = "turn BIGINT, upto BIGINT, parts ARRAY<STRUCT<name: STRING, level: INT>>, gone ARRAY<STRING>"
_START = {"turn": -1, "upto": -1, "parts": [], "gone": []}
#: Pointers that are kept.
_KEPT = 4


def batch_folders(path: str) -> BatchWriter:
    """Write each batch to its own folder of the log ``path``; a repeated batch replaces its folder.

    For append streams; of a complete-mode stream ``latest_result`` keeps the last results only.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batches/{BATCH}={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema: str, *, with_ids: bool = False) -> DataFrame:
    """All rows of a log, each once, whether its batch was folded or not; with their batch on request."""
    state = _pointer(spark, path)
    kinds = f"{schema}, {BATCH} BIGINT"
    rows = spark.createDataFrame([], kinds)
    late = if_present(spark.read.schema(kinds), f"{path}/batches")
    if late is not None:
        rows = late.filter(F.col(BATCH) > state["upto"])
    if state["parts"]:
        rows = rows.unionByName(spark.read.schema(kinds).parquet(*_places(path, state["parts"])))
    return rows if with_ids else rows.drop(BATCH)


def fold_batches(spark: SparkSession, path: str, schema: str, *, fan: int = FAN) -> int:
    """Fold the batches that have come to their end into parts; the number of folders left.

    All batches but the newest, which may still be written, make a new part; ``fan`` parts of a level
    are joined to one of the next, so that each row is written a logarithmic number of times. One
    write of the pointer switches over. What it no longer names is removed by the next fold, so a
    reader has that long. A batch that a restarted stream repeats after it was folded counts once:
    the pointer goes by its number. A fold that died changes nothing and is done again.
    """
    state, kinds = _pointer(spark, path), f"{schema}, {BATCH} BIGINT"
    for folder in state["gone"]:
        remove_folder(spark, f"{path}/{folder}", below=path)
    late = if_present(spark.read.schema(kinds), f"{path}/batches")
    found = [] if late is None else late.filter(F.col(BATCH) > state["upto"]).select(BATCH).distinct().collect()
    ended = sorted(row[BATCH] for row in found)[:-1]  # as many as came since the last fold
    parts, gone = [tuple(part) for part in state["parts"]], []
    if ended:
        name = f"{ended[0]}-{ended[-1]}-0"
        rows = late.filter(F.col(BATCH).between(ended[0], ended[-1]))
        _write(rows, f"{path}/folded/{name}")
        parts.append((name, 0))
        gone += [f"batches/{BATCH}={number}" for number in ended]
    level = 0
    while len(joined := [part for part in parts if part[1] == level]) >= fan:
        name = f"{joined[0][0].split('-')[0]}-{joined[-1][0].split('-')[1]}-{level + 1}"
        _write(spark.read.schema(kinds).parquet(*_places(path, joined)), f"{path}/folded/{name}")
        parts = [(name, level + 1) if part == joined[0] else part for part in parts if part not in joined[1:]]
        gone += [f"folded/{part[0]}" for part in joined if part[0] != name]
        level += 1
    upto = ended[-1] if ended else state["upto"]
    if ended or state["gone"]:
        # a part of this very fold that was joined at once was never named: it goes with the others
        _point(spark, path, {"turn": state["turn"] + 1, "upto": upto, "parts": parts, "gone": gone})
    return len(parts) + len(gone) + len(found) - len(ended)


def _places(path: str, parts: list) -> list[str]:
    return [f"{path}/folded/{part[0]}" for part in parts]


def _write(rows: DataFrame, folder: str) -> None:
    """Rows in files of a good size, whatever the number of those they come from."""
    rows.hint("rebalance").write.mode("overwrite").parquet(folder)


def _pointer(spark: SparkSession, path: str) -> dict:
    marks = if_present(spark.read.schema(_STATE).option("ignoreMissingFiles", "true"), f"{path}/state")
    last = None if marks is None else marks.orderBy(F.desc("turn")).first()
    return _START if last is None else last.asDict()


def _point(spark: SparkSession, path: str, state: dict) -> None:
    mark = spark.createDataFrame([tuple(state.values())], _STATE).coalesce(1)
    mark.write.mode("overwrite").parquet(f"{path}/state/of={state['turn'] % _KEPT}")
