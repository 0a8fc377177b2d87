"""Session settings the jobs are written for, and the shared scratch folder.

The library never builds a master URL or sets a partition count for its caller: both belong to
the cluster.
"""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

# Merge sessions on the map side, so one busy key is shrunk before it is shuffled.
MERGE_SESSIONS_EARLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"

# Every value is a default or a correctness pin; sizes and partition counts are left to the cluster.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State larger than executor heap lives in RocksDB instead of JVM maps.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    MERGE_SESSIONS_EARLY: "true",
}


def with_recommended_conf(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add ``RECOMMENDED_CONF`` to a session builder that the caller finishes."""
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    return builder


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session for as long as the block lasts."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.

    Where it is unset, a machine-local folder is used in local mode only. On a cluster, executors
    would not see such a folder, so that case is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return context.getCheckpointDir().rstrip("/")


#: The folder of the run that this code is part of, and the schema of its owner's record.
_RUN: ContextVar[str | None] = ContextVar("tidemark_run", default=None)
_OWNER = "folder STRING, application STRING, started TIMESTAMP"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared scratch folder, within the folder of the run if there is one."""
    place = _RUN.get() or f"{scratch_root(spark)}/tidemark"
    return f"{place}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[None]:
    """Whatever is staged in the block is removed when it ends, however it ends.

    A frame that was made in the block and still reads from a staged table is to be used up in it.
    A run within a run belongs to the outer one. Each run has a folder with a record of its owner,
    by which ``sweep_runs`` finds what a lost driver has left.
    """
    if _RUN.get() is not None:
        yield
        return
    folder = f"{scratch_root(spark)}/tidemark/run-{uuid.uuid4().hex}"
    owner = (folder, spark.sparkContext.applicationId, datetime.now(timezone.utc))
    spark.createDataFrame([owner], _OWNER).coalesce(1).write.parquet(f"{folder}/owner")
    token = _RUN.set(folder)
    try:
        yield
    finally:
        _RUN.reset(token)
        remove_folder(spark, folder)


def sweep_runs(spark: SparkSession, older_than: timedelta) -> int:
    """Remove the folders of runs that began so long ago and were never ended; their number.

    Choose a time that no run takes: whether a run is still at work cannot be seen from outside.
    """
    records = spark.read.schema(_OWNER).option("ignoreMissingFiles", "true")
    owners = if_present(records, f"{scratch_root(spark)}/tidemark/run-*/owner")
    if owners is None:
        return 0
    border = datetime.now(timezone.utc) - older_than
    left = owners.filter(F.col("started") < F.lit(border)).collect()  # one row per run
    for row in left:
        log.warning("removing %s, left by %s", row["folder"], row["application"])
        remove_folder(spark, row["folder"])
    return len(left)


def remove_folder(spark: SparkSession, folder: str, *, below: str | None = None) -> None:
    """Remove a folder with all it holds; only one below the scratch folder, or below ``below``.

    The catalog does it, as the owner of a database's location, on whatever store the folder is.
    """
    place = f"{scratch_root(spark)}/tidemark" if below is None else below.rstrip("/")
    if not folder.startswith(f"{place}/") or ".." in folder:
        raise ValueError(f"{folder} is not below {place}")
    name = f"tidemark_removed_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{folder}'")
    spark.sql(f"DROP DATABASE `{name}` CASCADE")


def if_present(reader: DataFrameReader, path: str) -> DataFrame | None:
    """The rows below a path, or ``None`` where nothing was written yet."""
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and return a scan of what was written.

    Cuts the lineage: a lost executor costs a re-read, never a second evaluation that could place
    rows differently.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
