"""Quality by compression: how much smaller a text gets with a dictionary of good text than with one of bad text."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

#: Bounds of the learning sample, per label: texts, characters of a text. Half of the texts make the
#: dictionary, the other half the calibration.
SAMPLE_TEXTS = 2000
SAMPLE_CHARS = 4000
#: Bytes of a dictionary, and bytes that one text adds to it.
DICTIONARY_BYTES = 256 << 10
SHARE_BYTES = 600
#: Bytes that are compressed at once: a dictionary counts as much at the end of a text as at its start.
CHUNK = 2000
LEVEL = 9


@dataclass(frozen=True)
class Quality:
    """Two raw-content dictionaries and the line that turns a size difference into log odds."""

    good: bytes
    bad: bytes
    slope: float
    offset: float

    def score(self, difference: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, self.offset + self.slope * difference))))


def differences(good: bytes, bad: bytes):
    """A function from a text to its size under ``bad`` less that under ``good``, over its own bytes."""
    import zstandard

    def compressor(content: bytes):
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False).compress

    if not good or not bad:
        return lambda body: 0.0
    by_good, by_bad = compressor(good), compressor(bad)

    def difference(body: str | None) -> float:
        raw = memoryview((body or "").encode("utf-8", "replace"))
        gain = 0
        for at in range(0, len(raw), CHUNK):
            part = raw[at : at + CHUNK]
            gain += len(by_bad(part)) - len(by_good(part))
        return gain / max(1, len(raw))

    return difference


def fit_line(values: list[float], labels: list[int], weights: list[float]) -> tuple[float, float]:
    """Slope and offset of a logistic line by Newton steps, each class smoothed by one row of its own share."""
    import numpy as np

    x, y, w = (np.asarray(v, dtype=np.float64) for v in (values, labels, weights))
    spread = float(np.sqrt(np.average((x - np.average(x, weights=w)) ** 2, weights=w))) or 1.0
    design = np.stack([x / spread, np.ones_like(x)], axis=1)
    w = w / w.mean()
    beta = np.array([0.0, math.log((w[y == 1].sum() + 1) / (w[y == 0].sum() + 1))])
    for _ in range(50):
        odds = 1.0 / (1.0 + np.exp(-np.clip(design @ beta, -30, 30)))
        ridge = np.array([1e-2, 1e-6])
        gradient = design.T @ (w * (y - odds)) - ridge * beta
        curvature = (design * (w * odds * (1 - odds))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(curvature, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / spread), float(beta[1])


def learn_quality(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, *, left_out: Column | None = None) -> Quality:
    """Dictionaries and calibration from a bounded sample of the documents with label 0 or 1.

    ``left_out`` is an expression over the key: such rows are never read. Keys with a NULL text,
    without a label or with both labels are left out. Counts per label choose a hash threshold that
    lets about ``SAMPLE_TEXTS`` documents of each label through; they are taken in the order of that
    hash, so the same tables give the same model. Calibration weighs the labels by their counts.
    What reaches the driver is bounded by the parameters above.

    Where no text of one label is known, all texts get the share of label 1 (0.5 if there is none).
    """
    rows = labels if left_out is None else labels.where(~left_out)
    known = (
        rows.where(F.col(key).isNotNull() & F.col(label).isin(0, 1))
        .groupBy(F.col(key).alias("key"))
        .agg(F.min(label).cast("int").alias("label"), F.max(label).cast("int").alias("most"))
        .where("label = most")
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if not counts:
        return Quality(b"", b"", 0.0, 0.0)
    ring = 1 << 30
    drawn = F.pmod(F.xxhash64(F.lit("quality"), F.col("key").cast("string")), F.lit(ring))
    share = [F.when(F.col("label") == k, F.lit(int(min(1.0, SAMPLE_TEXTS / n) * ring))) for k, n in counts.items()]
    chosen = known.withColumn("drawn", drawn).where(F.col("drawn") < F.coalesce(*share)).select("key", "label", "drawn")
    chosen = F.broadcast(chosen.orderBy("drawn", "key").limit(3 * SAMPLE_TEXTS))  # so no text is shuffled
    texts = docs.select(F.col(key).alias("key"), F.substring(F.col(text), 1, SAMPLE_CHARS).alias("text")).where("text IS NOT NULL")
    half = F.pmod(F.xxhash64(F.lit("half"), F.col("key").cast("string")), F.lit(2)) == 0
    sample = (
        texts.join(chosen, "key")
        .select("label", "text", "drawn", half.alias("calibrates"))
        .orderBy("drawn", "text")
        .limit(3 * SAMPLE_TEXTS)
        .collect()
    )

    def dictionary(value: int) -> bytes:
        parts = (r["text"].encode()[:SHARE_BYTES] for r in sample if r["label"] == value and not r["calibrates"])
        return b"\n".join(p for p in parts if p)[:DICTIONARY_BYTES]

    good, bad = dictionary(1), dictionary(0)
    odds = math.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5))
    held = [r for r in sample if r["calibrates"]]
    of = {value: sum(r["label"] == value for r in held) for value in (0, 1)}
    if not good or not bad or not of[0] or not of[1]:
        return Quality(b"", b"", 0.0, odds)
    measure = differences(good, bad)
    slope, offset = fit_line(
        [measure(r["text"]) for r in held], [r["label"] for r in held], [counts[r["label"]] / of[r["label"]] for r in held]
    )
    return Quality(good, bad, slope, offset)


def score_quality(docs: DataFrame, key: str, text: str, model: Quality) -> DataFrame:
    """``key, difference, score, predicted`` of every whole text; nothing but the text decides.

    ``difference`` is the size under the bad dictionary less that under the good one, over the bytes
    of the text, and ``score`` the share of label 1 that the calibration gives it. A NULL or empty
    text has difference 0 and is scored like any other. NULL and repeated keys stay; an empty table
    gives no rows; columns not named are ignored, whatever they are called.
    """

    def each(batches: Iterator) -> Iterator:
        import pyarrow as pa

        measure = differences(model.good, model.bad)
        for batch in slices(batches):
            found = [measure(body) for body in batch.column(1).to_pylist()]
            scores = [model.score(x) for x in found]
            columns = [batch.column(0), pa.array(found, pa.float64()), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "difference", "score", "predicted"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    scored = rows.mapInArrow(each, f"key {rows.schema['key'].dataType.simpleString()}, difference double, score double, predicted int")
    return scored.withColumnRenamed("key", key)


def held_out(key: str) -> Column:
    """One row in three, never learned from: the checksum of the key's text decides; a NULL key is not held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))
