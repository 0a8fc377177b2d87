"""Fingerprints of a set of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.fixed_values import HASH_COLUMN, HASH_SEPARATOR


def change_hash(columns: Sequence[str]) -> Column:
    """``md5`` of the values joined by ``_``; a constant where there are no columns.

    NULLs are skipped and the separator is not escaped, so different rows can share a
    fingerprint. Use it for exchange with other systems; ``differs`` decides about changes.
    """
    if not columns:
        return F.md5(F.lit("1"))
    return F.md5(F.concat_ws(HASH_SEPARATOR, *columns))


def add_change_hash(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Append the fingerprint of some columns as ``hash_md5``."""
    return df.withColumn(HASH_COLUMN, change_hash(columns))


def differs(left: str, right: str, columns: Sequence[str]) -> Column:
    """True if any column differs between two structs; NULL equals NULL only."""
    changed = F.lit(False)
    for name in columns:
        changed = changed | ~F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return changed
