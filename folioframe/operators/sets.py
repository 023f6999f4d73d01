"""Deduplication, collection differences and delta application."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioframe.operators.ranking import first_of


def dedup(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key."""
    return first_of(rows, keys, [F.col(c) for c in order])


def content_hash(columns: Sequence[str]):
    """A hash of the columns as text, with nulls told from empty text."""
    return F.sha1(F.concat_ws("|", *(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in columns)).cast("binary"))


def compare(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, status) of every key: left, right, same or changed."""
    a = left.select(F.col(key), content_hash(columns).alias("__a"))
    b = right.select(F.col(key), content_hash(columns).alias("__b"))
    status = F.when(F.col("__b").isNull(), "left").when(F.col("__a").isNull(), "right").when(F.col("__a") == F.col("__b"), "same").otherwise("changed")
    return a.join(b, key, "full").select(key, status.alias("status"))


def apply_delta(base: DataFrame, delta: DataFrame, key: str, deleted: DataFrame | None = None) -> DataFrame:
    """Rows of delta, and rows of base that neither delta nor deleted names."""
    kept = base.join(delta.select(key).distinct(), key, "left_anti").select(*base.columns)
    out = delta.select(*base.columns).unionByName(kept)
    return out.join(deleted.select(key).distinct(), key, "left_anti").select(*base.columns) if deleted is not None else out


def incremental(previous: DataFrame, current: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, action): delete keys that are gone, upsert keys that are new or whose contents differ."""
    got = compare(previous, current, key, columns).where("status <> 'same'")
    return got.select(key, F.when(F.col("status") == "left", "delete").otherwise("upsert").alias("action"))
