"""Look-up, semi, anti, prefix and cascade joins. Strategies are left to the optimizer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def inherit(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, columns: dict[str, str]) -> DataFrame:
    """child with each column of columns filled, where null, from the parent's column it maps to (first of equal parents)."""
    values = parent.groupBy(F.col(parent_key).alias("__k")).agg(*(F.min(p).alias(f"__{c}") for c, p in columns.items()))
    joined = child.join(values, child[child_key] == values["__k"], "left")
    kept = [c for c in child.columns if c not in columns]
    return joined.select(*kept, *(F.coalesce(F.col(c), F.col(f"__{c}")).alias(c) if c in child.columns else F.col(f"__{c}").alias(c) for c in columns))


def dangling(references: DataFrame, targets: DataFrame, reference: str, key: str) -> DataFrame:
    """References whose target is missing."""
    return references.join(targets.select(F.col(key).alias(reference)), reference, "left_anti")


def flag(rows: DataFrame, others: DataFrame, key: str, other_key: str, name: str) -> DataFrame:
    """rows with a boolean: is the key among others? Others are reduced to distinct keys first, so a hot key adds no rows."""
    keys = others.select(F.col(other_key).alias("__k")).distinct()
    return rows.join(keys, rows[key] == keys["__k"], "left").withColumn(name, F.col("__k").isNotNull()).drop("__k")


def missing_reverse(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Distinct edges without an edge the other way."""
    e = edges.select(src, dst).distinct()
    back = e.select(F.col(dst).alias(src), F.col(src).alias(dst))
    return e.join(back, [src, dst], "left_anti")


def prefix_join(rows: DataFrame, prefixes: DataFrame, column: str, prefix: str, lengths: Sequence[int]) -> DataFrame:
    """Rows with each prefix that starts their column: an equi-join for each length in use, never a nested loop."""
    out = None
    for n in sorted(set(lengths)):
        mine = prefixes.where(F.length(prefix) == n)
        got = rows.where(F.length(column) >= n).join(mine, F.substring(column, 1, n) == F.col(prefix))
        out = got if out is None else out.unionByName(got)
    return out


def cascade(*choices: Column) -> Column:
    """The first choice that is not null: match keys by priority."""
    return F.coalesce(*choices)
