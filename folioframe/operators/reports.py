"""Grouped reports: fetch errors by site, log lines by level, counts by category, classes that spread over links."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioframe.operators.graph import propagate


def error_report(rows: DataFrame, key: str, url: str, error: str, dummy: Sequence[str] = ()) -> DataFrame:
    """(domain, error, n, key, url) of each kind of failure, with the least key and its url as an example; dummy errors do not count."""
    domain = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    bad = rows.where(F.col(error).isNotNull() & (~F.col(error).isin(*dummy) if dummy else F.lit(True)))
    return bad.groupBy(domain.alias("domain"), F.col(error).alias("error")).agg(F.count("*").alias("n"), F.min(key).alias(key), F.min_by(url, key).alias(url))


#: Levels of log lines, the gravest first.
LEVELS = ("SEVERE", "WARN", "INFO", "DEBUG")


def log_report(lines: DataFrame, line: str, ts: str | None = None) -> DataFrame:
    """(level, message, n, rank[, first, last]): lines from their level on, counted; rank orders by level, then by descending count."""
    pattern = rf"\b({'|'.join(LEVELS)})\b:?\s*(.*)$"
    got = lines.where(F.col(line).rlike(pattern)).withColumns({"level": F.regexp_extract(line, pattern, 1), "message": F.regexp_extract(line, pattern, 2)})
    span = [F.min(ts).alias("first"), F.max(ts).alias("last")] if ts else []
    order = F.struct(F.array_position(F.array(*map(F.lit, LEVELS)), F.col("level")).alias("level"), (-F.col("n")).alias("n"))
    return got.groupBy("level", "message").agg(F.count("*").alias("n"), *span).withColumn("rank", order)


def count_buckets(rows: DataFrame, buckets: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows that each condition holds for: one pass for all."""
    return rows.agg(*(F.count_if(c).alias(n) for n, c in buckets.items()))


def column_changes(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, column, old, new) of every column that differs between rows with one key, and of every column of rows that one side lacks."""
    side = lambda df, name: df.select(key, F.struct(*(F.col(c).cast("string").alias(c) for c in columns)).alias(name))
    both = side(left, "a").join(side(right, "b"), key, "full")
    cells = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"a.{c}").alias("old"), F.col(f"b.{c}").alias("new")) for c in columns))
    return both.select(key, F.explode(F.filter(cells, lambda x: ~x["old"].eqNullSafe(x["new"]))).alias("x")).select(key, "x.*")


def classify(rows: DataFrame, rules: Mapping[str, Sequence[Column]], key: str, links: DataFrame | None = None, src: str = "src", dst: str = "dst") -> DataFrame:
    """(key, class): classes any of whose rules holds for the row, and, with links, those of rows from which a link leads to it."""
    hit = F.array_compact(F.array(*(F.when(F.coalesce(F.greatest(*[r.cast("int") for r in rs], F.lit(0)), F.lit(0)) == 1, F.lit(c)) for c, rs in rules.items())))
    own = rows.select(key, F.explode(hit).alias("class"))
    return propagate(own, links, key, "class", src, dst) if links is not None else own


def schema_changes(left: DataFrame, right: DataFrame) -> list[tuple[str, str | None, str | None]]:
    """(column, old type, new type) of each column that was added, removed or changed."""
    a, b = dict(left.dtypes), dict(right.dtypes)
    return [(c, a.get(c), b.get(c)) for c in sorted(a | b) if a.get(c) != b.get(c)]
