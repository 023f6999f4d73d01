"""Incremental behaviour: notifications, saved searches, deliveries, feeds and caches. Clocks are parameters, so that a run can be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def notifications(items: DataFrame, subscriptions: DataFrame, sent: DataFrame, item: str, ts: str, year: str, this_year: int) -> DataFrame:
    """(user, serial, id) to notify: items of a subscribed serial past the subscription's `seen` (not at it), of the last three years, not in sent (user, id)."""
    recent = items.where(F.col(year).between(this_year - 2, this_year))
    met = recent.join(subscriptions.select("user", "serial", "seen"), "serial").where(F.col(ts) > F.col("seen"))
    return met.select("user", "serial", item).distinct().join(sent.select("user", item), ["user", item], "left_anti").select("user", "serial", item)


def new_results(current: DataFrame, stored: DataFrame, search: str, item: str) -> DataFrame:
    """(search, item): results that the stored set of the search has not."""
    return current.select(search, item).distinct().join(stored.select(search, item), [search, item], "left_anti")


def advanced_results(current: DataFrame, stored: DataFrame, search: str, item: str) -> DataFrame:
    """The sets to store: the current one of a search with a new result, the stored one of any other."""
    moved = new_results(current, stored, search, item).select(search).distinct()
    return current.select(search, item).distinct().join(moved, search, "left_semi").unionByName(stored.select(search, item).distinct().join(moved, search, "left_anti"))


def url_key(url: Column) -> Column:
    """What urls compare by: the DOI in one (in lower case), else the url without scheme and last slash."""
    found = F.regexp_extract(url, r"(10\.\d{4,9}/[^\s?#]+)", 1)
    return F.when(found != "", F.lower(found)).otherwise(F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://|/$", ""))


def delivered(items: DataFrame, urls: DataFrame, tracker: DataFrame, key: str, hash_: str, ignored: tuple[str, ...] = ()) -> DataFrame:
    """(key, by, records): items that were delivered, by url if any of their array `urls` was, else by hash, with the tracker's record ids.

    tracker is (id, hash, state), urls (record_id, url). Deliveries in an ignored state do not count.
    """
    known = tracker.where(~F.coalesce(F.col("state").isin(*ignored), F.lit(False))) if ignored else tracker
    at = urls.join(known.select(F.col("id").alias("record_id")), "record_id").select(url_key(F.col("url")).alias("__u"), "record_id").distinct()
    by_url = items.select(key, F.explode("urls").alias("__x")).select(key, url_key(F.col("__x")).alias("__u")).distinct().join(at, "__u").select(key, F.lit("url").alias("by"), "record_id")
    by_hash = items.select(key, F.col(hash_).alias("__h")).join(known.select(F.col("hash").alias("__h"), F.col("id").alias("record_id")), "__h").select(key, F.lit("hash").alias("by"), "record_id")
    every = by_url.unionByName(by_hash).groupBy(key, "by").agg(F.array_sort(F.collect_set("record_id")).alias("records"))
    return every.groupBy(key).agg(F.max_by(F.struct("by", "records"), "by").alias("r")).select(key, "r.by", "r.records")


def tardy(deliveries: DataFrame, source: str, ts: str, now: str, days: int) -> DataFrame:
    """(source, last): sources whose last delivery is more than `days` before now."""
    last = deliveries.groupBy(source).agg(F.max(ts).alias("last"))
    return last.where(F.col("last") < F.expr(f"timestamp '{now}' - interval {int(days)} days"))


def recent(rows: DataFrame, ts: str, now: str, hours: int = 24) -> DataFrame:
    """Rows of the last hours up to now."""
    stamp = F.lit(now).cast("timestamp")
    return rows.where((F.col(ts) >= stamp - F.expr(f"interval {int(hours)} hours")) & (F.col(ts) <= stamp))


def digests(items: DataFrame, users: DataFrame, ts: str) -> DataFrame:
    """(user, feed, n, items): what came into the feeds of a user since they were last notified, newest first."""
    met = items.join(users.select("user", "feed", "notified"), "feed").where(F.col(ts) > F.col("notified"))
    listed = F.sort_array(F.collect_list(F.struct(ts, "item_id", "title")), asc=False)
    return met.groupBy("user", "feed").agg(F.count("*").alias("n"), listed.alias("items"))


def expiry(key: Column, fetched: Column, failed: Column, least: int = 30, most: int = 60) -> Column:
    """When a cache entry ends: failures after least to most days, spread by the key's hash so that they do not end together; others never (null)."""
    spread = F.pmod(F.xxhash64(key), F.lit(most - least + 1)) + least
    return F.when(failed, fetched + F.make_dt_interval(spread.cast("int")))


def store_new_items(stream: DataFrame, path: str, checkpoint: str, key: str = "item_id", longest: int = 1000):
    """A started query that appends the items of a stream whose key the table at path has not; long texts are cut with `...`.

    A batch that runs again after a failure finds its own rows there and adds nothing. Items of one batch with one key are one row, the least.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c != key]
        one = batch.groupBy(key).agg(F.min(F.struct(*rest)).alias("r")).select(key, "r.*").select(*batch.columns)
        cut = one.withColumns({c: F.when(F.length(c) > longest, F.concat(F.left(c, F.lit(longest - 3)), F.lit("..."))).otherwise(F.col(c)) for c, t in one.dtypes if t == "string" and c != key})
        jvm = spark._jvm.org.apache.hadoop.fs.Path(path)
        if jvm.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm):
            cut = cut.join(spark.read.parquet(path).select(key), key, "left_anti").select(*batch.columns)
        cut.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
