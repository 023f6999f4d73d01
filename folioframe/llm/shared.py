"""Folders that the driver and all executors share, and small broadcast filters.

Intermediate tables go below spark.checkpoint.dir, which a cluster sets to a folder that all nodes
reach. Only where it is unset (a local session, as in tests) a folder of this machine is made.
"""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
#: Bits of a Bloom filter: 8 MB to broadcast, however many keys it has.
BLOOM_BITS = 1 << 26


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session, as a URI or path that Spark can write to."""
    found = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING, None)
    if not found:
        jvm = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jvm.get() if jvm.isDefined() else None
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="folioframe-")
        spark.conf.set(_SETTING, found)
    # With its scheme, so that Spark's writers and those of this package mean the same file system.
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(found)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run of an operator."""
    return f"{shared_dir(spark)}/folioframe/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, path: str) -> DataFrame:
    """df written as a table at path and read again: lineage ends there, and a lost executor costs no more than its tasks."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system, if it is there."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def spread_keys(spark: SparkSession, n: int) -> list[int]:
    """An int for each of n partitions that repartition(n, key) puts there, so that n groups of known size never meet in one task."""
    some = spark.range(0, int(n * (np.log(n + 1) + 12)), 1, 1).select(F.col("id").cast("int").alias("key"))
    got = dict(some.select("key", F.pmod(F.hash("key"), F.lit(n)).alias("at")).groupBy("at").agg(F.min("key").alias("key")).collect())
    free = iter(range(-1, -n - 1, -1))  # for a partition that no key was found for
    return [got[k] if k in got else next(free) for k in range(n)]


def give_back() -> None:
    """What this Python process has freed goes back to the system: workers live on for later tasks, and an executor has several."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def numbered(docs: DataFrame, file: str, row: str) -> DataFrame:
    """docs with two bigint columns that tell every row apart: a hash of its file and its place there.

    Both are what the reader of Parquet files knows of a row, so a task that runs again gives the same. Rows that come from elsewhere are
    written as such files first.
    """
    at = {file: F.xxhash64("_metadata.file_path"), row: F.col("_metadata.row_index")}
    try:
        return docs.select("*", *(c.alias(name) for name, c in at.items()))
    except AnalysisException:
        written = saved(docs, work_dir(docs.sparkSession, "rows"))
        return written.select("*", *(c.alias(name) for name, c in at.items()))


def bloom_of(keys: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter (two bits a key, BLOOM_BITS in all) over a bigint column.

    It is merged by key range on the executors; what reaches the driver has a fixed bound.
    """
    k = F.col(column)
    bit = F.explode(F.array(F.pmod(k, F.lit(BLOOM_BITS)), F.pmod(F.shiftright(k, 26), F.lit(BLOOM_BITS))))
    words = (
        keys.select(bit.alias("b"))
        .groupBy(F.shiftright("b", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(BLOOM_BITS // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def bloom_has(bloom: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each int64 key may be in the filter."""

    def test(b: np.ndarray) -> np.ndarray:
        return (bloom[b >> 6] >> (b & 63)) & 1 == 1

    return test(np.mod(keys, BLOOM_BITS)) & test(np.mod(keys >> 26, BLOOM_BITS))
