"""Helpers shared by the training-data operators.

Work folders live in the folder the cluster names in ``spark.checkpoint.dir``;
intermediate tables are pinned there as Parquet, so a lost executor costs a
reread and never changes a result.
"""

from __future__ import annotations

import os
import re
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package when it is run from a checkout.

    On a cluster the package is installed on the executors or sent with
    ``--py-files``; then this only adds one more (harmless) import path.
    """
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if _ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, have) if x)


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    ship(spark)
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once into the shared folder and return the reread table."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_dir(spark: SparkSession, path: str) -> None:
    """Remove a work folder made by ``work_dir`` (an outdated round of an iteration)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """The pyarrow file system and path of a Hadoop-style URI (``file:/x``, ``hdfs://...``, ``s3://...``)."""
    if re.match(r"file:/|/", uri):
        return pafs.LocalFileSystem(), "/" + re.sub(r"^(file:)?/+", "", uri)
    return pafs.FileSystem.from_uri(uri)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a variant of it that no column of ``df`` has (names compare without case)."""
    have = {c.lower() for c in df.columns}
    out, k = name, 0
    while out.lower() in have:
        k += 1
        out = f"{name}_{k}"
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def range_bounds(df: DataFrame, key: str, shards: int, per_shard: int = 64) -> list[int]:
    """At most ``shards - 1`` ascending split points of an integer column, the same on every run.

    The points are quantiles of the keys whose hash falls under a threshold
    set from the exact row count, so the driver receives about
    ``shards * per_shard`` keys whatever the table's size; only the key column
    is read.
    """
    n = df.filter(F.col(key).isNotNull()).count()
    if shards <= 1 or not n:
        return []
    step = max(1, n // (shards * per_shard))
    hit = F.pmod(F.xxhash64(F.col(key)), F.lit(step)) == 0
    keys = sorted({r[0] for r in df.filter(F.col(key).isNotNull() & hit).select(key).distinct().collect()})
    if not keys:
        return []
    return sorted({keys[len(keys) * i // shards] for i in range(1, shards)})


def shard_of(keys: pa.Array, bounds: list[int]) -> np.ndarray:
    """Shard number of each key (NULL keys: shard 0, they sort first)."""
    null = keys.is_null().to_numpy(zero_copy_only=False)
    k = keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.searchsorted(np.asarray(bounds, dtype=np.int64), k, side="right") if bounds else np.zeros(len(k), np.int64)
    out[null] = 0
    return out.astype(np.int32)


def pair_bounds(df: DataFrame, key: str, salt: str, shards: int, per_shard: int = 64) -> list[tuple[int, int]]:
    """:func:`range_bounds` of (key, salt) pairs, for keys that many rows repeat: an id's rows may fill several shards."""
    n = df.filter(F.col(key).isNotNull()).count()
    if shards <= 1 or not n:
        return []
    step = max(1, n // (shards * per_shard))
    hit = F.pmod(F.xxhash64(F.col(key), F.col(salt)), F.lit(step)) == 0
    pairs = sorted({tuple(r) for r in df.filter(F.col(key).isNotNull() & hit).select(key, salt).distinct().collect()})
    return sorted({pairs[len(pairs) * i // shards] for i in range(1, shards)}) if pairs else []


def shard_of_pair(keys: pa.Array, salts: pa.Array, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Number of bounds at or below each (key, salt) pair (NULL keys: 0, they sort first)."""
    null = keys.is_null().to_numpy(zero_copy_only=False)
    k = keys.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    s = salts.to_numpy(zero_copy_only=False).astype(np.int64)
    edge_k = np.array([b[0] for b in bounds], np.int64)
    edge_s = np.array([b[1] for b in bounds], np.int64)
    out = np.searchsorted(edge_k, k, side="left")
    last = np.searchsorted(edge_k, k, side="right")
    for i in np.flatnonzero(last > out):  # among the bounds of the same key
        out[i] += np.searchsorted(edge_s[out[i]:last[i]], s[i], side="right")
    out[null] = 0
    return out.astype(np.int32)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, and the offsets of its rows in them (NULL as empty)."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return flat[offsets[0]:offsets[-1]], offsets - offsets[0]


def strings(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """Python strings of a text column, NULL as empty."""
    return [x or "" for x in column.to_pylist()]
