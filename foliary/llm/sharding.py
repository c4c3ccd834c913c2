"""Sharding by jump consistent hashing (Lamping and Veach): a stable key and the number of shards
decide, no ring table is kept, and one more shard takes rows only into itself.

Cases: a null key is the key 0; a null text has no bytes; equal keys share a shard; slots of
equal keys follow the text's checksum and size, then are arbitrary but gapless; an empty table
gives no rows; columns other than the key and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Fixed values of the published algorithm: the multiplier of its linear congruential generator.
MULTIPLIER = 2862933555777941757


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shards of unsigned 64-bit keys. All keys still jumping take their next jump together."""
    key = keys.astype(np.uint64).copy()
    shard = np.full(len(key), -1, dtype=np.int64)
    nxt = np.zeros(len(key), dtype=np.int64)
    live = np.arange(len(key))
    while len(live):
        shard[live] = nxt[live]
        key[live] = key[live] * np.uint64(MULTIPLIER) + np.uint64(1)
        top = (key[live] >> np.uint64(33)).astype(np.float64) + 1.0
        nxt[live] = ((shard[live] + 1).astype(np.float64) * (2147483648.0 / top)).astype(np.int64)
        live = live[nxt[live] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a long key; expects at least one shard."""
    if shards < 1:
        raise ValueError("at least one shard is needed")

    @F.pandas_udf("int")
    def of(s: pd.Series) -> pd.Series:
        return pd.Series(jump(s.to_numpy(dtype=np.int64).view(np.uint64), shards), dtype="int32")

    return of(F.coalesce(key.cast("long"), F.lit(0)))


def sharded(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = rows.withColumn("shard", shard_of(F.col("doc_id"), shards)).withColumn("grown_shard", shard_of(F.col("doc_id"), shards + 1))
    # the key decides before the slots are counted, so Python is not run again after the shuffle
    return common.prefix_sums(rows.withColumn("_one", F.lit(1)), ["shard"], ["doc_id", "text_crc32", "size"], "_one", "slot").drop("_one")


def write_shards(docs: DataFrame, path: str, shards: int = 8, id_col: str = "doc_id", files_per_shard: int = 1) -> None:
    """One folder per shard, rows of a key together; a large shard is split into files by key. The folders are named `shard=N`, or, where
    the documents have a column of that name, which stays as it is, with underscores before."""
    name = common.free_name(docs, "shard")
    key = F.pmod(F.xxhash64(id_col), F.lit(files_per_shard))
    docs.withColumn(name, shard_of(F.col(id_col), shards)).repartition(name, key).write.partitionBy(name).parquet(path)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = sharded(common.documents(spark, sf_dir), 8)
    return got.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
