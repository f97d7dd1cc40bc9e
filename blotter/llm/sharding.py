"""Operator 5: jump consistent hashing of stable keys to shards.

A row's shard depends on its key and the shard count alone (no ring table, no
state): appending one shard moves about 1/(n+1) of the keys, all of them into
the new shard.  Slots number the rows of a shard without gaps.

Defined results: a null key is a key like any other (all its rows share one
shard); null text has size 1 and the checksum of the empty text; repeated rows
each get a slot of their own; an empty table gives an empty result; extra
columns are ignored, whatever their names."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import running_total, ship_package

LAW = "key"


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key among ``shards`` (Lamping and Veach's jumps, all
    keys at once; the multiplier is the published generator's)."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64, copy=True)
    shard = np.zeros(len(state), dtype=np.int64)
    live = np.arange(len(state))
    while len(live):
        state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
        draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
        nxt = ((shard[live] + 1) * (float(1 << 31) / draw)).astype(np.int64)
        inside = nxt < shards
        live = live[inside]
        shard[live] = nxt[inside]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    """Column form: the shard of a key column of any type."""
    @F.pandas_udf("int")
    def jump(h: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(h.to_numpy(dtype=np.int64).view(np.uint64), shards))

    return jump(F.xxhash64(key))


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = 16, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: key, size, checksum, shard, slot in the shard, and
    the shard after one more shard is appended.  Only these thin columns are
    shuffled, never the texts."""
    ship_package(spark)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    thin = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).cast("long").alias("text_crc32"),
        shard_of(F.col(key), shards).alias("shard"),
        shard_of(F.col(key), shards + 1).alias("grown_shard"),
        F.lit(1).cast("long").alias("__one"))
    order = [F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    placed = running_total(spark, thin, "shard", order, "__one", "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), "grown_shard")


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """The rows themselves as one Parquet folder per shard."""
    ship_package(docs.sparkSession)
    (docs.withColumn("__shard", shard_of(F.col(key), shards))
     .withColumnRenamed("__shard", "shard_id").write.partitionBy("shard_id").parquet(path))
