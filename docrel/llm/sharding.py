"""Sharding by rendezvous hashing of stable record keys.

Every (key, shard) pair has a number u in (0, 1) from a digest, and a record goes to
the shard with the least ``-ln(u) / weight``.  That is an exponential variable whose
rate is the shard's weight, so a shard wins a share of the keys in proportion to its
weight.  A record's numbers for the shards that stay are not changed when a shard is
added or taken away: only records that the new shard wins, or the lost one held, move.

The shard of a record is a function of its key and the shards alone, computed in the
scan: no shuffle, no state.  Places inside a shard (``slot``) are numbered by ranges,
so a shard's rows are spread over tasks like any others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrel.llm.common import stored, text_of
from docrel.operators.integrity import assign_ids

SHARDS = 40
SEED = "shard-1"
#: Bytes that a record takes beside its text.
OVERHEAD = 16
#: Hex digits of a digest that are read: 52 bits, which a double holds exactly.
_DIGITS = 13


def record_key(col: str | Column) -> Column:
    """A stable text for a key; null is a key of its own."""
    col = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.concat(F.lit("k"), col.cast("string")), F.lit("null"))


def score(key: Column, shard: int, weight: float = 1.0, seed: str = SEED) -> Column:
    """The score of a key at a shard; the least one wins."""
    digest = F.md5(F.encode(F.concat(F.lit(f"{seed}|{shard}|"), key), "UTF-8"))
    number = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double")
    return -F.ln((number + 0.5) / float(16 ** _DIGITS)) / float(weight)


def shard_of(key: Column, weights: Sequence[float], seed: str = SEED) -> Column:
    """struct<score, shard>: the winner among shards 0 to ``len(weights) - 1``; of equal
    scores the lower shard."""
    if not weights or any(not 0 < w < float("inf") for w in weights):
        raise ValueError("weights must be positive")
    return F.array_min(F.array(*[F.struct(score(key, s, w, seed).alias("score"), F.lit(s).alias("shard"))
                                 for s, w in enumerate(weights)]))


def sharded(df: DataFrame, key_col: str = "doc_id", weights: Sequence[float] = (1.0,) * SHARDS,
            seed: str = SEED, shard_as: str = "shard") -> DataFrame:
    """``df`` with the shard of each row's key, all columns kept (``shard_as`` must be new).

    Rows with equal keys, null among them, share a shard.
    """
    if shard_as.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"there is a column {shard_as} already")
    return df.withColumn(shard_as, shard_of(record_key(f"`{key_col}`"), weights, seed)["shard"])


def write_sharded(df: DataFrame, path: str, key_col: str = "doc_id",
                  weights: Sequence[float] = (1.0,) * SHARDS, seed: str = SEED) -> str:
    """Write ``df`` as Parquet, one folder ``shard=N`` a shard.

    Rows are not shuffled: each task appends to the folders of its rows.  A retried
    or repeated write replaces the whole output.
    """
    sharded(df, key_col, weights, seed).write.mode("overwrite").partitionBy("shard").parquet(path)
    return path


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
           weights: Sequence[float] = (1.0,) * SHARDS, more: float = 1.0, seed: str = SEED) -> DataFrame:
    """One row per row of ``df``: id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the text's UTF-8 bytes (null: none) and ``OVERHEAD``; ``slot`` counts
    a shard's rows from 0 by id (nulls first), size and checksum; ``grown_shard`` is
    the shard when one of weight ``more`` is added.  Empty texts, ties and repeated
    rows are rows like others.  Empty table: no rows.  Other columns are ignored.
    """
    body = F.encode(text_of(text_col), "UTF-8")
    key = record_key(f"`{id_col}`")
    rows = df.select(F.col(id_col).alias("id"), (F.length(body) + OVERHEAD).cast("long").alias("size"),
                     F.crc32(body).alias("crc"), shard_of(key, weights, seed).alias("won"),
                     score(key, len(weights), more, seed).alias("new"))
    rows = stored(rows.select("id", "size", "crc", F.col("won.shard").alias("shard"),
                              F.when(F.col("new") < F.col("won.score"), len(weights))
                              .otherwise(F.col("won.shard")).alias("grown")), "shards")
    # the row's place parts equal rows, so that a key with many rows is cut into ranges too
    placed = assign_ids(rows.withColumn("at", F.monotonically_increasing_id()), ["id", "size", "crc", "at"],
                        "slot", start=0, group_cols=["shard"])
    return placed.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"),
                         F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), "slot",
                         F.col("grown").cast("int").alias("grown_shard"))
