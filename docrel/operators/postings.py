"""PHY-6 / FLT-1 with posting bitmaps: who holds an item, as bits.

The edge table (owner, item) becomes one bitmap for each (item, bucket of owners): bit p
of bucket b stands for one owner.  "Any of these items" is the union of their bitmaps
bucket by bucket, "all of these" the intersection; members are counted without being
listed.  A bucket spans 32,768 neighbouring owners, so a hot item is many rows, each
4 KB at most, and its buckets are combined in many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BYTES = 4096


def posting_bitmaps(edges: DataFrame, owner: str, item: str) -> DataFrame:
    """(item, bucket, bits) of edges; ``owner`` is a whole number, repeated edges count
    once, NULLs not at all.  Bits are combined in the map tasks before the shuffle."""
    return edges.filter(F.col(owner).isNotNull() & F.col(item).isNotNull()) \
        .groupBy(F.col(item).alias("item"), F.bitmap_bucket_number(F.col(owner).cast("long")).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(owner).cast("long"))).alias("bits"))


def any_of(postings: DataFrame, items: Sequence) -> DataFrame:
    """(bucket, bits): owners of at least one of ``items``."""
    return postings.filter(F.col("item").isin(list(items))).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def all_of(postings: DataFrame, items: Sequence) -> DataFrame:
    """(bucket, bits): owners of every one of ``items``; no items: nobody."""
    items = list(dict.fromkeys(items))
    return postings.filter(F.col("item").isin(items)).groupBy("bucket") \
        .agg(F.bitmap_and_agg("bits").alias("bits"), F.count(F.lit(1)).alias("n")) \
        .filter(F.col("n") == len(items)).select("bucket", "bits")


def member_count(sets: DataFrame, alias: str = "n") -> DataFrame:
    """How many owners a set of bitmaps holds; one row."""
    return sets.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0).cast("long")).alias(alias))


def _byte(bits: Column, at: Column) -> Column:
    return F.conv(F.hex(F.substring(bits, at + 1, F.lit(1))), 16, 10).cast("int")


def members(sets: DataFrame, owner_as: str = "owner") -> DataFrame:
    """The owners of a set of bitmaps, one row each."""
    bytes_ = sets.select("bucket", "bits", F.explode(F.sequence(F.lit(0), F.lit(_BYTES - 1))).alias("at")) \
                 .select("bucket", "at", _byte(F.col("bits"), F.col("at")).alias("byte")).filter("byte <> 0")
    bits = bytes_.select("bucket", "at", "byte", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("bit")) \
                 .filter(F.expr("shiftright(byte, bit) & 1 = 1"))
    # bucket b above 0 holds the owners from (b - 1) * 32768 + 1 on, others those from b * 32768 down
    span, place = F.lit(8 * _BYTES), F.col("at") * 8 + F.col("bit")
    owner = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * span + place + 1).otherwise(F.col("bucket") * span - place)
    return bits.select(owner.cast("long").alias(owner_as))


__all__ = ["all_of", "any_of", "member_count", "members", "posting_bitmaps"]
