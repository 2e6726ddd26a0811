"""Exact deduplication with a heavy-hitter split.

Texts are equal when they are identical after every run of ASCII white space is
replaced by one space (a null text counts as empty).  A copied text that holds a
large share of all rows would meet in one shuffle task, so the digests are split:

1. a Misra-Gries-style summary (Spark's mergeable frequent-items sketch,
   ``approx_top_k``) finds every digest that may be frequent.  Each map task
   keeps at most ``TRACKED`` counters; the summaries are merged in two steps;
2. the candidates, at most ``CANDIDATES`` numbers, are verified by an exact,
   map-side combined aggregate that gives each its winner (smallest id) and size;
3. the verified winners, at most as many rows, are broadcast: copies of heavy
   digests are settled inside the map tasks and are never shuffled;
4. the remaining digests, none of which is frequent, go through an ordinary
   shuffle.

A sketch that misses a digest or names a rare one changes only which path its
rows take, never the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docrel.llm.common import fresh, stored, text_of

#: Counters of a summary, and how many digests it may name.  A digest on more
#: than 3.5 / TRACKED of the rows is always named while there are CANDIDATES.
TRACKED = 4096
CANDIDATES = 1024
#: Groups in which the summaries of the map tasks are merged first.
MERGE_FAN = 64

#: Runs that differ from one space; replacing just these normalises the text.
_RUNS = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"


def normalized(text: str | Column = "text") -> Column:
    """The text with each run of ASCII white space replaced by one space."""
    return F.regexp_replace(text_of(text), _RUNS, " ")


def digest(text: str | Column = "text") -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(F.encode(normalized(text), "UTF-8"), 256))


def frequent(df: DataFrame, col: str, tracked: int = TRACKED,
             candidates: int = CANDIDATES) -> list[int]:
    """Values of the long column that may be frequent; at most ``candidates``."""
    part = df.groupBy((F.spark_partition_id() % MERGE_FAN).alias("fan")).agg(
        F.expr(f"approx_top_k_accumulate(`{col}`, {tracked})").alias("s"))
    # grouped by a constant: merging summaries fails in Spark where a task has none
    merged = part.groupBy(F.lit("all").alias("all")).agg(F.expr(
        f"approx_top_k_estimate(approx_top_k_combine(s, {tracked}), {min(candidates, tracked)})").alias("t")).collect()
    return sorted(x["item"] for row in merged for x in row["t"] or []
                  if x["item"] is not None and x["count"] > 1)


def _in(col: str, values: list[int]) -> Column:
    return F.col(col).isin(values) if values else F.lit(False)


def _winners(keys: DataFrame, heavy: list[int]) -> DataFrame:
    """(sha, keep_id, keep_at, group_size) of the candidates, by exact counting; the
    winner has the smallest id (nulls last) and of these the smallest place."""
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "at"))
    return keys.filter(_in("h64", heavy)).groupBy("sha").agg(first.alias("w"), F.count(F.lit(1)).alias("group_size")) \
               .select("sha", F.col("w.id").alias("keep_id"), F.col("w.at").alias("keep_at"), "group_size")


def _digests(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, sha, h64, at) of every row, stored; ``at`` tells rows of equal id and text apart."""
    return stored(df.select(F.col(id_col).alias("id"), digest(text_col).alias("sha"))
                  .withColumn("h64", F.xxhash64("sha")).withColumn("at", F.monotonically_increasing_id()), "digests")


def membership(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: id, keep_id, group_size, kept, text_sha256.

    Exactly one row of each group is kept: one with the smallest id (nulls count
    as largest; of rows that share id and text any one, as they are the same).
    Null text: empty.  Empty table: no rows.  Other columns are ignored.
    """
    keys = _digests(df, id_col, text_col)
    heavy = frequent(keys, "h64")
    hot = keys.filter(_in("h64", heavy)).join(F.broadcast(_winners(keys, heavy)), "sha")
    hot = hot.withColumn("kept", F.col("at") == F.col("keep_at"))
    w = Window.partitionBy("sha")
    rest = (keys.filter(~_in("h64", heavy))
            .withColumn("keep_id", F.min("id").over(w))
            .withColumn("group_size", F.count(F.lit(1)).over(w))
            .withColumn("kept", F.row_number().over(w.orderBy(F.asc_nulls_last("id"))) == 1))
    cols = [F.col("id").alias(id_col), "keep_id", "group_size", "kept",
            F.lower(F.hex("sha")).alias("text_sha256")]
    return rest.select(*cols).unionByName(hot.select(*cols))


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that :func:`membership` keeps, with all their columns.

    Copies of heavy digests are removed inside the map tasks; the rows left are
    shuffled once, on their digest.
    """
    sha, h64, keep = fresh(df, "dedup_sha"), fresh(df, "dedup_h64"), fresh(df, "dedup_keep")
    keys = _digests(df, id_col, text_col)
    heavy = frequent(keys, "h64")
    rows = df.withColumn(sha, digest(text_col)).withColumn(h64, F.xxhash64(sha))
    win = _winners(keys, heavy).select(F.col("sha").alias(sha), F.col("keep_id").alias(keep),
                                       F.lit(True).alias(fresh(df, "dedup_hot")))
    hot = win.columns[-1]
    left = rows.join(F.broadcast(win), sha, "left") \
               .filter(F.col(hot).isNull() | F.col(id_col).eqNullSafe(F.col(keep)))
    rank = fresh(df, "dedup_rank")
    # equal ids and texts may still differ in other columns: settle that by their hash
    tie = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in df.columns])
    w = Window.partitionBy(sha).orderBy(F.asc_nulls_last(id_col), tie)
    return left.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) == 1) \
               .select(*[F.col(f"`{c}`") for c in df.columns])
