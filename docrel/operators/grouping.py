"""Grouping, scalar aggregates, one-row-per-key and top-k:
AGG-1, AGG-2, AGG-3, AGG-5, AGG-7, JOIN-4, ORD-1, ORD-2, ORD-3.

Skew: every aggregate here is partial/final (map-side combine), so a key that
holds a third of the rows is reduced inside each map task before the shuffle.
"First row per key" is a ``min_by`` aggregate, not a sorted window, for the same
reason.  Global top-k is ``TakeOrderedAndProject`` (each task keeps k rows); the
per-group form relies on Spark's window group limit, which trims each group to k
rows before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Parts of a group that a top-k beyond Spark's group limit cuts first.
GROUP_PARTS = 64


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def reshuffled_agg(df: DataFrame, keys, *aggs: Column) -> DataFrame:
    """``groupBy(keys).agg(*aggs)`` (or distinct ``keys`` without aggs) whose
    result a later join on ``keys`` re-shuffles.

    An aggregate joined straight on its own grouping keys is read without an
    exchange; AQE can split a skewed join partition only when *both* join
    inputs are shuffle stages.  Grouping on one struct column hides the hash
    partitioning, so the small aggregate side is shuffled again and a hot key
    on the other side can be split.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    g = df.groupBy(F.struct(*keys).alias("_gk"))
    out = g.agg(*aggs) if aggs else g.count().drop("count")
    return out.select(*[F.col(f"_gk.{k}").alias(k) for k in keys],
                      *[c for c in out.columns if c != "_gk"])


#: Parts that a key of few values is spread over where one row per value is joined to it.
KEY_PARTS = 64


def attach_per_group(df: DataFrame, per_group: DataFrame, group: str, spread_on: str,
                     how: str = "inner") -> DataFrame:
    """Join a table of one row per group to rows of few, possibly hot groups.

    Joined on the group alone, all rows of a group would be shuffled to one task
    where the table is too large to broadcast.  Both sides are keyed on (group,
    part): a row's part is a hash of ``spread_on``, the table holds every part.
    """
    part = F.pmod(F.xxhash64(spread_on), F.lit(KEY_PARTS)).cast("int")
    parts = per_group.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(KEY_PARTS - 1))))
    return df.withColumn("_part", part).join(parts, [group, "_part"], how).drop("_part")


def count_per_group(df: DataFrame, keys, alias: str = "count") -> DataFrame:
    """AGG-1 — rows per group."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(alias))


def scalar_count(df: DataFrame, alias: str = "count") -> DataFrame:
    """AGG-3 — whole-table count as a one-row DataFrame (no driver round trip)."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def mean_of_counts(counts: DataFrame, count_col: str, alias: str, *,
                   drop_empty: bool = False) -> DataFrame:
    """AGG-2 / AGG-7 — mean of per-group counts.

    A global aggregate over zero rows gives one NULL row in SQL; the document
    pipeline gives no row.  ``drop_empty=True`` selects the pipeline behaviour.
    """
    out = counts.agg(F.avg(F.col(count_col)).alias(alias), F.count(F.lit(1)).alias("_n"))
    if drop_empty:
        out = out.filter(F.col("_n") > 0)
    return out.drop("_n")


def attach_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """JOIN-4 — put the columns of a global aggregate on every row.

    ``scalar`` must be a global aggregate (exactly one row), so broadcasting it
    is bounded by construction.
    """
    return df.crossJoin(F.broadcast(scalar))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """AGG-5 — one row per key: the row smallest in ``order`` (ascending).

    The reference leaves the kept row unspecified (``dropDuplicates`` /
    ``$first``); we require an order so the result is repeatable.  Make
    ``order`` total (add a unique column) for a unique answer.  NULLs in
    ``order`` sort first.  Runs as ``min_by`` with partial aggregation.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ordk = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    row = F.struct(*[F.col(c) for c in rest])
    picked = df.groupBy(*keys).agg(F.min_by(row, ordk).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def top_k(df: DataFrame, by, k: int, tiebreak=None) -> DataFrame:
    """ORD-1/2/3 — first ``k`` rows by ``by`` (Columns carry their direction),
    with ``tiebreak`` making the order total.  Plans as TakeOrderedAndProject."""
    order = _cols(by) + (_cols(tiebreak) if tiebreak is not None else [])
    return df.orderBy(*order).limit(k)


def top_k_with_ties(df: DataFrame, value: str, k: int, *, descending: bool = True) -> DataFrame:
    """ORD-3 ``with_ties`` — rows whose rank (SQL ``rank()``) on ``value`` is <= k.

    rank(x) <= k exactly when x is at least as good as the k-th best value, so
    we take the k best values with a top-k (k rows) and filter by the k-th.
    No global window, no single-task sort of the whole table.
    """
    v = F.col(value)
    best = df.select(v.alias("_v")).orderBy(F.col("_v").desc() if descending else F.col("_v").asc()) \
             .limit(k)
    cut = best.agg((F.min("_v") if descending else F.max("_v")).alias("_cut"))
    cond = (v >= F.col("_cut")) if descending else (v <= F.col("_cut"))
    return df.filter(v.isNotNull()).crossJoin(F.broadcast(cut)).filter(cond).drop("_cut")


def top_k_per_group(df: DataFrame, group, by, k: int, tiebreak=None,
                    rank_as: str | None = None) -> DataFrame:
    """ORD-3 per group — first ``k`` rows of each group in a total order.

    Spark turns ``row_number() <= k`` into a window group limit that keeps k
    rows per group in every map task before the shuffle, so a hot group sends
    at most k rows per task.  Spark does so only while k is within
    ``spark.sql.optimizer.windowGroupLimitThreshold``; beyond it the group's parts
    by a hash of its rows are cut to k rows first, so a hot group is many tasks too.
    """
    order = _cols(by) + (_cols(tiebreak) if tiebreak is not None else [])
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        part = Window.partitionBy(*_cols(group), "_part").orderBy(*order)
        df = df.withColumn("_part", F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in df.columns]),
                                           F.lit(GROUP_PARTS))) \
               .withColumn("_rn", F.row_number().over(part)).filter(F.col("_rn") <= k).drop("_part", "_rn")
    w = Window.partitionBy(*_cols(group)).orderBy(*order)
    rn = rank_as or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    return out if rank_as else out.drop(rn)
