"""Physical tuning at user level: PHY-1 cache, PHY-2 hash repartition, PHY-3
driver scalar, PHY-5 partitioned/clustered layout, PHY-6 inverted (multikey)
table.  Broadcast joins (JOIN-3) are left to AQE, which knows the bytes of a side
once its shuffle is written.

Secondary indexes do not exist in Spark; their effect — reading only the data
a predicate can match — comes from partition directories (pruning) and from
Parquet row groups clustered on a key (min/max statistics skip the others).
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrel.operators.membership import membership_edges


@contextlib.contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """PHY-1 — persist ``df`` for the block, release it afterwards.  Worth it
    only when two or more actions read it; lost blocks are recomputed."""
    p = df.persist(level)
    try:
        yield p
    finally:
        p.unpersist()


def hash_partition(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """PHY-2 — hash repartition on ``keys``.  Pays off only right before a
    join/aggregate on the same keys, whose exchange it then replaces.  Use it on
    keys without hot values: rows are moved before any map-side aggregation,
    so a key holding a third of the rows lands in one task (aggregate first)."""
    return df.repartition(n, *keys)


def scalar_value(df: DataFrame):
    """PHY-3 — run a one-row aggregate and return its first value to the
    driver (one extra job; use as a literal in a later plan)."""
    row = df.first()
    return None if row is None else row[0]


def write_layout(df: DataFrame, path: str, *, partition_by: Sequence[str] = (),
                 cluster_by: Sequence[str] = (), num_files: int | None = None,
                 bloom_on: dict[str, int] | None = None, row_group_bytes: int | None = None,
                 mode: str = "overwrite") -> str:
    """PHY-5 — write ``df`` partitioned into directories by ``partition_by``
    (equality filters prune whole directories) and range-clustered by
    ``cluster_by`` inside them (row-group min/max statistics skip data).
    ``cluster_by`` should end in a high-cardinality column (e.g. the key) so
    that a hot directory value is still split over several writers.

    ``bloom_on`` names columns for equality lookups on which the rows are not clustered,
    with the distinct values that a row group may hold: each row group gets a Bloom
    filter of that size, and a lookup reads only the groups that may hold its value."""
    out = df
    if cluster_by:
        keys = [*partition_by, *cluster_by]
        # without num_files AQE sizes the range partitions (and so the files)
        out = out.repartitionByRange(num_files, *keys) if num_files else out.repartitionByRange(*keys)
        out = out.sortWithinPartitions(*keys)
    w = out.write.mode(mode)
    for c, distinct in (bloom_on or {}).items():
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true") \
             .option(f"parquet.bloom.filter.expected.ndv#{c}", str(distinct))
    if row_group_bytes:
        w = w.option("parquet.block.size", str(row_group_bytes))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def bucket_table(df: DataFrame, table: str, n_buckets: int, by: Sequence[str],
                 sort_by: Sequence[str] = (), path: str | None = None) -> str:
    """PHY-5 — catalog table bucketed (and sorted) on ``by``: later joins and
    aggregates on ``by`` between tables with the same bucketing skip the
    shuffle.  Rows are shuffled to their buckets first, so a bucket is one file,
    which is what lets a join rely on its order.  ``path``: an external table there."""
    w = df.repartition(n_buckets, *by).write.mode("overwrite").bucketBy(n_buckets, *by)
    if path:
        w = w.option("path", path)
    if sort_by:
        w = w.sortBy(*sort_by)
    w.saveAsTable(table)
    return table


def colocated_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """PHY-5 — join of two tables bucketed and sorted alike on ``keys``: bucket meets
    bucket in a sort-merge join without an exchange.  The hint keeps a side that seems
    small from being broadcast, which would read it whole in every task."""
    return left.join(right.hint("merge"), list(keys), how)


def write_inverted_index(owners: DataFrame, owner_key: str, array_col: str, path: str, *,
                         item_as: str = "item_id", owner_as: str = "owner_id",
                         num_files: int | None = None) -> str:
    """PHY-6 — multikey index on an array field, as a table.

    One ``(item, owner)`` row per distinct array element, range-clustered by
    item.  ``array_contains(arr, v)`` (a full scan) becomes ``item = v`` on
    this table: pushed to the Parquet reader, which skips every row group
    whose item range excludes ``v``.
    """
    edges = membership_edges(owners, owner_key, array_col, owner_as=owner_as, item_as=item_as)
    # range on (item, owner): files stay clustered by item, yet an item held by
    # a third of all owners is spread over several writers instead of one;
    # without num_files AQE sizes the range partitions (and so the files)
    ranged = edges.repartitionByRange(num_files, item_as, owner_as) if num_files \
        else edges.repartitionByRange(item_as, owner_as)
    ranged.sortWithinPartitions(item_as, owner_as).write.mode("overwrite").parquet(path)
    return path


def index_lookup(spark: SparkSession, path: str, value, *, item_as: str = "item_id",
                 owner_as: str = "owner_id") -> DataFrame:
    """Owners whose array holds ``value``, read through the inverted table."""
    return spark.read.parquet(path).filter(F.col(item_as) == value).select(owner_as)
