"""Updates and appends that touch only what they must.

SNK-3 over a partitioned table rewrites the partitions that hold an updated key and
leaves the files of all others as they are.  SNK-2 into a bucketed table meets the
target on its own bucketing, so the target is neither shuffled nor sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrel.session import drop_scratch, scratch_path
from docrel.sources.sinks import absent_rows, set_fields


def among(col: str, values: Sequence) -> Column:
    """Whether a column holds one of some values, NULL counting as a value."""
    known = [v for v in values if v is not None]
    hit = F.col(col).isin(known) if known else F.lit(False)
    return F.coalesce(hit, F.lit(False)) | F.col(col).isNull() if len(known) < len(values) else hit


def update_partitions(spark: SparkSession, path: str, updates: DataFrame, key: str, fields: Sequence[str], *,
                      partition_by: str, order: Sequence[str] | None = None) -> list:
    """SNK-3 in place on the Parquet table at ``path``, partitioned by ``partition_by``:
    :func:`set_fields` on the partitions that hold an updated key; gives their values.

    1. the key and partition columns alone are read to find those partitions (only the
       partitions that ``updates`` names, if it has the partition column);
    2. their new rows are written to a scratch table;
    3. a dynamic overwrite puts them in the place of those partitions.

    A key's partition does not change (``fields`` may not hold ``partition_by``).  A job
    that fails before 3 leaves the table as it was; a repeated update, the same ``$set``,
    brings it to the same rows.
    """
    if partition_by in fields or key in fields:
        raise ValueError("the key and the partition column cannot be set")
    target = spark.read.parquet(path)
    keys = updates.select(key, *([partition_by] if partition_by in updates.columns else [])).filter(F.col(key).isNotNull())
    where = target.select(key, partition_by)
    if partition_by in updates.columns:
        named = [r[0] for r in keys.select(partition_by).distinct().collect()]  # one value a partition
        where = where.filter(among(partition_by, named)) if named else where.filter(F.lit(False))
        on = F.col("t." + key).eqNullSafe(F.col("u." + key)) & F.col("t." + partition_by).eqNullSafe(F.col("u." + partition_by))
    else:
        on = F.col("t." + key) == F.col("u." + key)
    hit = where.alias("t").join(keys.alias("u"), on, "left_semi")
    touched = [r[0] for r in hit.select(partition_by).distinct().collect()]  # one value a partition
    if not touched:
        return []
    own = [c for c in updates.columns if c in (key, *fields) or c in (order or [])]
    rows = set_fields(target.filter(among(partition_by, touched)), updates.select(*own), key, fields, order=order)
    staged = scratch_path(spark, "partitions")
    rows.write.mode("overwrite").parquet(staged)
    spark.read.schema(target.schema).parquet(staged).write.mode("overwrite") \
         .option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)
    drop_scratch(spark, staged)
    spark.catalog.refreshByPath(path)
    return sorted(touched, key=lambda v: (v is not None, v))


def append_to_bucketed(spark: SparkSession, table: str, batch: DataFrame, keys: Sequence[str], *,
                       n_buckets: int, sort_by: Sequence[str] = (), order: Sequence[str] | None = None) -> None:
    """SNK-2 into the catalog table ``table``, bucketed on ``keys`` into ``n_buckets``:
    only the batch is shuffled, and its rows are written in the table's buckets.

    Applying the same batch twice changes nothing.
    """
    target = spark.table(table)
    fresh = absent_rows(target, batch.select(*target.columns), keys, order=order)
    # staged, as the rows are read from the table that they are written to
    staged = scratch_path(spark, "absent")
    fresh.write.mode("overwrite").parquet(staged)
    rows = spark.read.schema(target.schema).parquet(staged).repartition(n_buckets, *keys)
    w = rows.write.mode("append").bucketBy(n_buckets, *keys)
    (w.sortBy(*sort_by) if sort_by else w).saveAsTable(table)
    drop_scratch(spark, staged)


__all__ = ["among", "append_to_bucketed", "update_partitions"]
