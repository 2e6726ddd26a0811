"""Sinks: SNK-1 full refresh, SNK-2 insert-if-absent, SNK-3 keyed partial
update, SNK-4 CSV.

Writes are distributed (one file per task); no data goes through the driver.
SNK-2 and SNK-3 never overwrite the path they read: they write a new version
to ``out_path`` and return it, so a failed job leaves the old table intact and
a retried one produces the same table (idempotent).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docrel.operators.grouping import first_per_key
from docrel.sources.io import FILE_FORMATS


def refresh(df: DataFrame, path_or_name: str | None = None, *, fmt: str = "parquet", partition_by=None,
            **options) -> None:
    """SNK-1 — drop-and-reload: the target holds exactly ``df`` afterwards.

    File formats write to the path.  Other formats (JDBC, a document-store
    connector) are addressed by their options: for ``jdbc`` the name is the
    ``dbtable``, for a connector nothing but the options says where to write.
    """
    if fmt == "jdbc" and path_or_name:
        options["dbtable"] = path_or_name
    w = df.write.mode("overwrite").format(fmt).options(**{k: str(v) for k, v in options.items()})
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.save(path_or_name if fmt in FILE_FORMATS else None)


def refresh_all(tables: dict[str, DataFrame], paths: dict[str, str], *, fmt: str = "parquet",
                max_parallel: int = 4) -> None:
    """SNK-1 for a set of independent tables (the four collections of a
    migration): each is a full refresh; their jobs are submitted together so
    small tables run alongside big ones instead of after them."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, min(max_parallel, len(tables)))) as pool:
        futures = [pool.submit(refresh, df, paths[k], fmt=fmt) for k, df in tables.items()]
        for f in futures:
            f.result()


def append_if_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str], *,
                     order: Sequence[str] | None = None) -> DataFrame:
    """SNK-2 — the target plus the batch rows whose key is not yet present.

    Several batch rows with one key keep the first in ``order`` (default: the
    key columns then all others), so the outcome does not depend on arrival
    order.  A NULL key is a key like others.  Applying the same batch twice changes nothing.
    """
    return target.unionByName(absent_rows(target, batch.select(*target.columns), keys, order=order))


def absent_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str], *,
                order: Sequence[str] | None = None) -> DataFrame:
    """SNK-2 — one row of ``batch`` for each key that ``target`` does not hold.

    Rows whose key has no NULL are anti-joined on plain equality, which meets a target
    bucketed on ``keys`` where it lies.  NULL keys are keys too (a NULL equals a NULL):
    they are compared null-safely with the target's rows of NULL keys alone.
    """
    keys = list(keys)
    order = list(order) if order else [c for c in batch.columns if c not in keys]
    one = first_per_key(batch, keys, order).select(*batch.columns) if order else batch.dropDuplicates(keys)
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    there = target.select(*keys)
    known = one.filter(~some_null).join(there, keys, "left_anti")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"b.{k}").eqNullSafe(F.col(f"t.{k}"))
    null = one.filter(some_null).alias("b").join(there.filter(some_null).alias("t"), on, "left_anti")
    return known.unionByName(null)


def set_fields(target: DataFrame, updates: DataFrame, key: str, fields: Sequence[str], *,
               order: Sequence[str] | None = None) -> DataFrame:
    """SNK-3 — ``update_one({key: k}, {"$set": {...}})`` for every update row.

    Matched rows take the update's values for ``fields``; unmatched target rows
    are untouched; updates without a target row are dropped (no upsert).  Several
    updates of one key act as successive ``$set``s: the last in ``order`` (make it
    total; NULLs come first) wins.  Without ``order`` a repeated key fails the job.
    """
    values = F.struct(*[F.col(f).alias(f"_u_{f}") for f in fields])
    pick = F.max_by(values, F.struct(*order)) if order else \
        F.when(F.count(F.lit(1)) == 1, F.first(values)).otherwise(
            F.raise_error(F.concat(F.lit("several updates without an order for key "),
                                   F.first(F.col(key).cast("string")))))
    u = updates.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("_uk")).agg(pick.alias("_u")) \
               .select("_uk", F.lit(True).alias("_hit"), "_u.*")
    j = target.join(u, target[key] == u["_uk"], "left")
    cols = []
    for c in target.columns:
        if c in fields:
            cols.append(F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c))
        else:
            cols.append(F.col(c))
    return j.select(*cols)


def write_versioned(df: DataFrame, out_path: str, *, fmt: str = "parquet") -> str:
    """Write a new version of a table to ``out_path`` — never the path being
    read — and return it.  Overwrite mode makes a re-run after a failed
    attempt replace the partial output instead of failing on it."""
    df.write.mode("overwrite").format(fmt).save(out_path)
    return out_path


#: How CSV files are written and read: every string is quoted, a quote in it
#: doubled, and an unquoted mark stands for NULL, so that line breaks, quotes, empty
#: strings and NULLs come back as they were.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"', "lineSep": "\n", "emptyValue": "",
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
CSV_NULL = "\\N"


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """SNK-4 — CSV with a header line, no index column, one part file per task.

    NULL is written as ``\\N``; a string that is just that mark fails the job, as
    it could not be told from NULL.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(c == CSV_NULL, F.raise_error(F.lit(f"{f.name} holds the mark of NULL"))).otherwise(c)
        cols.append(c.alias(f.name))
    df.select(*cols).write.mode(mode).options(**CSV_OPTIONS, nullValue=CSV_NULL, quoteAll=True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back what :func:`write_csv` wrote, with a declared schema; a row that
    does not fit it fails the job."""
    return spark.read.options(**CSV_OPTIONS, nullValue=CSV_NULL, multiLine=True, mode="FAILFAST") \
                .schema(schema).csv(path)
