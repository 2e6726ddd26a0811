"""Sources: SRC-1 (collections), SRC-2 (keyed parallel split), SRC-3 (tables).

Reads go straight from storage to executors: nothing passes through the driver.
Declared schemas (``docrel.schemas``) replace schema inference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


FILE_FORMATS = ("parquet", "json", "orc", "csv", "text")


def read_collection(spark: SparkSession, path_or_name: str, *, fmt: str = "parquet",
                    schema: T.StructType | None = None, **options) -> DataFrame:
    """SRC-1 — a document collection as a DataFrame with nested fields.

    ``fmt`` is any Spark data source: ``parquet``/``json`` for files (testable
    here), or a document-store connector format, whose options (connection,
    database, collection, partitioner) pass through unchanged.  A declared
    ``schema`` skips the inference pass; fields missing from a document read
    as NULL.
    """
    r = spark.read.format(fmt).options(**{k: str(v) for k, v in options.items()})
    if schema is not None:
        r = r.schema(schema)
    if fmt in FILE_FORMATS:
        return r.load(path_or_name)
    return r.load()


def keyed_split_options(column: str, lower: int, upper: int, num_partitions: int) -> dict:
    """SRC-2 — options that split a JDBC read into ``num_partitions`` parallel
    range queries on ``column`` (bounds only set the stride; no row is
    filtered out)."""
    if num_partitions < 1 or upper < lower:
        raise ValueError("need num_partitions >= 1 and upper >= lower")
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper),
            "numPartitions": str(num_partitions)}


def connector_split_options(partitioner: str, key: str, num_partitions: int) -> dict:
    """SRC-2 — options that split a document-store read on ``key`` into
    ``num_partitions`` parts by the connector's ``partitioner``; pass them to
    :func:`read_collection`.  (Fixed values: the connector's option names.)"""
    if num_partitions < 1:
        raise ValueError("need num_partitions >= 1")
    return {"partitioner": partitioner, "partitionerOptions.partitionKey": key,
            "partitionerOptions.numberOfPartitions": str(num_partitions)}


def read_table(spark: SparkSession, path_or_table: str, *, fmt: str = "parquet",
               schema: T.StructType | None = None, columns: list[str] | None = None,
               split: dict | None = None, **options) -> DataFrame:
    """SRC-3 — a relational table.

    ``fmt="jdbc"``: ``path_or_table`` is the table (``dbtable``), connection
    options are passed through and ``split`` (from :func:`keyed_split_options`)
    parallelises the read.  File formats read ``path_or_table`` as a path;
    their split is governed by ``spark.sql.files.maxPartitionBytes``.
    ``columns`` projects early (pruned at the scan).
    """
    r = spark.read.format(fmt)
    opts = dict(options)
    if split and fmt in FILE_FORMATS:
        raise ValueError("a keyed split needs a store that can run range queries")
    if fmt == "jdbc":
        opts["dbtable"] = path_or_table
        opts.update(split or {})
    r = r.options(**{k: str(v) for k, v in opts.items()})
    if schema is not None:
        r = r.schema(schema)
    df = r.load() if fmt == "jdbc" else r.load(path_or_table)
    return df.select(*columns) if columns else df
