"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docrel.session import ensure_checkpoint_dir, scratch_path

#: One or more ASCII white-space characters, and one word between them.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(col: str | Column = "text") -> Column:
    """The text, a null counting as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fresh(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage in a form that survives lost executors; unlike a
    checkpoint it is compressed, and later reads prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of few rows, so that what a task makes of one stays small."""
    for b in batches:
        for i in range(0, len(b), rows):
            yield b.slice(i, rows)


__all__ = ["SPACES", "WORD", "documents", "ensure_checkpoint_dir", "fresh", "scratch_path",
           "slices", "stored", "text_of"]
