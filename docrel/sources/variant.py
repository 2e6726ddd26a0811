"""SRC-1 — documents without a declared schema, as ``VARIANT``.

A document store's collections may drift: a field is missing in one document, null in
another, an empty array or a different type in a third.  A declared schema reads the
first two alike.  Here each line is one binary-encoded value whose paths are taken when
asked for, and a field's state tells all cases apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: States of a field, in the order in which they are tested.
STATES = ("malformed", "missing", "null", "empty_array", "array", "object", "scalar")


def read_documents(spark: SparkSession, path: str, doc_as: str = "doc") -> DataFrame:
    """One row a line of JSON: the text ``line`` and the document, NULL where it is malformed."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.try_parse_json("value").alias(doc_as))


def field(doc: str | Column, path: str, kind: str) -> Column:
    """The value at ``path`` as ``kind``; NULL where it is missing, null or of another kind."""
    return F.try_variant_get(F.col(doc) if isinstance(doc, str) else doc, path, kind)


def field_state(doc: str | Column, path: str) -> Column:
    """One of ``STATES`` for the field at ``path``."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    value = F.variant_get(doc, path, "variant")
    kind = F.schema_of_variant(value)
    return (F.when(doc.isNull(), "malformed").when(value.isNull(), "missing")
            .when(F.is_variant_null(value), "null")
            .when(kind.startswith("ARRAY"), F.when(
                F.size(F.try_variant_get(value, "$", "array<variant>")) == 0, "empty_array").otherwise("array"))
            .when(kind.startswith("OBJECT"), "object").otherwise("scalar"))


def merged_schema(docs: DataFrame, doc: str = "doc") -> str:
    """The schema that all documents together have, conflicting types as VARIANT."""
    return docs.agg(F.schema_of_variant_agg(doc).alias("s")).first()["s"]


def student_documents(docs: DataFrame, doc: str = "doc") -> tuple[DataFrame, DataFrame]:
    """``students`` and ``enrolled`` from drifting documents, as the declared collections:
    an array that is missing or null has no row in ``enrolled``, an empty one an empty row."""
    take = lambda path, kind: field(doc, path, kind)
    good = docs.filter(F.col(doc).isNotNull())
    students = good.select(take("$._id", "bigint").alias("_id"), take("$.student_name", "string").alias("student_name"),
                           take("$.student_email", "string").alias("student_email"),
                           take("$.department_id", "int").alias("department_id"))
    arrays = good.select(take("$._id", "bigint").alias("_id"), F.lit(0).cast("long").alias("_chunk"),
                         take("$.enrolled_courses", "array<bigint>").alias("enrolled_courses"))
    return students, arrays.filter(F.col("enrolled_courses").isNotNull())


__all__ = ["STATES", "field", "field_state", "merged_schema", "read_documents", "student_documents"]
