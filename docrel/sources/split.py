"""SRC-2 — balanced splits of a keyed source into range reads.

A store that splits by equal strides of the key puts most rows of a skewed key into one
part.  Here the bounds are quantiles of the key (a mergeable sketch, one pass), so the
parts have about equally many rows whatever the distribution.  A value that fills whole
parts by itself is cut further by a second column.  Each part is one range predicate:
for a JDBC read one query, for files a pushed-down filter.
"""

from __future__ import annotations

import datetime
import decimal
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Relative error of the sketch is 1 / ACCURACY of the rows.
ACCURACY = 10_000


def literal(value) -> str:
    """A value as a SQL literal."""
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, bool) or not isinstance(value, (int, float, decimal.Decimal)):
        raise TypeError(f"no range split on {type(value).__name__}")
    return repr(value) if not isinstance(value, decimal.Decimal) else str(value)


def quantiles(df: DataFrame, col: str | Column, n: int) -> list:
    """The n - 1 inner bounds of n equal parts of the non-null values, in order."""
    if n < 2:
        return []
    col = F.col(col) if isinstance(col, str) else col
    cuts = df.agg(F.percentile_approx(col, [i / n for i in range(1, n)], ACCURACY).alias("q")).first()["q"]
    return sorted(cuts or [])


def _ranges(col: str, cuts: Sequence, of: str = "") -> list[str]:
    """Predicates (lo, hi] over distinct sorted bounds, the outer ones open."""
    out = []
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        parts = ([of] if of else []) + ([f"{col} > {literal(lo)}"] if lo is not None else []) \
            + ([f"{col} <= {literal(hi)}"] if hi is not None else [])
        out.append(" AND ".join(parts) if parts else f"{col} IS NOT NULL")
    return out


def balanced_predicates(df: DataFrame, key: str, n_parts: int, *, tie: str | None = None) -> list[str]:
    """SQL predicates that put every row of ``df`` into exactly one part, of about
    equal sizes; the last one holds the rows whose key is NULL.

    ``key`` is a numeric, date or timestamp column.  A value that is the bound of two or
    more neighbouring parts holds more rows than a part: it becomes a part of its own,
    cut into as many by quantiles of ``tie`` where one is given (rows whose ``tie`` is
    NULL in the first of them).
    """
    if n_parts < 1:
        raise ValueError("need n_parts >= 1")
    cuts = quantiles(df.select(key), key, n_parts)
    times = {v: cuts.count(v) for v in cuts}
    heavy = [v for v in sorted(times) if times[v] > 1]
    out = []
    for lo, hi in zip([None, *sorted(times)], [*sorted(times), None]):
        last = hi in heavy
        bounds = [f"{key} > {literal(lo)}"] if lo is not None else []
        bounds += [f"{key} {'<' if last else '<='} {literal(hi)}"] if hi is not None else []
        out.append(" AND ".join(bounds) if bounds else f"{key} IS NOT NULL")
        if last:
            own = f"{key} = {literal(hi)}"
            cut = sorted(set(quantiles(df.filter(own).select(tie), tie, times[hi]))) if tie else []
            within = _ranges(tie, cut, own) if cut else [own]
            if tie and cut:
                within[0] = f"{own} AND ({tie} <= {literal(cut[0])} OR {tie} IS NULL)"
            out += within
    return [*out, f"{key} IS NULL"]


def part_of(predicates: Sequence[str]) -> Column:
    """The number of the part that a row falls into."""
    out = F.lit(None).cast("int")
    for i, p in reversed(list(enumerate(predicates))):
        out = F.when(F.expr(p), F.lit(i)).otherwise(out)
    return out


def read_parts(df: DataFrame, predicates: Sequence[str], part_as: str | None = None) -> DataFrame:
    """``df`` read part by part: one filtered scan a predicate, pushed to the source."""
    out = None
    for i, p in enumerate(predicates):
        part = df.filter(p)
        part = part.withColumn(part_as, F.lit(i)) if part_as else part
        out = part if out is None else out.unionByName(part)
    return out


def jdbc_arguments(url: str, table: str, predicates: Sequence[str], **properties) -> dict:
    """Arguments of ``spark.read.jdbc`` for one connection and query a part."""
    return {"url": url, "table": table, "predicates": list(predicates),
            "properties": {k: str(v) for k, v in properties.items()}}


def read_jdbc_parts(spark: SparkSession, url: str, table: str, key: str, n_parts: int, *,
                    tie: str | None = None, **properties) -> DataFrame:
    """A JDBC table read in balanced parts.  The bounds come from a sketch over a first
    read of the key alone, itself split by equal strides between the key's ends."""
    props = {k: str(v) for k, v in properties.items()}
    ends = f"(SELECT min({key}) AS lo, max({key}) AS hi FROM {table}) ends"
    lo, hi = spark.read.jdbc(url, ends, properties=props).first()
    cols = ", ".join([key, *([tie] if tie else [])])
    keys = spark.read.jdbc(url, f"(SELECT {cols} FROM {table}) keys", column=key, lowerBound=lo, upperBound=hi,
                           numPartitions=n_parts, properties=props) if lo is not None and isinstance(lo, int) \
        else spark.read.jdbc(url, f"(SELECT {cols} FROM {table}) keys", properties=props)
    return spark.read.jdbc(**jdbc_arguments(url, table, balanced_predicates(keys, key, n_parts, tie=tie), **properties))


__all__ = ["balanced_predicates", "jdbc_arguments", "literal", "part_of", "quantiles", "read_jdbc_parts", "read_parts"]
