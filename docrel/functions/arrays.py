"""Column-level helpers: arrays (ARR-1, ARR-2, AGG-10), constant maps (ARR-3),
formatting (ARR-4) and repeatable hashing (used by WIN-1/WIN-2).

All of them are built-in Catalyst expressions, so they stay inside whole-stage
codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unwind(df: DataFrame, array_col: str, as_: str | None = None, *,
           preserve_empty: bool = False, distinct: bool = False,
           drop_source: bool = True) -> DataFrame:
    """ARR-1 — one row per array element.

    ``preserve_empty=False`` drops rows whose array is NULL or empty (``explode``);
    ``True`` keeps them with a NULL element (``explode_outer``).  ``distinct``
    removes repeated elements first, so an id listed twice yields one row.
    """
    as_ = as_ or array_col
    arr = F.col(array_col)
    if distinct:
        arr = F.array_distinct(arr)
    gen = F.explode_outer(arr) if preserve_empty else F.explode(arr)
    keep = [c for c in df.columns if not (drop_source and c == array_col) and c != as_]
    return df.select(*keep, gen.alias(as_))


def array_size0(arr) -> Column:
    """AGG-10 — array length with NULL (missing field) counted as 0."""
    return F.coalesce(F.size(_c(arr)), F.lit(0))


def is_subset(a, b) -> Column:
    """ARR-2 — every element of ``a`` is in ``b``; the empty set is a subset of
    anything.  A NULL ``a`` is treated as empty, a NULL ``b`` as empty."""
    a = F.coalesce(_c(a), F.array())
    b = F.coalesce(_c(b), F.array())
    return F.size(F.array_except(a, b)) == 0


def array_any(arr, pred: Callable[[Column], Column]) -> Column:
    """FLT-4 helper — some element satisfies ``pred`` (NULL array -> false)."""
    return F.coalesce(F.exists(_c(arr), pred), F.lit(False))


def sorted_join(arr, sep: str = ",") -> Column:
    """Canonical text of an array (sorted, joined) for comparison and hashing."""
    return F.array_join(F.array_sort(_c(arr)), sep)


def map_lookup(mapping: Mapping, key) -> Column:
    """ARR-3 — value for ``key`` from a constant map (NULL when absent)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*pairs), _c(key)) if pairs else F.lit(None)


def zero_pad(prefix, number, width: int = 3, sep: str = "-") -> Column:
    """ARR-4 — ``PREFIX-007``; the number is padded, never truncated."""
    return F.format_string(f"%s{sep}%0{width}d", _c(prefix), _c(number))


def md5_int(*parts) -> Column:
    """Repeatable 32-bit hash of the ``|``-joined text of ``parts``.

    The same value comes out of any engine that has MD5 (first 8 hex digits),
    which lets samples be checked against an SQL oracle.
    """
    text = F.concat_ws("|", *[_c(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def rand_in_range(lo: int, hi: int, *parts) -> Column:
    """WIN-2 — repeatable integer in [lo, hi] per key (``random.randint`` per row)."""
    return (F.lit(lo) + md5_int(*parts) % F.lit(hi - lo + 1)).cast("int")
