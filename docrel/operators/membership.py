"""Array-valued relationships: FLT-1, JOIN-1, AGG-4, PHY-7.

A document like ``students{_id, enrolled_courses: [..]}`` stores a many-to-many
link inside an array.  Joining on ``array_contains`` is a theta join that Spark
can only run as a nested loop (``BroadcastNestedLoopJoin``: every owner against
every item).  Here the array is unwound once into an *edge* table
``(owner, item)`` and everything else is an equi join or a grouped count, which
Spark hash-partitions, pre-aggregates map-side and re-plans with AQE.

Semantics follow ``array_contains``: an owner listing an item twice is matched
once (``array_distinct`` before ``explode``), NULL elements match nothing, a NULL
or empty array yields no edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.operators.grouping import reshuffled_agg


def _members(owners: DataFrame) -> DataFrame:
    # overflow rows of a bucketed collection (negative _chunk) only repeat values
    return owners.filter(F.col("_chunk") >= 0) if "_chunk" in owners.columns else owners


def membership_filter(owners: DataFrame, array_col: str, value) -> DataFrame:
    """FLT-1 — owners whose array contains ``value``; NULL array -> no row."""
    return _members(owners).filter(F.coalesce(F.array_contains(F.col(array_col), F.lit(value)), F.lit(False)))


def membership_edges(owners: DataFrame, owner_key: str, array_col: str, *,
                     owner_as: str = "owner_id", item_as: str = "item_id",
                     distinct: bool = True) -> DataFrame:
    """JOIN-1 building block — one ``(owner, item)`` row per array element.

    ``distinct=True`` (the default, matching ``array_contains`` and ``$lookup``)
    counts an item listed twice by one owner once.  ``distinct=False`` is the
    plain ``explode`` count that double-counts repeated ids.
    """
    arr = F.col(array_col)
    if distinct:
        owners, arr = _members(owners), F.array_distinct(arr)
    return (owners.select(F.col(owner_key).alias(owner_as), F.explode(arr).alias(item_as))
            .filter(F.col(item_as).isNotNull()))


def membership_join(items: DataFrame, owners: DataFrame, item_key: str, array_col: str,
                    *, how: str = "inner", keep_array: bool = False) -> DataFrame:
    """JOIN-1 — ``items ⋈ owners`` on ``item_key ∈ owners.array_col`` as an equi join.

    Returns the columns of both sides, one row per (item, owner) with the item
    in the owner's array.  The array itself is dropped unless ``keep_array``:
    copied onto each of its n matches it would make the output quadratic in
    the fan-out.
    """
    tag = "_member_item"
    unwound = _members(owners).withColumn(tag, F.explode(F.array_distinct(F.col(array_col)))) \
                    .filter(F.col(tag).isNotNull())
    if not keep_array:
        unwound = unwound.drop(array_col)
    inner = items.join(unwound, items[item_key] == unwound[tag])
    if how == "inner":
        return inner.drop(tag)
    if how != "left":
        raise ValueError("how must be 'inner' or 'left'")
    # not a left outer join: AQE could not split the owners of a hot item in it
    taken = reshuffled_agg(unwound, [tag])
    none = items.join(taken, items[item_key] == taken[tag], "left_anti")
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in unwound.schema.fields]
    cols = [*(f"i{n}" for n in range(len(items.columns))), *(f"o{n}" for n in range(len(rest)))]
    both = inner.toDF(*cols).unionByName(none.select("*", *rest).toDF(*cols))
    drop = len(items.columns) + unwound.columns.index(tag)
    names = [*items.columns, *unwound.columns]
    return both.drop(cols[drop]).toDF(*[x for n, x in enumerate(names) if n != drop])


def membership_counts(owners: DataFrame, owner_key: str, array_col: str, *,
                      item_as: str = "item_id", count_as: str = "n_owners") -> DataFrame:
    """PHY-7 — distinct owners per item, counted on the edge table before any
    join (partial aggregation map-side; a hot item is combined in every task)."""
    edges = membership_edges(owners, owner_key, array_col, owner_as="_owner", item_as=item_as)
    return edges.groupBy(item_as).agg(F.count(F.lit(1)).alias(count_as))


def counts_for_items(items: DataFrame, item_key: str, counts: DataFrame, count_item: str,
                     count_col: str, *, include_empty: bool = False) -> DataFrame:
    """AGG-4 — attach per-item counts to the item rows.

    ``include_empty=False`` keeps only items with at least one match (the inner
    join of the baseline Spark queries); ``True`` keeps every item and counts 0
    for the unmatched ones (the ``$lookup`` + ``$size`` pipelines).
    """
    renamed = counts.withColumnRenamed(count_item, "_cnt_item")
    j = items.join(renamed, items[item_key] == renamed["_cnt_item"],
                   "left" if include_empty else "inner").drop("_cnt_item")
    if include_empty:
        j = j.withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0).cast("long")))
    return j
