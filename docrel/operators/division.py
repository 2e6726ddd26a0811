"""Relational division — "entities related to *all* items of a set".

AGG-8 ``divide``: count-based.  (entity, item) pairs are semi-joined to the
divisor, made distinct and counted per entity; an entity qualifies when its count
equals the divisor's size.  Every step is a shuffle on a key or a partial aggregate, so
neither the dividend nor the divisor has to fit anywhere.

AGG-9 ``divide_by_containment``: set-based (``$setIsSubset``).  The divisor is a
subset of an entity's items when the entity has as many different divisor items
as the divisor; they are counted as a distinct aggregate and never collected.
Both forms return the same rows; tests compare them.

Options (SURVEY §2.11 rows 5 and 6): pairs are made distinct first, so repeated
(entity, item) rows cannot inflate a count; an empty divisor yields no entity
by default (``empty_divisor="none"``, the SQL count form) or every candidate
entity (``"all"``, textbook division).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.operators.grouping import reshuffled_agg


def _g(group) -> list[str]:
    if group is None:
        return []
    return [group] if isinstance(group, str) else list(group)


def divide(dividend: DataFrame, divisor: DataFrame, entity: str, item: str, *,
           group=None, empty_divisor: str = "none",
           entities: DataFrame | None = None, unique_pairs: bool = False,
           unique_divisor: bool = False) -> DataFrame:
    """AGG-8 — rows ``(group..., entity)`` such that, within the group, the entity
    is paired with every divisor item.

    ``dividend`` has columns ``group..., entity, item``; ``divisor`` has
    ``group..., item``.  With ``empty_divisor="all"`` an empty divisor (of a group)
    returns every entity of ``entities`` (of that group; default: of the dividend).
    ``unique_pairs=True`` declares the (group, entity, item) rows of the
    dividend already distinct (e.g. a functional dependency item → entity),
    which saves the de-duplicating shuffle; ``unique_divisor=True`` does the
    same for divisor rows (e.g. items that are primary keys).
    """
    if empty_divisor not in ("none", "all"):
        raise ValueError("empty_divisor must be 'none' or 'all'")
    g = _g(group)
    need_items = divisor.select(*g, item).filter(F.col(item).isNotNull())
    if not unique_divisor:
        need_items = reshuffled_agg(need_items, g + [item])  # distinct, re-shuffled for the join
    need = (reshuffled_agg(need_items, g, F.count(F.lit(1)).alias("_need")) if g
            else need_items.agg(F.count(F.lit(1)).alias("_need")))
    # semi join first: only pairs with a divisor item are made distinct and shuffled
    pairs = (dividend.select(*g, entity, item).filter(F.col(entity).isNotNull())
             .join(need_items, g + [item], "left_semi"))
    if not unique_pairs:
        pairs = pairs.distinct()
    have = pairs.groupBy(*g, entity).agg(F.count(F.lit(1)).alias("_have"))
    return _matching(have, need, g, entity, empty_divisor, entities if entities is not None else dividend)


def _matching(have: DataFrame, need: DataFrame, g: list[str], entity: str, empty_divisor: str,
              universe: DataFrame) -> DataFrame:
    """Entities with as many items as their divisor, and those with an empty one if asked."""
    if g:
        hit = have.join(need, g).filter(F.col("_have") == F.col("_need")).select(*g, entity)
        if empty_divisor == "all":
            rest = universe.select(*g, entity).filter(F.col(entity).isNotNull()).distinct()
            hit = hit.unionByName(rest.join(need, g, "left_anti"))
        return hit
    hit = have.crossJoin(F.broadcast(need)).filter(F.col("_have") == F.col("_need")).select(entity)
    if empty_divisor == "all":
        rest = universe.select(entity).filter(F.col(entity).isNotNull()).distinct()
        hit = hit.unionByName(rest.crossJoin(F.broadcast(need.filter(F.col("_need") == 0))).select(entity))
    return hit


def divide_by_containment(dividend: DataFrame, divisor: DataFrame, entity: str, item: str, *,
                          group=None, empty_divisor: str = "none",
                          entities: DataFrame | None = None) -> DataFrame:
    """AGG-9 — same answer and options as :func:`divide`, via set containment:
    the number of different divisor items of an entity against their number."""
    if empty_divisor not in ("none", "all"):
        raise ValueError("empty_divisor must be 'none' or 'all'")
    g = _g(group)
    need_items = reshuffled_agg(divisor.select(*g, item).filter(F.col(item).isNotNull()), g + [item])
    size = F.count_distinct(item)
    need = (reshuffled_agg(need_items, g, size.alias("_need")) if g
            else need_items.agg(size.alias("_need")))
    have = (dividend.select(*g, entity, item).filter(F.col(entity).isNotNull())
            .join(need_items, g + [item], "left_semi")
            .groupBy(*g, entity).agg(size.alias("_have")))
    return _matching(have, need, g, entity, empty_divisor, entities if entities is not None else dividend)
