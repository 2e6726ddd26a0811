"""Repeatable per-group sampling and assignment: WIN-1..WIN-4, JOIN-10.

The reference draws with ``random.sample`` / ``random.randint`` in a driver
loop.  Here every draw is a hash of (seed, key, draw number), so the result is
a pure function of the data and the seed, computed in parallel, and checkable
against SQL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrel.functions.arrays import md5_int, rand_in_range, zero_pad
from docrel.operators.grouping import attach_per_group
from docrel.operators.integrity import assign_ids


def number_within_group(items: DataFrame, group: str, item: str, idx_as: str = "idx") -> DataFrame:
    """Items numbered 0..m-1 inside each group (in ``item`` order) — via
    :func:`assign_ids`, so a huge group is not one task."""
    return assign_ids(items.select(group, item), [item], idx_as, start=0, group_cols=[group])


def sample_per_entity(entities: DataFrame, items: DataFrame, entity: str, group: str,
                      item: str, k, seed: int, *, item_as: str | None = None) -> DataFrame:
    """WIN-1 — for each entity, ``min(k, m)`` distinct items drawn without
    replacement from the m items of its own group (``random.sample``).

    Draw j (0-based) takes position ``md5_int(seed, entity, j) mod (m - j)``
    among the items not yet drawn (sequential selection, exact: no retries,
    no pairs of entity × group).  Items are numbered per group, so the draw
    turns into an equi join on (group, index).

    ``entities``: columns ``entity, group``; ``items``: ``group, item``.
    ``k`` is an int or a Column (e.g. :func:`rand_in_range` for 3–5 per entity).
    Output: ``entity, item`` (renamed to ``item_as``), one row per drawn item.
    """
    numbered = number_within_group(items, group, item, "_idx")
    sizes = items.groupBy(group).agg(F.count(F.lit(1)).alias("_m"))  # one row per group
    kk = F.lit(k) if not isinstance(k, Column) else k
    e = attach_per_group(entities.select(entity, group, kk.cast("long").alias("_k")), sizes, group, entity)
    e = e.withColumn("_n", F.least(F.col("_k"), F.col("_m"))).filter(F.col("_n") > 0)
    ent = F.col(entity)

    def draw(acc, j):
        r = md5_int(F.lit(seed), ent, j) % (F.col("_m") - j)
        # map r to the r-th position not yet drawn: walk the drawn ones in order
        pos = F.aggregate(F.array_sort(acc), r, lambda v, c: F.when(v >= c, v + 1).otherwise(v))
        return F.concat(acc, F.array(pos))

    picks = F.aggregate(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1),
                        F.array().cast("array<bigint>"), draw)
    drawn = e.select(ent, F.col(group), F.explode(picks).alias("_idx"))
    out = drawn.join(numbered.select(group, "_idx", item), [group, "_idx"])
    return out.select(ent, F.col(item).alias(item_as or item))


def first_claim(claims: DataFrame, item: str, claimant: str, order: Sequence[str], *,
                claimant_as: str | None = None) -> DataFrame:
    """WIN-3 — first-wins assignment: each item goes to the claimant of its
    earliest claim in ``order`` (``SELECT … IF NOT EXISTS`` in a loop).

    A claim never depends on earlier outcomes, so the loop equals "smallest
    claim per item", computed as ``min_by`` with partial aggregation.
    """
    ordk = F.struct(*[F.col(o) for o in order], F.col(claimant))
    picked = claims.groupBy(item).agg(F.min_by(F.col(claimant), ordk).alias(claimant_as or claimant))
    return picked


def expand_grid(groups: DataFrame, group: str, prefix: Column, n_slots, years: Sequence[int],
                seed: int, *, width: int = 3) -> DataFrame:
    """WIN-4 — per group, ``n_slots`` course slots × the given years; a running
    number advancing with every (slot, year) cell formats the code
    (``PREFIX-007``); core flag drawn per cell (``random.choice``).

    The running number is arithmetic — (slot-1)·len(years) + year index + 1 —
    so no window is needed.
    """
    ny = len(years)
    ns = F.lit(n_slots) if not isinstance(n_slots, Column) else n_slots
    g = groups.select(F.col(group), prefix.alias("_prefix"), ns.alias("_slots"))
    g = g.select("*", F.explode(F.sequence(F.lit(1), F.col("_slots"))).alias("slot"))
    g = g.select("*", F.posexplode(F.array(*[F.lit(y) for y in years])).alias("_yi", "offering_year"))
    counter = (F.col("slot") - 1) * ny + F.col("_yi") + 1
    return g.select(
        F.col(group), "slot", "offering_year",
        counter.alias("counter"),
        zero_pad(F.col("_prefix"), counter, width).alias("course_code"),
        (md5_int(F.lit(seed), F.col(group), counter) % 2 == 0).alias("is_core_course"))


def candidate_counts(entities: DataFrame, items: DataFrame, group: str,
                     count_as: str = "n_candidates") -> DataFrame:
    """JOIN-10 — how many same-group items each entity could pick.  Counted
    per group and joined, never by forming the entity × item pairs.  A hot group's
    entities are spread by a hash of the first column."""
    per = items.groupBy(group).agg(F.count(F.lit(1)).alias(count_as))
    return attach_per_group(entities, per, group, entities.columns[0], "left") \
                   .withColumn(count_as, F.coalesce(F.col(count_as), F.lit(0).cast("long")))


__all__ = ["candidate_counts", "expand_grid", "first_claim", "number_within_group",
           "rand_in_range", "sample_per_entity"]
