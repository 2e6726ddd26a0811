"""Connected components of a distributed edge list.

Alternates the large-star and small-star steps of Kiveris et al., "Connected
Components in MapReduce and Beyond" (2014): every step is one map-side combined
minimum per node and one join, so no neighbourhood is ever gathered in a task.
The joins read stored or re-shuffled inputs, which lets AQE split a hub's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.llm.common import stored
from docrel.operators.grouping import reshuffled_agg


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = reshuffled_agg(both, "u", F.min(F.least("u", "v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
               .distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges have u > v."""
    least = reshuffled_agg(edges, "u", F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v) but the roots themselves.

    ``root`` is the smallest node of the component.  Loops are ignored; an empty
    edge list gives no rows.
    """
    now = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"),
                                               F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or seen == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = seen
        now = stored(_small_star(stored(_large_star(now), "large")), "edges")
