"""Mixing overlapping sources to target weights by min-cost flow.

A document may belong to several sources; its membership pattern is the set of
them.  The mix is planned on patterns and then carried out on documents:

1. one aggregate gives the size of every pattern and of every source;
2. each source gets a target: its share of the mix by weight, stopped at
   ``max_copies`` times its size, the excess reshared by weight;
3. a flow routes the tokens of patterns to the quotas of their sources.  A
   pattern's first pass is free and each further pass costs one more (convex),
   so repetition is used last and spread over the patterns that allow it;
4. inside a pattern, documents take whole passes; a seeded order decides which
   of them take one pass more.  The cut in that order is found by histograms of
   the order's leading digits, never by sorting a pattern.

The plan has a row per pattern, not per document: it is the catalogue of source
combinations, at most ``MAX_PATTERNS`` rows, which the driver solves.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docrel.llm.common import WORD, fresh, stored, text_of

#: Share of all sizes that the mix holds, and passes over a document at most.
SHARE = 1.5
MAX_COPIES = 2
SEED = "mix-1"
MAX_PATTERNS = 100_000
#: Digits of the seeded order that one histogram resolves (in base 16).
DIGITS = 2


def cycle_weights(weights: Sequence[float] = (5.0, 2.0, 1.0)) -> Callable[[list], dict]:
    """Weights repeating over the sources by code point, null last."""
    def of(sources: list) -> dict:
        ranked = sorted(sources, key=lambda s: (s is None, s or ""))
        return {s: weights[i % len(weights)] for i, s in enumerate(ranked)}
    return of


def targets(sizes: dict, weights: dict, total: float, max_copies: int = MAX_COPIES) -> dict:
    """Share ``total`` by weight; what a source cannot hold is reshared."""
    out, open_ = {}, sorted(sizes, key=lambda s: (s is None, s or ""))
    left = float(total)
    while open_:
        weight = sum(weights[s] for s in open_)
        full = [s for s in open_ if left * weights[s] / weight > max_copies * sizes[s]]
        if not full:
            out |= {s: left * weights[s] / weight for s in open_}
            break
        for s in full:
            out[s] = float(max_copies * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def route(patterns: list[tuple[tuple, int]], quotas: dict,
          max_copies: int = MAX_COPIES) -> list[int]:
    """Tokens that each pattern (its sources, its size) gives, by min-cost flow.

    Every pattern can give ``max_copies`` passes; pass k costs k - 1 a token.
    Flow is sent along cheapest augmenting paths until the quotas are met or no
    path is left.
    """
    sources = sorted(quotas, key=lambda s: (s is None, s or ""))
    at = {s: 2 + len(patterns) + i for i, s in enumerate(sources)}
    graph: list[list[list]] = [[] for _ in range(2 + len(patterns) + len(sources))]

    def edge(a: int, b: int, room: int, price: int) -> None:
        graph[a].append([b, room, price, len(graph[b])])
        graph[b].append([a, 0, -price, len(graph[a]) - 1])

    for p, (members, size) in enumerate(patterns):
        for k in range(max_copies):
            edge(0, 2 + p, size, k)
        for s in members:
            edge(2 + p, at[s], max_copies * size, 0)
    for s in sources:
        edge(at[s], 1, int(round(quotas[s])), 0)
    height = [0] * len(graph)
    while True:
        dist, back = [float("inf")] * len(graph), [None] * len(graph)
        dist[0], queue = 0, [(0, 0)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > dist[a]:
                continue
            for i, (b, room, price, _) in enumerate(graph[a]):
                far = d + price + height[a] - height[b]
                if room > 0 and far < dist[b]:
                    dist[b], back[b] = far, (a, i)
                    heapq.heappush(queue, (far, b))
        if back[1] is None:
            break
        height = [h + min(d, dist[1]) for h, d in zip(height, dist)]
        path, b = [], 1
        while b:
            a, i = back[b]
            path.append(graph[a][i])
            b = a
        sent = min(e[1] for e in path)
        for e in path:
            e[1] -= sent
            graph[e[0]][e[3]][1] += sent
    given = [0] * len(patterns)
    for b, room, _, back_at in graph[0]:
        given[b - 2] += graph[b][back_at][1]
    return given


def _key(*cols: Column) -> Column:
    """The seeded order: 15 hex digits."""
    return F.substring(F.md5(F.concat_ws("|", *cols)), 1, 15)


def mixed(df: DataFrame, sources: Column, weights: Callable[[list], dict] | None = None, *,
          id_col: str = "doc_id", text_col: str = "text", share: float = SHARE,
          max_copies: int = MAX_COPIES, seed: str = SEED) -> tuple[DataFrame, dict, dict]:
    """Plan of a mix: (rows, sizes, targets).

    ``sources`` is an array column of the sources of a document (null: the one
    source null).  ``rows`` holds for each row of ``df``: id, tie (a hash of its
    text), pattern (array of sources), size (words of the whole text; null: 0)
    and taken.  Sizes and targets are by source; a document of several sources
    counts in the size of each.  Documents without words take nothing.  Rows with
    the same id and text are taken or left together.  Empty table: no rows and
    empty plans.  Reruns agree.
    """
    weights = weights or cycle_weights()
    pattern = F.array_sort(F.array_distinct(F.coalesce(sources, F.array(F.lit(None).cast("string")))))
    body = text_of(text_col)
    tie = F.xxhash64(body)
    rows = stored(df.select(
        F.col(id_col).alias("id"), tie.alias("tie"), pattern.alias("pattern"),
        F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
        _key(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")),
             F.md5(F.encode(body, "UTF-8"))).alias("key")), "sizes")
    # the plan's rows: one for each combination of sources
    plan = rows.groupBy("pattern").agg(F.sum("size").alias("size")).limit(MAX_PATTERNS + 1).collect()
    if len(plan) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} combinations of sources")
    patterns = sorted(((tuple(p["pattern"]), p["size"]) for p in plan),
                      key=lambda p: [(s is None, s or "") for s in p[0]])
    sizes: dict = {}
    for members, size in patterns:
        for s in members:
            sizes[s] = sizes.get(s, 0) + size
    total = sum(size for _, size in patterns)
    quotas = targets(sizes, weights(list(sizes)), share * total, max_copies)
    given = route(patterns, quotas, max_copies)
    return _selected(rows, [(m, n, g) for (m, n), g in zip(patterns, given)]), sizes, quotas


def _selected(rows: DataFrame, plan: list[tuple[tuple, int, int]]) -> DataFrame:
    """Attach ``taken``: whole passes for all, one more up to a cut in the seeded order."""
    spark = rows.sparkSession
    full = {m: (g // n if n else 0) for m, n, g in plan}
    need = {m: (g % n if n else 0) for m, n, g in plan}
    # a prefix before or after all keys where there is no cut to look for
    prefix = {m: "" if need[m] else "!" for m in need}
    schema = "pattern array<string>, passes long, need long, prefix string"

    def with_plan() -> DataFrame:
        plan_rows = spark.createDataFrame([(list(m), full[m], need[m], prefix[m]) for m in full], schema)
        return rows.alias("a").join(F.broadcast(plan_rows).alias("b"),
                                    F.col("a.pattern").eqNullSafe(F.col("b.pattern"))) \
                   .select("a.*", "passes", "need", "prefix")

    if not plan:
        return rows.select("id", "tie", "pattern", "size", F.lit(0).cast("long").alias("taken"))
    up_to = Window.partitionBy("pattern").orderBy("bin")
    for level in (1, 2):  # histograms of 16 ** DIGITS bins a pattern narrow the cut down
        bins = with_plan().filter(F.col("key").startswith(F.col("prefix"))) \
            .groupBy("pattern", "need", F.substring("key", 1, DIGITS * level).alias("bin")) \
            .agg(F.sum("size").alias("size"))
        cuts = bins.withColumn("sum", F.sum("size").over(up_to)).filter("sum > need") \
                   .groupBy("pattern").agg(F.min("bin").alias("bin"),
                                           F.min(F.col("sum")).alias("sum"),
                                           F.min_by("size", "bin").alias("size"))
        for x in cuts.collect():  # a row for each pattern of the plan
            m = tuple(x["pattern"])
            prefix[m] = x["bin"]
            need[m] -= x["sum"] - x["size"]
    now = with_plan()
    on_cut = F.col("key").startswith(F.col("prefix"))
    below = F.when(F.col("key") < F.col("prefix"), F.col("size")).otherwise(F.lit(0))
    # what shares the digits of the cut: 1 / 16 ** (2 * DIGITS) of a pattern
    order = Window.partitionBy("pattern").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    last = now.filter(on_cut).withColumn("sum", F.sum("size").over(order))
    # the document on the cut is taken if that brings the pattern nearer to its tokens
    more = F.when(2 * F.col("sum") - F.col("size") <= 2 * F.col("need"), F.col("size")).otherwise(F.lit(0))
    cols = ["id", "tie", "pattern", "size"]
    taken = lambda extra: (F.col("passes") * F.col("size") + extra).cast("long").alias("taken")
    return now.filter(~on_cut).select(*cols, taken(below)) \
              .unionByName(last.select(*cols, taken(more)))


def report(df: DataFrame, source_col: str = "source", id_col: str = "doc_id",
           text_col: str = "text", **kw) -> DataFrame:
    """id, size, source_size, target and taken of every row of a table whose
    documents each have one source (null is a source of its own)."""
    rows, sizes, quotas = mixed(df, F.array(F.col(source_col).cast("string")), id_col=id_col,
                                text_col=text_col, **kw)
    plan = df.sparkSession.createDataFrame([([s], sizes[s], quotas[s]) for s in sizes],
                                           "pattern array<string>, source_size long, target double")
    out = rows.alias("a").join(F.broadcast(plan).alias("b"),
                               F.col("a.pattern").eqNullSafe(F.col("b.pattern")))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken")


def applied(df: DataFrame, source_col: str = "source", id_col: str = "doc_id",
            text_col: str = "text", **kw) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken, all its columns."""
    rows, _, _ = mixed(df, F.array(F.col(source_col).cast("string")), id_col=id_col,
                       text_col=text_col, **kw)
    # rows with the same id and text are in one pattern or are told apart by it
    own_id, own_tie, own_source, n = (fresh(df, c) for c in ("mix_id", "mix_tie", "mix_source", "mix_times"))
    times = rows.filter("taken > 0").select(
        F.col("id").alias(own_id), F.col("tie").alias(own_tie), F.col("pattern")[0].alias(own_source),
        F.expr("taken div size").alias(n)).distinct()
    tie, copy = fresh(df, "mix_text"), fresh(df, "mix_copy")
    left = df.withColumn(tie, F.xxhash64(text_of(text_col)))
    joined = left.join(times, F.col(id_col).eqNullSafe(F.col(own_id)) & (F.col(tie) == F.col(own_tie))
                       & F.col(source_col).cast("string").eqNullSafe(F.col(own_source)))
    return joined.select(*[F.col(f"`{c}`") for c in df.columns],
                         F.explode(F.sequence(F.lit(1), F.col(n).cast("int"))).alias(copy)) \
                 .drop(copy)
