"""Integrity checks as distributed jobs: SCH-2 (NOT NULL, VARCHAR(n)),
SCH-3 (PRIMARY KEY / UNIQUE), SCH-4 (FOREIGN KEY), and SCH-5 dense surrogate
keys (SERIAL).

Checks return DataFrames (violating rows, or a report
``(table_name, rule, column_name, violations)``); nothing is collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from docrel import schemas
from docrel.session import drop_scratch, ensure_checkpoint_dir, scratch_path


# SCH-2 ------------------------------------------------------------------------
def column_rule_report(table_name: str, df: DataFrame, not_null: Sequence[str] = (),
                       max_length: Mapping[str, int] | None = None) -> DataFrame:
    """Violations of NOT NULL and VARCHAR(n) in one scan of ``df``."""
    max_length = dict(max_length or {})
    aggs, labels = [], []
    for c in not_null:
        aggs.append(F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long"))
        labels.append(("not_null", c))
    for c, n in max_length.items():
        aggs.append(F.sum(F.when(F.length(F.col(c)) > n, 1).otherwise(0)).cast("long"))
        labels.append((f"varchar({n})", c))
    if not aggs:
        raise ValueError("no rule given")
    one = df.agg(*[a.alias(f"_v{i}") for i, a in enumerate(aggs)])
    stack = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("rule"), F.lit(col).alias("column_name"),
                 F.coalesce(F.col(f"_v{i}"), F.lit(0).cast("long")).alias("violations"))
        for i, (rule, col) in enumerate(labels)]))
    return one.select(stack.alias("r")).select(
        F.lit(table_name).alias("table_name"), "r.rule", "r.column_name", "r.violations")


# SCH-3 ------------------------------------------------------------------------
def unique_violations(df: DataFrame, keys: Sequence[str], *,
                      count_as: str = "n_rows") -> DataFrame:
    """Key values held by more than one row, with their row count.

    Rows with a NULL in the key are ignored (SQL UNIQUE); the NOT NULL half of
    a PRIMARY KEY is reported by :func:`column_rule_report`.
    """
    keys = list(keys)
    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    return (df.filter(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as))
            .filter(F.col(count_as) > 1))


def key_violation_counts(df: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Number of violating key values for several key sets of one table in one
    pass: ``(set_index, violations)``, one row per set.

    Several sets are one aggregation over grouping sets (a table's PRIMARY KEY and
    UNIQUE constraints together); ``grouping_id()`` tells the sets apart, and groups
    with a NULL in their key are dropped (UNIQUE ignores them).
    """
    sets = [list(ks) for ks in key_sets]
    given = [" and ".join(f"`{k}` is not null" for k in ks) for ks in sets]
    if len(sets) == 1:  # nothing to expand
        return df.filter(given[0]).groupBy(*sets[0]).count().filter("count > 1") \
                 .selectExpr("0 as set_index", "count(*) as violations")
    cols = sorted({c for ks in sets for c in ks})
    gids = [sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in ks) for ks in sets]
    agg = df.select(*cols).groupingSets(sets, *cols) \
            .agg(F.count(F.lit(1)).alias("_n"), F.grouping_id().alias("_gid"))
    one = agg.filter("_n > 1").selectExpr(
        *[f"count_if(_gid = {gid} and {nn}) as _v{i}" for i, (gid, nn) in enumerate(zip(gids, given))])
    return one.selectExpr(_stacked([str(i) for i in range(len(sets))], "set_index"))


def _stacked(labels: Sequence[str], names: str) -> str:
    """SQL that turns one row ``_v0, _v1, ...`` into a row a value, each after its label (SQL literals)."""
    return f"stack({len(labels)}, {', '.join(f'{x}, _v{i}' for i, x in enumerate(labels))}) as ({names}, violations)"


# SCH-4 ------------------------------------------------------------------------
def fk_violations(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
                  parent_cols: Sequence[str]) -> DataFrame:
    """Child rows whose (all non-NULL) key has no parent row (MATCH SIMPLE).

    An anti join keeps a child row iff no parent matches, so repeated parent
    keys change nothing and are not de-duplicated (no extra shuffle)."""
    child_cols, parent_cols = list(child_cols), list(parent_cols)
    p = parent.select(*[F.col(pc).alias(f"_p{i}") for i, pc in enumerate(parent_cols)])
    nn = F.lit(True)
    cond = F.lit(True)
    for i, cc in enumerate(child_cols):
        nn = nn & child[cc].isNotNull()
        cond = cond & (child[cc] == p[f"_p{i}"])
    return child.filter(nn).join(p, cond, "left_anti")


def _rule_pass(name: str, df: DataFrame, tables: Mapping[str, DataFrame], row_rules: bool = True) -> DataFrame:
    """All per-row rules of a table in one read of it: NOT NULL, VARCHAR(n) and,
    through a left join to each parent's distinct keys, FOREIGN KEY."""
    # the parents' key columns must not shadow those of the table
    labels, flags, rows = [], [], df
    for rule, c, bad in _row_rules(name) if row_rules else []:
        labels.append((rule, c))
        flags.append(bad)
    for i, (ccols, parent, pcols) in enumerate(schemas.FOREIGN_KEYS.get(name, [])):
        if parent not in tables:
            continue
        own = [f"_p{i}_{k}" for k in range(len(pcols))]
        # distinct in one struct, so that the keys are shuffled again for the join (see reshuffled_agg)
        keys = tables[parent].selectExpr(f"struct({', '.join(f'`{p}` as {o}' for p, o in zip(pcols, own))}) as _gk") \
                             .distinct().selectExpr("_gk.*", f"true as _hit{i}")
        rows = rows.join(keys, F.expr(" and ".join(f"`{c}` = {o}" for c, o in zip(ccols, own))), "left")
        labels.append((f"foreign_key:{parent}", ",".join(ccols)))
        flags.append(" and ".join([*(f"`{c}` is not null" for c in ccols), f"_hit{i} is null"]))
    one = rows.selectExpr(*[f"count_if({f}) as _v{i}" for i, f in enumerate(flags)])
    return one.selectExpr(f"'{name}' as table_name", _stacked([f"'{rule}', '{c}'" for rule, c in labels], "rule, column_name"))


def integrity_report(tables: Mapping[str, DataFrame], *, row_rules: bool = True) -> DataFrame:
    """Every declared rule of ``schemas`` over the given relational tables, as
    one report ``(table_name, rule, column_name, violations)``.

    Two passes a table: the per-row rules, and all its key sets in one grouping-sets
    aggregate.  Store derived tables before (``sinks.refresh_all``): each pass reads
    its table, and foreign keys read the parents' keys.  ``row_rules=False`` leaves out
    NOT NULL and VARCHAR, which a write can count itself (:func:`load_checked`).
    """
    parts: list[DataFrame] = []
    for name, df in tables.items():
        if name not in schemas.RELATIONAL:
            continue
        if row_rules or schemas.FOREIGN_KEYS.get(name):
            parts.append(_rule_pass(name, df, tables, row_rules))
        key_sets = ([("primary_key", schemas.PRIMARY_KEYS[name])] if name in schemas.PRIMARY_KEYS else []) \
            + [("unique", u) for u in schemas.UNIQUE_KEYS.get(name, [])]
        if key_sets:
            rules, cols = (", ".join(f"'{x}'" for x in xs) for xs in
                           ([r for r, _ in key_sets], [",".join(k) for _, k in key_sets]))
            parts.append(key_violation_counts(df, [k for _, k in key_sets]).selectExpr(
                f"'{name}' as table_name", f"element_at(array({rules}), set_index + 1) as rule",
                f"element_at(array({cols}), set_index + 1) as column_name", "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# SCH-5 ------------------------------------------------------------------------
_LOCAL_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def assign_ids(df: DataFrame, order_cols: Sequence[str], id_col: str = "id", *,
               start: int = 1, group_cols: Sequence[str] = (),
               num_partitions: int | None = None) -> DataFrame:
    """Dense consecutive ids in ``order_cols`` order (per ``group_cols`` if
    given), like SERIAL on an ordered insert or ``row_number()`` — without a
    single-task window.

    1. range-partition on (groups, order) and sort inside each partition;
    2. tag each row with (partition, position) and checkpoint, which freezes the
       layout (and survives executor loss) — this is the one action;
    3. count rows per (partition, group): at most partitions + groups rows;
    4. running sums of those counts give each (partition, group) its offset;
    5. id = start + offset + position - first position of the group in the partition.

    ``order_cols`` must be a total order (unique), or ties get arbitrary ids.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    g = list(group_cols)
    keys = g + list(order_cols)
    # without an explicit count AQE sizes the range partitions from the data
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions \
        else df.repartitionByRange(*keys)
    tagged = (ranged.sortWithinPartitions(*keys)
              .withColumn("_pos", F.monotonically_increasing_id()))
    frozen = tagged.checkpoint(eager=True)
    frozen = frozen.withColumn("_part", F.shiftright("_pos", _LOCAL_BITS)) \
                   .withColumn("_local", F.col("_pos").bitwiseAND((1 << _LOCAL_BITS) - 1))
    from pyspark.sql import Window
    counts = frozen.groupBy("_part", *g).agg(F.count(F.lit(1)).alias("_cnt"),
                                             F.min("_local").alias("_first"))
    w = Window.partitionBy(*g).orderBy("_part") \
              .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.withColumn("_off", F.sum("_cnt").over(w) - F.col("_cnt")).drop("_cnt")
    # without groups there is one offset a partition: so few that the rows need not move again
    out = frozen.join(offsets if g else F.broadcast(offsets), ["_part", *g])
    out = out.withColumn(id_col, (F.lit(start) + F.col("_off") + F.col("_local") - F.col("_first"))
                         .cast("long"))
    return out.drop("_pos", "_part", "_local", "_off", "_first")


# SCH-2 while loading ------------------------------------------------------------
def _row_rules(name: str) -> list[tuple[str, str, str]]:
    """(rule, column, SQL of whether a row violates it) of a table's rules that need no other row."""
    return [("not_null", c, f"`{c}` is null") for c in schemas.not_null_columns(name)] \
        + [(f"varchar({n})", c, f"length(`{c}`) > {n}") for c, n in schemas.VARCHAR_LIMITS.get(name, {}).items()]


def observed(name: str, df: DataFrame) -> tuple[DataFrame, Observation]:
    """``df`` and an observation that counts its rows and the violations of the table's
    NOT NULL and VARCHAR rules while ``df`` is written: no read of its own."""
    seen = Observation(f"rules_{name}")
    sums = [F.expr(f"count_if({bad})").alias(f"v{i}") for i, (_, _, bad) in enumerate(_row_rules(name))]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *sums), seen


def observed_rows(name: str, seen: Observation) -> list[tuple[str, str, str, int]]:
    """(table_name, rule, column_name, violations) of an observation, after the write."""
    got = seen.get
    return [(name, rule, c, got[f"v{i}"]) for i, (rule, c, _) in enumerate(_row_rules(name))]


def load_checked(tables: Mapping[str, DataFrame], paths: Mapping[str, str], *, max_parallel: int = 4) -> DataFrame:
    """Write relational tables (SNK-1) and report their rules: those of single rows are
    counted by the write itself, keys and references on the stored tables.

    The report has the rows of :func:`integrity_report`.
    """
    from docrel.sources.sinks import refresh_all

    spark = next(iter(tables.values())).sparkSession
    pairs = {k: observed(k, df) for k, df in tables.items()}
    refresh_all({k: df for k, (df, _) in pairs.items()}, dict(paths), max_parallel=max_parallel)
    rows = [r for k, (_, seen) in pairs.items() for r in observed_rows(k, seen)]
    counted = spark.createDataFrame(rows, "table_name string, rule string, column_name string, violations long")
    stored = {k: spark.read.schema(tables[k].schema).parquet(paths[k]) for k in tables}
    return counted.unionByName(integrity_report(stored, row_rules=False))


# SCH-5 over several loads ---------------------------------------------------------
def load_serial(spark: SparkSession, path: str, batch: DataFrame, batch_id: str, keys: Sequence[str],
                order_cols: Sequence[str], id_col: str = "id", *, start: int = 1) -> DataFrame:
    """Give the rows of a batch dense ids that go on where the last load ended, like a
    SERIAL column over later inserts; ``batch`` with ``id_col``.

    The ids are kept in a table of their own at ``path``: (keys, id), a folder
    ``load=<batch_id>`` a batch.  The highest id there is the high-water mark.  A key that
    was loaded before keeps its id, so a replayed batch gets its old ids and leaves no
    gap; a batch that failed half way is replaced by its repetition.  Keys are unique
    in a batch and not NULL; loads of one table follow one another.  The result holds
    the batch's ids apart from the table, so it stays as it is over later loads.
    """
    keys = list(keys)
    fields = ", ".join(f"`{k}` {batch.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{fields}, `{id_col}` long, load string"
    try:
        kept = spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = spark.createDataFrame([], schema)
    known = kept.select(*keys, id_col)
    fresh = batch.select(*dict.fromkeys([*keys, *order_cols])).join(known.select(*keys), keys, "left_anti")
    top = kept.agg(F.max(id_col)).first()[0]
    numbered = assign_ids(fresh, order_cols, id_col, start=start if top is None else top + 1)
    # what this batch holds already stays beside what is new, and replaces its folder
    own = kept.filter(F.col("load") == batch_id).select(*keys, id_col).unionByName(numbered.select(*keys, id_col))
    staged = scratch_path(spark, "ids")
    own.write.mode("overwrite").parquet(staged)
    spark.read.parquet(staged).withColumn("load", F.lit(batch_id)).write.mode("overwrite") \
         .option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(path)
    drop_scratch(spark, staged)
    spark.catalog.refreshByPath(path)
    # Later loads replace files that a plan over the table has listed, and Spark takes all scans of
    # one path as equal, whatever files they list: in a plan over two loads one would stand for both.
    ids = scratch_path(spark, "loaded")
    spark.read.schema(schema).parquet(path).select(*keys, id_col) \
         .join(batch.select(*keys), keys, "left_semi").write.parquet(ids)
    return batch.join(spark.read.schema(f"{fields}, `{id_col}` long").parquet(ids), keys)
