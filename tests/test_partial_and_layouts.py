"""Balanced splits, partial updates, bucketed and Bloom-filtered layouts, posting
bitmaps, documents without a schema, correlated lookups, checks on load and ids over loads."""

import datetime
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docrel.operators import documents, integrity, postings
from docrel.plans import layout, testmap
from docrel.sources import partial, sinks, split, variant
from docrel.streaming import append_absent_batch

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# SRC-2 -------------------------------------------------------------------------
@pytest.mark.parametrize("tie", ["t", None])
def test_every_row_falls_into_one_balanced_part(spark, tie):
    r = random.Random(1)
    rows = [(None if i % 25 == 0 else 7 if i % 3 == 0 else int(r.expovariate(0.001)), None if i % 50 == 3 else i) for i in range(20_000)]
    df = spark.createDataFrame(rows, "k long, t long").repartition(8)
    parts = split.balanced_predicates(df, "k", 16, tie=tie)
    matched = df.select(sum((F.expr(f"CAST(coalesce({p}, false) AS INT)") for p in parts), F.lit(0)).alias("n"),
                        split.part_of(parts).alias("part"), "k")
    assert [x[0] for x in matched.select("n").distinct().collect()] == [1]
    sizes = {x.part: x.n for x in matched.groupBy("part").agg(F.count("*").alias("n")).collect()}
    assert sum(sizes.values()) == len(rows)
    assert matched.filter("k is null").select("part").distinct().collect() == [(len(parts) - 1,)]
    known = [n for p, n in sizes.items() if p != len(parts) - 1]
    if tie:
        assert max(known) < 1.3 * sum(known) / len(known)
    read = split.read_parts(df, parts, "part")
    assert {x.part: x["count"] for x in read.groupBy("part").count().collect()} == sizes


def test_split_edge_cases(spark):
    none = spark.createDataFrame([], "k long, t long")
    assert split.balanced_predicates(none, "k", 4, tie="t") == ["k IS NOT NULL", "k IS NULL"]
    one = spark.createDataFrame([(5, i) for i in range(100)], "k long, t long")
    parts = split.balanced_predicates(one, "k", 4, tie="t")
    got = Counter(x[0] for x in one.select(split.part_of(parts)).collect())
    assert sum(got.values()) == 100 and max(got.values()) <= 35
    days = spark.createDataFrame([(datetime.date(2020, 1, 1) + datetime.timedelta(i),) for i in range(90)], "k date")
    parts = split.balanced_predicates(days, "k", 3)
    assert sorted(Counter(x[0] for x in days.select(split.part_of(parts)).collect()).values()) == [30, 30, 30]
    with pytest.raises(ValueError):
        split.balanced_predicates(days, "k", 0)
    args = split.jdbc_arguments("jdbc:x", "t", parts, user="u", fetchsize=10)
    assert args["predicates"] == parts and args["properties"] == {"user": "u", "fetchsize": "10"}


def test_split_predicates_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    parts = split.balanced_predicates(df, "l_orderkey", 4)
    assert "PushedFilters: [IsNotNull(l_orderkey), GreaterThan(l_orderkey" in plan_of(df.filter(parts[1]))


# SNK-3 in place ------------------------------------------------------------------
def files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(path)
            for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("named", [True, False])
def test_only_touched_partitions_are_rewritten(spark, tmp_path, named):
    path = str(tmp_path / "t")
    rows = [(i, f"v{i}", None if i % 5 == 0 else f"p{i % 5}") for i in range(100)]
    spark.createDataFrame(rows, "_id long, v string, part string").write.partitionBy("part").parquet(path)
    before = files(path)
    ups = [(3, "a", 1, "p3"), (3, "b", 2, "p3"), (10, "n", 1, None), (None, "x", 1, "p1"), (999, "g", 1, "p2")]
    upd = spark.createDataFrame(ups, "_id long, v string, at int, part string")
    upd = upd if named else upd.drop("part")
    for _ in range(2):
        assert partial.update_partitions(spark, path, upd, "_id", ["v"], partition_by="part", order=["at"]) == [None, "p3"]
    want = {(i, {3: "b", 10: "n"}.get(i, v), p) for i, v, p in rows}
    assert set(map(tuple, spark.read.parquet(path).select("_id", "v", "part").collect())) == want
    after = files(path)
    kept = {f: t for f, t in before.items() if "part=p3" not in f and "HIVE" not in f}
    assert len(kept) >= 3 and kept.items() <= after.items()
    assert partial.update_partitions(spark, path, upd.filter("_id = 999"), "_id", ["v"], partition_by="part") == []
    assert files(path) == after
    with pytest.raises(ValueError):
        partial.update_partitions(spark, path, upd, "_id", ["part"], partition_by="part")


# SNK-2 with NULL keys --------------------------------------------------------------
def test_null_keys_are_appended_once(spark, tmp_path):
    target = spark.createDataFrame([(1, "a", "x"), (2, None, "x"), (None, None, "old")], "k long, j string, v string")
    batch = spark.createDataFrame([(None, None, "new"), (2, None, "new"), (2, "b", "new"), (None, "b", "new"), (None, "b", "z"),
                                   (3, "c", "new")], "k long, j string, v string")
    once = sinks.append_if_absent(target, batch, ["k", "j"])
    twice = sinks.append_if_absent(once, batch, ["k", "j"])
    want = Counter([(1, "a", "x"), (2, None, "x"), (None, None, "old"), (2, "b", "new"), (None, "b", "new"), (3, "c", "new")])
    assert Counter(map(tuple, once.collect())) == Counter(map(tuple, twice.collect())) == want
    for part in (None, "j"):
        path = str(tmp_path / f"s{part}")
        w = target.write
        (w.partitionBy(part) if part else w).parquet(path)
        sink = append_absent_batch(path, ["k", "j"], partition_by=part)
        sink(batch, 0)
        sink(batch, 1)
        assert Counter(map(tuple, spark.read.parquet(path).select("k", "j", "v").collect())) == want
    sink = append_absent_batch(str(tmp_path / "fresh"), ["k", "j"])
    sink(batch, 0)
    assert spark.read.parquet(str(tmp_path / "fresh")).count() == 5


def exchanges_above(plan, table):
    """Whether an exchange or sort stands over the scan of a table, by indentation."""
    lines = plan.split("\n")
    at = next(i for i, x in enumerate(lines) if "Scan" in x and table in x)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-*()0123456789"))
    over, i = [], at
    while i:
        i -= 1
        d = len(lines[i]) - len(lines[i].lstrip(" :+-*()0123456789"))
        if d < depth:
            over.append(lines[i])
            depth = d
            if "Join" in lines[i]:
                break
    return [x for x in over if "Exchange" in x]


def test_bucketed_target_is_not_shuffled(spark):
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = spark.range(0, 5000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.col("id").cast("string").alias("v"))
    layout.bucket_table(target, "bucket_target", n, ["k"], ["k"])
    batch = spark.range(4000, 6000).select(F.when(F.col("id") < 5990, F.col("id")).alias("k"), F.lit("new").alias("v"))
    fresh = partial.absent_rows(spark.table("bucket_target"), batch.hint("merge"), ["k"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(partial.absent_rows(spark.table("bucket_target"), batch, ["k"]))
        assert "SortMergeJoin" in plan and not exchanges_above(plan, "bucket_target")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert fresh.count() == 990
    for _ in range(2):
        partial.append_to_bucketed(spark, "bucket_target", batch, ["k"], n_buckets=n, sort_by=["k"])
        got = spark.table("bucket_target")
        assert got.count() == 5990 and got.filter("k is null").count() == 1


def test_colocated_join_has_no_exchange(spark):
    for name, rows in (("co_a", spark.range(1000).withColumnRenamed("id", "k")),
                       ("co_b", spark.range(5000).select((F.col("id") % 700).alias("k"), "id"))):
        layout.bucket_table(rows, name, 8, ["k"], ["k"])
    j = layout.colocated_join(spark.table("co_a"), spark.table("co_b"), ["k"]).groupBy("k").count()
    plan = plan_of(j)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert j.count() == 700 and j.agg(F.sum("count")).first()[0] == 5000


# PHY-5 point lookup ------------------------------------------------------------------
def scanned_rows(df):
    """Rows that the scan of an executed plan gave on after skipping row groups."""
    df.collect()
    def walk(node):
        name = node.nodeName()
        if "Scan" in name and node.metrics().contains("numOutputRows"):
            yield node.metrics().apply("numOutputRows").value()
        kids = node.children()
        for i in range(kids.size()):
            yield from walk(kids.apply(i))
        if hasattr(node, "executedPlan") and "AdaptiveSparkPlan" in name:
            yield from walk(node.executedPlan())
    return sum(walk(df._jdf.queryExecution().executedPlan()))


def test_bloom_filters_skip_row_groups(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 8).select(F.col("id"), (F.col("id") % 5).alias("dept"),
                                               F.concat(F.md5(F.col("id").cast("string")), F.lit("@x")).alias("mail"))
    paths = {}
    for bloom in (True, False):
        paths[bloom] = layout.write_layout(rows, str(tmp_path / f"b{bloom}"), cluster_by=["dept", "id"], num_files=8,
                                           bloom_on={"mail": 5000} if bloom else None)
    mail = rows.filter("id = 12345").first().mail
    found = {b: spark.read.parquet(p).filter(F.col("mail") == mail) for b, p in paths.items()}
    assert [r.id for b in found for r in found[b].collect()] == [12345, 12345]
    read = {b: scanned_rows(df) for b, df in found.items()}
    assert read[True] <= 10_000 and read[False] >= 35_000, read
    gone = spark.read.parquet(paths[True]).filter(F.col("mail") == "0" * 32 + "@x")
    assert scanned_rows(gone) <= 5_100


# PHY-6 -----------------------------------------------------------------------------
def test_posting_bitmaps_against_sets(spark):
    r = random.Random(2)
    owners = [0, 1, -1, 32_767, 32_768, 32_769, -32_767, -32_768, -32_769, 65_536, 10 ** 12] + [r.randrange(-10 ** 6, 10 ** 6) for _ in range(300)]
    edges = [(r.choice(owners), r.choice("abcd")) for _ in range(3000)] + [(o, "a") for o in owners] + [(None, "a"), (1, None)]
    df = spark.createDataFrame(edges, "s long, c string").repartition(4)
    by = {c: {s for s, x in edges if x == c and s is not None} for c in "abcdz"}
    p = postings.posting_bitmaps(df, "s", "c")
    for items in (["a"], ["a", "b"], ["b", "c", "d", "b"], ["a", "z"], ["z"], []):
        both = set.intersection(*(by[i] for i in items)) if items else set()
        some = set().union(*(by[i] for i in items))
        for sets, want in ((postings.all_of(p, items), both), (postings.any_of(p, items), some)):
            got = [x[0] for x in postings.members(sets).collect()]
            assert len(got) == len(set(got)) and set(got) == want
            assert postings.member_count(sets).first()[0] == len(want)


# SRC-1 as VARIANT --------------------------------------------------------------------
def test_states_of_drifting_fields(spark, tmp_path):
    lines = ['{"_id": 1, "student_name": "A", "enrolled_courses": [1, 2]}', '{"_id": 2, "enrolled_courses": null}',
             '{"_id": 3, "enrolled_courses": []}', '{"_id": 4}', '{"_id": "5", "department_id": "x", "enrolled_courses": {"a": 1}}',
             '{"_id": 6, "enrolled_courses": 7}', '{"_id": ', '[]', '{"_id": 8, "enrolled_courses": [null]}']
    path = str(tmp_path / "docs")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    docs = variant.read_documents(spark, path)
    state = {r.line: r.s for r in docs.select("line", variant.field_state("doc", "$.enrolled_courses").alias("s")).collect()}
    assert [state[x] for x in lines] == ["array", "null", "empty_array", "missing", "object", "scalar", "malformed", "missing", "array"]
    assert set(state.values()) <= set(variant.STATES)
    students, enrolled = variant.student_documents(docs)
    assert {(r._id, r.student_name) for r in students.collect() if r._id} == {(1, "A"), *((i, None) for i in (2, 3, 4, 5, 6, 8))}
    assert {(r._id, tuple(r.enrolled_courses)) for r in enrolled.collect()} == {(1, (1, 2)), (3, ()), (8, (None,))}
    assert "department_id: STRING" in variant.merged_schema(docs.filter("doc is not null and line <> '[]'"))


# JOIN-8 with let -----------------------------------------------------------------------
def test_correlated_lookup_against_brute_force(spark):
    r = random.Random(4)
    left = [(i, r.choice([1, 2, 3, None]), r.choice(["x", "y", None])) for i in range(40)]
    right = [(100 + i, r.choice([1, 2, 3, None]), r.choice(["x", "y", None]), r.randrange(5)) for i in range(200)]
    a, b = spark.createDataFrame(left, "_id long, g long, d string"), spark.createDataFrame(right, "_id long, f long, d string, y int")
    out = documents.lookup_correlated(a, b, "_id", "g", "f", "best", let={"d": "d"},
                                      where=F.col("d") == F.col("_let_d"), order=[F.col("y").desc(), F.col("_id").asc()], k=3)
    got = {x._id: [(d._id, d.y) for d in x.best] for x in out.collect()}
    want = {i: [(x[0], x[3]) for x in sorted((x for x in right if g is not None and x[1] == g and d is not None and x[2] == d),
                                             key=lambda x: (-x[3], x[0]))[:3]] for i, g, d in left}
    assert got == want and any(not v for v in want.values())
    assert "WindowGroupLimit" in plan_of(out)


# SCH while loading, SERIAL ---------------------------------------------------------------
def test_load_counts_what_the_report_counts(spark, tmp_path):
    rel = testmap.relational(testmap.load(spark, SF))
    rel["students"] = rel["students"].withColumn("student_email", F.when(F.col("student_id") % 7 > 0, F.repeat("student_email", 12)))
    rel["teaches"] = rel["teaches"].withColumn("instructor_id", F.col("instructor_id") + 5)
    paths = {k: str(tmp_path / k) for k in rel}
    got = integrity.load_checked(rel, paths).collect()
    want = integrity.integrity_report({k: spark.read.parquet(p) for k, p in paths.items()}).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, want))
    by = {(x.table_name, x.rule, x.column_name): x.violations for x in got}
    assert by["students", "not_null", "student_email"] > 0 and by["students", "varchar(100)", "student_email"] > 0


def test_serial_goes_on_over_loads_and_replays(spark, tmp_path):
    path = str(tmp_path / "ids")
    rows = [(f"k{i}", i) for i in range(90)]
    batches = [rows[:30], rows[30:31], rows[31:90]]
    frame = lambda b: spark.createDataFrame(b, "k string, o long")
    seen = {}
    for i in (0, 1, 0, 2, 1, 2):
        got = {r.k: r.id for r in integrity.load_serial(spark, path, frame(batches[i]), f"b{i}", ["k"], ["o"]).collect()}
        assert len(got) == len(batches[i]) and all(seen.get(k, v) == v for k, v in got.items())
        seen |= got
    assert seen == {k: i + 1 for k, i in rows}
    more = integrity.load_serial(spark, path, frame([("k5", 0), ("new", 1)]), "b3", ["k"], ["o"])
    assert {r.k: r.id for r in more.collect()} == {"k5": 6, "new": 91}
    assert integrity.load_serial(spark, path, frame([]), "b4", ["k"], ["o"]).collect() == []


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_serial_results_stay_over_later_loads(spark, tmp_path, broadcast):
    path = str(tmp_path / "ids")
    frame = lambda b: spark.createDataFrame(b, "k string, o long")
    rows = [(f"k{i}", i) for i in range(60)]
    batches = {"a": rows[:20], "b": [rows[3], *rows[20:40]], "c": rows[40:]}
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        held = [(x, integrity.load_serial(spark, path, frame(batches[x]), x, ["k"], ["o"])) for x in "abacb"]
        for x, df in held:  # read only now, after "a" and "b" were loaded again
            assert sorted((r.k, r.id) for r in df.collect()) == sorted((k, o + 1) for k, o in batches[x])
        together = held[2][1].unionByName(held[1][1]).unionByName(held[3][1])
        assert Counter((r.k, r.id) for r in together.collect()) == Counter((k, o + 1) for x in "abc" for k, o in batches[x])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_scalars_are_checked_once_a_student(spark):
    from docrel.plans import registry
    got = {(r.table_name, r.rule, r.column_name): r.violations for r in registry.sch_2_notnull(spark, SF).collect()}
    n = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert got["students", "varchar(10)", "student_email"] <= 2 * n
