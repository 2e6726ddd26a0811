"""Fast forms against naive forms on the driver's sf0.001/sf0.01 tables,
compared as multisets with ``exceptAll`` both ways."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from docrel.functions.arrays import md5_int
from docrel.operators import division, grouping, integrity, membership, sampling
from docrel.plans import testmap

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def cols(spark):
    return testmap.collections(spark, SF)


def test_membership_join_equals_theta_join(cols):
    c = cols["courses"].select("_id", "course_code")
    s = cols["enrolled"].withColumnRenamed("_id", "sid")
    theta = c.join(s, F.array_contains(s["enrolled_courses"], c["_id"]))  # the literal nested loop
    same(membership.membership_join(c, s, "_id", "enrolled_courses").select("_id", "sid"),
         theta.select("_id", "sid"))
    left = membership.membership_join(testmap.with_unused(c, "_id"), s, "_id", "enrolled_courses", how="left")
    assert left.columns == ["_id", "course_code", "sid", "_chunk"]
    same(left.filter("sid is not null").select("_id", "sid"), theta.select("_id", "sid"))
    assert left.filter("sid is null").count() >= c.count()


def test_division_count_equals_containment(spark):
    cols = testmap.collections(spark, SF2)
    c = cols["courses"]
    core = c.filter(F.col("is_core_course")).select("department_id", F.col("_id").alias("course_id"))
    taught = c.filter(F.col("instructor_id").isNotNull()) \
              .select("department_id", "instructor_id", F.col("_id").alias("course_id"))
    same(division.divide(taught, core, "instructor_id", "course_id", group="department_id"),
         division.divide_by_containment(taught, core, "instructor_id", "course_id", group="department_id"))


def test_first_per_key_equals_row_number(spark):
    o = testmap.load(spark, SF2)["orders"].select("o_custkey", "o_orderkey", "o_orderdate")
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    slow = o.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    same(grouping.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]), slow)


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_assign_ids_equals_row_number(spark, parts):
    o = testmap.load(spark, SF2)["orders"].select("o_orderkey", "o_orderdate", "o_custkey")
    fast = integrity.assign_ids(o, ["o_orderdate", "o_orderkey"], "id", num_partitions=parts)
    slow = o.withColumn("id", F.row_number().over(Window.orderBy("o_orderdate", "o_orderkey")).cast("long"))
    same(fast.select("o_orderkey", "id"), slow.select("o_orderkey", "id"))
    g = integrity.assign_ids(o, ["o_orderkey"], "gid", start=0, group_cols=["o_custkey"],
                             num_partitions=parts)
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    gs = o.withColumn("gid", (F.row_number().over(w) - 1).cast("long"))
    same(g.select("o_orderkey", "gid"), gs.select("o_orderkey", "gid"))


def test_top_k_with_ties_equals_rank(cols):
    cnt = membership.membership_counts(cols["enrolled"], "_id", "enrolled_courses",
                                       item_as="course_id", count_as="n")
    fast = grouping.top_k_with_ties(cnt, "n", 5)
    slow = cnt.withColumn("rk", F.rank().over(Window.orderBy(F.col("n").desc()))) \
              .filter("rk <= 5").drop("rk")
    same(fast, slow)


def test_sample_properties(spark, cols):
    ents = cols["students"].select(F.col("_id").alias("sid"), "department_id")
    items = cols["courses"].select("department_id", F.col("_id").alias("cid"))
    k = 4
    out = sampling.sample_per_entity(ents, items, "sid", "department_id", "cid", k, seed=7)
    # without replacement, from the entity's own group, min(k, m) items each
    assert out.count() == out.distinct().count()
    j = out.join(ents, "sid").join(items, ["department_id", "cid"], "left_anti")
    assert j.count() == 0
    m = items.groupBy("department_id").agg(F.count(F.lit(1)).alias("m"))
    per = out.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))
    chk = ents.join(m, "department_id").join(per, "sid", "left") \
              .filter(F.coalesce("n", F.lit(0)) != F.least(F.lit(k), F.col("m")))
    assert chk.count() == 0
    # repeatable
    again = sampling.sample_per_entity(ents, items, "sid", "department_id", "cid", k, seed=7)
    same(out, again)


def test_sample_whole_group_when_small(spark):
    ents = spark.createDataFrame([(1, "g"), (2, "g"), (3, "h")], "e long, g string")
    items = spark.createDataFrame([("g", 10), ("g", 11), ("h", 12)], "g string, i long")
    out = sampling.sample_per_entity(ents, items, "e", "g", "i", 5, seed=1)
    assert sorted(tuple(r) for r in out.collect()) == [(1, 10), (1, 11), (2, 10), (2, 11), (3, 12)]


def test_md5_int_range(spark):
    v = spark.range(1000).select(md5_int(F.lit(1), "id").alias("h"))
    lo, hi = v.agg(F.min("h"), F.max("h")).first()
    assert 0 <= lo and hi < 2 ** 32


def test_bucketed_collections_answer_the_same(spark):
    from docrel.plans import queries as Q
    plain = testmap.collections(spark, SF)
    small = testmap.collections(spark, SF, 2)
    assert small["enrolled"].count() > plain["enrolled"].count()  # some arrays split
    same(small["students"], plain["students"])
    for f in (lambda c: Q.q1_students_in_course(c, 15), lambda c: Q.q2_mean_enrolment(c, 2),
              Q.q4_students_per_department, lambda c: Q.q6_top_courses(c, 25), Q.enrollment_edges):
        same(f(small), f(plain))
    inline = dict(plain, students=plain["students"].join(plain["enrolled"].drop("_chunk"), "_id", "left"))
    del inline["enrolled"]
    same(Q.q6_top_courses(inline, 25), Q.q6_top_courses(plain, 25))


def test_hot_parent_is_split_into_bounded_chunks(spark):
    from docrel.operators.documents import embed
    parent = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    rows = [(1, v) for v in range(1000)] + [(1, 7)] * 5 + [(2, 5), (2, 5)]
    child = spark.createDataFrame(rows, "k long, v long")
    out = embed(parent, child, "k", "k", "v", "arr", max_len=100).collect()
    hot = [r for r in out if r["k"] == 1]
    assert len(hot) >= 8 and max(len(r["arr"]) for r in hot) < 250
    flat = sorted(v for r in hot for v in r["arr"])
    assert flat == sorted(v for k, v in rows if k == 1)          # nothing lost or added
    assert sum(7 in r["arr"] for r in hot) == 1                  # repeats share a chunk
    assert sorted((r["k"], r["_chunk"], r["arr"]) for r in out if r["k"] != 1) == [(2, 0, [5, 5])]


def test_dense_ids_do_not_move_the_rows_again(spark):
    """One offset a partition is broadcast to the frozen rows, whatever the size threshold."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ids = integrity.assign_ids(spark.range(1000).select(F.xxhash64("id").alias("x")), ["x"], "id", num_partitions=5)
        plan = ids._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(r.id for r in ids.collect()) == list(range(1, 1001))
