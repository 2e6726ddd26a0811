"""Plan shape assertions and sink idempotence."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from docrel import schemas
from docrel.operators import grouping, membership
from docrel.plans import layout, queries as Q, testmap
from docrel.session import scratch_path
from docrel.sources import io, sinks

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def cols(spark):
    return testmap.collections(spark, SF)


def test_membership_paths_have_no_nested_loop(cols):
    for df in (Q.q6_top_courses(cols), Q.q2_mean_enrolment(cols, 2),
               membership.membership_join(cols["courses"], cols["enrolled"].withColumnRenamed("_id", "sid"), "_id",
                                          "enrolled_courses")):
        p = plan(df)
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_top_k_is_take_ordered(cols):
    p = plan(Q.q6_top_courses(cols))
    assert "TakeOrderedAndProject" in p


def test_top_k_per_group_limits_before_shuffle(cols):
    cnt = membership.membership_counts(cols["enrolled"], "_id", "enrolled_courses",
                                       item_as="course_id", count_as="n")
    df = grouping.top_k_per_group(cnt.withColumn("g", F.col("course_id") % 7), "g",
                                  F.col("n").desc(), 2, F.col("course_id"))
    p = plan(df)
    assert "WindowGroupLimit" in p and "Partial" in p


def test_counts_are_partial_aggregates(cols):
    p = plan(membership.membership_counts(cols["enrolled"], "_id", "enrolled_courses"))
    assert "partial_count" in p


def test_inverted_index_pushes_equality(spark, cols):
    path = scratch_path(spark, "idx")
    layout.write_inverted_index(cols["enrolled"], "_id", "enrolled_courses", path,
                                item_as="course_id", owner_as="student_id")
    df = layout.index_lookup(spark, path, 15, item_as="course_id", owner_as="student_id")
    assert "EqualTo(course_id,15)" in plan(df)
    slow = membership.membership_filter(cols["enrolled"], "enrolled_courses", 15).select("_id")
    assert sorted(r[0] for r in df.collect()) == sorted(r[0] for r in slow.collect())


def test_partitioned_layout_prunes(spark, cols):
    path = scratch_path(spark, "by_dept")
    layout.write_layout(cols["courses"], path, partition_by=["department_id"], cluster_by=["_id"])
    df = spark.read.parquet(path).filter(F.col("department_id") == 1)
    assert "PartitionFilters: [isnotnull(department_id" in df._jdf.queryExecution().executedPlan().toString() \
        or "department_id" in plan(df)
    assert df.count() == cols["courses"].filter("department_id = 1").count()


def _table(df):
    return sorted(tuple(r) for r in df.collect())


def test_refresh_is_idempotent(spark, cols):
    path = scratch_path(spark, "c")
    sinks.refresh(cols["courses"], path)
    first = _table(io.read_collection(spark, path, schema=schemas.COURSE_DOCS))
    sinks.refresh(cols["courses"], path)
    assert _table(io.read_collection(spark, path, schema=schemas.COURSE_DOCS)) == first


def test_append_if_absent_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "z"), (3, "c"), (3, "c")], "k long, v string")
    once = sinks.append_if_absent(target, batch, ["k"])
    assert _table(once) == [(1, "a"), (2, "b"), (3, "c")]
    assert _table(sinks.append_if_absent(once, batch, ["k"])) == _table(once)


def test_set_fields_is_idempotent_and_no_upsert(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k long, v string, w long")
    upd = spark.createDataFrame([(2, "B"), (9, "ghost")], "k long, v string")
    once = sinks.set_fields(target, upd, "k", ["v"])
    assert _table(once) == [(1, "a", 10), (2, "B", 20)]
    assert _table(sinks.set_fields(once, upd, "k", ["v"])) == _table(once)


def test_csv_round_trip(spark, cols):
    path = scratch_path(spark, "csv")
    sinks.write_csv(cols["courses"], path)
    back = sinks.read_csv(spark, path, schemas.COURSE_DOCS)
    assert _table(back) == _table(cols["courses"])


def test_json_collection_keeps_nulls_and_arrays(spark, cols):
    path = scratch_path(spark, "json")
    rows = cols["students"].join(cols["enrolled"].drop("_chunk"), "_id", "left") \
        .unionByName(cols["students"].limit(3).withColumn("enrolled_courses", F.lit(None).cast("array<long>")))
    sinks.refresh(rows, path, fmt="json")
    back = io.read_collection(spark, path, fmt="json", schema=schemas.STUDENT_DOCS_INLINE)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))


def test_keyed_split_options():
    o = io.keyed_split_options("id", 0, 100, 4)
    assert o == {"partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    with pytest.raises(ValueError):
        io.keyed_split_options("id", 5, 1, 4)


def test_set_fields_reduces_duplicate_updates(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    upd = spark.createDataFrame([(2, "z", 2), (2, "y", 1)], "k long, v string, ts long")
    out = sinks.set_fields(target, upd, "k", ["v"], order=["ts"])
    assert _table(out) == [(1, "a"), (2, "z")]           # as successive updates: the last one
    with pytest.raises(Exception, match="several updates without an order for key 2"):
        sinks.set_fields(target, upd, "k", ["v"]).collect()


def test_cached_releases(spark):
    df = spark.range(10)
    with layout.cached(df) as c:
        assert c.is_cached and c.count() == 10
    assert not df.is_cached


def test_bucketed_tables_join_without_shuffle(spark, cols):
    s = cols["students"].select("_id", "department_id")
    e = membership.membership_edges(cols["enrolled"], "_id", "enrolled_courses",
                                    owner_as="_id", item_as="course_id")
    layout.bucket_table(s, "b_students", 4, ["_id"], ["_id"])
    layout.bucket_table(e, "b_edges", 4, ["_id"], ["_id"])
    j = spark.table("b_students").join(spark.table("b_edges"), "_id")
    old_threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p and "Exchange" not in p
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old_threshold)
    assert j.count() == e.count()


def test_micro_batch_append_survives_replay(spark):
    from docrel.streaming import append_absent_batch
    target = scratch_path(spark, "stream_t")
    sink = append_absent_batch(target, ["k"])
    b1 = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k long, v string")
    b2 = spark.createDataFrame([(2, "z"), (3, "d")], "k long, v string")
    sink(b1, 0)
    sink(b1, 0)          # the same epoch replayed after a failure
    sink(b2, 1)
    assert _table(spark.read.parquet(target)) == [(1, "a"), (2, "b"), (3, "d")]


def test_refresh_all_writes_every_table(spark, cols):
    paths = {k: scratch_path(spark, k) for k in cols}
    sinks.refresh_all(cols, paths)
    for k, df in cols.items():
        assert _table(spark.read.parquet(paths[k])) == _table(df)


def test_q2_is_lazy_and_counts_first(spark, cols):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("q2", "q2")
    df = Q.q2_mean_enrolment(cols, 2)
    assert tracker.getJobIdsForGroup("q2") == []
    p = plan(df)
    # the per-course partial count sits below the semi join
    assert p.index("LeftSemi") < p.index("partial_count")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_student_scalars_need_no_enrolments(cols):
    for df in (Q.q4_students_per_department(cols), cols["students"]):
        assert "lineitem" not in plan(df) and "l_partkey" not in plan(df)


def test_csv_keeps_odd_strings(spark):
    rows = [(1, "a\nb"), (2, ""), (3, None), (4, 'x"y,z'), (5, " pad "), (6, "\r\n"), (7, "\\"), (8, '"'), (9, "\\n")]
    df = spark.createDataFrame(rows, "k long, v string")
    path = scratch_path(spark, "odd_csv")
    sinks.write_csv(df, path)
    assert sorted(tuple(r) for r in sinks.read_csv(spark, path, df.schema).collect()) == rows
    with pytest.raises(Exception, match="mark of NULL"):
        sinks.write_csv(spark.createDataFrame([("\\N",)], "v string"), scratch_path(spark, "bad_csv"))


def test_stream_with_a_wrong_key_fails(spark):
    from docrel.streaming import append_absent_batch
    target = scratch_path(spark, "stream_wrong")
    spark.createDataFrame([(1, "a")], "k long, v string").write.parquet(target)
    batch = spark.createDataFrame([(1, 2, "b")], "k long, other long, v string")
    with pytest.raises(Exception, match="other"):
        append_absent_batch(target, ["other"])(batch, 0)
    assert spark.read.parquet(target).count() == 1


def test_stream_reads_touched_partitions(spark):
    from docrel.streaming import append_absent_batch
    target = scratch_path(spark, "stream_days")
    sink = append_absent_batch(target, ["day", "k"], partition_by="day")
    b = spark.createDataFrame([(1, 1, "a"), (2, 1, "b"), (2, 1, "c")], "day int, k long, v string")
    sink(b, 0)
    sink(b, 0)
    sink(spark.createDataFrame([(2, 2, "d"), (3, 1, "e")], "day int, k long, v string"), 1)
    assert sorted((r.day, r.k, r.v) for r in spark.read.parquet(target).collect()) == \
        [(1, 1, "a"), (2, 1, "b"), (2, 2, "d"), (3, 1, "e")]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace
    from docrel.session import ensure_checkpoint_dir
    none = SimpleNamespace(get=lambda *a: None)
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=none))


def test_connector_options():
    o = io.connector_split_options("SplitByKey", "_id", 8)
    assert o["partitionerOptions.partitionKey"] == "_id" and o["partitionerOptions.numberOfPartitions"] == "8"
    with pytest.raises(ValueError):
        io.connector_split_options("SplitByKey", "_id", 0)


def test_hot_copies_make_bounded_rows(spark):
    """One (parent, value) pair repeated far beyond the bucket size: home row
    plus overflow rows of at most max_len copies; membership sees it once."""
    from docrel.operators.documents import embed
    child = spark.range(25000).select(F.lit(1).cast("long").alias("k"),
                                      F.when(F.col("id") < 20000, F.lit(7)).otherwise(F.col("id")).alias("v"))
    parent = spark.createDataFrame([(1,)], "k long")
    rows = embed(parent, child, "k", "k", "v", "arr", max_len=1000).collect()
    assert max(len(r["arr"]) for r in rows) <= 2000
    assert sum(r["arr"].count(7) for r in rows) == 20000 and sum(len(r["arr"]) for r in rows) == 25000
    assert [r["_chunk"] for r in rows if 7 in r["arr"] and r["_chunk"] >= 0].__len__() == 1
    edges = membership.membership_edges(
        embed(parent, child, "k", "k", "v", "arr", max_len=1000), "k", "arr")
    assert edges.count() == 5001


SKEW = {"spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k"}


@pytest.fixture
def skewed(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _join_nodes(df, hot="1 = 1"):
    """Join nodes of the final plan, and the hot rows of each task."""
    tasks = df.withColumn("_task", F.spark_partition_id())
    per_task = Counter(r["_task"] for r in tasks.withColumn("_hot", F.expr(hot)).collect() if r["_hot"])
    tasks.collect()
    return [x for x in plan(tasks).split("Initial Plan")[0].splitlines() if "SortMergeJoin" in x], \
        list(per_task.values())


def test_hot_parent_is_split_in_every_join(spark, skewed):
    """A parent with a third of all children: the bucketing join, the join that
    attaches the chunks and a left membership join on a hot item are all split."""
    from docrel.operators.documents import attach, embed
    child = spark.range(300000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000 + 1).alias("k"),
        (F.col("id") * 7 % 100003).alias("v"))
    parent = spark.range(5002).select(F.col("id").alias("k"))
    side = embed(parent, child, "k", "k", "v", "arr", max_len=100)
    joins, _ = _join_nodes(side)
    assert any("skew=true" in x for x in joins)
    path = scratch_path(spark, "hot_side")
    side.write.parquet(path)
    out = attach(parent, spark.read.parquet(path), "k")
    joins, rows = _join_nodes(out, "k = 0")
    inner = [x for x in joins if "Inner" in x]
    assert inner and all("skew=true" in x for x in inner)
    assert len(rows) > 1 and max(rows) < 0.7 * sum(rows)
    res = out.groupBy((F.col("k") == 0).alias("hot")).agg(F.sum(F.size("arr")).alias("elems"))
    assert sorted(tuple(r) for r in res.collect()) == [(False, 200000), (True, 100000)]


def test_hot_item_is_split_in_a_left_membership_join(spark, skewed):
    owners = spark.range(30000).select(F.col("id").alias("o"), F.array(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 500 + 1)).alias("arr"))
    items = spark.range(600).select(F.col("id").alias("i"), F.lit("x" * 20).alias("name"))
    out = membership.membership_join(items, owners, "i", "arr", how="left")
    joins, rows = _join_nodes(out, "i = 0")
    inner = [x for x in joins if "Inner" in x]
    assert inner and all("skew=true" in x for x in inner)
    assert out.count() == 30000 + 99 and sum(rows) == 10000
    assert len(rows) > 1 and max(rows) < 0.7 * sum(rows)


def test_indexed_migration_prunes_by_department(spark):
    from docrel.plans import migration
    rel = testmap.relational(testmap.load(spark, SF))
    paths = migration.migrate(rel, scratch_path(spark, "mig"), with_indexes=True)
    c = spark.read.parquet(paths["courses_by_department"]).filter(F.col("department_id") == 3)
    p = c._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(department_id" in p and "= 3)" in p
    assert c.count() == spark.read.parquet(paths["courses"]).filter("department_id = 3").count()
    idx = layout.index_lookup(spark, paths["students_by_course"], 15, item_as="course_id",
                              owner_as="student_id")
    assert "EqualTo(course_id,15)" in plan(idx)
