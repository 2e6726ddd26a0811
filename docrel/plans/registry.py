"""Registered queries: one per operator of SURVEY §2 (ids in the names), each
``(spark, sf_dir) -> DataFrame`` over the driver's tables through the §5.1
mapping.  Column names match the SQL in ``docrel.plans.oracle``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrel import schemas
from docrel.functions.arrays import (array_size0, is_subset, map_lookup, rand_in_range,
                                     sorted_join, unwind, zero_pad)
from docrel.operators import division, documents, grouping, integrity, membership, postings, sampling
from docrel.plans import layout, queries as Q, testmap
from docrel.session import scratch_path
from docrel.sources import io, partial, sinks, split, variant
from docrel import streaming

Query = Callable[[SparkSession, str], DataFrame]

# Fixed parameters of the registered queries.
COURSE_Q1 = 15
COURSE_FLT1 = 42
INSTRUCTOR_Q2 = 2
DEPARTMENT_Q3 = 1
DEPARTMENT_FLT4 = 3
UNKNOWN_INSTRUCTOR = -1
MIN_STUDENTS_FLT5 = 8
SEED = 42
SAMPLE_K = 3
SAMPLE_K_RANGE = (3, 5)
GRID_SLOTS = (4, 6)
GRID_YEARS = (2020, 2021, 2022)
SPLIT_PARTS = 16
BUCKETS = 8
EMAIL_LOOKUP = "s15@example.edu"
ANY_COURSES = (15, 42)
ALL_DEPARTMENTS = (1, 2, 3)
NEWEST = 3
NO_DEPARTMENT = -1
SMALL_ARRAY = 4  # q_7_chunked: bucket size small enough to split students here
TINY_ARRAY = 1   # q_7_overflow: repeated enrolments spill into overflow rows
REGION_CODES = {"AFRICA": "AF", "AMERICA": "AM", "ASIA": "AS", "EUROPE": "EU", "MIDDLE EAST": "ME"}


def _cols(spark, sf, max_array=documents.MAX_LEN):
    return testmap.collections(spark, sf, max_array)


def _applicants(cols) -> DataFrame:
    """Students, and a copy of each without enrolments."""
    return testmap.with_unused(cols["students"], "_id")


def _planned(cols) -> DataFrame:
    """Courses, and a copy of each that nobody teaches or takes."""
    return testmap.with_unused(cols["courses"], "_id", instructor_id=F.lit(None).cast("long"))


def _rel(spark, sf):
    return testmap.relational(testmap.load(spark, sf))


def _raw(spark, sf):
    return testmap.load(spark, sf)


def _flat_students(cols) -> DataFrame:
    rows = documents.attach(cols["students"], cols["enrolled"], "_id")
    return rows.select("_id", "_chunk", "student_name", "student_email", "department_id",
                       array_size0("enrolled_courses").cast("long").alias("n_courses"),
                       sorted_join("enrolled_courses").alias("courses"))


def _course_counts(cols) -> DataFrame:
    return membership.membership_counts(cols["enrolled"], "_id", "enrolled_courses",
                                        item_as="course_id", count_as="num_enrollments")


# §2.10 — the six queries and the migration --------------------------------------
def q_1(spark, sf):
    return Q.q1_students_in_course(_cols(spark, sf), COURSE_Q1)


def q_1_id(spark, sf):
    return Q.q1_students_in_course(_cols(spark, sf), COURSE_Q1, with_id=True)


def q_2(spark, sf):
    return Q.q2_mean_enrolment(_cols(spark, sf), INSTRUCTOR_Q2)


def q_2_zero(spark, sf):
    return Q.q2_mean_enrolment(_cols(spark, sf), INSTRUCTOR_Q2, include_empty=True)


def q_3(spark, sf):
    return Q.q3_department_courses(_cols(spark, sf), DEPARTMENT_Q3)


def q_4(spark, sf):
    return Q.q4_students_per_department(_cols(spark, sf))


def q_5(spark, sf):
    return Q.q5_instructors_teaching_all_core(_cols(spark, sf), DEPARTMENT_Q3)


def q_5_grouped(spark, sf):
    return Q.q5_grouped(_cols(spark, sf))


def q_5_pipeline(spark, sf):
    return Q.q5_pipeline(_cols(spark, sf), DEPARTMENT_Q3)


def q_6_zero(spark, sf):
    """Q-6 for all courses, with those that nobody takes."""
    cols = _cols(spark, sf)
    return Q.q6_top_courses(dict(cols, courses=_planned(cols)), None, include_empty=True)


def q_6(spark, sf):
    return Q.q6_top_courses(_cols(spark, sf), 10)


def q_7(spark, sf):
    return _flat_students(_cols(spark, sf))


def q_7_chunked(spark, sf):
    return _flat_students(_cols(spark, sf, SMALL_ARRAY))


def q_7_indexed(spark, sf):
    """Q-7 with indexes: the written multikey index on enrolled_courses holds
    exactly the distinct (course, student) pairs, the department-partitioned
    copies every document: (kind, part, id, label)."""
    from docrel.plans.migration import migrate
    paths = migrate(_rel(spark, sf), scratch_path(spark, "migrated"), with_indexes=True)
    out = spark.read.parquet(paths["students_by_course"]).select(
        F.lit("index").alias("kind"), F.col("course_id").alias("part"),
        F.col("student_id").alias("id"), F.lit("").alias("label"))
    for name, label in (("students", "student_email"), ("instructors", "instructor_email"),
                        ("courses", "course_code")):
        copy = spark.read.parquet(paths[f"{name}_by_department"])
        out = out.unionByName(copy.select(
            F.lit(name).alias("kind"), F.col("department_id").cast("long").alias("part"),
            F.col("_id").alias("id"), F.col(label).alias("label")))
    return out


def q_7_overflow(spark, sf):
    """Q-7 with a bucket of one: every repeated enrolment goes to an overflow
    row (negative ``_chunk``)."""
    return _flat_students(_cols(spark, sf, TINY_ARRAY))


def q_7_courses(spark, sf):
    return _cols(spark, sf)["courses"]


def q_7_roundtrip(spark, sf):
    back = documents.flatten_collections(_cols(spark, sf))["enrollments"]
    return grouping.count_per_group(back, ["student_id", "course_id"], "n")


# SRC / SNK ------------------------------------------------------------------------
def src_1_collection(spark, sf):
    cols = _cols(spark, sf)
    back = {}
    for name in ("students", "enrolled"):
        path = scratch_path(spark, f"{name}_json")
        sinks.refresh(cols[name], path, fmt="json")
        back[name] = io.read_collection(spark, path, fmt="json", schema=schemas.COLLECTIONS[name])
    return _flat_students(back)


def src_1_variant(spark, sf):
    """Documents whose fields drift, read without a schema: the states of two fields."""
    s = _cols(spark, sf)["students"]
    i = F.col("_id") % 5
    array = F.when(i == 1, ', "enrolled_courses": null').when(i == 2, ', "enrolled_courses": []') \
        .when(i == 3, F.concat(F.lit(', "enrolled_courses": ['), F.col("_id").cast("string"), F.lit(", null]"))) \
        .when(i == 4, ', "enrolled_courses": "none"').otherwise("")
    dept = F.when(F.col("department_id") < 5, F.concat(F.lit('{"no": '), F.col("department_id").cast("string"), F.lit("}"))) \
        .otherwise(F.col("department_id").cast("string"))
    line = F.concat(F.lit('{"_id": '), F.col("_id").cast("string"), F.lit(', "department_id": '), dept, array,
                    F.when(F.col("_id") % 97 == 0, "").otherwise("}"))
    path = scratch_path(spark, "students_text")
    s.select(line.alias("value")).write.mode("overwrite").text(path)
    docs = variant.read_documents(spark, path)
    states = docs.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), variant.field_state("doc", f"$.{f}").alias("state"))
        for f in ("_id", "department_id", "enrolled_courses")])).alias("x"))
    return states.select("x.*").groupBy("field", "state").agg(F.count(F.lit(1)).alias("n"))


def src_2_split(spark, sf):
    """Lines split by a key of which a third is one value, some are NULL and the rest is
    far from uniform: rows, NULL keys, and whether no part is 1.3 times the mean."""
    li = _raw(spark, sf)["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey")
    key = F.when(F.col("l_linenumber") == 7, F.lit(None)).when(F.col("l_orderkey") % 3 == 0, F.lit(0)) \
        .otherwise(F.col("l_orderkey") * F.col("l_orderkey"))
    path = scratch_path(spark, "split_source")
    li.withColumn("k", key.cast("long")).write.mode("overwrite").parquet(path)
    source = io.read_table(spark, path)
    predicates = split.balanced_predicates(source, "k", SPLIT_PARTS, tie="l_partkey")
    per = split.read_parts(source, predicates, "part").groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("k").isNull().cast("long")).alias("nulls"))
    known = F.when(F.col("nulls") == 0, F.col("n"))
    return per.agg(F.sum("n").alias("n_rows"), F.sum("nulls").alias("null_rows"),
                   F.sum((F.col("nulls") > 0).cast("long")).alias("null_parts"),
                   (F.max(known) < 1.3 * F.avg(known)).alias("balanced"))


def src_3_tables(spark, sf):
    return io.read_table(spark, f"{sf}/customer.parquet", columns=["c_custkey", "c_name", "c_nationkey"])


def snk_1_refresh(spark, sf):
    path = scratch_path(spark, "courses")
    c = _cols(spark, sf)["courses"]
    sinks.refresh(c, path)
    sinks.refresh(c, path)  # a second full refresh leaves the same collection
    return io.read_collection(spark, path, schema=schemas.COURSE_DOCS)


def snk_2_absent(spark, sf):
    s = _cols(spark, sf)["students"].select("_id", "student_name", "department_id")
    target = s.filter(F.col("department_id") < 13)
    batch = s.filter(F.col("department_id") >= 8) \
             .withColumn("student_name", F.concat("student_name", F.lit(" (new)")))
    batch = batch.unionByName(batch)  # repeated rows in one batch
    p0, p1, p2 = (scratch_path(spark, f"students_v{i}") for i in range(3))
    sinks.write_versioned(target, p0)
    v1 = sinks.append_if_absent(spark.read.parquet(p0), batch, ["_id"])
    sinks.write_versioned(v1, p1)
    v2 = sinks.append_if_absent(spark.read.parquet(p1), batch, ["_id"])  # idempotent
    sinks.write_versioned(v2, p2)
    return spark.read.parquet(p2)


def snk_2_stream(spark, sf):
    """SNK-2 on a file stream: the batch (twice over) arrives as files read in
    several micro-batches; the target ends as with the batch form."""
    s = _cols(spark, sf)["students"].select("_id", "student_name", "department_id")
    target = scratch_path(spark, "stream_target")
    source = scratch_path(spark, "stream_source")
    sinks.write_versioned(s.filter(F.col("department_id") < 13), target)
    batch = s.filter(F.col("department_id") >= 8) \
             .withColumn("student_name", F.concat("student_name", F.lit(" (new)")))
    batch.write.mode("append").parquet(source)
    batch.write.mode("append").parquet(source)  # the same rows again, in later files
    src = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 4).parquet(source)
    q = streaming.stream_append_if_absent(src, target, ["_id"])
    q.awaitTermination()
    return spark.read.parquet(target)


def snk_2_pruned(spark, sf):
    """SNK-2 on a stream into a partitioned target, of which a batch reads what it touches."""
    s = _cols(spark, sf)["students"].select("_id", "student_name", "department_id")
    target, source = scratch_path(spark, "stream_target"), scratch_path(spark, "stream_source")
    s.filter(F.col("department_id") < 13).write.mode("overwrite").partitionBy("department_id").parquet(target)
    batch = s.filter(F.col("department_id") >= 8) \
             .withColumn("student_name", F.concat("student_name", F.lit(" (new)")))
    batch.unionByName(batch).write.mode("append").parquet(source)
    src = spark.readStream.schema(batch.schema).parquet(source)
    streaming.stream_append_if_absent(src, target, ["_id", "department_id"],
                                      partition_by="department_id").awaitTermination()
    return spark.read.parquet(target)


def snk_2_bucketed(spark, sf):
    """SNK-2 twice over into a bucketed table; the batch holds a NULL key."""
    s = _cols(spark, sf)["students"].select("_id", "student_name", "department_id")
    table = f"docrel_students_{uuid.uuid4().hex}"
    layout.bucket_table(s.filter(F.col("department_id") < 13), table, BUCKETS, ["_id"], ["_id"],
                        path=scratch_path(spark, "bucketed"))
    batch = s.filter(F.col("department_id") >= 8) \
             .withColumn("student_name", F.concat("student_name", F.lit(" (new)")))
    ghost = batch.agg(F.lit(None).cast("long").alias("_id"), F.lit("nobody").alias("student_name"),
                      F.max("department_id").alias("department_id"))
    batch = batch.unionByName(ghost).unionByName(ghost)
    for _ in range(2):
        partial.append_to_bucketed(spark, table, batch, ["_id"], n_buckets=BUCKETS, sort_by=["_id"])
    return spark.table(table)


def snk_3_partition(spark, sf):
    """SNK-3 on a table partitioned by nation: only nations below 5 hold updated keys."""
    c = _raw(spark, sf)["customer"]
    path = scratch_path(spark, "customers")
    c.select(F.col("c_custkey").alias("_id"), F.col("c_mktsegment").alias("segment"),
             F.col("c_nationkey").alias("nation")).write.mode("overwrite").partitionBy("nation").parquet(path)
    rich = c.filter((F.col("c_acctbal") > 5000) & (F.col("c_nationkey") < 5))
    def update(key, value, at):
        return rich.select(key.alias("_id"), value.alias("segment"), F.lit(at).alias("at"))
    key = F.col("c_custkey")
    upd = update(key, F.lower("c_mktsegment"), 2).unionByName(update(key, F.lit("early"), 1)) \
        .unionByName(update(key + F.lit(1 << 40), F.lit("ghost"), 1))
    partial.update_partitions(spark, path, upd, "_id", ["segment"], partition_by="nation", order=["at", "segment"])
    return spark.read.parquet(path)


def snk_3_update(spark, sf):
    """Two updates a customer, of which the later wins, and some without a target."""
    c = _raw(spark, sf)["customer"]
    target = c.select(F.col("c_custkey").alias("_id"), F.col("c_mktsegment").alias("segment"))
    rich = c.filter(F.col("c_acctbal") > 5000)
    def update(key, value, at):
        return rich.select(key.alias("_id"), value.alias("segment"), F.lit(at).alias("at"))
    key = F.col("c_custkey")
    upd = update(key, F.lower("c_mktsegment"), 2).unionByName(update(key, F.lit("early"), 1)) \
        .unionByName(update(key + F.lit(1 << 40), F.lit("ghost"), 1))
    p0, p1 = scratch_path(spark, "seg_v0"), scratch_path(spark, "seg_v1")
    sinks.write_versioned(target, p0)
    out = sinks.set_fields(spark.read.parquet(p0), upd, "_id", ["segment"], order=["at", "segment"])
    sinks.write_versioned(out, p1)
    return spark.read.parquet(p1)


def snk_3_array(spark, sf):
    """SNK-3 on the array field: in departments below 5 every course once; the
    bucket size does not show in the answer."""
    cols = _cols(spark, sf, SMALL_ARRAY)
    keys = cols["students"].filter(F.col("department_id") < 5).select("_id")
    once = Q.enrollment_edges(cols)
    side = documents.set_array(cols["enrolled"], keys, once, "_id", "student_id", "course_id",
                               "enrolled_courses", max_len=SMALL_ARRAY)
    back = documents.flatten_collections(dict(cols, enrolled=side))["enrollments"]
    return grouping.count_per_group(back, ["student_id", "course_id"], "n")


def snk_4_csv(spark, sf):
    """Courses whose codes hold line breaks, quotes and delimiters, are empty or NULL."""
    path = scratch_path(spark, "courses_csv")
    c = _cols(spark, sf)["courses"]
    year = F.col("offering_year")
    odd = c.withColumn("course_code", F.when(year == 1998, "").when(year == 1999, F.lit(None).cast("string"))
                       .when(year == 2000, F.concat("course_code", F.lit('\n"a", \'b\' \\ ')))
                       .when(year == 2001, F.concat(F.lit(" "), "course_code", F.lit("\r\n")))
                       .otherwise(F.col("course_code")))
    sinks.write_csv(odd, path)
    return sinks.read_csv(spark, path, schemas.COURSE_DOCS)


# SCH ------------------------------------------------------------------------------
def sch_2_notnull(spark, sf):
    cols = _cols(spark, sf)
    a = integrity.column_rule_report("courses", _planned(cols), ["course_code", "instructor_id"],
                                     {"course_code": 14})
    b = integrity.column_rule_report("students", _applicants(cols), [], {"student_name": 18, "student_email": 10})
    # a student's array may be several rows of the side collection, or none
    without = _applicants(cols).join(cols["enrolled"].select("_id"), "_id", "left_anti")
    c = without.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit("students").alias("table_name"), F.lit("not_null").alias("rule"),
        F.lit("enrolled_courses").alias("column_name"), "violations")
    return a.unionByName(b).unionByName(c)


def sch_2_load(spark, sf):
    """The report of all rules, those of single rows counted by the load itself."""
    rel = _rel(spark, sf)
    return integrity.load_checked(rel, {k: scratch_path(spark, k) for k in rel})


def sch_3_unique(spark, sf):
    return integrity.unique_violations(_raw(spark, sf)["lineitem"], ["l_orderkey", "l_linenumber"])


def sch_3_report(spark, sf):
    """All rules over the six tables, stored first as a database would hold them."""
    rel = _rel(spark, sf)
    paths = {k: scratch_path(spark, k) for k in rel}
    sinks.refresh_all(rel, paths)
    return integrity.integrity_report({k: spark.read.parquet(p) for k, p in paths.items()})


def sch_4_fk(spark, sf):
    claims = testmap.teaches_claims(_raw(spark, sf)["lineitem"])
    c = _cols(spark, sf)["courses"].select("_id", "instructor_id")
    return integrity.fk_violations(c, claims, ["_id", "instructor_id"], ["course_id", "instructor_id"])


def sch_5_ids(spark, sf):
    o = _raw(spark, sf)["orders"].select("o_orderkey", "o_orderdate")
    return integrity.assign_ids(o, ["o_orderdate", "o_orderkey"], "order_id").drop("o_orderdate")


def sch_5_serial(spark, sf):
    """Orders loaded in three batches, the first again after the second."""
    o = _raw(spark, sf)["orders"].select("o_orderkey", "o_orderdate", "o_orderstatus")
    path, out = scratch_path(spark, "serial"), {}
    for status in "FOFP":
        batch = o.filter(F.col("o_orderstatus") == status)
        out[status] = integrity.load_serial(spark, path, batch, status, ["o_orderkey"],
                                            ["o_orderdate", "o_orderkey"], "order_id")
    rows = [df.select("o_orderkey", "order_id") for df in out.values()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# FLT / PRJ ------------------------------------------------------------------------
def flt_1(spark, sf):
    cols = _cols(spark, sf)
    hit = membership.membership_filter(cols["enrolled"], "enrolled_courses", COURSE_FLT1).select("_id")
    return cols["students"].join(hit, "_id", "left_semi").select("_id", "student_name", "department_id")


def flt_2(spark, sf):
    return _cols(spark, sf)["courses"].filter(F.col("instructor_id") == INSTRUCTOR_Q2) \
        .select("_id", "course_code")


def flt_3(spark, sf):
    return _cols(spark, sf)["courses"] \
        .filter((F.col("department_id") == DEPARTMENT_Q3) & F.col("is_core_course")) \
        .select("_id", "course_code")


def flt_5(spark, sf):
    return _course_counts(_cols(spark, sf)) \
        .filter(F.col("num_enrollments") >= MIN_STUDENTS_FLT5) \
        .select("course_id", F.col("num_enrollments").alias("num_students"))


def _flt_4(spark, sf, same):
    cols = _cols(spark, sf)
    conds = [F.col("department_id") == DEPARTMENT_FLT4, F.col("is_core_course")]
    return documents.match_children(cols["instructors"], cols["courses"], "_id", "instructor_id",
                                    conds, same_element=same).select("_id", "instructor_name")


def flt_4_any(spark, sf):
    return _flt_4(spark, sf, False)


def flt_4_same(spark, sf):
    return _flt_4(spark, sf, True)


def prj_1_3(spark, sf):
    c = _cols(spark, sf)["courses"]
    return documents.project_doc(c.withColumnRenamed("course_code", "code")
                                  .withColumnRenamed("department_id", "dept"),
                                 ["code", "dept"], exclude_id=True)


def prj_5(spark, sf):
    c = _cols(spark, sf)["courses"]
    return c.select("_id", F.substring_index("course_code", "-", 1).alias("code_prefix"),
                    (F.col("offering_year") >= 2001).alias("is_recent"))


# JOIN -----------------------------------------------------------------------------
def join_1_membership(spark, sf):
    """Courses and the students who take them, with columns of both."""
    cols = _cols(spark, sf)
    c = cols["courses"].select(F.col("_id").alias("course_id"), "course_code")
    j = membership.membership_join(c, cols["enrolled"].withColumnRenamed("_id", "student_id"), "course_id",
                                   "enrolled_courses")
    s = cols["students"].select(F.col("_id").alias("student_id"), "student_name")
    return j.join(s, "student_id").select("course_id", "course_code", "student_id", "student_name")


def join_1_left(spark, sf):
    """JOIN-1 keeping courses that nobody takes."""
    cols = _cols(spark, sf)
    c = _planned(cols).select(F.col("_id").alias("course_id"), "course_code")
    side = cols["enrolled"].select(F.col("_id").alias("student_id"), "enrolled_courses")
    return membership.membership_join(c, side, "course_id", "enrolled_courses", how="left")


def join_2(spark, sf):
    cols = _cols(spark, sf)
    c, i = cols["courses"], cols["instructors"]
    return c.join(i, c["instructor_id"] == i["_id"]).select(c["_id"], "course_code", "instructor_name")


def join_3(spark, sf):
    cols = _cols(spark, sf)
    d, s = cols["departments"], cols["students"]
    return s.join(d, s["department_id"] == d["_id"]).select(s["_id"], "department_name")


def join_9(spark, sf):
    cols = _cols(spark, sf)
    j = documents.lookup_unwind(cols["instructors"], cols["departments"], "department_id", "_id",
                                "department_info")
    return j.select("_id", F.col("department_info.department_name").alias("department_name"))


def join_4_share(spark, sf):
    s = _cols(spark, sf)["students"]
    per = grouping.count_per_group(s, "department_id", "total_students")
    return grouping.attach_scalar(per, grouping.scalar_count(s, "all_students"))


def join_5_fold(spark, sf):
    rel = _rel(spark, sf)
    f = documents.fold_link(testmap.with_unused(rel["courses"], "course_id"), rel["teaches"], "course_id", "course_id",
                            "instructor_id", rel["instructors"], "instructor_id", as_="instructor_id")
    i = rel["instructors"].select(F.col("instructor_id").alias("_iid"), "instructor_name")
    return f.join(i, f["instructor_id"] == i["_iid"], "left") \
            .select(F.col("course_id").alias("_id"), "instructor_id", "instructor_name")


def join_6_lookup(spark, sf):
    cols = _cols(spark, sf)
    j = documents.lookup(cols["departments"], cols["instructors"], "_id", "department_id",
                         "dept_instructors")
    return j.select("_id", "_chunk", F.size("dept_instructors").cast("long").alias("n_instructors"),
                    sorted_join(F.col("dept_instructors._id")).alias("instructor_ids"))


def join_7_lookup_array(spark, sf):
    cols = _cols(spark, sf)
    j = documents.lookup_in_array(cols["courses"], cols["enrolled"], "_id", "enrolled_courses",
                                  "enrolled_students", doc_cols=["_id"])
    return j.select("_id", "_chunk", F.size("enrolled_students").cast("long").alias("n_students"),
                    sorted_join(F.col("enrolled_students._id")).alias("student_ids"))


def join_7_count(spark, sf):
    cols = _cols(spark, sf)
    j = documents.lookup_count(cols["courses"], cols["enrolled"], "_id", "enrolled_courses",
                               "n_students", foreign_is_array=True)
    return j.select("_id", "n_students")


def join_6_null(spark, sf):
    """JOIN-6 where missing equals null: the courses of every instructor, and of none."""
    cols = _cols(spark, sf)
    c = _planned(cols).select("_id", "instructor_id")
    j = documents.lookup(c.select("instructor_id"), c, "instructor_id", "instructor_id", "docs",
                         null_safe=True, max_len=SMALL_ARRAY, doc_cols=["_id"])
    return j.groupBy("instructor_id").agg(F.sum(F.size("docs")).alias("n_courses"))


def join_8_sub(spark, sf):
    """JOIN-8: every instructor of department 3 carries the same array, the core
    courses of department 1.  It is kept once; its size and the sum of its ids are
    one row, attached to all."""
    cols = _cols(spark, sf)
    core = cols["courses"].filter((F.col("department_id") == DEPARTMENT_Q3) & F.col("is_core_course"))
    ins = cols["instructors"].filter(F.col("department_id") == DEPARTMENT_FLT4)
    keys, shared = documents.lookup_uncorrelated(ins, core.select("_id", "course_code"), "_id", "all_core",
                                                 max_len=SMALL_ARRAY)
    each = shared.select(F.explode("all_core._id").alias("id"))
    return grouping.attach_scalar(keys.select("_id"), each.agg(F.count("id").alias("n_core"),
                                                               F.sum("id").alias("ids_sum")))


def join_8_correlated(spark, sf):
    """JOIN-8 with ``let``: of each instructor the three newest core courses that are of
    the instructor's own department."""
    cols = _cols(spark, sf)
    j = documents.lookup_correlated(
        cols["instructors"], cols["courses"], "_id", "_id", "instructor_id", "newest",
        let={"dept": "department_id"}, where=F.col("is_core_course") & (F.col("department_id") == F.col("_let_dept")),
        order=[F.col("offering_year").desc(), F.col("_id").asc()], k=NEWEST, doc_cols=["_id", "offering_year"])
    ids = F.transform("newest", lambda d: d["_id"].cast("string"))
    return j.select("_id", F.size("newest").cast("long").alias("n_newest"), F.array_join(ids, ",").alias("course_ids"))


def agg_6_bucket_sizes(spark, sf):
    """No generic answer depends on the bucket size: (max_array, what, n)."""
    out = None
    for m in (TINY_ARRAY, SMALL_ARRAY, documents.MAX_LEN):
        cols = _cols(spark, sf, m)
        d, s, side = cols["departments"], cols["students"], cols["enrolled"]
        per = documents.lookup_count(d, s, "_id", "department_id", "n")
        docs = documents.lookup(d, s, "_id", "department_id", "docs", max_len=m, doc_cols=["_id"])
        one = documents.lookup_unwind(d, s, "_id", "department_id", "doc")
        every = membership.membership_edges(side, "_id", "enrolled_courses", distinct=False)
        for what, df, n in (("lookup_count", per, F.sum("n")), ("lookup", docs, F.sum(F.size("docs"))),
                            ("lookup_unwind", one, F.count("doc")),
                            ("unique_violations", integrity.unique_violations(s, ["_id"]), F.count("_id")),
                            ("edges", Q.enrollment_edges(cols), F.count("course_id")),
                            ("all_edges", every, F.count("item_id"))):
            row = df.agg(n.cast("long").alias("n")).select(F.lit(m).alias("max_array"),
                                                           F.lit(what).alias("what"), "n")
            out = row if out is None else out.unionByName(row)
    return out


def join_10(spark, sf):
    cols = _cols(spark, sf)
    out = sampling.candidate_counts(cols["students"].select("_id", "department_id"),
                                    cols["courses"].select("department_id"), "department_id")
    return out.select("_id", "n_candidates")


def join_11(spark, sf):
    """JOIN-11 — courses nobody takes.  Anti-joined against the per-course
    counts (one pre-aggregated row per course), not the raw edges, so a hot
    course is never a hot key of the join."""
    cols = _cols(spark, sf)
    taken = _course_counts(cols).select("course_id")
    c = _planned(cols)
    return c.join(taken, c["_id"] == taken["course_id"], "left_anti").select("_id", "course_code")


# AGG ------------------------------------------------------------------------------
def agg_1(spark, sf):
    return grouping.count_per_group(_cols(spark, sf)["students"], "department_id", "total_students")


def agg_2(spark, sf):
    return grouping.mean_of_counts(_course_counts(_cols(spark, sf)), "num_enrollments",
                                   "average_students")


def agg_4(spark, sf):
    cols = _cols(spark, sf)
    claims = testmap.with_unused(testmap.teaches_claims(_raw(spark, sf)["lineitem"]), "course_id")
    per = membership.counts_for_items(claims, "course_id", _course_counts(cols), "course_id",
                                      "num_enrollments", include_empty=True)
    n = F.col("num_enrollments")
    return per.groupBy("instructor_id").agg(
        F.avg(n).alias("avg_zero"), F.avg(F.when(n > 0, n)).alias("avg_inner"))


def agg_5(spark, sf):
    o = _raw(spark, sf)["orders"].select("o_custkey", "o_orderkey", "o_orderdate")
    return grouping.first_per_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])


def agg_6_embed(spark, sf):
    rel = _rel(spark, sf)
    s = documents.embed(testmap.with_unused(rel["students"], "student_id"), rel["enrollments"], "student_id", "student_id",
                        "course_id", "enrolled_courses", empty="empty")
    return s.select(F.col("student_id").alias("_id"), "_chunk",
                    F.size("enrolled_courses").cast("long").alias("n_courses"),
                    sorted_join("enrolled_courses").alias("courses"))


def agg_7_empty(spark, sf):
    cols = _cols(spark, sf)
    a = Q.q2_mean_enrolment(cols, UNKNOWN_INSTRUCTOR).select(F.lit("sql").alias("mode"), "*")
    b = Q.q2_mean_enrolment(cols, UNKNOWN_INSTRUCTOR, drop_empty=True) \
         .select(F.lit("pipeline").alias("mode"), "*")
    return a.unionByName(b)


def _type_division_inputs(spark, sf):
    raw = _raw(spark, sf)
    li = raw["lineitem"].select("l_orderkey", "l_partkey")
    o = raw["orders"].select("o_orderkey", "o_custkey")
    p = raw["part"].select("p_partkey", "p_type")
    dividend = li.join(o, li["l_orderkey"] == o["o_orderkey"]) \
                 .join(p, F.col("l_partkey") == p["p_partkey"]) \
                 .select(F.col("o_custkey").alias("c_custkey"), "p_type")
    return dividend, p.select("p_type")


def agg_8_division(spark, sf):
    dividend, divisor = _type_division_inputs(spark, sf)
    return division.divide(dividend, divisor, "c_custkey", "p_type")


def agg_8_grouped(spark, sf):
    """Grouped division with a divisor per group: per nation, the customers
    whose lines cover every part type that any customer of their nation bought."""
    raw = _raw(spark, sf)
    dividend, _ = _type_division_inputs(spark, sf)
    c = raw["customer"].select("c_custkey", "c_nationkey")
    grouped = dividend.join(c, "c_custkey").select("c_nationkey", "c_custkey", "p_type")
    divisor = grouped.select("c_nationkey", "p_type")
    return division.divide(grouped, divisor, "c_custkey", "p_type", group="c_nationkey")


def agg_8_empty(spark, sf):
    """Division by an empty set, read as "all": every instructor."""
    return Q.q5_instructors_teaching_all_core(_cols(spark, sf), NO_DEPARTMENT, empty_divisor="all")


def agg_8_grouped_empty(spark, sf):
    """The same per group: departments below 5 have no core course here."""
    cols = _cols(spark, sf)
    c = cols["courses"].withColumn("is_core_course", F.col("is_core_course") & (F.col("department_id") >= 5))
    return Q.q5_grouped(dict(cols, courses=c), empty_divisor="all")


def agg_9_division(spark, sf):
    dividend, divisor = _type_division_inputs(spark, sf)
    return division.divide_by_containment(dividend, divisor, "c_custkey", "p_type")


# WIN ------------------------------------------------------------------------------
def _sample(spark, sf, k):
    cols = _cols(spark, sf)
    ents = cols["students"].select(F.col("_id").alias("student_id"), "department_id")
    items = cols["courses"].select("department_id", F.col("_id").alias("course_id"))
    kk = k if not isinstance(k, tuple) else rand_in_range(k[0], k[1], F.lit(SEED), F.col("student_id"))
    return sampling.sample_per_entity(ents, items, "student_id", "department_id", "course_id", kk, SEED)


def win_1_sample(spark, sf):
    return _sample(spark, sf, SAMPLE_K)


def win_1_range(spark, sf):
    return _sample(spark, sf, SAMPLE_K_RANGE)


def win_2_range(spark, sf):
    s = _cols(spark, sf)["students"]
    lo, hi = SAMPLE_K_RANGE
    return s.select("_id", rand_in_range(lo, hi, F.lit(SEED), F.col("_id")).alias("k"))


def win_3_first(spark, sf):
    return testmap.teaches_claims(_raw(spark, sf)["lineitem"])


def win_3_sampled(spark, sf):
    """WIN-1 then WIN-3: every instructor draws three courses of the own department;
    a course goes to the first who drew it."""
    cols = _cols(spark, sf)
    ents = cols["instructors"].select(F.col("_id").alias("instructor_id"), "department_id")
    items = cols["courses"].select("department_id", F.col("_id").alias("course_id"))
    drawn = sampling.sample_per_entity(ents, items, "instructor_id", "department_id", "course_id",
                                       SAMPLE_K, SEED)
    return sampling.first_claim(drawn, "course_id", "instructor_id", ["instructor_id"])


def _dept_prefix(raw) -> DataFrame:
    n, r = raw["nation"], raw["region"]
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.select(F.col("n_nationkey").alias("department_id"),
                    F.concat(map_lookup(REGION_CODES, F.col("r_name")),
                             F.format_string("%02d", F.col("n_nationkey"))).alias("prefix"))


def win_4_grid(spark, sf):
    d = _dept_prefix(_raw(spark, sf))
    lo, hi = GRID_SLOTS
    g = sampling.expand_grid(d, "department_id", F.col("prefix"),
                             rand_in_range(lo, hi, F.lit(SEED), F.col("department_id")),
                             GRID_YEARS, SEED)
    return g.select("department_id", "course_code", "offering_year", "is_core_course")


# ORD ------------------------------------------------------------------------------
def ord_3_topk(spark, sf):
    o = _raw(spark, sf)["orders"].select("o_orderkey", "o_totalprice")
    return grouping.top_k(o, F.col("o_totalprice").desc(), 10, F.col("o_orderkey").asc())


def ord_3_ties(spark, sf):
    return grouping.top_k_with_ties(_course_counts(_cols(spark, sf)), "num_enrollments", 10) \
        .select(F.col("course_id").alias("_id"), "num_enrollments")


def ord_3_group(spark, sf):
    cols = _cols(spark, sf)
    cnt = _course_counts(cols)
    c = cols["courses"].select("_id", "department_id")
    j = c.join(cnt, c["_id"] == cnt["course_id"]).select("department_id", "_id", "num_enrollments")
    return grouping.top_k_per_group(j, "department_id", F.col("num_enrollments").desc(), 3,
                                    F.col("_id").asc())


# ARR ------------------------------------------------------------------------------
def arr_1(spark, sf):
    return unwind(_cols(spark, sf)["enrolled"].select("_id", "enrolled_courses"), "enrolled_courses",
                  "course_id")


def arr_1_outer(spark, sf):
    cols = _cols(spark, sf)
    s = documents.attach(_applicants(cols), cols["enrolled"], "_id").select("_id", "enrolled_courses")
    return unwind(s, "enrolled_courses", "course_id", preserve_empty=True)


def arr_2(spark, sf):
    """Whether the departments of a student's courses include the student's own."""
    cols = _cols(spark, sf)
    c = cols["courses"].select(F.col("_id").alias("course_id"), F.col("department_id").alias("dept"))
    # at most as many departments as there are
    depts = Q.enrollment_edges(cols).join(c, "course_id").groupBy("student_id") \
        .agg(F.collect_set("dept").alias("depts"))
    s = _applicants(cols)
    return s.join(depts, s["_id"] == depts["student_id"], "left") \
            .select("_id", is_subset(F.array("department_id"), "depts").alias("covered"))


def arr_3_4(spark, sf):
    raw = _raw(spark, sf)
    n, r = raw["nation"], raw["region"]
    j = n.join(r, n["n_regionkey"] == r["r_regionkey"])
    return j.select("n_nationkey",
                    zero_pad(map_lookup(REGION_CODES, F.col("r_name")), F.col("n_nationkey"), 3)
                    .alias("code"))


# PHY ------------------------------------------------------------------------------
def phy_1_cache(spark, sf):
    """PHY-1: one cached intermediate read by two consumers (the per-department
    counts and the total) in one job, released after the result is written."""
    s = _cols(spark, sf)["students"].select("department_id")
    out = scratch_path(spark, "share")
    with layout.cached(s) as c:
        per = grouping.count_per_group(c, "department_id", "total_students")
        sinks.write_versioned(grouping.attach_scalar(per, grouping.scalar_count(c, "all_students")), out)
    return spark.read.parquet(out)


def phy_2_repartition(spark, sf):
    """PHY-2 where it pays: courses (unique ``_id``, so no hot key) are hash
    partitioned on the join key the per-course counts are already partitioned
    on, so the join adds no exchange.  Edges are never repartitioned raw: that
    would send a hot course to one task before any pre-aggregation."""
    cols = _cols(spark, sf)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cnt = grouping.count_per_group(Q.enrollment_edges(cols), "course_id", "num_enrollments")
    c = layout.hash_partition(cols["courses"].select("_id", "course_code"), n, "_id")
    j = c.join(cnt, c["_id"] == cnt["course_id"]).select("_id", "course_code", "num_enrollments")
    return grouping.top_k(j, F.col("num_enrollments").desc(), 10, F.col("_id").asc())


def phy_3_scalar(spark, sf):
    cols = _cols(spark, sf)
    c = cols["courses"]
    core = c.filter((F.col("department_id") == DEPARTMENT_Q3) & F.col("is_core_course"))
    need = layout.scalar_value(grouping.scalar_count(core, "n"))
    taught = c.join(core.select(F.col("_id").alias("_cid")), c["_id"] == F.col("_cid"), "left_semi") \
              .filter(F.col("instructor_id").isNotNull())
    per = grouping.count_per_group(taught, "instructor_id", "n").filter(F.col("n") == F.lit(need))
    i = cols["instructors"]
    return i.join(per, i["_id"] == per["instructor_id"], "left_semi").select("instructor_name")


def phy_5_layout(spark, sf):
    path = scratch_path(spark, "courses_by_dept")
    layout.write_layout(_cols(spark, sf)["courses"], path, partition_by=["department_id"],
                        cluster_by=["_id"])
    back = {"courses": spark.read.parquet(path)}
    return Q.q3_department_courses(back, DEPARTMENT_Q3)


def phy_5_bucketed(spark, sf):
    """PHY-5: students and orders bucketed and sorted alike, joined and counted in place."""
    raw = _raw(spark, sf)
    names = [f"docrel_{k}_{uuid.uuid4().hex}" for k in ("students", "orders")]
    students = raw["customer"].select(F.col("c_custkey").alias("_id"), F.col("c_name").alias("student_name"))
    orders = raw["orders"].select(F.col("o_custkey").alias("_id"), "o_totalprice")
    for df, name in zip((students, orders), names):
        layout.bucket_table(df, name, BUCKETS, ["_id"], ["_id"], path=scratch_path(spark, name))
    j = layout.colocated_join(spark.table(names[0]), spark.table(names[1]), ["_id"])
    return j.groupBy("_id", "student_name").agg(F.count(F.lit(1)).alias("n_orders"),
                                                F.max("o_totalprice").alias("largest"))


def phy_5_lookup(spark, sf):
    """PHY-5: a point lookup by e-mail in students clustered by department; Bloom filters
    tell which row groups may hold it."""
    path = scratch_path(spark, "students_bloom")
    students = _cols(spark, sf)["students"]
    layout.write_layout(students, path, cluster_by=["department_id", "_id"], bloom_on={"student_email": 100_000})
    return spark.read.parquet(path).filter(F.col("student_email") == EMAIL_LOOKUP) \
        .select("_id", "student_name", "student_email")


def phy_6_bitmaps(spark, sf):
    """PHY-6: students in any of some courses and in all of some departments, and how many."""
    cols = _cols(spark, sf)
    edges = Q.enrollment_edges(cols)
    in_course = postings.any_of(postings.posting_bitmaps(edges, "student_id", "course_id"), ANY_COURSES)
    c = cols["courses"].select(F.col("_id").alias("course_id"), "department_id")
    in_all = postings.all_of(postings.posting_bitmaps(edges.join(c, "course_id"), "student_id", "department_id"),
                             ALL_DEPARTMENTS)
    out = None
    for reading, sets in (("any", in_course), ("all", in_all)):
        # a bucket's bitmap is read for its members and for its count
        one = postings.members(sets, "student_id").select(F.lit(reading).alias("reading"), "student_id")
        n = postings.member_count(sets, "student_id").select(F.lit(f"{reading}_count").alias("reading"), "student_id")
        out = one.unionByName(n) if out is None else out.unionByName(one).unionByName(n)
    return out


def phy_6_inverted(spark, sf):
    cols = _cols(spark, sf)
    path = scratch_path(spark, "enrolled_index")
    layout.write_inverted_index(cols["enrolled"], "_id", "enrolled_courses", path,
                                item_as="course_id", owner_as="student_id")
    hit = layout.index_lookup(spark, path, COURSE_Q1, item_as="course_id", owner_as="student_id")
    s = cols["students"]
    return s.join(hit, s["_id"] == hit["student_id"], "left_semi").select("student_name", "student_email")


def phy_7_prejoin(spark, sf):
    cols = _cols(spark, sf)
    c = cols["courses"].select("_id", "course_code")
    return membership.counts_for_items(c, "_id", _course_counts(cols), "course_id",
                                       "num_enrollments", include_empty=True)


REGISTRY: dict[str, Query] = {
    name: fn for name, fn in globals().items()
    if callable(fn) and name.split("_")[0] in
    {"q", "src", "snk", "sch", "flt", "prj", "join", "agg", "win", "ord", "arr", "phy"}
    and getattr(fn, "__module__", "") == __name__
}
