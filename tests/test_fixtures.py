"""Hand-made edge cases (FIXTURES.md §4): duplicate ids in arrays, NULL and
empty arrays, a NULL element, a course without students, a course without an
instructor, empty divisors, unknown keys."""

import pytest
from pyspark.sql import functions as F

from docrel import schemas
from docrel.operators import division, documents, integrity, membership
from docrel.plans import queries as Q


@pytest.fixture(scope="module")
def cols(spark):
    students = spark.createDataFrame(
        [(1, "s1", "s1@x", 1, [1, 2]), (2, "s2", "s2@x", 1, [1, 1]), (3, "s3", "s3@x", 2, None),
         (4, "s4", "s4@x", 2, []), (5, "s5", "s5@x", 1, [2, None])], schemas.STUDENT_DOCS_INLINE)
    courses = spark.createDataFrame(
        [(1, "CS-1", 1, True, 2020, 2), (2, "CS-2", 1, True, 2021, 2),
         (3, "CS-3", 1, False, 2022, 2), (4, "EE-1", 2, True, 2020, None)], schemas.COURSE_DOCS)
    instructors = spark.createDataFrame(
        [(1, "i1", "i1@x", 1), (2, "i2", "i2@x", 1)], schemas.INSTRUCTOR_DOCS)
    departments = spark.createDataFrame([(1, "D1"), (2, "D2")], schemas.DEPARTMENT_DOCS)
    return {"students": students, "courses": courses, "instructors": instructors,
            "departments": departments}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_q2_inner_and_zero_preserving(cols):
    assert rows(Q.q2_mean_enrolment(cols, 2)) == [(2.0,)]
    (v,), = rows(Q.q2_mean_enrolment(cols, 2, include_empty=True))
    assert v == pytest.approx(4 / 3)


def test_q2_unknown_instructor(cols):
    assert rows(Q.q2_mean_enrolment(cols, 99)) == [(None,)]
    assert rows(Q.q2_mean_enrolment(cols, 99, drop_empty=True)) == []


def test_counts_distinct_vs_plain_explode(cols):
    c = membership.membership_counts(cols["students"], "_id", "enrolled_courses",
                                     item_as="course_id", count_as="n")
    assert dict(rows(c)) == {1: 2, 2: 2}
    plain = membership.membership_edges(cols["students"], "_id", "enrolled_courses",
                                        item_as="course_id", distinct=False)
    assert dict(rows(plain.groupBy("course_id").count())) == {1: 3, 2: 2}


def test_q6_top_with_tie_break(cols):
    assert rows(Q.q6_top_courses(cols, 1)) == [(1, "CS-1", 2)]
    assert rows(Q.q6_top_courses(cols, 10, include_empty=True)) == \
        [(1, "CS-1", 2), (2, "CS-2", 2), (3, "CS-3", 0), (4, "EE-1", 0)]


def test_q1_null_and_empty_arrays(cols):
    assert rows(Q.q1_students_in_course(cols, 2)) == [("s1", "s1@x"), ("s5", "s5@x")]
    assert rows(Q.q1_students_in_course(cols, 4)) == []


def test_q5_division_and_empty_divisor(cols):
    assert rows(Q.q5_instructors_teaching_all_core(cols, 1)) == [("i2",)]
    assert rows(Q.q5_instructors_teaching_all_core(cols, 3)) == []
    assert rows(Q.q5_instructors_teaching_all_core(cols, 3, empty_divisor="all")) == [("i1",), ("i2",)]


def test_q5_grouped(cols):
    # department 2's only core course has no instructor: nobody qualifies
    assert rows(Q.q5_grouped(cols)) == [(1, 2)]


def test_division_forms_agree_with_duplicates(spark):
    dividend = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "a"), (3, "b"), (3, "c"), (3, "a")],
        "e long, i string")
    divisor = spark.createDataFrame([("a",), ("b",), ("b",)], "i string")
    a = division.divide(dividend, divisor, "e", "i")
    b = division.divide_by_containment(dividend, divisor, "e", "i")
    assert rows(a) == rows(b) == [(1,), (3,)]


def test_lookup_empty_and_null_safe(spark):
    left = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "k long, f long")
    right = spark.createDataFrame([(10, "x"), (None, "n"), (10, "y")], "f long, v string")
    out = documents.lookup(left, right, "f", "f", "docs")
    sizes = {r["f"]: len(r["docs"]) for r in out.collect()}
    assert sizes == {10: 2, None: 0, 30: 0}
    ns = documents.lookup(left, right, "f", "f", "docs", null_safe=True)
    assert {r["f"]: len(r["docs"]) for r in ns.collect()} == {10: 2, None: 1, 30: 0}


def test_lookup_count_matches_lookup_size(cols):
    a = documents.lookup_in_array(cols["courses"], cols["students"], "_id", "enrolled_courses", "st")
    b = documents.lookup_count(cols["courses"], cols["students"], "_id", "enrolled_courses", "n",
                               foreign_is_array=True)
    assert rows(a.select("_id", F.size("st").cast("long"))) == rows(b.select("_id", "n"))


def test_match_children_any_vs_same(cols):
    conds = [F.col("department_id") == 1, F.col("is_core_course") == F.lit(False)]
    anym = documents.match_children(cols["instructors"], cols["courses"], "_id", "instructor_id", conds)
    same = documents.match_children(cols["instructors"], cols["courses"], "_id", "instructor_id",
                                    [F.col("department_id") == 2, F.col("is_core_course")],
                                    same_element=True)
    assert rows(anym.select("_id")) == [(2,)]
    assert rows(same.select("_id")) == []


def test_embed_missing_vs_empty(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    child = spark.createDataFrame([(1, 5), (1, 3), (1, 5)], "k long, v long")
    miss = dict((r["k"], r["a"]) for r in documents.embed(parent, child, "k", "k", "v", "a").collect())
    emp = dict((r["k"], r["a"]) for r in documents.embed(parent, child, "k", "k", "v", "a",
                                                         empty="empty").collect())
    assert miss == {1: [3, 5, 5]}
    assert emp == {1: [3, 5, 5], 2: []}


def test_integrity_negative_rows(spark):
    d = spark.createDataFrame([(1, "D1"), (1, "D1b"), (2, None)], "department_id int, department_name string")
    s = spark.createDataFrame(
        [(1, "a" * 101, "e1", 1), (2, "b", "e1", 1), (3, "c", "e3", 9)],
        "student_id long, student_name string, student_email string, department_id int")
    t = spark.createDataFrame([(1, 1, 1), (1, 1, 2)], "teaches_id long, course_id long, instructor_id long")
    rep = {(r["table_name"], r["rule"], r["column_name"]): r["violations"]
           for r in integrity.integrity_report({"departments": d, "students": s, "teaches": t}).collect()}
    assert rep[("departments", "primary_key", "department_id")] == 1
    assert rep[("departments", "not_null", "department_name")] == 1
    assert rep[("students", "varchar(100)", "student_name")] == 1
    assert rep[("students", "unique", "student_email")] == 1
    assert rep[("students", "foreign_key:departments", "department_id")] == 1
    assert rep[("teaches", "unique", "course_id")] == 1
    assert rep[("teaches", "primary_key", "teaches_id")] == 1


def test_fk_composite_ignores_nulls(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 7)], "a long, b long")
    parent = spark.createDataFrame([(1, 1)], "x long, y long")
    assert rows(integrity.fk_violations(child, parent, ["a", "b"], ["x", "y"])) == [(3, 7)]


def test_lookup_uncorrelated_keeps_the_array_once(cols):
    core = cols["courses"].filter("department_id = 1 AND is_core_course").select("_id")
    keys, shared = documents.lookup_uncorrelated(cols["instructors"], core, "_id", "all_core")
    assert shared.count() == 1
    assert sorted((r["_id"], [d["_id"] for d in r["all_core"]]) for r in keys.join(shared, "_shared").collect()) == \
        [(1, [1, 2]), (2, [1, 2])]
    keys, shared = documents.lookup_uncorrelated(cols["instructors"], core.filter("_id < 0"), "_id", "x")
    assert [len(r["x"]) for r in keys.join(shared, "_shared").collect()] == [0, 0]
    keys, shared = documents.lookup_uncorrelated(cols["instructors"], core, "_id", "x", max_len=1)
    assert sorted(d["_id"] for r in shared.collect() for d in r["x"]) == [1, 2] and shared.count() == 2


def test_empty_divisors_per_group(spark):
    dividend = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 3, 7), (2, 3, 8)], "g long, e long, i long")
    divisor = spark.createDataFrame([(1, 5), (3, 9)], "g long, i long")
    for f in (division.divide, division.divide_by_containment):
        assert rows(f(dividend, divisor, "e", "i", group="g")) == [(1, 1)]
        assert rows(f(dividend, divisor, "e", "i", group="g", empty_divisor="all")) == [(1, 1), (2, 3)]


def test_every_copy_is_unwound(spark):
    parent = spark.createDataFrame([(1,)], "k long")
    child = spark.createDataFrame([(1, 7)] * 9 + [(1, 8)], "k long, v long")
    side = documents.embed(parent, child, "k", "k", "v", "arr", max_len=2)
    plain = membership.membership_edges(side, "k", "arr", distinct=False)
    assert plain.count() == 10 and membership.membership_edges(side, "k", "arr").count() == 2


def test_set_array_replaces_whole_arrays(spark):
    parent = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    child = spark.createDataFrame([(1, 7), (1, 8), (2, 9), (2, 9)], "k long, v long")
    side = documents.embed(parent, child, "k", "k", "v", "arr", max_len=1)
    new = spark.createDataFrame([(1, 5)], "k long, v long")
    out = documents.set_array(side, parent.filter("k < 2"), new, "k", "k", "v", "arr", max_len=1)
    flat = out.select("k", F.explode("arr").alias("v"))
    assert rows(flat) == [(1, 5), (2, 9), (2, 9)]


def test_key_violation_counts_one_pass(spark):
    df = spark.createDataFrame(
        [(1, "a", "x"), (1, "b", "x"), (2, None, "y"), (3, None, "y"), (4, "c", None), (5, "c", None)],
        "id long, email string, code string")
    out = dict(tuple(r) for r in integrity.key_violation_counts(df, [["id"], ["email"], ["code"]]).collect())
    # id 1 twice; email 'c' twice (NULL emails ignored); code 'x' and 'y' twice (NULL ignored)
    assert out == {0: 1, 1: 1, 2: 2}
