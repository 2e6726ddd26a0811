"""SURVEY §5.1 — the university schema mapped onto the driver's tables, whole.

Fixed mapping (values must match the SQL oracle):

    departments  nation(n_nationkey, n_name)
    instructors  supplier(s_suppkey, s_name, s_nationkey); e-mail 'i<key>@example.edu'
    students     customer(c_custkey, c_name, c_nationkey); e-mail 's<key>@example.edu'
    enrollments  orders ⋈ lineitem → (o_custkey, l_partkey), repeats kept;
                 enrollment_id = l_orderkey * 10 + l_linenumber
    teaches      first claim per l_partkey in (l_shipdate, l_orderkey, l_linenumber, l_suppkey)
                 order, claimant l_suppkey; every course of department 1 is taught by
                 instructor 1; teaches_id = course_id
    courses      part: course_code = p_brand-%06d(p_partkey), department_id = p_partkey % 25,
                 is_core_course = p_size > 25, offering_year = 1998 + p_size % 5

Every line is an enrolment and every part is taught, so the cases of a course or a
student without any are tested on derived rows beside them (``with_unused``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docrel.functions.arrays import zero_pad
from docrel.operators.documents import MAX_LEN, build_collections
from docrel.operators.sampling import first_claim
from docrel.sources.io import read_table

# Fixed values of the mapping.
N_DEPARTMENTS_FOR_COURSES = 25
OVERRIDE_DEPARTMENT = 1
OVERRIDE_INSTRUCTOR = 1
CORE_MIN_SIZE = 25
FIRST_YEAR = 1998
N_YEARS = 5

UNUSED_OFFSET = 1 << 40  # ids of derived rows that nothing refers to

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def load(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: read_table(spark, f"{sf_dir}/{n}.parquet") for n in names}


def teaches_claims(lineitem: DataFrame) -> DataFrame:
    """WIN-3 over lineitem: (course_id, instructor_id), before the override."""
    claims = lineitem.select(F.col("l_partkey").alias("course_id"), "l_shipdate", "l_orderkey",
                             "l_linenumber", F.col("l_suppkey").alias("instructor_id"))
    return first_claim(claims, "course_id", "instructor_id",
                       ["l_shipdate", "l_orderkey", "l_linenumber"])


def with_unused(df: DataFrame, key: str, **changes) -> DataFrame:
    """``df`` and a copy of every row under an id that no link refers to, with
    ``changes`` of its columns: planned courses, applicants."""
    copy = df.withColumn(key, F.col(key) + F.lit(UNUSED_OFFSET))
    for c, v in changes.items():
        copy = copy.withColumn(c, v)
    return df.unionByName(copy.select(*df.columns))


def relational(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six relational tables."""
    departments = raw["nation"].select(F.col("n_nationkey").alias("department_id"),
                                       F.col("n_name").alias("department_name"))
    instructors = raw["supplier"].select(
        F.col("s_suppkey").alias("instructor_id"), F.col("s_name").alias("instructor_name"),
        F.concat(F.lit("i"), F.col("s_suppkey").cast("string"), F.lit("@example.edu"))
        .alias("instructor_email"),
        F.col("s_nationkey").alias("department_id"))
    students = raw["customer"].select(
        F.col("c_custkey").alias("student_id"), F.col("c_name").alias("student_name"),
        F.concat(F.lit("s"), F.col("c_custkey").cast("string"), F.lit("@example.edu"))
        .alias("student_email"),
        F.col("c_nationkey").alias("department_id"))
    courses = raw["part"].select(
        F.col("p_partkey").alias("course_id"),
        zero_pad(F.col("p_brand"), F.col("p_partkey"), 6).alias("course_code"),
        (F.col("p_partkey") % N_DEPARTMENTS_FOR_COURSES).cast("int").alias("department_id"),
        (F.col("p_size") > CORE_MIN_SIZE).alias("is_core_course"),
        (F.lit(FIRST_YEAR) + F.col("p_size") % N_YEARS).cast("int").alias("offering_year"))
    dept1 = courses.filter(F.col("department_id") == OVERRIDE_DEPARTMENT).select(
        "course_id", F.lit(OVERRIDE_INSTRUCTOR).cast("long").alias("instructor_id"))
    teaches = teaches_claims(raw["lineitem"]) \
        .join(dept1.select("course_id"), "course_id", "left_anti").unionByName(dept1) \
        .select(F.col("course_id").alias("teaches_id"), "course_id", "instructor_id")
    li = raw["lineitem"].select("l_orderkey", F.col("l_partkey").alias("course_id"), (
        F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("enrollment_id"))
    enrollments = li.join(raw["orders"].select("o_orderkey", "o_custkey"),
                          li["l_orderkey"] == F.col("o_orderkey")) \
                    .select("enrollment_id", F.col("o_custkey").alias("student_id"), "course_id")
    return {"departments": departments, "students": students, "instructors": instructors,
            "courses": courses, "teaches": teaches, "enrollments": enrollments}


def collections(spark: SparkSession, sf_dir: str, max_array: int = MAX_LEN) -> dict[str, DataFrame]:
    """The collections (Q-7 applied to the mapped tables)."""
    return build_collections(relational(load(spark, sf_dir)), max_array=max_array)
