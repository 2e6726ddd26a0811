"""The six end-to-end queries over the collections.

``cols`` is the dict returned by ``build_collections`` (or read back from
storage): ``departments, students, instructors, courses`` and ``enrolled``, the
side collection of the students' arrays (without it, ``students`` must hold
``enrolled_courses`` inline).  Each function returns a lazy DataFrame; options
select between the variants the reference disagrees on (SURVEY §2.11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docrel.operators.division import divide
from docrel.operators.documents import array_rows, match_children
from docrel.operators.grouping import (attach_scalar, count_per_group, first_per_key, mean_of_counts,
                                       scalar_count, top_k)
from docrel.operators.membership import membership_edges, membership_filter


def enrollment_edges(cols: dict[str, DataFrame]) -> DataFrame:
    """Distinct (student_id, course_id) pairs from the embedded arrays."""
    return membership_edges(array_rows(cols), "_id", "enrolled_courses",
                            owner_as="student_id", item_as="course_id")


def q1_students_in_course(cols: dict[str, DataFrame], course_id: int = 15, *,
                          with_id: bool = False) -> DataFrame:
    """Q-1 — name and e-mail of the students enrolled in ``course_id``; with
    ``with_id`` also ``_id``, which a document projection keeps."""
    hit = membership_filter(array_rows(cols), "enrolled_courses", course_id).select("_id")
    out = cols["students"].join(hit, "_id", "left_semi")
    return out.select(*(["_id"] if with_id else []), "student_name", "student_email")


def q2_mean_enrolment(cols: dict[str, DataFrame], instructor_id: int = 2, *,
                      include_empty: bool = False, drop_empty: bool = False) -> DataFrame:
    """Q-2 — mean number of students over the courses taught by ``instructor_id``.

    ``include_empty=False``: courses without students do not count (Spark
    baseline); ``True``: they count as 0 (pipeline).  ``drop_empty=True``: no
    row at all when the instructor teaches nothing (pipeline) instead of a
    NULL mean (SQL).

    Edges are counted per course first (partial aggregation, skew-safe); the
    counts meet the instructor's courses on their key.
    """
    taught = cols["courses"].filter(F.col("instructor_id") == instructor_id).select("_id")
    counts = count_per_group(enrollment_edges(cols), "course_id", "num_students")
    if include_empty:
        counts = taught.join(counts, taught["_id"] == counts["course_id"], "left") \
            .select(F.coalesce("num_students", F.lit(0).cast("long")).alias("num_students"))
    else:
        counts = counts.join(taught, counts["course_id"] == taught["_id"], "left_semi")
    return mean_of_counts(counts, "num_students", "average_students", drop_empty=drop_empty)


def q3_department_courses(cols: dict[str, DataFrame], department_id: int = 1) -> DataFrame:
    """Q-3 — one row per course code of a department (smallest ``_id`` kept)."""
    c = cols["courses"].filter(F.col("department_id") == department_id) \
        .select("course_code", "department_id", "is_core_course", "_id")
    return first_per_key(c, ["course_code"], ["_id"]).drop("_id")


def q4_students_per_department(cols: dict[str, DataFrame]) -> DataFrame:
    """Q-4 — number of students per department, with the department name."""
    counts = count_per_group(cols["students"], "department_id", "total_students")
    d = cols["departments"]
    return counts.join(d, counts["department_id"] == d["_id"]) \
        .select("department_name", "total_students")


def q5_instructors_teaching_all_core(cols: dict[str, DataFrame], department_id: int = 1, *,
                                     empty_divisor: str = "none") -> DataFrame:
    """Q-5 — instructors who teach every core course of ``department_id``
    (relational division by counts)."""
    courses = cols["courses"]
    core = courses.filter((F.col("department_id") == department_id) & F.col("is_core_course")) \
        .select(F.col("_id").alias("course_id"))
    taught = courses.filter(F.col("instructor_id").isNotNull()) \
        .select("instructor_id", F.col("_id").alias("course_id"))
    ins = cols["instructors"]
    # a course document names one instructor, and _id is the key: pairs and
    # divisor rows are unique
    hit = divide(taught, core, "instructor_id", "course_id", empty_divisor=empty_divisor,
                 entities=ins.select(F.col("_id").alias("instructor_id")), unique_pairs=True,
                 unique_divisor=True)
    return ins.join(hit, ins["_id"] == hit["instructor_id"], "left_semi").select("instructor_name")


def q5_pipeline(cols: dict[str, DataFrame], department_id: int = 1) -> DataFrame:
    """Q-5 as the document pipeline reads it: (_id, instructor_name, n_taught, n_core).

    Instructors with a taught course in the department and a core course (not
    necessarily the same one) whose taught courses, of any department, include
    every core course of the department.  Without core courses the subset test
    holds for all of them.  The pipeline's arrays are answered by their sizes.
    """
    courses, ins = cols["courses"], cols["instructors"]
    pre = match_children(ins, courses, "_id", "instructor_id",
                         [F.col("department_id") == department_id, F.col("is_core_course")])
    core = courses.filter((F.col("department_id") == department_id) & F.col("is_core_course"))
    taught = courses.filter(F.col("instructor_id").isNotNull()) \
        .select("instructor_id", F.col("_id").alias("course_id"))
    hit = divide(taught, core.select(F.col("_id").alias("course_id")), "instructor_id", "course_id",
                 empty_divisor="all", entities=pre.select(F.col("_id").alias("instructor_id")),
                 unique_pairs=True, unique_divisor=True)
    per = count_per_group(taught, "instructor_id", "n_taught")
    out = pre.join(hit, pre["_id"] == hit["instructor_id"], "left_semi") \
             .join(per, pre["_id"] == per["instructor_id"]).select("_id", "instructor_name", "n_taught")
    return attach_scalar(out, scalar_count(core, "n_core"))


def q5_grouped(cols: dict[str, DataFrame], *, empty_divisor: str = "none") -> DataFrame:
    """Q-5 for every department at once: (department_id, instructor_id), of the
    courses that the instructor teaches there."""
    courses = cols["courses"]
    core = courses.filter(F.col("is_core_course")) \
        .select("department_id", F.col("_id").alias("course_id"))
    taught = courses.filter(F.col("instructor_id").isNotNull()) \
        .select("department_id", "instructor_id", F.col("_id").alias("course_id"))
    return divide(taught, core, "instructor_id", "course_id", group="department_id",
                  empty_divisor=empty_divisor, unique_pairs=True, unique_divisor=True)


def q6_top_courses(cols: dict[str, DataFrame], k: int | None = 10, *,
                   include_empty: bool = False) -> DataFrame:
    """Q-6 — the ``k`` courses with most students (``None``: all); ties broken by ``_id``.

    Students are counted per course on the edge table first (PHY-7), then the
    counts meet the courses on their unique key, then a top-k keeps k rows
    per task.
    """
    counts = count_per_group(enrollment_edges(cols), "course_id", "num_enrollments")
    c = cols["courses"].select("_id", "course_code")
    j = c.join(counts, c["_id"] == counts["course_id"], "left" if include_empty else "inner")
    j = j.select("_id", "course_code",
                 F.coalesce("num_enrollments", F.lit(0).cast("long")).alias("num_enrollments"))
    return j if k is None else top_k(j, F.col("num_enrollments").desc(), k, F.col("_id").asc())
