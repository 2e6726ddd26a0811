"""SCH-1 — explicit schemas for the six relational tables and four collections.

Reading with a declared schema avoids a sampling pass at load time and pins the
types that the queries rely on (ids are LONG so they hold keys of any size).
The rule tables below are the declared constraints; ``operators.integrity``
turns them into distributed checks.
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.LongType()
DEPT = T.IntegerType()


def _s(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# Relational side -------------------------------------------------------------
DEPARTMENTS = _s(("department_id", DEPT, False), ("department_name", T.StringType(), False))
STUDENTS = _s(("student_id", ID, False), ("student_name", T.StringType(), False),
              ("student_email", T.StringType(), False), ("department_id", DEPT, False))
INSTRUCTORS = _s(("instructor_id", ID, False), ("instructor_name", T.StringType(), False),
                 ("instructor_email", T.StringType(), False), ("department_id", DEPT, False))
COURSES = _s(("course_id", ID, False), ("course_code", T.StringType(), False),
             ("department_id", DEPT, False), ("is_core_course", T.BooleanType(), False),
             ("offering_year", T.IntegerType(), False))
TEACHES = _s(("teaches_id", ID, False), ("course_id", ID, False), ("instructor_id", ID, False))
ENROLLMENTS = _s(("enrollment_id", ID, False), ("student_id", ID, False), ("course_id", ID, False))

RELATIONAL = {
    "departments": DEPARTMENTS, "students": STUDENTS, "instructors": INSTRUCTORS,
    "courses": COURSES, "teaches": TEACHES, "enrollments": ENROLLMENTS,
}

# Document side ---------------------------------------------------------------
DEPARTMENT_DOCS = _s(("_id", DEPT, False), ("department_name", T.StringType(), True))
STUDENT_DOCS = _s(("_id", ID, False), ("student_name", T.StringType(), True),
                  ("student_email", T.StringType(), True), ("department_id", DEPT, True))
#: Side collection of the students' array (``operators.documents``).
ENROLLED_DOCS = _s(("_id", ID, False), ("_chunk", T.LongType(), False),
                   ("enrolled_courses", T.ArrayType(ID, True), True))
#: Students as a document store may hold them, with the array inline.
STUDENT_DOCS_INLINE = T.StructType(STUDENT_DOCS.fields + [ENROLLED_DOCS.fields[2]])
INSTRUCTOR_DOCS = _s(("_id", ID, False), ("instructor_name", T.StringType(), True),
                     ("instructor_email", T.StringType(), True), ("department_id", DEPT, True))
COURSE_DOCS = _s(("_id", ID, False), ("course_code", T.StringType(), True),
                 ("department_id", DEPT, True), ("is_core_course", T.BooleanType(), True),
                 ("offering_year", T.IntegerType(), True), ("instructor_id", ID, True))

COLLECTIONS = {
    "departments": DEPARTMENT_DOCS, "students": STUDENT_DOCS, "enrolled": ENROLLED_DOCS,
    "instructors": INSTRUCTOR_DOCS, "courses": COURSE_DOCS,
}

# Declared constraints of the relational schema (fixed values) -----------------
# VARCHAR(n) limits per column.
VARCHAR_LIMITS = {
    "departments": {"department_name": 100},
    "students": {"student_name": 100, "student_email": 100},
    "instructors": {"instructor_name": 100, "instructor_email": 100},
    "courses": {"course_code": 20},
}
PRIMARY_KEYS = {
    "departments": ["department_id"], "students": ["student_id"],
    "instructors": ["instructor_id"], "courses": ["course_id"],
    "teaches": ["teaches_id"], "enrollments": ["enrollment_id"],
}
UNIQUE_KEYS = {
    "students": [["student_email"]], "instructors": [["instructor_email"]],
    "courses": [["course_code"]], "teaches": [["course_id"]],
}
# child table -> list of (child columns, parent table, parent columns)
FOREIGN_KEYS = {
    "students": [(["department_id"], "departments", ["department_id"])],
    "instructors": [(["department_id"], "departments", ["department_id"])],
    "courses": [(["department_id"], "departments", ["department_id"])],
    "teaches": [(["instructor_id"], "instructors", ["instructor_id"]),
                (["course_id"], "courses", ["course_id"])],
    "enrollments": [(["student_id"], "students", ["student_id"]),
                    (["course_id"], "courses", ["course_id"])],
}


def not_null_columns(table: str) -> list[str]:
    """Columns declared NOT NULL (every relational column is)."""
    return [f.name for f in RELATIONAL[table].fields if not f.nullable]
