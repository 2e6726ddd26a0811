"""Independent SQL (DuckDB dialect) for every registered query.

The views ``nation supplier customer part orders lineitem region`` are the
driver's tables; the CTE block ``BASE`` restates the §5.1 mapping in plain SQL
(window ``row_number`` where Spark uses ``min_by``, ``NOT EXISTS`` where Spark
uses anti joins, counts where Spark unwinds arrays), so the two sides share no
code path.
"""

from __future__ import annotations

from docrel import schemas
from docrel.plans import registry as R


def md5i(*parts: str) -> str:
    inner = ", ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST(('0x' || substr(md5(concat_ws('|', {inner})), 1, 8)) AS BIGINT)"


BASE = """
WITH
departments AS (SELECT n_nationkey AS _id, n_name AS department_name FROM nation),
instructors AS (
  SELECT s_suppkey AS _id, s_name AS instructor_name,
         'i' || CAST(s_suppkey AS VARCHAR) || '@example.edu' AS instructor_email,
         s_nationkey AS department_id
  FROM supplier),
students AS (
  SELECT c_custkey AS _id, c_name AS student_name,
         's' || CAST(c_custkey AS VARCHAR) || '@example.edu' AS student_email,
         c_nationkey AS department_id
  FROM customer),
rel_courses AS (
  SELECT p_partkey AS course_id, printf('%s-%06d', p_brand, p_partkey) AS course_code,
         CAST(p_partkey % 25 AS INTEGER) AS department_id, p_size > 25 AS is_core_course,
         CAST(1998 + p_size % 5 AS INTEGER) AS offering_year
  FROM part),
claims AS (
  SELECT course_id, instructor_id FROM (
    SELECT l_partkey AS course_id, l_suppkey AS instructor_id,
           row_number() OVER (PARTITION BY l_partkey
                              ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey) AS rn
    FROM lineitem) x
  WHERE rn = 1),
teaches AS (
  SELECT course_id AS teaches_id, course_id, instructor_id FROM claims WHERE course_id % 25 <> 1
  UNION ALL
  SELECT course_id, course_id, CAST(1 AS BIGINT) FROM rel_courses WHERE department_id = 1),
courses AS (
  SELECT c.course_id AS _id, c.course_code, c.department_id, c.is_core_course, c.offering_year,
         i._id AS instructor_id
  FROM rel_courses c
  LEFT JOIN teaches t ON t.course_id = c.course_id
  LEFT JOIN instructors i ON i._id = t.instructor_id),
enrollments AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS enrollment_id, o.o_custkey AS student_id,
         l.l_partkey AS course_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
planned AS (  -- courses, and a copy of each that nobody teaches or takes
  SELECT * FROM courses
  UNION ALL SELECT _id + 1099511627776, course_code, department_id, is_core_course, offering_year, NULL
  FROM courses),
applicants AS (
  SELECT * FROM students
  UNION ALL SELECT _id + 1099511627776, student_name, student_email, department_id FROM students),
edges AS (SELECT DISTINCT student_id, course_id FROM enrollments),
course_counts AS (SELECT course_id, count(*) AS num_enrollments FROM edges GROUP BY course_id),
in_departments AS (
  SELECT e.student_id FROM edges e JOIN rel_courses c ON c.course_id = e.course_id
  WHERE c.department_id IN (1, 2, 3) GROUP BY e.student_id HAVING count(DISTINCT c.department_id) = 3),
rel_departments AS (SELECT _id AS department_id, department_name FROM departments),
rel_students AS (SELECT _id AS student_id, student_name, student_email, department_id FROM students),
rel_instructors AS (SELECT _id AS instructor_id, instructor_name, instructor_email, department_id
                    FROM instructors)
"""

REGION_CASE = "CASE r.r_name " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in R.REGION_CODES.items()) + " END"

def chunked(pairs: str, key: str, val: str, max_len: int) -> str:
    """Rows ``(key, val, _chunk)`` of the bucket pattern over a pairs subquery.
    The first ``max_len`` copies of a value go to its home chunk: 0 if the key
    has at most ``max_len`` home copies in all or for its smallest value, else
    md5(value) mod ceil(n / max_len); copy r > max_len goes to overflow chunk
    -(md5(value) * 2^30 + (r - 1) // max_len)."""
    m = max_len
    nch = f"CAST(ceil(st.n / {m}) AS BIGINT)"
    h = md5i("p." + val)
    return f"""(
  SELECT p.{key}, p.{val},
         CASE WHEN p._rn > {m} THEN -({h} * {1 << 30} + (p._rn - 1) // {m})
              WHEN {nch} <= 1 OR p.{val} = st.hmin THEN 0
              ELSE {h} % {nch} END AS _chunk
  FROM (SELECT {key}, {val}, row_number() OVER (PARTITION BY {key}, {val}) AS _rn
        FROM ({pairs}) q0) p
  JOIN (SELECT {key}, sum(least(c, {m})) AS n, min({val}) AS hmin
        FROM (SELECT {key}, {val}, count(*) AS c FROM ({pairs}) q GROUP BY {key}, {val}) q1
        GROUP BY {key}) st
    ON st.{key} = p.{key})"""


def student_flat(max_len: int) -> str:
    c = chunked("SELECT student_id, course_id FROM enrollments", "student_id", "course_id", max_len)
    return f"""
SELECT s._id, coalesce(c._chunk, 0) AS _chunk, s.student_name, s.student_email, s.department_id,
       count(c.course_id) AS n_courses,
       string_agg(CAST(c.course_id AS VARCHAR), ',' ORDER BY c.course_id) AS courses
FROM students s LEFT JOIN {c} c ON c.student_id = s._id
GROUP BY s._id, c._chunk, s.student_name, s.student_email, s.department_id
"""


STUDENT_FLAT = student_flat(R.documents.MAX_LEN)

Q1 = f"""
SELECT s.student_name, s.student_email FROM students s
WHERE s._id IN (SELECT student_id FROM enrollments WHERE course_id = {R.COURSE_Q1})
"""

Q1_ID = f"""
SELECT s._id, s.student_name, s.student_email FROM students s
WHERE s._id IN (SELECT student_id FROM enrollments WHERE course_id = {R.COURSE_Q1})
"""

Q3 = f"""
SELECT course_code, department_id, is_core_course FROM (
  SELECT *, row_number() OVER (PARTITION BY course_code ORDER BY _id) AS rn
  FROM courses WHERE department_id = {R.DEPARTMENT_Q3}) x
WHERE rn = 1
"""

Q4 = """
SELECT d.department_name, count(*) AS total_students
FROM students s JOIN departments d ON d._id = s.department_id
GROUP BY d._id, d.department_name
"""

Q5 = f"""
, core AS (SELECT _id FROM courses WHERE department_id = {R.DEPARTMENT_Q3} AND is_core_course)
SELECT i.instructor_name FROM instructors i
WHERE i._id IN (
  SELECT c.instructor_id FROM courses c JOIN core ON core._id = c._id
  WHERE c.instructor_id IS NOT NULL
  GROUP BY c.instructor_id
  HAVING count(DISTINCT c._id) = (SELECT count(*) FROM core))
"""

Q6 = """
SELECT c._id, c.course_code, x.num_enrollments
FROM courses c JOIN course_counts x ON x.course_id = c._id
ORDER BY x.num_enrollments DESC, c._id
LIMIT 10
"""

COURSES_ALL = """
SELECT _id, course_code, department_id, is_core_course, offering_year, instructor_id FROM courses
"""

Q2_INNER = """
SELECT avg(x.num_enrollments) AS average_students
FROM course_counts x JOIN courses c ON c._id = x.course_id
WHERE c.instructor_id = {ins}
"""


def _sample_sql(k_expr: str, k_max: int, entity: str = "student_id", table: str = "students") -> str:
    """Sequential selection without replacement, unrolled for ``k_max`` draws."""
    seed = R.SEED
    steps = []
    prev = "ents"
    for j in range(k_max):
        r = f"{md5i(str(seed), entity, str(j))} % (m - {j})"
        if j == 0:
            mapped = f"r{j}"
        else:
            sort = "list_sort([" + ", ".join(f"p{i}" for i in range(j)) + "])"
            v = f"r{j}"
            for i in range(1, j + 1):
                v = f"({v} + CASE WHEN {v} >= s{j}[{i}] THEN 1 ELSE 0 END)"
            mapped = v
            steps.append(f"a{j} AS (SELECT *, {sort} AS s{j} FROM {prev})")
            prev = f"a{j}"
        steps.append(f"b{j} AS (SELECT *, CASE WHEN {j} < n THEN {r} END AS r{j} FROM {prev})")
        steps.append(f"d{j} AS (SELECT *, CASE WHEN {j} < n THEN {mapped} END AS p{j} FROM b{j})")
        prev = f"d{j}"
    picks = ", ".join(f"p{j}" for j in range(k_max))
    return f"""
, items AS (
  SELECT department_id, _id AS course_id,
         row_number() OVER (PARTITION BY department_id ORDER BY _id) - 1 AS idx,
         count(*) OVER (PARTITION BY department_id) AS m
  FROM courses),
sizes AS (SELECT DISTINCT department_id, m FROM items),
ents AS (
  SELECT s._id AS {entity}, s.department_id, z.m, least(CAST({k_expr} AS BIGINT), z.m) AS n
  FROM {table} s JOIN sizes z ON z.department_id = s.department_id),
{", ".join(steps)},
picks AS (SELECT {entity}, department_id, unnest([{picks}]) AS idx FROM {prev}),
drawn AS (
  SELECT p.{entity}, i.course_id
  FROM picks p JOIN items i ON i.department_id = p.department_id AND i.idx = p.idx)
"""


def _k_range_expr(key: str) -> str:
    lo, hi = R.SAMPLE_K_RANGE
    return f"CAST({lo} + {md5i(str(R.SEED), key)} % {hi - lo + 1} AS INTEGER)"


def _report_sql() -> str:
    parts = []
    for t, schema in schemas.RELATIONAL.items():
        rel = f"rel_{t}" if t in ("departments", "students", "instructors", "courses") else t
        for c in schemas.not_null_columns(t):
            parts.append(f"SELECT '{t}' AS table_name, 'not_null' AS rule, '{c}' AS column_name, "
                         f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS violations FROM {rel}")
        for c, n in schemas.VARCHAR_LIMITS.get(t, {}).items():
            parts.append(f"SELECT '{t}', 'varchar({n})', '{c}', "
                         f"CAST(count(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) FROM {rel}")
        keysets = ([("primary_key", schemas.PRIMARY_KEYS[t])] if t in schemas.PRIMARY_KEYS else []) \
            + [("unique", u) for u in schemas.UNIQUE_KEYS.get(t, [])]
        for rule, keys in keysets:
            k = ", ".join(keys)
            nn = " AND ".join(f"{x} IS NOT NULL" for x in keys)
            parts.append(f"SELECT '{t}', '{rule}', '{','.join(keys)}', CAST(count(*) AS BIGINT) FROM "
                         f"(SELECT {k} FROM {rel} WHERE {nn} GROUP BY {k} HAVING count(*) > 1) v")
        for ccols, pt, pcols in schemas.FOREIGN_KEYS.get(t, []):
            prel = f"rel_{pt}" if pt in ("departments", "students", "instructors", "courses") else pt
            nn = " AND ".join(f"c.{x} IS NOT NULL" for x in ccols)
            eq = " AND ".join(f"p.{pc} = c.{cc}" for cc, pc in zip(ccols, pcols))
            parts.append(f"SELECT '{t}', 'foreign_key:{pt}', '{','.join(ccols)}', CAST(count(*) AS BIGINT) "
                         f"FROM {rel} c WHERE {nn} AND NOT EXISTS (SELECT 1 FROM {prel} p WHERE {eq})")
    return "\nUNION ALL\n".join(parts)


DIVISION_DIVIDEND = """
, dividend AS (
  SELECT DISTINCT o.o_custkey AS c_custkey, p.p_type
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON p.p_partkey = l.l_partkey)
"""

SQL: dict[str, str] = {
    "q_1": Q1,
    "q_1_id": Q1_ID,
    "q_5_pipeline": f"""
, core AS (SELECT _id FROM courses WHERE department_id = {R.DEPARTMENT_Q3} AND is_core_course)
SELECT i._id, i.instructor_name,
       (SELECT count(*) FROM courses c WHERE c.instructor_id = i._id) AS n_taught,
       (SELECT count(*) FROM core) AS n_core
FROM instructors i
WHERE EXISTS (SELECT 1 FROM courses c WHERE c.instructor_id = i._id AND c.department_id = {R.DEPARTMENT_Q3})
  AND EXISTS (SELECT 1 FROM courses c WHERE c.instructor_id = i._id AND c.is_core_course)
  AND NOT EXISTS (SELECT 1 FROM core k WHERE k._id NOT IN
                  (SELECT c._id FROM courses c WHERE c.instructor_id = i._id))
""",
    "q_6_zero": f"""
SELECT c._id, c.course_code, coalesce(x.num_enrollments, 0) AS num_enrollments
FROM planned c LEFT JOIN course_counts x ON x.course_id = c._id
""",
    "q_2": Q2_INNER.format(ins=R.INSTRUCTOR_Q2),
    "q_2_zero": f"""
SELECT avg(coalesce(x.num_enrollments, 0)) AS average_students
FROM courses c LEFT JOIN course_counts x ON x.course_id = c._id
WHERE c.instructor_id = {R.INSTRUCTOR_Q2}
""",
    "q_3": Q3,
    "q_4": Q4,
    "q_5": Q5,
    "q_5_grouped": """
, need AS (SELECT department_id, count(*) AS need FROM courses WHERE is_core_course GROUP BY department_id)
SELECT c.department_id, c.instructor_id
FROM courses c JOIN need n ON n.department_id = c.department_id
WHERE c.is_core_course AND c.instructor_id IS NOT NULL
GROUP BY c.department_id, c.instructor_id, n.need
HAVING count(DISTINCT c._id) = n.need
""",
    "q_6": Q6,
    "q_7": STUDENT_FLAT,
    "q_7_chunked": student_flat(R.SMALL_ARRAY),
    "q_7_overflow": student_flat(R.TINY_ARRAY),
    "q_7_indexed": """
SELECT 'index' AS kind, course_id AS part, student_id AS id, '' AS label FROM edges
UNION ALL SELECT 'students', department_id, _id, student_email FROM students
UNION ALL SELECT 'instructors', department_id, _id, instructor_email FROM instructors
UNION ALL SELECT 'courses', department_id, _id, course_code FROM courses
""",
    "q_7_courses": COURSES_ALL,
    "q_7_roundtrip": "SELECT student_id, course_id, count(*) AS n FROM enrollments GROUP BY student_id, course_id",
    "src_1_collection": STUDENT_FLAT,
    "src_3_tables": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "snk_1_refresh": COURSES_ALL,
    "snk_2_absent": """
SELECT _id, student_name, department_id FROM students WHERE department_id < 13
UNION ALL
SELECT _id, student_name || ' (new)', department_id FROM students WHERE department_id >= 13
""",
    "snk_2_pruned": """
SELECT _id, student_name, department_id FROM students WHERE department_id < 13
UNION ALL
SELECT _id, student_name || ' (new)', department_id FROM students WHERE department_id >= 13
""",
    "snk_2_bucketed": """
SELECT _id, student_name, department_id FROM students WHERE department_id < 13
UNION ALL
SELECT _id, student_name || ' (new)', department_id FROM students WHERE department_id >= 13
UNION ALL SELECT NULL, 'nobody', max(department_id) FROM students
""",
    "src_1_variant": """
SELECT field, state, count(*) AS n FROM (
  SELECT f.field, CASE
    WHEN _id % 97 = 0 THEN 'malformed'
    WHEN f.field = '_id' THEN 'scalar'
    WHEN f.field = 'department_id' THEN CASE WHEN department_id < 5 THEN 'object' ELSE 'scalar' END
    ELSE CASE _id % 5 WHEN 0 THEN 'missing' WHEN 1 THEN 'null' WHEN 2 THEN 'empty_array'
                      WHEN 3 THEN 'array' ELSE 'scalar' END END AS state
  FROM students, (VALUES ('_id'), ('department_id'), ('enrolled_courses')) f(field)) x
GROUP BY field, state
""",
    "src_2_split": """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE l_linenumber = 7) AS null_rows, 1 AS null_parts, true AS balanced
FROM lineitem
""",
    "snk_3_partition": """
SELECT c_custkey AS _id, CASE WHEN c_acctbal > 5000 AND c_nationkey < 5 THEN lower(c_mktsegment)
       ELSE c_mktsegment END AS segment, c_nationkey AS nation
FROM customer
""",
    "sch_2_load": _report_sql(),
    "sch_5_serial": """
SELECT o_orderkey, row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END,
                                      o_orderdate, o_orderkey) AS order_id
FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')
""",
    "join_8_correlated": f"""
SELECT i._id, count(x.course_id) AS n_newest,
       coalesce(string_agg(CAST(x.course_id AS VARCHAR), ',' ORDER BY x.place), '') AS course_ids
FROM instructors i LEFT JOIN (
  SELECT n._id AS iid, c._id AS course_id,
         row_number() OVER (PARTITION BY n._id ORDER BY c.offering_year DESC, c._id) AS place
  FROM instructors n JOIN courses c ON c.instructor_id = n._id AND c.department_id = n.department_id
   AND c.is_core_course) x ON x.iid = i._id AND x.place <= {R.NEWEST}
GROUP BY i._id
""",
    "phy_5_bucketed": """
SELECT c_custkey AS _id, c_name AS student_name, count(*) AS n_orders, max(o_totalprice) AS largest
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name
""",
    "phy_5_lookup": f"""
SELECT _id, student_name, student_email FROM students WHERE student_email = '{R.EMAIL_LOOKUP}'
""",
    "phy_6_bitmaps": f"""
SELECT 'any' AS reading, student_id FROM edges WHERE course_id IN {R.ANY_COURSES} GROUP BY student_id
UNION ALL
SELECT 'any_count', count(DISTINCT student_id) FROM edges WHERE course_id IN {R.ANY_COURSES}
UNION ALL
SELECT 'all', student_id FROM in_departments
UNION ALL
SELECT 'all_count', count(*) FROM in_departments
""",
    "snk_2_stream": """
SELECT _id, student_name, department_id FROM students WHERE department_id < 13
UNION ALL
SELECT _id, student_name || ' (new)', department_id FROM students WHERE department_id >= 13
""",
    "snk_3_update": """
SELECT c_custkey AS _id,
       CASE WHEN c_acctbal > 5000 THEN lower(c_mktsegment) ELSE c_mktsegment END AS segment
FROM customer
""",
    "snk_3_array": """
SELECT e.student_id, e.course_id, CASE WHEN s.department_id < 5 THEN 1 ELSE count(*) END AS n
FROM enrollments e JOIN students s ON s._id = e.student_id
GROUP BY e.student_id, e.course_id, s.department_id
""",
    "snk_4_csv": r"""
SELECT _id, CASE offering_year WHEN 1998 THEN '' WHEN 1999 THEN NULL
                 WHEN 2000 THEN course_code || chr(10) || '"a", ''b'' \ '
                 WHEN 2001 THEN ' ' || course_code || chr(13) || chr(10) ELSE course_code END AS course_code,
       department_id, is_core_course, offering_year, instructor_id FROM courses
""",
    "sch_2_notnull": """
SELECT 'courses' AS table_name, 'not_null' AS rule, 'course_code' AS column_name,
       CAST(count(*) FILTER (WHERE course_code IS NULL) AS BIGINT) AS violations FROM planned
UNION ALL SELECT 'courses', 'not_null', 'instructor_id',
       CAST(count(*) FILTER (WHERE instructor_id IS NULL) AS BIGINT) FROM planned
UNION ALL SELECT 'courses', 'varchar(14)', 'course_code',
       CAST(count(*) FILTER (WHERE length(course_code) > 14) AS BIGINT) FROM planned
UNION ALL SELECT 'students', 'not_null', 'enrolled_courses',
       CAST(count(*) FILTER (WHERE _id NOT IN (SELECT student_id FROM enrollments)) AS BIGINT) FROM applicants
UNION ALL SELECT 'students', 'varchar(18)', 'student_name',
       CAST(count(*) FILTER (WHERE length(student_name) > 18) AS BIGINT) FROM applicants
UNION ALL SELECT 'students', 'varchar(10)', 'student_email',
       CAST(count(*) FILTER (WHERE length(student_email) > 10) AS BIGINT) FROM applicants
""",
    "sch_3_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
    "sch_3_report": _report_sql(),
    "sch_4_fk": """
SELECT c._id, c.instructor_id FROM courses c
WHERE c.instructor_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM claims t WHERE t.course_id = c._id AND t.instructor_id = c.instructor_id)
""",
    "sch_5_ids": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS order_id FROM orders",
    "flt_1": f"""
SELECT s._id, s.student_name, s.department_id FROM students s
WHERE EXISTS (SELECT 1 FROM enrollments e WHERE e.student_id = s._id AND e.course_id = {R.COURSE_FLT1})
""",
    "flt_2": f"SELECT _id, course_code FROM courses WHERE instructor_id = {R.INSTRUCTOR_Q2}",
    "flt_3": f"SELECT _id, course_code FROM courses WHERE department_id = {R.DEPARTMENT_Q3} AND is_core_course",
    "flt_5": f"""
SELECT course_id, count(*) AS num_students FROM edges GROUP BY course_id
HAVING count(*) >= {R.MIN_STUDENTS_FLT5}
""",
    "flt_4_any": f"""
SELECT i._id, i.instructor_name FROM instructors i
WHERE EXISTS (SELECT 1 FROM courses c WHERE c.instructor_id = i._id AND c.department_id = {R.DEPARTMENT_FLT4})
  AND EXISTS (SELECT 1 FROM courses c WHERE c.instructor_id = i._id AND c.is_core_course)
""",
    "flt_4_same": f"""
SELECT i._id, i.instructor_name FROM instructors i
WHERE EXISTS (SELECT 1 FROM courses c WHERE c.instructor_id = i._id
              AND c.department_id = {R.DEPARTMENT_FLT4} AND c.is_core_course)
""",
    "prj_1_3": "SELECT course_code AS code, department_id AS dept FROM courses",
    "prj_5": "SELECT _id, split_part(course_code, '-', 1) AS code_prefix, offering_year >= 2001 AS is_recent FROM courses",
    "join_1_membership": """
SELECT e.course_id, c.course_code, e.student_id, s.student_name
FROM edges e JOIN courses c ON c._id = e.course_id JOIN students s ON s._id = e.student_id
""",
    "join_1_left": """
SELECT c._id AS course_id, c.course_code, e.student_id FROM planned c LEFT JOIN edges e ON e.course_id = c._id
""",
    "join_6_null": "SELECT instructor_id, count(*) AS n_courses FROM planned GROUP BY instructor_id",
    "join_2": """
SELECT c._id, c.course_code, i.instructor_name FROM courses c JOIN instructors i ON i._id = c.instructor_id
""",
    "join_3": "SELECT s._id, d.department_name FROM students s JOIN departments d ON d._id = s.department_id",
    "join_9": "SELECT i._id, d.department_name FROM instructors i JOIN departments d ON d._id = i.department_id",
    "join_4_share": """
SELECT department_id, count(*) AS total_students, (SELECT count(*) FROM students) AS all_students
FROM students GROUP BY department_id
""",
    "join_5_fold": """
SELECT c._id, i._id AS instructor_id, i.instructor_name
FROM planned c LEFT JOIN teaches t ON t.course_id = c._id
LEFT JOIN instructors i ON i._id = t.instructor_id
""",
    "join_6_lookup": f"""
SELECT d._id, coalesce(c._chunk, 0) AS _chunk, count(c._iid) AS n_instructors,
       coalesce(string_agg(CAST(c._iid AS VARCHAR), ',' ORDER BY c._iid), '') AS instructor_ids
FROM departments d
LEFT JOIN {chunked("SELECT department_id AS k, _id AS _iid FROM instructors", "k", "_iid", R.documents.MAX_LEN)} c
  ON c.k = d._id
GROUP BY d._id, c._chunk
""",
    "join_7_lookup_array": f"""
SELECT c._id, coalesce(x._chunk, 0) AS _chunk, count(x._sid) AS n_students,
       coalesce(string_agg(CAST(x._sid AS VARCHAR), ',' ORDER BY x._sid), '') AS student_ids
FROM courses c
LEFT JOIN {chunked("SELECT course_id AS k, student_id AS _sid FROM edges", "k", "_sid", R.documents.MAX_LEN)} x
  ON x.k = c._id
GROUP BY c._id, x._chunk
""",
    "join_7_count": """
SELECT c._id, count(e.student_id) AS n_students
FROM courses c LEFT JOIN edges e ON e.course_id = c._id GROUP BY c._id
""",
    "join_8_sub": f"""
, core AS (SELECT _id FROM courses WHERE department_id = {R.DEPARTMENT_Q3} AND is_core_course)
SELECT i._id, (SELECT count(*) FROM core) AS n_core, (SELECT CAST(sum(_id) AS BIGINT) FROM core) AS ids_sum
FROM instructors i WHERE i.department_id = {R.DEPARTMENT_FLT4}
""",
    "agg_6_bucket_sizes": f"""
SELECT m.max_array, w.what, w.n
FROM (VALUES ({R.TINY_ARRAY}), ({R.SMALL_ARRAY}), ({R.documents.MAX_LEN})) m(max_array),
     (SELECT 'lookup_count' AS what, count(*) AS n FROM students
      UNION ALL SELECT 'lookup', count(*) FROM students
      UNION ALL SELECT 'lookup_unwind', count(*) FROM students
      UNION ALL SELECT 'unique_violations', 0
      UNION ALL SELECT 'edges', count(*) FROM edges
      UNION ALL SELECT 'all_edges', count(*) FROM enrollments) w
""",
    "join_10": """
SELECT s._id, coalesce(n.n, 0) AS n_candidates
FROM students s LEFT JOIN (SELECT department_id, count(*) AS n FROM courses GROUP BY department_id) n
  ON n.department_id = s.department_id
""",
    "join_11": """
SELECT c._id, c.course_code FROM planned c
WHERE NOT EXISTS (SELECT 1 FROM enrollments e WHERE e.course_id = c._id)
""",
    "agg_1": "SELECT department_id, count(*) AS total_students FROM students GROUP BY department_id",
    "agg_2": "SELECT avg(num_enrollments) AS average_students FROM course_counts",
    "agg_4": """
, per AS (
  SELECT t.instructor_id, coalesce(x.num_enrollments, 0) AS n
  FROM (SELECT * FROM claims UNION ALL SELECT course_id + 1099511627776, instructor_id FROM claims) t
  LEFT JOIN course_counts x ON x.course_id = t.course_id)
SELECT instructor_id, avg(n) AS avg_zero, avg(CASE WHEN n > 0 THEN n END) AS avg_inner
FROM per GROUP BY instructor_id
""",
    "agg_5": """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
  FROM orders) x
WHERE rn = 1
""",
    "agg_6_embed": f"""
SELECT s._id, coalesce(c._chunk, 0) AS _chunk, count(c.course_id) AS n_courses,
       coalesce(string_agg(CAST(c.course_id AS VARCHAR), ',' ORDER BY c.course_id), '') AS courses
FROM applicants s
LEFT JOIN {chunked("SELECT student_id, course_id FROM enrollments", "student_id", "course_id",
                   R.documents.MAX_LEN)} c ON c.student_id = s._id
GROUP BY s._id, c._chunk
""",
    "agg_7_empty": Q2_INNER.format(ins=R.UNKNOWN_INSTRUCTOR).replace(
        "SELECT avg", "SELECT 'sql' AS mode, avg", 1) + "\nUNION ALL\n" + Q2_INNER.format(
        ins=R.UNKNOWN_INSTRUCTOR).replace("SELECT avg", "SELECT 'pipeline' AS mode, avg", 1)
        + " HAVING count(*) > 0",
    "agg_8_division": DIVISION_DIVIDEND + """
SELECT c_custkey FROM dividend GROUP BY c_custkey
HAVING count(*) = (SELECT count(DISTINCT p_type) FROM part)
""",
    "agg_8_grouped": DIVISION_DIVIDEND + """
, g AS (SELECT c.c_nationkey, d.c_custkey, d.p_type FROM dividend d JOIN customer c ON c.c_custkey = d.c_custkey)
SELECT g.c_nationkey, g.c_custkey FROM g
GROUP BY g.c_nationkey, g.c_custkey
HAVING count(DISTINCT g.p_type) = (SELECT count(DISTINCT p_type) FROM g g2 WHERE g2.c_nationkey = g.c_nationkey)
""",
    "agg_8_empty": "SELECT instructor_name FROM instructors",
    "agg_8_grouped_empty": """
, core AS (SELECT * FROM courses WHERE is_core_course AND department_id >= 5),
need AS (SELECT department_id, count(*) AS need FROM core GROUP BY department_id)
SELECT DISTINCT c.department_id, c.instructor_id FROM courses c
WHERE c.instructor_id IS NOT NULL AND coalesce((SELECT need FROM need n WHERE n.department_id = c.department_id), 0)
  = (SELECT count(*) FROM core k WHERE k.department_id = c.department_id AND k.instructor_id = c.instructor_id)
""",
    "agg_9_division": DIVISION_DIVIDEND + """
SELECT DISTINCT d.c_custkey FROM dividend d
WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT DISTINCT p_type FROM part) t
  WHERE NOT EXISTS (SELECT 1 FROM dividend x WHERE x.c_custkey = d.c_custkey AND x.p_type = t.p_type))
""",
    "win_1_sample": _sample_sql(str(R.SAMPLE_K), R.SAMPLE_K) + "SELECT student_id, course_id FROM drawn",
    "win_1_range": _sample_sql(_k_range_expr("s._id"), R.SAMPLE_K_RANGE[1]) + "SELECT student_id, course_id FROM drawn",
    "win_3_sampled": _sample_sql(str(R.SAMPLE_K), R.SAMPLE_K, "instructor_id", "instructors")
        + "SELECT course_id, min(instructor_id) AS instructor_id FROM drawn GROUP BY course_id",
    "win_2_range": f"SELECT _id, {_k_range_expr('_id')} AS k FROM students",
    "win_3_first": "SELECT course_id, instructor_id FROM claims",
    "win_4_grid": f"""
, d AS (
  SELECT n.n_nationkey AS department_id,
         ({REGION_CASE}) || printf('%02d', n.n_nationkey) AS prefix,
         CAST({R.GRID_SLOTS[0]} + {md5i(str(R.SEED), 'n.n_nationkey')} % {R.GRID_SLOTS[1] - R.GRID_SLOTS[0] + 1}
              AS INTEGER) AS slots
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey),
g AS (
  SELECT d.department_id, d.prefix, s.slot, y.yi, y.offering_year,
         (s.slot - 1) * {len(R.GRID_YEARS)} + y.yi + 1 AS counter
  FROM d, LATERAL (SELECT unnest(generate_series(1, d.slots)) AS slot) s,
       (VALUES {", ".join(f"({i}, {y})" for i, y in enumerate(R.GRID_YEARS))}) y(yi, offering_year))
SELECT department_id, printf('%s-%03d', prefix, counter) AS course_code, offering_year,
       {md5i(str(R.SEED), 'department_id', 'counter')} % 2 = 0 AS is_core_course
FROM g
""",
    "ord_3_topk": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
    "ord_3_ties": """
SELECT course_id AS _id, num_enrollments FROM (
  SELECT *, rank() OVER (ORDER BY num_enrollments DESC) AS rk FROM course_counts) x
WHERE rk <= 10
""",
    "ord_3_group": """
SELECT department_id, _id, num_enrollments FROM (
  SELECT c.department_id, c._id, x.num_enrollments,
         row_number() OVER (PARTITION BY c.department_id ORDER BY x.num_enrollments DESC, c._id) AS rn
  FROM courses c JOIN course_counts x ON x.course_id = c._id) y
WHERE rn <= 3
""",
    "arr_1": "SELECT student_id AS _id, course_id FROM enrollments",
    "arr_1_outer": "SELECT s._id, e.course_id FROM applicants s LEFT JOIN enrollments e ON e.student_id = s._id",
    "arr_2": """
SELECT s._id, EXISTS (
    SELECT 1 FROM edges e JOIN courses c ON c._id = e.course_id
    WHERE e.student_id = s._id AND c.department_id = s.department_id) AS covered
FROM applicants s
""",
    "arr_3_4": f"""
SELECT n.n_nationkey, printf('%s-%03d', {REGION_CASE}, n.n_nationkey) AS code
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
""",
    "phy_1_cache": """
SELECT department_id, count(*) AS total_students, (SELECT count(*) FROM students) AS all_students
FROM students GROUP BY department_id
""",
    "phy_2_repartition": Q6,
    "phy_3_scalar": Q5,
    "phy_5_layout": Q3,
    "phy_6_inverted": Q1,
    "phy_7_prejoin": """
SELECT c._id, c.course_code, coalesce(x.num_enrollments, 0) AS num_enrollments
FROM courses c LEFT JOIN course_counts x ON x.course_id = c._id
""",
}


def oracle_sql() -> dict[str, str]:
    """Full statements: the mapping CTEs followed by each query.  Queries that
    add CTEs of their own start with a comma and continue the WITH list."""
    out = {}
    for name, body in SQL.items():
        body = body.strip()
        if body.startswith(","):
            out[name] = BASE + body
        else:
            out[name] = BASE + ", _q AS (" + body + ")\nSELECT * FROM _q"
    return out
