"""Documents ⇄ tables: AGG-6 embed, JOIN-5 fold, JOIN-6..9 lookups, FLT-4,
PRJ-3/4, and the Q-7 migration (``build_collections``) with its inverse.

A collection has one row per document, always.  An array that grows with the
data (a student's courses, a lookup's matches) is kept in a *side collection*
``(key, _chunk, array)`` of arrays of bounded length, as the bucket pattern does
in document stores; only functions on that array read it, so no answer depends
on the bucket size and nothing else pays for the array.

Chunks are chosen by a hash of the element, so every copy of a value sits in the
same chunk (membership tests and de-duplication stay per row).  A key with at
most ``max_len`` elements has one row, chunk 0.  A value repeated more than
``max_len`` times for one key keeps ``max_len`` copies in its chunk; the rest go
to overflow rows (negative ``_chunk``), so even one group of copies holding a
third of all rows makes bounded rows.

Lookups that only feed a count never build an array (``lookup_count``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docrel.functions.arrays import md5_int
from docrel.operators.grouping import reshuffled_agg, top_k_per_group

CHUNK = "_chunk"
#: Default bound of an array's length.
MAX_LEN = 10_000

OVERFLOW_PIECES = 1 << 30  # overflow chunk id = -(md5(value) * OVERFLOW_PIECES + piece)


def _chunk_arrays(pairs: DataFrame, max_len: int, sort: bool,
                  null_safe: bool = False) -> DataFrame:
    """``pairs(_k, _v, _h)`` → ``(_k, _chunk, _arr)``: values of each key in
    arrays of about ``max_len`` (``_h`` is what the chunk is hashed on).

    Copies of one value are counted first (partial aggregation collapses them
    map-side); up to ``max_len`` copies go to the value's home chunk (>= 0),
    further copies to overflow rows with negative ``_chunk`` of at most
    ``max_len`` copies each.  Overflow rows only repeat values already present
    in a home chunk, so membership readers skip them.
    """
    pairs = pairs.filter(F.col("_v").isNotNull())
    if max_len < 1:
        raise ValueError("max_len must be >= 1")
    m = F.lit(max_len)
    counted = pairs.groupBy("_k", "_v", "_h").agg(F.count(F.lit(1)).alias("_c"))
    home = F.least(F.col("_c"), m)
    # per-key size and smallest hash key: partial aggregates, one row per key,
    # re-shuffled for the join below so AQE can split a hot key's partition
    stats = reshuffled_agg(counted, ["_k"], F.sum(home).alias("_n"), F.min("_h").alias("_hmin"))
    nch = F.ceil(F.col("_n") / m).cast("long")
    chunk = F.when((nch <= 1) | (F.col("_h") == F.col("_hmin")), F.lit(0).cast("long")) \
             .otherwise(F.pmod(md5_int(F.col("_h")), nch))
    on = counted["_k"].eqNullSafe(stats["_k"]) if null_safe else counted["_k"] == stats["_k"]
    tagged = counted.join(stats, on).drop(stats["_k"])
    # Grouping on one struct column, not on (_k, _chunk): the join's hash
    # partitioning on _k would otherwise satisfy the grouping, leaving a hot
    # key's join and aggregation in one task.  With the struct key, Spark puts
    # an exchange (preceded by a partial aggregate) after the join, so AQE can
    # split a skewed join partition.
    homes = tagged.select(F.struct("_k", chunk.alias(CHUNK)).alias("_ck"),
                          F.array_repeat("_v", home.cast("int")).alias("_rep"))
    arr = F.flatten(F.collect_list("_rep"))
    if sort:
        arr = F.array_sort(arr)
    out = homes.groupBy("_ck").agg(arr.alias("_arr")) \
               .select(F.col("_ck._k").alias("_k"), F.col(f"_ck.{CHUNK}").alias(CHUNK), "_arr")
    pieces = F.explode(F.sequence(F.lit(1).cast("long"),
                                  F.ceil((F.col("_c") - m) / m).cast("long")))
    over = tagged.filter(F.col("_c") > m).select("_k", "_v", "_h", "_c", pieces.alias("_j"))
    over = over.select(
        "_k",
        (-(md5_int(F.col("_h")) * F.lit(OVERFLOW_PIECES) + F.col("_j"))).alias(CHUNK),
        F.array_repeat("_v", F.least(m, F.col("_c") - m * F.col("_j")).cast("int")).alias("_arr"))
    return out.unionByName(over)


def _side(left: DataFrame, left_key: str, arrays: DataFrame, as_: str, *, fill_empty: bool,
          null_safe: bool = False) -> DataFrame:
    """``(left_key, _chunk, as_)`` for the keys of ``left``; with ``fill_empty`` a
    chunk-0 row with ``[]`` for those without elements.

    Semi and anti joins against keys, so AQE can split a hot key's rows: they are
    always on the preserved, left side.
    """
    keys = reshuffled_agg(left.select(F.col(left_key).alias("_lk")), ["_lk"])
    def cond(a, b):
        return a["_k"].eqNullSafe(b["_lk"]) if null_safe else a["_k"] == b["_lk"]
    out = arrays.join(keys, cond(arrays, keys), "left_semi") \
                .select(F.col("_k").alias(left_key), CHUNK, F.col("_arr").alias(as_))
    if not fill_empty:
        return out
    have = reshuffled_agg(arrays.select("_k"), ["_k"])
    none = keys.join(have, cond(have, keys), "left_anti")
    return out.unionByName(none.select(
        F.col("_lk").alias(left_key), F.lit(0).cast("long").alias(CHUNK),
        F.array().cast(arrays.schema["_arr"].dataType).alias(as_)))


def member_rows(df: DataFrame) -> DataFrame:
    """Rows that carry membership: all rows, minus the overflow rows (negative
    ``_chunk``) of a side collection, which only repeat values."""
    if CHUNK in df.columns:
        return df.filter(F.col(CHUNK) >= 0)
    return df


def attach(parent: DataFrame, side: DataFrame, key: str) -> DataFrame:
    """Parents with the rows of a side collection: one row per parent and chunk,
    and one (chunk 0, NULL array) for parents without any.

    An inner join, of which AQE can split either side, and the parents that it
    leaves out; a left outer join could not split a hot parent's chunks.
    """
    hit = parent.join(side, key)
    none = parent.join(reshuffled_agg(side, [key]), key, "left_anti")
    rest = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != CHUNK
            else F.lit(0).cast("long").alias(CHUNK) for f in side.schema.fields if f.name != key]
    return hit.unionByName(none.select("*", *rest))


# AGG-6 ------------------------------------------------------------------------
def embed(parent: DataFrame, children: DataFrame, parent_key: str, child_fk: str,
          value: str, as_: str, *, empty: str = "missing", sort: bool = True,
          max_len: int = MAX_LEN) -> DataFrame:
    """Collect child values into an array field of the parent: the side
    collection ``(parent_key, _chunk, as_)``.

    ``empty="missing"`` gives parents without children no row (what a per-parent
    ``$set`` does: the field is never written); ``"empty"`` gives them ``[]``.
    Duplicated children are kept; NULL values and children without a parent are
    not embedded; ``sort`` makes the order repeatable.
    """
    if empty not in ("missing", "empty"):
        raise ValueError("empty must be 'missing' or 'empty'")
    pairs = children.select(F.col(child_fk).alias("_k"), F.col(value).alias("_v"),
                            F.col(value).alias("_h")).filter(F.col("_k").isNotNull())
    return _side(parent, parent_key, _chunk_arrays(pairs, max_len, sort), as_,
                 fill_empty=empty == "empty")


def set_array(side: DataFrame, keys: DataFrame, children: DataFrame, key: str, child_fk: str,
              value: str, as_: str, *, max_len: int = MAX_LEN) -> DataFrame:
    """SNK-3 on an array field: the side collection with the arrays of ``keys``
    replaced by their ``children`` (none: the field goes)."""
    kept = side.join(reshuffled_agg(keys, [key]), key, "left_anti")
    return kept.unionByName(embed(keys, children, key, child_fk, value, as_, max_len=max_len))


# JOIN-5 -----------------------------------------------------------------------
def fold_link(base: DataFrame, link: DataFrame, base_key: str, link_base: str, link_target: str,
              target: DataFrame, target_key: str, *, as_: str) -> DataFrame:
    """Two-hop left join folding a link table into a nullable foreign key:
    ``base ⟕ link ⟕ target`` → ``base.*, target.target_key AS as_``.

    The link must hold at most one row per ``link_base`` (check with
    ``integrity.unique_violations``) or base rows fan out.
    """
    l2 = link.select(F.col(link_base).alias("_lb"), F.col(link_target).alias("_lt"))
    t2 = target.select(F.col(target_key).alias(as_))
    return (base.join(l2, base[base_key] == l2["_lb"], "left")
            .join(t2, F.col("_lt") == t2[as_], "left")
            .drop("_lb", "_lt"))


# JOIN-6 / 7 / 8 / 9 -----------------------------------------------------------
def _docs(right: DataFrame, cols: Sequence[str] | None = None) -> Column:
    return F.struct(*[F.col(c) for c in (cols or right.columns)])


def lookup(left: DataFrame, right: DataFrame, local: str, foreign: str, as_: str, *,
           null_safe: bool = False, max_len: int = MAX_LEN,
           chunk_by: str | None = None, doc_cols: Sequence[str] | None = None) -> DataFrame:
    """JOIN-6 — ``$lookup``: the side collection ``(local, _chunk, as_)`` of the
    matching right documents (sorted) of every distinct left key, ``[]`` when none.
    ``null_safe=True`` also matches NULL with NULL (the document store treats
    missing and null as equal).  Chunks are hashed on ``chunk_by`` (default: the
    first right column).  ``doc_cols`` keeps only those fields of the matched
    documents (a projection after the lookup, applied before it)."""
    h = chunk_by or right.columns[0]
    pairs = right.select(F.col(foreign).alias("_k"), _docs(right, doc_cols).alias("_v"),
                         F.col(h).alias("_h"))
    if not null_safe:
        pairs = pairs.filter(F.col("_k").isNotNull())
    arrays = _chunk_arrays(pairs, max_len, sort=True, null_safe=null_safe)
    return _side(left, local, arrays, as_, fill_empty=True, null_safe=null_safe)


def lookup_in_array(left: DataFrame, right: DataFrame, local: str, foreign_array: str,
                    as_: str, *, max_len: int = MAX_LEN, chunk_by: str | None = None,
                    doc_cols: Sequence[str] | None = None) -> DataFrame:
    """JOIN-7 — ``$lookup`` whose foreign field is an array: a right document
    matches when the array contains the local value (once, however often).
    ``right`` holds the array inline or is a side collection; the result is a
    side collection ``(local, _chunk, as_)`` as in :func:`lookup`.

    Every match copies the matched document, so a document whose array has n
    entries is copied n times; pass ``doc_cols`` to copy only the fields needed
    (leaving out the array itself keeps the volume linear in the matches)."""
    h = chunk_by or right.columns[0]
    right = member_rows(right)
    pairs = right.select(F.explode(F.array_distinct(F.col(foreign_array))).alias("_k"),
                         _docs(right, doc_cols).alias("_v"), F.col(h).alias("_h")) \
                 .filter(F.col("_k").isNotNull())
    arrays = _chunk_arrays(pairs, max_len, sort=True)
    return _side(left, local, arrays, as_, fill_empty=True)


def lookup_count(left: DataFrame, right: DataFrame, local: str, foreign: str, as_: str, *,
                 foreign_is_array: bool = False) -> DataFrame:
    """JOIN-6/7 + AGG-10 without the array: ``$size`` of the lookup, 0 when none.

    Children are counted per key first (partial aggregation), then joined to
    the left rows, so a hot key costs one pre-aggregated row.
    """
    if foreign_is_array:
        # distinct per document: a document's chunks share no value
        keys = member_rows(right).select(F.explode(F.array_distinct(F.col(foreign))).alias("_lk"))
    else:
        keys = right.select(F.col(foreign).alias("_lk"))
    # re-shuffled so a left key shared by many left rows can be split by AQE
    counts = reshuffled_agg(keys.filter(F.col("_lk").isNotNull()), ["_lk"],
                            F.count(F.lit(1)).alias(as_))
    out = left.join(counts, left[local] == counts["_lk"], "left").drop("_lk")
    return out.withColumn(as_, F.coalesce(F.col(as_), F.lit(0).cast("long")))


def lookup_uncorrelated(left: DataFrame, sub: DataFrame, left_key: str, as_: str, *,
                        max_len: int = MAX_LEN) -> tuple[DataFrame, DataFrame]:
    """JOIN-8 — sub-pipeline lookup without correlation: every left row gets the
    same array, the documents of ``sub`` (``[]`` when there are none).

    The array is the same for all rows, so it is kept once: ``(keys, shared)``
    with ``keys`` = the left rows' key and ``_shared`` = 0, and ``shared`` the side
    collection ``(_shared, _chunk, as_)``.  Joining the two on ``_shared`` writes the
    array out for every row; counts, subset and membership tests need not.
    """
    one = left.select(left_key, F.lit(0).alias("_shared"))
    h = F.xxhash64(*[F.col(c).cast("string") for c in sub.columns])
    # 0 for every row, but not a literal: joins on literals would become cross joins
    pairs = sub.select(F.pmod(h, F.lit(1)).cast("int").alias("_k"), _docs(sub).alias("_v"), h.alias("_h"))
    arrays = _chunk_arrays(pairs, max_len, sort=True) \
        .select(F.col("_k").alias("_shared"), CHUNK, F.col("_arr").alias(as_))
    none = sub.agg(F.count(F.lit(1)).alias("_n")).filter("_n = 0").select(
        F.lit(0).alias("_shared"), F.lit(0).cast("long").alias(CHUNK),
        F.array().cast(arrays.schema[as_].dataType).alias(as_))
    return one, arrays.unionByName(none)


def lookup_correlated(left: DataFrame, right: DataFrame, left_key: str, local: str, foreign: str, as_: str, *,
                      let: dict[str, str] | None = None, where=None, order: Sequence[Column], k: int,
                      doc_cols: Sequence[str] | None = None) -> DataFrame:
    """JOIN-8 — ``$lookup`` with ``let`` and a pipeline of match, sort and limit: every
    left row gets the first ``k`` matching documents of ``right``, ``[]`` if there are none.

    Documents match on ``local`` = ``foreign`` and on ``where(doc)``, a condition that
    may name the left row's ``let`` variables: ``let={"dept": "department_id"}`` puts that
    field at ``_let_dept``.  ``order`` is a total order of the documents by their own fields.

    The sub-pipeline of each row is one join, and the limit a window group limit that
    keeps ``k`` documents a row in every task before they meet; arrays hold ``k`` at most.
    ``left_key`` must be unique; a NULL ``local`` matches nothing.
    """
    let = let or {}
    asks = left.select(F.col(left_key).alias("_owner"), F.col(local).alias("_lk"),
                       *[F.col(c).alias(f"_let_{v}") for v, c in let.items()]).filter("_lk IS NOT NULL")
    docs = asks.join(right, F.col("_lk") == right[foreign])
    if where is not None:
        docs = docs.filter(where)
    best = top_k_per_group(docs, "_owner", list(order), k, rank_as="_place")
    doc = F.struct(*[F.col(c) for c in (doc_cols or right.columns)])
    # at most k documents a row, put in order by their place
    arrays = best.groupBy("_owner").agg(F.sort_array(F.collect_list(F.struct("_place", doc.alias("_doc")))).alias("_a")) \
                 .select(F.col("_owner").alias("_key"), F.transform("_a", lambda x: x["_doc"]).alias(as_))
    out = left.join(arrays, left[left_key] == F.col("_key"), "left").drop("_key")
    return out.withColumn(as_, F.coalesce(F.col(as_), F.array().cast(arrays.schema[as_].dataType)))


def lookup_unwind(left: DataFrame, right: DataFrame, local: str, foreign: str,
                  as_: str) -> DataFrame:
    """JOIN-9 — ``$lookup`` followed by ``$unwind`` is an inner join; the right
    document stays nested under ``as_`` so paths like ``as_.field`` (PRJ-4)
    read as in the pipeline.  Never collects and re-explodes."""
    r = right.select(F.col(foreign).alias("_lk"), _docs(right).alias(as_))
    return left.join(r, left[local] == r["_lk"]).drop("_lk")


# FLT-4 ------------------------------------------------------------------------
def match_children(parent: DataFrame, child: DataFrame, parent_key: str, child_fk: str,
                   conditions: Sequence[Column], *, same_element: bool = False) -> DataFrame:
    """FLT-4 — parents with children matching conditions.

    ``same_element=False`` is the document-store reading of
    ``{"arr.a": x, "arr.b": y}``: each condition may be met by a *different*
    child.  ``True`` requires one child meeting all.  Evaluated as flags
    aggregated per parent (partial aggregation), then a semi join.
    """
    if same_element:
        flags = [F.max(_and(conditions).cast("int")).alias("_f0")]
    else:
        flags = [F.max(c.cast("int")).alias(f"_f{i}") for i, c in enumerate(conditions)]
    per = child.filter(F.col(child_fk).isNotNull()).groupBy(F.col(child_fk).alias("_pk")).agg(*flags)
    ok = per.filter(_and([F.col(f"_f{i}") == 1 for i in range(len(flags))])).select("_pk")
    return parent.join(ok, parent[parent_key] == ok["_pk"], "left_semi")


def _and(conds: Sequence[Column]) -> Column:
    out = F.coalesce(conds[0], F.lit(False))
    for c in conds[1:]:
        out = out & F.coalesce(c, F.lit(False))
    return out


# PRJ-3 ------------------------------------------------------------------------
def project_doc(df: DataFrame, include: Sequence[str], *, exclude_id: bool = False,
                id_col: str = "_id") -> DataFrame:
    """PRJ-3 — document projection: listed fields, plus ``_id`` unless excluded."""
    cols = list(include)
    if not exclude_id and id_col in df.columns and id_col not in cols:
        cols = [id_col] + cols
    return df.select(*cols)


# Q-7 --------------------------------------------------------------------------
def build_collections(tables: dict[str, DataFrame], *,
                      max_array: int = MAX_LEN) -> dict[str, DataFrame]:
    """Q-7 — six relational tables → four collections and the side
    collection of the embedded array.

    * departments, instructors, students: primary key renamed to ``_id``;
    * courses: ``teaches`` folded into a nullable ``instructor_id`` (JOIN-5);
    * enrolled: ``enrollments`` embedded per student (AGG-6) as
      ``(_id, _chunk, enrolled_courses)``, no row for students without
      enrolments, duplicates kept, at most about ``max_array`` a row.
    """
    d, s, i, c = (tables[k] for k in ("departments", "students", "instructors", "courses"))
    departments = d.select(F.col("department_id").alias("_id"), "department_name")
    instructors = i.select(F.col("instructor_id").alias("_id"), "instructor_name",
                           "instructor_email", "department_id")
    courses = fold_link(c, tables["teaches"], "course_id", "course_id", "instructor_id",
                        i, "instructor_id", as_="instructor_id")
    courses = courses.select(F.col("course_id").alias("_id"), "course_code", "department_id",
                             "is_core_course", "offering_year", "instructor_id")
    students = s.select(F.col("student_id").alias("_id"), "student_name", "student_email",
                        "department_id")
    enrolled = embed(students, tables["enrollments"], "_id", "student_id", "course_id",
                     "enrolled_courses", max_len=max_array)
    return {"departments": departments, "students": students, "enrolled": enrolled,
            "instructors": instructors, "courses": courses}


def array_rows(cols: dict[str, DataFrame]) -> DataFrame:
    """The rows that hold ``enrolled_courses``: the side collection, or students
    read from a store with the array inline."""
    return cols.get("enrolled", cols["students"])


def flatten_collections(cols: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Inverse of Q-7 for the two folded relationships: ``enrollments`` (with
    repeats, as embedded) and ``teaches`` (courses with an instructor)."""
    enrollments = array_rows(cols).select(F.col("_id").alias("student_id"),
                                          F.explode("enrolled_courses").alias("course_id"))
    teaches = cols["courses"].filter(F.col("instructor_id").isNotNull()) \
                             .select(F.col("_id").alias("course_id"), "instructor_id")
    return {"enrollments": enrollments, "teaches": teaches}
