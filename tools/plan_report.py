"""Write PLANS.md: the executed (AQE final) physical plans of the headline
queries over stored collections, summarised — shuffles, join strategies,
aggregation phases, pushed filters and read schemas.

Usage: ``python tools/plan_report.py [sf_dir] > PLANS.md``
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from docrel.operators import membership  # noqa: E402
from docrel.plans import layout, queries as Q, registry, testmap  # noqa: E402
from docrel.plans.migration import read_migrated  # noqa: E402
from docrel.session import get_session, scratch_path  # noqa: E402
from docrel.sources import sinks  # noqa: E402


COMMENTARY = """## Reading these plans at 100 TB

* **Q-1** is a scan-side filter with no shuffle; `array_contains` cannot be pushed to Parquet, so
  the whole `students` array column is read. The PHY-6 form pushes `course_id = 15` into the
  inverted table (range-clustered, so row groups outside 15 are skipped) and joins back to head
  rows only: its cost tracks the number of matches, not the collection size.
* **Q-2** counts students per course first (partial aggregate, so a hot course is reduced in
  every map task), then keeps the instructor's courses by a semi join on the course, whose small
  side AQE broadcasts where its bytes allow; no job is run to decide the plan.
* **Q-3** pushes `department_id = 1` into the scan (or prunes directories on the PHY-5 layout);
  its one shuffle is the `first_per_key` de-duplication, partially aggregated.
* **Q-4** reads one column of `students`, which has one row per student and no array, in one
  partial aggregate, and joins the 25-row department table by broadcast (AQE's runtime size check).
* **Q-5** is count-based division: the divisor and the one-row divisor count are broadcast (size
  known at run time / one row by construction); the per-instructor count is a partial aggregate.
* **Q-6** counts edges per course with map-side combine (a hot course is reduced in every map
  task), joins one row per course, and keeps 10 rows per task (`TakeOrderedAndProject`).
* **Per-group top-k** trims each group to k rows before its shuffle (`WindowGroupLimit Partial`).
* **Q-7 students** (the bucketed embed): copies are counted per (student, course) first (partial
  aggregate), per-student sizes are re-shuffled before they meet the counts (both join sides are
  shuffle stages, so AQE can split a hot student), and chunks are grouped on one struct key so
  an exchange with a partial `collect_list` follows the join; no row exceeds the bucket size.

At this scale factor AQE broadcasts most small sides at run time; at 100 TB the same plans keep
their shape with sort-merge joins on unique keys wherever a side outgrows the threshold. No plan
here has a nested-loop or cartesian join, a global window, or a driver-side collect.
"""


def summarise(plan: str) -> dict:
    plan = plan.split("== Initial Plan ==")[0]  # AQE prints the final plan first
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|"
                                   r"Exchange SinglePartition", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                       r"BroadcastNestedLoopJoin|CartesianProduct)[^\n]*?"
                                       r"(Inner|LeftOuter|LeftSemi|LeftAnti|Cross|RightOuter)", plan))),
        "partial_aggs": len(re.findall(r"partial_", plan)),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]\n]*?)(?:\]|\.\.\.,)", plan)) - {""}),
        "partition_filters": sorted(set(re.findall(r"PartitionFilters: \[([^\]\n]*)\]", plan)) - {""}),
        "read": sorted(set(re.findall(r"ReadSchema: (\S+)", plan))),
        "topk": "TakeOrderedAndProject" in plan,
        "group_limit": "WindowGroupLimit" in plan,
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16)
    scratch = scratch_path(spark, "plans")
    built = testmap.collections(spark, sf_dir)
    paths = {k: f"{scratch}/{k}" for k in built}
    sinks.refresh_all(built, paths)
    cols = read_migrated(spark, paths)
    idx = layout.write_inverted_index(cols["enrolled"], "_id", "enrolled_courses", f"{scratch}/idx",
                                      item_as="course_id", owner_as="student_id")
    bydept = layout.write_layout(cols["courses"], f"{scratch}/bydept", partition_by=["department_id"],
                                 cluster_by=["_id"])
    counts = membership.membership_counts(cols["enrolled"], "_id", "enrolled_courses",
                                          item_as="course_id", count_as="n")
    cases = {
        "Q-1 students in course 15": Q.q1_students_in_course(cols, registry.COURSE_Q1),
        "Q-1 through the inverted table (PHY-6)": cols["students"].join(
            layout.index_lookup(spark, idx, registry.COURSE_Q1, item_as="course_id",
                                owner_as="student_id"),
            F.col("_id") == F.col("student_id"), "left_semi").select("student_name", "student_email"),
        "Q-2 mean enrolment, instructor 2": Q.q2_mean_enrolment(cols, registry.INSTRUCTOR_Q2),
        "Q-3 courses of department 1": Q.q3_department_courses(cols, registry.DEPARTMENT_Q3),
        "Q-3 on the department-partitioned layout (PHY-5)":
            Q.q3_department_courses({"courses": spark.read.parquet(bydept)}, registry.DEPARTMENT_Q3),
        "Q-4 students per department": Q.q4_students_per_department(cols),
        "Q-5 teaches all core courses (division)": Q.q5_instructors_teaching_all_core(cols, 1),
        "Q-5 grouped by department": Q.q5_grouped(cols),
        "Q-6 top-10 courses": Q.q6_top_courses(cols, 10),
        "Q-7 students collection (bucketed embed, from the raw tables)": built["students"],
        "ORD-3 top-3 per department": registry.grouping.top_k_per_group(
            cols["courses"].join(counts, F.col("_id") == F.col("course_id")), "department_id",
            F.col("n").desc(), 3, F.col("_id")),
    }
    print("# PLANS — executed physical plans of the headline queries\n")
    print(f"Generated by `tools/plan_report.py` at `{sf_dir}` over collections written to Parquet "
          "(students one row each; their arrays a side collection, max 10,000 ids per row), `local[8]`, AQE on. Counts are read off the "
          "final adaptive plan after the query ran.\n")
    for name, df in cases.items():
        df.write.format("noop").mode("overwrite").save()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"## {name}\n")
        print(f"* shuffles: {s['shuffles']}; broadcasts: {s['broadcasts']}; partial aggregates: "
              f"{s['partial_aggs']}; top-k: {s['topk']}; window group limit: {s['group_limit']}")
        print(f"* joins: {', '.join(' '.join(j) for j in s['joins']) or 'none'}")
        print(f"* pushed filters: {'; '.join(s['pushed']) or 'none'}")
        if s["partition_filters"]:
            print(f"* partition filters: {'; '.join(s['partition_filters'])}")
        print(f"* read schemas: {'; '.join(s['read'])}\n")
    print(COMMENTARY, end="")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
