"""Time the headline queries on local cores and print one JSON line.

``BENCH_SF_DIR`` names the folder of given tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed
runs per query (the median counts). Each result goes to the ``noop`` sink. Queries that write tables do
their work when they are built, so building is timed too.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rosterline.plans import catalog  # noqa: E402
from rosterline.session import local_session  # noqa: E402

HEADLINE = [
    "val_1_students",
    "val_2_enrollments",
    "val_4_register",
    "q_01_students_per_department",
    "q_02_course_gpa",
    "q_03_enrollments_per_student",
    "q_05_course_popularity",
    "q_07_enrollment_report",
    "q_08_student_course_load",
    "q_09_cross_department",
    "q_11_without_enrollment",
    "q_15_department_card",
    "q_16_top_students",
    "q_17_grade_distribution",
    "v_3_student_gpa",
    "v_4_course_statistics",
    "v_5_department_summary",
    "f_5_department_stats",
    "o_1_find_student",
    "o_9_not_in",
    "mv_1_artist_sales",
    "mv_2_genre_popularity",
    "mv_3_customer_lifetime_value",
    "p_1_top_artists",
    "p_2_purchase_history",
    "p_4_monthly_revenue",
    "b_1_artist_revenue",
    "b_2_monthly_sales",
    "b_3_sales_by_country",
    "b_4_genre_performance",
    "b_5_direct",
    "b_6_genre_track_counts",
    "b_7_countries_above",
    "inc_1_upsert",
    "inc_2_insert_ignore",
    "snk_2_load_enrollments",
    "f_3_enroll_students",
    "f_6_stored_grades",
    "mv_4_refresh_all",
    "str_1_registration",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = local_session(cores, int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        started = time.perf_counter()
        catalog.run(name, spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    once(names[0])  # start the executor threads
    seconds = {name: round(statistics.median(once(name) for _ in range(runs)), 4) for name in names}
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
