"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local cores.
Arguments, if any, are the queries to run instead.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = """
s09_filtered_scan s08_partitioned s12_bucketed
p06_where_between p12_expand o01_sort_by o02_top_n o03_best_per_key o04_top_n_rank o07_top_buyers u01_distinct u07_reconcile
j01_inner_join j04_semi_join j06_sum_having j13_bucketed_join j14_salted_join j15_split_hot_join j21_interval_join
a07_multi_agg a10_cube a12_pivot a15_collect_list a17_distinct_count a18_approx_distinct a19_median
w01_rank_all w02_lag_lead w04_running_total w09_range_sum w11_global_running w16_sessionize
d04_parse_date f06_parse_log n10_array_sum n11_json_fields x01_revenue_udf x02_revenue_expr
q06_above_average q08_not_in_full q11_correlated_agg h02_walk
c04_last_write_wins c08_scd2 c10_upsert t02_tumbling t04_sessions t07_interval_join
z03_funnel z05_daily_summary z06_features z07_monthly_report z08_change_history
""".split()
# The same windows as a table with hot keys would run them; timed beside the headline queries.
HOT_PATH = "w02_lag_lead_split w04_running_total_split w16_sessionize_split a19_median_split c08_scd2_split".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from millrace.plans.catalogue import QUERIES
    from millrace.session import build_session

    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    })
    # Start the JVM's and the file system's one-off work before timing.
    QUERIES["a07_multi_agg"].run(spark, folder).write.format("noop").mode("overwrite").save()

    def timed(names: list[str]) -> dict[str, float]:
        seconds = {}
        for name in names:
            start = time.perf_counter()
            QUERIES[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        return seconds

    seconds = timed(sys.argv[1:] or HEADLINE)
    hot = timed([] if sys.argv[1:] else HOT_PATH)
    print(json.dumps({
        "metric": "total wall time of headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "hot_path": hot, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
