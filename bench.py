"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma separated names, default the headline list).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cohortspark.plans import book  # noqa: E402
from cohortspark.session import build_session  # noqa: E402

HEADLINE = [
    "growth_quartile_table", "filter_by_group_mean", "distinct_keep_all", "left_join", "full_join", "anti_join", "nearest_score",
    "asof_previous_purchase", "within_interval_join", "interval_setdiff", "top_n_ties_kept", "group_by_summarise", "first_last_nth",
    "median_quantiles", "tabyl_two_way", "margins_every_subset", "get_dupes", "rank_family", "ntile_skips_na", "lag_lead_default",
    "cumsum_whole_table", "group_statistics_recycled", "fill_down_up", "gather_measures", "spread_levels", "complete_grid", "nest_rows",
    "str_detect_count", "str_replace_first_all", "glue_template", "floor_dates", "list_map_sum", "json_parse_column", "lump_most_frequent",
    "normed_growth", "imputed_scores", "cohort_percentiles", "share_per_quartile", "csv_round_trip", "stream_tumbling_windows",
    "graph_degree_distribution", "graph_components",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", int(cpus), **{"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries = book.queries()
    for n in ("group_by_summarise", "inner_join", "row_number_groups", "tabyl_three_way"):  # start the JVM and its code caches
        queries[n](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        start = time.perf_counter()
        queries[n](spark, folder).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
