"""Times the headline queries and prints one JSON line.

Every result is written in full to the no-op sink, so no column is pruned away and nothing is collected.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcast import catalog  # noqa: E402
from shelfcast.session import local_session  # noqa: E402

HEADLINE = [
    "win7_all_features", "jon5_build_fact", "win2_rolling_blocked", "jon9_local_holidays", "agg1_sales_profile",
    "agg8_totals", "agg9_describe_by_family", "agg10_column_profile", "agg23_importance_mutual_info",
    "agg26_location_rollup", "out2_iqr", "win11_decompose", "win13_sequences", "spl2_split_three", "spl5_backtest_linear",
    "fct1_adf", "fct3_fit_arima", "fct7_fit_additive", "spl7_search", "evl2_macro_average", "mon3_ks_drift",
    "mon13_prediction_anomalies", "str2_windowed_stats", "mon14_report",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    names = sys.argv[1:] or HEADLINE
    # one small query first, so that the first timing does not include the start of the JVM
    catalog.QUERIES["top2_families"](spark, folder).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(scale.group(1)) if scale else None}))


if __name__ == "__main__":
    main()
