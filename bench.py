"""Time the headline queries; prints one JSON line.

The sample is landed once as partitioned parquet (timed as its own query); the others read the landed table.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from delaylens.catalog import QUERIES  # noqa: E402
from delaylens.catalog.base import Tables  # noqa: E402
from delaylens.session import build_session  # noqa: E402
from delaylens.sources import stores  # noqa: E402

HEADLINE = [
    "b10_null_audit", "b13_remove_outliers_iqr", "b14_remove_outliers_iqr_all", "c2_cyclical_minutes",
    "c11_split_city_state", "d5_apply_fitted_encoding", "e1_airport_congestion", "e2_delay_propensity",
    "f1_woe_encode", "f7_standard_scale", "g1_stratified_split", "g4_stratified_kfold", "h3_avg_delay_by_airline",
    "h7_monthly_trend", "h10_weighted_contribution_airline", "h16_correlation_matrix", "h18_profile",
    "i1_classification_metrics", "i4_roc_curve", "m6_logistic_l1", "m9_neural_regressor", "x5_tree_shap",
    "late_flight_run",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", cpus, spark__ui__enabled="false", spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    target = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/flights"
    timings: dict[str, float] = {}

    begin = time.time()
    spread = Tables(spark, folder).flights.repartition(cpus)  # each sample table is a single file
    stores.land_dataset(spark, target, lambda: spread)
    timings["a3_land_dataset"] = round(time.time() - begin, 3)
    landed = Tables(spark, folder, spark.read.parquet(target).drop("FL_YEAR"))
    for name in HEADLINE:
        begin = time.time()
        QUERIES[name](Tables(spark, folder, landed.flights)).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - begin, 3)
        print(name, timings[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, total wall time", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings, "sf": os.path.basename(folder).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
