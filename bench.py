"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all), BENCH_RUNS (default 1;
the model fit and what follows it run once). Every query is run once to warm up, then the
median of the timed runs counts. Results go to a sink that computes all rows and keeps none.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

LIGHT = ("group_week_summary", "last_dose_weeks", "rolling_weather", "lag_mean_fec",
         "lag_any_dose", "join_asof_last_dose", "group_model_data", "individual_model_data",
         "history_features", "forecast_features", "load_dosing_sheet", "hourly_weather_rollup")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    from herdcast.queries import models, queries
    from herdcast.session import build_session
    n = os.cpu_count() if cpus == "*" else int(cpus)
    conf = {"spark.sql.shuffle.partitions": str(n), "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="herdcast-bench-")   # local mode only
    spark = build_session(f"local[{cpus}]", "bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times: dict[str, float] = {}
    for name in LIGHT:
        once(name)
        times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    for warm in (True, False):          # the whole chain of models, from the tables
        models.forget()
        seconds = once("fit_group_lmm")
        if not warm or runs == 1:
            times["fit_prediction_model"] = round(seconds, 3)
    times["predict_animal"] = round(once("predict_animal"), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                      "cpus": n}))
    spark.stop()


if __name__ == "__main__":
    main()
