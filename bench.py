"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import catalog  # noqa: E402
from seriesloom.models import holt_winters, smoothing  # noqa: E402
from seriesloom.operators import clean, describe, lags, season, stationarity, trend, windows  # noqa: E402
from seriesloom.plans import validate  # noqa: E402
from seriesloom.session import build_session, materialize  # noqa: E402
from seriesloom.sources.panel import irregular_panel  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "1"))


def steps(panels):
    """Name to a function that builds the frame to be timed, for each panel."""
    out = {}
    for name, get in panels.items():
        out[f"clean_{name}"] = lambda g=get: clean.clean(g())
        out[f"describe_{name}"] = lambda g=get: describe.describe_series(g())
        out[f"decompose_{name}"] = lambda g=get: season.decompose(g())
        out[f"trend_{name}"] = lambda g=get: trend.analyze_trend(g())
        out[f"moving_average_{name}"] = lambda g=get: windows.moving_average(g(), 7)
        out[f"autocorrelation_{name}"] = lambda g=get: lags.autocorrelation(g(), 40)
        out[f"kpss_{name}"] = lambda g=get: stationarity.kpss_test(g())
        out[f"adf_{name}"] = lambda g=get: stationarity.adf_test(g())
        out[f"ses_fit_{name}"] = lambda g=get: smoothing.fit_smoothing(g(), "ses")
        out[f"holt_fit_{name}"] = lambda g=get: smoothing.fit_smoothing(g(), "holt")
        out[f"holt_winters_fit_{name}"] = lambda g=get: holt_winters.fit_holt_winters(g(), 12, "add", rounds=1)
        out[f"rolling_origin_sma_{name}"] = lambda g=get: validate.grid_search(g(), "sma")
        out[f"rolling_origin_ses_{name}"] = lambda g=get: validate.grid_search(g(), "ses")
        out[f"rolling_origin_holt_{name}"] = lambda g=get: validate.grid_search(g(), "holt")
    return out


def run(df) -> float:
    t0 = time.perf_counter()
    df().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false", spark__driver__memory="20g")
    spark.sparkContext.setLogLevel("ERROR")
    times, panels = {}, {}
    for name, rows in (("daily", catalog.order_days), ("supplier", catalog.supplier_days)):
        for _ in range(2):  # the first build warms up
            t0 = time.perf_counter()
            panels[name] = materialize(irregular_panel(rows(spark, SF_DIR), ties="sum"), name)
            times[f"panel_{name}"] = time.perf_counter() - t0
    get = {n: (lambda n=n: panels[n]) for n in panels}
    only = set(sys.argv[1:])
    for name, build in steps(get).items():
        if only and name not in only:
            continue
        runs = [run(build) for _ in range(REPEATS + 1)]
        times[name] = statistics.median(runs[1:])
    out = {k: round(v, 3) for k, v in times.items()}
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": out,
                      "sf": os.path.basename(SF_DIR.rstrip("/")), "cpus": int(CPUS)}))
    spark.stop()


if __name__ == "__main__":
    main()
