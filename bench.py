"""Benchmark: both pipelines end to end plus the report set.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints ONE JSON line. Timings:

* etl_total / elt_total -- whole flow from the driver tables to the
  written star (landing copies, lake snapshot, warehouse tables)
* report_summary -- one aggregate pass over the stored ETL fact, written
  to marts/ (every report reads it)
* q*/kpi -- each dashboard report over the stored ETL warehouse
* elt_* -- the same over the stored ELT warehouse

``value`` is the sum of all timings.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from healthmart.plans import pipelines as P  # noqa: E402
from healthmart.plans import reports as R  # noqa: E402
from healthmart.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="hm-bench-")
    spark = get_session(f"local[{cpus}]", app="healthmart-bench", shuffle_partitions=int(cpus) * 2,
                        spark__driver__memory="4g",
                        spark__sql__files__maxPartitionBytes=str(128 * 1024 * 1024))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    ns, ds = P.driver_inputs(spark, sf_dir)
    input_rows = ns.count() + ds.count()  # appointment + profile rows fed to each flow
    ns, ds = P.driver_inputs(spark, sf_dir)
    etl = timed("etl_total", lambda: P.run_etl(ns, ds, P.Options(), base=os.path.join(scratch, "etl")))
    ns, ds = P.driver_inputs(spark, sf_dir)
    elt = timed("elt_total", lambda: P.run_elt(ns, ds, P.Options(), base=os.path.join(scratch, "elt")))
    fact_rows = etl.star.fact.count()

    # one pass over each stored fact builds the report summary (marts/);
    # every report then reads that summary
    etl_star = timed("report_summary", lambda: P.with_summary(etl.star, os.path.join(scratch, "etl")))
    elt_star = timed("elt_report_summary", lambda: P.with_summary(elt.star, os.path.join(scratch, "elt")))
    for name, thunk in R.dashboard(etl_star).items():
        timed(name, lambda t=thunk: t().collect())
    for name, thunk in R.dashboard(elt_star, "ELT").items():
        timed(f"elt_{name}", lambda t=thunk: t().collect())

    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "etl_elt_flows_plus_reports",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "fact_rows": fact_rows,
        "input_rows": input_rows,
        "etl_rows_per_sec": round(input_rows / times["etl_total"]),
        "elt_rows_per_sec": round(input_rows / times["elt_total"]),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
