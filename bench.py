"""Benchmark of the headline steps; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).

Steps timed (each forces full evaluation; the session is warmed up first on
sf0.001 so that one-off code generation is not charged to the first step):

* ods_request_full     M1 over all request batches (gate, stamp, dedupe, flag)
* ods_request_touched  M1 of the last batch, touched keys only, onto the
                       history of the first two
* dims                 D1-D22 from the ODS snapshots
* fact_request         D23 + D24 (18 broadcast lookups, upsert, RSO blanking)
* fact_case            D25
* daily_pivot          R1 from the request fact
* daily_stats_e2e      R3 from staging to report in a fresh build

The warm-up runs the same build on BENCH_WARMUP_DIR (default sf0.01), large
enough for the JVM to compile the hot paths; it is not timed.

Shuffle bytes written per step are read from Spark's event log, written to a
fresh scratch folder (each step runs under its own job group).
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tierwell import specs  # noqa: E402
from tierwell.operators import gate, history  # noqa: E402
from tierwell.plans.warehouse import Warehouse, batch_clock  # noqa: E402
from tierwell.session import local_session, materialize  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def all_dims(wh: Warehouse) -> None:
    wh.build_dims()


def shuffle_bytes_by_group(log_dir: str) -> dict[str, int]:
    """Sum of shuffle bytes written per job group, from the event log."""
    import glob
    stage_group: dict[int, str] = {}
    written: dict[str, int] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path) or os.path.basename(path).startswith((".", "appstatus")):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        if group:
                            stage_group[sid] = group
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    group = stage_group.get(info["Stage ID"])
                    for acc in info.get("Accumulables", []):
                        if acc.get("Name") == "internal.metrics.shuffle.write.bytesWritten" and group:
                            written[group] = written.get(group, 0) + int(acc.get("Value", 0))
    return written


def main() -> None:
    import tempfile
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    log_dir = tempfile.mkdtemp(prefix="tierwell-eventlog-")
    spark = local_session(cpus, shuffle_partitions=max(8, cpus),
                          extra_conf={"spark.eventLog.enabled": "true",
                                      "spark.eventLog.compress": "false",
                                      "spark.eventLog.dir": f"file://{log_dir}"})

    # warm-up: same plans on smaller data (code generation, JIT), not timed
    warm = Warehouse(spark, os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01"))
    warm.daily_stats().collect()
    run(warm.fct_case)

    times: dict[str, float] = {}

    def timed(name, fn):
        spark.sparkContext.setJobGroup(name, name)
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    wh = Warehouse(spark, sf_dir)
    timed("ods_request_full", lambda: wh.ods_request)

    # incremental: history of batches 1-2 prepared, batch 3 loaded touched-only
    stg = wh.stg_request
    valid = gate.valid_rows(stg, specs.REQUEST.required)
    first = materialize(history.merge_stored(
        history.empty_ods(spark, specs.REQUEST),
        history.stamp(valid.filter(F.col("batch") < 3), specs.REQUEST, batch_clock()),
        specs.REQUEST))
    third = stg.filter(F.col("batch") == 3).drop("batch")
    timed("ods_request_touched", lambda: run(history.load_history(
        first, third, specs.REQUEST, "2002-01-03 00:00:00", touched_only=True)))

    timed("ods_case_address", lambda: (wh.ods_case, wh.ods_address))
    timed("dims", lambda: all_dims(wh))
    timed("fact_request", lambda: run(wh.fct_request))
    timed("fact_case", lambda: run(wh.fct_case))
    timed("daily_pivot", lambda: run(wh.pivot))
    timed("daily_stats_e2e", lambda: Warehouse(spark, sf_dir).daily_stats().collect())

    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    result = {"metric": "warehouse_build_total", "value": total, "unit": "sec",
              "queries": times, "sf": sf}
    spark.stop()   # flushes the event log
    try:
        shuffled = shuffle_bytes_by_group(log_dir)
        result["shuffle_bytes"] = {k: shuffled.get(k, 0) for k in times}
    except Exception:  # noqa: BLE001 - the timings stand on their own
        pass
    print(json.dumps(result))


if __name__ == "__main__":
    main()
