"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row computed,
none collected). End-to-end jobs are timed as well: the bronze load of landed
envelopes into a catalog table, two incremental silver runs (first run
inserts, second run upserts a re-sent, overlapping window), and a hot-key
skew probe of the dedupe. Derived fixture tables are stored first and timed
apart. Shuffle volumes come from Spark's event log in a scratch folder.
Prints one JSON line.
"""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import tempfile
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from pluvio import fixtures as fx  # noqa: E402
from pluvio import queries as Q  # noqa: E402
from pluvio.plans import run_bronze_load, run_silver_fact  # noqa: E402
from pluvio.session import build_session, scratch_path  # noqa: E402
from pluvio.sources import create_tables, write_envelopes  # noqa: E402



def _shuffle_metrics(log_dir: str) -> dict[str, dict[str, int]]:
    """Shuffle bytes written and input bytes read per job group, from the event log."""
    stage_group: dict[int, str] = {}
    out: dict[str, dict[str, int]] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("."):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if group:
                        for sid in ev.get("Stage IDs", []):
                            stage_group[sid] = group
                elif kind == "SparkListenerTaskEnd":
                    group = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if group:
                        acc = out.setdefault(group, {"shuffle_bytes": 0, "shuffle_records": 0, "input_bytes": 0})
                        sw = m.get("Shuffle Write Metrics") or {}
                        acc["shuffle_bytes"] += sw.get("Shuffle Bytes Written", 0)
                        acc["shuffle_records"] += sw.get("Shuffle Records Written", 0)
                        acc["input_bytes"] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
    return out


def _timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 3)


def _jobs(spark, sf_dir: str, times: dict) -> None:
    """Bronze load + two silver runs over catalog tables in a scratch schema."""
    root = scratch_path(spark, "bench-jobs")
    schema = "pluvio_bench_" + root.rsplit("-", 1)[-1][:10]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{root}/db'")
    names = create_tables(spark, schema)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    cut = dt.datetime(2024, 1, 16)
    early = write_envelopes(
        fx.observation_features(ev.filter(F.col("ts") < F.lit(cut)), key="unique"), f"{root}/landing", "x1"
    )
    rest = write_envelopes(
        fx.observation_features(ev.filter(F.col("ts") >= F.lit(cut - dt.timedelta(days=2))), key="unique"),
        f"{root}/landing",
        "x2",
    )
    r = [dt.datetime(2024, 2, d) for d in range(1, 6)]
    times["job_bronze_load"] = _timed(
        lambda: run_bronze_load(spark, early, names["bronze"], job_id="l1", run_ts=r[0])
    )
    times["job_silver_first_run"] = _timed(
        lambda: run_silver_fact(spark, names["bronze"], names["fact"], job_id="s1", trace_id="t", run_ts=r[1], snapshot_root=f"{root}/snap")
    )
    run_bronze_load(spark, rest, names["bronze"], job_id="l2", run_ts=r[2])
    times["job_silver_upsert_run"] = _timed(
        lambda: run_silver_fact(spark, names["bronze"], names["fact"], job_id="s2", trace_id="t", run_ts=r[3], snapshot_root=f"{root}/snap")
    )


def _skew_probe(spark, sf_dir: str, times: dict) -> dict:
    """A third of all observations share one record key: the dedupe must not
    route them to one reducer (partial WindowGroupLimit before the exchange)."""
    from pluvio.operators import latest_per_key, parse_fact

    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    hot = F.when(F.col("event_id") % 3 == 0, F.lit("obs-hot")).otherwise(
        F.concat(F.lit("obs-"), F.col("event_id").cast("string"))
    )
    bronze = ev.select(
        F.col("event_id").cast("string").alias("_record_id"),
        fx.to_variant(fx.observation_feature(hot)).alias("raw_response_json"),
        F.col("ts").cast("timestamp").alias("_record_updated_at"),
    )
    path = scratch_path(spark, "skew-probe")
    bronze.write.parquet(path)
    spark.sparkContext.setJobGroup("skew_probe", "skew_probe")
    times["skew_probe_dedupe"] = _timed(
        lambda: latest_per_key(parse_fact(spark.read.parquet(path)), "noaa_record_id")
        .write.format("noop").mode("overwrite").save()
    )
    return {"rows": ev.count(), "hot_key_rows": ev.filter(F.col("event_id") % 3 == 0).count()}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = sys.argv[1:] or list(Q.QUERIES)  # every registered query
    # Spark's event log in a scratch folder gives shuffle / input bytes per query
    # (no UI). BENCH_EVENT_LOG=0 turns it off.
    log_dir = tempfile.mkdtemp(prefix="pluvio-eventlog-") if os.environ.get("BENCH_EVENT_LOG", "1") != "0" else None
    spark = build_session(app_name="pluvio-bench", event_log_dir=log_dir)
    qs = Q.queries()
    fixture_s = _timed(lambda: Q.prepare_fixtures(spark, sf_dir))
    # Warm-up (JVM class loading, Python workers), not timed.
    qs["fact_minute54"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        times[name] = _timed(lambda: qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    skew = None
    if not sys.argv[1:]:
        spark.sparkContext.setJobGroup("jobs", "jobs")
        _jobs(spark, sf_dir, times)
        skew = _skew_probe(spark, sf_dir, times)
    spark.stop()
    metrics = _shuffle_metrics(log_dir) if log_dir else {}
    if skew and "skew_probe" in metrics:
        skew["shuffled_records"] = metrics["skew_probe"]["shuffle_records"]
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "fixture_seconds": fixture_s,
                **({"skew_probe": skew} if skew else {}),
                **(
                    {
                        "shuffle_bytes": {k: v["shuffle_bytes"] for k, v in metrics.items()},
                        "input_bytes": {k: v["input_bytes"] for k, v in metrics.items()},
                    }
                    if metrics
                    else {}
                ),
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
