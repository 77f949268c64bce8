"""Merge cost that follows the batch: key summaries, bucketed targets, days that are not known."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio import fixtures as fx
from pluvio import schemas as S
from pluvio.plans import merge_fact, run_bronze, run_silver_fact
from pluvio.plans.silver_job import merge_and_publish
from pluvio.sources import create_tables, key_summary
from pluvio.sources.key_summary import bloom, days_that_may_hold, may_hold, summaries
from test_pipeline import CUT, R, _events, _expected_54, _fact, tables  # noqa: F401


def test_filters_miss_no_key():
    r = np.random.default_rng(1)
    keys = r.integers(-(1 << 63), 1 << 63, 5000, dtype=np.int64)
    bits = bloom(keys)
    assert all(may_hold(bits, keys[k : k + 1]) for k in range(len(keys)))
    others = r.integers(-(1 << 63), 1 << 63, 20_000, dtype=np.int64)
    assert sum(may_hold(bits, others[k : k + 1]) for k in range(len(others))) < 5
    assert not may_hold(bits, others[:0]) and not may_hold(bloom(keys[:0]), others[:9])


def test_runs_end_with_files_and_sizes(spark, monkeypatch):
    monkeypatch.setattr(key_summary, "RUN_KEYS", 10)
    rows = [(f"f{k // 25}", f"k{k:03}", k) for k in range(50)]
    got = summaries(spark.createDataFrame(rows, "file string, k string, h long").coalesce(1)).orderBy("lo").collect()
    assert [(r["file"], r["n"], r["lo"], r["hi"]) for r in got] == [
        ("f0", 10, "k000", "k009"), ("f0", 10, "k010", "k019"), ("f0", 5, "k020", "k024"),
        ("f1", 10, "k025", "k034"), ("f1", 10, "k035", "k044"), ("f1", 5, "k045", "k049"),
    ]


def _two_runs(spark, tmp, names, first, second, **kw):
    run_bronze(spark, fx.observation_features(first), tmp + "/l", names["bronze"], extract_job_id="a", load_job_id="a", run_ts=R[0])
    run_silver_fact(spark, names["bronze"], names["fact"], job_id="s1", trace_id="t", run_ts=R[1], snapshot_root=tmp + "/snap")
    run_bronze(spark, fx.observation_features(second), tmp + "/l", names["bronze"], extract_job_id="b", load_job_id="b", run_ts=R[2])
    return run_silver_fact(spark, names["bronze"], names["fact"], job_id="s2", trace_id="t", run_ts=R[3], snapshot_root=tmp + "/snap", **kw)


def _late(ev, days=2):
    """The events of the last days alone: their keys lie in few days of the fact table."""
    last = ev.agg(F.max("ts")).first()[0]
    return ev.filter(F.col("ts") > F.lit(last) - F.expr(f"INTERVAL {days} DAY"))


def test_keys_are_read_of_the_days_that_may_hold_one(spark, tmp, tables):  # noqa: F811
    ev = _events(spark)
    counts = _two_runs(spark, tmp, tables, ev, _late(ev))
    assert counts["days"] > 10 and 1 <= counts["days_read"] <= 4
    assert counts["updated"] == len(_expected_54(_late(ev))) and _fact(spark, tables["fact"]) == _expected_54(ev)


@pytest.mark.parametrize("fault", ["always", "no summaries", "too many keys"])
def test_a_wrong_may_costs_only_reading(spark, tmp, tables, monkeypatch, fault):  # noqa: F811
    ev = _events(spark)
    if fault == "always":
        monkeypatch.setattr(key_summary, "may_hold", lambda bits, hashes: True)
    elif fault == "too many keys":
        monkeypatch.setattr(key_summary, "MAX_KEYS", 0)
    else:
        monkeypatch.setattr(key_summary, "FOLDER", "_other")
        monkeypatch.setattr("pluvio.plans.silver_job.write_summaries", lambda *a: None)
    counts = _two_runs(spark, tmp, tables, ev, _late(ev))
    assert counts.get("days_read", 99) > 4 or fault == "always"
    assert counts["updated"] == len(_expected_54(_late(ev))) and _fact(spark, tables["fact"]) == _expected_54(ev)


def test_key_scan_prunes_partitions(spark, tmp, tables):  # noqa: F811
    ev = _events(spark)
    _two_runs(spark, tmp, tables, ev, _late(ev))
    fact = spark.table(tables["fact"])
    one = fact.orderBy(F.desc("hourly_precip_timestamp")).limit(1)
    days, total = days_that_may_hold(spark, fact, one, key=S.FACT_KEY, partition_col=S.FACT_PARTITION)
    assert days == [one.first()["observed_date"]] and total > 10
    unknown = spark.createDataFrame([("nowhere",), (None,)], f"{S.FACT_KEY} string")
    assert days_that_may_hold(spark, fact, unknown, key=S.FACT_KEY, partition_col=S.FACT_PARTITION)[0] == []


def _bucketed(spark, tmp, n):
    schema = "pluvio_b_" + re.sub(r"\W", "_", tmp)[-20:]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{tmp}/db'")
    return create_tables(spark, schema, fact_buckets=n)


def test_bucketed_runs_equal_plain_runs(spark, tmp):
    ev = _events(spark)
    names = _bucketed(spark, tmp, 8)
    first = ev.filter(F.col("ts") < F.lit(CUT))
    counts = _two_runs(spark, tmp, names, first, ev)
    assert counts["updated"] == len(_expected_54(first)) and _fact(spark, names["fact"]) == _expected_54(ev)
    key = spark.table(names["fact"]).first()[S.FACT_KEY]
    assert spark.table(names["fact"]).filter(F.col(S.FACT_KEY) == key).count() == 1  # by bucket pruning


def test_a_bucketed_target_is_not_shuffled(spark, tmp):
    ev = _events(spark)
    names = _bucketed(spark, tmp, 8)
    _two_runs(spark, tmp, names, ev, ev)
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        target = spark.table(names["fact"])
        source = target.limit(9).select(*S.FACT_COLUMNS).withColumn("hourly_precip_value", F.lit(-1.0))
        plans = {}
        for co_located in (True, False):
            merged = merge_fact(target, source, job_id="j", trace_id="t", run_ts=R[3], co_located=co_located)
            plans[co_located] = merged._jdf.queryExecution().executedPlan().toString()
            assert merged.where("_action = 'update' AND hourly_precip_value = -1").count() == 9
            assert merged.count() == target.count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert plans[True].count("Exchange hashpartitioning") == plans[False].count("Exchange hashpartitioning") - 1
    join = plans[True][plans[True].index("SortMergeJoin") :]
    scan = join[: join.index("FileScan")]
    assert "Exchange" not in scan and "Bucketed: true" in join


def test_co_located_merge_with_null_keys(spark):
    r = random.Random(2)
    cols = f"{S.FACT_KEY} string, v int"
    from pluvio.operators import merge_upsert

    target = spark.createDataFrame([(f"k{k}", k) for k in range(60)] + [(None, -1), (None, -2)], cols)
    source = spark.createDataFrame([(f"k{r.randrange(30, 60) if k < 20 else 100 + k}", 1000 + k) for k in range(20, 40)] + [(f"k{k}", 500 + k) for k in range(10)] + [(None, 7), (None, 8)], cols)
    args = (target, source, S.FACT_KEY, ["v"], [S.FACT_KEY, "v"])
    plain = sorted(map(str, merge_upsert(*args).collect()))
    assert sorted(map(str, merge_upsert(*args, co_located=True).collect())) == plain


def test_days_that_are_not_known_are_a_partition(spark, tmp, tables):  # noqa: F811
    """An explicit partition rewrite stays one when a row has no day."""
    cols = spark.table(tables["fact"]).columns

    def batch(rows, ts):
        df = spark.createDataFrame(rows, f"{S.FACT_KEY} string, day string, hourly_precip_value double")
        df = df.select(S.FACT_KEY, "hourly_precip_value", F.to_timestamp("day").alias("hourly_precip_timestamp"))
        for c in S.FACT_COLUMNS:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast(S.FACT[c].dataType))
        return merge_and_publish(
            spark, df, spark.table(tables["fact"]),
            lambda t, s, b: merge_fact(t, s, job_id="j", trace_id="t", run_ts=ts, broadcast_source=b),
            lambda s: s.select(F.to_date("hourly_precip_timestamp").alias(S.FACT_PARTITION)),
            key=S.FACT_KEY, table=tables["fact"], snapshot_root=tmp + "/snap", partition_col=S.FACT_PARTITION,
            name="m", rewrite="partitions",
        )

    assert batch([("a", "2024-01-01", 1.0), ("b", None, 2.0), ("c", "2024-01-02", 3.0)], R[0])["rewrite"] == "partitions"
    again = batch([("b", "2024-01-02", 4.0), ("a", None, 5.0)], R[1])
    assert again["rewrite"] == "partitions" and again["updated"] == 2
    got = {r[S.FACT_KEY]: (str(r["observed_date"]), r["hourly_precip_value"]) for r in spark.table(tables["fact"]).select(*cols).collect()}
    assert got == {"a": ("None", 5.0), "b": ("2024-01-02", 4.0), "c": ("2024-01-02", 3.0)}


def test_a_source_is_broadcast_only_within_its_bound(spark, monkeypatch):
    from pluvio.operators import merge, merge_upsert

    cols = f"{S.FACT_KEY} string, v int"
    target = spark.createDataFrame([(f"k{k}", k) for k in range(40)] + [(None, -1)], cols)
    source = spark.createDataFrame([(f"k{k}", 100 + k) for k in range(30, 50)] + [(None, 7)], cols)
    args = (target, source, S.FACT_KEY, ["v"], [S.FACT_KEY, "v"])
    assert merge.source_bytes(source) == 21 * (16 + 8) + 20 * 3
    rows, plans = [], []
    for bound in (1 << 20, 100):
        monkeypatch.setattr(merge, "BROADCAST_BYTES", bound)
        merged = merge_upsert(*args, broadcast_source=True)
        plans.append(merged._jdf.queryExecution().optimizedPlan().toString())
        rows.append(sorted(map(str, merged.collect())))
    assert rows[0] == rows[1]
    assert "FullOuter" not in plans[0] and "FullOuter" in plans[1]
