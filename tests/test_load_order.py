"""Order over a whole load: chunks of a trace, several envelopes, several extracts; equal stamps; loads run again."""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from pluvio.operators import latest_per_key
from pluvio.plans import run_bronze, run_bronze_load
from pluvio.sources import WRITE_TRUNCATE, load_table, read_bronze, write_envelopes

RUN = dt.datetime(2024, 2, 1, 12, 0, 0)


def _features(spark, lo, hi, key=10, parts=4, other=7):
    """Documents ``lo .. hi - 1`` in this order over several partitions, all of one trace but every ``other``-th."""
    rows = spark.range(lo, hi, 1, parts)
    doc = F.struct(F.concat(F.lit("obs-"), (F.col("id") % key).cast("string")).alias("id"), F.col("id").alias("n"))
    trace = F.when(F.col("id") % other == 0, F.lit("seventh")).otherwise(F.lit("hot"))
    return rows.select(trace.alias("trace_id"), F.parse_json(F.to_json(doc)).alias("feature"))


def _rows(spark, bronze):
    n = F.try_variant_get("raw_response_json", "$.n", "long").alias("n")
    return read_bronze(spark, bronze).select(n, "_record_id", "_job_id", "_trace_id", "_record_created_at", "_record_updated_at")


def _in_stamp_order(rows, trace):
    got = [r for r in rows if r["_trace_id"] == trace]
    return [r["n"] for r in sorted(got, key=lambda r: r["_record_updated_at"])]


def test_stamps_rise_over_chunks_and_envelopes(spark, tmp):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # a landed file is read by several tasks
    try:
        n = run_bronze(spark, _features(spark, 0, 900), tmp + "/l", tmp + "/b", extract_job_id="x", load_job_id="l", run_ts=RUN, max_features=60)
        rows = _rows(spark, tmp + "/b").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert n == 900 and len({r["_record_id"] for r in rows}) == 900
    assert len({r["_record_updated_at"] for r in rows}) == 900
    for trace in ("hot", "seventh"):
        assert _in_stamp_order(rows, trace) == [k for k in range(900) if (k % 7 == 0) == (trace == "seventh")]
    first = min(r["_record_created_at"] for r in rows)
    assert max(r["_record_created_at"] for r in rows) - first == dt.timedelta(microseconds=899)
    assert [r["_record_id"] for r in sorted(rows, key=lambda r: r["_record_updated_at"])] == sorted(r["_record_id"] for r in rows)
    assert all(re.fullmatch(r"[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", r["_record_id"]) for r in rows)


def test_extracts_of_one_load_go_by_landing_time(spark, tmp):
    write_envelopes(_features(spark, 0, 50), tmp + "/l", "z-first", max_features=9)
    time.sleep(1.1)
    write_envelopes(_features(spark, 50, 100), tmp + "/l", "a-second", max_features=9)
    run_bronze_load(spark, tmp + "/l/*", tmp + "/b", job_id="l", run_ts=RUN)
    rows = _rows(spark, tmp + "/b").collect()
    assert _in_stamp_order(rows, "hot") == [k for k in range(100) if k % 7]


def test_lines_of_one_file_keep_their_order(spark, tmp):
    os.makedirs(tmp + "/l")
    with open(tmp + "/l/a.json", "w") as f:
        for line in range(40):
            docs = [{"id": "obs-1", "n": 3 * line + k} for k in range(3)] if line % 5 else []
            f.write(json.dumps({"trace_id": "t", "observations": {"features": docs}}) + "\n")
    run_bronze_load(spark, tmp + "/l", tmp + "/b", job_id="l", run_ts=RUN)
    rows = _rows(spark, tmp + "/b").collect()
    assert _in_stamp_order(rows, "t") == [3 * line + k for line in range(40) if line % 5 for k in range(3)]


def test_a_load_run_again_is_there_once(spark, tmp):
    write_envelopes(_features(spark, 0, 90), tmp + "/l", "x")
    kw = dict(run_ts=RUN)
    run_bronze_load(spark, tmp + "/l/x", tmp + "/b", job_id="007", **kw)  # an id that looks like a number
    run_bronze_load(spark, tmp + "/l/x", tmp + "/b", job_id="other", **kw)
    before = sorted(map(tuple, _rows(spark, tmp + "/b").collect()))
    run_bronze_load(spark, tmp + "/l/x", tmp + "/b", job_id="other", **kw)
    assert sorted(map(tuple, _rows(spark, tmp + "/b").collect())) == before
    assert {r[2] for r in before} == {"007", "other"} and len(before) == 180


def test_a_later_load_is_never_older(spark, tmp):
    write_envelopes(_features(spark, 0, 90), tmp + "/l", "x")
    run_bronze_load(spark, tmp + "/l/x", tmp + "/b", job_id="one", run_ts=RUN)
    run_bronze_load(spark, tmp + "/l/x", tmp + "/b", job_id="two", run_ts=RUN - dt.timedelta(seconds=5))
    run_bronze_load(spark, tmp + "/l/x", tmp + "/b", job_id="three", run_ts=RUN + dt.timedelta(microseconds=60))
    span = {
        r["_job_id"]: (r["lo"], r["hi"])
        for r in _rows(spark, tmp + "/b").groupBy("_job_id").agg(F.min("_record_created_at").alias("lo"), F.max("_record_created_at").alias("hi")).collect()
    }
    assert span["one"][1] < span["two"][0] and span["two"][1] < span["three"][0]


def test_equal_stamps_have_one_winner(spark, tmp):
    """Two loads with the same stamps: the later run wins, whatever the order of evaluation."""
    kw = dict(max_features=8, after_last=False)
    one = dict(key=2000, other=2001)
    later = RUN + dt.timedelta(milliseconds=1)
    docs = _features(spark, 1, 2000, **one)
    run_bronze(spark, docs, tmp + "/l", tmp + "/c", extract_job_id="x", load_job_id="l2", run_ts=RUN, **kw)
    docs = _features(spark, 1001, 2000, **one)
    run_bronze(spark, docs, tmp + "/l", tmp + "/c", extract_job_id="y", load_job_id="l3", run_ts=later, **kw)
    rows = read_bronze(spark, tmp + "/c").withColumn("id", F.try_variant_get("raw_response_json", "$.id", "string"))
    assert rows.groupBy("_record_updated_at").count().where("count > 1").count() == 999
    for parts in (1, 5):
        won = latest_per_key(rows.repartition(parts), "id").where("int(substr(id, 5)) > 1000").select("_job_id").distinct()
        assert [r[0] for r in won.collect()] == ["l3"]


def _schema(spark, tmp):
    name = "pluvio_load_" + re.sub(r"\W", "_", tmp)[-24:]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name} LOCATION '{tmp}/db'")
    return name


@pytest.mark.parametrize("disposition", ["WRITE_APPEND", "WRITE_EMPTY", WRITE_TRUNCATE])
@pytest.mark.parametrize("catalog", [False, True])
def test_a_load_is_evaluated_once(spark, tmp, disposition, catalog):
    target = _schema(spark, tmp) + ".once" if catalog else tmp + "/t"
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(50).select(F.col("id"), F.lit("2026-01-01").cast("date").alias("day")).mapInArrow(count, "id long, day date")
    assert load_table(rows, target, disposition=disposition, partition_col="day") == 50 and seen.value == 50
    with pytest.raises(ValueError, match="empty"):
        load_table(rows.where("id < 0"), target, disposition=disposition, partition_col="day")
    there = spark.table(target) if catalog else spark.read.parquet(target)
    assert there.count() == 50
    if disposition == WRITE_TRUNCATE:
        assert load_table(rows.where("id < 20"), target, disposition=disposition, partition_col="day") == 20
        assert (spark.table(target) if catalog else spark.read.parquet(target)).count() == 20


def test_an_empty_load_makes_no_target(spark, tmp):
    from pluvio.sources import table_exists

    for target in (tmp + "/none", _schema(spark, tmp) + ".none"):
        with pytest.raises(ValueError, match="cannot be empty"):
            load_table(spark.range(0), target)
        assert not table_exists(spark, target)


def test_envelopes_are_written_without_a_shuffle(spark, tmp):
    folder = write_envelopes(_features(spark, 0, 100, parts=3), tmp + "/l", "x", max_features=10)
    files = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
    assert len(files) == 3  # one file per input partition, in its order
    seen = []
    for f in files:
        with open(f"{folder}/{f}") as lines:
            for line in lines:
                env = json.loads(line)
                assert len(env["observations"]["features"]) <= 10
                seen += [d["n"] for d in env["observations"]["features"] if env["trace_id"] == "hot"]
    assert seen == [k for k in range(100) if k % 7]
