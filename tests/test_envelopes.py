import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from pluvio.operators import to_bronze
from pluvio.sources import quarantined_envelopes, read_envelopes, write_envelopes

RUN = dt.datetime(2026, 2, 1, 12, 0, 0)


def _write_lines(folder, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "part-0.json"), "w") as f:
        for line in lines:
            f.write(line + "\n")


def _feature(i):
    return {"id": f"obs-{i}", "properties": {"stationId": "KBOS", "timestamp": f"2026-04-24T{i:02d}:54:00+00:00"}}


def test_valid_and_empty(spark, tmp):
    _write_lines(
        tmp + "/l",
        [
            json.dumps({"trace_id": "t1", "observations": {"features": [_feature(1), _feature(2)]}}),
            json.dumps({"trace_id": "t2", "observations": {"features": []}}),
        ],
    )
    env = read_envelopes(spark, tmp + "/l")
    bronze = to_bronze(env, job_id="job", run_ts=RUN)
    rows = bronze.orderBy("_record_created_at").collect()
    assert len(rows) == 2
    assert rows[0]["_trace_id"] == "t1" and rows[0]["_job_id"] == "job"
    assert rows[1]["_record_created_at"] - rows[0]["_record_created_at"] == dt.timedelta(microseconds=1)
    assert rows[0]["_record_id"] != rows[1]["_record_id"]
    assert rows[0]["created_date"] == RUN.date()


@pytest.mark.parametrize(
    "line,reason",
    [
        ('{"trace_id": "t", "observations": {}}', "missing observations.features"),
        ('{"observations": {"features": []}}', "missing trace_id"),
        ('{"trace_id": "t"}', "missing observations"),
        ("this is not json", "corrupt line"),
    ],
)
def test_bad_envelopes(spark, tmp, line, reason):
    good = json.dumps({"trace_id": "ok", "observations": {"features": [_feature(1)]}})
    _write_lines(tmp + "/l", [good, line])
    with pytest.raises(Exception, match="invalid envelope"):
        read_envelopes(spark, tmp + "/l").collect()
    assert read_envelopes(spark, tmp + "/l", on_bad="quarantine").count() == 1
    bad = quarantined_envelopes(spark, tmp + "/l").collect()
    assert [r["_envelope_error"] for r in bad] == [reason]


def test_write_then_read_chunks_large_traces(spark, tmp):
    feats = spark.range(23).select(
        F.when(F.col("id") < 20, F.lit("hot")).otherwise(F.lit("cold")).alias("trace_id"),
        F.parse_json(F.to_json(F.struct(F.concat(F.lit("obs-"), F.col("id").cast("string")).alias("id")))).alias(
            "feature"
        ),
    ).coalesce(1)
    folder = write_envelopes(feats, tmp + "/landing", "extract-1", max_features=7)
    assert folder.endswith("/extract-1")
    env = read_envelopes(spark, folder)
    sizes = sorted((r["trace_id"], r["n"]) for r in env.select("trace_id", F.size("observations.features").alias("n")).collect())
    assert all(n <= 7 for _, n in sizes)
    assert sum(n for t, n in sizes if t == "hot") == 20 and sum(n for t, n in sizes if t == "cold") == 3
    assert len([t for t, _ in sizes if t == "hot"]) >= 3
    ids = to_bronze(env, job_id="j", run_ts=RUN).select(
        F.try_variant_get("raw_response_json", "$.id", "string").alias("id")
    )
    assert ids.distinct().count() == 23
    # order inside an envelope follows the input order
    lists = env.select(
        F.transform("observations.features", lambda x: F.try_variant_get(x, "$.id", "string")).alias("ids")
    ).collect()
    for r in lists:
        nums = [int(i.split("-")[1]) for i in r["ids"]]
        assert nums == sorted(nums)


def test_bronze_load_quarantine(spark, tmp):
    from pluvio.plans import run_bronze_load

    good = json.dumps({"trace_id": "ok", "observations": {"features": [_feature(1), _feature(2)]}})
    _write_lines(tmp + "/l", [good, "not json", '{"trace_id": "t"}'])
    n = run_bronze_load(
        spark, tmp + "/l", tmp + "/bronze", job_id="j", run_ts=RUN, on_bad="quarantine", quarantine_path=tmp + "/q"
    )
    assert n == 2
    q = spark.read.json(tmp + "/q")
    assert sorted(r["_envelope_error"] for r in q.collect()) == ["corrupt line", "missing observations"]
    with pytest.raises(Exception, match="invalid envelope"):
        run_bronze_load(spark, tmp + "/l", tmp + "/bronze2", job_id="j2", run_ts=RUN)


def test_write_envelopes_rejects_null_trace(spark, tmp):
    feats = spark.range(3).select(
        F.when(F.col("id") == 1, F.lit(None)).otherwise(F.lit("t")).cast("string").alias("trace_id"),
        F.parse_json(F.lit('{"id": "x"}')).alias("feature"),
    )
    with pytest.raises(Exception, match="NULL trace_id"):
        write_envelopes(feats, tmp + "/l", "j")
