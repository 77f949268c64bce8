"""Work per row of the landed path: texts of a document are made and read once (stream_replay)."""

import datetime as dt

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pluvio import fixtures as fx
from pluvio import schemas as S
from pluvio.operators.parse import parse_fact
from pluvio.plans import run_bronze_load
from pluvio.plans.bronze_job import stage_features
from pluvio.session import drop_materialized
from pluvio.sources import read_envelopes, write_envelopes
from pluvio.sources.tables import read_bronze, replace_partitions

RUN = dt.datetime(2024, 2, 1)
KINDS = ("view", "error", "signup", "purchase", None)


def _events(spark, n=40):
    rows = [(i, dt.datetime(2024, 1, 1 + i % 3, i % 24, 54), i % 7, KINDS[i % 5], None if i % 11 == 3 else i / 4) for i in range(n)]
    return spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double")


def test_features_land_as_text_once_and_load_as_the_same_documents(spark, tmp):
    ev = _events(spark)
    features = fx.observation_features(ev)
    assert isinstance(features.schema["feature"].dataType, T.StructType)  # no VARIANT on the way to its text
    folder = write_envelopes(features, f"{tmp}/l", "x")
    run_bronze_load(spark, folder, f"{tmp}/bronze", job_id="j", run_ts=RUN)
    found = read_bronze(spark, f"{tmp}/bronze").select(F.to_json("raw_response_json").alias("doc"), "_trace_id")
    wanted = ev.select(F.to_json(fx.to_variant(fx.observation_feature(fx.record_key("unique")))), fx.station_day_trace())
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))


def test_typed_columns_read_their_text_once(spark, tmp):
    fx.observation_bronze(_events(spark)).write.parquet(f"{tmp}/b")
    plan = parse_fact(spark.read.parquet(f"{tmp}/b"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE(") and "RLIKE(try_variant_get" not in plan and "try_cast(try_variant_get" not in plan


def test_staged_features_have_a_dictionary_for_file_names_only(spark, tmp):
    folder = write_envelopes(fx.observation_features(_events(spark)), f"{tmp}/l", "x")
    staged, table, n = stage_features(read_envelopes(spark, folder, source=True), "cost")
    assert n == 40
    for uri in staged.inputFiles():
        columns = pq.ParquetFile(uri.removeprefix("file://")).metadata.row_group(0)
        for c in map(columns.column, range(columns.num_columns)):
            assert any("DICTIONARY" in e for e in c.encodings) == (c.path_in_schema == "__file"), c.path_in_schema
    drop_materialized(spark, table)


def test_a_load_cut_to_half_in_place_holds_that_half(spark, tmp):
    folder = write_envelopes(fx.observation_features(_events(spark)), f"{tmp}/l", "x")
    bronze = f"{tmp}/bronze"
    for job in ("a", "b"):
        run_bronze_load(spark, folder, bronze, job_id=job, run_ts=RUN, after_last=False)
    half = read_bronze(spark, bronze).where("_job_id = 'b' AND substr(_record_id, -1) < '8'")
    kept = {r[0] for r in half.select("_record_id").collect()}
    replace_partitions(half, bronze, S.BRONZE_PARTITIONS)
    rows = read_bronze(spark, bronze).select("_job_id", "_record_id").collect()
    assert 0 < len(kept) < 40
    assert sum(r["_job_id"] == "a" for r in rows) == 40
    assert sorted(r["_record_id"] for r in rows if r["_job_id"] == "b") == sorted(kept)
