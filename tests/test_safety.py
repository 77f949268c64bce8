"""Interrupted, replayed and oddly configured runs lose no rows."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pluvio import fixtures as fx
from pluvio.operators import next_cursor, stations_page
from pluvio.plans import run_bronze, run_silver_fact
from pluvio.session import checkpoint_root
from pluvio.sources import create_tables, load_table, scan
from pluvio.sources.tables import WRITE_TRUNCATE, table_exists
from test_pipeline import R, _events, _expected_54, _fact, tables  # noqa: F401


@pytest.mark.parametrize("rewrite", ["snapshot", "partitions"])
def test_publish_stopped_after_any_statement_heals(spark, tmp, tables, monkeypatch, rewrite):  # noqa: F811
    ev = _events(spark)
    kw = dict(snapshot_root=tmp + "/snap", rewrite=rewrite, trace_id="t")
    run_bronze(spark, fx.observation_features(ev), tmp + "/l", tables["bronze"], extract_job_id="a", load_job_id="a", run_ts=R[0])
    run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s1", run_ts=R[1], **kw)
    run_bronze(spark, fx.observation_features(ev), tmp + "/l", tables["bronze"], extract_job_id="b", load_job_id="b", run_ts=R[2])
    plain = SparkSession.sql
    for stop in (0, 1, 5):
        left = [stop]

        def sql(self, text, *args, left=left, **kwargs):
            if text.startswith("ALTER TABLE") and "TBLPROPERTIES" not in text:
                if left[0] == 0:
                    raise RuntimeError("the driver dies here")
                left[0] -= 1
            return plain(self, text, *args, **kwargs)

        with monkeypatch.context() as m:
            m.setattr(SparkSession, "sql", sql)
            with pytest.raises(RuntimeError, match="dies here"):
                run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s2", run_ts=R[3], **kw)
        spark.sql(f"REFRESH TABLE {tables['fact']}")
        assert spark.table(tables["fact"]).count() == len(_expected_54(ev))  # no row out of sight
    run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s2", run_ts=R[3], **kw)
    assert _fact(spark, tables["fact"]) == _expected_54(ev)


ZONED = """
import sys, tempfile
sys.path.insert(0, {repo!r})
from pluvio.session import build_session
spark = build_session(master="local[2]", shuffle_partitions=2)
from pyspark.sql import functions as F
from pluvio.operators.bronze import run_timestamp
import datetime as dt
at = dt.datetime(2024, 11, 3, 6, 30)
us = spark.range(1).select(F.unix_micros(run_timestamp(at))).first()[0]
assert us == 1730615400000000, us
from pluvio.plans.silver_job import mark_micros, table_mark
from pluvio.sources import create_tables, set_table_property
"""


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_run_stamp_is_utc_in_any_process_zone(zone):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ZONED.format(repo=repo).replace("from pluvio.sources import create_tables, set_table_property\n", "")
    done = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": zone}, capture_output=True, text=True, timeout=200)
    assert done.returncode == 0, done.stderr[-1500:]


def test_truncate_replaces_all_partitions_whatever_the_session_says(spark, tmp):
    names = create_tables(spark, "pluvio_truncate", location=tmp + "/db")
    rows = spark.table(names["fact"])
    try:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        for day in ("2024-01-01", "2024-01-02"):
            row = spark.range(1).select(
                *(F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c != "observed_date"), F.lit(day).cast("date").alias("observed_date")
            )
            load_table(row, names["fact"], disposition=WRITE_TRUNCATE)
        assert [str(r[0]) for r in spark.table(names["fact"]).select("observed_date").collect()] == ["2024-01-02"]
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
        spark.sql("DROP SCHEMA pluvio_truncate CASCADE")


def test_every_page_and_capped_scans(spark, tmp):
    df = spark.range(6).select(F.concat(F.lit("ST"), F.col("id").cast("string")).alias("noaa_station_id"))
    seen, cursor = [], None
    while True:
        page = stations_page(df, limit=4, cursor=cursor)
        seen += [r[0] for r in page.collect()]
        cursor = next_cursor(page)
        if cursor is None:
            break
    assert seen == [f"ST{k}" for k in range(6)]
    df.write.parquet(tmp + "/p")
    assert scan(spark, tmp + "/p", max_rows=0).count() == 0 and scan(spark, tmp + "/p").count() == 6
    assert not table_exists(spark, tmp + "/missing") and table_exists(spark, tmp + "/p")


@pytest.mark.parametrize("catalog", [False, True])
def test_broken_append_is_replaced_by_the_replay(spark, tmp, tables, catalog):  # noqa: F811
    """A replayed micro-batch overwrites what a broken append left; other batches' rows stay."""
    from pluvio.sources import read_bronze, read_envelopes, replace_partitions, write_envelopes
    from pluvio.streaming.medallion import batch_job_id, ensure_fact_table, medallion_batch

    ev = _events(spark)
    folder = write_envelopes(fx.observation_features(ev), tmp + "/landing", "x1")
    batch = read_envelopes(spark, folder, source=True).withColumn("__batch_ts", F.lit(R[0]).cast("timestamp"))
    bronze = tables["bronze"] if catalog else tmp + "/bronze"
    fact = "pluvio_broken_" + tmp.rsplit("/", 1)[-1].replace("-", "_")[-20:]
    ensure_fact_table(spark, fact, tmp + "/snap/initial")
    kw = dict(checkpoint=tmp + "/ckpt", bronze=bronze, fact_table=fact, snapshot_root=tmp + "/snap", trace_id="t")
    medallion_batch(batch, 6, **kw)
    medallion_batch(batch, 7, **kw)
    whole = sorted(map(str, read_bronze(spark, bronze).drop("raw_response_json").collect()))
    rest = read_bronze(spark, bronze).filter(F.col("_job_id") == batch_job_id(tmp + "/ckpt", 7)).limit(5)
    replace_partitions(spark.createDataFrame(rest.collect(), rest.schema), bronze, ["created_date", "_job_id"])
    assert read_bronze(spark, bronze).count() == ev.count() + 5
    medallion_batch(batch, 7, **kw)
    assert sorted(map(str, read_bronze(spark, bronze).drop("raw_response_json").collect())) == whole
    assert _fact(spark, fact) == _expected_54(ev)


def test_no_local_scratch_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())
