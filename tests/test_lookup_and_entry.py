import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from pluvio.operators import next_cursor, observations, station, stations_page

SF = "/root/testdata/sf0.001"


def _obs(spark):
    rows = [
        ("ST1", f"obs-{i}", dt.datetime(2026, 1, 1) + dt.timedelta(hours=i)) for i in range(10)
    ] + [("ST2", "obs-x", dt.datetime(2026, 1, 1))]
    return spark.createDataFrame(rows, "noaa_station_id string, noaa_record_id string, hourly_precip_timestamp timestamp")


def test_observations_falsy_parameters_are_omitted(spark):
    df = _obs(spark)
    assert observations(df, "ST1").count() == 10
    assert observations(df, "ST1", start="", end=None, limit=0).count() == 10
    got = observations(df, "ST1", start="2026-01-01 02:00:00", end="2026-01-01 05:00:00").count()
    assert got == 4  # inclusive bounds


def test_observations_limit_is_newest_first(spark):
    out = [r["noaa_record_id"] for r in observations(_obs(spark), "ST1", limit=3).collect()]
    assert out == ["obs-9", "obs-8", "obs-7"]


def test_station_and_paging(spark):
    df = spark.range(1234).select(
        F.concat(F.lit("ST"), F.col("id").cast("string")).alias("noaa_station_id"),
        (F.col("id") % 3).cast("string").alias("state"),
    )
    assert station(df, "ST77").count() == 1
    seen, cursor, pages = [], None, 0
    while True:
        page = stations_page(df, limit=500, cursor=cursor)
        keys = [r[0] for r in page.select("noaa_station_id").collect()]
        seen += keys
        pages += 1
        cursor = next_cursor(page, limit=500)
        if cursor is None:
            break
    assert pages == 3 and len(seen) == 1234 and len(set(seen)) == 1234 and seen == sorted(seen)
    assert stations_page(df, state="1", limit=10).count() == 10
    assert stations_page(df, id="ST5").count() == 1


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "noaa_record_id" in df.columns


def test_every_query_has_an_oracle():
    from pluvio import queries as Q

    assert set(Q.queries()) == set(Q.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["fact_minute54", "merge_upsert_fact", "merge_upsert_dim", "write_dispositions"])
def test_queries_match_oracle_small(spark, name):
    con = duckdb.connect()
    for t in ("events", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    key = sorted(df.columns)
    mine = sorted(tuple(str(r[c]) for c in key) for r in df.collect())
    cols = rel.columns
    theirs = sorted(tuple(str(r[cols.index(c)]) for c in key) for r in rel.fetchall())
    assert mine == theirs


def test_last_day_window(spark):
    from pluvio.operators import last_day

    now = dt.datetime(2026, 1, 1, 9, 30)
    got = [r["noaa_record_id"] for r in last_day(_obs(spark), "ST1", now=now).collect()]
    assert sorted(got) == [f"obs-{i}" for i in range(10)]  # all within (now - 1 day, now]
    assert last_day(_obs(spark), "ST1", now=dt.datetime(2026, 1, 1, 5, 0)).count() == 6


def test_geography_view(spark):
    from pluvio.functions import geog_point_wkb
    from pluvio.sources import geography_view

    spark.createDataFrame([(1.0, 2.0)], "lon double, lat double").select(
        geog_point_wkb("lon", "lat").alias("noaa_station_geopoint")
    ).createOrReplaceTempView("pluvio_geo_src")
    v = geography_view(spark, "pluvio_geo_src", "pluvio_geo_v", enable=True)
    assert spark.sql("SELECT st_srid(noaa_station_geopoint) AS s FROM pluvio_geo_v").first()["s"] == 4326
    assert v.count() == 1


def test_observations_prune_fact_days(spark, tmp):
    df = _obs(spark).withColumn("observed_date", F.to_date("hourly_precip_timestamp"))
    extra = df.withColumn("hourly_precip_timestamp", F.col("hourly_precip_timestamp") + F.expr("INTERVAL 3 DAYS")).withColumn(
        "observed_date", F.to_date("hourly_precip_timestamp")
    )
    df.unionByName(extra).write.partitionBy("observed_date").parquet(tmp + "/fact")
    fact = spark.read.parquet(tmp + "/fact")
    out = observations(fact, "ST1", start="2026-01-01 02:00:00", end="2026-01-01 05:00:00")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "observed_date" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert out.count() == 4


def test_geography_view_requires_the_flag(spark):
    from pluvio.sources import geography_view

    spark.conf.set("spark.sql.geospatial.enabled", "false")
    with pytest.raises(RuntimeError, match="geospatial"):
        geography_view(spark, "pluvio_geo_src_missing", "v")
