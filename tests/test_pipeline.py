"""Round trip: landing -> bronze -> silver fact, several runs; stream vs batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pluvio import fixtures as fx
from pluvio.plans import run_bronze, run_silver_fact
from pluvio.sources import create_tables
from pluvio.streaming import stream_medallion

SF = "/root/testdata/sf0.001"
CUT = dt.datetime(2024, 1, 16)
R = [dt.datetime(2024, 2, d) for d in range(1, 8)]
FIELDS = [
    "noaa_record_id",
    "noaa_station_id",
    "hourly_precip_timestamp",
    "hourly_precip_value",
    "hourly_precip_unit",
    "hourly_precip_qc",
]


def _events(spark):
    return spark.read.parquet(f"{SF}/events.parquet")


def _expected_54(ev):
    """Plain expectation: every event at minute 54 (record ids are unique per event)."""
    return sorted(
        (
            f"obs-{r['event_id']}",
            f"ST{r['user_id']}",
            r["ts"],
            None if r["event_type"] in ("error", "signup") else r["value"],
            "mm",
            None if r["event_type"] == "view" else r["event_type"][0].upper(),
        )
        for r in ev.filter(F.minute("ts") == 54).collect()
    )


def _fact(spark, table):
    df = spark.table(table).select(*FIELDS).withColumn(
        "hourly_precip_timestamp", F.col("hourly_precip_timestamp").cast("timestamp_ntz")
    )
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture()
def tables(spark, tmp):
    db = "pluvio_rt_" + tmp.rsplit("/", 1)[-1].replace("-", "_")[-20:]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {db} LOCATION '{tmp}/db'")
    return create_tables(spark, db)


def test_round_trip_and_high_water_mark(spark, tmp, tables):
    ev = _events(spark)
    early = ev.filter(F.col("ts") < F.lit(CUT))
    feats_early = fx.observation_features(early)
    feats_all = fx.observation_features(ev)
    landing = tmp + "/landing"
    kw = dict(snapshot_root=tmp + "/snap")

    n1 = run_bronze(spark, feats_early, landing, tables["bronze"], extract_job_id="x1", load_job_id="l1", run_ts=R[0])
    assert n1 == early.count()
    c1 = run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s1", trace_id="t1", run_ts=R[1], **kw)
    exp_early = _expected_54(early)
    assert (c1["inserted"], c1["updated"]) == (len(exp_early), 0)
    assert _fact(spark, tables["fact"]) == exp_early

    # Nothing new in bronze: nothing read, nothing written.
    c_idle = run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s1b", trace_id="t1", run_ts=R[2], **kw)
    assert c_idle["source_rows"] == 0 and c_idle["affected"] == 0

    # Second extract re-sends the early window and adds the rest: updates + inserts.
    run_bronze(spark, feats_all, landing, tables["bronze"], extract_job_id="x2", load_job_id="l2", run_ts=R[3])
    c2 = run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s2", trace_id="t2", run_ts=R[4], **kw)
    exp_all = _expected_54(ev)
    assert c2["updated"] == len(exp_early)
    assert c2["inserted"] == len(exp_all) - len(exp_early)
    assert _fact(spark, tables["fact"]) == exp_all
    fact = spark.table(tables["fact"])
    assert fact.filter("_job_id = 's2'").count() == len(exp_all)
    # creation stamps are set on insert and never touched by updates
    assert fact.filter(F.col("_record_created_at") == F.lit(R[1])).count() == len(exp_early)
    # partitions follow the observation day
    assert fact.filter(F.to_date("hourly_precip_timestamp") != F.col("observed_date")).count() == 0


def test_update_only_run_and_policies(spark, tmp, tables):
    ev = _events(spark)
    feats = fx.observation_features(ev)
    kw = dict(snapshot_root=tmp + "/snap")
    run_bronze(spark, feats, tmp + "/landing", tables["bronze"], extract_job_id="x1", load_job_id="l1", run_ts=R[0])
    run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s1", trace_id="t", run_ts=R[5], **kw)
    # A re-send stamped before the silver run's insert time is skipped for good (strict >).
    run_bronze(spark, feats, tmp + "/landing", tables["bronze"], extract_job_id="x2", load_job_id="l2", run_ts=R[2])
    c = run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s2", trace_id="t", run_ts=R[6], **kw)
    assert c["source_rows"] == 0
    # A re-send stamped after it: update-only run; with insert_time the mark stays, so the next
    # run re-reads the same rows; with source_time the mark moves and the next run reads nothing.
    run_bronze(spark, feats, tmp + "/landing", tables["bronze"], extract_job_id="x3", load_job_id="l3", run_ts=R[6] + dt.timedelta(hours=1))
    c3 = run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s3", trace_id="t", run_ts=R[6], **kw)
    assert c3["inserted"] == 0 and c3["updated"] > 0
    c4 = run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s4", trace_id="t", run_ts=R[6], **kw)
    assert c4["updated"] == c3["updated"]
    c5 = run_silver_fact(
        spark, tables["bronze"], tables["fact"], job_id="s5", trace_id="t", run_ts=R[6], hwm_policy="source_time", **kw
    )
    assert c5["updated"] == c3["updated"]
    c6 = run_silver_fact(
        spark, tables["bronze"], tables["fact"], job_id="s6", trace_id="t", run_ts=R[6], hwm_policy="source_time", **kw
    )
    assert c6["source_rows"] == 0
    assert _fact(spark, tables["fact"]) == _expected_54(ev)


def test_stream_matches_batch(spark, tmp):
    ev = _events(spark)
    from pluvio.sources import write_envelopes

    days = [dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21), dt.datetime(2024, 2, 1)]
    for i in range(3):
        part = ev.filter((F.col("ts") >= F.lit(days[i])) & (F.col("ts") < F.lit(days[i + 1])))
        write_envelopes(fx.observation_features(part), tmp + "/landing", f"x{i}")
    table = "pluvio_stream_" + tmp.rsplit("/", 1)[-1].replace("-", "_")[-20:]
    args = (spark, tmp + "/landing/*", tmp + "/bronze", table, tmp + "/ckpt")
    q = stream_medallion(*args, snapshot_root=tmp + "/snap", max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    assert _fact(spark, table) == _expected_54(ev)
    bronze_rows = spark.read.parquet(tmp + "/bronze").count()
    assert bronze_rows == ev.count()
    n_jobs = spark.read.parquet(tmp + "/bronze").select("_job_id").distinct().count()
    assert n_jobs > 1  # several micro-batches
    # A rerun with no new file runs no batch and changes nothing.
    q2 = stream_medallion(*args, snapshot_root=tmp + "/snap", max_files_per_trigger=1)
    q2.awaitTermination()
    assert spark.read.parquet(tmp + "/bronze").count() == bronze_rows
    assert _fact(spark, table) == _expected_54(ev)


def _locations(spark, table):
    rows = spark.sql(f"SHOW PARTITIONS {table}").collect()
    out = {}
    for r in rows:
        spec = r[0].split("=", 1)[1]
        desc = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (observed_date = DATE'{spec}')")
        out[spec] = desc.filter("col_name = 'Location'").first()["data_type"]
    return out


@pytest.mark.parametrize("rewrite", ["partitions", "snapshot"])
def test_rewrite_modes(spark, tmp, tables, rewrite):
    ev = _events(spark)
    kw = dict(snapshot_root=tmp + "/snap", rewrite=rewrite)
    first = ev.filter(F.col("ts") < F.lit(dt.datetime(2024, 1, 20)))
    run_bronze(spark, fx.observation_features(first), tmp + "/l", tables["bronze"], extract_job_id="a", load_job_id="a", run_ts=R[0])
    run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s1", trace_id="t", run_ts=R[1], **kw)
    before = _locations(spark, tables["fact"])
    late = ev.filter(F.col("ts") >= F.lit(dt.datetime(2024, 1, 25)))
    run_bronze(spark, fx.observation_features(late), tmp + "/l", tables["bronze"], extract_job_id="b", load_job_id="b", run_ts=R[2])
    c = run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s2", trace_id="t", run_ts=R[3], **kw)
    assert c["rewrite"] == rewrite and c["updated"] == 0
    after = _locations(spark, tables["fact"])
    assert _fact(spark, tables["fact"]) == sorted(_expected_54(first) + _expected_54(late))
    if rewrite == "partitions":
        # untouched days keep their files; only the new days were written
        assert all(after[d] == loc for d, loc in before.items())
        assert c["kept"] == 0
    else:
        assert all(after[d] != loc for d, loc in before.items())


def test_partition_move_leaves_no_stale_copy(spark, tmp, tables):
    """An update that moves a record to another day rewrites both days."""
    from pyspark.sql import Row

    doc = '{{"id": "obs-1", "properties": {{"stationId": "S", "timestamp": "{ts}"}}}}'
    def bronze(ts, stamp):
        return spark.createDataFrame(
            [Row(_record_id=ts, raw=doc.format(ts=ts), _job_id="j", _trace_id="t", c=stamp, u=stamp)]
        ).select(
            "_record_id", F.parse_json("raw").alias("raw_response_json"), "_job_id", "_trace_id",
            F.col("c").cast("timestamp").alias("_record_created_at"), F.col("u").cast("timestamp").alias("_record_updated_at"),
            F.to_date(F.col("c").cast("timestamp")).alias("created_date"),
        )
    from pluvio.sources import load_table

    load_table(bronze("2024-01-01T10:54:00Z", "2024-02-01 00:00:00"), tables["bronze"])
    run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s1", trace_id="t", run_ts=R[1], snapshot_root=tmp + "/s")
    load_table(bronze("2024-01-03T10:54:00Z", "2024-02-03 00:00:00"), tables["bronze"])
    c = run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s2", trace_id="t", run_ts=R[4], snapshot_root=tmp + "/s")
    assert c["updated"] == 1 and c["rewrite"] == "partitions"
    rows = spark.table(tables["fact"]).collect()
    assert len(rows) == 1 and str(rows[0]["observed_date"]) == "2024-01-03"
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {tables['fact']}").collect()] == ["observed_date=2024-01-03"]


def test_dimension_and_silver_run(spark, tmp, tables):
    from pluvio.plans import run_silver, run_silver_dim
    from pluvio.sources import load_table

    cust = spark.read.parquet(f"{SF}/customer.parquet")
    reg = fx.station_registry_bronze(cust, updated_at=dt.datetime(2024, 3, 1), with_state=False).withColumn(
        "created_date", F.to_date("_record_created_at")
    )
    older = fx.station_registry_bronze(
        cust, updated_at=dt.datetime(2024, 2, 28), elevation_offset=1.0, record_prefix="old", with_state=False
    ).withColumn("created_date", F.to_date("_record_created_at"))
    load_table(reg.unionByName(older), tables["bronze"])
    c = run_silver_dim(spark, tables["bronze"], tables["dim"], job_id="d1", trace_id="t", run_ts=R[1], snapshot_root=tmp + "/d")
    assert c["inserted"] == cust.count() and c["updated"] == 0
    dim = spark.table(tables["dim"])
    assert dim.count() == cust.count()
    got = {r["noaa_station_id"]: r["noaa_station_elevation_m"] for r in dim.collect()}
    want = {f"ST{r['c_custkey']}": r["c_acctbal"] for r in cust.collect()}
    assert got == want  # newest version (no +1) wins
    assert dim.filter(F.length("noaa_station_geopoint") != 21).count() == 0
    schema = tables["fact"].split(".")[0].strip("`")
    counts = run_silver(spark, "trace-x", schema=schema, run_ts=R[2], snapshot_root=tmp + "/f")
    assert counts["source_rows"] == 0 and counts["job_id"]


def test_replayed_micro_batch_is_idempotent(spark, tmp):
    """foreachBatch is at-least-once: running the same batch id twice appends
    bronze once and leaves the fact unchanged."""
    from pluvio.sources import read_envelopes, write_envelopes
    from pluvio.streaming import ensure_fact_table, medallion_batch

    ev = _events(spark)
    folder = write_envelopes(fx.observation_features(ev), tmp + "/landing", "x1")
    batch = read_envelopes(spark, folder, source=True).withColumn("__batch_ts", F.lit(R[0]).cast("timestamp"))
    table = "pluvio_replay_" + tmp.rsplit("/", 1)[-1].replace("-", "_")[-20:]
    ensure_fact_table(spark, table, tmp + "/snap/initial")
    kw = dict(checkpoint=tmp + "/ckpt", bronze=tmp + "/bronze", fact_table=table, snapshot_root=tmp + "/snap", trace_id="t")
    first = medallion_batch(batch, 7, **kw)
    before = _fact(spark, table)
    again = medallion_batch(batch, 7, **kw)
    assert first["bronze_rows"] == again["bronze_rows"] == ev.count()
    assert spark.read.parquet(tmp + "/bronze").count() == ev.count()
    assert _fact(spark, table) == before == _expected_54(ev)
    assert again["inserted"] == 0 and again["updated"] == first["inserted"]


def test_shuffled_merge_path_in_job(spark, tmp, tables):
    """Above the broadcast bound the job uses the shuffled full outer join; same result."""
    ev = _events(spark)
    kw = dict(snapshot_root=tmp + "/snap", max_broadcast_rows=0)
    first = ev.filter(F.col("ts") < F.lit(CUT))
    run_bronze(spark, fx.observation_features(first), tmp + "/l", tables["bronze"], extract_job_id="a", load_job_id="a", run_ts=R[0])
    run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s1", trace_id="t", run_ts=R[1], **kw)
    run_bronze(spark, fx.observation_features(ev), tmp + "/l", tables["bronze"], extract_job_id="b", load_job_id="b", run_ts=R[2])
    c = run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s2", trace_id="t", run_ts=R[3], **kw)
    assert c["updated"] == len(_expected_54(first))
    assert _fact(spark, tables["fact"]) == _expected_54(ev)


def test_recorded_mark_equals_scanned_mark(spark, tmp, tables):
    from pluvio.operators import high_water_mark
    from pluvio.plans.silver_job import MARK_PROPERTY, table_mark
    from pluvio.sources import table_property

    ev = _events(spark)
    kw = dict(snapshot_root=tmp + "/snap")
    run_bronze(spark, fx.observation_features(ev), tmp + "/l", tables["bronze"], extract_job_id="a", load_job_id="a", run_ts=R[0])
    assert table_property(spark, tables["fact"], MARK_PROPERTY) is None
    run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s1", trace_id="t", run_ts=R[1], **kw)
    scanned = high_water_mark(spark.table(tables["fact"])).first()[0]
    assert table_mark(spark, tables["fact"]) == scanned == R[1]
    # update-only run under source_time raises the recorded mark to the bronze stamps
    run_bronze(spark, fx.observation_features(ev), tmp + "/l", tables["bronze"], extract_job_id="b", load_job_id="b", run_ts=R[2])
    run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s2", trace_id="t", run_ts=R[3], hwm_policy="source_time", **kw)
    scanned = high_water_mark(spark.table(tables["fact"])).first()[0]
    assert table_mark(spark, tables["fact"]) == scanned > R[2]


def test_many_affected_partitions_fall_back_to_snapshot(spark, tmp, tables):
    from pluvio.plans.silver_job import fact_source, merge_and_publish, merge_fact, fact_new_partitions
    from pluvio import schemas as S

    ev = _events(spark)
    run_bronze(spark, fx.observation_features(ev), tmp + "/l", tables["bronze"], extract_job_id="a", load_job_id="a", run_ts=R[0])
    target = spark.table(tables["fact"])
    source = fact_source(spark.table(tables["bronze"]), target)
    c = merge_and_publish(
        spark, source, target,
        lambda t, s, b: merge_fact(t, s, job_id="j", trace_id="t", run_ts=R[1], broadcast_source=b),
        fact_new_partitions, key=S.FACT_KEY, table=tables["fact"], snapshot_root=tmp + "/snap",
        partition_col=S.FACT_PARTITION, max_broadcast_rows=10, name="m", max_partition_switches=3,
    )
    assert c["rewrite"] == "snapshot" and c["inserted"] == len(_expected_54(ev))
    assert _fact(spark, tables["fact"]) == _expected_54(ev)


def test_publish_without_aqe(spark, tmp, tables):
    ev = _events(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        run_bronze(spark, fx.observation_features(ev), tmp + "/l", tables["bronze"], extract_job_id="a", load_job_id="a", run_ts=R[0])
        c = run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s", trace_id="t", run_ts=R[1], snapshot_root=tmp + "/s")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert c["inserted"] == len(_expected_54(ev))
    assert _fact(spark, tables["fact"]) == _expected_54(ev)


def test_stream_into_catalog_tables(spark, tmp, tables):
    from pluvio.sources import write_envelopes

    ev = _events(spark)
    write_envelopes(fx.observation_features(ev), tmp + "/landing", "x1")
    q = stream_medallion(spark, tmp + "/landing/*", tables["bronze"], tables["fact"], tmp + "/ckpt", snapshot_root=tmp + "/snap")
    q.awaitTermination()
    assert q.exception() is None
    assert spark.table(tables["bronze"]).count() == ev.count()
    assert _fact(spark, tables["fact"]) == _expected_54(ev)


def test_stream_picks_up_new_landings(spark, tmp, tables):
    """Processing-time trigger: files landed while the query runs are merged on the next batch."""
    from pluvio.sources import write_envelopes

    ev = _events(spark)
    early = ev.filter(F.col("ts") < F.lit(CUT))
    write_envelopes(fx.observation_features(early), tmp + "/landing", "x1")
    q = stream_medallion(
        spark, tmp + "/landing/*", tables["bronze"], tables["fact"], tmp + "/ckpt",
        snapshot_root=tmp + "/snap", available_now=False, processing_time="1 second",
    )
    try:
        q.processAllAvailable()
        assert _fact(spark, tables["fact"]) == _expected_54(early)
        write_envelopes(fx.observation_features(ev.filter(F.col("ts") >= F.lit(CUT))), tmp + "/landing", "x2")
        q.processAllAvailable()
        assert _fact(spark, tables["fact"]) == _expected_54(ev)
    finally:
        q.stop()
    assert q.exception() is None


def test_command_line(spark, tmp):
    from pluvio.__main__ import main
    from pluvio.sources import write_envelopes

    schema = "pluvio_cli_" + tmp.rsplit("/", 1)[-1].replace("-", "_")[-20:]
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{tmp}/db'")
    main(["create-tables", "--schema", schema], spark=spark)
    ev = _events(spark)
    folder = write_envelopes(fx.observation_features(ev), tmp + "/landing", "x1")
    loaded = main(["bronze-load", "--landing", folder, "--schema", schema], spark=spark)
    assert loaded["rows"] == ev.count()
    out = main(["silver", "--schema", schema, "--trace-id", "t", "--snapshot-root", tmp + "/snap", "--dimension"], spark=spark)
    assert out["fact"]["inserted"] == len(_expected_54(ev))
    assert out["dim"]["source_rows"] > 0


def test_scratch_source_is_dropped(spark, tmp, tables):
    from pluvio.session import scratch_schema

    ev = _events(spark)
    run_bronze(spark, fx.observation_features(ev), tmp + "/l", tables["bronze"], extract_job_id="a", load_job_id="a", run_ts=R[0])
    run_silver_fact(spark, tables["bronze"], tables["fact"], job_id="s", trace_id="t", run_ts=R[1], snapshot_root=tmp + "/s")
    left = [t.name for t in spark.catalog.listTables(scratch_schema(spark)) if "fact_merge" in t.name]
    assert left == []
