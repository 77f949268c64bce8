import datetime as dt

from pluvio.operators import latest_per_key, routine_reports

T0 = dt.datetime(2026, 1, 1, 10, 0, 0)


def _df(spark, rows):
    return spark.createDataFrame(
        rows, "_record_id string, noaa_record_id string, _record_updated_at timestamp, hourly_precip_timestamp timestamp"
    )


def test_null_keys_form_one_group(spark):
    rows = [("a", None, T0, T0), ("b", None, T0 + dt.timedelta(1), T0), ("c", "k", T0, T0)]
    out = latest_per_key(_df(spark, rows), "noaa_record_id").collect()
    assert sorted(r["_record_id"] for r in out) == ["b", "c"]


def test_ties_break_on_record_id_desc(spark):
    rows = [("a", "k", T0, T0), ("b", "k", T0, T0)]
    assert latest_per_key(_df(spark, rows), "noaa_record_id").first()["_record_id"] == "b"


def test_null_order_sorts_last(spark):
    rows = [("a", "k", None, T0), ("b", "k", T0, T0)]
    assert latest_per_key(_df(spark, rows), "noaa_record_id").first()["_record_id"] == "b"


def test_dedupe_before_minute_filter(spark):
    at54 = dt.datetime(2026, 1, 1, 9, 54)
    at10 = dt.datetime(2026, 1, 1, 10, 10)
    rows = [("old", "k", T0, at54), ("new", "k", T0 + dt.timedelta(hours=1), at10), ("x", "j", T0, at54)]
    out = routine_reports(latest_per_key(_df(spark, rows), "noaa_record_id"))
    assert [r["_record_id"] for r in out.collect()] == ["x"]


def test_partial_group_limit_before_shuffle(spark):
    rows = [(str(i), "hot", T0 + dt.timedelta(seconds=i), T0) for i in range(50)]
    df = latest_per_key(_df(spark, rows).repartition(4), "noaa_record_id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert df.first()["_record_id"] == "49"


def test_multi_key(spark):
    df = spark.createDataFrame(
        [("a", "s1", 1, T0), ("b", "s1", 1, T0 + dt.timedelta(1)), ("c", "s1", 2, T0)],
        "_record_id string, st string, n int, _record_updated_at timestamp",
    )
    out = latest_per_key(df, ["st", "n"]).orderBy("n").collect()
    assert [r["_record_id"] for r in out] == ["b", "c"]


def test_aggregate_method_matches_window(spark):
    rows = [
        ("a", None, T0, T0), ("b", None, T0 + dt.timedelta(1), T0),
        ("c", "k", T0, T0), ("d", "k", T0, T0), ("e", "k", None, T0),
        ("f", "j", None, T0), ("g", "j", None, T0),
        ("h", "m", T0 + dt.timedelta(2), T0), ("i", "m", T0 + dt.timedelta(1), T0),
    ]
    df = _df(spark, rows)
    w = sorted(tuple(r) for r in latest_per_key(df, "noaa_record_id", method="window").collect())
    a = sorted(tuple(r) for r in latest_per_key(df, "noaa_record_id", method="aggregate").collect())
    assert w == a
    assert sorted(r[0] for r in a) == ["b", "d", "g", "h"]


def test_auto_uses_aggregate_when_window_limit_is_off(spark):
    df = _df(spark, [(str(i), "hot", T0 + dt.timedelta(seconds=i), T0) for i in range(20)])
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    try:
        out = latest_per_key(df, "noaa_record_id")
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "max_by" in plan and "partial" in plan.lower()
        assert out.first()["_record_id"] == "19"
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
