"""Property test: any split of a version history into batches (in update order)
gives the fact table that a plain-Python model of the silver semantics gives."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pluvio import schemas as S
from pluvio.operators import latest_per_key, merge_upsert, routine_reports

T0 = dt.datetime(2026, 1, 1)
SRC = "_record_id string, noaa_record_id string, _record_updated_at timestamp, hourly_precip_timestamp timestamp, hourly_precip_value double"
UPDATE = ["_record_id", "hourly_precip_timestamp", "hourly_precip_value", "_record_updated_at"]
INSERT = ["_record_id", "noaa_record_id", "hourly_precip_timestamp", "hourly_precip_value", "_record_updated_at"]

versions = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.sampled_from([54, 54, 10]), st.one_of(st.none(), st.floats(0, 5))),
    min_size=1,
    max_size=12,
)


def _rows(history):
    out = []
    for i, (key, minute, value) in enumerate(history):
        obs = T0 + dt.timedelta(hours=i, minutes=minute)
        out.append((f"r{i:03d}", key, T0 + dt.timedelta(seconds=i), obs, value))
    return out


def _model(batches):
    fact, null_rows = {}, []
    for batch in batches:
        latest = {}
        for row in batch:  # rows are in update order: later wins
            latest[row[1]] = row
        for key, row in latest.items():
            if row[3].minute != 54:
                continue
            if key is None:
                null_rows.append(row)
            else:
                fact[key] = row
    return sorted(list(fact.values()) + null_rows, key=lambda r: r[0])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(history=versions, cuts=st.lists(st.integers(0, 12), max_size=3), broadcast=st.booleans())
def test_batches_equal_model(spark, history, cuts, broadcast):
    rows = _rows(history)
    bounds = sorted({0, len(rows), *[c for c in cuts if c <= len(rows)]})
    batches = [rows[a:b] for a, b in zip(bounds, bounds[1:]) if b > a]
    fact = spark.createDataFrame([], SRC)
    for batch in batches:
        src = routine_reports(latest_per_key(spark.createDataFrame(batch, SRC), S.FACT_KEY))
        merged = merge_upsert(fact, src, S.FACT_KEY, UPDATE, INSERT, broadcast_source=broadcast).drop("_action")
        fact = spark.createDataFrame(merged.collect(), SRC)  # keep lineage short
    got = sorted((tuple(r) for r in fact.collect()), key=lambda r: r[0])
    assert got == _model(batches)
