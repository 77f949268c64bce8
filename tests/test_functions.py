import math

import pytest
from pyspark.sql import functions as F

from pluvio.functions import (
    geog_point_wkb,
    iso_timestamp,
    json_value,
    safe_double,
    strip_unit,
    wkb_latitude,
    wkb_longitude,
)

DOC = (
    '{"s": "abc", "n": 1.50, "b": true, "o": {"k": 1}, "a": [1, 2], "z": null, '
    '"brace": "{not json", "Case": "upper", "coords": [-71.5, 42.25], "p": {"q": {"r": "deep"}}}'
)


def _jv(spark, path):
    df = spark.range(1).select(F.parse_json(F.lit(DOC)).alias("d"))
    return df.select(json_value("d", path).alias("v")).first()["v"]


@pytest.mark.parametrize(
    "path,expected",
    [
        ("s", "abc"),
        ("n", "1.5"),
        ("b", "true"),
        ("o", None),
        ("a", None),
        ("z", None),
        ("missing", None),
        ("brace", "{not json"),
        ("case", None),
        ("Case", "upper"),
        ("coords[0]", "-71.5"),
        ("coords[1]", "42.25"),
        ("coords[2]", None),
        ("p.q.r", "deep"),
        ("$.p.q", None),
    ],
)
def test_json_value(spark, path, expected):
    assert _jv(spark, path) == expected


@pytest.mark.parametrize(
    "text,expected",
    [
        ("abc", None),
        ("", None),
        ("1e3", 1000.0),
        ("1.5d", None),
        ("true", None),
        (" 1.5", None),
        ("-2.5", -2.5),
        (".5", 0.5),
        ("5.", 5.0),
        ("Infinity", math.inf),
        ("-inf", -math.inf),
        ("0x1p3", None),
        (None, None),
    ],
)
def test_safe_double(spark, text, expected):
    got = spark.createDataFrame([(text,)], "t string").select(safe_double("t").alias("v")).first()["v"]
    assert got == expected


def test_safe_double_nan(spark):
    got = spark.createDataFrame([("nan",)], "t string").select(safe_double("t").alias("v")).first()["v"]
    assert math.isnan(got)


def test_iso_timestamp_offsets(spark):
    rows = spark.createDataFrame(
        [("2026-04-24T17:54:00Z",), ("2026-04-24T17:54:00+00:00",), ("2026-04-24T17:54:00+05:30",), (None,)],
        "t string",
    ).select(iso_timestamp("t").alias("ts"))
    mins = [r[0] for r in rows.select(F.minute("ts")).collect()]
    assert mins == [54, 54, 24, None]


def test_iso_timestamp_malformed(spark):
    df = spark.createDataFrame([("not a time",)], "t string")
    with pytest.raises(Exception, match="malformed timestamp"):
        df.select(iso_timestamp("t")).collect()
    assert df.select(iso_timestamp("t", on_bad="null").alias("v")).first()["v"] is None


def test_strip_unit(spark):
    df = spark.createDataFrame([("wmoUnit:mm",), ("mm",), ("wmoUnit:wmoUnit:x",), (None,)], "u string")
    assert [r[0] for r in df.select(strip_unit("u")).collect()] == ["mm", "mm", "x", None]


def test_geopoint_roundtrip(spark):
    df = spark.createDataFrame([(-71.5, 42.25), (181.0, 0.0), (None, 1.0), (1.0, None)], "lon double, lat double")
    out = df.select(geog_point_wkb("lon", "lat").alias("g")).select(
        F.length("g").alias("n"), wkb_longitude("g").alias("x"), wkb_latitude("g").alias("y")
    ).collect()
    assert (out[0]["n"], out[0]["x"], out[0]["y"]) == (21, -71.5, 42.25)
    assert (out[1]["x"], out[1]["y"]) == (-179.0, 0.0)
    assert out[2]["n"] is None and out[3]["n"] is None


def test_geopoint_bytes(spark):
    import struct

    g = spark.createDataFrame([(1.0, 2.0)], "lon double, lat double").select(geog_point_wkb("lon", "lat")).first()[0]
    assert bytes(g) == struct.pack("<BIdd", 1, 1, 1.0, 2.0)


def test_geopoint_latitude_out_of_range(spark):
    df = spark.createDataFrame([(0.0, 91.0)], "lon double, lat double")
    with pytest.raises(Exception, match="latitude"):
        df.select(geog_point_wkb("lon", "lat")).collect()


@pytest.mark.parametrize(
    "text,ok",
    [
        ("2026-04-24", True),
        ("2026-04-24 17:54", True),
        ("2026-04-24T17:54:00.123456+05:30", True),
        ("2026-04-24T17:54:00 UTC", True),
        ("2026-04-24T17:54:00-04", True),
        ("2026", False),
        ("2026-04", False),
        ("17:54:00", False),
        ("2026-04-24T17:54:00+05:30 junk", False),
    ],
)
def test_iso_timestamp_shapes(spark, text, ok):
    got = spark.createDataFrame([(text,)], "t string").select(iso_timestamp("t", on_bad="null").alias("v")).first()["v"]
    assert (got is not None) == ok
