"""Row numbers over a distributed sort."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from pluvio.operators.numbering import number_rows


def test_numbers_follow_the_order(spark):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", None]), r.randrange(50), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, x int, id long").repartition(7)
    got = number_rows(df, [F.col("x").desc(), "id"]).collect()
    want = {k: n for n, (_, _, k) in enumerate(sorted(rows, key=lambda v: (-v[1], v[2])), 1)}
    assert {v.id: v.row_number for v in got} == want and len(got) == len(rows)


def test_numbers_per_group_with_a_hot_group(spark):
    r = random.Random(4)
    rows = [("hot" if k % 3 else r.choice(["x", "y", "z", None]), k * 7919 % 2003, k) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, x int, id long").repartition(5)
    out = number_rows(df, ["x", "id"], groups=["g"], out="nr")
    assert out.columns == ["g", "x", "id", "nr"]
    want = {}
    for g in {v[0] for v in rows}:
        for n, v in enumerate(sorted((v for v in rows if v[0] == g), key=lambda v: (v[1], v[2])), 1):
            want[v[2]] = n
    assert {v.id: v.nr for v in out.collect()} == want


def test_empty_table_and_equal_rows(spark):
    empty = spark.createDataFrame([], "g string, x int")
    assert number_rows(empty, ["x"]).collect() == [] and number_rows(empty, ["x"], groups=["g"]).collect() == []
    same = spark.createDataFrame([("a", 1)] * 40, "g string, x int")
    assert sorted(v.row_number for v in number_rows(same, ["x"]).collect()) == list(range(1, 41))
    assert sorted(v.row_number for v in number_rows(same, ["x"], groups=["g"]).collect()) == list(range(1, 41))
