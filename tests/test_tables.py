import pytest
from pyspark.sql import functions as F

from pluvio.sources import (
    WRITE_APPEND,
    WRITE_EMPTY,
    WRITE_TRUNCATE,
    create_tables,
    load_table,
    qualified,
    read_ndjson,
    run_sql,
    scan,
)


def _rows(spark, n, day="2026-01-01"):
    return spark.range(n).select(
        F.col("id").cast("string").alias("_record_id"), F.lit(day).cast("date").alias("created_date")
    )


def test_dispositions_on_path(spark, tmp):
    p = tmp + "/t"
    assert load_table(_rows(spark, 3), p, disposition=WRITE_EMPTY, partition_col="created_date") == 3
    assert load_table(_rows(spark, 2), p, disposition=WRITE_APPEND, partition_col="created_date") == 2
    assert spark.read.parquet(p).count() == 5
    with pytest.raises(ValueError, match="not empty"):
        load_table(_rows(spark, 1), p, disposition=WRITE_EMPTY, partition_col="created_date")
    assert load_table(_rows(spark, 4, "2026-01-02"), p, disposition=WRITE_TRUNCATE, partition_col="created_date") == 4
    got = spark.read.parquet(p)
    assert got.count() == 4 and got.select("created_date").distinct().count() == 1
    assert load_table(_rows(spark, 1), p, disposition="SOMETHING_ELSE", partition_col="created_date") == 1
    assert spark.read.parquet(p).count() == 5


def test_empty_input_is_an_error(spark, tmp):
    with pytest.raises(ValueError, match="cannot be empty"):
        load_table(_rows(spark, 0), tmp + "/e")


def test_catalog_tables(spark, tmp):
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS pluvio_t LOCATION '{tmp}/db'")
    names = create_tables(spark, "pluvio_t")
    desc = {r["col_name"]: r["comment"] for r in spark.sql(f"DESCRIBE TABLE {names['fact']}").collect()}
    assert desc["hourly_precip_value"] == "Precipitation value"
    spark.sql(
        f"INSERT INTO {names['fact']} (_record_id, noaa_record_id, observed_date) VALUES ('r', 'k', DATE'2026-01-01')"
    )
    row = spark.table(names["fact"]).first()
    assert row["_record_created_at"] is not None and row["_record_updated_at"] is not None
    # WRITE_EMPTY is fine on an existing empty table
    assert spark.table(names["dim"]).isEmpty()
    empty_dim = spark.createDataFrame([], spark.table(names["dim"]).schema)
    new_rows = empty_dim.unionByName(
        spark.range(2).select(
            F.col("id").cast("string").alias("_record_id"),
            F.lit("2026-01-01").cast("date").alias("created_date"),
        ),
        allowMissingColumns=True,
    )
    assert load_table(new_rows, names["dim"], disposition=WRITE_EMPTY) == 2
    assert spark.table(names["dim"]).count() == 2
    with pytest.raises(ValueError, match="not empty"):
        load_table(new_rows, names["dim"], disposition=WRITE_EMPTY)
    assert load_table(new_rows, names["dim"], disposition=WRITE_TRUNCATE) == 2
    assert spark.table(names["dim"]).count() == 2


def test_scan_sql_and_names(spark, tmp):
    spark.range(10).write.parquet(tmp + "/s")
    assert scan(spark, tmp + "/s", max_rows=3).count() == 3
    assert scan(spark, tmp + "/s").count() == 10
    spark.read.parquet(tmp + "/s").createOrReplaceTempView("pluvio_scan_v")
    out = run_sql(spark, "SELECT count(*) AS n FROM IDENTIFIER(:t) WHERE id >= :lo", t="pluvio_scan_v", lo=4)
    assert out.first()["n"] == 6
    assert qualified("cat", "db", "my`t") == "`cat`.`db`.`my``t`"


def test_read_ndjson(spark, tmp):
    with open(tmp + "/a.json", "w") as f:
        f.write('{"a": 1, "b": "x"}\n{"a": 2}\n')
    assert read_ndjson(spark, tmp + "/a.json").columns == ["a", "b"]
    assert read_ndjson(spark, tmp + "/a.json", "a long").columns == ["a"]


def test_run_sql_positional(spark):
    out = run_sql(spark, "SELECT ? + ? AS s", 2, 3)
    assert out.first()["s"] == 5
    with pytest.raises(ValueError):
        run_sql(spark, "SELECT 1", 1, a=2)
