import datetime as dt

from pyspark.sql import functions as F

from pluvio import schemas as S
from pluvio.operators import high_water_mark, incremental_filter

T0 = dt.datetime(2026, 1, 1, 0, 0, 0)


def _src(spark):
    rows = [(str(i), T0 + dt.timedelta(hours=i), (T0 + dt.timedelta(hours=i)).date()) for i in range(48)]
    return spark.createDataFrame(rows, "_record_id string, _record_updated_at timestamp, created_date date")


def test_empty_target_reads_everything(spark):
    assert incremental_filter(_src(spark), S.empty(spark, S.FACT)).count() == 48
    mark = high_water_mark(S.empty(spark, S.FACT)).first()[0]
    assert mark == dt.datetime(1970, 1, 1)


def test_row_equal_to_mark_is_excluded(spark):
    target = spark.createDataFrame([(T0 + dt.timedelta(hours=10),)], "_record_updated_at timestamp")
    out = incremental_filter(_src(spark), target)
    assert out.count() == 37
    assert out.agg(F.min("_record_id").cast("int")).first()[0] == 11 or out.filter("_record_id = '10'").count() == 0


def test_partition_hint_keeps_result(spark, tmp):
    _src(spark).write.partitionBy("created_date").parquet(tmp + "/b")
    src = spark.read.parquet(tmp + "/b")
    target = spark.createDataFrame([(T0 + dt.timedelta(hours=30),)], "_record_updated_at timestamp")
    plain = incremental_filter(src, target)
    pruned = incremental_filter(src, target, partition_col="created_date")
    assert sorted(plain.collect()) == sorted(pruned.collect())
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionfilters" in plan.lower() or "created_date" in plan


def test_mark_pushed_to_scan(spark, tmp):
    _src(spark).write.parquet(tmp + "/c")
    src = spark.read.parquet(tmp + "/c")
    target = spark.createDataFrame([(T0,)], "_record_updated_at timestamp")
    plan = incremental_filter(src, target)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "_record_updated_at" in plan


def test_literal_mark_prunes_partitions_statically(spark, tmp):
    _src(spark).write.partitionBy("created_date").parquet(tmp + "/p")
    src = spark.read.parquet(tmp + "/p")
    mark = T0 + dt.timedelta(hours=30)
    out = incremental_filter(src, S.empty(spark, S.FACT), partition_col="created_date", mark=mark)
    plan = out._jdf.queryExecution().executedPlan().toString()
    part_filters = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    assert "created_date" in part_filters and "Subquery" not in part_filters
    assert out.count() == 17
