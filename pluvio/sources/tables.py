"""Catalog tables: DDL, write dispositions, scans, snapshot publishing."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from pluvio import schemas as S
from pluvio.session import delete_folder, drop_materialized, materialize

# Load write dispositions (an unknown one appends).
WRITE_APPEND = "WRITE_APPEND"
WRITE_TRUNCATE = "WRITE_TRUNCATE"
WRITE_EMPTY = "WRITE_EMPTY"

# Table names inside the chosen schema.
BRONZE_TABLE = "raw_station_observations"
FACT_TABLE = "fact_station_precipitation"
DIM_TABLE = "dim_stations"


def _is_path(name: str) -> bool:
    return "/" in name or name.startswith("file:")


def _column_ddl(field: T.StructField) -> str:
    comment = field.metadata.get("comment")
    ddl = f"`{field.name}` {field.dataType.simpleString().upper()}"
    if field.name in ("_record_created_at", "_record_updated_at"):
        ddl += " DEFAULT current_timestamp()"
    if comment:
        ddl += " COMMENT '" + comment.replace("'", "\\'") + "'"
    return ddl


def table_ddl(
    name: str, schema: T.StructType, partition_cols: str | list[str], *, location: str | None = None, bucket: str = ""
) -> str:
    """DDL of a table with a UTC-day partition column, then any columns of the schema to partition by."""
    by = [partition_cols] if isinstance(partition_cols, str) else partition_cols
    cols = [_column_ddl(f) for f in schema.fields]
    cols.append(f"`{by[0]}` DATE COMMENT 'UTC day (partition)'")
    ddl = (
        f"CREATE TABLE IF NOT EXISTS {name} (\n  "
        + ",\n  ".join(cols)
        + f"\n) USING parquet PARTITIONED BY ({', '.join(f'`{c}`' for c in by)}){bucket}"
    )
    if location:
        ddl += f" LOCATION '{location}'"
    return ddl


def create_tables(
    spark: SparkSession, schema: str = "pluvio", *, location: str | None = None, fact_buckets: int | None = None
) -> dict[str, str]:
    """Create the schema and the bronze, fact and dimension tables (idempotent).

    Creation/update stamps default to ``current_timestamp()``; each table has a
    derived UTC-day partition column (bronze/dim by creation day, fact by
    observation day), bronze also one partition per load. With
    ``fact_buckets`` the fact table is bucketed by record id within each day, so
    that a merge joins it bucket by bucket. Returns the qualified names.
    """
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`" + (f" LOCATION '{location}'" if location else ""))
    names = {
        "bronze": f"`{schema}`.`{BRONZE_TABLE}`",
        "fact": f"`{schema}`.`{FACT_TABLE}`",
        "dim": f"`{schema}`.`{DIM_TABLE}`",
    }
    spark.sql(table_ddl(names["bronze"], S.BRONZE, S.BRONZE_PARTITIONS))
    bucket = f" CLUSTERED BY (`{S.FACT_KEY}`) INTO {int(fact_buckets)} BUCKETS" if fact_buckets else ""
    spark.sql(table_ddl(names["fact"], S.FACT, S.FACT_PARTITION, bucket=bucket))
    spark.sql(table_ddl(names["dim"], S.DIM, S.DIM_PARTITION))
    return names


def table_exists(spark: SparkSession, name: str) -> bool:
    if _is_path(name):
        try:
            spark.read.parquet(name).schema
            return True
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise  # a storage or permission error does not mean "no table"
    return spark.catalog.tableExists(name.replace("`", ""))


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.parquet(name) if _is_path(name) else spark.table(name)


def read_bronze(spark: SparkSession, name: str) -> DataFrame:
    """The bronze table; of a folder the partition columns keep their types, whatever a job id looks like."""
    if not _is_path(name):
        return spark.table(name)
    schema = T.StructType([*S.BRONZE.fields, T.StructField(S.BRONZE_PARTITION, T.DateType())])
    return spark.read.schema(schema).parquet(name)


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    """What an overwrite replaces, whatever the session says (a writer option does not reach ``insertInto``):
    ``static`` the whole table, ``dynamic`` the partitions that are written."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, mode)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _write(df: DataFrame, table: str, partition_cols: list[str], overwrite: str | None) -> None:
    """Append, or overwrite by the given mode; the table or folder is made where there is none."""
    spark = df.sparkSession
    if _is_path(table):
        w = df.write.mode("overwrite" if overwrite else "append").option("partitionOverwriteMode", overwrite or "static")
        (w.partitionBy(*partition_cols) if partition_cols else w).parquet(table)
    elif table_exists(spark, table):
        with _overwrite_mode(spark, overwrite or "static"):
            df.select(*spark.table(table).columns).write.insertInto(table, overwrite=overwrite is not None)
    else:
        w = df.write.format("parquet").mode("append")
        (w.partitionBy(*partition_cols) if partition_cols else w).saveAsTable(table)


def load_table(
    df: DataFrame,
    table: str,
    *,
    disposition: str = WRITE_APPEND,
    partition_col: str | list[str] | None = None,
) -> int:
    """Load rows into a table (catalog name) or Parquet folder (path); returns rows written.

    * ``WRITE_APPEND`` (also any unknown value): add rows;
    * ``WRITE_TRUNCATE``: replace all content (static overwrite of every partition);
    * ``WRITE_EMPTY``: write only if the target has no rows (an existing empty
      table is fine), else ``ValueError``.

    Empty input is an error that leaves the target as it was. The rows are
    evaluated once: their number is observed on the write, and where a write of
    no rows would do harm (``WRITE_TRUNCATE``) they are staged first.
    """
    spark = df.sparkSession
    exists = table_exists(spark, table)
    if disposition == WRITE_EMPTY and exists and not read_table(spark, table).isEmpty():
        raise ValueError(f"{table} is not empty (WRITE_EMPTY)")
    cols = [partition_col] if isinstance(partition_col, str) else list(partition_col or [])
    obs = Observation("load_rows")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if disposition == WRITE_TRUNCATE and exists:
        staged, scratch = materialize(observed, "load_rows")
        try:
            if obs.get["rows"]:
                _write(staged, table, cols, "static")
        finally:
            drop_materialized(spark, scratch)
    else:
        _write(observed, table, cols, None)
        if not obs.get["rows"] and not exists:  # the write made an empty target
            if _is_path(table):
                delete_folder(spark, table)
            else:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
    if not obs.get["rows"]:
        raise ValueError(f"load into {table}: the rows cannot be empty")
    return int(obs.get["rows"])


def replace_partitions(df: DataFrame, table: str, partition_cols: list[str]) -> int:
    """Write rows in place of whatever their own partitions hold; returns rows written.

    With a batch or job id among the partition columns an append becomes
    repeatable: what a broken attempt left is overwritten by the next one.
    """
    obs = Observation("replace_rows")
    _write(df.observe(obs, F.count(F.lit(1)).alias("rows")), table, partition_cols, "dynamic")
    return int(obs.get["rows"])


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Newline-delimited JSON; a schema is applied as given, ``None`` infers one."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def scan(spark: SparkSession, table: str, max_rows: int | None = None) -> DataFrame:
    """Rows of a table or Parquet folder, optionally capped (order unspecified)."""
    df = read_table(spark, table)
    return df.limit(int(max_rows)) if max_rows is not None else df


def _layout(df: DataFrame, cols: list[str]) -> DataFrame:
    """File layout for a partitioned write, then a sort inside each task so
    files are clustered by key.

    With AQE: rebalance by the partition column (AQE splits a hot day into
    several tasks and merges small days; no sampling pass). Without AQE that
    hint is a plain repartition by day (one task per day), so the day is salted
    with a hash bucket of the key instead.
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        out = df.hint("rebalance", cols[0])
    else:
        n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        bucket = F.pmod(F.xxhash64(*[F.col(c) for c in cols[1:]] or [F.lit(0)]), F.lit(n))
        out = df.repartition(n, F.col(cols[0]), bucket)
    return _sorted(out, cols)


def _sorted(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows stay in their tasks (the buckets of a co-located merge), sorted for the partitioned write."""
    return df.sortWithinPartitions(*[F.col(c) for c in cols])


def bucketing(spark: SparkSession, table: str) -> tuple[int, list[str]] | None:
    """Number of buckets and bucket columns of a catalog table, if it has any."""
    if _is_path(table) or not table_exists(spark, table):
        return None
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "Num Buckets" not in info:
        return None
    return int(info["Num Buckets"]), [c.strip(" `") for c in info["Bucket Columns"].strip("[]").split(",")]


def _write_folder(df: DataFrame, folder: str, partition_col: str | None, buckets: tuple[int, list[str]] | None) -> None:
    """Write a published folder; of a bucketed table as its bucket files (through a passing table that is dropped again)."""
    w = df.write.mode("errorifexists").format("parquet")
    if partition_col:
        w = w.partitionBy(partition_col)
    if not buckets:
        w.save(folder)
        return
    passing = f"pluvio_publish_{uuid.uuid4().hex}"
    try:
        w.bucketBy(buckets[0], *buckets[1]).option("path", folder).saveAsTable(passing)
    finally:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {passing}")  # an external table: its files stay


def publish_snapshot(
    df: DataFrame,
    table: str,
    root: str,
    *,
    partition_col: str | None = None,
    layout_cols: list[str] | None = None,
    observation: Observation | None = None,
    metrics: list | None = None,
    drop_cols: list[str] | None = None,
) -> str:
    """Write ``df`` as a new snapshot folder under ``root`` and point ``table`` at it.

    The folder being read (the current snapshot) is never overwritten, so a
    failed or retried job leaves the table as it was. A table whose partitions
    the catalog tracks is switched partition by partition (new files first,
    partitions without rows dropped last, so no row is ever out of sight);
    any other by one ``ALTER TABLE ... SET LOCATION``. With ``layout_cols`` (day, then key) the rows
    are rebalanced by day (a hot day is split over several tasks by AQE) and
    sorted by key inside each file.
    ``observation``/``metrics`` are attached after the exchange.
    """
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/snapshot-{uuid.uuid4().hex}"
    buckets = bucketing(spark, table)
    if layout_cols:
        df = _sorted(df, layout_cols) if buckets else _layout(df, layout_cols)
    obs = observation or Observation("publish_snapshot")
    seen = [F.collect_set(F.col(partition_col)).alias("__partitions")] if partition_col else []
    unknown = [F.count_if(F.col(partition_col).isNull()).alias("__unknown")] if partition_col else []
    df = df.observe(obs, *(metrics or []), *seen, *unknown, F.count(F.lit(1)).alias("__rows"))
    if drop_cols:
        df = df.drop(*drop_cols)
    _write_folder(df, folder, partition_col, buckets)
    if table_exists(spark, table):
        tracked = tracks_partitions(spark, table)
        if tracked:
            written = {str(v): v for v in obs.get["__partitions"]}
            if obs.get["__unknown"]:
                written[_NULL_PARTITION] = None
            _switch_partitions(spark, table, partition_col, folder, written, _partitions(spark, table))
        else:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.sql(f"REFRESH TABLE {table}")
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{folder}'")
    return folder


def tracks_partitions(spark: SparkSession, table: str) -> bool:
    """True when the catalog keeps the table's partitions (per-partition locations)."""
    if _is_path(table) or not table_exists(spark, table):
        return False
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Partition Provider")
    row = info.first()
    return bool(row) and row["data_type"] == "Catalog"


_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _partitions(spark: SparkSession, table: str) -> set[str]:
    """Values of a tracked table's partitions, as the catalog writes them."""
    return {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def _switch_partitions(spark: SparkSession, table: str, col: str, folder: str, written: dict, existing: set[str]) -> None:
    """Point partitions at their new files, add new ones, and only then drop those without rows."""
    for v in sorted(written.keys() & existing):
        spark.sql(f"ALTER TABLE {table} PARTITION ({_spec(col, written[v])}) SET LOCATION '{folder}/{col}={v}'")
    added = [f"PARTITION ({_spec(col, written[v])}) LOCATION '{folder}/{col}={v}'" for v in sorted(written.keys() - existing)]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(added))
    gone = [f"PARTITION ({_spec(col, None if v == _NULL_PARTITION else v)})" for v in sorted(existing - written.keys())]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(gone))


def _spec(partition_col: str, value) -> str:
    if value is None:
        return f"{partition_col} = NULL"
    return f"{partition_col} = DATE'{value}'" if hasattr(value, "isoformat") else f"{partition_col} = '{value}'"


def publish_partitions(
    df: DataFrame,
    table: str,
    root: str,
    *,
    partition_col: str,
    affected: list,
    layout_cols: list[str] | None = None,
    observation: Observation | None = None,
    metrics: list | None = None,
    drop_cols: list[str] | None = None,
) -> str:
    """Replace only the ``affected`` partitions of a catalog-partitioned table.

    ``df`` must hold the complete new content of exactly those partitions. It
    is written to a new folder (nothing being read is overwritten), then each
    affected partition is pointed at its new files (``SET LOCATION``), added,
    or dropped when it has no rows left. Untouched partitions are not read or
    written. Each partition switch is atomic; the switch of several partitions
    is not (see README).
    """
    spark = df.sparkSession
    folder = f"{root.rstrip('/')}/rewrite-{uuid.uuid4().hex}"
    buckets = bucketing(spark, table)
    if layout_cols:
        df = _sorted(df, layout_cols) if buckets else _layout(df, layout_cols)
    obs = observation or Observation("publish_partitions")
    unknown = F.count_if(F.col(partition_col).isNull()).alias("__unknown")
    df = df.observe(obs, *(metrics or []), unknown, F.collect_set(F.col(partition_col)).alias("__partitions"))
    if drop_cols:
        df = df.drop(*drop_cols)
    _write_folder(df, folder, partition_col, buckets)
    name = lambda v: _NULL_PARTITION if v is None else str(v)
    written = {str(v) for v in obs.get["__partitions"]} | ({_NULL_PARTITION} if obs.get["__unknown"] else set())
    unexpected = written - {name(v) for v in affected}
    if unexpected:
        raise RuntimeError(f"rows written outside the affected partitions: {sorted(unexpected)[:5]}")
    touched = {name(v): v for v in affected}
    _switch_partitions(
        spark, table, partition_col, folder, {v: touched[v] for v in written}, _partitions(spark, table) & touched.keys()
    )
    spark.sql(f"REFRESH TABLE {table}")
    return folder


def geography_view(
    spark: SparkSession, table: str, view: str, *, wkb_col: str = "noaa_station_geopoint", enable: bool = False
) -> DataFrame:
    """Temp view of a table with the WKB point exposed as GEOGRAPHY(4326).

    Needs ``spark.sql.geospatial.enabled``; pass ``enable=True`` to switch it on
    for the session. The stored column stays WKB (GEOGRAPHY cannot be written
    to Parquet).
    """
    if enable:
        spark.conf.set("spark.sql.geospatial.enabled", "true")
    elif spark.conf.get("spark.sql.geospatial.enabled", "false") != "true":
        raise RuntimeError("spark.sql.geospatial.enabled is off; pass enable=True")
    base = read_table(spark, table)
    out = base.withColumn(wkb_col, F.expr(f"st_geogfromwkb(`{wkb_col}`)"))
    out.createOrReplaceTempView(view)
    return out


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    """One table property (``SHOW TBLPROPERTIES``), or None."""
    if _is_path(table) or not table_exists(spark, table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == key).collect()
    return rows[0]["value"] if rows else None


def set_table_property(spark: SparkSession, table: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{value}')")
