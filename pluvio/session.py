"""Session helpers: UTC pinning, shared scratch space, a builder for tests and bench."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone to UTC.

    ``minute()``, ``to_date()`` and string -> timestamp casts are evaluated in the
    session zone; a :30/:45 zone would break the minute-of-hour filter and the
    day partitioning, so every job runs in UTC.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from the session (the context's checkpoint dir, or the
    ``spark.checkpoint.dir`` setting). Where none is named, a local master
    (tests) gets a fresh local folder; on a cluster that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="pluvio-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
        else:
            spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def default_snapshot_root(spark: SparkSession, name: str) -> str:
    """Where published table data goes unless the caller says so: beside the warehouse's tables."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}_snapshots"


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "pluvio",
    event_log_dir: str | None = None,
) -> SparkSession:
    """Local session used by tests and the benchmark (the driver owns its own).

    ``event_log_dir`` turns on Spark's event log there (stage/task metrics
    without a UI).
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    builder = SparkSession.builder
    if event_log_dir:
        builder = (
            builder.config("spark.eventLog.enabled", "true")
            .config("spark.eventLog.dir", event_log_dir)
            .config("spark.eventLog.compress", "false")
            .config("spark.eventLog.rolling.enabled", "false")
        )
    spark = (
        builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("PLUVIO_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark



SCRATCH_SCHEMA = "pluvio_scratch"


def scratch_schema(spark: SparkSession) -> str:
    """The scratch schema of the session's checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{SCRATCH_SCHEMA}_{zlib.crc32(root.encode()):08x}"


def materialize(df: DataFrame, name: str, **options: str) -> tuple[DataFrame, str]:
    """Write ``df`` once as a managed Parquet table in a scratch schema that
    lives in the shared checkpoint folder, and read it back.

    Cuts the lineage (a lost executor recomputes nothing upstream), stores the
    rows columnar and compressed, and gives the optimizer real size statistics.
    ``options`` go to the Parquet writer.
    Returns the frame and the table name; ``DROP TABLE`` removes the files.
    """
    spark = df.sparkSession
    root = checkpoint_root(spark).rstrip("/")
    # a schema keeps its first location: each checkpoint folder has one of its own
    schema = scratch_schema(spark)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema} LOCATION '{root}/scratch-tables'")
    table = f"{schema}.{re.sub(r'[^0-9A-Za-z_]', '_', name)}_{uuid.uuid4().hex}"
    df.write.format("parquet").options(**options).saveAsTable(table)
    return spark.table(table), table


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own making, in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def drop_materialized(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
