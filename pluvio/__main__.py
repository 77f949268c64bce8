"""Command line: the scheduled entry points of the pipeline.

    python -m pluvio create-tables --schema weather
    python -m pluvio bronze-load --landing /shared/landing/extract-42 --schema weather
    python -m pluvio silver --schema weather --trace-id trace-42 [--dimension]
    python -m pluvio stream --landing '/shared/landing/*' --schema weather --checkpoint /shared/ckpt

The session comes from ``SparkSession.builder.getOrCreate()`` (cluster
settings apply); the zone is pinned to UTC.
"""

from __future__ import annotations

import argparse
import json
import sys
import uuid

from pyspark.sql import SparkSession

from pluvio.plans import run_bronze_load, run_silver, run_silver_dim
from pluvio.session import default_snapshot_root, use_utc
from pluvio.sources import create_tables
from pluvio.sources.tables import BRONZE_TABLE, DIM_TABLE, FACT_TABLE
from pluvio.streaming import stream_medallion


def _names(schema: str) -> dict[str, str]:
    return {
        "bronze": f"`{schema}`.`{BRONZE_TABLE}`",
        "fact": f"`{schema}`.`{FACT_TABLE}`",
        "dim": f"`{schema}`.`{DIM_TABLE}`",
    }


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="pluvio")
    sub = parser.add_subparsers(dest="command", required=True)
    p = sub.add_parser("create-tables")
    p.add_argument("--schema", required=True)
    p = sub.add_parser("bronze-load")
    p.add_argument("--landing", required=True)
    p.add_argument("--schema", required=True)
    p.add_argument("--job-id", default=None)
    p.add_argument("--on-bad", default="fail", choices=["fail", "quarantine"])
    p.add_argument("--quarantine-path", default=None)
    p = sub.add_parser("silver")
    p.add_argument("--schema", required=True)
    p.add_argument("--trace-id", required=True)
    p.add_argument("--snapshot-root", default=None)
    p.add_argument("--hwm-policy", default="insert_time", choices=["insert_time", "source_time"])
    p.add_argument("--dimension", action="store_true", help="also merge the station dimension")
    p = sub.add_parser("stream")
    p.add_argument("--landing", required=True)
    p.add_argument("--schema", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--snapshot-root", default=None)
    p.add_argument("--processing-time", default=None, help="run continuously with this trigger")
    args = parser.parse_args(argv)

    spark = use_utc(spark or SparkSession.builder.getOrCreate())
    names = _names(args.schema)
    if args.command == "create-tables":
        return create_tables(spark, args.schema)
    if args.command == "bronze-load":
        job_id = args.job_id or str(uuid.uuid4())
        rows = run_bronze_load(
            spark, args.landing, names["bronze"], job_id=job_id, on_bad=args.on_bad,
            quarantine_path=args.quarantine_path,
        )
        return {"job_id": job_id, "rows": rows}
    if args.command == "silver":
        root = args.snapshot_root or default_snapshot_root(spark, "silver")
        out = {"fact": run_silver(spark, args.trace_id, schema=args.schema, snapshot_root=f"{root}/fact",
                                  hwm_policy=args.hwm_policy)}
        if args.dimension:
            out["dim"] = run_silver_dim(spark, names["bronze"], names["dim"], job_id=out["fact"]["job_id"],
                                        trace_id=args.trace_id, snapshot_root=f"{root}/dim")
        return out
    root = args.snapshot_root or default_snapshot_root(spark, "silver") + "/fact"
    q = stream_medallion(
        spark, args.landing, names["bronze"], names["fact"], args.checkpoint, snapshot_root=root,
        available_now=args.processing_time is None, processing_time=args.processing_time,
    )
    q.awaitTermination()
    return {"stream": str(q.id)}


def cli() -> int:
    print(json.dumps(main(), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(cli())
