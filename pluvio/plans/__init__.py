"""The jobs: bronze load (C1), extract + load (C4), silver fact (C2),
silver dimension (C3) and the silver run (C5)."""

from pluvio.plans.bronze_job import run_bronze, run_bronze_load
from pluvio.plans.silver_job import (
    dim_source,
    fact_source,
    merge_dim,
    merge_fact,
    run_silver,
    run_silver_dim,
    run_silver_fact,
)

__all__ = [
    "dim_source",
    "fact_source",
    "merge_dim",
    "merge_fact",
    "run_bronze",
    "run_bronze_load",
    "run_silver",
    "run_silver_dim",
    "run_silver_fact",
]
