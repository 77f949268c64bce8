"""DataFrame -> DataFrame operators: bronze rows, parsing, dedupe, incremental
reads, MERGE, lookups. No I/O; every operator is lazy."""

from pluvio.operators.bronze import run_timestamp, to_bronze
from pluvio.operators.dedupe import latest_per_key
from pluvio.operators.incremental import high_water_mark, incremental_filter, mark_value
from pluvio.operators.lookup import last_day, next_cursor, observations, station, stations_listing, stations_page
from pluvio.operators.merge import assert_unique_keys, merge_counts, merge_into_table, merge_upsert
from pluvio.operators.numbering import number_rows
from pluvio.operators.parse import parse_dim, parse_fact, routine_reports

__all__ = [
    "assert_unique_keys",
    "high_water_mark",
    "incremental_filter",
    "last_day",
    "latest_per_key",
    "mark_value",
    "merge_counts",
    "merge_into_table",
    "merge_upsert",
    "next_cursor",
    "number_rows",
    "observations",
    "parse_dim",
    "parse_fact",
    "routine_reports",
    "run_timestamp",
    "station",
    "stations_listing",
    "stations_page",
    "to_bronze",
]
