"""Reads, writes and tables: envelopes, NDJSON, catalog DDL, write
dispositions, scans, SQL with bound parameters, snapshot / partition publishing."""

from pluvio.sources.envelopes import check_envelopes, quarantined_envelopes, read_envelopes, write_envelopes
from pluvio.sources.sql import qualified, run_sql
from pluvio.sources.tables import (
    WRITE_APPEND,
    WRITE_EMPTY,
    WRITE_TRUNCATE,
    create_tables,
    geography_view,
    publish_partitions,
    tracks_partitions,
    load_table,
    publish_snapshot,
    read_bronze,
    read_ndjson,
    read_table,
    replace_partitions,
    scan,
    set_table_property,
    table_property,
    table_exists,
    table_ddl,
)

__all__ = [
    "check_envelopes",
    "WRITE_APPEND",
    "WRITE_EMPTY",
    "WRITE_TRUNCATE",
    "create_tables",
    "geography_view",
    "publish_partitions",
    "tracks_partitions",
    "load_table",
    "publish_snapshot",
    "qualified",
    "quarantined_envelopes",
    "read_bronze",
    "read_envelopes",
    "read_ndjson",
    "read_table",
    "replace_partitions",
    "run_sql",
    "scan",
    "set_table_property",
    "table_property",
    "table_ddl",
    "table_exists",
    "write_envelopes",
]
