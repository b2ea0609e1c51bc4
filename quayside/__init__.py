"""Typed load and export for Spark."""

from quayside.functions.convert import conform, conform_column
from quayside.functions.jsontext import json_flatten, json_rows, to_json_value
from quayside.functions.normalize import normalize, output_schema
from quayside.operators.align import align
from quayside.operators.batches import cut_batches
from quayside.operators.export import export
from quayside.operators.index import with_group_index, with_row_index
from quayside.operators.ledger import classify, dedup, error_message, read_ledger, retry_select
from quayside.operators.load import load, load_table, read_target
from quayside.operators.queries import run_per_key, run_queries, run_query
from quayside.operators.route import route
from quayside.plans.session import configure
from quayside.sources.readers import pull_increment, read_checked, read_json_strict, read_records, table_spec
from quayside.streaming.stream import drop_replayed, stream_load
from quayside.types import ColumnSpec, spec

__all__ = [
    "ColumnSpec", "align", "classify", "configure", "conform", "conform_column", "cut_batches", "dedup", "drop_replayed",
    "error_message", "export", "json_flatten", "json_rows", "load", "load_table", "normalize", "output_schema", "pull_increment",
    "read_checked", "read_json_strict", "read_ledger", "read_records", "read_target", "retry_select", "route", "run_per_key",
    "run_queries", "run_query", "spec", "stream_load", "table_spec", "to_json_value", "with_group_index", "with_row_index",
]
