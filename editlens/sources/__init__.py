"""Sources: driver fixtures, raw JSONL history, feeds and stream sources."""

from editlens.sources.fixtures import (
    documents,
    edit_events,
    load_table,
    part_names,
)
from editlens.sources.jsonl import scan_jsonl, scan_jsonl_strict
from editlens.sources.raw import land_raw, raw_inventory, run_raw_sink, write_jsonl
from editlens.sources.feed import dedupe_by_id, explode_features
from editlens.sources.stream import stream_source, to_log_records, write_log

__all__ = [
    "dedupe_by_id",
    "documents",
    "edit_events",
    "explode_features",
    "land_raw",
    "load_table",
    "part_names",
    "raw_inventory",
    "run_raw_sink",
    "scan_jsonl",
    "scan_jsonl_strict",
    "stream_source",
    "to_log_records",
    "write_log",
    "write_jsonl",
]
