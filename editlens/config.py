"""Defaults and fixed values shared by every job."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values that must equal the original pipeline's -----------------
# Stop words removed from title keywords, in their original order.
STOP_WORDS = (
    "the", "a", "an", "of", "and", "in", "to", "is", "it", "for",
    "on", "at", "by", "with", "from", "as", "or", "that", "this",
)
# Keyword token pattern, applied to the lower-cased title.
TOKEN_PATTERN = "[a-zA-Z]{3,}"
# Event types the speed layer counts; other non-empty types are rejected.
COUNTED_TYPES = ("edit", "new", "categorize")
# Hour label format of the hourly view.
HOUR_FORMAT = "yyyy-MM-dd HH"
# Fallback grouping key and stream partition key.
UNKNOWN_KEY = "unknown"
DEFAULT_PARTITION_KEY = "default"
DEFAULT_WIKI = "enwiki"
# White space around a JSON line: what a plain text strip removes.
WHITE_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
               "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
# Latency reported for a sentinel that never shows up (ms).
SENTINEL_TIMEOUT_MS = 60000.0
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Defaults:
    top_n: int = 10
    exclude_bots: bool = True
    window: str = "5 minutes"
    slide: str = "1 minute"
    window_seconds: int = 300
    pane_seconds: int = 10
    watermark: str = "1 minute"
    trigger: str = "30 seconds"
    max_files: int = 1000               # landed files per micro-batch
    flush_size: int = 50
    flush_seconds: int = 10
    raw_file_records: int = 1_000_000   # of a raw history file; producers flush far smaller ones
    landed_rows: int = 250_000          # of a landed stream file
    state_partitions: int = 24          # of the snapshot's state, if a micro-batch has no more files
    fanout: int = 5
    key_max_len: int = 256
    period_seconds: int = 60
    rate_threshold: float = 500.0
    rate_periods: int = 3
    lag_threshold_ms: float = 60000.0
    lag_periods: int = 2
    sentinel_timeout_ms: float = SENTINEL_TIMEOUT_MS


DEFAULTS = Defaults()
