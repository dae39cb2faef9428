"""Time helpers. Jobs pin the session time zone to UTC (see plans.session)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from editlens.config import HOUR_FORMAT


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_label(epoch_seconds: Column | str = "timestamp") -> Column:
    """Epoch seconds -> 'yyyy-MM-dd HH' in the session zone (UTC)."""
    return F.from_unixtime(_c(epoch_seconds), HOUR_FORMAT)


def epoch_ms(ts: Column | str) -> Column:
    return F.unix_millis(_c(ts))


def minute_start(ts: Column | str, seconds: int = 60) -> Column:
    """Start of the aligned period of ``seconds`` containing ``ts``."""
    return F.window(_c(ts), f"{int(seconds)} seconds").start


def to_ntz(ts: Column | str) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ (UTC wall clock) for result tables."""
    return _c(ts).cast("timestamp_ntz")
