"""Column functions shared by batch and streaming plans."""

from editlens.functions.predicates import (
    group_key,
    has_wiki,
    not_bot,
    partition_key,
    should_count,
)
from editlens.functions.text import keyword_tokens
from editlens.functions.timefns import epoch_ms, hour_label, minute_start, to_ntz

__all__ = [
    "epoch_ms",
    "group_key",
    "has_wiki",
    "hour_label",
    "keyword_tokens",
    "minute_start",
    "not_bot",
    "partition_key",
    "should_count",
    "to_ntz",
]
