"""Row predicates and key expressions (all JVM-side Column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from editlens.config import (
    COUNTED_TYPES,
    DEFAULT_PARTITION_KEY,
    DEFAULTS,
    UNKNOWN_KEY,
)


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def not_bot(bot: Column | str = "bot") -> Column:
    """Null-safe bot filter: keep ``bot = false`` and ``bot IS NULL``."""
    return ~F.coalesce(_c(bot), F.lit(False))


def has_wiki(wiki: Column | str = "wiki") -> Column:
    return _c(wiki).isNotNull()


def should_count(
    bot: Column | str = "bot",
    etype: Column | str = "type",
    wiki: Column | str = "wiki",
    title: Column | str = "title",
) -> Column:
    """Speed-layer admission rule.

    Bots are dropped. A missing or empty type is kept. A non-empty type
    outside the counted set is rejected only when the record carries a
    wiki or a title; a record with neither (a foreign feed item) is kept.
    A JSON null is treated as an absent field.
    """
    t = _c(etype)
    typed_ok = (
        (F.coalesce(t, F.lit("")) == F.lit(""))
        | t.isin(*COUNTED_TYPES)
        | (_c(wiki).isNull() & _c(title).isNull())
    )
    return not_bot(bot) & typed_ok


def group_key(wiki: Column | str = "wiki", ident: Column | str = "id") -> Column:
    """Counting key: wiki, else id, else 'unknown' (empty strings skipped)."""
    return F.coalesce(
        F.nullif(_c(wiki).cast("string"), F.lit("")),
        F.nullif(_c(ident).cast("string"), F.lit("")),
        F.lit(UNKNOWN_KEY),
    )


def partition_key(key: Column | str = "wiki", max_len: int = DEFAULTS.key_max_len) -> Column:
    """Stream partition key: first ``max_len`` characters, or 'default'."""
    return F.coalesce(
        F.nullif(F.substring(_c(key).cast("string"), 1, max_len), F.lit("")),
        F.lit(DEFAULT_PARTITION_KEY),
    )
