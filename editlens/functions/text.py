"""Title keyword tokenizer as native array expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from editlens.config import STOP_WORDS, TOKEN_PATTERN


def word_matches(text: Column | str) -> Column:
    """Lower-cased ASCII-letter runs of length >= 3, stop words included."""
    c = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(F.lower(c), F.lit(TOKEN_PATTERN), F.lit(0))


def keyword_tokens(text: Column | str) -> Column:
    """Lower-case, find all ASCII-letter runs of length >= 3, drop stop words.

    Returns ``array<string>`` (NULL for a NULL text, which ``explode``
    treats like an empty array).
    """
    return F.filter(word_matches(text), lambda w: ~w.isin(*STOP_WORDS))
