"""String helpers that mirror the small Python string idioms of the
reference projects (``strip(chars)``, ``rsplit(n=1)``, ``replace``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def btrim_chars(c, chars: str) -> Column:
    """Python ``str.strip(chars)``: remove any of ``chars`` from both ends."""
    return F.btrim(_c(c), F.lit(chars))


def strip_text(c, text: str) -> Column:
    """Remove every literal occurrence of ``text`` (``replace(text, '')``)."""
    return F.replace(_c(c), F.lit(text), F.lit(""))


def empty_as_null(c) -> Column:
    """``''`` becomes NULL, anything else passes through."""
    return F.nullif(_c(c), F.lit(""))


def last_token(c) -> Column:
    """``s.rsplit(n=1)[-1]``: the last whitespace-separated token."""
    return F.regexp_extract(_c(c), r"^(.*?)\s*(\S+)\s*$", 2)


def before_last_token(c) -> Column:
    """``s.rsplit(n=1)[0]``: text before the last whitespace-separated token.

    A string with a single token has nothing before it; that yields NULL,
    as pandas does when ``rsplit`` produces one part.
    """
    head = F.regexp_extract(_c(c), r"^\s*(.*\S)\s+\S+\s*$", 1)
    return F.when(head == "", F.lit(None).cast("string")).otherwise(head)
