"""Column-level helpers: every function returns a ``Column`` built from
Spark SQL built-ins, so it stays inside whole-stage code generation."""

from sluice.functions.text import (  # noqa: F401
    btrim_chars,
    empty_as_null,
    last_token,
    before_last_token,
    strip_text,
)
from sluice.functions.time import hours_after, parse_init  # noqa: F401
