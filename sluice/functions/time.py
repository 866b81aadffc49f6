"""Time helpers: forecast-style ``init`` stamps plus hour offsets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the layout of a forecast run stamp, e.g. 2024011500.
INIT_PATTERN = r"^[0-9]{10}$"  # yyyyMMddHH


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_init(c, lenient: bool = False) -> Column:
    """``yyyyMMddHH`` text to a timestamp without time zone.

    Malformed text fails the job; with ``lenient`` it becomes NULL. The
    digits are set out as a time and cast, so the session's time zone and
    its missing hours play no part.
    """
    text = _c(c)
    spelled = F.concat(F.substring(text, 1, 4), F.lit("-"), F.substring(text, 5, 2), F.lit("-"), F.substring(text, 7, 2),
                       F.lit(" "), F.substring(text, 9, 2), F.lit(":00:00"))
    known = F.when(text.rlike(INIT_PATTERN), spelled).when(text.isNotNull(), F.concat(F.lit("not an init stamp: "), text))
    return known.try_cast("timestamp_ntz") if lenient else known.cast("timestamp_ntz")


def stamp_date(c) -> Column:
    """The date of a zone-free timestamp as ``yyyyMMdd`` text."""
    return F.replace(F.substring(_c(c).cast("string"), 1, 10), F.lit("-"), F.lit(""))


def hours_after(base, hours) -> Column:
    """``base + hours`` as a day-time interval, keeping ``timestamp_ntz``."""
    return _c(base) + F.make_dt_interval(F.lit(0), _c(hours).cast("int"))
