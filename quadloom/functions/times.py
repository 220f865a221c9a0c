"""Instants as TIMESTAMP_NTZ in UTC.

``date_trunc`` and casts to TIMESTAMP go through the session time zone, which
is the caller's to choose. These expressions never do, so results are the same
in any session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: days from 0000-01-01 to 1970-01-01.
_DAYS_BEFORE_1970 = 719_528
# Fixed value: an ISO-8601 instant. A cast alone would take words like "today".
_INSTANT = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,9})?Z\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Each expression below refers to its argument once: the optimizer puts argument
# expressions in the place of columns, and repeated ones would multiply.


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970, rounded towards the past, from the year 0 on.

    ``unix_timestamp`` rounds towards 1970, so it is given a later instant.
    """
    later = F.timestamp_add("DAY", F.lit(_DAYS_BEFORE_1970), _col(ts))
    return F.unix_timestamp(later) - _DAYS_BEFORE_1970 * 86_400


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970, from the year 0 on."""
    fraction = F.extract(F.lit("SECOND"), _col(ts)) * 1_000_000
    return epoch_seconds(ts) * 1_000_000 + F.pmod(fraction.cast("bigint"), F.lit(1_000_000))


def from_epoch_seconds(seconds: Column | str) -> Column:
    """The instant of a count of seconds."""
    return F.timestamp_add("SECOND", _col(seconds), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def from_epoch_micros(micros: Column | str) -> Column:
    """The instant of a count of microseconds."""
    return F.timestamp_add("MICROSECOND", _col(micros), F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'"))


def truncate_seconds(ts: Column | str) -> Column:
    """The instant cut down to a whole second (towards the past)."""
    return from_epoch_seconds(epoch_seconds(ts))


def truncate_to(ts: Column | str, granularity: str) -> Column:
    """Cut an instant to ``second``, ``minute``, ``hour`` or ``day``."""
    widths = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400}
    width = widths[granularity]
    if width == 1:
        return truncate_seconds(ts)
    s = epoch_seconds(ts)
    return from_epoch_seconds(s - F.pmod(s, F.lit(width)))


def format_instant(ts: Column | str) -> Column:
    """ISO-8601 in UTC, with 0, 3 or 6 digits of a second as needed."""
    text = _col(ts).cast("string")
    fraction = F.substring(text, 21, 6)
    digits = F.length(fraction)
    width = F.when(digits <= 3, 3).otherwise(6)
    tail = F.when(digits == 0, F.lit("")).otherwise(F.concat(F.lit("."), F.rpad(fraction, width, "0")))
    return F.concat(F.replace(F.substring(text, 1, 19), F.lit(" "), F.lit("T")), tail, F.lit("Z"))


def parse_instant(text: Column | str) -> Column:
    """The instant of an ISO-8601 text in UTC; null when the text is not one."""
    text = _col(text)
    return F.when(text.rlike(_INSTANT), text.try_cast("timestamp_ntz"))
