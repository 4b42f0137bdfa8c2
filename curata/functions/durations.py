"""Duration and age columns (P7, P8, P9, P20), all built-in expressions.

Float arithmetic follows Python on non-negative input: ``%`` on doubles is
Java's exact ``fmod`` (``pmod`` would add and round), and whole units are taken
as ``(s - s % u) / u`` which is exact, like Python's ``//``.  Milliseconds are
rounded half-to-even (``rint``), as Python's ``round``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Unit sizes in seconds.
WEEK, DAY, HOUR, MINUTE = 7 * 24 * 60 * 60, 24 * 60 * 60, 60 * 60, 60


def epoch_us(c, dtype=None) -> Column:
    """Microseconds since 1970-01-01 without depending on the session time zone:
    wall-clock micros for ``timestamp_ntz``, instant micros for ``timestamp``,
    longs as they are."""
    x = _col(c)
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), x)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        return x.cast("long")
    return F.unix_micros(x.cast("timestamp"))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _whole(x: Column, unit: int) -> Column:
    return ((x - (x % F.lit(float(unit)))) / F.lit(float(unit))).cast("long")


def duration_text(c) -> Column:
    """P7. Text like ``0.500s``, ``5s``, ``2m``, ``2m 5s``, ``1h 0m 0s``, ``1w 0d 0h 0m 0s``.

    All units from the largest non-zero one down are printed, except that in the
    minutes-only branch the seconds are left out when they and the ms are 0.
    The ms can round to 1000 (``59.9996`` -> ``59.1000s``); that is kept.
    """
    s = _col(c).cast("double")
    weeks = _whole(s, WEEK)
    days = _whole(s % F.lit(float(WEEK)), DAY)
    hours = _whole(s % F.lit(float(DAY)), HOUR)
    minutes = _whole(s % F.lit(float(HOUR)), MINUTE)
    secs = F.floor(s % F.lit(60.0)).cast("long")
    ms = F.rint((s - F.floor(s)) * 1000.0).cast("long")
    sec_text = F.when(ms == 0, F.concat(secs.cast("string"), F.lit("s"))).otherwise(
        F.format_string("%d.%03ds", secs, ms))
    u = lambda v, suffix: F.concat(v.cast("string"), F.lit(suffix))
    return (
        F.when(weeks > 0, F.concat_ws(" ", u(weeks, "w"), u(days, "d"), u(hours, "h"), u(minutes, "m"), sec_text))
        .when(days > 0, F.concat_ws(" ", u(days, "d"), u(hours, "h"), u(minutes, "m"), sec_text))
        .when(hours > 0, F.concat_ws(" ", u(hours, "h"), u(minutes, "m"), sec_text))
        .when(minutes > 0, F.when((secs > 0) | (ms > 0), F.concat_ws(" ", u(minutes, "m"), sec_text))
              .otherwise(u(minutes, "m")))
        .otherwise(sec_text)
    )


def _idiv(x: Column, n: int) -> Column:
    """Integer division truncating toward zero (Java ``%`` keeps the dividend's sign)."""
    return ((x - x % F.lit(n)) / F.lit(n)).cast("long")


def elapsed_text(c) -> Column:
    """P8. Whole-second text up to days, always ending in seconds: ``1d 0h 0m 5s``.

    Integer division truncates toward zero, as shell arithmetic does.
    """
    s = _col(c).cast("long")
    days, hours = _idiv(s, DAY), _idiv(s % F.lit(DAY), HOUR)
    minutes, secs = _idiv(s % F.lit(HOUR), MINUTE), s % F.lit(MINUTE)
    return (
        F.when(days > 0, F.format_string("%dd %dh %dm %ds", days, hours, minutes, secs))
        .when(hours > 0, F.format_string("%dh %dm %ds", hours, minutes, secs))
        .when(minutes > 0, F.format_string("%dm %ds", minutes, secs))
        .otherwise(F.format_string("%ds", secs))
    )


def seconds_text(c) -> Column:
    """P9. Two-decimal seconds text for the CSV sink only (Java rounds the decimal
    digits half-up, Python the binary value; keep the double column for data)."""
    return F.format_string("%.2f", _col(c).cast("double"))


def age_hours(c, now) -> Column:
    """P20. Whole hours between ``c`` and ``now`` (a parameter, never the clock),
    on whole seconds, truncated toward zero as shell arithmetic."""
    now_col = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    diff = F.unix_seconds(now_col) - F.unix_seconds(_col(c).cast("timestamp"))
    return _idiv(diff, HOUR)
