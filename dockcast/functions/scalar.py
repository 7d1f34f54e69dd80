"""Scalar column expressions (JVM-side, whole-stage codegen friendly).

Every function takes column names or Columns and returns a Column, so it can
be used inside ``select``/``withColumn`` on any table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    if isinstance(c, Column):
        return c
    # Names such as ``30m_blag_pct_full`` start with a digit: quote them.
    return F.col(f"`{c}`") if not c.startswith("`") and "." not in c else F.col(c)


def occupancy_ratio(full: str | Column, empty: str | Column) -> Column:
    """full / (full + empty); null when the station has no docks (0/0).

    ``try_divide`` instead of ``/``: under ANSI mode a zero divisor raises.
    """
    f = col(full)
    return F.try_divide(f.cast("double"), (f + col(empty)).cast("double"))


def clip01(x: str | Column) -> Column:
    """Clip to [0, 1]; null stays null (greatest/least alone would skip it)."""
    c = col(x)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(0.0), F.least(F.lit(1.0), c.cast("double"))))


def floor_at(x: str | Column, lo: float = 0.0) -> Column:
    c = col(x)
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(lo), c.cast("double")))


def euclid(x1, y1, x2, y2) -> Column:
    """Plane distance between (x1, y1) and (x2, y2), as on lat/lng degrees."""
    return F.sqrt(F.pow(col(x1) - col(x2), 2) + F.pow(col(y1) - col(y2), 2))


def month_part(ts) -> Column:
    return F.month(col(ts)).cast("long")


def weekday_part(ts) -> Column:
    """Day of week with Monday = 0 (the serving convention)."""
    return F.weekday(col(ts)).cast("long")


def hour_part(ts) -> Column:
    return F.hour(col(ts)).cast("long")


def time_features(ts: str) -> dict[str, Column]:
    """month, day_of_week (Mon=0), hour of a timestamp column."""
    return {"month": month_part(ts), "day_of_week": weekday_part(ts), "hour": hour_part(ts)}


def hour_key(ts) -> Column:
    """Text hour key ``yyyy-MM-dd_HH`` (display/parity only; joins use
    ``hour_floor`` which keeps the timestamp type)."""
    return F.date_format(col(ts), "yyyy-MM-dd_HH")


def _floor_ntz(c: Column, unit: str) -> Column:
    """Wall-clock truncation built from the parts, so no session-time-zone
    round trip (and no DST gap) is involved."""
    zero = F.lit(0)
    return F.make_timestamp_ntz(
        F.year(c), F.month(c), F.dayofmonth(c),
        F.hour(c) if unit in ("hour", "minute") else zero,
        F.minute(c) if unit == "minute" else zero, zero)


def _floor(c: Column, unit: str, ntz: bool) -> Column:
    return _floor_ntz(c, unit) if ntz else F.date_trunc(unit, c).cast("timestamp")


def hour_floor(ts, ntz: bool = True) -> Column:
    """Truncate to the hour: wall clock (TIMESTAMP_NTZ) by default, or an
    instant truncated in the session time zone with ``ntz=False``."""
    return _floor(col(ts), "hour", ntz)


def forecast_ts(ts, minutes: int = 30, ntz: bool = True) -> Column:
    """Base time + horizon, rounded to the minute (half a minute rounds up;
    the pandas original rounds exact half-minutes to even)."""
    shifted = col(ts) + F.expr(f"INTERVAL {int(minutes)} MINUTES 30 SECONDS")
    return _floor(shifted, "minute", ntz)


def wall_clock(ts, from_tz: str, to_tz: str) -> Column:
    """Wall-clock time in ``from_tz`` → the same instant's wall clock in
    ``to_tz`` (TIMESTAMP_NTZ in and out, independent of the session zone)."""
    return F.convert_timezone(F.lit(from_tz), F.lit(to_tz), col(ts).cast("timestamp_ntz"))


def relative_day_text(ts, days: int, fmt: str = "yyyy-MM-dd") -> Column:
    """Date ``days`` before ``ts`` as text (report request ranges)."""
    return F.date_format(F.date_sub(F.to_date(col(ts)), days), fmt)


def ts_text(ts, fmt: str) -> Column:
    """Timestamp → text in a fixed format (see ``fixed_values``)."""
    return F.date_format(col(ts), fmt)


def parse_ts(text, fmt: str, ntz: bool = True) -> Column:
    """Text in a fixed format → timestamp (null when it does not parse)."""
    f = F.try_to_timestamp(col(text), F.lit(fmt))
    return f.cast("timestamp_ntz") if ntz else f


def epoch_seconds_to_ts(c) -> Column:
    return F.timestamp_seconds(col(c))


def epoch_nanos_to_ts(c) -> Column:
    """pandas writes ns timestamps; read as long they are divided down to µs."""
    return F.timestamp_micros(F.floor(col(c) / F.lit(1000)).cast("long"))


def map_default(c, mapping: Mapping[str, str], default: str = "N/A") -> Column:
    """Dictionary lookup with a default, as a literal map (small mappings).

    Large mappings belong in a table joined with ``operators.joins.lookup_join``.
    """
    if not mapping:
        return F.lit(default)
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.coalesce(F.element_at(F.create_map(*kv), col(c)), F.lit(default))


def percent_text(x, digits: int = 0) -> Column:
    """Fraction → ``'42%'`` text as shown in the station view; exact halves
    round to the even percent (12.5 % → 12 %)."""
    c = col(x)
    if digits == 0:
        txt = F.format_string("%d%%", F.bround(c * 100).cast("long"))
    else:
        txt = F.format_string(f"%.{digits}f%%", c * 100)
    return F.when(c.isNotNull(), txt)


def reconstruct_fill(pct, change, mode: str = "serving") -> Column:
    """Turn a predicted relative change back into a fill level.

    ``serving`` follows the serving formula (pct + 1 + change); ``consistent``
    inverts the training target (target = pct - future ⇒ future = pct - change).
    """
    if mode == "serving":
        return col(pct) + F.lit(1.0) + col(change)
    if mode == "consistent":
        return col(pct) - col(change)
    raise ValueError(f"unknown mode {mode!r}")


def json_int_field(c, field: str) -> Column:
    """Integer field of a JSON text column; a malformed value gives null
    (one bad record must not fail a job over the whole table)."""
    return F.get_json_object(col(c), f"$.{field}").try_cast("int")


def any_true(conds: list[Column]) -> Column:
    """Null-safe OR: a comparison against null counts as False (as a pandas
    boolean mask does)."""
    out = F.lit(False)
    for c in conds:
        out = out | F.coalesce(c, F.lit(False))
    return out


def any_null(cols: list[str]) -> Column:
    return any_true([col(c).isNull() for c in cols])
