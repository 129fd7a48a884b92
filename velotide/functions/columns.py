"""Column-expression helpers.  All are built-in Spark expressions (no UDF), so
they stay inside whole-stage codegen and cost nothing beyond the projection."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Unicode White_Space characters, stripped by the warehouse's TRIM (which
# removes Unicode whitespace, unlike Spark's trim that removes blanks only).
UNICODE_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Earth radius of the spherical model used for station distances, metres.
EARTH_RADIUS_M = 6371010.0
# Unix epoch as wall-clock time; base for zone-free arithmetic on timestamp_ntz.
EPOCH_NTZ = "1970-01-01 00:00:00"
# Zones of the run instant: the trip batch month is named in the scheduler's
# zone, the station snapshot day in the feed operator's zone.
SOURCE_MONTH_ZONE = "Asia/Jakarta"
SNAPSHOT_ZONE = "America/New_York"
# ----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Strip leading and trailing Unicode whitespace (null stays null)."""
    return F.btrim(_c(c), F.lit(UNICODE_WHITESPACE))


def canonical_name(c) -> Column:
    """Order-free station name: lower-case, bracketed text removed, split on
    ``&``, parts trimmed, blanks dropped, sorted, joined with `` & ``.

    A null name gives the empty string, as an ARRAY subquery over an empty
    UNNEST does in the warehouse."""
    cleaned = F.regexp_replace(F.lower(trim_ws(c)), r"\s*\([^)]*\)", "")
    parts = F.transform(F.split(cleaned, "&"), lambda p: trim_ws(p))
    kept = F.filter(parts, lambda p: p != F.lit(""))
    return F.coalesce(F.array_join(F.array_sort(kept), " & "), F.lit(""))


def code_to_decimal(c) -> Column:
    """Station code as NUMERIC(38,9) after trailing underscores are removed;
    text that is not a number gives null."""
    return F.regexp_replace(_c(c), "_+$", "").try_cast("decimal(38,9)")


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres on a sphere of EARTH_RADIUS_M."""
    la1, lo1, la2, lo2 = (F.radians(_c(x)) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def epoch_seconds_ntz(c) -> Column:
    """Whole seconds since the epoch of a timestamp_ntz, independent of the
    session time zone."""
    return F.timestamp_diff("SECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), _c(c))


def epoch_micros_ntz(c) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), _c(c))


def minute_diff(end, start) -> Column:
    """Number of minute boundaries crossed between start and end
    (12:00:59 -> 12:01:00 is 1), not the elapsed whole minutes."""
    return F.floor(epoch_seconds_ntz(end) / 60) - F.floor(epoch_seconds_ntz(start) / 60)


def second_diff(end, start) -> Column:
    """Number of second boundaries crossed between start and end."""
    return epoch_seconds_ntz(end) - epoch_seconds_ntz(start)


def date_key(c) -> Column:
    """Calendar day as the integer YYYYMMDD (bigint)."""
    d = _c(c)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def zero(c) -> Column:
    return F.coalesce(_c(c), F.lit(0))


def row_md5(*cols, null_text: str = "<NULL>", sep: str = "|") -> Column:
    """Deterministic hex md5 row id over the given columns, nulls spelled out."""
    parts = [F.coalesce(_c(c).cast("string"), F.lit(null_text)) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def ntz_plus_seconds(base: str, seconds) -> Column:
    """``timestamp_ntz base`` plus a whole number of seconds."""
    return F.lit(base).cast("timestamp_ntz") + F.make_dt_interval(secs=_c(seconds))


def instant_from_micros(micros) -> Column:
    return F.timestamp_micros(_c(micros))


def source_month_of_run(run_instant) -> Column:
    """First day of the run's month in the scheduler's zone (the batch a
    monthly run lands)."""
    return F.trunc(F.to_date(F.from_utc_timestamp(_c(run_instant), SOURCE_MONTH_ZONE)), "month")


def snapshot_date_of_run(run_instant) -> Column:
    """Calendar day of the run in the feed's zone (the snapshot a daily run
    lands)."""
    return F.to_date(F.from_utc_timestamp(_c(run_instant), SNAPSHOT_ZONE))


def as_month(value) -> dt.date:
    """Day 1 of a month given as ``YYYY-MM``, ``YYYY-MM-DD``, date or timestamp."""
    if isinstance(value, dt.date):  # a datetime is one, too
        return dt.date(value.year, value.month, 1)
    text = str(value)
    if not re.fullmatch(r"\d{4}-\d{2}(-\d{2})?", text):
        raise ValueError(f"not a month: {text!r} (YYYY-MM or YYYY-MM-DD)")
    day = dt.date.fromisoformat(text if len(text) > 7 else f"{text}-01")
    return day.replace(day=1)
