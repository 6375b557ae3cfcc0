"""Time flooring with the reference's text arithmetic.

Times arrive as ISO text (``2020-08-17T09:14:58+08:00``).  The reference
replaces ``T`` by a space, keeps the first 14 characters, appends the minute
floored to the grain, and parses the result in the local zone: the UTC offset
is ignored and seconds are dropped.  Here the local zone is the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from natspark.functions.split import _c


def floor_minutes_ms(col, grain_minutes: int = 5) -> Column:
    """Epoch milliseconds of the floored minute, null when the text does not
    parse (the reference raises there).

    The checks come first in the CASE: Spark always evaluates a CASE's first
    condition, so the pieces it shares with the value (the translated text,
    the minute digits) are computed once; inside a later branch they would
    be computed again for every use."""
    if 60 % grain_minutes:
        raise ValueError("grain_minutes must divide 60")
    s = F.translate(_c(col), "T", " ")
    mm = F.substring(s, 15, 2)
    minute = mm.cast("int")
    floored = F.lpad((minute - minute % grain_minutes).cast("string"), 2, "0")
    text = F.concat(F.substring(s, 1, 14), floored, F.lit(":00"))
    ts = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    bad = (F.length(s) < 16) | ~mm.rlike("^[0-9]{1,2}$")
    return F.when(bad, F.lit(None).cast("bigint")).otherwise(F.unix_millis(ts))


def event_time(ms_col) -> Column:
    """TIMESTAMP (session zone) from epoch milliseconds, for watermarks and
    windows; TIMESTAMP_NTZ is not accepted by ``withWatermark``."""
    return F.timestamp_millis(_c(ms_col))


def msg_time(col) -> Column:
    """ISO text to its 5-minute floor in epoch seconds (offset dropped)."""
    return F.floor(floor_minutes_ms(col, 5) / 1000).cast("bigint")


def _task_struct(ts: Column) -> Column:
    """Slots on the local clock: the instant is truncated, the rest of the
    step is taken off the zoneless time, and the zone is applied again."""
    def slot(unit: str, seconds: int, back: Column | None = None) -> Column:
        local = F.date_trunc(unit, ts).cast("timestamp_ntz")
        if back is not None:
            local = local - back
        cur = F.unix_seconds(local.cast("timestamp"))
        return F.struct(cur.alias("current"), (cur - F.lit(seconds)).alias("previous"))

    return F.struct(
        slot("hour", 3600).alias("hour"),
        slot("hour", 21600, F.make_dt_interval(hours=F.hour(ts) % 6)).alias("six_hour"),
        slot("day", 86400).alias("day"),
        slot("minute", 300, F.make_dt_interval(mins=F.minute(ts) % 5)).alias("minute5"))


def task_time(epoch_seconds) -> Column:
    """Four (current, previous) epoch-second pairs for a time: hour, 6-hour
    block, local day and 5-minute slot.  "Previous" is fixed-second
    arithmetic (-3600, -21600, -86400, -300), as in the reference."""
    return _task_struct(F.timestamp_seconds(_c(epoch_seconds)))


def task_time_now() -> Column:
    """``task_time`` of the current time."""
    return _task_struct(F.current_timestamp())
