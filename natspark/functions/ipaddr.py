"""Dotted IPv4 text to an unsigned 32-bit value held in BIGINT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from natspark.functions.split import _c, item, jsplit


def ip_to_long(col) -> Column:
    """Shift-or of the four dot-separated parts; 0 when there are not exactly
    four parts (trailing empty parts do not count).  Parts are not range
    checked, as in the reference; a non-numeric part gives null where the
    reference raises."""
    parts = jsplit(col, "\\.")
    acc = F.lit(0).cast("bigint")
    for i in range(4):
        octet = item(parts, i).try_cast("int").cast("bigint")
        acc = F.shiftleft(acc, 8).bitwiseOR(octet)
    return F.when(F.size(parts) == 4, acc).otherwise(F.lit(0).cast("bigint"))


def ip_to_long_strict(col) -> Column:
    """Value of a well-formed address (four parts of decimal digits, each
    0..255; leading zeros are read as numbers), else null.  Used for range
    lookups, where a malformed address resolves to nothing.

    The validity test is the CASE's first condition, which Spark always
    evaluates, so the split and the four casts are shared with the value
    instead of being recomputed; no regex runs per row."""
    parts = F.split(_c(col), "\\.")
    octets = [item(parts, i).try_cast("int") for i in range(4)]
    ok = (F.size(parts) == 4) & (F.translate(_c(col), "0123456789.", "") == F.lit(""))
    for o in octets:
        ok = ok & o.between(0, 255)
    val = (F.shiftleft(octets[0].cast("bigint"), 24) + F.shiftleft(octets[1].cast("bigint"), 16)
           + F.shiftleft(octets[2].cast("bigint"), 8) + octets[3].cast("bigint"))
    return F.when(ok, val)
