"""Row key hashing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from natspark.functions.split import _c
from natspark.schemas import ADDRESS_FIELDS


def md5_hex(col) -> Column:
    """MD5 of the UTF-8 bytes, two lower-case hex digits per byte."""
    return F.md5(_c(col))


def rowkey(accesstime="accesstime", fields=tuple(ADDRESS_FIELDS)) -> Column:
    """Hex characters 8..23 of the MD5 of the six address strings joined
    without separator, then ``_`` and the epoch-millisecond accesstime.
    Protocol and host do not take part."""
    digest = md5_hex(F.concat(*[_c(f) for f in fields]))
    return F.concat(F.substring(digest, 9, 16), F.lit("_"), _c(accesstime).cast("string"))
