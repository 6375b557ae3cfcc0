"""Small projection helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from natspark.functions.split import _c


def strip_protocol(col) -> Column:
    """Remove one trailing ``:``."""
    c = _c(col)
    return F.when(c.endswith(":"), c.substr(F.lit(1), F.length(c) - 1)).otherwise(c)


def to_json_doc(cols) -> Column:
    """JSON object whose values are all strings (the sinks' document map).

    ``cols`` holds column names or ``(name, Column)`` pairs."""
    fields = []
    for c in cols:
        name, expr = (c, F.col(c)) if isinstance(c, str) else c
        fields.append(expr.cast("string").alias(name))
    return F.to_json(F.struct(*fields))
