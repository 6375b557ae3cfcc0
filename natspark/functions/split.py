"""String splitting with the JVM ``String.split`` contract.

``String.split(regex)`` drops trailing empty strings (``"a,"`` has one part,
``","`` has none) but an empty input yields one empty part.  Spark's ``split``
keeps trailing empties, so every field access in this package goes through
``jsplit`` and ``item``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# Separator patterns whose trailing runs are exactly a run of characters from
# a set, so a character-set ``rtrim`` strips them (much cheaper than a regex).
# ``\\s`` is the JVM's whitespace class.
TRIM_SETS = {",": ",", ":": ":", " ": " ", "\\.": ".", "\\|": "|", "[->()]": "->()",
             "\\s+": " \t\n\x0b\f\r"}


def jsplit(col, pattern: str) -> Column:
    """Split ``col`` on the regex ``pattern``; trailing empty parts dropped.

    Trailing separators are stripped first (``rtrim`` for the character
    separators above, else a possessive regex anchored at the absolute end),
    then Spark's ``split`` runs once.  ``split('')`` is ``['']``: right for an
    empty input, while an input made only of separators has no part.  Valid
    for separators that never match the empty string."""
    c = _c(col)
    chars = TRIM_SETS.get(pattern)
    if chars is not None:
        body = F.rtrim(c, F.lit(chars))
    else:
        body = F.regexp_replace(c, f"(?:{pattern})++\\z", "")
    parts = F.split(body, pattern)
    only_separators = (F.size(parts) == 1) & (F.get(parts, 0) == F.lit("")) & (c != F.lit(""))
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(parts)


def item(arr: Column, index: int) -> Column:
    """0-based element, null when the array is too short (never throws)."""
    return F.get(arr, index)


def text_lines(col) -> Column:
    """Lines of a text as a text-file reader sees them: split on ``\\n`` or
    ``\\r\\n``, no extra empty line after a final newline, no line at all
    for an empty text."""
    c = _c(col)
    body = F.regexp_replace(c, "\\r?\\n\\z", "")
    return (F.when(c == F.lit(""), F.array().cast("array<string>"))
            .otherwise(F.split(body, "\\r?\\n")))
