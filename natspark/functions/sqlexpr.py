"""The parse's building blocks as Spark SQL expression text.

Same expressions as the Column functions in this package, written as SQL so
that a whole parse stage is one ``selectExpr`` call instead of thousands of
Python-to-JVM calls (plan construction dominated small jobs).  Arguments are
SQL expressions (usually column names); results are SQL text.
"""

from __future__ import annotations

from natspark.functions.split import TRIM_SETS


def lit(s: str) -> str:
    """A Spark SQL string literal for ``s`` (backslash escapes, \\uXXXX for
    control characters)."""
    out = []
    for ch in s:
        if ch in ("\\", "'"):
            out.append("\\" + ch)
        elif ord(ch) < 32 or ord(ch) == 127:
            out.append("\\u%04x" % ord(ch))
        else:
            out.append(ch)
    return "'" + "".join(out) + "'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def jsplit(e: str, pattern: str) -> str:
    """``functions.split.jsplit`` as SQL."""
    chars = TRIM_SETS.get(pattern)
    if chars is not None:
        body = f"trim(TRAILING {lit(chars)} FROM {e})"
    else:
        strip = "(?:" + pattern + r")++\z"
        body = f"regexp_replace({e}, {lit(strip)}, '')"
    parts = f"split({body}, {lit(pattern)}, -1)"
    return (f"CASE WHEN size({parts}) = 1 AND get({parts}, 0) = '' AND {e} <> '' "
            f"THEN CAST(array() AS ARRAY<STRING>) ELSE {parts} END")


def jsplit_on_comma(e: str, literal: str | None = None, chars: str | None = None) -> str:
    """``jsplit`` for a text that contains no comma (a comma part of a line):
    the separator (a ``literal`` string, or any one of ``chars``) is first
    rewritten to a comma with a plain ``replace`` / ``translate``, so the split
    takes the JVM's no-regex path instead of compiling a pattern per row.
    Same parts as splitting on the separator itself."""
    if literal is not None:
        e = f"replace({e}, {lit(literal)}, ',')"
    if chars is not None:
        e = f"translate({e}, {lit(chars)}, {lit(',' * len(chars))})"
    return jsplit(e, ",")


def item(arr: str, index: int) -> str:
    return f"get({arr}, {int(index)})"


def time_text(e: str) -> str:
    """Stage 1 of the floor: ``T`` replaced by a space."""
    return f"translate({e}, 'T', ' ')"


def minute_of(t: str) -> str:
    """Stage 2 of the floor: the two minute digits of a ``time_text`` as INT
    (null unless they are digits, as the JVM's integer parse requires)."""
    mm = f"substring({t}, 15, 2)"
    return f"CASE WHEN {mm} RLIKE '^[0-9]{{1,2}}$' THEN CAST({mm} AS INT) END"


def floored_ms(t: str, minute: str, grain_minutes: int = 5) -> str:
    """Stage 3 of the floor, from the columns of stages 1 and 2.  Staging
    keeps every piece computed once (inside a CASE branch Spark would
    evaluate each repeated piece again)."""
    if 60 % grain_minutes:
        raise ValueError("grain_minutes must divide 60")
    floored = f"lpad(CAST({minute} - {minute} % {int(grain_minutes)} AS STRING), 2, '0')"
    text = f"concat(substring({t}, 1, 14), {floored}, ':00')"
    return (f"CASE WHEN length({t}) >= 16 THEN "
            f"unix_millis(try_to_timestamp({text}, 'yyyy-MM-dd HH:mm:ss')) END")


def floor_minutes_ms(e: str, grain_minutes: int = 5) -> str:
    """``functions.timefns.floor_minutes_ms`` as one SQL expression (checks
    first, so the shared pieces are computed once)."""
    if 60 % grain_minutes:
        raise ValueError("grain_minutes must divide 60")
    s = time_text(e)
    mm = f"substring({s}, 15, 2)"
    minute = f"CAST({mm} AS INT)"
    floored = f"lpad(CAST({minute} - {minute} % {int(grain_minutes)} AS STRING), 2, '0')"
    text = f"concat(substring({s}, 1, 14), {floored}, ':00')"
    return (f"CASE WHEN length({s}) < 16 OR NOT ({mm} RLIKE '^[0-9]{{1,2}}$') THEN NULL "
            f"ELSE unix_millis(try_to_timestamp({text}, 'yyyy-MM-dd HH:mm:ss')) END")


def strip_protocol(e: str) -> str:
    return f"CASE WHEN endswith({e}, ':') THEN substring({e}, 1, length({e}) - 1) ELSE {e} END"
