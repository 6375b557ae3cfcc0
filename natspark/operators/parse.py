"""Syslog line parsing (split, arity filter, field extraction, rejects).

A line is ``<time> <host> t2 t3 t4 t5 <src:port>-><dst:port>(<proto>):, <text>
snat to <ip:port>``.  The comma parts, whitespace tokens, flow items and
``ip:port`` pairs are all split with the JVM ``String.split`` contract
(``jsplit``), so a trailing separator never yields a field.

One projection computes every field and a ``reason`` naming the first field
that is missing, in the order the reference evaluates them.  Accepted rows
have no reason; rejected rows keep the raw line.  No Python runs per row.

Rows are kept or dropped with ``inline`` over a zero-or-one element array
rather than with ``where``: a filter on a parsed field would be pushed below
the projections and have every nested split inlined into it (the plan grows
exponentially and each split runs twice).  The generator is a barrier that
keeps each split computed once per line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from natspark.functions import sqlexpr as X
from natspark.schemas import NAT_LOG_COLUMNS

# The field order of the reference's evaluation, which decides
# the reject reason reported for a line that misses several fields.
REASON_ORDER = ["accesstime", "hostIP", "flow", "source", "target", "converted",
                "protocol", "sourceIp", "sourcePort", "targetIp", "targetPort",
                "convertedIp", "convertedPort"]

# Column holding each REASON_ORDER field (or the intermediate it comes from).
_PRESENT = {"accesstime": "accesstime", "hostIP": "hostIP", "flow": "_flow",
            "source": "_source", "target": "_target", "converted": "_converted",
            "protocol": "protocol", **{n: n for n in REASON_ORDER[7:]}}
_PAIRS = {"source": "_source", "target": "_target", "converted": "_converted"}
# The reference's separators.
COMMA, WHITESPACE, SNAT, PORT = ",", r"\s+", " snat to ", ":"
FLOW_CHARS = "->()"          # the flow token is split on any one of these


def _fields(lines: DataFrame, value: str, grain_minutes: int, keep: list[str]) -> DataFrame:
    """Projections, each one ``selectExpr``; every split is computed once and
    referenced by name in the next stage (the stages fuse into one
    generated-code loop).  The two comma parts contain no comma, so their
    flow and ``snat to`` separators are rewritten to commas and split
    without a regex."""
    k = [X.ident(c) for c in keep]
    v = f"CAST({X.ident(value)} AS STRING)"
    stage1 = lines.selectExpr(*k, f"{v} AS _line", f"{X.jsplit(v, COMMA)} AS _parts")
    stage2 = stage1.selectExpr(
        *k, "_line", "size(_parts) >= 2 AS _arity_ok",
        f"{X.jsplit(X.item('_parts', 0), WHITESPACE)} AS _tok",
        f"{X.jsplit_on_comma(X.item('_parts', 1), literal=SNAT)} AS _conv")
    stage3 = stage2.selectExpr(
        *k, "_line", "_arity_ok",
        f"{X.time_text(X.item('_tok', 0))} AS _time",
        f"{X.item('_tok', 1)} AS hostIP", f"{X.item('_tok', 6)} AS _flow",
        f"{X.item('_conv', 1)} AS _converted")
    stage4 = stage3.selectExpr(
        *k, "_line", "_arity_ok", "_time", f"{X.minute_of('_time')} AS _minute",
        "hostIP", "_flow", "_converted",
        f"{X.jsplit_on_comma('_flow', chars=FLOW_CHARS)} AS _fl")
    stage5 = stage4.selectExpr(
        *k, "_line", "_arity_ok",
        f"{X.floored_ms('_time', '_minute', grain_minutes)} AS accesstime",
        "hostIP", "_flow", "_converted",
        f"{X.item('_fl', 0)} AS _source", f"{X.item('_fl', 2)} AS _target",
        f"{X.strip_protocol(X.item('_fl', 3))} AS protocol")
    stage6 = stage5.selectExpr(
        *k, "_line", "_arity_ok", "accesstime", "hostIP", "protocol", "_flow", *_PAIRS.values(),
        *[f"{X.jsplit(c, PORT)} AS _{n}_p" for n, c in _PAIRS.items()])
    out = stage6.selectExpr(
        *k, "_line", "_arity_ok", "accesstime", "hostIP", "protocol", "_flow", *_PAIRS.values(),
        *[f"{X.item(f'_{n}_p', 0)} AS {n}Ip" for n in _PAIRS],
        *[f"{X.item(f'_{n}_p', 1)} AS {n}Port" for n in _PAIRS])
    reason = "coalesce(" + ", ".join(
        f"CASE WHEN {_PRESENT[n]} IS NULL THEN {X.lit(n)} END" for n in REASON_ORDER) + ")"
    return out.selectExpr(*k, "_line", "_arity_ok", *NAT_LOG_COLUMNS, f"{reason} AS reason")


def _select_rows(df: DataFrame, keep_row: str, cols: list[str], keep=()) -> DataFrame:
    """Rows where the SQL condition ``keep_row`` holds, projected to ``keep``
    and ``cols``, without a Filter node (see the module note): ``inline`` of a
    null array yields no row.  ``keep`` stays beside the generator, so a later
    filter on a partition column still reaches the scan."""
    row = "struct(" + ", ".join(X.ident(c) for c in cols) + ")"
    return df.selectExpr(*[X.ident(c) for c in keep], f"inline(CASE WHEN {keep_row} THEN array({row}) END)")


def parse_all(lines: DataFrame, value: str = "value", grain_minutes: int = 5,
              keep: list[str] | tuple = ()) -> DataFrame:
    """Every line parsed, plus ``reason`` (null when accepted), the raw
    line as ``_line`` and ``_arity_ok`` (at least two comma parts; lines
    without are dropped silently, neither accepted nor rejected)."""
    return _fields(lines, value, grain_minutes, list(keep))


def _observed(parsed: DataFrame, observe: str | Observation) -> DataFrame:
    """``parsed`` with the figures of ``natspark.streaming.accounting``,
    counted as its rows pass."""
    ok = F.col("_arity_ok")
    return parsed.observe(observe, F.count(F.lit(1)).alias("lines"),
                          F.count_if(ok & F.col("reason").isNull()).alias("accepted"),
                          F.count_if(ok & F.col("reason").isNotNull()).alias("rejected"),
                          F.count_if(~ok).alias("without_arity"))


def parse_table(lines: DataFrame, value: str = "value", grain_minutes: int = 5,
                keep: list[str] | tuple = (), observe: str | Observation | None = None) -> DataFrame:
    """Accepted and rejected rows of one parse, to be written once and read
    by every branch: ``keep`` and ``NAT_LOG`` columns, ``reason`` (null when
    accepted) and ``line`` (the raw line of a rejected row, else null).  With
    ``observe`` (a name, or an ``Observation`` of a batch) the lines are
    counted by what became of them."""
    parsed = parse_all(lines, value, grain_minutes, keep)
    if observe is not None:
        parsed = _observed(parsed, observe)
    cols = [*keep, *NAT_LOG_COLUMNS, "reason"]
    rows = _select_rows(parsed, "_arity_ok", [*NAT_LOG_COLUMNS, "reason", "_line"], keep)
    return rows.selectExpr(*[X.ident(c) for c in cols], "CASE WHEN reason IS NOT NULL THEN _line END AS line")


def accepted(table: DataFrame) -> DataFrame:
    """The parsed logs of a ``parse_table``."""
    return table.where("reason IS NULL").drop("reason", "line")


def rejected(table: DataFrame, keep: list[str] | tuple = ()) -> DataFrame:
    """The rejected lines of a ``parse_table``, as ``parse_rejects`` gives them."""
    return table.where("reason IS NOT NULL").select(*keep, "line", "reason")


def parse_nat_log(lines: DataFrame, value: str = "value", grain_minutes: int = 5,
                  keep: list[str] | tuple = (), mode: str = "drop") -> DataFrame:
    """Parsed NAT logs (``NAT_LOG`` columns plus ``keep``).

    ``mode="drop"``: malformed lines are left out (see ``parse_rejects``);
    ``mode="fail"``: the job fails on the first malformed line, as the
    reference does.  ``grain_minutes=1`` gives the unfloored variant.
    """
    parsed = parse_all(lines, value, grain_minutes, keep)
    if mode == "fail":
        keep_row = ("CASE WHEN _arity_ok AND reason IS NOT NULL THEN raise_error(concat("
                    "'malformed NAT log (', reason, '): ', _line)) ELSE _arity_ok END")
        return _select_rows(parsed, keep_row, NAT_LOG_COLUMNS, keep)
    if mode != "drop":
        raise ValueError("mode must be 'drop' or 'fail'")
    return _select_rows(parsed, "_arity_ok AND reason IS NULL", NAT_LOG_COLUMNS, keep)


def parse_rejects(lines: DataFrame, value: str = "value", grain_minutes: int = 5,
                  keep: list[str] | tuple = ()) -> DataFrame:
    """Lines that pass the arity filter but miss a required field:
    ``keep`` columns, ``line`` and ``reason``."""
    parsed = parse_all(lines, value, grain_minutes, keep)
    rejected = _select_rows(parsed, "_arity_ok AND reason IS NOT NULL",
                            ["_line", "reason"], keep)
    return rejected.withColumnRenamed("_line", "line")
