"""What became of every line: figures observed while the parse runs.

``parse_table(..., observe=NAME)`` counts its lines on the way, without a pass
of its own: ``lines`` that came in, and how many of them were accepted,
rejected, or without the two comma parts.  In a stream the figures of each
micro-batch reach ``ParseAccounting``, a query listener, together with the rows
that the watermark dropped.
"""

from __future__ import annotations

import threading

from pyspark.sql.streaming import StreamingQueryListener

FIGURES = ("lines", "accepted", "rejected", "without_arity")


class ParseAccounting(StreamingQueryListener):
    """Adds up the figures of the queries it hears of (``spark.streams.
    addListener``), by the name given to ``observe``.  A micro-batch that is
    run again counts once: its last run."""

    def __init__(self):
        self._lock = threading.Lock()
        self._batches: dict[tuple[str, str, int], dict[str, int]] = {}
        self._late: dict[tuple[str, int], int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        query, batch = str(p.id), p.batchId
        with self._lock:
            for name, row in p.observedMetrics.items():
                got = row.asDict()
                if set(FIGURES) <= set(got):
                    self._batches[(name, query, batch)] = {f: got[f] for f in FIGURES}
            # a batch without data may follow under the same id: rows it drops add to the figure
            late = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            self._late[(query, batch)] = max(late, self._late.get((query, batch), 0))

    def totals(self, name: str) -> dict[str, int]:
        """The figures of ``name`` over all micro-batches, and ``late`` rows."""
        with self._lock:
            mine = {k: v for k, v in self._batches.items() if k[0] == name}
            out = {f: sum(v[f] for v in mine.values()) for f in FIGURES}
            queries = {k[1] for k in mine}
            out["late"] = sum(n for (q, _), n in self._late.items() if q in queries)
            return out


def balanced(figures: dict[str, int]) -> bool:
    """Every line is accounted for."""
    return figures["lines"] == sum(figures[f] for f in FIGURES[1:])
