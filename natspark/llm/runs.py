"""Periodic runs of words by string synchronising sets.

A run is a stretch of consecutive words with smallest period q and at least
``min_exponent`` periods that no neighbouring word extends.  At each dyadic
scale t = 4, 8, 16, ... a synchronising set holds the positions whose window of
length-t contexts has its smallest hash at either end; contexts that begin in
highly periodic regions (period t/4 at most) don't count.  Membership depends
on the next 2t words only, so inside a run of period q the set repeats every q
positions, and it has a position in every t of them.  For t <= q < 2t two
members with equal next 2t words, one after the other, are therefore q apart:
such pairs propose (place, period).  The highly periodic regions that a scale
leaves out are the runs of smaller periods: those below 4 are found directly,
the others at the scales before.  Every proposal is compared word by word, so
hashes decide nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from natspark.llm.common import gather_spans, mix64, text_chunks, word_bounds

_FAR = np.uint64(2**64 - 1)
RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal numbers for equal words, exactly."""
    length = ends - starts
    flat = data[gather_spans(starts, length)]
    bounds = pa.py_buffer(np.concatenate([[0], np.cumsum(length)]).astype(np.int64))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(flat)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal stretch of true values."""
    edge = np.diff(np.concatenate([[0], same.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _window_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of ``size`` consecutive values from each position on; positions
    whose window leaves the array get what is left of it."""
    n = len(values)
    pad = -(-n // size) * size + size
    v = np.full(pad, _FAR, np.uint64)
    v[:n] = values
    v = v.reshape(-1, size)
    left = np.minimum.accumulate(v, axis=1).ravel()
    right = np.minimum.accumulate(v[:, ::-1], axis=1)[:, ::-1].ravel()
    at = np.arange(n)
    return np.minimum(right[at], left[at + size - 1])


class _Texts:
    """The words of several texts, end to end: code, text and place of each."""

    def __init__(self, code: np.ndarray, text: np.ndarray, n_texts: int):
        self.code, self.text = code, text
        size = np.bincount(text, minlength=n_texts)
        self.first = np.cumsum(size) - size
        self.size = size
        self.left = (self.first + size)[text] - np.arange(len(code))    # words from here on

    def keep(self, texts: np.ndarray) -> np.ndarray:
        return texts[self.text]


def find_runs(code: np.ndarray, text: np.ndarray, n_texts: int, min_exponent: int = 4
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, period) of the runs with at least ``min_exponent``
    (4 or more) periods, ordered by text, start and period.

    ``text`` is the ascending text number of every word in ``code``.
    """
    if min_exponent < 4:
        raise ValueError("the scales see runs of four periods or more")
    d = _Texts(code, text, n_texts)
    found: list[np.ndarray] = []

    def add(d: _Texts, begin: np.ndarray, end: np.ndarray, period) -> None:
        """Stretches [begin, end) of words equal to those ``period`` further."""
        period = np.broadcast_to(np.asarray(period, np.int64), begin.shape)
        long = end - begin >= 3 * period
        begin, end, period = begin[long], end[long], period[long]
        t = d.text[begin]
        found.append(np.stack([t, begin - d.first[t], end - begin + period, period]))

    # periods below 4, compared directly
    n = len(code)
    equal = {}
    for q in (1, 2, 3):
        same = np.zeros(n, bool)
        if n > q:
            same[:-q] = (code[:-q] == code[q:]) & (text[:-q] == text[q:])
        equal[q] = same
        b, e = _stretches(same)
        if q > 1:                       # a stretch of one word has period 1
            several = (e - b >= 3 * q) & ~equal[1][b]
            if q == 3:
                several = (e - b >= 9) & ~(equal[1][b] & equal[1][np.minimum(b + 1, n - 1)])
            b, e = b[several], e[several]
        add(d, b, e, q)

    # contexts of one word, two, four: the hash of a context comes from its halves
    one = mix64(code.astype(np.uint64) + np.uint64(1))

    def doubled(h: np.ndarray, t: int) -> np.ndarray:
        out = h * np.uint64(0x9E3779B97F4A7C15)
        out[:-t] += h[t:] ^ (h[t:] >> np.uint64(29))
        return mix64(out)

    h, t = one, 1
    while t < 4:
        h, t = doubled(h, t), 2 * t
    while True:
        # period t takes 4t words: shorter texts leave
        texts = d.size >= min_exponent * t
        if not texts.any():
            break
        if not texts[d.text].all():
            kept = d.keep(texts)
            h, d = h[kept], _Texts(d.code[kept], d.text[kept], n_texts)
        twice = doubled(h, t)
        _scale(d, h, twice, t, found, add)
        h, t = twice, 2 * t
    runs = np.concatenate([*found, np.empty((4, 0), np.int64)], axis=1)
    runs = runs[:, runs[2] >= min_exponent * runs[3]]
    runs = np.unique(runs[[0, 1, 3, 2]], axis=1)
    return runs[0], runs[1], runs[3], runs[2]


def _scale(d: _Texts, h: np.ndarray, twice: np.ndarray, t: int, found: list[np.ndarray], add) -> None:
    """Find the runs of periods t .. 2t-1 in ``d``."""
    n = len(h)
    order = h >> np.uint64(1)
    order[d.left < t] = _FAR
    # contexts in highly periodic regions don't count
    periodic = np.zeros(n + 1, np.int64)
    for text, start, length, period in found:
        mine = (4 * period <= t) & (length >= t) & (d.size[text] > 0)
        begin = d.first[text[mine]] + start[mine]
        np.add.at(periodic, begin, 1)
        np.add.at(periodic, begin + length[mine] - t + 1, -1)
    order[np.cumsum(periodic[:-1]) > 0] = _FAR
    end_value = np.full(n, _FAR, np.uint64)
    end_value[:-t] = order[t:]
    low = np.minimum(_window_min(order, t), end_value)
    member = np.flatnonzero((d.left >= 2 * t) & (low != _FAR) & ((low == order) | (low == end_value)))
    if len(member) < 2:
        return
    # members with equal contexts of 2t words, one after the other
    by = np.lexsort((member, twice[member], d.text[member]))
    m = member[by]
    gap = np.diff(m)
    pair = (twice[m][1:] == twice[m][:-1]) & (d.text[m][1:] == d.text[m][:-1]) & (gap >= t) & (gap < 2 * t)
    place, period = m[:-1][pair], gap[pair]
    if not len(place):
        return
    # proposals of one period that touch are one; a period on either side is compared too
    by = np.lexsort((place, period))
    place, period = place[by], period[by]
    new = np.ones(len(place), bool)
    new[1:] = (period[1:] != period[:-1]) | (place[1:] > place[:-1] + 2 * t)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(place)) - 1
    q = period[head]
    text = d.text[place[head]]
    begin = np.maximum(place[head] - q, d.first[text])
    end = np.minimum(place[last] + 2 * t + q, d.first[text] + d.size[text] - q)
    size = end - begin
    at = gather_spans(begin, size)
    which = np.repeat(np.arange(len(head)), size)
    same = d.code[at] == d.code[at + q[which]]
    # a gap between the proposals keeps their stretches apart
    spaced = np.zeros(len(at) + len(head), bool)
    spot = np.arange(len(at)) + which
    spaced[spot] = same
    b, e = _stretches(spaced)
    origin = np.zeros(len(spaced), np.int64)
    owner = np.zeros(len(spaced), np.int64)
    origin[spot], owner[spot] = at, which
    add(d, origin[b], origin[b] + (e - b), q[owner[b]])


def _collapsed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, text: np.ndarray, n_texts: int,
               drop: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    s, e, owner = starts[~drop], ends[~drop], text[~drop]
    length = e - s + 1
    flat = np.append(data, np.uint8(0x20))[gather_spans(s, length)]
    stop = np.cumsum(length)
    flat[stop - 1] = 0x20
    size = np.bincount(owner, weights=length, minlength=n_texts).astype(np.int64)
    tail = np.cumsum(size)[size > 0] - 1          # no space after a text's last word
    flat = np.delete(flat, tail)
    bounds = np.concatenate([[0], np.cumsum(np.maximum(size - 1, 0))])
    return pa.Array.from_buffers(pa.large_string(), n_texts, [None, pa.py_buffer(bounds.astype(np.int64)),
                                                              pa.py_buffer(np.ascontiguousarray(flat))])


def periodic_runs(docs: DataFrame, text_col: str = "text", min_words: int = 6, min_exponent: int = 4,
                  chunk_bytes: int = 1 << 20) -> DataFrame:
    """Add to ``docs`` ``n_words``, ``runs`` (array of (start, length, period),
    ordered by start and period, in words from 0) and ``collapsed``, the text
    without what any run repeats: words of a run after its first period go, the
    others are joined by one space.

    Words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte.  A run has at
    least ``min_exponent`` periods (4 or more) and ``min_words`` words.  A null
    or empty text has no words, no runs and collapses to "".  Every row is
    looked at for itself: repeated rows have equal results, and columns of
    ``docs`` that have these names are replaced.  Memory follows the longest
    text; time is n log n in its words.
    """
    made = {"n_words": T.LongType(), "runs": T.ArrayType(RUN), "collapsed": T.StringType()}
    names = [c for c in docs.columns if c.lower() not in made]
    src = docs.select(*[docs[f"`{c}`"] for c in names], F.col(f"`{text_col}`"))
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(k, v) for k, v in made.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in text_chunks(b.column(len(names)), chunk_bytes):
                starts, ends, text = word_bounds(data, offs)
                k = j - i
                t, start, length, period = find_runs(word_codes(data, starts, ends), text, k, min_exponent)
                enough = length >= min_words
                t, start, length, period = t[enough], start[enough], length[enough], period[enough]
                n_words = np.bincount(text, minlength=k)
                first = (np.cumsum(n_words) - n_words)[t]
                cover = np.zeros(len(starts) + 1, np.int64)
                np.add.at(cover, first + start + period, 1)
                np.add.at(cover, first + start + length, -1)
                items = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start, length, period)],
                                                   ["start", "length", "period"])
                bounds = np.concatenate([[0], np.cumsum(np.bincount(t, minlength=k))])
                out = [pa.array(n_words, pa.int64()),
                       pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items),
                       _collapsed(data, starts, ends, text, k, np.cumsum(cover[:-1]) > 0).cast(pa.string())]
                yield pa.RecordBatch.from_arrays([b.column(c).slice(i, k) for c in range(len(names))] + out,
                                                 schema.names)

    return src.mapInArrow(run, schema)
