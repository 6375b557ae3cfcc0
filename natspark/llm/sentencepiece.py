"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text becomes words (runs of the space mark and what follows, up to the next
space): no piece of the vocabulary crosses such a border, so words merge on
their own.  All new distinct words of a chunk merge together: flat arrays of
symbols, the smallest pair rank of each word found by a segmented minimum,
its leftmost pairs merged in all words at once, the arrays compacted, until no
word has a pair left.  A word longer than ``LONG_WORD`` (text without spaces)
would hold all others back with a round per merge, so it takes the same merges
in the same order from a heap.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from natspark.llm.common import free_name, gather_spans, text_chunks

MARK = "▁"
_NONE = np.iinfo(np.int32).max
_LONG_RUN = 64
LONG_WORD = 512
# Texts on which other kinds of models, normalizers or prefixes show.
_PROBES = ("", " ", "  a  b ", "The quick brown fox jumps over the lazy dog's 1234567 friends.", "a\tb\nc\r\n d",
           "ＡＢ ﬁ ² Å é e\u0301 \u00a0x", "naïve Straße привет 日本語 😀 \u200b", "unbelievably internationalization")


class Vocabulary:
    """Tables derived from a BPE model with byte fallback and an identity
    normalizer; ``model`` is the content of the model file."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.bos, self.eos, self.unk = sp.bos_id(), sp.eos_id(), sp.unk_id()
        normal: dict[str, int] = {}
        self.byte_ids = np.full(256, self.unk, np.int32)
        content: list[bytes] = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                content.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i):
                content.append(b"")
            elif sp.is_unknown(i):
                content.append(" ⁇ ".encode())
            else:
                normal[piece] = i
                content.append(piece.replace(MARK, " ").encode())
        if any(MARK in p.lstrip(MARK) for p in normal):
            raise ValueError("a piece crosses a word border; words can't merge on their own")
        # decoding: piece contents end to end
        self.content = np.frombuffer(b"".join(content), np.uint8)
        self.content_len = np.fromiter(map(len, content), np.int64, n)
        self.content_at = np.cumsum(self.content_len) - self.content_len
        # Symbols: ids of pieces, then single characters that only occur inside pieces.
        symbols = dict(normal)
        for c in dict.fromkeys("".join(normal)):
            symbols.setdefault(c, n + len(symbols) - len(normal))
        self.pieces = n
        self.chars = {c: i for c, i in symbols.items() if len(c) == 1}
        scores = np.array([sp.get_score(i) for i in range(n)])
        ids = np.fromiter(normal.values(), np.int64, len(normal))
        # equal scores share a rank: the leftmost pair then comes first
        rank = dict(zip(ids.tolist(), np.unique(-scores[ids], return_inverse=True)[1].tolist()))
        keys, ranks, merged = [], [], []
        best_using: dict[int, int] = {}
        for piece, i in normal.items():
            for cut in range(1, len(piece)):
                left, right = symbols.get(piece[:cut]), symbols.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(rank[i])
                    merged.append(i)
                    for part in (left, right):
                        best_using[part] = min(best_using.get(part, _NONE), rank[i])
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int32)[order]
        self.merged = np.array(merged, np.int32)[order]
        self._pairs: dict[int, tuple[int, int]] | None = None       # made for the first long word
        # Merging a pair everywhere at once equals one at a time if no pair
        # that its piece can enter comes before (or ties with) the pair itself.
        self.at_once = np.zeros(n + 1, bool)
        for i, r in rank.items():
            self.at_once[i] = best_using.get(i, _NONE) > r
        # A character outside all longer pieces ends a word; newline does in common models.
        inside = set("".join(p for p in normal if len(p) > 1))
        self.splits_newline = "\n" not in inside
        self.splitter = re.compile(f"\n|{MARK}+[^{MARK}\n]*|[^{MARK}\n]+" if self.splits_newline
                                   else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        # A long run of spaces merges from the left into the longest run
        # piece; checked here, since the shortcut for long runs relies on it.
        self.run_len = max((k for k in range(2, 65) if MARK * k in normal), default=0)
        self.run_id = normal.get(MARK * self.run_len)
        if self.run_id is not None:
            ids, _ = self.merge_words([MARK * (4 * self.run_len + k) for k in range(self.run_len)])
            tails, _ = self.merge_words([MARK * (self.run_len + k) for k in range(self.run_len)])
            if np.count_nonzero(ids == self.run_id) != 3 * self.run_len + np.count_nonzero(tails == self.run_id):
                self.run_id = None

    # ------------------------------------------------------------- merging

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        found = (self.keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], _NONE), np.where(found, self.merged[at], -1)

    def _merge_long(self, sym: np.ndarray) -> np.ndarray:
        """The symbols of one word, all merges done: smallest rank first, the
        leftmost among equals, from a heap of (rank, place)."""
        if self._pairs is None:
            self._pairs = dict(zip(self.keys.tolist(), zip(self.ranks.tolist(), self.merged.tolist())))
        pairs, none = self._pairs, (_NONE, -1)
        n = len(sym)
        r, m = self._lookup(sym[:-1], sym[1:])
        heap = ((r.astype(np.int64) << 32) | np.arange(n - 1))[r != _NONE].tolist()
        heapq.heapify(heap)
        rank, into, s = [*r.tolist(), _NONE], [*m.tolist(), -1], sym.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while heap:
            key = heapq.heappop(heap)
            p = key & 0xFFFFFFFF
            if rank[p] != key >> 32:                    # the pair has changed since
                continue
            gone = after[p]
            s[p], end = into[p], after[gone]
            rank[gone], s[gone] = _NONE, None
            after[p] = end
            rank[p], into[p] = pairs.get(s[p] << 32 | s[end], none) if end < n else none
            if end < n:
                before[end] = p
            if rank[p] != _NONE:
                heapq.heappush(heap, rank[p] << 32 | p)
            left = before[p]
            if left >= 0:
                rank[left], into[left] = pairs.get(s[left] << 32 | s[p], none)
                if rank[left] != _NONE:
                    heapq.heappush(heap, rank[left] << 32 | left)
        return np.array([x for x in s if x is not None], np.int64)

    def merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of the words, end to end, and how many each has."""
        text = "".join(words)
        length = np.fromiter(map(len, words), np.int64, len(words))
        cps = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        uniq, inv = np.unique(cps, return_inverse=True)
        char_id = np.array([self.chars.get(chr(c), -1 - int(c)) for c in uniq], np.int64)
        sym = char_id[inv] if len(uniq) else np.empty(0, np.int64)
        word = np.repeat(np.arange(len(words)), length)
        done_sym, done_word = [], []
        long = np.flatnonzero(length > LONG_WORD)
        if len(long):
            end = np.cumsum(length)
            for w in long.tolist():
                done_sym.append(self._merge_long(sym[end[w] - length[w]:end[w]]))
                done_word.append(np.full(len(done_sym[-1]), w))
            short = (length <= LONG_WORD)[word]
            sym, word = sym[short], word[short]
        rank = np.full(len(sym), _NONE, np.int32)      # of the pair that begins here
        into = np.full(len(sym), -1, np.int32)
        same = word[:-1] == word[1:]
        r, m = self._lookup(sym[:-1], sym[1:])
        rank[:-1] = np.where(same, r, _NONE)
        into[:-1] = m
        while len(sym):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            idle = np.repeat(low == _NONE, size)
            if idle.any():                              # finished words leave
                done_sym.append(sym[idle])
                done_word.append(word[idle])
                sym, word, rank, into = (x[~idle] for x in (sym, word, rank, into))
                if not len(sym):
                    break
                size, low = size[low != _NONE], low[low != _NONE]
                first = np.cumsum(size) - size
            hit = rank == np.repeat(low, size)
            at = np.flatnonzero(hit)
            # the leftmost pair of each word, and the others where that is safe
            lead = np.concatenate([[True], word[at][1:] != word[at][:-1]])
            safe = self.at_once[into[at]]
            at = at[lead | (safe & (into[at] == into[at][np.maximum.accumulate(
                np.where(lead, np.arange(len(at)), 0))]))]
            # in a run of overlapping pairs (a a a) every second one merges
            if len(at) > 1:
                new_run = np.concatenate([[True], np.diff(at) > 1])
                start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - start) % 2 == 0]
            sym[at] = into[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            new_at = at - np.arange(len(at))            # where a merged symbol lands
            sym, word, rank, into = (x[keep] for x in (sym, word, rank, into))
            # pairs that touch a merged symbol are looked up again
            near = np.zeros(len(sym), bool)
            near[new_at] = True
            near[new_at[new_at > 0] - 1] = True
            touch = np.flatnonzero(near)
            has_next = touch + 1 < len(sym)
            inner = touch[has_next]
            inner = inner[word[inner] == word[inner + 1]]
            rank[touch] = _NONE
            r, m = self._lookup(sym[inner], sym[inner + 1])
            rank[inner], into[inner] = r, m
        sym = np.concatenate(done_sym) if done_sym else sym
        word = np.concatenate(done_word) if done_word else word
        order = np.argsort(word, kind="stable")
        sym, word = sym[order], word[order]
        # Characters without a piece: their UTF-8 bytes.
        lone = (sym < 0) | (sym >= self.pieces)
        if lone.any():
            name = {i: c for c, i in self.chars.items() if i >= self.pieces}
            kinds, which = np.unique(sym[lone], return_inverse=True)
            raw = [self.byte_ids[np.frombuffer((chr(-1 - int(k)) if k < 0 else name[int(k)]).encode(), np.uint8)]
                   for k in kinds]
            width = np.fromiter(map(len, raw), np.int64, len(raw))
            size = np.ones(len(sym), np.int64)
            size[lone] = width[which]
            is_byte = np.repeat(lone, size)
            out = np.empty(len(is_byte), np.int64)
            out[~is_byte] = sym[~lone]
            out[is_byte] = np.concatenate(raw)[gather_spans((np.cumsum(width) - width)[which], width[which])]
            sym, word = out, np.repeat(word, size)
        return sym.astype(np.int32), np.bincount(word, minlength=len(words))


class Encoder:
    """Encodes and decodes texts; merged words are kept up to a bound."""

    def __init__(self, vocabulary: Vocabulary, max_words: int = 300_000):
        self.v, self.max_words = vocabulary, max_words
        self._clear()

    def _clear(self) -> None:
        self.row: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.at = np.empty(0, np.int64)
        self.len = np.empty(0, np.int64)

    def words(self, text: str) -> list[str]:
        if not text:
            return []
        words = self.v.splitter.findall(MARK + text.replace(" ", MARK))
        if self.v.run_id is not None and MARK * _LONG_RUN in text.replace(" ", MARK):
            words = [p for w in words for p in self._cut_run(w)]
        return words

    def _cut_run(self, word: str) -> list[str]:
        """Long runs of spaces merge from the left into the longest run
        piece; all but the last few of these are cut off as words."""
        run = len(word) - len(word.lstrip(MARK))
        n = self.v.run_len
        whole = (run - 2 * n) // n
        if run < _LONG_RUN or whole < 1:
            return [word]
        return [MARK * n] * whole + [word[whole * n:]]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts (with begin and end ids), end to end, and how
        many each has."""
        if len(self.row) > self.max_words:
            self._clear()
        found = [self.words(t) for t in texts]
        n_words = np.fromiter(map(len, found), np.int64, len(found))
        words = [w for ws in found for w in ws]
        row = self.row
        new = [w for w in dict.fromkeys(words) if w not in row]
        if new:
            row.update(zip(new, range(len(row), len(row) + len(new))))
            ids, n = self.v.merge_words(new)
            self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(n) - n])
            self.ids = np.concatenate([self.ids, ids])
            self.len = np.concatenate([self.len, n])
        rows = np.fromiter(map(row.__getitem__, words), np.int64, len(words))
        n_ids = self.len[rows]
        text = np.repeat(np.arange(len(texts)), n_words)
        per_text = np.bincount(text, n_ids, minlength=len(texts)).astype(np.int64)
        flat = self.ids[gather_spans(self.at[rows], n_ids)]
        total = per_text + 2
        out = np.empty(int(total.sum()), np.int32)
        end = np.cumsum(total)
        out[end - total] = self.v.bos
        out[end - 1] = self.v.eos
        inner = np.ones(len(out), bool)
        inner[end - total] = inner[end - 1] = False
        out[inner] = flat
        return out, total

    def decode(self, ids: np.ndarray, n: np.ndarray) -> list[bytes]:
        """UTF-8 texts of id sequences given end to end.  The mark of the
        begin of the text goes; control ids have no text; ids outside the
        vocabulary raise IndexError."""
        v = self.v
        if len(ids) and (ids.min() < 0 or ids.max() >= v.pieces):
            raise IndexError("an id is outside the vocabulary")
        size = v.content_len[ids]
        data = v.content[gather_spans(v.content_at[ids], size)].tobytes()
        out, at = [], 0
        spans = np.add.reduceat(np.append(size, 0), np.minimum(np.cumsum(n) - n, len(size))) if len(n) else []
        for k, length in zip(spans, n):
            raw = data[at:at + int(k)] if length else b""
            at += len(raw)
            out.append(raw[1:] if raw.startswith(b" ") else raw)
        return out


def check_model(model: bytes) -> None:
    """Raise ValueError unless the library encodes and decodes some telling
    texts as this module does: a model of another kind, with another
    normalizer or without the mark before the first word doesn't fit."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    enc = Encoder(Vocabulary(model))
    ids, n = enc.encode(list(_PROBES))
    for text, end, k, back in zip(_PROBES, np.cumsum(n), n, enc.decode(ids, n)):
        want = sp.encode(text, add_bos=True, add_eos=True)
        if ids[end - k:end].tolist() != want or back.decode("utf-8", "replace") != sp.decode(want):
            raise ValueError("the model is not a BPE model with byte fallback and an identity normalizer")


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model: bytes, text_col: str = "text",
           outputs: tuple[str, ...] = ("ids", "n_tokens"), chunk_bytes: int = 1 << 20) -> DataFrame:
    """Add to ``docs`` any of ``ids`` (array<int>, with begin and end ids),
    ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit
    integers), ``decoded`` and ``decoded_sha256`` (of the ids decoded again).

    Columns of ``docs`` with these names are replaced; others may have any
    name.  A null text is an empty one: begin and end id only, decoding to "".
    Equal texts get equal ids.  ``model`` is a model file's content, sent along
    with the tasks; a model of another kind raises ValueError.
    """
    check_model(model)
    kinds = {"ids": T.ArrayType(T.IntegerType()), "n_tokens": T.LongType(), "ids_sha256": T.StringType(),
             "decoded": T.StringType(), "decoded_sha256": T.StringType()}
    names = [c for c in docs.columns if c.lower() not in outputs]
    src = docs.select(*[F.col(f"`{c}`") for c in names], F.col(text_col).alias(free_name(docs, "_in")))
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(o, kinds[o]) for o in outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(Vocabulary(model))
        for b in batches:
            for i, j, data, offs in text_chunks(b.column(len(names)), chunk_bytes):
                raw = data.tobytes()
                texts = [raw[s:e].decode() for s, e in zip(offs[:-1], offs[1:])]
                ids, n = enc.encode(texts)
                end = np.cumsum(n)
                made: dict[str, pa.Array] = {"n_tokens": pa.array(n, pa.int64())}
                if "ids" in outputs:
                    made["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], end]), pa.int32()), pa.array(ids, pa.int32()))
                if "ids_sha256" in outputs:
                    le = ids.astype("<u4").tobytes()
                    made["ids_sha256"] = pa.array(
                        [hashlib.sha256(le[4 * (e - k):4 * e]).hexdigest() for e, k in zip(end, n)], pa.string())
                if "decoded" in outputs or "decoded_sha256" in outputs:
                    back = enc.decode(ids, n)
                    made["decoded_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string())
                    made["decoded"] = pa.array([x.decode("utf-8", "replace") for x in back]
                                               if "decoded" in outputs else [None] * len(back), pa.string())
                cols = [b.column(c).slice(i, j - i) for c in range(len(names))]
                yield pa.RecordBatch.from_arrays(cols + [made[o] for o in outputs], schema.names)

    return src.mapInArrow(run, schema)


def decode(rows: DataFrame, model: bytes, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded`` (replacing a column of this name), the text of
    ``ids_col``; a null or empty array is ""."""
    names = [c for c in rows.columns if c.lower() != "decoded"]
    src = rows.select(*[F.col(f"`{c}`") for c in names],
                      F.col(ids_col).cast("array<int>").alias(free_name(rows, "_in")))
    schema = T.StructType([rows.schema[c] for c in names] + [T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(Vocabulary(model))
        for b in batches:
            lists = [np.array(x or [], np.int64) for x in b.column(len(names)).to_pylist()]
            n = np.fromiter(map(len, lists), np.int64, len(lists))
            back = enc.decode(np.concatenate([*lists, np.empty(0, np.int64)]), n)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in range(len(names))]
                + [pa.array([x.decode("utf-8", "replace") for x in back], pa.string())], schema.names)

    return src.mapInArrow(run, schema)
