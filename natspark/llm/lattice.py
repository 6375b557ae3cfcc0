"""Language-model scores from a subword lattice.

An existing piece vocabulary spans a lattice over every word (a space mark,
then the word's bytes): an edge for each piece that matches there, one for
each single byte, and one across the whole word if training has seen it.  A
text's probability is the sum over all its segmentations of the product of
the edge weights, computed in log space by a forward recursion.  No edge
crosses a word's begin, so the recursion over the text is the product over its
words, times the end token.

Weights come from all training texts.  The edge of a known word has its
absolutely discounted relative frequency; the discounted mass goes to the
pieces, whose unigram probabilities are learned by EM over the distinct words.
With these weights the score is a proper probability.  The edges of all words
are written once, in the order of the recursion; the table stays distributed,
and a vector with a cell per piece comes to the driver each round.  The same
table gives the counts of the add-0.1 word unigram beside the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from natspark.llm.common import (free_name, gather_spans, materialize, span_hashes, text_chunks,
                                 word_bounds)

SPACE = 0x20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class PieceLattice:
    """Pieces as byte strings (a leading space for the mark): 256 bytes first,
    then the pieces of two and more bytes, then the end token.  ``keys`` are
    the sorted hashes of the longer pieces and ``piece`` their numbers."""

    keys: np.ndarray
    piece: np.ndarray
    lengths: tuple[int, ...]
    size: int

    @property
    def end(self) -> int:
        return self.size - 1


def lattice_of(pieces: list[bytes]) -> PieceLattice:
    """From the distinct contents of a vocabulary's pieces; a space may only
    lead (other pieces could cross a word's begin and are left out)."""
    longer = sorted({p for p in pieces if len(p) > 1 and b" " not in p[1:]
                     and not any(b in p for b in b"\t\n\x0b\x0c\r") and p.lower() == p})
    data = np.frombuffer(b"".join(longer), np.uint8)
    size = np.fromiter(map(len, longer), np.int64, len(longer))
    end = np.cumsum(size)
    h = span_hashes(data, end - size, end)
    order = np.argsort(h)
    return PieceLattice(h[order], 256 + order, tuple(int(x) for x in np.unique(size)), 256 + len(longer) + 1)


def vocabulary_pieces(model: bytes) -> list[bytes]:
    """The piece contents of a sentencepiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    return [sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]


# In training, words of at most so many bytes (with the space) are summed as plain
# products: even of the least weights they stay in the range of a double.
SHORT = 30


class Edges:
    """The edges of a batch of words, in the order of the forward recursion.

    Word w has nodes first[w] .. first[w] + its bytes; edge e ends at node
    ``dst`` after ``size`` bytes of ``piece``.  Edges lie by the depth of their
    end, then by the end; ``steps`` counts them by depth.  The arrays don't
    depend on the weights, so they are made once for all rounds."""

    def __init__(self, dst: np.ndarray, size: np.ndarray, piece: np.ndarray, first: np.ndarray, steps: np.ndarray):
        self.dst, self.size, self.piece, self.first, self.steps = dst, size, piece, first, steps
        self.src = dst - size
        self.bounds = np.concatenate([[0], np.cumsum(steps)])

    @classmethod
    def of(cls, lattice: PieceLattice, data: np.ndarray, offs: np.ndarray) -> Edges:
        """``data[offs[w]:offs[w + 1]]`` are the bytes of word w."""
        n = np.diff(offs)
        word = np.repeat(np.arange(len(n)), n)
        left = offs[1:][word] - np.arange(len(data))       # bytes to the word's end
        ends, sizes, pieces = [np.arange(len(data)) + word + 1], [np.ones(len(data), np.int64)], [data.astype(np.int64)]
        for size in lattice.lengths:
            at = np.flatnonzero(left >= size)
            if not len(at):
                break
            h = span_hashes(data, at, at + size)
            hit = np.searchsorted(lattice.keys, h)
            hit[hit == len(lattice.keys)] = 0
            ok = lattice.keys[hit] == h
            at, hit = at[ok], hit[ok]
            ends.append(at + word[at] + size)
            sizes.append(np.full(len(at), size))
            pieces.append(lattice.piece[hit])
        dst, size, piece = (np.concatenate(x) for x in (ends, sizes, pieces))
        first = offs[:-1] + np.arange(len(n))
        nodes = len(data) + len(n)
        depth = (np.arange(nodes) - np.repeat(first, n + 1))[dst]
        order = np.argsort(depth * nodes + dst)
        return cls(dst[order], size[order], piece[order], np.append(first, nodes), np.bincount(depth)[1:])

    def last(self) -> np.ndarray:
        """The end node of each word."""
        return self.first[1:] - 1

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Sum over all paths from a word's first node to each node; ``weight``
        is of each edge."""
        alpha = np.zeros(int(self.first[-1]))
        alpha[self.first[:-1]] = 1.0
        for a, b in zip(self.bounds, self.bounds[1:]):
            at = self.dst[a:b]
            runs = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            alpha[at[runs]] = np.add.reduceat(alpha[self.src[a:b]] * weight[a:b], runs)
        return alpha

    def log_forward(self, weight: np.ndarray) -> np.ndarray:
        """``forward`` for weights and sums in log space, for words of any length."""
        alpha = np.full(int(self.first[-1]), -np.inf)
        alpha[self.first[:-1]] = 0.0
        for a, b in zip(self.bounds, self.bounds[1:]):
            at = self.dst[a:b]
            runs = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            alpha[at[runs]] = _log_sums(alpha[self.src[a:b]] + weight[a:b], runs)
        return alpha

    def uses(self, probability: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, every word counted once: forward, then
        backward from 1 / (the word's sum), through the same edges."""
        weight = probability[self.piece]
        alpha = self.forward(weight)
        beta = np.zeros(len(alpha))
        beta[self.last()] = 1.0 / alpha[self.last()]
        post = np.empty(len(weight))
        for a, b in zip(self.bounds[-2::-1], self.bounds[:0:-1]):
            back = weight[a:b] * beta[self.dst[a:b]]
            np.add.at(beta, self.src[a:b], back)
            post[a:b] = alpha[self.src[a:b]] * back
        return np.bincount(self.piece, post, minlength=len(probability))


class WordLattice:
    """The edges of a batch of words: word w has nodes 0..len, edge e goes
    from node ``src`` to ``dst`` (numbered over all words) by ``piece``."""

    def __init__(self, lattice: PieceLattice, data: np.ndarray, offs: np.ndarray):
        n = np.diff(offs)
        word = np.repeat(np.arange(len(n)), n)
        left = offs[1:][word] - np.arange(len(data))       # bytes to the word's end
        src, dst, piece = [np.arange(len(data)) + word], [np.arange(len(data)) + word + 1], [data.astype(np.int64)]
        for size in lattice.lengths:
            at = np.flatnonzero(left >= size)
            if not len(at):
                break
            h = span_hashes(data, at, at + size)
            hit = np.searchsorted(lattice.keys, h)
            hit[hit == len(lattice.keys)] = 0
            ok = lattice.keys[hit] == h
            at, hit = at[ok], hit[ok]
            src.append(at + word[at])
            dst.append(at + word[at] + size)
            piece.append(lattice.piece[hit])
        self.src, self.dst, self.piece = (np.concatenate(x) for x in (src, dst, piece))
        self.first = offs[:-1] + np.arange(len(n))         # node 0 of each word
        self.last = offs[1:] + np.arange(len(n))
        self.nodes = len(data) + len(n)
        depth = np.arange(self.nodes) - np.repeat(self.first, n + 1)
        self.by_dst = self._grouped(self.dst, depth)
        self.depth = depth

    @staticmethod
    def _grouped(node: np.ndarray, depth: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Edges in steps of equal depth of ``node``: (edges, begin of each
        node's run, node of each run)."""
        order = np.lexsort((node, depth[node]))
        d = depth[node[order]]
        steps = []
        for part in np.split(order, np.flatnonzero(np.diff(d)) + 1):
            at = node[part]
            runs = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            steps.append((part, runs, at[runs]))
        return steps

    def forward(self, logp: np.ndarray) -> np.ndarray:
        """log sum over all paths from a word's first node to each node."""
        alpha = np.full(self.nodes, -np.inf)
        alpha[self.first] = 0.0
        for edges, runs, node in self.by_dst:
            alpha[node] = _log_sums(alpha[self.src[edges]] + logp[self.piece[edges]], runs)
        return alpha

    def backward(self, logp: np.ndarray) -> np.ndarray:
        beta = np.full(self.nodes, -np.inf)
        beta[self.last] = 0.0
        for edges, runs, node in reversed(self._grouped(self.src, self.depth)):
            beta[node] = _log_sums(beta[self.dst[edges]] + logp[self.piece[edges]], runs)
        return beta


def _log_sums(x: np.ndarray, runs: np.ndarray) -> np.ndarray:
    top = np.maximum.reduceat(x, runs)
    size = np.diff(np.append(runs, len(x)))
    return top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, size)), runs))


def _word_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the words, each led by a space, and their offsets."""
    joined = [b" " + w for w in words.cast(pa.large_binary()).to_pylist()]
    size = np.fromiter(map(len, joined), np.int64, len(joined))
    return np.frombuffer(b"".join(joined), np.uint8), np.concatenate([[0], np.cumsum(size)])


def _slices(offs: np.ndarray, limit: int = 1 << 17) -> Iterator[tuple[int, int]]:
    i, n = 0, len(offs) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1))
        yield i, j
        i = j


# -------------------------------------------------------------------- training

def word_counts(texts: DataFrame, text_col: str) -> DataFrame:
    """(word, n): occurrences of each lower-cased (A-Z) word; counts are added
    up in each chunk before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, offs in text_chunks(b.column(0), 3 << 20):
                data = _LOWER[data]
                start, end, _ = word_bounds(data, offs)
                h = span_hashes(data, start, end)
                _, at, n = np.unique(h, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([_strings(data, start[at], end[at]), pa.array(n, pa.int64())],
                                                 ["word", "n"])

    return (texts.select(text_col).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    size = end - start
    offs = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offs), pa.py_buffer(data[gather_spans(start, size)]))


BLOCK = "words binary, n binary, edges binary"


def _packed(*arrays: np.ndarray) -> bytes:
    """Integer arrays as compressed bytes: differences, since most are small."""
    import zstandard

    head = np.array([len(arrays), *map(len, arrays)], np.int64)
    body = [np.diff(x, prepend=0).astype(np.int32).tobytes() for x in arrays]
    return zstandard.ZstdCompressor(level=1).compress(head.tobytes() + b"".join(body))


def _unpacked(raw: bytes) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(raw)
    k = int(np.frombuffer(data, np.int64, 1)[0])
    sizes = np.frombuffer(data, np.int64, k, 8)
    flat = np.frombuffer(data, np.int32, -1, 8 * (k + 1))
    return [np.cumsum(x, dtype=np.int64) for x in np.split(flat, np.cumsum(sizes)[:-1])]


def edge_blocks(counts: DataFrame, lattice: PieceLattice) -> DataFrame:
    """A ``BLOCK`` for every hundred kilobytes or so of words: the words, their
    counts and their ``Edges``, as bytes that Spark only carries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, n = b.column(0).to_pylist(), b.column(1).to_numpy()
            data, offs = _word_bytes(b.column(0))
            for i, j in _slices(offs):
                e = Edges.of(lattice, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                row = ["\n".join(words[i:j]).encode(), n[i:j].astype("<i8").tobytes(),
                       _packed(e.dst, e.size, e.piece, e.first, e.steps)]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in row], ["words", "n", "edges"])

    return counts.select("word", "n").mapInArrow(run, BLOCK)


def fit(counts: DataFrame, lattice: PieceLattice, rounds: int = 11, prior: float = 0.02) -> np.ndarray:
    """The weights of ``fit_words`` alone."""
    return fit_words(counts, lattice, rounds, prior)[0]


def fit_words(counts: DataFrame, lattice: PieceLattice, rounds: int = 11, prior: float = 0.02
              ) -> tuple[np.ndarray, DataFrame]:
    """Log probabilities of the pieces by EM over the distinct words, each
    counted once (what the pieces must explain is words not seen before).

    Starts from equal probabilities.  Every one of the ``rounds`` rounds adds
    up the expected uses of each piece over all words, plus ``prior``.  The
    edges of the words are written once; a round reads them and runs forward
    and backward only.  The few words over ``SHORT`` bytes go through their
    lattices in log space each round.  Also returns the words with their counts
    and their log probability (word, n, lat in log10) under the last weights.
    """
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    short = F.octet_length("word") < SHORT
    words = counts.select("word", "n")
    blocks = materialize(edge_blocks(words.where(short).repartition(tasks, "word"), lattice), "lm-edges")
    long = materialize(words.where(~short), "lm-long")
    logp = np.full(lattice.size, -np.log(lattice.size))
    for _ in range(rounds):
        total = np.full(lattice.size, prior)
        uses = _expected_short(blocks, lattice.size, np.exp(logp)).unionByName(_expected(long, lattice, logp))
        for r in uses.groupBy("piece").agg(F.sum("n").alias("n")).collect():
            total[r["piece"]] += r["n"]
        logp = np.log(total / total.sum())

    def blocks_scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words, n, edges in zip(*(b.column(c).to_pylist() for c in range(3))):
                e = Edges(*_unpacked(edges))
                yield _scored(pa.array(words.decode().split("\n")), np.frombuffer(n, "<i8"),
                              e.log_forward(logp[e.piece])[e.last()])

    def words_scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _scored(b.column(0), b.column(1).to_numpy(), word_scores(lattice, logp, *_word_bytes(b.column(0))))

    scored = blocks.mapInArrow(blocks_scored, WORD_SCHEMA).unionByName(long.mapInArrow(words_scored, WORD_SCHEMA))
    return logp, materialize(scored, "lm-scored")


WORD_SCHEMA = "word string, n long, lat double"


def _scored(words: pa.Array, n: np.ndarray, log_scores: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(n, pa.int64()),
                                       pa.array(log_scores / np.log(10))], ["word", "n", "lat"])


def _uses_of(total: np.ndarray) -> pa.RecordBatch:
    used = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["piece", "n"])


def _expected_short(blocks: DataFrame, size: int, probability: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for b in batches:
            for raw in b.column(0).to_pylist():
                total += Edges(*_unpacked(raw)).uses(probability)
        yield _uses_of(total)

    return blocks.select("edges").mapInArrow(run, "piece long, n double")


def _expected(words: DataFrame, lattice: PieceLattice, logp: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(lattice.size)
        for b in batches:
            data, offs = _word_bytes(b.column(0))
            for i, j in _slices(offs):
                w = WordLattice(lattice, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
                alpha, beta = w.forward(logp), w.backward(logp)
                of = np.searchsorted(w.first, w.src, "right") - 1
                post = np.exp(alpha[w.src] + logp[w.piece] + beta[w.dst] - alpha[w.last][of])
                total += np.bincount(w.piece, post, minlength=lattice.size)
        yield _uses_of(total)

    return words.select("word").mapInArrow(run, "piece long, n double")


def word_scores(lattice: PieceLattice, logp: np.ndarray, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Log sum over all segmentations of each word, in log space."""
    out = np.empty(len(offs) - 1)
    for i, j in _slices(offs):
        e = Edges.of(lattice, data[offs[i]:offs[j]], offs[i:j + 1] - offs[i])
        out[i:j] = e.log_forward(logp[e.piece])[e.last()]
    return out


# --------------------------------------------------------------------- scoring

class WordTable:
    """Counts and lattice scores of frequent words, by sorted hash."""

    def __init__(self, head):
        raw = [w.encode() for w in head["word"]]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        end = np.cumsum(size)
        h = span_hashes(np.frombuffer(b"".join(raw), np.uint8), end - size, end)
        order = np.argsort(h)
        self.keys = h[order]
        self.n, self.lat = head["n"].to_numpy(np.int64)[order], head["lat"].to_numpy(float)[order]

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, score) of each word; count -1 for words not in the table."""
        if not len(self.keys):
            return np.full(len(h), -1), np.zeros(len(h))
        at = np.searchsorted(self.keys, h)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == h
        return np.where(hit, self.n[at], -1), np.where(hit, self.lat[at], 0.0)


def score(docs: DataFrame, learn, model: bytes, text_col: str = "text", smoothing: float = 0.1,
          head_words: int = 200_000) -> DataFrame:
    """Score every row of ``docs``, learning from those where the condition
    ``learn`` holds.

    Adds ``n_tokens`` (words and the end), ``n_known`` (tokens that occur in
    training), ``train_tokens``, ``base_score`` (log10, add-``smoothing`` word
    unigram over all training words and the end), ``lattice_score`` (log10 of
    the probability from pieces alone, with the end at its share of the
    training tokens) and ``score`` (log10 of the lattice probability with the
    edges of known words); columns of these names are replaced and ``text_col``
    goes.  Other columns may have any name.

    A null or blank text is its end token alone.  Without training rows all
    pieces, the end among them, are equally likely and the base is over an
    empty table.  Equal texts get equal scores.  The counts of
    frequent training words, ``head_words`` at most, go along with the tasks
    (a bound, whatever the corpus); all other words are looked up by a join,
    so every count is exact.
    """
    added = ("n_tokens", "n_known", "train_tokens", "base_score", "lattice_score", "score")
    names = [c for c in docs.columns if c.lower() not in added and c != text_col]
    train = docs.where(learn)
    counts = materialize(word_counts(train, text_col), "lm-words")
    ends = train.count()
    n_words, distinct, once, twice = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.count_if(F.col("n") == 1),
        F.count_if(F.col("n") == 2)).first()
    total, kinds = n_words + ends, distinct + (1 if ends else 0)
    base = float(np.log10(total + smoothing * (kinds + 1)))
    lattice = lattice_of(vocabulary_pieces(model))
    logp, scored = fit_words(counts, lattice)
    # Absolute discounting; the discount is the usual estimate from the
    # numbers of words seen once and twice.
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once else 0.1
    to_pieces = discount * kinds / total if total else 1.0
    head = WordTable(_frequent(scored, head_words).toPandas())
    if ends:
        end_score = float(np.log10((ends - discount) / total))
    else:
        end_score = float(logp[lattice.end] / np.log(10))
    end_base = float(np.log10(ends + smoothing) - base)
    # pieces alone: an end with its share of the training tokens, else a word
    end_share = ends / total if ends else float(np.exp(logp[lattice.end]))
    end_only = float(np.log10(end_share))
    word_only = float(np.log10(1 - end_share)) if end_share < 1 else 0.0

    # what joins and lists need has names that no column of docs has
    made = {k: free_name(docs, f"_{k}") for k in ("row", "in", "learn", "tokens", "known", "base", "score", "lattice", "tail",
                                                  "tail_base", "tail_score", "tail_lattice", "tail_known")}
    uid, tail_col = made["row"], made["tail"]
    src = docs.select(*[F.col(f"`{c}`") for c in names], F.coalesce(learn, F.lit(False)).alias(made["learn"]),
                      F.col(f"`{text_col}`").alias(made["in"]))
    kept = len(names) + 1
    tail_type = T.ArrayType(T.StructType([T.StructField("word", T.StringType()), T.StructField("tf", T.LongType())]))
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(made["learn"], T.BooleanType())]
                          + [T.StructField(made["tokens"], T.LongType()), T.StructField(made["known"], T.LongType()),
                             T.StructField(made["base"], T.DoubleType()), T.StructField(made["score"], T.DoubleType()),
                             T.StructField(made["lattice"], T.DoubleType()), T.StructField(tail_col, tail_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in text_chunks(b.column(kept)):
                data = _LOWER[data]
                start, end, doc = word_bounds(data, offs)
                h, at, inv = np.unique(span_hashes(data, start, end), return_index=True, return_inverse=True)
                c, lat = head.find(h)
                in_head = c >= 0
                pure = np.where(in_head, lat + word_only, 0.0)
                b10 = np.where(in_head, np.log10(np.maximum(c, 0) + smoothing) - base, 0.0)
                s10 = np.zeros(len(h))
                s10[in_head] = np.log10((c[in_head] - discount) / max(total, 1) + to_pieces * 10.0 ** lat[in_head])
                rows = j - i
                known = np.bincount(doc, in_head[inv], minlength=rows).astype(np.int64) + (1 if ends else 0)
                tail = np.flatnonzero(~in_head[inv])
                pair, tf = np.unique(doc[tail] * max(len(h), 1) + inv[tail], return_counts=True)
                owner, word = pair // max(len(h), 1), pair % max(len(h), 1)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(owner, np.arange(rows + 1)), pa.int32()),
                    pa.StructArray.from_arrays([_strings(data, start[at[word]], end[at[word]]),
                                                pa.array(tf, pa.int64())], ["word", "tf"]))
                cols = [b.column(k).slice(i, rows) for k in range(kept)]
                cols += [pa.array(np.bincount(doc, minlength=rows) + 1, pa.int64()), pa.array(known, pa.int64()),
                         pa.array(np.bincount(doc, b10[inv], minlength=rows) + end_base),
                         pa.array(np.bincount(doc, s10[inv], minlength=rows) + end_score),
                         pa.array(np.bincount(doc, pure[inv], minlength=rows) + end_only), lists]
                yield pa.RecordBatch.from_arrays(cols, schema.names)

    # Written once: the row numbers below stay as they are.
    first = materialize(src.mapInArrow(run, schema).withColumn(uid, F.monotonically_increasing_id()), "lm-first")
    n, lat = F.col("n"), F.col("lat")
    seen = F.log10((n - F.lit(discount)) / F.lit(float(max(total, 1))) + F.lit(to_pieces) * F.pow(F.lit(10.0), lat))
    one = F.explode(F.col(f"`{tail_col}`"))
    # only rows outside training can hold words that have no score yet
    others = first.where(~F.col(f"`{made['learn']}`")).select(one.alias("t")).select("t.word").distinct()
    unseen = others.join(scored.select("word"), "word", "left_anti").withColumn("n", F.lit(None).cast("long"))

    def new_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = word_scores(lattice, logp, *_word_bytes(b.column(0))) / np.log(10)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(got)], ["word", "n", "lat"])

    table = scored.unionByName(materialize(unseen.mapInArrow(new_words, WORD_SCHEMA), "lm-unseen"))
    found = (first.select(F.col(f"`{uid}`").alias("id"), one.alias("t")).select("id", "t.word", "t.tf")
             .join(table, "word").groupBy(F.col("id").alias(uid)).agg(
        F.sum(F.col("tf") * (F.log10(F.coalesce(n, F.lit(0)) + F.lit(smoothing)) - F.lit(base))).alias(made["tail_base"]),
        F.sum(F.col("tf") * F.when(n.isNull(), lat + F.lit(float(np.log10(to_pieces)))).otherwise(seen)
              ).alias(made["tail_score"]),
        F.sum(F.col("tf") * (lat + F.lit(word_only))).alias(made["tail_lattice"]),
        F.sum(F.when(n.isNotNull(), F.col("tf")).otherwise(0)).alias(made["tail_known"])))

    def col(k: str) -> Column:
        return F.col(f"`{made[k]}`")

    return first.join(found, uid, "left").select(
        *[F.col(f"`{c}`") for c in names], col("tokens").alias("n_tokens"),
        (col("known") + F.coalesce(col("tail_known"), F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (col("base") + F.coalesce(col("tail_base"), F.lit(0.0))).alias("base_score"),
        (col("lattice") + F.coalesce(col("tail_lattice"), F.lit(0.0))).alias("lattice_score"),
        (col("score") + F.coalesce(col("tail_score"), F.lit(0.0))).alias("score"))


def _frequent(counts: DataFrame, limit: int) -> DataFrame:
    """The words that occur at least 2**b times, for the smallest b that
    leaves at most ``limit`` of them."""
    power = F.floor(F.log2("n")).cast("int")
    sizes = sorted(((r["b"], r["k"]) for r in counts.groupBy(power.alias("b")).agg(F.count("*").alias("k")).collect()),
                   reverse=True)
    least, held = 62, 0
    for b, k in sizes:
        if held + k > limit:
            break
        least, held = b, held + k
    return counts.where(F.col("n") >= F.lit(1 << least))
