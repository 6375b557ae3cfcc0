"""Language identification of whole, possibly mixed-language texts.

A word's script (code point ranges) narrows the languages that can have
written it; a character n-gram model scores the word under each of those; and
a Viterbi pass with a switching penalty labels the words, so that runs of
words in one language come out as spans.  The text's language is the one with
the most letters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from natspark.llm.common import span_hashes

# First and last code point of the scripts told apart.
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF), ("arabic", 0x0750, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("han", 0x20000, 0x2FA1F),
)
SCRIPT_NAMES = tuple(dict.fromkeys(s[0] for s in SCRIPTS)) + ("other",)
_LETTERS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"


def script_of(char: str) -> int:
    """Index into SCRIPT_NAMES of a letter's script."""
    cp = ord(char)
    for name, lo, hi in SCRIPTS:
        if lo <= cp <= hi:
            return SCRIPT_NAMES.index(name)
    return len(SCRIPT_NAMES) - 1


@dataclass(frozen=True)
class LanguageModel:
    """What a fit learns; its size depends on the parameters only.

    ``logp`` has a row per n-gram slot and a column per language, ``scripts``
    tells which scripts a language is written in, ``prior`` is the share of
    each language among the training words.
    """

    languages: tuple[str, ...]
    logp: np.ndarray
    scripts: np.ndarray
    prior: np.ndarray
    orders: tuple[int, ...]


# ------------------------------------------------------------- word features

def _ngram_slots(words: list[str], orders: tuple[int, ...], slots: int
                 ) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams (orders over "<word>") and the whole word:
    (slot of each, word number of each)."""
    marked = ["<" + w + ">" for w in words]
    chars = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint8)
    length = np.fromiter(map(len, marked), np.int64, len(marked))
    first = np.cumsum(length) - length
    word = np.repeat(np.arange(len(marked)), length)
    pos = np.arange(len(word))
    end = first + length
    starts, ends, of = [first], [end], [np.arange(len(marked))]
    for n in orders:
        ok = pos + n <= end[word]
        starts.append(pos[ok])
        ends.append(pos[ok] + n)
        of.append(word[ok])
    s, e, of = (np.concatenate(x) for x in (starts, ends, of))
    return (span_hashes(chars, s * 4, e * 4) % np.uint64(slots)).astype(np.int64), of


def _word_scripts(words: list[str]) -> np.ndarray:
    """The script of each word: that of its first letter."""
    cache: dict[str, int] = {}
    return np.fromiter((cache[c] if (c := w[0]) in cache else cache.setdefault(c, script_of(c))
                        for w in words), np.int64, len(words))


def words_of(text: str | None) -> list[str]:
    """The words of a text, lower-cased one by one: lower case can be longer,
    and a word's number must stay that of the word in the text."""
    if not text:
        return []
    if text.isascii():
        return _LETTERS.findall(text.lower())
    return [w.lower() for w in _LETTERS.findall(text)]


# ------------------------------------------------------------------- training

def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
        max_docs_per_language: int = 3000, seed: int = 11,
        slots: int = 1 << 17, orders: tuple[int, ...] = (1, 2, 3, 4),
        min_script_share: float = 0.01) -> LanguageModel:
    """Fit on a bounded sample: per language at most about
    ``max_docs_per_language`` whole documents of ``labelled``, those of the
    smallest text hashes.

    Rows without text or label teach nothing.  The sampled texts are counted
    on the executors; what comes to the driver is one count per language and
    slot, and per language and script.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
                           ).where("text is not null and lang is not null and lang <> ''")
    per_lang = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = tuple(sorted(per_lang))
    if not languages:
        return LanguageModel((), np.zeros((slots, 0), np.float32),
                             np.zeros((0, len(SCRIPT_NAMES)), bool), np.zeros(0), orders)
    keep = F.lit(0)
    for lang, n in per_lang.items():
        keep = F.when(F.col("lang") == lang, int(min(1.0, max_docs_per_language / n) * 2**31)
                      ).otherwise(keep)
    sample = rows.where(F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(2**31)) < keep)
    index = {lang: i for i, lang in enumerate(languages)}
    n_scripts = len(SCRIPT_NAMES)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = np.zeros((len(index), slots), np.int64)
        scripts = np.zeros((len(index), n_scripts), np.int64)
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                for i in range(0, len(words), 8192):
                    s, _ = _ngram_slots(words[i:i + 8192], orders, slots)
                    grams[index[lang]] += np.bincount(s, minlength=slots)
                if words:
                    scripts[index[lang]] += np.bincount(_word_scripts(words), minlength=n_scripts)
        for kind, counts in enumerate((grams, scripts)):
            lang, slot = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(lang), kind)), pa.array(lang), pa.array(slot),
                 pa.array(counts[lang, slot])], ["kind", "lang", "slot", "n"])

    counted = (sample.mapInArrow(count, "kind long, lang long, slot long, n long")
               .groupBy("kind", "lang", "slot").agg(F.sum("n").alias("n")).toPandas())
    grams = np.zeros((len(languages), slots))
    scripts = np.zeros((len(languages), n_scripts))
    for kind, out in ((0, grams), (1, scripts)):
        part = counted[counted.kind == kind]
        out[part.lang.to_numpy(), part.slot.to_numpy()] = part.n.to_numpy()
    total = grams.sum(1, keepdims=True)
    logp = np.log((grams + 0.5) / (total + 0.5 * slots))
    words = scripts.sum(1)
    share = scripts / np.maximum(words[:, None], 1)
    return LanguageModel(languages, np.ascontiguousarray(logp.T.astype(np.float32)),
                         share >= min_script_share, words / max(words.sum(), 1), orders)


# ----------------------------------------------------------------- prediction

class WordScorer:
    """Scores of distinct words, kept between batches up to a bound."""

    def __init__(self, model: LanguageModel, max_words: int = 200_000):
        self.model, self.max_words = model, max_words
        self._clear()

    def _clear(self) -> None:
        k = len(self.model.languages)
        self.row: dict[str, int] = {}
        self.scores = np.zeros((0, k), np.float32)
        self.known = np.zeros(0, bool)

    def rows(self, words: list[str]) -> np.ndarray:
        """Row of each word in ``scores`` and ``known``."""
        if len(self.row) > self.max_words:
            self._clear()
        row = self.row
        new = [w for w in dict.fromkeys(words) if w not in row]
        if new:
            row.update(zip(new, range(len(row), len(row) + len(new))))
            # a few thousand words at a time: each has dozens of n-grams
            parts = [self._score(new[i:i + 8192]) for i in range(0, len(new), 8192)]
            self.scores = np.concatenate([self.scores, *(p[0] for p in parts)])
            self.known = np.concatenate([self.known, *(p[1] for p in parts)])
        return np.fromiter(map(row.__getitem__, words), np.int64, len(words))

    def _score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Log scores relative to the best candidate; languages not written
        in the word's script are far below; a word in a script of no learned
        language says nothing (all 0, not known)."""
        m = self.model
        slot, of = _ngram_slots(words, m.orders, len(m.logp))
        order = np.argsort(of, kind="stable")
        first = np.searchsorted(of[order], np.arange(len(words)))
        raw = np.add.reduceat(m.logp[slot[order]], first, axis=0)
        # n-grams of several orders overlap; their evidence counts once
        raw = raw / len(m.orders)
        candidate = m.scripts[:, _word_scripts(words)].T
        known = candidate.any(1)
        raw = np.where(candidate, raw, -1e4)
        raw -= raw.max(1, keepdims=True)
        raw[~known] = 0
        return np.maximum(raw, -50).astype(np.float32), known


def viterbi(scores: np.ndarray, offs: np.ndarray, penalty: float,
            start: np.ndarray) -> np.ndarray:
    """Best language of every word of several texts at once.

    ``scores`` has a row per word, text i owning rows offs[i]:offs[i+1]; the
    texts step together, longest first, so a step is one array operation.
    """
    k = scores.shape[1]
    n = np.diff(offs)
    best = np.zeros(len(scores), np.int64)
    if not len(scores) or not k:
        return best
    order = np.argsort(-n, kind="stable")
    first, n = offs[:-1][order], n[order]
    alive = np.searchsorted(-n, -np.arange(1, n[0] + 1), "right")   # texts with more than t words
    back = np.zeros((len(scores), k), np.uint8)
    v = scores[first[:alive[0]]] + start
    last = np.zeros(len(n), np.int64)
    own = np.arange(k)
    for t in range(1, int(n[0])):
        a = alive[t]
        if a < len(v):
            last[a:len(v)] = v[a:].argmax(1)
            v = v[:a]
        top = v.argmax(1)
        jump = v[np.arange(a), top] - penalty
        stay = v >= jump[:, None]
        at = first[:a] + t
        back[at] = np.where(stay, own, top[:, None])
        v = np.where(stay, v, jump[:, None]) + scores[at]
    last[:len(v)] = v.argmax(1)
    state = last.copy()
    for t in range(int(n[0]) - 1, -1, -1):
        a = alive[t]
        at = first[:a] + t
        best[at] = state[:a]
        state[:a] = back[at, state[:a]]
    return best


SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                                 T.StructField("lang", T.StringType())]))


def _spans(text: str, labels: np.ndarray, languages: tuple[str, ...]) -> list[dict]:
    if len(labels) and (labels == labels[0]).all():      # one span: only its ends are looked for
        end = next(i for i in range(len(text), 0, -1) if _LETTERS.match(text, i - 1))
        return [{"start": _LETTERS.search(text).start(), "end": end, "lang": languages[labels[0]]}]
    out: list[dict] = []
    for m, k in zip(_LETTERS.finditer(text), labels):
        if out and out[-1]["lang"] == languages[k]:
            out[-1]["end"] = m.end()
        else:
            out.append({"start": m.start(), "end": m.end(), "lang": languages[k]})
    return out


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text",
             penalty: float = 4.0, with_spans: bool = True, max_chars: int = 2 << 20) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``spans`` to ``docs`` (replacing
    columns of these names).

    ``spans`` lists (start, end, lang) in code points, from a span's first
    letter to its last.  ``score`` is the share of the text's letters that
    stand in words labelled ``lang_pred`` and written in a script of a learned
    language; 0 if there is none.  A text that is null, empty or without
    letters is ``und`` with score 0 and no spans, and so is every text if the
    model learned no language.  Ties go to the first language in code point
    order.  Whole texts are read, ``max_chars`` characters of them at a time
    (a longer text is a chunk of its own).
    """
    names = [c for c in docs.columns if c.lower() not in ("lang_pred", "score", "spans")]
    schema = T.StructType([docs.schema[c] for c in names]
                          + [T.StructField("lang_pred", T.StringType()),
                             T.StructField("score", T.DoubleType())]
                          + ([T.StructField("spans", SPAN)] if with_spans else []))
    at = names.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = WordScorer(model)
        for b in batches:
            texts = b.column(at).to_pylist()
            size = np.cumsum([len(t or "") + 1 for t in texts])
            i = 0
            while i < len(texts):
                j = max(i + 1, int(np.searchsorted(size, size[i] + max_chars)))
                langs, scores, spans = _predict(texts[i:j], scorer, penalty, with_spans)
                cols = [b.column(c).slice(i, j - i) for c in range(len(names))]
                cols += [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
                if with_spans:
                    cols.append(pa.array(spans, pa.list_(pa.struct(
                        [("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))))
                yield pa.RecordBatch.from_arrays(cols, schema.names)
                i = j

    return docs.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(predict, schema)


def _predict(texts: list[str | None], scorer: WordScorer, penalty: float, with_spans: bool
             ) -> tuple[list[str], np.ndarray, list]:
    languages = scorer.model.languages
    k = len(languages)
    found = [words_of(t) if k else [] for t in texts]
    offs = np.concatenate([[0], np.cumsum([len(w) for w in found])]).astype(np.int64)
    words = [w for ws in found for w in ws]
    rows = scorer.rows(words)
    start = np.log(np.maximum(scorer.model.prior, 1e-9)) if k else np.zeros(0)
    labels = viterbi(scorer.scores[rows], offs, penalty, start)
    letters = np.fromiter(map(len, words), np.int64, len(words))
    doc = np.repeat(np.arange(len(texts)), np.diff(offs))
    votes = np.bincount(doc * k + labels, letters * scorer.known[rows],
                        minlength=len(texts) * k).reshape(len(texts), k) if k else np.zeros((len(texts), 0))
    total = np.bincount(doc, letters, minlength=len(texts))
    langs, scores = [], np.zeros(len(texts))
    for i in range(len(texts)):
        if not total[i]:
            langs.append(UNDETERMINED)
            continue
        # without a word in a known script, the labels (by prior) still decide
        best = int(votes[i].argmax() if votes[i].any() else np.bincount(labels[offs[i]:offs[i + 1]]).argmax())
        langs.append(languages[best])
        scores[i] = votes[i][best] / total[i]
    spans = ([_spans(t or "", labels[offs[i]:offs[i + 1]], languages) for i, t in enumerate(texts)]
             if with_spans else [])
    return langs, scores, spans


def accepted(lang: Column, score: Column, min_score: float = 0.2) -> Column:
    """Whether a filtering stage keeps a document: a language was found and
    has at least ``min_score`` of the letters."""
    return (lang != UNDETERMINED) & (score >= min_score)
