"""Fingerprints against a plain computation byte by byte; every stage of the
corpus pipeline, and the whole of it, against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import sentencepiece as library

import corpus_pipeline
from natspark.llm import common, ctph, queries, warc
from tests.llm.test_operators import DOCS, brute_components, words

# ------------------------------------------------------------- fingerprints


def plain_level(raw, i):
    """Trailing zero bits of the rolling hash after byte i."""
    h = sum((raw[i - j] + 1) * pow(0x01000193, j, 2**32) for j in range(min(7, i + 1))) % 2**32
    h ^= h >> 15
    h = h * 0x85EBCA6B % 2**32
    h ^= h >> 13
    return (h & -h).bit_length() - 1 if h else 32


def plain_char(chunk):
    h, power = len(chunk), 1
    for b in chunk:
        h += int(common._BYTE[b]) * power
        power = power * common._BASE % 2**64
    return int(common.mix64(np.array([h % 2**64], np.uint64))[0]) >> 58


def plain_print(text):
    raw = text.encode()
    levels = [plain_level(raw, i) for i in range(len(raw))]
    k = 0
    while 64 * 2**k < len(raw):
        k += 1
    if k and sum(x >= k for x in levels) + 1 < 32:
        k -= 1
    parts = []
    for exponent, limit in ((k, 64), (k + 1, 32)):
        cuts = [i + 1 for i, x in enumerate(levels) if x >= exponent and i + 1 < len(raw)][:limit - 1]
        edges = [0, *cuts, len(raw)]
        parts.append([plain_char(raw[a:b]) for a, b in zip(edges, edges[1:])] if raw else [])
    return k, parts[0], parts[1]


def plain_alike(a, b):
    need = min(len(a), len(b), 4)
    runs = {tuple(a[i:i + need]) for i in range(len(a) - need + 1)}
    if not need or not any(tuple(b[i:i + need]) in runs for i in range(len(b) - need + 1)):
        return 0.0
    row = list(range(len(b) + 1))                       # edit distance by insertions and deletions
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(row[j - 1] if x == y else 1 + min(row[j], new[-1]))
        row = new
    return 1 - row[-1] / (len(a) + len(b))


def plain_likeness(x, y):
    if x == y:
        return 1.0
    if x[0] == y[0]:
        return max(plain_alike(x[1], y[1]), plain_alike(x[2], y[2]))
    if x[0] - y[0] == 1:
        return plain_alike(x[1], y[2])
    return plain_alike(x[2], y[1]) if y[0] - x[0] == 1 else 0.0


def written(p):
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    return f"{2 ** p[0]}:{''.join(letters[c] for c in p[1])}:{''.join(letters[c] for c in p[2])}"


def texts_of_all_kinds():
    rnd = random.Random(8)
    vocabulary = ["the", "of", "größe", "日本", "x", "running", "token", "\n", "😀"]
    out = [None, "", "a", "ab", "y" * 5000, "é" * 129, "ab" * 900, "same", "same"]
    for n in (3, 12, 13, 40, 130, 131, 700, 1500):
        out.append(" ".join(rnd.choice(vocabulary) + str(rnd.randrange(50)) for _ in range(n)))
        out.append(out[-1].replace("the", "thy", 2))
    return out


def test_fingerprints_and_likeness_equal_a_plain_computation(spark):
    texts = texts_of_all_kinds()
    rows = [(i * 3 - 5, t) for i, t in enumerate(texts)]
    got = {r.id: r for r in ctph.neighbours(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4), chunk_chars=900).collect()}
    assert len(got) == len(rows)
    for n, (i, t) in enumerate(rows):
        t, following = t or "", rows[(n + 1) % len(rows)][1] or ""
        new = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        own, changed = plain_print(t), plain_print(new)
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (written(own), written(changed)), i
        assert got[i].near_edited == pytest.approx(plain_likeness(own, changed), abs=1e-12)
        assert got[i].near_next == pytest.approx(plain_likeness(own, plain_print(following)), abs=1e-12)


def test_fingerprints_of_rows_that_share_an_id(spark):
    """A third of the rows without an id and a third with one id: they stay
    in the order of id and text, over several tasks."""
    rnd = random.Random(4)
    rows = [(None, f"n{rnd.randrange(90)}" * 30) for _ in range(100)] + [(7, f"s{rnd.randrange(90)}" * 30) for _ in range(100)] \
        + [(i, f"o{i}" * 30) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = ctph.neighbours(docs).collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        new = t[:len(t) - len(t) // 2] + following[:len(t) // 2]
        want.append((i, hashlib.sha256(new.encode()).hexdigest()))
    assert Counter((r.id, r.edited_sha256) for r in got) == Counter(want)


def test_warc_hot_payloads_and_others_give_the_same_revisits(spark, monkeypatch):
    rnd = random.Random(6)
    rows = [(i, f"u{i}", "hot" if i % 3 else f"own {rnd.randrange(60)}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = []
    for hot in (0, 1, 256):
        monkeypatch.setattr(warc, "HOT_PAYLOADS", hot)
        found.append(sorted(map(tuple, warc.with_revisits(pages).collect()), key=lambda r: r[0]))
    first = {}
    for i, _, html in rows:
        first.setdefault(html, i)
    want = [(i, url, html, None if first[html] == i else first[html]) for i, url, html in rows]
    assert found == [want] * 3


# ----------------------------------------------------------------- pipeline

@pytest.fixture(scope="module")
def documents():
    """Two languages; copies, near copies and repeated rows, documents
    without letters, nulls in every column."""
    rnd = random.Random(5)
    english = "the and of to that with which from have this were their would about there".split()
    german = "der und nicht eine werden auch nach durch wenn sich über zwischen haben oder sind".split()
    rows = []
    for i in range(90):
        t = " ".join(rnd.choice(english if i % 2 else german) + " " + rnd.choice(english if i % 2 else german) for _ in range(30))
        rows.append((i, t, "en" if i % 2 else "de", ["a", "b", "c", None][i % 4], len(t), i, "x"))
    text = rows[1][1].split()
    near = " ".join([*text[:-1], "altogether"])
    rows += [(200, rows[1][1], "en", "a", 1, 1, "x"), (201, near, "en", None, 1, 1, "x"), (202, rows[2][1], None, "b", 1, None, None),
             (203, re.sub("[a-z]", lambda m: m[0].upper(), rows[4][1]), "de", "b", 1, 1, "x"), (204, None, "en", "a", None, None, None), (205, "", "en", "b", 0, 1, "x"),
             (206, " \t\n", None, None, 3, 1, "x"), (207, "12 34 !!", "en", "b", 8, 1, "x")]
    return rows + [rows[6]]


def plain_targets(sizes):
    """Sources by code point, null last, weigh 5, 2, 1; no target above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, full, out = sum(sizes.values()), set(), {}
    while True:
        free = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = 3 * sizes[s]
            left -= out[s]
            full.add(s)


def test_every_stage_and_the_run_equal_plain_versions(spark, documents, tmp_path):
    docs = spark.createDataFrame(documents, DOCS).repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    folder = str(tmp_path)
    read = spark.read.parquet(folder + "/documents.parquet")

    def written_rows(df, name):
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    # language ID: documents with words of a language stay, those without letters go
    seen = written_rows(stages["language_id"](spark, read, folder), "seen")
    assert seen.columns == read.columns
    clean = [r for r in documents if r[0] not in (204, 205, 206, 207)]
    assert Counter(tuple(r) for r in seen.collect()) == Counter(clean)

    # near-dedup: of each class of five-word shingles the smallest id, once
    kept = written_rows(stages["near_dedup"](spark, seen, folder), "kept")
    classes = brute_components({r[0]: (r[0], r[1]) for r in clean}.values(), 5)
    want = [r for r in {r[0]: r for r in clean}.values() if classes[r[0]][1] == r[0]]
    assert kept.columns == read.columns
    assert Counter(tuple(r) for r in kept.collect()) == Counter(want)
    assert not {200, 201, 202, 203} & {r[0] for r in want}

    # mixing: every source comes to its target
    mix = written_rows(stages["source_mix"](spark, kept, folder), "mix")
    assert mix.columns == read.columns
    sizes = Counter()
    for r in want:
        sizes[r[3]] += len(words(r[1]))
    by_id = {r[0]: r for r in want}
    targets = plain_targets(sizes)

    def check_mix(rows):
        taken, of = Counter(), Counter()
        for i, source, text in rows:
            assert source == by_id[i][3]
            mine = words(text)
            assert mine == words(by_id[i][1])[:len(mine)]
            taken[source] += len(mine)
            of[i] += len(mine)
        assert all(abs(taken[s] - t) <= 1 for s, t in targets.items()) and set(taken) <= set(targets)
        assert all(n <= 3 * len(words(by_id[i][1])) for i, n in of.items())

    mixed = mix.select("doc_id", "source", "text").collect()
    check_mix(mixed)

    # tokenizing: the ids of the library
    sp = library.SentencePieceProcessor(model_file=queries.tokenizer_path())
    encoded = stages["tokenize"](spark, mix, folder).collect()
    ids = Counter((i, tuple(sp.encode(t, add_bos=True, add_eos=True))) for i, _, t in mixed)
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded) == ids
    assert all(r.n_tokens == len(r.ids) for r in encoded)

    # the run is the stages one after the other
    whole = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in whole) == ids
    check_mix((r.doc_id, r.source, sp.decode(list(r.ids))) for r in whole)


def test_the_run_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_plain_targets_meet_the_whole():
    got = plain_targets({"a": 10, "b": 100, None: 50})
    assert math.isclose(sum(got.values()), 160) and got["a"] == 30
