"""Small cases of every corpus operator: nulls, empty and long texts, ties,
repeated rows, empty tables, extra columns with clashing names."""

import hashlib
import math
import random
import re
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from natspark.llm import (chat, ctph, langid, lattice, licenses, mih, mixing, neardup, queries,
                          sentencepiece, warc)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept int, size string"


@pytest.fixture(scope="module")
def model():
    return sentencepiece.read_model(queries.tokenizer_path())


@pytest.fixture(scope="module")
def docs(spark):
    rnd = random.Random(3)
    words = "the of and ing tion der und ein sch les des une".split()
    rows = []
    for i in range(60):
        t = " ".join(rnd.choice(words[:5] if i % 2 else words[5:]) + rnd.choice(words) for _ in range(40))
        rows.append((i, t, "en" if i % 2 else "de", ["a", "b", None][i % 3], len(t), 7, "x"))
    rows += [(100, rows[1][1], "en", "a", 1, 1, "x"), (101, rows[1][1] + " more", "en", "a", 1, 1, "x"),
             (101, rows[1][1] + " more", "en", "a", 1, 1, "x"), (102, None, None, None, None, None, None),
             (103, "", "en", "b", 0, 1, "x"), (104, " \t\n", "en", "b", 3, 1, "x"),
             (105, "12 34 !!", "en", "b", 8, 1, "x"), (None, "the of", "en", "a", 6, 1, "x"),
             (106, "word " * 30000, None, "a", 150000, 1, "x"), (107, "y" * 50000, None, "a", 50000, 1, "x")]
    return spark.createDataFrame(rows, DOCS).repartition(3)


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def test_mix_meets_targets_and_cuts_exactly(docs):
    plan = mixing.mix_sources(docs, carry=["doc_id", "text", "source"])
    got = plan.select("doc.doc_id", "doc.text", "doc.source", "size", "source_size", "target", "taken").collect()
    assert len(got) == docs.count() and all(r["size"] == len(words(r.text)) for r in got)
    for source in {r.source for r in got}:
        part = [r for r in got if r.source == source]
        assert part[0].source_size == sum(r["size"] for r in part)
        assert abs(sum(r.taken for r in part) - part[0].target) <= 1
        assert all(r.taken <= 3 * r["size"] for r in part) and part[0].target <= 3 * part[0].source_size + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, plan.select("doc.doc_id", "doc.text", "doc.source", "size",
                                                                "source_size", "target", "taken").collect()))
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_chat_rotates_every_participant(spark):
    t = spark.createDataFrame([(1, 0, "system", "be kind", 1), (1, 1, "ann", "hi <|im_end|>", 1), (1, 2, "bob", None, 1),
                               (1, None, "ann", "late", 1), (1, 1, "ann", "hi <|im_end|>", 1), (2, 0, "system", "x", 1),
                               (None, 0, None, "lost", 1)], "conv_id long, turn int, role string, text string, part int")
    got = chat.rotate(t).collect()
    assert {(r.conv, r.speaker) for r in got} == {(1, "ann"), (1, "bob"), (None, "unknown")}
    for r in got:
        own = "".join(r.rendered[s:e] for s, e in r["mask"])
        assert own.count("<|im_end|>") == r.n_own == r.rendered.count("<|im_start|>assistant\n")
    first = min((r for r in got if r.speaker == "bob"), key=lambda r: r.part)
    assert "user name=ann\nhi < |im_end|><|im_end|>" in first.rendered and first.n_turns == 4
    assert chat.rotate(t.limit(0)).count() == 0


def test_chat_pieces_hold_a_bounded_number_of_rows(spark):
    rows = [(1, None, "ann", f"late {i % 40:02d}") for i in range(95)] + [(1, 3, "bob", "again")] * 33
    rows += [(None, 0, f"p{i % 3}", f"lost {i:03d}") for i in range(41)] + [(2, i, "ann", f"t{i}") for i in range(25)]
    t = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").repartition(7)
    got = chat.rotate(t, part_turns=10).collect()
    assert max(r.n_turns for r in got) == 10
    for conv, who in ((1, "ann"), (1, "bob"), (None, "p0"), (None, "p2"), (2, "ann")):
        mine = sorted((r for r in got if r.conv == conv and r.speaker == who), key=lambda r: (r.part, r.piece))
        want = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, r[2], r[3]))
        assert re.findall(r"\n([^\n]*)<\|im_end\|>", "".join(r.rendered for r in mine)) == [r[3] for r in want]
        for r in mine:
            assert [r.rendered[s:e].removesuffix("<|im_end|>") for s, e in r["mask"]] == re.findall(
                r"<\|im_start\|>assistant\n([^\n]*)<\|im_end\|>", r.rendered)
    assert {r.piece for r in got if r.conv == 2} == {0}


def test_language_spans_and_undetermined(docs):
    m = langid.fit(docs)
    got = {r.doc_id: r for r in langid.identify(docs, m).collect()}
    for i in (102, 103, 104, 105):
        assert (got[i].lang_pred, got[i].score, got[i].spans) == ("und", 0.0, [])
    assert sum(got[i].lang_pred == ("en" if i % 2 else "de") for i in range(60)) >= 57
    assert got[3].spans[0].start == 0 and all(0 <= r.score <= 1 for r in got.values())
    none = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, none, with_spans=False).collect()} == {"und"}
    assert langid.identify(docs.limit(0), m).count() == 0


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(0)
    offs = np.array([0, 4, 4, 9])
    s = rng.normal(size=(9, 3)) * 3
    got = langid.viterbi(s, offs, 1.5, np.zeros(3))
    import itertools
    for a, b in zip(offs[:-1], offs[1:]):
        def value(path):
            return sum(s[a + i, k] for i, k in enumerate(path)) - 1.5 * sum(x != y for x, y in zip(path, path[1:]))
        best = max(value(p) for p in itertools.product(range(3), repeat=b - a))
        assert abs(value(tuple(got[a:b])) - best) < 1e-9


def test_sentencepiece_equals_the_library(docs, model):
    import sentencepiece as library
    sp = library.SentencePieceProcessor(model_proto=model)
    enc = sentencepiece.Encoder(sentencepiece.Vocabulary(model))
    rnd = random.Random(5)
    texts = ["", " ", "  a b\n\tc", "▁a", "a\x00b", "日本語😀é", " " * 1000 + "x", "a" * 3000, "<s></s><0x41>",
             *("".join(rnd.choice("abeht ▁\n.éß日") for _ in range(rnd.randint(0, 60))) for _ in range(500))]
    ids, n = enc.encode(texts)
    end = np.cumsum(n)
    back = enc.decode(ids, n)
    for t, e, k, b in zip(texts, end, n, back):
        want = sp.encode(t, add_bos=True, add_eos=True)
        assert ids[e - k:e].tolist() == want and b.decode() == sp.decode(want)
    out = sentencepiece.encode(docs, model, outputs=("ids", "n_tokens", "decoded"))
    rows = {r.doc_id: r for r in sentencepiece.decode(out.drop("decoded"), model).collect()}
    assert rows[102].ids == [1, 2] and rows[102].decoded == ""
    assert rows[106].decoded == "word " * 30000 and rows[5].kept == 7
    assert sentencepiece.encode(docs.limit(0), model).count() == 0


def test_long_words_equal_the_library_and_other_models_are_refused(spark, model):
    import sentencepiece as library
    sp = library.SentencePieceProcessor(model_proto=model)
    enc = sentencepiece.Encoder(sentencepiece.Vocabulary(model))
    rnd = random.Random(11)
    n = sentencepiece.LONG_WORD
    texts = ["".join(rnd.choice(abc) for _ in range(size)) for size in (n - 2, n - 1, n, n + 1, 3 * n, 20_000)
             for abc in ("abcdefghijklmnopqrstuvwxyz", "ab", "theinsr", "日本語é😀th", "01▁.ea")]
    texts += ["ab" * n, "the" * n + "\n" + "y" * n, "a " * n + "q" * 2 * n + " end", "x" * 200_000]
    ids, k = enc.encode(texts)
    for t, e, size in zip(texts, np.cumsum(k), k):
        assert ids[e - size:e].tolist() == sp.encode(t, add_bos=True, add_eos=True), t[:40]
    cased = spark.createDataFrame([(1, "a b", 2, 3)], "id int, text string, _in int, __IN int")
    out = sentencepiece.encode(cased, model)
    assert out.columns == [*cased.columns, "ids", "n_tokens"] and out.first()["_in"] == 2
    assert sentencepiece.decode(out, model).first().decoded == "a b"


def test_other_models_are_refused(model, monkeypatch):
    sentencepiece.check_model(model)
    # a table that merges in another order stands for a model of another kind
    made = sentencepiece.Vocabulary(model)
    made.ranks = made.ranks[::-1].copy()
    monkeypatch.setattr(sentencepiece, "Vocabulary", lambda _: made)
    with pytest.raises(ValueError):
        sentencepiece.check_model(model)


def test_language_words_and_spans_keep_their_places(spark):
    rows = [(i, "bu güzel bir gün ve sonra eve geldi" if i % 2 else "hello there you are my good old friend",
             "tr" if i % 2 else "en") for i in range(40)]
    m = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    text = "İİİ güzel bir gün ve sonra hello there you are my good friend"
    got = langid.identify(spark.createDataFrame([(text,), ("  12 hello there 3 ",)], "text string"), m).collect()
    assert [text[s.start:s.end] for s in got[0].spans if s.lang == "en"] == ["hello there you are my good friend"]
    assert [(s.start, s.end, s.lang) for s in got[1].spans] == [(5, 16, "en")]
    assert langid.words_of("İx Σ1ß") == ["i̇x", "σ", "ß"]


def test_language_word_scores_equal_their_definition(spark):
    """Smoothed n-gram counts in dictionaries instead of hashed tables."""
    rows = [(0, "ab ab ba abc", "en"), (1, "xy yx xyz", "de"), (2, "ab xy", "en"), (3, "", "de"), (4, None, "en"),
            (5, "да нет", "ru")]
    m = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))

    def grams(word):
        marked = f"<{word}>"
        return [marked] + [marked[i:i + n] for n in m.orders for i in range(len(marked) - n + 1)]

    seen = {lang: [g for _, t, k in rows if k == lang for w in (t or "").split() for g in grams(w)]
            for lang in m.languages}
    assert m.languages == ("de", "en", "ru")

    def score(word):
        cyrillic = word[0] > "z"
        raw = [sum(math.log((seen[k].count(g) + 0.5) / (len(seen[k]) + 0.5 * len(m.logp))) for g in grams(word))
               / len(m.orders) if (k == "ru") == cyrillic else -math.inf for k in m.languages]
        return [max(x - max(raw), -50) for x in raw]

    tested = ["ab", "xy", "abc", "zz", "ab", "да", "x"]
    scorer = langid.WordScorer(m)
    at = scorer.rows(tested)
    assert np.allclose(scorer.scores[at], [score(w) for w in tested], atol=1e-3)
    strange = scorer.rows(["日本"])
    assert scorer.known[at].all() and not scorer.known[strange].any()


def brute_components(rows, w):
    sets = {}
    for i, t in rows:
        ws = words(t)
        sets[i] = {tuple(ws[k:k + w]) for k in range(len(ws) - w + 1)} if len(ws) >= w else ({tuple(ws)} if ws else set())
    comp = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                n = len(sets[a] & sets[b])
                if n and 100 * n >= 80 * len(sets[a] | sets[b]) and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    return {i: (len(sets[i]), comp[i]) for i in sets}


@pytest.mark.parametrize("w", [2, 5])
def test_near_duplicates_equal_brute_force(spark, docs, w):
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(400)}" for _ in range(60)]
    more = []
    for i in range(200, 240):                     # copies of one text with a few edits each
        t = list(base)
        for _ in range(rnd.randrange(1, 5)):
            t[rnd.randrange(60)] = f"z{rnd.randrange(9)}"
        more.append((i, " ".join(t)))
    all_docs = docs.select("doc_id", "text").where("doc_id is not null").unionByName(
        spark.createDataFrame(more, "doc_id long, text string"))
    got = {r.id: (r.n_shingles, r.component) for r in
           neardup.near_duplicates(all_docs, neardup.Params(shingle_words=w, block=8, set_block=8)).collect()}
    assert got == brute_components([tuple(r) for r in all_docs.collect()], w)


def test_one_of_each_group_stays(docs):
    kept = sorted(r.doc_id for r in neardup.one_of_each(docs).collect() if r.doc_id is not None)
    assert 1 in kept and 100 not in kept and 101 not in kept and {102, 103, 104}.issubset(kept)
    assert neardup.one_of_each(docs).columns == docs.columns
    assert neardup.one_of_each(docs.limit(0)).count() == 0


def test_nearest_neighbours_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 16))
    rows = [(i, [float(v) for v in r], 1) for i, r in enumerate(x)]
    rows += [(400, None, 1), (420, [0.0] * 16, 1), (440, [float("nan")] * 16, 1), (460, [None] + [1.0] * 15, 1),
             (480, [1.0, 2.0], 1), (None, [1.0] * 16, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = mih.nearest(df, F.col("id") % 20 == 0, k=5, block_rows=100, block_queries=7).collect()
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    hits = 0
    for q in range(0, 400, 20):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - s[q, r.vec_id]) < 1e-9 for r in mine)
        hits += len({r.vec_id for r in mine} & set(np.argsort(-s[q])[:5].tolist()))
    assert {r.query_id for r in got} == set(range(0, 400, 20)) and hits >= 0.9 * 100
    assert mih.nearest(df.limit(0), F.col("id") % 20 == 0).count() == 0
    two = mih.nearest(df.where("vec_id in (0, 1)"), F.col("id") % 20 == 0).collect()
    assert [(r.query_id, r.vec_id) for r in two] == [(0, 1)]


def test_nearest_neighbours_of_every_dimension(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(60, 20)), rng.normal(size=(30, 3))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100 + i, v.tolist()) for i, v in enumerate(y)]
    rows += [(7, x[0].tolist())] * 200                   # one id holds most rows
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = mih.nearest(df, F.col("id") % 20 == 0, k=3, sample_rows=50, block_rows=16, block_queries=2).collect()
    assert {r.query_id for r in got} == {0, 20, 40, 100, 120}
    for r in got:
        a, b = (x, 0) if r.query_id < 100 else (y, 100)
        assert (r.vec_id >= 100) == (r.query_id >= 100)
        row = [a[r.vec_id - b]] + ([x[0]] if r.vec_id == 7 else [])
        assert any(abs(r.score - a[r.query_id - b] @ v) < 1e-9 for v in row)


def test_fingerprints_and_their_neighbours(docs):
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    got = ctph.neighbours(docs, chunk_chars=500).collect()
    want = []
    for n, (i, t) in enumerate(rows):
        new = ctph.edited(t, rows[(n + 1) % len(rows)][1])
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r.id, r.n_chars, r.edited_sha256)) for r in got)
    prints = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        prints.setdefault(r.id, r.fingerprint)
    assert prints[1] == prints[100] and prints[102] == prints[103] == "1::"
    assert ctph.neighbours(docs.limit(0)).count() == 0


def test_lattice_sums_all_segmentations(docs, model):
    small = lattice.lattice_of([b" a", b"ab", b" ab", b"ba"])
    logp = np.log(np.arange(1, small.size + 1) / np.arange(1, small.size + 1).sum())
    ids = {bytes([b]): b for b in range(256)} | {p: 256 + i for i, p in enumerate(sorted([b" a", b"ab", b" ab", b"ba"]))}

    def total(rest):
        return 1.0 if not rest else sum(math.exp(logp[k]) * total(rest[len(p):]) for p, k in ids.items()
                                        if rest.startswith(p))
    raw = [b" abab", b" a", b" bba"]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    w = lattice.WordLattice(small, np.frombuffer(b"".join(raw), np.uint8), offs)
    assert np.allclose(np.exp(w.forward(logp)[w.last]), [total(r) for r in raw])
    assert np.allclose(w.backward(logp)[w.first], w.forward(logp)[w.last])
    got = {r.doc_id: r for r in lattice.score(docs.select("doc_id", "text"), F.col("doc_id") % 2 == 0, model,
                                               head_words=5).collect()}
    train = [x for r in docs.collect() if r.doc_id is not None and r.doc_id % 2 == 0 for x in [*words(r.text), None]]
    n, v = len(train), len(set(train))
    for r in docs.collect():
        tokens = [*words(r.text), None]
        base = sum(math.log10((train.count(x) + 0.1) / (n + 0.1 * (v + 1))) for x in tokens) if len(tokens) < 100 else None
        g = got[r.doc_id]
        assert g.n_tokens == len(tokens) and g.train_tokens == n and g.score < 0 and math.isfinite(g.score)
        assert base is None or abs(base - g.base_score) < 1e-6
    nothing = lattice.score(docs.select("doc_id", "text"), F.lit(False), model).collect()
    assert all(math.isfinite(r.score) and r.train_tokens == 0 for r in nothing)


def test_edges_give_what_the_word_lattices_give():
    vocab = [b" a", b"ab", b" ab", b"ba", b"bab"]
    small = lattice.lattice_of(vocab)
    rnd = random.Random(6)
    raw = [b" " + bytes(rnd.choice(b"abc") for _ in range(rnd.randrange(1, 12))) for _ in range(60)]
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    p = np.random.default_rng(1).random(small.size)
    p /= p.sum()
    e, w = lattice.Edges.of(small, data, offs), lattice.WordLattice(small, data, offs)
    assert np.allclose(np.log(e.forward(p[e.piece])[e.last()]), w.forward(np.log(p))[w.last])
    assert np.allclose(lattice.word_scores(small, np.log(p), data, offs), w.forward(np.log(p))[w.last])
    alpha, beta = w.forward(np.log(p)), w.backward(np.log(p))
    of = np.searchsorted(w.first, w.src, "right") - 1
    post = np.exp(alpha[w.src] + np.log(p)[w.piece] + beta[w.dst] - alpha[w.last][of])
    assert np.allclose(e.uses(p), np.bincount(w.piece, post, minlength=small.size))


def test_scores_equal_their_definition_whatever_the_columns_are_called(spark, model):
    rnd = random.Random(8)
    texts = [" ".join(rnd.choice(["the", "The", "house", "zq", "été", "x" * 40, "of"]) + rnd.choice(["", "", "s", "ly"])
                      for _ in range(rnd.randrange(12))) for _ in range(24)] + ["", None, "Only here", "9" * 70]
    names = ["_row", "_in", "_tokens", "_known", "_base", "_score", "_lattice", "_tail", "_tail_base", "id", "t", "n"]
    df = spark.createDataFrame([(i, t, *[7] * len(names)) for i, t in enumerate(texts)],
                               "doc_id long, text string, " + ", ".join(f"{c} int" for c in names)).repartition(3)
    learn = F.col("doc_id") % 3 != 0
    got = lattice.score(df, learn, model, head_words=3)
    assert got.columns == ["doc_id", *names, "n_tokens", "n_known", "train_tokens", "base_score", "lattice_score", "score"]
    got = {r.doc_id: r for r in got.collect()}
    assert len(got) == len(texts) and all(r._score == r._tail == r["id"] == 7 for r in got.values())
    train = [t for i, t in enumerate(texts) if i % 3]
    counts, ends = {}, len(train)
    for t in train:
        for x in words(t):
            counts[x] = counts.get(x, 0) + 1
    total, kinds = sum(counts.values()) + ends, len(counts) + 1
    pieces = lattice.lattice_of(lattice.vocabulary_pieces(model))
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    logp = lattice.fit(table, pieces)
    vocab = {bytes([b]): b for b in range(256)}
    longer = sorted({p for p in lattice.vocabulary_pieces(model) if len(p) > 1 and b" " not in p[1:]
                     and not any(b in p for b in b"\t\n\x0b\x0c\r") and p.lower() == p})
    vocab |= {p: 256 + k for k, p in enumerate(longer)}

    def of_pieces(word):
        raw, alpha = b" " + word.encode(), [1.0]
        for d in range(1, len(raw) + 1):
            alpha.append(sum(alpha[k] * math.exp(logp[vocab[raw[k:d]]]) for k in range(d) if raw[k:d] in vocab))
        return alpha[-1]

    once, twice = sum(n == 1 for n in counts.values()), sum(n == 2 for n in counts.values())
    discount = min(0.9, max(0.1, once / (once + 2 * twice)))
    for i, t in enumerate(texts):
        score, pure = math.log10((ends - discount) / total), math.log10(ends / total)
        for x in words(t):
            p = of_pieces(x)
            score += math.log10(max(counts.get(x, 0) - discount, 0) / total + discount * kinds / total * p)
            pure += math.log10(p * (1 - ends / total))
        assert got[i].n_known == 1 + sum(x in counts for x in words(t))
        assert abs(got[i].score - score) < 1e-6 and abs(got[i].lattice_score - pure) < 1e-6, t


def test_every_em_round_sees_every_word(spark):
    small = lattice.lattice_of([b"zq", b" zq", b"ab"])
    vocab = {bytes([b]): b for b in range(256)} | {p: 256 + i for i, p in enumerate(sorted([b"zq", b" zq", b"ab"]))}
    # more distinct words than the 50,000 that a sample once held; two letters apart from all others
    words = [f"{i:05d}" for i in range(55_000)] + ["zqab", "abzq"]
    counts = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = lattice.fit(counts, small, rounds=3)

    def uses(word, logp):
        paths = []

        def walk(rest, made, value):
            if not rest:
                paths.append((made, value))
            for p, k in vocab.items():
                if rest.startswith(p):
                    walk(rest[len(p):], [*made, k], value * math.exp(logp[k]))
        walk(word, [], 1.0)
        norm = sum(v for _, v in paths)
        return [(k, v / norm) for made, v in paths for k in made]

    logp = np.full(small.size, -np.log(small.size))
    digits = np.zeros(small.size)
    for w in words[:-2]:
        for c in w.encode():
            digits[c] += 1
    digits[0x20] = 55_000
    for _ in range(3):
        total = digits + 0.02
        for w in words[-2:]:
            for k, v in uses(b" " + w.encode(), logp):
                total[k] += v
        logp = np.log(total / total.sum())
    assert np.allclose(got, logp, atol=1e-6)


def test_licenses_are_found_and_inherited(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    files = spark.createDataFrame([
        ("a/LICENSE", mit, 1), ("a/b/c/code.txt", "some words here", 1), ("a/b/own.txt", "many words\n" + gpl + "\nand more " * 9, 1),
        ("a/b/d/COPYING", gpl, 1), ("a/b/d/e/x.txt", None, 1), ("z/x.txt", "", 1), (None, "words", 1), ("top.txt", "words", 1),
        ("a/b/c/code.txt", "some words here", 1)], "path string, text string, license int")
    got = {}
    for r in licenses.inherit(licenses.scan(files)).collect():
        got.setdefault(r.path, (r.effective_license, r.inherited_from, r.depth_up))
    assert got["a/LICENSE"][0] == "MIT" and got["a/b/own.txt"][0] == "GPL-3.0"
    assert got["a/b/c/code.txt"] == ("MIT", "a", 2) and got["a/b/d/e/x.txt"] == ("GPL-3.0", "a/b/d", 1)
    assert got["z/x.txt"] == got[None] == got["top.txt"] == (None, None, None)
    assert licenses.inherit(licenses.scan(files.limit(0))).count() == 0


def test_licenses_of_wrapped_headers_whole_texts_and_tags(spark):
    def wrapped(text, mark="# "):
        return "\n".join(mark + x for x in textwrap.wrap(text, 72))

    body = licenses.licence_bodies()
    code = "\n".join(f"x{i} = call{i}(a{i}, b{i})" for i in range(300))
    rows = [("gpl.py", "# tool\n" + wrapped(licenses.HEADERS["GPL-3.0 (header)"]) + "\n\n" + code, "GPL-3.0", False),
            ("mpl.c", wrapped(licenses.HEADERS["MPL-2.0 (header)"], " * ") + "\n" + code, "MPL-2.0", False),
            ("mit.c", wrapped(body["MIT (text)"], " * ") + "\n" + code, "MIT", False),
            ("tag.c", "// SPDX-License-Identifier: GPL-2.0-or-later\n" + code, "GPL-2.0", False),
            ("other.c", "// SPDX-License-Identifier: Foo-9\n" + code, None, False),
            ("long.txt", code + "\n" + body["MPL-2.0 (text)"], "MPL-2.0", True),
            ("plain.c", code, None, False)]
    rows += [(f"texts/{n.partition(' ')[0]}.txt", body[n], n.partition(" ")[0], True) for n in body]
    files = spark.createDataFrame([r[:2] for r in rows] + [(f"f{i}", f"some word{i} and the license of") for i in range(300)],
                                  "path string, text string")
    got = {r.path: (r.license, r.is_license_file) for r in licenses.scan(files).collect()}
    assert {r[0]: got[r[0]] for r in rows} == {r[0]: r[2:] for r in rows}


def plain_cosine(a, b, idf, rare):
    def weights(tf):
        return {t: (1 + math.log(n)) * idf.get(t, rare) for t, n in tf.items()}
    a, b = weights(a), weights(b)
    norm = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
    return sum(x * b.get(t, 0.0) for t, x in a.items()) / norm if norm else 0.0


def test_license_bodies_are_compared_at_every_term():
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(40)]
    body = [rnd.choice(vocab) for _ in range(licenses.SHORT_TERMS + 20)]
    idf = {t: 1 + rnd.random() * 3 for t in vocab}
    m = licenses.Matcher({"X (text)": " ".join(body)}, idf, 4.5)
    for before, after in ((0, 1), (7, 5), (133, 60)):
        changed = [t if rnd.random() > 0.2 else f"z{rnd.randrange(9)}" for t in body]
        text = [f"z{rnd.randrange(30)}" for _ in range(before)] + changed + [rnd.choice(vocab) for _ in range(after)]
        got = m.best_body(text, np.array([True]))
        size = len(body)
        all_of = [plain_cosine(licenses.Counter(text[i:i + size]), licenses.Counter(body), idf, 4.5)
                  for i in range(len(text) - size + 1)]
        assert abs(got[1] - max(all_of)) < 1e-9 and abs(all_of[got[2]] - max(all_of)) < 1e-9 and got[3] == size
    assert m.best_body(body, np.array([True])) == (None, 0.0, 0, 0)      # no longer than the body


def test_license_scan_and_inheritance_equal_brute_force(spark):
    rnd = random.Random(12)
    templates = {"A-1": "released under the alpha license version one", "B-2": "beta public domain notice two two",
                 "C-3": "permission is given by gamma to all", "A-1 (long)": "this file may be used under the alpha "
                 "license if the notice of the alpha license and its version one stay in all copies"}
    pool = sorted({w for t in templates.values() for w in t.split()}) + ["noise", "other", "words", "copyright"]
    files = []
    for i in range(150):
        t = rnd.choice(list(templates.values())).split()
        t = [w if rnd.random() > 0.2 else rnd.choice(pool) for w in t]
        t = [rnd.choice(pool) for _ in range(rnd.randrange(12))] + t + [rnd.choice(pool) for _ in range(rnd.randrange(12))]
        text = "".join(w + rnd.choice([" ", " ", " ", "\n", "\n# "]) for w in t)
        path = "/".join([rnd.choice("abc") for _ in range(rnd.randrange(4))] + [rnd.choice(["LICENSE", "x.c", "y.c"])])
        files.append((i, path, text))
    files += [(200, "a/b/c/deep/er/z.c", "plain words"), (201, None, templates["A-1"]), (202, "LICENSE", ""), (203, "q/z.c", None)]
    names = ["_dir", "_n", "_up", "_license", "_p", "_t", "_path", "_text", "k", "depth_up"]
    df = spark.createDataFrame([(*f, *[7] * len(names)) for f in files],
                               "i int, path string, text string, " + ", ".join(f"{c} int" for c in names)).repartition(3)
    out = licenses.inherit(licenses.scan(df, templates=templates, threshold=0.7))
    assert out.columns == ["i", "path", *names[:-1], "license", "similarity", "header", "is_license_file",
                           "effective_license", "inherited_from", "depth_up"]
    got = {r.i: r for r in out.collect()}
    assert len(got) == len(files) and all(r._dir == r._n == r._license == r.k == 7 for r in got.values())

    total = len(files)
    idf = {w: math.log((1 + total) / (1 + sum(w in licenses.terms(t or "") for _, _, t in files))) + 1
           for x in templates.values() for w in licenses.terms(x)}
    rare = math.log(1 + total) + 1
    most = 1.25 * max(len(t.split()) for t in templates.values())
    want = {}
    for i, path, text in files:
        lines = [x for x in (text or "").split("\n") if licenses.terms(x)]
        cue = [bool(re.search("license|copyright|permission is|public domain", x)) or
               (k + 1 < len(lines) and (x.split()[-1], re.sub("^# *", "", lines[k + 1]).split()[0])
                in {("permission", "is"), ("public", "domain")}) for k, x in enumerate(lines)]
        windows = [licenses.terms(text or "")]
        for s in range(len(lines)):
            for e in range(s + 1, len(lines) + 1):
                size = sum(sum(licenses.terms(x).values()) for x in lines[s:e])
                if any(cue[s:e]) and (size <= most or e == s + 1 or (e == s + 2 and cue[s])):
                    windows.append(licenses.terms("\n".join(lines[s:e])))
        scores = {n: max(plain_cosine(w, licenses.terms(t), idf, rare) for w in windows) for n, t in templates.items()}
        top = max(scores.values())
        if top >= 0.7:
            want[i] = ({n.partition(" (")[0] for n, v in scores.items() if v > top - 1e-9}, top)
    assert 20 < len(want) < 150
    for i, path, text in files:
        r = got[i]
        assert (r.license is not None) == (i in want), (i, text)
        if i in want:
            assert r.license in want[i][0] and abs(r.similarity - want[i][1]) < 1e-9
        else:
            assert r.similarity == 0
        if r.license is not None:
            assert (r.effective_license, r.inherited_from, r.depth_up) == (r.license, None, None)
            continue
        folder, up = (path.rpartition("/")[0], 0) if path is not None else (None, 0)
        expected = (None, None, None)
        while folder is not None:
            here = sorted((-x.similarity, x.license) for x in got.values()
                          if x.is_license_file and x.path is not None and x.path.rpartition("/")[0] == folder)
            if here:
                expected = (here[0][1], folder, up)
                break
            folder, up = (folder.rpartition("/")[0], up + 1) if folder else (None, up)
        assert (r.effective_license, r.inherited_from, r.depth_up) == expected, path


def test_warc_revisits_equal_brute_force(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice([None, *range(40)]) if rnd.random() < 0.1 else i, f"u{i}", rnd.choice([None, "", "a", "é", "x" * 999, f"own {i}"]))
            for i in range(200)]
    for least in (0, 2):
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
        index, folder = warc.bundle(pages, min_bytes=least)
        got = sorted(((r.url, r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload)
                      for r in warc.read_archives(index, folder).collect()), key=lambda r: r[0])
        want = []
        for i, url, html in rows:
            body = (html or "").encode()
            ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
            refers = min(ids) if ids and len(body) >= least and i != min(ids) else None
            want.append((url, i, "response" if refers is None else "revisit", refers, len(body),
                         body if refers is None else None))
        assert got == sorted(want, key=lambda r: r[0])


def test_warc_round_trip_and_random_access(spark, tmp_path):
    pages = spark.createDataFrame([(3, "u3", "same", 1), (1, "u\n1%", "same", 1), (2, "u2", None, 1), (5, None, "", 1),
                                   (7, "u7", "é" * 3_000_000, 1), (None, "u", "same", 1), (9, "u9", "alone", 1)],
                                  "page_id long, url string, html string, frame int")
    index, folder = warc.bundle(pages, folder=str(tmp_path / "w"))
    rows = {r.page_id: r for r in warc.read_archives(index, folder).collect()}
    assert len(rows) == 7 and rows[1].url == "u\n1%"
    assert (rows[1].record_type, rows[3].record_type, rows[3].refers_to) == ("response", "revisit", 1)
    assert rows[None].refers_to == 1 and rows[5].refers_to == 2 and rows[2].payload_bytes == 0
    assert bytes(rows[7].payload).decode() == "é" * 3_000_000 and rows[7].payload_bytes == 6_000_000
    assert [r.page_id for r in warc.fetch(index.where("page_id = 9"), folder).collect()] == [9]
    empty, where = warc.bundle(pages.limit(0), folder=str(tmp_path / "e"))
    assert warc.read_archives(empty, where).count() == 0


def test_files_of_a_hot_directory_inherit(spark):
    rows = [(f"big/src/f{i}.py", None, 0.0, False) for i in range(300)] + [(f"d{i}/x/y.py", None, 0.0, False) for i in range(40)] \
        + [("big/LICENSE", "MIT", 1.0, True), ("d7/LICENSE", "ISC", 0.9, True), (None, None, 0.0, False)]
    scanned = spark.createDataFrame(rows, "path string, license string, similarity double, is_license_file boolean")
    got = {r.path: (r.effective_license, r.inherited_from, r.depth_up)
           for r in licenses.inherit(scanned.withColumn("_of", F.lit(1)).repartition(5)).collect()}
    assert len(got) == len(rows) and got[None] == (None, None, None)
    for path, own, *_ in rows[:-1]:
        top = path.split("/")[0]
        lic = {"big": "MIT", "d7": "ISC"}.get(top)
        assert got[path] == ((own, None, None) if own else (lic, top if lic else None, 1 if lic else None)), path
