"""Prefix trie, periodic runs and binary token files against brute force."""

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from natspark.llm import queries, runs, tokenbin, trie
from natspark.llm.common import materialize, table
from natspark.session import scratch_path

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ prefix trie

def trie_brute(rows, head_of, base_of):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    paths = {c: tuple(own.get(base_of(c), [])[:head_of(c)] + ts[head_of(c):]) for c, ts in own.items()}
    members = {}
    for c, p in paths.items():
        for d in range(len(p) + 1):
            members.setdefault(p[:d], []).append(c)
    kids = {n: set() for n in members}
    for n in members:
        if n:
            kids[n[:-1]].add(n)
    leaves, saved = {}, {}
    for n in sorted(members, key=len, reverse=True):
        leaves[n] = sum(leaves[k] for k in kids[n]) if kids[n] else 1
        last = len(n[-1][1].encode()) if n else 0
        saved[n] = (len(members[n]) - 1) * last + sum(saved[k] for k in kids[n])
    out = []
    for n, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(paths[c]) == len(n))
        out.append((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie_rows(spark, rows, head, base, shards, part):
    t = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    t = t.withColumn("conv", F.lit("x")).withColumn("path", F.lit(1)).repartition(3)
    turns = materialize(trie.number_turns(t), "t")
    rebuilt = trie.with_borrowed_heads(turns, base, head, most=8)
    got = trie.prefix_trie(rebuilt, shards=shards, part=part)
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("shards,part", [(1, 256), (5, 2), (9, 3), (40, 256)])
def test_trie_equals_brute_force(spark, shards, part):
    rnd = random.Random(shards)
    rows = []
    for c in range(60):
        if c % 10 == 5 or c == 33:
            continue                                    # bases that aren't there
        for turn in range(rnd.randrange(1, 14)):
            rows.append((c, rnd.choice([turn, turn, None]), rnd.choice(["u", "a", None]), rnd.choice(["x", "é", None, ""])))
    rows += [(c, t, "u", "same") for c in range(100, 190) for t in range(5)]          # copies
    rows += [(201, 0, "u", "only")] + [(200, t % 3, "a", "again") for t in range(9)] + [(None, 0, "u", "lost")]
    rnd.shuffle(rows)
    conv = F.col("conv")
    want = trie_brute(rows, lambda c: zlib.crc32(str(c).encode()) % 9, lambda c: c - c % 5)
    got = trie_rows(spark, rows, F.crc32(conv.cast("string").cast("binary")) % 9, conv - conv % 5, shards, part)
    assert got == want


def test_trie_without_conversations_and_with_long_ones(spark):
    zero, conv = F.lit(0), F.col("conv")
    assert trie_rows(spark, [], zero, conv, 4, 8) == []
    assert trie_rows(spark, [(None, 0, "u", "x")], zero, conv, 4, 8) == []
    deep = [(c, t, "u", str(min(t, 50 + c))) for c in range(4) for t in range(90)]
    assert trie_rows(spark, deep, zero, conv, 4, 7) == trie_brute(deep, lambda c: 0, lambda c: c)


def test_splitters_cut_copies_and_bound_the_skeleton(spark):
    rows = spark.createDataFrame([(c, 0, b"", b"k" * 32, [1, 2], False, b"") for c in range(400)],
                                 "conv long, part int, anchor binary, path binary, sizes array<long>, more boolean, "
                                 "next_anchor binary")
    cuts = trie.splitters(rows, 8)
    assert len(cuts) == 7 and len({c[3] for c in cuts}) == 7
    assert len(trie.skeleton(cuts)) == 3
    sizes = np.diff([-1, *[c[3] for c in cuts], 400])
    assert sizes.max() < 200


# ---------------------------------------------------------------- periodic runs

def runs_brute(w, least=6):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        x = 0
        while x + q < n:
            y = x
            while y + q < n and w[y] == w[y + q]:
                y += 1
            length = y - x + q
            if y > x and length >= max(least, 4 * q) and not any(
                    all(w[i] == w[i + p] for i in range(x, x + length - p)) for p in range(1, q)):
                out.append((x, length, q))
            x = max(y, x + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def collapsed_brute(w, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_equal_brute_force(spark):
    rnd = random.Random(2)
    texts = [None, "", " \t\n", "a", "a a a a a", "a a a a a a", "é " * 30, "x" * 9000 + " y" * 9]
    for _ in range(150):
        k = rnd.choice([1, 2, 3, 40])
        w = [rnd.choice("abcdefghijklmnopqrstuvwxyzäöüßéèàçñABCDEFGH"[:k]) for _ in range(rnd.choice([0, 5, 40, 90]))]
        for _ in range(rnd.randrange(3)):
            p = rnd.choice([1, 2, 3, 4, 5, 8, 13, 16, 21])
            a = [rnd.choice("abc") for _ in range(p)]
            i = rnd.randrange(len(w) + 1)
            w[i:i] = (a * 8)[:rnd.randrange(1, 7 * p)]
        texts.append(rnd.choice([" ", "  ", "\t\r\n"]).join(w))
    fib, nxt = "a", "ab"
    while len(fib) < 300:
        fib, nxt = nxt, nxt + fib
    texts += [" ".join(fib), " ".join(bin(i).count("1") % 2 and "p" or "q" for i in range(300)), " ".join(fib[:21] * 9)]
    texts += texts[-3:]                                 # repeated rows
    docs = spark.createDataFrame([(i if i % 9 else None, t, "x") for i, t in enumerate(texts)],
                                 "doc_id long, text string, runs string").repartition(3)
    got = runs.periodic_runs(docs, chunk_bytes=500)
    assert got.columns == ["doc_id", "text", "n_words", "runs", "collapsed"] and got.count() == len(texts)
    for r in got.collect():
        w = words(r.text)
        want = runs_brute(w)
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(w), want)
        assert r.collapsed == collapsed_brute(w, want)
    assert runs.periodic_runs(docs.limit(0)).count() == 0


def test_runs_query_equals_its_definition(spark):
    docs = table(spark, SF, "documents").collect()
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w = words(d.text)[:]
        h = zlib.crc32(str(d.doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        r = got[d.doc_id]
        if n > 1500 and h % 10:                         # brute force is quadratic
            continue
        found = runs_brute(w)
        some += len(found)
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        assert r.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed_brute(w, found).encode()).hexdigest()
    assert some > 3


# ----------------------------------------------------------------- token files

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(queries.binary_tokenizer())


@pytest.mark.parametrize("block_ids", [64, 256, 1024])
@pytest.mark.parametrize("share", [0.0, 0.5, 0.9, 1.0])
def test_blocks_round_trip(block_ids, share):
    rng = np.random.default_rng(3)
    for ids in (np.empty(0), [7], rng.integers(0, 50257, 3001), [0, 2**32 - 1] * 200, np.full(700, 9),
                np.minimum(rng.zipf(1.3, 5000), 2**31)):
        ids = np.array(ids, np.uint32)
        blocks = tokenbin.pack_blocks(ids, block_ids, share)
        at = np.cumsum([0, *map(len, blocks)])[:-1]
        assert (tokenbin.unpack_blocks(b"".join(blocks), at, block_ids) == ids).all()
        for k, b in enumerate(blocks):                  # no more patches than the share leaves
            low, count, patches, width, high = struct.unpack_from("<IHHBB", b)
            mine = ids[k * block_ids:(k + 1) * block_ids]
            assert low == mine.min() and count + 1 == len(mine)
            assert patches == sum(int(x) - low >= 1 << width for x in mine.tolist()) <= (1 - share) * block_ids
    with pytest.raises(ValueError):
        tokenbin.pack_blocks(np.ones(3, np.uint32), 100)


def test_encoder_equals_the_library(library):
    rnd = random.Random(4)
    marks = [" ", "  ", "\n", "\t", " ", "　", " ", "\x85", "'s", "'ll", "é", "ß", "à", "字", "🙂", "12", "word",
             "Word", ",", "...", "<|endoftext|>", "<|", "\x1c", "\x7f", "_", "́"]
    texts = ["", " ", "a b", " a", "a ", "don't we  'll it's"] + ["".join(rnd.choice(marks) for _ in range(rnd.randrange(40)))
                                                                 for _ in range(800)]
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0, *map(len, raw)])
    enc = tokenbin.UnitEncoder(queries.binary_tokenizer(), keep=100)
    assert enc.by_unit
    for _ in range(2):
        ids, n = enc.encode(np.frombuffer(b"".join(raw), np.uint8), offs)
        ends = np.cumsum(n)
        for t, e, k in zip(texts, ends, n):
            assert ids[e - k:e].tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_files_hold_the_stream_in_id_order(spark, library):
    rows = [(i, f"text number {i} " + "lorem ipsum " * (i % 7), 1) for i in range(70)]
    rows += [(None, "no id", 1), (None, None, 1), (5, "text number 5 again", 1), (7, None, 1), (200, "", 1),
             (201, "word " * 9000, 1), (202, "same", 1), (202, "same", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(4)
    folder = scratch_path(spark, "t-ids")
    index = tokenbin.write_ids(docs, queries.binary_tokenizer(), folder, file_ids=300, chunk_bytes=500, block_ids=64,
                               tasks=2)
    got = tokenbin.read_documents(index, folder, with_ids=True).orderBy("start").collect()
    assert len(got) == len(rows) and index.count() > 2
    assert [r.id for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    at = 0
    for r in got:
        assert (r.start, r.n_ids) == (at, len(r.ids)) and r.ids[-1] == 0
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_ids
    want = sorted(library.encode(t or "", add_special_tokens=False).ids + [0] for _, t, _ in rows)
    assert sorted(r.ids for r in got) == want
    # any span, from its blocks alone
    one = index.orderBy(F.desc("n_ids")).first()
    fs, _ = tokenbin.filesystem(folder)
    with fs.open_input_file(one.file) as f:
        reader = tokenbin.TokenReader(f, f.size())
        whole = reader.span(0, reader.n_ids)
        for a, n in ((0, 1), (63, 2), (500, 700), (reader.n_ids - 1, 1), (3, 0)):
            assert reader.span(a, n).tolist() == whole[a:a + n].tolist()
        pieces = [(d, p.tolist(), last) for d, p, last in reader.documents(run_ids=300)]
        assert [x for _, p, _ in pieces for x in p] == whole.tolist()
        assert sum(last for *_, last in pieces) == one.n_docs
    empty = tokenbin.write_ids(docs.limit(0), queries.binary_tokenizer(), scratch_path(spark, "t-none"))
    assert tokenbin.read_documents(empty, folder).count() == 0


def test_token_query_equals_the_library(spark, library):
    docs = sorted(table(spark, SF, "documents").select("doc_id", "text").collect())
    got = sorted(queries.op13_token_files(spark, SF).collect())
    at = 0
    for d, r in zip(docs, got, strict=True):
        ids = library.encode(d.text or "", add_special_tokens=False).ids + [0]
        assert tuple(r) == (d.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
