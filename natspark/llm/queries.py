"""The registered queries of the corpus operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from natspark.llm import (chat, ctph, langid, lattice, licenses, mih, mixing, neardup, runs, sentencepiece, tokenbin,
                          trie, warc)
from natspark.llm.common import bounded_batches, id_remainder, materialize, table
from natspark.session import scratch_path


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_sources(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return plan.select(F.col("doc.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op2_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.transform("mask", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return (chat.rotate(table(spark, sf_dir, "conversations")).withColumnRenamed("conv", "conv_id")
            .withColumn("mask", F.array_join(spans, ";")))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    model = langid.fit(docs.where(id_remainder(F.col("doc_id"), 5) != 0))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    span = F.transform("spans", lambda s: F.concat(s["start"], F.lit("-"), s["end"], F.lit(":"), s["lang"]))
    return (langid.identify(rows, model).withColumn("spans", F.array_join(span, ";")).drop("text"))


def tokenizer_path() -> str:
    """The public tokenizer file that the registered queries use."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = sentencepiece.read_model(tokenizer_path())
    return sentencepiece.encode(docs, model, outputs=("n_tokens", "ids_sha256", "decoded_sha256")
                                ).drop("text")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Params(shingle_words=2))
    return found.select(F.col("id").alias("doc_id"), "n_shingles",
                        F.col("component").alias("component_id"), "kept")


def op8_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder(F.col("doc_id"), 10) == 0, F.lit(False))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return lattice.score(rows, id_remainder(F.col("doc_id"), 10) != 0,
                         sentencepiece.read_model(tokenizer_path()))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.neighbours(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, folder = warc.bundle(table(spark, sf_dir, "pages"))
    return warc.read_archives(index, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files: a source is a tree with a folder per language,
    thousand and hundred of ids."""
    folder = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")),
                         F.expr("doc_id div 1000"), F.expr("doc_id div 100"))
    files = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(folder, F.lit("/"), F.col("doc_id"), F.lit(".txt")).alias("path"), "text")
    return licenses.inherit(licenses.scan(files)).drop("header")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of rebuilt conversations: each takes its first turns from the
    one whose id ends in 0 or 5."""
    turns = materialize(trie.number_turns(table(spark, sf_dir, "conversations")), "op11-turns")
    conv = F.col("conv")
    rebuilt = trie.with_borrowed_heads(turns, conv - conv % 5, id_remainder(conv, 9), most=8)
    return trie.prefix_trie(rebuilt).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


def tiled_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text): of documents whose crc32(doc_id) ends in 0, the words
    from some place on are replaced by repetitions of the first few of them;
    the others stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    rows = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    rows = rows.withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    tiled = F.expr("array_join(concat(slice(words, 1, a), slice(flatten(array_repeat(slice(words, a + 1, p), "
                   "cast(ceil((n - a) / p) as int))), 1, n - a)), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, tiled).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    found = runs.periodic_runs(tiled_texts(table(spark, sf_dir, "documents")))
    line = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]),
                                                               F.lit("\n"))), "")
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
                    F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
                    F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
                    F.sha2(line, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


def binary_tokenizer() -> str:
    """The content of the public tokenizer file of the binary token files."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        return f.read()


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    folder = scratch_path(spark, "token-files")
    index = tokenbin.write_ids(table(spark, sf_dir, "documents"), binary_tokenizer(), folder)
    return tokenbin.read_documents(index, folder).select(
        F.col("id").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_chat_perspectives": op2_chat_perspectives,
    "op3_language_id": op3_language_id,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_multi_index_hashing": op6_multi_index_hashing,
    "op7_fingerprints": op7_fingerprints,
    "op8_lattice_score": op8_lattice_score,
    "op9_license_scan": op9_license_scan,
    "op10_warc": op10_warc,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_files": op13_token_files,
}

# The same mix from the definition: limits by water level, then one running
# sum per source in key order.
_OP1 = r"""
WITH d AS (
  SELECT doc_id, source, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) - 1 AS n FROM d GROUP BY source),
w AS (SELECT *, CASE n % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w,
             3 * source_size AS lim FROM s),
r AS (SELECT *, lim / w AS ratio FROM w),
c AS (SELECT *, coalesce(sum(lim) OVER e, 0) AS lims, coalesce(sum(w) OVER e, 0) AS ws,
             sum(source_size) OVER () AS total, sum(w) OVER () AS allw
      FROM r WINDOW e AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, CAST(total - lims AS DOUBLE) / (allw - ws) AS level FROM c),
h AS (SELECT arg_min(level, (ratio, coalesce('s' || source, 't'))) AS share FROM l WHERE level <= ratio),
t AS (SELECT source, source_size, least(CAST(lim AS DOUBLE), share * w) AS target FROM l, h),
b AS (SELECT *, CAST(floor(target + 1e-6) AS BIGINT) AS budget FROM t),
p AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.budget,
             CASE WHEN b.source_size > 0 THEN b.budget // b.source_size ELSE 0 END AS epochs,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - d.size AS run
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + least(greatest(budget - epochs * source_size - run, 0), size) AS BIGINT) AS taken
FROM p
"""

# Pieces in order, joined; a span begins after what all earlier pieces and the
# own head take.
_OP2 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS who, replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations),
p AS (SELECT DISTINCT conv_id, who AS speaker FROM t WHERE who <> 'system'),
x AS (SELECT t.conv_id, p.speaker, coalesce(turn // 1024, 4611686018427387904) AS part, turn, who, body,
             who = p.speaker AS own,
             '<|im_start|>' || CASE WHEN who = p.speaker THEN 'assistant' WHEN who = 'system' THEN who
                                    ELSE 'user name=' || replace(who, '<|', '< |') END || chr(10) AS head
      FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
z AS (SELECT *, row_number() OVER (w ORDER BY turn NULLS LAST, who, body) AS n, count(*) OVER w AS rows_of_part
      FROM x WINDOW w AS (PARTITION BY conv_id, speaker, part)),
q AS (SELECT *, CASE WHEN rows_of_part > 1024 THEN (n - 1) // 1024 ELSE 0 END AS piece FROM z),
y AS (SELECT *,
             coalesce(sum(length(head) + length(body) + 11) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             + length(head) AS pos
      FROM q WINDOW o AS (PARTITION BY conv_id, speaker, part, piece ORDER BY n))
SELECT conv_id, speaker, part, CAST(piece AS BIGINT) AS piece, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       string_agg(head || body || '<|im_end|>' || chr(10), '' ORDER BY n) AS rendered,
       coalesce(string_agg(CAST(pos AS BIGINT) || '-' || CAST(pos + length(body) + 10 AS BIGINT), ';' ORDER BY n)
                FILTER (own), '') AS mask
FROM y GROUP BY conv_id, speaker, part, piece
"""

# The trie from the definition: a node is a depth and the turns so far; what a
# subtree holds is summed over its nodes' smallest members.  crc32 is a fold
# over the bits of the decimal id.
_OP11 = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS who, coalesce(text, '') AS body,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
bits AS (
  SELECT c, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
           lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda x, e: CASE WHEN e >= 0 THEN xor(x, e) WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS x
  FROM (SELECT DISTINCT c FROM t)),
k AS (SELECT c, c - c % 5 AS base, xor(x, 4294967295) % 9 AS head FROM bits),
got AS (SELECT k.c, k.head, count(t.c) AS got FROM k LEFT JOIN t ON t.c = k.base AND t.pos < k.head GROUP BY ALL),
r AS (
  SELECT k.c, t.pos + 1 AS depth, t.who, t.body FROM k JOIN t ON t.c = k.base AND t.pos < k.head
  UNION ALL
  SELECT t.c, t.pos - head + got + 1, who, body FROM t JOIN got USING (c) WHERE t.pos >= head
  UNION ALL
  SELECT c, 0, '', '' FROM k),
p AS (
  SELECT c, depth, CASE WHEN depth = 0 THEN 0 ELSE strlen(body) END AS bytes,
         md5(string_agg(CASE WHEN depth = 0 THEN '' ELSE md5(who || chr(0) || body) END, '') OVER w) AS path,
         max(depth) OVER (PARTITION BY c) AS size
  FROM r WINDOW w AS (PARTITION BY c ORDER BY depth)),
n AS (
  SELECT depth, path, min(c) AS c, count(*) AS n, max(bytes) AS bytes,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = depth), '')) AS ends
  FROM p GROUP BY depth, path),
up AS (
  SELECT n.*, u.path AS parent_path, u.depth AS parent_depth
  FROM n LEFT JOIN p u ON u.c = n.c AND u.depth = n.depth - 1),
kids AS (SELECT parent_depth AS depth, parent_path AS path, count(*) AS kids FROM up WHERE parent_depth IS NOT NULL GROUP BY ALL),
full_nodes AS (
  SELECT up.*, coalesce(kids, 0) AS kids, parent.c AS parent_conv
  FROM up LEFT JOIN kids USING (depth, path)
  LEFT JOIN n parent ON parent.depth = up.parent_depth AND parent.path = up.parent_path),
sums AS (
  SELECT p.depth, p.path, sum(CAST(f.kids = 0 AS BIGINT)) AS leaves, sum((f.n - 1) * f.bytes) AS saved
  FROM p JOIN full_nodes f ON f.c = p.c AND f.depth >= p.depth GROUP BY ALL)
SELECT f.c AS conv_id, CAST(f.depth AS BIGINT) AS depth, parent_conv AS parent_conv_id, n AS n_convs,
       CAST(kids AS BIGINT) AS n_children, CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       ends AS ends_sha256
FROM full_nodes f JOIN sums USING (depth, path)
"""

ORACLE_SQL = {
    "op11_prefix_trie": _OP11,
    "op2_chat_perspectives": _OP2,
    "op1_mix_sources": _OP1,
}
