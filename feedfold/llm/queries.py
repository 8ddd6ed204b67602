"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedfold.llm import ann, bpe, fim, lines, neardup, packing, pii, quality, rans, secrets, sharding, spelling, wrappers
from feedfold.llm.common import table

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"


def op5_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op6_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.resolve(table(spark, sf_dir, "documents"), k=4, percent=80)
    return found.selectExpr("d AS doc_id", "n AS n_shingles", "component AS component_id", "d <=> component AS kept")


def op7_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op1_line_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs).select("doc_id", "text", "n_deleted")


#: Shortest runs of 50 words from and up to each line, as text; a run that an earlier place also has goes.
OP1_SQL = r"""
WITH marked AS (
  SELECT doc_id, list_transform(string_split(text, chr(10)),
    lambda x: struct_pack(line := x, w := len(list_filter(regexp_split_to_array(x, '[ 	-
]+'), lambda y: y <> '')))) AS ls,
    text FROM documents),
worded AS (SELECT doc_id, text, list_filter(ls, lambda x: x.w > 0) AS ls FROM marked),
lines AS (
  SELECT doc_id, generate_subscripts(ls, 1) AS p, unnest(list_transform(ls, lambda x: x.line)) AS line,
    unnest(list_transform(ls, lambda x: x.w)) AS w FROM worded),
summed AS (SELECT *, sum(w) OVER (PARTITION BY doc_id ORDER BY p) AS upto FROM lines),
pairs AS (
  SELECT a.doc_id, a.p AS s, min(b.p) AS e FROM summed a JOIN summed b
    ON a.doc_id = b.doc_id AND b.p >= a.p AND b.p < a.p + 50 AND b.upto - a.upto + a.w >= 50 GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.p) AS s, b.p AS e FROM summed a JOIN summed b
    ON a.doc_id = b.doc_id AND b.p >= a.p AND b.p < a.p + 50 AND b.upto - a.upto + a.w >= 50 GROUP BY ALL),
runs AS (
  SELECT r.doc_id, r.s, r.e, md5(array_to_string(list_transform(ls[r.s:r.e], lambda x: x.line), chr(10))) AS k
  FROM pairs r JOIN worded d USING (doc_id)),
later AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS n FROM runs),
gone AS (
  SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(s, e + 1)) AS p FROM later WHERE n > 1) GROUP BY 1),
numbered AS (
  SELECT m.doc_id, m.text, list_transform(range(1, len(ls) + 1), lambda i: struct_pack(line := ls[i].line, w := ls[i].w,
    p := len(list_filter(ls[1:i], lambda y: y.w > 0)))) AS ls FROM marked m)
SELECT n.doc_id, CASE WHEN ps IS NULL THEN n.text ELSE
  array_to_string(list_transform(list_filter(n.ls, lambda x: x.w = 0 OR NOT list_contains(ps, x.p)), lambda x: x.line), chr(10)) END AS text,
  coalesce(len(ps), 0) AS n_deleted
FROM numbered n LEFT JOIN gone USING (doc_id)
"""


def op2_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wrappers.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op3_rans_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), end_id=0)


def op4_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), end_id=2)
    return placed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op8_assignment_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"))


def op9_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op10_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op11_block_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(table(spark, sf_dir, "documents"))


OP11_SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || doc_id) AS d FROM documents),
drawn AS (
  SELECT doc_id, x, CAST(length(x) AS BIGINT) AS n,
    list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(d, i, 8) AS BIGINT)) AS h FROM texts),
cut AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
         WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (
  SELECT *, '<P>' || substr(x, 1, a) AS p, '<M>' || substr(x, a + 1, b - a) AS m, '<S>' || substr(x, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN p || s || m ELSE s || p || m END) AS output_sha256,
  sha256(x) AS restored_sha256
FROM parts
"""


def op12_sorted_list_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


#: Checksums byte by byte; words one edit apart by the words that are left without one letter.
OP12_SQL = """
WITH RECURSIVE steps AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS c
    FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256)))),
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents) GROUP BY 1, 2),
summed AS (
  SELECT doc_id, w, k, xor(4294967295, list_reduce(
    flatten(list_transform(string_split(doc_id || ':' || w, ''),
      lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, unicode(c) - 64] END)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), CAST(4294967295 AS BIGINT))) AS h
  FROM runs, steps),
words AS (
  SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM summed)
  WHERE length(word) >= 5 GROUP BY 1 HAVING sum(k) >= 3),
less AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (
  SELECT w.word, w.n, count(other) AS n_near, max(m) AS top, arg_min(other, (-m, other)) AS first
  FROM words w LEFT JOIN near USING (word) GROUP BY 1, 2),
forms AS (
  SELECT word, n, n_near, CASE WHEN top >= 2 * n THEN first END AS form, CASE WHEN top >= 2 * n THEN top END AS form_n FROM best),
chain AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT c.word, f.form FROM chain c JOIN forms f ON c.at = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.at AS root FROM chain c JOIN forms f ON c.at = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e USING (word)
"""


def op13_bounded_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


QUERIES = {
    "op1_line_suffix_array": op1_line_suffix_array,
    "op2_wrapper_extraction": op2_wrapper_extraction,
    "op3_rans_token_store": op3_rans_token_store,
    "op4_vector_packing": op4_vector_packing,
    "op5_pruned_graph": op5_pruned_graph,
    "op6_hyperminhash": op6_hyperminhash,
    "op7_bpe_segment_tree": op7_bpe_segment_tree,
    "op8_assignment_secrets": op8_assignment_secrets,
    "op9_weak_supervision": op9_weak_supervision,
    "op10_boosted_pii": op10_boosted_pii,
    "op11_block_rotation": op11_block_rotation,
    "op12_sorted_list_variants": op12_sorted_list_variants,
    "op13_bounded_ring": op13_bounded_ring,
}

SQL: dict[str, str] = {
    "op1_line_suffix_array": OP1_SQL,
    "op11_block_rotation": OP11_SQL,
    "op12_sorted_list_variants": OP12_SQL,
}
