"""The registered queries of this subpackage, and DuckDB SQL with the same rows where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from quarterdeck.llm import alignment, bpe, exact_dedup, line_dedup, packing, paragraphs, phrases, shards, simhash, spelling, topk, toxicity, wavelet
from quarterdeck.llm.common import table

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraphs.repeated_text(table(spark, sf_dir, "documents"))


@query
def op2_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shards.minimax_shards(table(spark, sf_dir, "documents"))
    return rows.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query
def op3_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_products(table(spark, sf_dir, "embeddings"))


@query
def op4_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op5_simhash_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


@query
def op6_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded_digests(table(spark, sf_dir, "documents"))


@query
def op7_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.round_trip(table(spark, sf_dir, "documents"))


@query
def op8_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


@query
def op12_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op13_pointer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_counts(table(spark, sf_dir, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL

ORACLE["op3_norm_buckets"] = """
WITH good AS (
  SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::HUGEINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM good q JOIN good c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""

ORACLE["op9_line_dedup"] = r"""
WITH pieces AS (
  SELECT doc_id, string_split(text, chr(10)) AS p FROM documents
), lines AS (
  SELECT doc_id, i::INT - 1 AS line_no, trim(p[i], ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line
  FROM pieces, unnest(range(1, len(p) + 1)) AS t(i)
), own AS (
  SELECT line, length(line) AS n, min(struct_pack(d := doc_id, l := line_no)) AS first
  FROM lines WHERE line <> '' GROUP BY line
), wide AS (
  SELECT line, first, unnest([n, n + 1]) AS at FROM own WHERE n >= 20
), near AS (
  SELECT a.line AS x, b.line AS y, a.first AS xf, b.first AS yf
  FROM wide a JOIN own b ON b.n = a.at AND a.line <> b.line
  WHERE levenshtein(a.line, b.line) <= 1
), earlier AS (
  SELECT line, min(f) AS f FROM (SELECT x AS line, yf AS f FROM near UNION ALL SELECT y, xf FROM near) GROUP BY line
), keep AS (
  SELECT own.line, least(own.first, coalesce(earlier.f, own.first)) AS k FROM own LEFT JOIN earlier USING (line)
)
SELECT doc_id, line_no, k.d AS keep_doc_id, k.l AS keep_line_no, (k.d = doc_id AND k.l = line_no) AS kept
FROM lines JOIN keep USING (line)
"""

ORACLE["op10_exact_dedup"] = r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
       doc_id = first_value(doc_id) OVER best AS kept, sha256(body) AS text_sha256
FROM rows WINDOW best AS (PARTITION BY body ORDER BY chars DESC, doc_id)
"""

#: DuckDB has no CRC-32, so it is folded over the bytes with the table of the reflected polynomial 0xEDB88320.
ORACLE["op11_spelling_variants"] = r"""
WITH RECURSIVE table_steps AS (
  SELECT range AS i, range::BIGINT AS v, 0 AS k FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, k + 1 FROM table_steps WHERE k < 8
), crc AS (
  SELECT list(v ORDER BY i) AS t FROM table_steps WHERE k = 8
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents
), named AS (
  SELECT d, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
  FROM runs WHERE length(run) >= 5 GROUP BY ALL
), digests AS (
  SELECT run, times, hex(encode(d || ':' || run)) AS h FROM named
), hashed AS (
  SELECT run, times, xor(list_reduce(
    list_transform(range(0, length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT),
    lambda a, b: xor(a // 256, t[xor(a % 256, b) + 1]), 4294967295::BIGINT), 4294967295) AS c
  FROM digests, crc
), spelt AS (
  SELECT CASE WHEN c % 97 = 0 THEN substr(run, 1, c % length(run)) || substr(run, c % length(run) + 2) ELSE run END AS word, times FROM hashed
), vocab AS (
  SELECT word, sum(times)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS hole FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)
), near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b ON a.i = b.i AND a.hole = b.hole AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN vocab b ON a.hole = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN vocab b ON a.hole = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m FROM near GROUP BY word
), forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN m >= 2 * v.n THEN (SELECT min(other) FROM near x WHERE x.word = v.word AND x.m = best.m) END AS form,
         CASE WHEN m >= 2 * v.n THEN m END AS form_n
  FROM vocab v LEFT JOIN best USING (word)
), path AS (
  SELECT word, word AS at FROM forms
  UNION ALL
  SELECT p.word, f.form FROM path p JOIN forms f ON p.at = f.word WHERE f.form IS NOT NULL
), roots AS (
  SELECT p.word, p.at AS root FROM path p JOIN forms f ON p.at = f.word WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n FROM forms JOIN roots USING (word)
"""

ORACLE["op12_positional_index"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL
), windows AS (
  SELECT item_id, least(len(w), 10) AS n, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i : i + 9])) AS p
  FROM items WHERE len(w) > 0
), widths AS (
  SELECT DISTINCT n FROM windows
), spots AS (
  SELECT r, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM docs, widths WHERE len(w) >= n
), hits AS (
  SELECT s.r, s.i, s.n, v.item_id FROM (SELECT r, n, i, w[i : i + n - 1] AS p FROM spots) s JOIN windows v ON s.n = v.n AND s.p = v.p
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT r, i, unnest(range(0, n)) AS k FROM hits) GROUP BY r
), found AS (
  SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits WHERE item_id IS NOT NULL GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""
