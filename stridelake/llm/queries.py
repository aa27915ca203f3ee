"""Queries and SQL of this subpackage; each operator module keeps its own general interface."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.alignment import align_tokens
from stridelake.llm.bytepairs import decode_documents, encode_documents
from stridelake.llm.forest import nearest_neighbours
from stridelake.llm.language import identify
from stridelake.llm.licences import scan_licences
from stridelake.llm.minhash import near_duplicates
from stridelake.llm.packing import pack_documents
from stridelake.llm.pages import extract_text
from stridelake.llm.quality import quality_rules
from stridelake.llm.shards import packed_shards
from stridelake.llm.spelling import spelling_variants
from stridelake.llm.subwords import encode_with_dropout
from stridelake.llm.suffixes import remove_earlier_copies


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_with_dropout(_read(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_earlier_copies(_read(spark, sf_dir, "documents"), length=50)
    return out.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed_spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = _read(spark, sf_dir, "documents")
    return packed_shards(documents, tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_read(spark, sf_dir, "documents")).drop("removed_lines")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"), width=4, percent=80)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_read(spark, sf_dir, "documents"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(_read(spark, sf_dir, "documents"))


def op10_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_read(spark, sf_dir, "pages"))


def op9_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks, pattern = tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    coded = decode_documents(encode_documents(_read(spark, sf_dir, "documents"), ranks, pattern), ranks, pattern)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("packed_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_read(spark, sf_dir, "documents"), min_length=6, min_count=5, typo_every=199, ratio=5)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return align_tokens(_read(spark, sf_dir, "documents"), *files, public_tokenizers.PATTERN)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_merge_dropout": op1_merge_dropout,
        "op2_suffix_dedup": op2_suffix_dedup,
        "op3_packing": op3_packing,
        "op4_token_shards": op4_token_shards,
        "op5_quality_rules": op5_quality_rules,
        "op6_minhash": op6_minhash,
        "op7_language": op7_language,
        "op8_licences": op8_licences,
        "op9_hash_forest": op9_hash_forest,
        "op10_page_text": op10_page_text,
        "op11_byte_bpe": op11_byte_bpe,
        "op12_spelling": op12_spelling,
        "op13_alignment": op13_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_quality_rules": OP5_SQL, "op6_minhash": OP6_SQL, "op9_hash_forest": OP9_SQL, "op12_spelling": OP12_SQL}


OP6_SQL = r"""
WITH RECURSIVE toks AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sh AS MATERIALIZED (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ')
    ELSE array_to_string(w[i:i + 3], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM toks WHERE len(w) > 0)),
sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
keys AS MATERIALIZED (
  SELECT doc_id, n, (SELECT 1) AS one, h FROM sizes JOIN
    (SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS h FROM sh GROUP BY doc_id) USING (doc_id)),
node AS MATERIALIZED (SELECT h, min(doc_id) AS v, any_value(n) AS n FROM keys GROUP BY h),
part AS MATERIALIZED (SELECT v, n, s FROM node JOIN sh ON sh.doc_id = node.v),
inter AS MATERIALIZED (
  SELECT a.v AS a, b.v AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM part a JOIN part b ON a.s = b.s AND a.v < b.v
  WHERE 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL),
edge AS MATERIALIZED (
  SELECT a, b FROM inter WHERE 100 * c >= 80 * (na + nb - c)
  UNION SELECT b, a FROM inter WHERE 100 * c >= 80 * (na + nb - c)),
walk AS (
  SELECT v AS root, v FROM node WHERE v IN (SELECT a FROM edge)
  UNION SELECT walk.root, edge.b FROM walk JOIN edge ON edge.a = walk.v WHERE edge.b > walk.root),
comp AS MATERIALIZED (SELECT v, min(root) AS c FROM walk GROUP BY v)
SELECT d.doc_id, coalesce(k.n, 0)::BIGINT AS n_shingles,
  coalesce(comp.c, node.v, d.doc_id) AS component_id,
  coalesce(comp.c, node.v, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN keys k USING (doc_id) LEFT JOIN node USING (h) LEFT JOIN comp ON comp.v = node.v
"""

OP5_SQL = r"""
WITH t AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS x,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ln
  FROM documents),
g AS (
  SELECT doc_id, i, w[i:i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t WHERE len(w) > 2)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM g) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
lines AS MATERIALIZED (
  SELECT doc_id, host, trim(regexp_replace(translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+', ' ', 'g')) AS l
  FROM (SELECT doc_id, host, unnest(ln) AS l FROM t)),
freq AS (SELECT host, l FROM lines GROUP BY host, l HAVING count(DISTINCT doc_id) > 25),
lost AS (SELECT doc_id, sum(length(l)) AS n FROM lines JOIN freq USING (host, l) GROUP BY doc_id),
total AS (SELECT doc_id, sum(length(l)) AS n FROM lines GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lost.n, 0)::BIGINT AS n_removed_chars, coalesce(total.n, 0)::BIGINT AS n
  FROM t LEFT JOIN cov USING (doc_id) LEFT JOIN lost USING (doc_id) LEFT JOIN total USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT 100 * (n - n_removed_chars) < 20 * n AS kept,
  n_removed_chars
FROM base
"""

#: Exact search. The forest's climb finds all neighbours where every query is one of the sample that sets it.
OP9_SQL = r"""
WITH v AS MATERIALIZED (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(
    list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])), lambda x, y: x + y)) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS r FROM pairs)
SELECT query_id, r::INTEGER AS rank, vec_id, score FROM ranked WHERE r <= 10
"""

#: Near words meet by what they are with one code point removed; crc32 goes by a table that its polynomial gives.
OP12_SQL = r"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))),
runs AS MATERIALIZED (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || w AS s, w FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents) WHERE length(w) >= 6),
bytes AS (
  SELECT w, list_transform(range(1, length(x), 2), lambda i:
    16 * strpos('123456789ABCDEF', x[i]) + strpos('123456789ABCDEF', x[i + 1])) AS b
  FROM (SELECT w, hex(encode(s)) AS x FROM runs)),
hashed AS (
  SELECT w, xor(list_reduce(list_prepend(4294967295, b), lambda c, y: xor(t[(xor(c, y) & 255) + 1], c >> 8)), 4294967295) AS h
  FROM bytes, tab),
words AS MATERIALIZED (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN w[1:(h % length(w))] || w[(h % length(w)) + 2:] ELSE w END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5),
less AS MATERIALIZED (
  SELECT DISTINCT word, n, i, word[1:i - 1] || word[i + 1:] AS d FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS MATERIALIZED (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.d = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.d = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS near_n FROM near GROUP BY word),
found AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(best.n_near, 0) AS n_near,
    CASE WHEN best.near_n >= 5 * w.n THEN (SELECT min(x.near) FROM near x WHERE x.word = w.word AND x.near_n = best.near_n) END AS form,
    CASE WHEN best.near_n >= 5 * w.n THEN best.near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS here, 0 AS steps FROM found
  UNION ALL SELECT walk.word, found.form, steps + 1 FROM walk JOIN found ON found.word = walk.here WHERE found.form IS NOT NULL),
roots AS (SELECT word, arg_max(here, steps) AS root FROM walk GROUP BY word)
SELECT word, form, root, n::BIGINT AS n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM found JOIN roots USING (word)
"""
