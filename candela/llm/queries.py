"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.llm.chat_format import prefix_trees, read_back, with_probe
from candela.llm.common import documents
from candela.llm.conversation_trie import conversation_trie
from candela.llm.exact_dedup import exact_duplicates
from candela.llm.license_scan import SHARE, SLACK, TEMPLATES, license_report
from candela.llm.lm_score import lm_scores
from candela.llm.mixing import mix_report
from candela.llm.packing import pack
from candela.llm.secret_scan import secret_report
from candela.llm.sharding import assign_shards
from candela.llm.simhash import near_duplicates
from candela.llm.spelling import spelling_variants
from candela.llm.topk import scaled, top_k
from candela.llm.toxicity import toxicity_report


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(documents(spark, sf_dir)).drop("n_chunks")


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(documents(spark, sf_dir)).drop("draws")


def op4_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (assign_shards(documents(spark, sf_dir), shards=24)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir)).drop("costly")


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (near_duplicates(documents(spark, sf_dir))
            .select("doc_id", "fingerprint", "component_id"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_probe(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return read_back(*prefix_trees(rows))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity_report(documents(spark, sf_dir), labels).drop("n_spans")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = scaled(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(documents(spark, sf_dir))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))


_TEMPLATE_ROWS = ",\n  ".join(
    f"({t}, '{x.label}', {str(x.whole).lower()}, {list(x.words)})" for t, x in enumerate(TEMPLATES))

OP1_SQL = rf"""
WITH tp(t, label, whole, w) AS (VALUES
  {_TEMPLATE_ROWS}),
tg AS (SELECT t, label, whole, len(w) - 1 AS n, p, w[p + 1] AS w0, w[p + 2] AS w1
       FROM tp, unnest(range(0, len(w) - 1)) AS u(p)),
d AS (SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dg AS (SELECT doc_id, i, w[i + 1] AS w0, w[i + 2] AS w1 FROM d, unnest(range(0, len(w) - 1)) AS u(i)),
v AS (SELECT DISTINCT doc_id, t, label, whole, n, i - p AS diag, p FROM dg JOIN tg USING (w0, w1)),
dd AS (SELECT DISTINCT doc_id, t, whole, diag FROM v),
gap AS (SELECT *, CASE WHEN whole THEN 1
               WHEN diag - lag(diag) OVER (PARTITION BY doc_id, t ORDER BY diag) <= {SLACK} THEN 0 ELSE 1 END AS cut FROM dd),
isl AS (SELECT *, sum(cut) OVER (PARTITION BY doc_id, t ORDER BY diag) AS island FROM gap),
vi AS (SELECT v.*, isl.island FROM v JOIN isl USING (doc_id, t, diag)),
-- Phrases: each diagonal alone.  Notices: any stretch of one island that is no wider than the notice.
win AS (
  SELECT e.doc_id, e.t, e.label, e.whole, e.island, e.diag AS last, min(a.diag) AS s0, count(DISTINCT a.p)::DOUBLE / e.n AS cover
  FROM (SELECT DISTINCT doc_id, t, label, whole, n, island, diag FROM vi) e
  JOIN vi a ON a.doc_id = e.doc_id AND a.t = e.t AND a.island = e.island AND a.diag BETWEEN e.diag - e.n AND e.diag
  GROUP BY e.doc_id, e.t, e.label, e.whole, e.island, e.diag, e.n),
sp AS (SELECT doc_id, t, label, whole, island, min(s0) AS s0, max(cover) AS cover FROM win GROUP BY doc_id, t, label, whole, island),
ok AS (SELECT * FROM sp WHERE CASE WHEN whole THEN cover = 1 ELSE cover >= {SHARE} END),
per AS (SELECT doc_id, count(*) FILTER (WHERE whole) AS n_base,
               min(s0) FILTER (WHERE whole) AS first_word, max(s0) FILTER (WHERE whole) AS last_word,
               array_to_string(list_sort(list(DISTINCT label) FILTER (WHERE whole)), ',') AS base_labels,
               array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(cover) AS score
        FROM ok GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN per USING (doc_id)
"""

OP2_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g USING (t)
"""

#: Levels are found by trying each source as the first that is not capped; the largest feasible wins.
OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
  FROM d GROUP BY source),
r AS (SELECT *, 3.0 * source_size / w AS ratio FROM s),
lv AS (
  SELECT a.ratio AS ratio,
         ((SELECT sum(source_size) FROM s) - coalesce((SELECT sum(3.0 * source_size) FROM r b WHERE b.ratio < a.ratio), 0))
         / (SELECT sum(w) FROM r b WHERE b.ratio >= a.ratio) AS level
  FROM r a),
l AS (SELECT max(level) FILTER (WHERE level < ratio) AS level FROM lv),
tg AS (SELECT source, source_size, least(3.0 * source_size, coalesce(level * w, 3.0 * source_size))::DOUBLE AS target FROM r, l),
p AS (
  SELECT d.doc_id, d.size, tg.source_size, tg.target, round(tg.target)::BIGINT AS axis,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY
           substr(md5(d.doc_id::VARCHAR || ':' || md5(d.t)), 1, 8), d.doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN tg ON d.source IS NOT DISTINCT FROM tg.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, axis - start)) + greatest(0, least(size, axis - source_size - start))
        + greatest(0, least(size, axis - 2 * source_size - start)))::BIGINT AS taken
FROM p
"""

OP8_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (SELECT *, replace(replace(t, '\', '\\'), '<|', '<\|') AS et,
             replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') AS er FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn, role, t)) AS turns_sha256,
       coalesce(sum(length(t)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(t, '' ORDER BY turn, role, t) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>' || er || chr(10) || et || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

OP10_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.row <> c.row AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
"""


def _crc32_sql(text: str) -> str:
    """DuckDB expression of the CRC-32 of an ASCII or Latin-1 string's UTF-8 bytes (its polynomial, bit by bit)."""
    return f"""(xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(regexp_replace(hex(encode({text})), '(..)', '\\1 ', 'g')[:-2], ' '),
                       lambda y: ('0x' || y)::BIGINT)),
        lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                 lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)),
        4294967295))"""


OP11_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(coalesce(role, '')), sha256(coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32_sql("conv_id::VARCHAR")} % 9 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
own AS (SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY place) AS turns FROM t GROUP BY conv_id),
whole AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), o.turns[c.h + 1:]) AS turns
  FROM c JOIN own o ON o.conv_id = c.conv_id LEFT JOIN own b ON b.conv_id = c.base),
v AS (SELECT conv_id, d AS depth, len(turns) = d AS ends, turns[1:d] AS path, turns[d].x AS last
      FROM whole, unnest(range(0, len(turns) + 1)) AS u(d)),
n AS (
  SELECT path, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * coalesce(any_value(strlen(last)), 0) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM v GROUP BY path),
k AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (path)),
s AS (
  SELECT path[1:d] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM m, unnest(range(0, depth + 1)) AS u(d) GROUP BY 1)
SELECT m.conv_id, m.depth, p.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens, m.ends_sha256
FROM m JOIN s USING (path) LEFT JOIN m p ON m.depth > 0 AND p.path = m.path[1:m.depth - 1]
"""


#: Neighbours by words with one code point left out, not by rotations.
OP13_SQL = f"""
WITH RECURSIVE d AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents),
r AS (SELECT id, run, count(*) AS k FROM d WHERE length(run) >= 5 GROUP BY id, run),
h AS (SELECT run, k, {_crc32_sql("id || ':' || run")} AS h FROM r),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word,
         sum(k)::BIGINT AS n
  FROM h GROUP BY 1 HAVING length(word) >= 5 AND sum(k) >= 3),
g AS (SELECT word, n, i, left(word, i::INT) || substr(word, (i + 2)::INT) AS less FROM w, unnest(range(0, length(word))) AS u(i)),
p AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM g a JOIN g b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, g.n, w.word, w.n FROM g JOIN w ON w.word = g.less
  UNION SELECT w.word, w.n, g.word, g.n FROM g JOIN w ON w.word = g.less),
b AS (SELECT word, n, count(*) AS n_near, min({{'k': -m, 'o': other}}) AS best FROM p GROUP BY word, n),
f AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.k >= 2 * w.n THEN best.o END AS form,
         CASE WHEN -best.k >= 2 * w.n THEN -best.k END AS form_n
  FROM w LEFT JOIN b USING (word)),
x AS (SELECT word, word AS at, form AS next FROM f
      UNION ALL SELECT x.word, f.word, f.form FROM x JOIN f ON f.word = x.next)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, x.at AS root FROM f JOIN x ON x.word = f.word AND x.next IS NULL
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": OP1_SQL, "op2_exact_dedup": OP2_SQL, "op3_mix": OP3_SQL,
            "op8_chat_format": OP8_SQL, "op10_topk": OP10_SQL,
            "op11_conversation_trie": OP11_SQL, "op13_spelling": OP13_SQL}
