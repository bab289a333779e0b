"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelens.llm import (byte_bpe, conversation_repair, flat_graph, jump_shards, language_id, license_scan, ngram_jaccard, packing, phrase_mining,
                          text_density, toxicity, url_rules, voronoi_knn)
from hirelens.llm.common import small_batches, table

RANK_FILE = "byte_bpe_multi_50k.tiktoken"
SHARDS = 16
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow")]


def op1_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voronoi_knn.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_flat_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_graph.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_density.extract(table(spark, sf_dir, "pages"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(RANK_FILE),
                           public_tokenizers.PATTERN, digests=True)


def op6_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), toxicity.training_rows())
    return toxicity.score(docs, model, spans=False)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"), findings=False)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.join(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs, language_id.training_rows()))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def op12_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jump_shards.slots(table(spark, sf_dir, "documents"), SHARDS)


def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.mine(table(spark, sf_dir, "documents"))


def _with_small_batches(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _with_small_batches(f) for f in (
        op1_voronoi_knn, op2_flat_graph, op3_text_density, op4_url_rules, op5_byte_bpe, op6_toxic_spans,
        op7_best_fit_packing, op8_license_scan, op9_ngram_jaccard, op10_language_id, op11_conversation_repair,
        op12_jump_shards, op13_phrase_mining)
}

#: CRC-32 by its table of 256 remainders.
_REMAINDERS = """remainders AS (
  SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v FROM range(256) r(i)))"""


def _crc32(text: str) -> str:
    return f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
        list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: ('0x' || x)::BIGINT)),
        lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])))::BIGINT"""


def _edit(before: str, cost: str, letter: str) -> str:
    """SQL for an edit added to a cost (nine digits) and audit in one text, which sorts by both."""
    return f"lpad(({before}[:9]::INTEGER + {cost})::VARCHAR, 9, '0') || {before}[10:] || '{letter}'"


#: The repair as a forward search: for each state (nothing, system, user, assistant) the least text so far.
_REPAIR_ORACLE = rf"""
WITH RECURSIVE {_REMAINDERS},
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32(
      "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations, remainders),
harmed AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
         CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM named),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(len(role) || ':' || role || text), copy) AS i FROM harmed),
judged AS MATERIALIZED (
  SELECT *, role[1] AS r, NOT regexp_matches(text, '[^ 	-
]') AS blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
         regexp_matches(text, '[^.!? 	-
][ 	-
]*$') AS cut_off,
         coalesce(lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au'), false)
           AS illegal FROM placed),
edited AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000' AS n, NULL::VARCHAR AS s, '000000002I' AS u, '000000004II' AS a
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, n, s, u, least(a, {_edit('u', '2', 'I')}) FROM (
    SELECT conv_id, i, n, s, a,
           least(u, {_edit('n', '2', 'I')}, {_edit('s', '2', 'I')}, {_edit('a', '2', 'I')}) AS u
    FROM (
      SELECT e.conv_id, j.i, {_edit('n', '3', 'D')} AS n,
        least({_edit('s', '3', 'D')}, CASE WHEN k AND r = 's' THEN {_edit('n', 'c', 'K')} END) AS s,
        least({_edit('u', '3', 'D')},
              CASE WHEN k AND r = 'u' THEN least({_edit('n', 'c', 'K')}, {_edit('s', 'c', 'K')}, {_edit('a', 'c', 'K')})
                END,
              CASE WHEN k THEN least({_edit('n', '2 + c', 'R')}, {_edit('s', '2 + c', 'R')}, {_edit('a', '2 + c', 'R')})
                END) AS u,
        least({_edit('a', '3', 'D')}, CASE WHEN k AND r = 'a' THEN {_edit('u', 'c', 'K')} END,
              CASE WHEN k THEN {_edit('u', '2 + c', 'R')} END) AS a
      FROM edited e JOIN (SELECT *, NOT blank AND NOT seen AS k, cut_off::INTEGER AS c FROM judged) j
        ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.i = e.i + 1))),
best AS (
  SELECT conv_id, least(arg_max(n, i), arg_max(a, i)) AS b, max(i) AS rows FROM edited GROUP BY conv_id),
-- place in the audit, row, whether an assistant is due, and the repaired lines
written AS (
  SELECT conv_id, b[10:] AS audit, 1::BIGINT AS p, 0::BIGINT AS i, false AS due, NULL::VARCHAR AS lines FROM best
  UNION ALL
  SELECT conv_id, audit, p + 1, i, CASE WHEN line IS NULL THEN due ELSE as_role = 'user' END,
         CASE WHEN line IS NULL THEN lines ELSE coalesce(lines || chr(10), '') || line END
  FROM (
    SELECT w.conv_id, audit, p, due, lines, coalesce(j.i, w.i) AS i,
      CASE WHEN audit[p] = 'K' THEN CASE WHEN r = 'u' THEN 'user' END ELSE fit END AS as_role,
      CASE audit[p] WHEN 'I' THEN fit || ':' WHEN 'R' THEN fit || ':' || text WHEN 'K' THEN role || ':' || text END
        AS line
    FROM (SELECT *, CASE WHEN due THEN 'assistant' ELSE 'user' END AS fit FROM written WHERE p <= len(audit)) w
    LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM w.conv_id AND j.i = w.i + 1 AND audit[p] <> 'I')),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND seen) AS duplicate,
    count(*) FILTER (NOT blank AND NOT seen AND cut_off) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM judged GROUP BY conv_id)
SELECT b.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, b[:9]::BIGINT AS cost, audit,
  sha256(coalesce(lines, '')) AS repaired_sha256
FROM best b JOIN written w ON w.conv_id IS NOT DISTINCT FROM b.conv_id AND p = len(audit) + 1
LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM b.conv_id"""

LLM_ORACLES: dict[str, str] = {
    "op1_voronoi_knn": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.e, d.e)::BIGINT AS score
  FROM v q JOIN v d ON d.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op2_flat_graph": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(id, c) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.c FROM reach r JOIN link l ON l.a = r.id),
least AS (SELECT id, min(c) AS c FROM reach GROUP BY id),
linked AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN least ON id = vec_id LEFT JOIN linked ON a = vec_id""",
    "op4_url_rules": """
WITH rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS r FROM pages),
part AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(r, '^[^/?#]*'), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM rest),
ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM part)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
    "op9_ngram_jaccard": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM w),
e AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n_a, any_value(b.n) AS n_b, count(*) AS c
  FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS MATERIALIZED (SELECT a, b FROM common WHERE 100 * c >= 80 * (n_a + n_b - c)),
reach(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.c FROM reach r JOIN link l ON l.a = r.id),
least AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT doc_id, len(s)::BIGINT AS n_shingles, c AS component_id FROM s JOIN least ON id = doc_id""",
    "op11_conversation_repair": _REPAIR_ORACLE,
    # The walk in 128-bit arithmetic.
    "op12_jump_shards": f"""
WITH RECURSIVE {_REMAINDERS},
d AS MATERIALIZED (
  SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS text FROM documents),
walk(n, k, passed, next) AS (
  SELECT n, CASE WHEN doc_id < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0)::HUGEINT END,
         -1::BIGINT, 0::BIGINT FROM d
  UNION ALL
  SELECT n, k, next, floor((next + 1) * (2147483648.0::DOUBLE / ((k // 8589934592)::BIGINT + 1)::DOUBLE))::BIGINT
  FROM (SELECT n, (k * 2862933555777941757 + 1) % 18446744073709551616 AS k, next FROM walk WHERE next <= 16)),
shard AS (
  SELECT n, max(passed) FILTER (passed < 16)::INTEGER AS shard, max(passed)::INTEGER AS grown_shard FROM walk GROUP BY n)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot, grown_shard
FROM (SELECT n, doc_id, (octet_length(encode(text)) + 1)::BIGINT AS size, {_crc32('text')} AS text_crc32 FROM d, remainders)
JOIN shard USING (n)""",
    "op13_phrase_mining": r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')),
    '[^\x20\x09]+') AS w FROM documents WHERE text IS NOT NULL),
total AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM piece GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, phrase, m, count(*)::HUGEINT AS a FROM (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' ')))
      AS phrase FROM piece, range(1, 6) s(m) WHERE len(w) >= m)
  GROUP BY lang, phrase, m HAVING count(*) >= 100),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1), range(1, 5) c(k) WHERE k < m),
score AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, 1000 * c.a * n // (x.a * y.a) AS score,
         row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 1000 * c.a * n // (x.a * y.a), k) AS least
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = lp JOIN f y ON y.lang = c.lang AND y.phrase = rp
  JOIN total t ON t.lang = c.lang),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM score s
  WHERE least = 1 AND NOT EXISTS (
    SELECT 1 FROM f WHERE f.lang = s.lang AND len(f.phrase) > len(s.phrase) AND 100 * f.a >= 100 * s.a
      AND contains(' ' || f.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000""",
}
