"""The operators as queries over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docrel.llm import (alignment, collocations, exact_dedup, langid, mixing, order_minhash,
                        packing, quality, secret_scan, sharding, simhash, surrogates, token_counts)
from docrel.llm.common import documents


def op1_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order MinHash of every document, its edited text and the next document."""
    return order_minhash.edited_report(documents(spark, sf_dir))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cost-balanced packing of all documents into sequences of 2048 tokens."""
    return packing.pieces(documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min-cost-flow mix of all documents: weights 5, 2, 1, 150 % of all words."""
    return mixing.report(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate groups of all documents, with a heavy-hitter split."""
    return exact_dedup.membership(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after edits, by segment trees."""
    return token_counts.report(documents(spark, sf_dir))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by error-correcting output codes."""
    return langid.identified(documents(spark, sf_dir))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document through a blob ledger."""
    return secret_scan.report(documents(spark, sf_dir))


#: Key of the surrogates that the query draws; a deployment passes its own secret.
SURROGATE_KEY = "public-demonstration-key"


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced by surrogates."""
    return surrogates.scrubbed(documents(spark, sf_dir), SURROGATE_KEY)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by class dictionaries."""
    docs = documents(spark, sf_dir)
    return quality.scored(docs, quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate components of all documents."""
    return simhash.grouped(documents(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best phrases of each language of all documents, by count transducers."""
    return collocations.collocations(documents(spark, sf_dir))


def op12_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by rendezvous hashing of their ids."""
    return sharding.report(documents(spark, sf_dir))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers over all documents."""
    return alignment.report(documents(spark, sf_dir))


def queries() -> dict:
    return {f.__name__: f for f in (op1_order_minhash, op2_packing, op3_mixing, op4_exact_dedup,
                                    op5_token_counts, op6_langid, op7_secrets, op8_surrogates,
                                    op9_quality, op10_simhash, op11_collocations, op12_rendezvous, op13_alignment)}


OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))), 1, 15) AS key
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM d GROUP BY source),
fill AS (  -- each round stops the targets that are over twice their source's size
  SELECT 0 AS round, source, source_size, weight, false AS at_cap,
         (SELECT 1.5 * sum(source_size) FROM src)::DOUBLE AS left_over FROM src
  UNION ALL
  SELECT round + 1, source, source_size, weight, at_cap OR hits,
         left_over - sum(CASE WHEN hits AND NOT at_cap THEN 2.0 * source_size ELSE 0 END) OVER ()
  FROM (SELECT *, (NOT at_cap) AND left_over * weight / sum(CASE WHEN at_cap THEN 0 ELSE weight END) OVER ()
                  > 2 * source_size AS hits FROM fill) f
  WHERE round < 60),
target AS (
  SELECT source, source_size,
         CASE WHEN at_cap THEN 2.0 * source_size
              ELSE left_over * weight / sum(CASE WHEN at_cap THEN 0 ELSE weight END) OVER () END AS target
  FROM fill WHERE round = 60),
need AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE round_even(target, 0)::BIGINT // source_size END AS passes,
         CASE WHEN source_size = 0 THEN 0 ELSE round_even(target, 0)::BIGINT % source_size END AS more
  FROM target),
run AS (
  SELECT d.doc_id, d.size, n.source_size, n.target, n.passes, n.more,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key) AS upto
  FROM d JOIN need n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target,
       (passes * size + CASE WHEN more > 0 AND 2 * upto - size <= 2 * more THEN size ELSE 0 END)::BIGINT AS taken
FROM run
"""


# CRC-32 is folded over the bytes by its table, which SQL makes by the polynomial.
OP12_SQL = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
           list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
body AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         coalesce('k' || doc_id, 'null') AS key FROM documents),
d AS (
  SELECT rid, doc_id, key, strlen(text)::BIGINT + 16 AS size,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               regexp_extract_all(hex(text), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM body, crc_table),
scores AS (
  SELECT rid, s AS shard, -ln((('0x' || substr(md5('shard-1|' || s || '|' || key), 1, 13))::BIGINT + 0.5)
                             / 4503599627370496.0) AS score
  FROM body, range(41) r(s)),
won AS (
  SELECT rid, arg_min(shard, (score, shard)) FILTER (shard < 40) AS shard, arg_min(shard, (score, shard)) AS grown
  FROM scores GROUP BY rid)
SELECT doc_id, size, crc AS text_crc32, 'key' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, crc) - 1 AS slot,
       grown::INTEGER AS grown_shard
FROM d JOIN won USING (rid)
"""

OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT row_number() OVER () AS pid, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
w AS (SELECT pid, lang, unnest(w) AS w1, unnest(range(len(w))) AS i FROM p),
t AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY pid ORDER BY i)),
f AS (
  SELECT lang, 1 AS k, w1 AS phrase, [w1] AS words, count(*)::HUGEINT AS f FROM t GROUP BY lang, w1
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, [w1, w2], count(*) FROM t WHERE w2 IS NOT NULL GROUP BY lang, w1, w2
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, [w1, w2, w3], count(*) FROM t WHERE w3 IS NOT NULL
  GROUP BY lang, w1, w2, w3),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 10),
cut AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, r.k1, l.f AS l, r2.f AS r, (1000000 * c.f * c.f) // (l.f * r2.f) AS score
  FROM c JOIN range(1, 3) r(k1) ON r.k1 < c.k
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:r.k1], ' ')
  JOIN f r2 ON r2.lang = c.lang AND r2.phrase = array_to_string(c.words[r.k1 + 1:], ' ')),
least AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k1) = 1),
gone AS (
  SELECT DISTINCT s.lang, s.phrase
  FROM c s JOIN (SELECT lang, f, unnest([array_to_string(words[1:2], ' '), array_to_string(words[2:3], ' ')]) AS phrase
                 FROM c WHERE k = 3) g ON g.lang = s.lang AND g.phrase = s.phrase
  WHERE 100 * g.f >= 50 * s.f),
ranked AS (
  SELECT least.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM least ANTI JOIN gone USING (lang, phrase))
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": OP3_SQL, "op4_exact_dedup": OP4_SQL, "op11_collocations": OP11_SQL,
            "op12_rendezvous": OP12_SQL}
