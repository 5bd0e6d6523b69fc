"""One query per operator over its whole table, the pipeline, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    byte_bpe,
    embedding_join,
    fingerprints,
    language,
    mixing,
    ngram_join,
    packing,
    periodic_runs,
    token_counts,
    toxicity,
    url_filter,
    vector_codes,
    warc,
)
from strata.llm.common import table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints_and_components(table(spark, sf_dir, "documents"))


def op2_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.embedding_components(table(spark, sf_dir, "embeddings"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_decode(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.plan(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archive(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "warc_date")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_repeats(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digest(periodic_runs.periodic_runs(docs))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_fingerprints, op2_embedding_join, op3_byte_bpe, op4_toxicity, op5_ngram_join, op6_mixing,
              op7_token_counts, op8_warc, op9_language, op10_url_filter, op11_vector_codes, op12_packing, op13_periodic_runs, pipeline)
}

#: op2 compares all vectors of a label directly; components by a recursive walk over the links.
_OP2 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
walk AS (
  SELECT vec_id AS node, vec_id AS reached FROM embeddings
  UNION SELECT w.node, l.b FROM walk w JOIN link l ON w.reached = l.a)
SELECT e.vec_id, (SELECT count(*) FROM link WHERE a = e.vec_id) AS n_links, min(w.reached) AS component_id, e.vec_id = min(w.reached) AS kept
FROM embeddings e JOIN walk w ON w.node = e.vec_id GROUP BY e.vec_id
"""

_SHINGLES = r"""
words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
size AS (SELECT doc_id, count(s) AS n FROM documents LEFT JOIN shingle USING (doc_id) GROUP BY doc_id)"""

_OP5 = f"""
WITH RECURSIVE {_SHINGLES},
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
walk AS (
  SELECT doc_id AS node, doc_id AS reached FROM documents
  UNION SELECT w.node, l.b FROM walk w JOIN link l ON w.reached = l.a)
SELECT s.doc_id, s.n AS n_shingles, min(w.reached) AS component_id FROM size s JOIN walk w ON w.node = s.doc_id GROUP BY ALL
"""

#: op6: the same closed form of the targets, and the same hash draws.
_OP6 = r"""
WITH sized AS (
  SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
source AS (
  SELECT source, sum(size)::BIGINT AS s, [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS w FROM sized GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER o AS k,
    coalesce(sum(2 * s) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS filled,
    (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS open_weight,
    (sum(s) OVER ())::BIGINT AS total
  FROM source WINDOW o AS (ORDER BY 2 * s / w, source NULLS LAST)),
open AS (
  SELECT k, 3 * total - 2 * filled AS rest, open_weight FROM ranked
  WHERE (3 * total - 2 * filled) * w <= 2 * s * open_weight * 2 ORDER BY k LIMIT 1),
goal AS (
  SELECT r.source, r.s, CASE WHEN o.k IS NULL OR r.k < o.k THEN (2 * r.s)::DOUBLE
    ELSE (r.w * o.rest)::DOUBLE / (o.open_weight * 2)::DOUBLE END AS target
  FROM ranked r LEFT JOIN open o ON true),
drawn AS (
  SELECT doc_id, size, s, target, CASE WHEN s = 0 THEN 0 ELSE target / s END AS rate,
    ('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, ''), ':', coalesce(text, ''))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS draw
  FROM sized JOIN goal ON sized.source IS NOT DISTINCT FROM goal.source)
SELECT doc_id, size, s AS source_size, target,
  ((floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken FROM drawn
"""


def _op11() -> str:
    """op11: every distance is computed; two rounds unrolled."""
    book = """book0 AS (SELECT p, j, row_number() OVER (PARTITION BY p, j ORDER BY vec_id) - 1 AS entry, x AS c FROM comp WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64))"""
    near = """near{k} AS (
  SELECT vec_id, p, min(struct_pack(d := d, entry := entry)) AS best FROM (
    SELECT vec_id, p, entry, sum((x - c) * (x - c))::BIGINT AS d FROM comp JOIN book{k} USING (p, j) GROUP BY vec_id, p, entry) GROUP BY vec_id, p)"""
    step = """mean{n} AS (
  SELECT p, j, best.entry AS entry, sum(x)::BIGINT AS s, count(*)::BIGINT AS n FROM near{k} JOIN comp USING (vec_id, p) GROUP BY ALL),
book{n} AS (
  SELECT b.p, b.j, b.entry, coalesce((s - ((s % n) + n) % n) // n, b.c) AS c FROM book{k} b LEFT JOIN mean{n} m ON m.p = b.p AND m.j = b.j AND m.entry = b.entry)"""
    parts = [book, near.format(k=0), step.format(k=0, n=1), near.format(k=1), step.format(k=1, n=2), near.format(k=2)]
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
comp AS (
  SELECT vec_id, i // (len(q) // 16) AS p, i % (len(q) // 16) AS j, q[i + 1] AS x FROM (SELECT vec_id, q, unnest(range(len(q))) AS i FROM kept)),
{", ".join(parts)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.entry), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM near2 GROUP BY vec_id)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, entry, j)) FROM book2) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


ORACLE: dict[str, str] = {"op11_vector_codes": _op11(), "op2_embedding_join": _OP2, "op5_ngram_join": _OP5, "op6_mixing": _OP6}
