"""The registered queries of this subpackage: one per operator, with production
parameters, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import (ann, clusters, decontaminate, html_text, language_id, line_dedup, lm, packing, repeats, resampling,
                          simhash, token_counts, toxicity)


def _table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def fold(buckets: int, id_col: str = "doc_id"):
    """crc32 of the id as text, modulo ``buckets``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(buckets))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    out = line_dedup.dedup_lines(docs, min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = fold(4) == 2
    out = language_id.identify(docs, learn=~held_out)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.count_tokens(docs, _tokenizer("piece_bpe_32k.model")).select(
        "doc_id", "n_tokens", "n_unknown", "best_score")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return repeats.remove_repeats(docs, width=200).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, _tokenizer("byte_bpe_50k.json"), capacity=2048, separator=0,
                        ranks=_tokenizer("byte_bpe_50k.tiktoken"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = fold(7) == 2
    return lm.score_texts(docs, train=~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash.near_duplicates(docs, size=3, max_bits=3).select("doc_id", "fingerprint", "component_id")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(rows, queries=rows.filter("vec_id % 50 = 0"), k=5)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontaminate.TestIndex(_table(spark, sf_dir, "documents", "doc_id", "text"),
                                    _table(spark, sf_dir, "benchmark", "item_id", "text"), size=10)
    return index.contamination().select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "url", "text", "n_chars")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    out = resampling.resample(docs, _table(spark, sf_dir, "benchmark", "text"), percent=5, min_words=20, buckets=10000, longest=3, salt="42:")
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = fold(3) == 1
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels", "doc_id", "toxic").filter(~held_out))
    return model.score(docs, threshold=0.7).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    out = clusters.cluster(rows, k=40, rounds=5, dims=64, scale=256, salt="2:")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                      F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ",").cast("binary"), 256).alias("centroid_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_language_id, op3_token_counts, op4_suffix_dedup, op5_best_fit_packing, op6_lm_scoring,
    op7_simhash, op8_nearest_neighbours, op9_decontamination, op10_html_text,
    op11_importance_resampling, op12_toxicity, op13_centroid_clusters)}

LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT *, {LOWER_SQL.format("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM lines),
lost AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT a.*, keeper IS NOT NULL AND doc_id < keeper AS gone FROM keyed a LEFT JOIN lost USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP9_SQL = f"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all({LOWER_SQL.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s : s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM iw WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s
        FROM dw CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
met AS (SELECT doc_id, item_id, s, n FROM places JOIN windows USING (n, win)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM met) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits USING (doc_id) LEFT JOIN found USING (doc_id)
"""



def op13_sql(k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, salt: str = "2:") -> str:
    """Every round compares all vectors with all centroids."""
    nearest = """a{n} AS MATERIALIZED (
  SELECT vec_id, pos, v, best.c AS cluster, best.d AS distance FROM (
    SELECT vec_id, r.pos, r.v, min({{'d': list_sum(list_transform(list_zip(r.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'c': c}}) AS best
    FROM vectors r CROSS JOIN m{n} m GROUP BY vec_id, r.pos, r.v))"""
    means = """m{after} AS MATERIALIZED (
  SELECT c, coalesce(list_transform(g.s, lambda x: CAST(floor(x / g.n) AS BIGINT)), m.v) AS v FROM m{n} m LEFT JOIN (
    SELECT cluster, max(n) AS n, list(s ORDER BY i) AS s FROM (
      SELECT cluster, i, count(*) AS n, CAST(sum(v[i]) AS BIGINT) AS s FROM a{n} CROSS JOIN range(1, {dims} + 1) t(i) GROUP BY cluster, i)
    GROUP BY cluster) g ON g.cluster = m.c)"""
    steps = [nearest.format(n=0)]
    for n in range(rounds):
        steps += [means.format(n=n, after=n + 1, dims=dims), nearest.format(n=n + 1)]
    return f"""
WITH vectors AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS pos, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}),
m0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (
    SELECT sha256('{salt}' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM vectors) QUALIFY c < {k}),
{", ".join(steps)}
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN m{rounds} m ON m.c = cluster
"""


ORACLES = {"op1_line_dedup": OP1_SQL, "op9_decontamination": OP9_SQL, "op13_centroid_clusters": op13_sql()}
