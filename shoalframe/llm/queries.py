"""The operators' queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import embeddings, jaccard, language, media, mixing, packing, quality, substrings, toxicity, wrappers


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path())


def fold_of(folds: int) -> Column:
    """crc32 of doc_id as text, modulo folds; a null doc_id is in none."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def op2_language_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = language.identify(docs, language.learn(docs, fold_of(4) != 2))
    return found.select("doc_id", F.coalesce(fold_of(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op3_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    columns = ["source", "lang", "n_chars"]
    found = quality.scores(docs, quality.learn(docs, labels, fold_of(5) != 0, columns), columns)
    return found.select("doc_id", F.coalesce(fold_of(5) == 0, F.lit(False)).alias("held_out"), "score_content", "score_metadata", "score", "predicted")


def op4_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(_table(spark, sf_dir, "pages"))


def op5_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.audio(_table(spark, sf_dir, "documents"))


def op6_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = toxicity.scores(docs, toxicity.learn(docs, _table(spark, sf_dir, "labels"), fold_of(5) != 0))
    return found.select("doc_id", F.coalesce(fold_of(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op7_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(_table(spark, sf_dir, "documents"), columns=["doc_id"]).select("row.doc_id", "source", "block", "release", "due", "slot", "at", "weight")


def op8_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(_table(spark, sf_dir, "documents"))


def op10_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_harmonic_packing, op2_language_compression, op3_co_training, op4_html_wrappers, op5_mpeg_audio, op6_toxicity_bigru, op7_pfair_mixing, op8_epsilon_grid, op9_recompression, op10_jaccard_rtree)}

SQL: dict[str, str] = {
    "op8_epsilon_grid": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_cosine_similarity(a.x, b.x) >= CAST(0.98 AS DOUBLE)),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
n AS (SELECT x, count(*) AS n FROM link GROUP BY x),
c AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(c.y, vec_id)) AS component_id, least(vec_id, coalesce(c.y, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN c ON c.x = vec_id
""",
    "op9_recompression": r"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i+12], ' ') AS g
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)),
doomed AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY g) AS first FROM win) WHERE doc_id > first),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM doomed)),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w WHERE len(words) > 0),
kept AS (
  SELECT word.doc_id, count(gone.p) AS removed, string_agg(word, ' ' ORDER BY word.p) FILTER (WHERE gone.p IS NULL) AS text
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.p = word.p GROUP BY word.doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
""",
    "op10_jaccard_rtree": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' '))) END AS s
  FROM w),
n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles FROM sets),
e AS (SELECT doc_id, unnest(s) AS g FROM sets),
k AS (SELECT *, count(*) OVER (PARTITION BY g) AS df FROM e),
co AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM k a JOIN k b ON a.g = b.g AND a.doc_id < b.doc_id WHERE a.df > 1 AND b.df > 1 GROUP BY 1, 2),
link AS (SELECT x, y FROM co JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n_shingles + q.n_shingles - c)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (SELECT x, y FROM edge UNION SELECT r.x, e.y FROM reach r JOIN edge e ON r.y = e.x)
SELECT n.doc_id, n.n_shingles, least(n.doc_id, coalesce(min(r.y), n.doc_id)) AS component_id
FROM n LEFT JOIN reach r ON r.x = n.doc_id GROUP BY n.doc_id, n.n_shingles
""",
}
