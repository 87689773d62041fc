"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import embedding_components

    return embedding_components(_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from . import toxicity

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.tag(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), "toxic_spans")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import bpe_prefix

    path, pattern = _tokenizer("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe_prefix.digests(bpe_prefix.decode(bpe_prefix.encode(_table(spark, sf_dir, "documents"), path, pattern), path, pattern))


def op4_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import secrets

    return secrets.digest(secrets.spans(_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"]))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import token_table

    ids = token_table(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), end_id=1)
    return ids.selectExpr("doc_id", "start", "cast(length(ids) div 4 as long) AS n_tokens", "crc32(ids) AS ids_crc32")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import best_fit_sequences

    return best_fit_sequences(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op7_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    judged = quality.judge(docs.select("doc_id", "text"), quality.references(docs))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance")


def op8_language_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import langid
    from .toxicity import held_out

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.classify(docs.select("doc_id", "text"), langid.dictionaries(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "narrow")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_join import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"), width=4, num=85, den=100, fold=True)


def op10_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc

    found = warc.read_archives(warc.archive(_table(spark, sf_dir, "pages"), least=1000))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {f.__name__: f for f in (op1_embedding_near_dedup, op2_toxicity, op3_byte_bpe, op4_credential_linking, op5_token_files, op6_best_fit_packing, op7_quality_divergence, op8_language_compression, op9_ngram_jaccard_join, op10_warc_dictionary)}

ORACLES: dict[str, str] = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
 ok AS (SELECT * FROM v WHERE label IS NOT NULL AND x IS NOT NULL AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(x, lambda c: c <> 0)) > 0),
 links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
 reach(node, root) AS (SELECT vec_id, vec_id FROM v UNION SELECT b, root FROM reach JOIN links ON a = node WHERE root < b),
 low AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1), n AS (SELECT a, count(*) AS n_links FROM links GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM v JOIN low ON node = vec_id LEFT JOIN n ON a = vec_id""",
    "op9_ngram_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s FROM w),
 f AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, unnest(s) AS t FROM s),
 p AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS c FROM f x JOIN f y ON x.t = y.t AND x.doc_id <> y.doc_id GROUP BY 1, 2, 3, 4),
 links AS (SELECT a, b FROM p WHERE 100 * c >= 85 * (na + nb - c)),
 reach(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT b, root FROM reach JOIN links ON a = node WHERE root < b)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id FROM s JOIN (SELECT node, min(root) AS component_id FROM reach GROUP BY 1) ON node = doc_id""",
    "op10_warc_dictionary": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
 k AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN keeper <> page_id THEN keeper END AS refers_to FROM k""",
}
