"""The corpus pipeline: documents through five training-data stages.

Toxic documents go, then those that fail the quality rules; of each group of near
duplicates the document of smallest id stays; secrets are overwritten; what is left is
packed into token sequences.  Each stage's result is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reliefspark.llm import jaccard_join, packing, quality, secrets, toxicity
from reliefspark.llm.common import marked, sieve, store, workspace


def _plain(docs: DataFrame, *used: str) -> DataFrame:
    """docs with its columns numbered, except those an operator reads, so that no name clashes with a result's."""
    return docs.toDF(*[c if c in used else f"__{k}" for k, c in enumerate(docs.columns)])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.5; the model is learned from the labels of `docs`. Null and empty texts stay, as repeated rows do."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = _plain(docs, "text")
    return toxicity.tag(rows, model).filter("toxicity < 0.5").select(*rows.columns).toDF(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the references are counted over `docs`. Null and empty texts go; repeated rows are judged alike."""
    rows = _plain(docs, "text")
    return quality.judge(rows, quality.references(docs)).filter("kept").select(*rows.columns).toDF(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each component of five-word shingles at a similarity of 0.8.

    Rows go by a hash of id and text, so that rows of one id are judged apart, and null ids, which come
    last, too. Repeated rows of one id and text stay once.
    """
    at, key = workspace(spark, "near"), f"__row{len(docs.columns)}"
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    component = store(jaccard_join.jaccard_components(keyed.select(F.col(key).alias("doc_id"), "text"), width=5, num=80, den=100), at, "component")
    more = component.groupBy("component_id").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("component_id")
    members = component.select(F.col("doc_id").alias(key), "component_id").distinct().join(more, "component_id")
    members = store(keyed.select(F.col("doc_id").cast("long").alias("id"), key).distinct().join(members, key), at, "members")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", key)).alias("first")).select(F.col(f"first.{key}").alias(key))
    dropped = store(members.join(first, key, "left_anti").select(key), at, "dropped")
    twice = component.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias(key))
    # Rows that surely stay, most of them, are not shuffled; the others are joined with the keys that go.
    doubt = f"__doubt{len(docs.columns)}"
    sure = marked(keyed, key, sieve(dropped.union(twice), key), doubt)
    some = sure.filter(doubt).drop(doubt).join(dropped, key, "left_anti").dropDuplicates([key])
    return sure.filter(~F.col(doubt)).select(*docs.columns).unionByName(some.select(*docs.columns))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets and linked credential parts overwritten; n_chars stays true, as lengths do. Null texts and repeated rows stay."""
    return secrets.mask(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences. A null text is empty: one piece of the end id; repeated rows are packed each."""
    import public_tokenizers

    return packing.best_fit_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("toxicity", toxicity_stage),
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("secret_scans", secrets_stage),
    ("best_fit_packing", packing_stage),
]

#: Trained scores, hashing tokenizers and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents table."""
    at = workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = store(stage(spark, docs, sf_dir), at, f"{k}-{name}")
    return docs
