"""From raw documents to packed training sequences: language, near-duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns the columns of `documents`;
the last one returns packed pieces. `run` writes each result as Parquet and reads it again for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ballast.llm import langid, mixing, neardup, packing, queries, secret_scan
from ballast.llm.common import stored

def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned go on; those without letters or without text go.

    Where lang is null, it becomes the prediction. Columns that share a name with the operator's own keep their values.
    """
    known = docs.where(F.col("doc_id").isNotNull() & ~langid.held_out())
    own = {c: f"_own_{c}" for c in ("lang_pred", "score") if c in docs.columns}
    found = langid.predict(docs.withColumnsRenamed(own), *langid.train(known))
    kept = found.where(F.col("lang_pred") != langid.UNKNOWN).withColumn("lang", F.coalesce("lang", "lang_pred"))
    return kept.drop("lang_pred", "score").withColumnsRenamed({v: k for k, v in own.items()}).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays, once.

    Of rows without id each different row stays once: there is nothing to name them by in a group.
    """
    found = neardup.near_duplicates(docs, size=5, percent=80)
    kept = found.where("kept").select("doc_id").distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi")
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("text", *others)).alias("_row")).select("doc_id", "_row.*")
    return rows.select(docs.columns).unionByName(docs.where("doc_id IS NULL").distinct())


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, with their secrets masked."""
    return secret_scan.mask(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix uses it; of rows that share an id the largest use counts, rows without id stay."""
    uses = mixing.mix(docs, queries.domain(), queries.WEIGHTS, queries.EPOCHS, fraction=1.0, seed=queries.SEED)
    uses = uses.where("doc_id IS NOT NULL AND uses > 0").groupBy("doc_id").agg(F.max("uses").cast("int").alias("_uses"))
    rows = docs.join(uses, "doc_id", "left").withColumn("_uses", F.when(F.col("doc_id").isNull(), 1).otherwise(F.col("_uses")))
    return rows.where("_uses > 0").withColumn("_epoch", F.explode(F.sequence(F.lit(1), F.col("_uses")))).select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: Language ID, near-duplicates, secrets and packing have no SQL; tests compare the pipeline with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
