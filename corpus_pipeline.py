"""Corpus pipeline: five stages of the training-data operators over ``documents``.

toxicity   documents scored toxic (1/2 or more) go
near_dups  one document of each class of near duplicates stays (the smallest id)
pii        personal data is replaced by surrogates
mix        sources are mixed to target weights; documents may come twice
tokens     byte-level BPE ids, and the decoded bytes, of every text

Each stage gets what the previous one kept, written as Parquet and reread; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir
from strata.sources.tables import read_table

PII_KEY = b"surrogates of the corpus"


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from strata.llm.crf import fit, score
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model, keep=docs.columns, score_col="__score").filter("__score < 0.5") \
        .select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a doc_id belong to no class and stay."""
    from strata.llm.ngram_join import near_duplicate_classes
    from strata.llm.stages import written
    classes = written(near_duplicate_classes(docs), "classes")
    stay = classes.filter("doc_id = component_id").select(F.col("doc_id").alias("__stays")).distinct()
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))
    kept = (docs.join(stay, docs["doc_id"] == stay["__stays"]).drop("__stays")
            .withColumn("__row", F.row_number().over(first)).filter("__row = 1").drop("__row"))
    return kept.select(*docs.columns).union(docs.filter("doc_id IS NULL"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from strata.llm.surrogates import replace_pii
    return replace_pii(docs, PII_KEY, count_col=None)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from strata.llm.mixing import mixed_documents
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from strata.llm.byte_bpe import round_trip
    return round_trip(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [("toxicity", toxicity), ("near_dups", near_duplicates), ("pii", pii), ("mix", mix), ("tokens", tokens)]

# Learned scores, hashed draws and tokenizers have no SQL form: the stages are
# tested against brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; the last one's rows."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
