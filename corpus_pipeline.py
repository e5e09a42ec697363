"""From raw documents to training sequences: five stages, each on what the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``documents``. Rows are judged one by one, so null ids and repeated rows need no care
before the last stage but for near copies, where rows without an id are told apart by their text.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracebook.llm import decontaminate, packing, secret_scan, simhash, toxicity
from tracebook.llm.common import fold, shared_folder, table

TOXIC = 0.7
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def documents(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the threshold; labels of one fold in three are not trained on."""
    labels = table(spark, sf_dir, "labels")
    network = toxicity.fitted(docs, labels, fold(F.col("doc_id"), 3) != 1)
    return documents(toxicity.scored(docs, network, "toxic_score").where(F.col("toxic_score") < TOXIC))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest id."""
    return documents(simhash.one_per_component(docs, limit=2, words_per_shingle=3))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return documents(decontaminate.without_items(docs, table(spark, sf_dir, "benchmark")))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked; n_chars is that of the text left."""
    masked = secret_scan.without_secrets(docs, secret_scan.fitted(docs))
    return documents(masked.withColumn("n_chars", F.length("text").cast("long")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", mask_secrets),
    ("packing", pack_sequences),
]

# trained networks, fingerprints and tokenizers have no SQL form: tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``; each result is written to the shared folder and reread."""
    docs = documents(table(spark, sf_dir, "documents"))
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        result = stage(spark, docs, sf_dir)
        if number == len(STAGES) - 1:
            break
        result.write.parquet(f"{folder}/{number}-{name}")
        docs = spark.read.parquet(f"{folder}/{number}-{name}")
    return result
