"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's docs. All but the last return the columns
of documents; other columns are dropped by the first. Ids should be unique: of rows
that share one, each stays if any of them does. Rows without an id go in the second
stage. An empty table passes through as an empty one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.cluster import remove, shared_folder
from stridelake.llm.language import accepted_documents
from stridelake.llm.minhash import near_duplicates
from stridelake.llm.packing import pack_documents
from stridelake.llm.quality import quality_rules, without_lines
from stridelake.llm.queries import tokenizer_path
from stridelake.llm.suffixes import remove_earlier_copies

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Rows that travel to a Python worker at once; whole documents make batches of the default length large.
BATCH_ROWS = "1000"


def _small_batches(spark: SparkSession) -> None:
    """Bound what executors hold of batches on their way to Python, unless the session sets a bound."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, BATCH_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is rejected, null texts and texts without a letter among them; null languages and nulls in other columns stay as they are."""
    _small_batches(spark)
    return accepted_documents(docs.select(*COLUMNS))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the rules, and boilerplate lines from those that stay."""
    _small_batches(spark)
    kept = quality_rules(docs, spare_first=True).where("kept").select("doc_id", "removed_lines").dropDuplicates(["doc_id"])
    text = without_lines(F.col("text"), F.col("source"), F.col("removed_lines"))
    return (
        docs.join(kept, "doc_id")
        .withColumn("text", text)
        .withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
        .select(*COLUMNS)
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies (five words, similarity 0.8)."""
    _small_batches(spark)
    kept = near_duplicates(docs).where("kept").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").select(*COLUMNS)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings of 50 bytes that an earlier document holds, whole characters only; emptied documents go."""
    _small_batches(spark)
    out = remove_earlier_copies(docs, length=50, whole_characters=True, carry=["lang", "source"])
    return (
        out.withColumnRenamed("kept", "text")
        .where("n_bytes = 0 OR text <> ''")
        .withColumn("n_chars", F.length("text").cast("long"))
        .select(*COLUMNS)
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of a document lies in which training sequence of 2048 ids."""
    _small_batches(spark)
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("best_fit_packing", packing),
]

#: SQL can express neither the trained language model nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written below spark.checkpoint.dir (a local master may leave that unset) and removed once the next is."""
    folder = f"{shared_folder(spark)}/corpus_pipeline/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            remove(spark, before)
        before = path
    return docs
