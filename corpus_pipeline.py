"""A training-corpus pipeline: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrylane.llm import bpe, line_dedup, mixing, rule_classifier, simhash
from quarrylane.llm.queries import tokenizer_path
from quarrylane.llm.shared import shared_dir, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return rule_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later matching lines are taken out of the texts; n_chars follows."""
    out = line_dedup.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.char_length("text").cast("bigint"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one_per_group(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in training order."""
    return mixing.materialised(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as tokens, with each row's place in training order: the file of the mix, and the row in it (null if docs is no stored table)."""
    stored = bool(docs.inputFiles())
    place = {"mix_file": F.col("_metadata.file_name") if stored else F.lit(None).cast("string"), "mix_row": F.col("_metadata.row_index") if stored else F.lit(None).cast("bigint")}
    rows = docs.select("doc_id", "text", *(c.alias(k) for k, c in place.items()))
    return bpe.encode_documents(rows, tokenizer_path(), ids=True).drop("text")


STAGES = [("quality classifier", quality), ("line dedup", lines), ("simhash near-dedup", near_copies), ("mixing", mix), ("bpe encoding", encode)]

#: No SQL has the classifier, the similarity join or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; what lies between them is in the shared folder.

    Nulls in any column, repeated rows and texts of any length go through all stages, as each
    stage's operator states; an empty table gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    where = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{where}/{k}")
        docs = spark.read.parquet(f"{where}/{k}")
    return docs
