"""The training-corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns the columns of documents, the last one with token ids, in `token_ids`
(with underscores behind it where documents have a column of that name).

Defined results: columns of documents pass unchanged whatever their names, but for text and n_chars, which follow the
lines that are dropped; documents with null, empty and letterless texts have no language and go; rows with null ids
are documents as others are; of repeated rows, which are near-duplicates, one stays; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import materialise, renamed
from waymark.llm.decontaminate import decontaminate
from waymark.llm.language import UNKNOWN, identify, training_sample
from waymark.llm.lines import dedup_lines
from waymark.llm.pieces import encode, read_model
from waymark.llm.queries import tokenizer_path
from waymark.llm.simhash import keep_one


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language; learns from the documents' own labels."""
    samples = training_sample(docs, "doc_id", "text", "lang")
    label, score = renamed(docs, "lang_pred_", "lang_score_")
    return identify(docs, samples, names=(label, score)).where(F.col(label) != UNKNOWN).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take recurring lines out of the texts; n_chars follows the text."""
    cut = dedup_lines(docs, names=tuple(renamed(docs, "lines_in_", "lines_out_"))).select(*docs.columns)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else cut


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop contaminated documents."""
    judged = decontaminate(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    id_, row = renamed(docs, "id_", "row_")
    bad = judged.where("contaminated").select(F.col("doc_id").alias(id_), F.col("row").alias(row))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(row)), "left_anti")


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Append the documents' token ids."""
    return encode(docs, read_model(tokenizer_path()), name_of_ids=renamed(docs, "token_ids")[0])


STAGES = [
    ("language", language_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("benchmark", benchmark_stage),
    ("tokens", token_stage),
]

#: SQL can express neither the language models nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
