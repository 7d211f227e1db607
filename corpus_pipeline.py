"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as
Parquet and read again as the next one's docs:

1. toxicity: documents that the classifier rejects go;
2. line dedup: lines of recurring templates are taken out of texts (n_chars
   follows the text), every document stays;
3. MinHash near-dedup (five words, 0.8): one document of each group stays;
4. mixing: every document is emitted as often as its source's target asks for;
5. byte-level BPE: token ids of each document, and digests of ids and of the
   bytes that they decode to.

All but the last keep the columns of documents, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carespark.llm import bpe, lines, minhash, mixing, toxicity
from carespark.llm.common import WORD, documents, free, saved, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, toxicity.learned(docs, table(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = free(docs, "lines_gone")
    out = lines.drop_templates(docs, dropped=gone)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(gone) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    words = free(docs, "words")
    sized = docs.withColumn(words, F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    return mixing.emit(mixing.mix(sized, "source", words, ["doc_id"]), free(sized, "copies")).select(docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(docs, keep_ids=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("near dedup", near_stage),
    ("mixing", mix_stage),
    ("bpe", token_stage),
]

ORACLE_SQL = None  # the classifier, MinHash and BPE have no SQL form; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
