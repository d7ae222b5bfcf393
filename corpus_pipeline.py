"""The training-data pipeline: each stage takes what its predecessor kept, and its decisions take effect.

Every stage but the last returns the columns of documents. run() writes each stage's result as Parquet in the shared folder and
reads it again, so a lost executor costs at most one stage's tasks. Before a stage begins, executors give back what earlier ones left.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import common, lines, minhash, packing, toxicity, winnowing

#: Packing and the classifier have no SQL form; tests hold run() against brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity of 0.5 or more go; labels of those whose crc32 of the id is divisible by 5 are not learnt from."""
    found = toxicity.toxicity_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), learn_from="crc32(cast(doc_id as string)) % 5 != 0", carry=tuple(docs.columns))
    return found.where("score < 0.5").select("row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose lines that many documents share; a document that loses all of them stays, empty. n_chars follows the text."""
    kept = lines.apply_bitmaps(docs, lines.line_bitmaps(docs)).select("row.*")
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, a similarity of 0.8 or more) the document of the smallest id stays. Documents without words or id are in no group; all rows of a repeated id stay or go together."""
    gone = minhash.near_duplicates(docs).where("not kept").select("doc_id").distinct()
    return docs.join(gone.hint("shuffle_hash"), "doc_id", "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a word inside a window of the benchmark go."""
    found = winnowing.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), carry=tuple(docs.columns))
    return found.where("n_hit = 0").select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 2048 ids that hold all texts."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def _released(stage):
    """The stage, after executors have given back memory: a heap that one stage has filled would stand beside the next one's workers."""

    @functools.wraps(stage)
    def f(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.release(spark)
        return stage(spark, docs, sf_dir)

    return f


STAGES = [(name, _released(f)) for name, f in (("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated), ("packing", pack))]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = common.table(stage(spark, docs, sf_dir))
    return docs
