"""The pipeline from documents to training batches: five stages, each on all that the one before has kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeel.llm.common import cut, shared_folder, ship, small
from tablekeel.llm.dedup import near_duplicates
from tablekeel.llm.language import learn_languages, predict_languages
from tablekeel.llm.mixing import mix, words_in
from tablekeel.llm.packing import pack
from tablekeel.llm.quality import learn_quality, score_quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention model, learned from labels, scores 0.3 or more."""
    ship(spark)
    docs = docs.select(COLUMNS)
    model = learn_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model).where(F.col("score") >= 0.3).select(COLUMNS)


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language the codes decide without ambiguity."""
    ship(spark)
    docs = docs.select(COLUMNS)
    model = learn_languages(docs)
    return predict_languages(docs, model).where(~F.col("ambiguous")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at five words and 0.8: that with the smallest id, nulls last.

    Decided row by row: where ids are null or repeat, rows get names of their own, in which
    the id comes first and then a hash of the text.
    """
    ship(spark)
    docs = docs.select(COLUMNS)
    if docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").isEmpty():
        gone = cut(near_duplicates(docs).where(~F.col("kept")).select("doc_id"))
        return docs.join(small(gone), "doc_id", "left_anti").select(COLUMNS)
    name = F.struct(
        F.col("doc_id").isNull().alias("nameless"),
        F.coalesce("doc_id", F.lit(0)).alias("doc_id"),
        F.xxhash64("text").alias("hash"),
        F.monotonically_increasing_id().alias("row"),
    )
    docs = cut(docs.withColumn("name", name))
    gone = cut(near_duplicates(docs, doc_id="name").where(~F.col("kept")).select(F.col("doc_id").alias("name")))
    return docs.join(small(gone), "name", "left_anti").select(COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to weights 5, 2, 1 takes it, up to three times."""
    rows = docs.select(*COLUMNS, words_in(F.col("text")).alias("size"), F.array("source").alias("sources"))
    plan = mix(rows, [5, 2, 1])
    taken = plan.repeats(rows).where("repeats > 0")
    return taken.withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))).select(COLUMNS)


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, bucket, padded, batch and slot: batches of 32,768 padded words in sixteen length buckets."""
    return pack(docs.select("doc_id", words_in(F.col("text")).alias("n_tokens")), buckets=16, budget=32_768)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_quality),
    ("language", keep_languages),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_batches),
]

#: Learned models, seeded hashes and near-duplicates at a miss probability are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
