"""The registered queries of the operators, over the test tables, with the SQL that checks them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekeel.llm.collocations import oracle as collocations_oracle
from tablekeel.llm.common import ship
from tablekeel.llm.infill import oracle as infill_oracle
from tablekeel.llm.licenses import oracle as license_oracle
from tablekeel.llm.topk import oracle as topk_oracle
from tablekeel.llm.warc import oracle as warc_oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tablekeel.llm.tokens import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.language import identify_language

    return identify_language(table(spark, sf_dir, "documents"))


@query
def op6_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.quality import classify_quality

    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_mixing_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.mixing import mix_by_source

    mixed = mix_by_source(table(spark, sf_dir, "documents"), [5, 2, 1])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op2_minhash_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.dedup import Rule, near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), Rule(words=3, percent=85))


@query
def op5_packing_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.mixing import words_in
    from tablekeel.llm.packing import pack

    docs = table(spark, sf_dir, "documents").select("doc_id", words_in(F.col("text")).alias("n_tokens"))
    return pack(docs, buckets=16, budget=32_768)


@query
def op4_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


ORACLES["op4_license_digests"] = license_oracle()


@query
def op9_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.warc import roundtrip

    return roundtrip(table(spark, sf_dir, "pages"))


ORACLES["op9_warc_transactions"] = warc_oracle()


@query
def op8_topk_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.topk import quantised, top_inner_products

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", quantised(F.col("embedding"), 256).alias("vector"))
    return top_inner_products(vectors, F.col("vec_id") % 50 == 0, k=5)


ORACLES["op8_topk_norms"] = topk_oracle()


@query
def op10_fingerprint_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.fingerprints import fingerprint_edits

    return fingerprint_edits(table(spark, sf_dir, "documents"))


@query
def op11_consensus_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.pagetext import main_texts

    return main_texts(table(spark, sf_dir, "pages"))


@query
def op12_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_son_collocations"] = collocations_oracle()


@query
def op13_infill_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tablekeel.llm.infill import fill_in_middle, with_digests

    return with_digests(fill_in_middle(table(spark, sf_dir, "documents")))


ORACLES["op13_infill_words"] = infill_oracle()
