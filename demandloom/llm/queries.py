"""Registered queries of the operators: one per operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.llm.collocations import collocations
from demandloom.llm.decontamination import contaminated
from demandloom.llm.durable import fresh
from demandloom.llm.html_text import extract_pages
from demandloom.llm.license_scan import scan_licenses
from demandloom.llm.line_dedup import line_groups
from demandloom.llm.mixing import mix
from demandloom.llm.ngram_join import ngram_components
from demandloom.llm.secret_scan import scan_secrets
from demandloom.llm.token_alignment import token_alignment
from demandloom.llm.token_counts import token_counts
from demandloom.llm.tokenizers import TokenizerFile
from demandloom.llm.topk_search import top_k
from demandloom.llm.toxicity import held_out, toxicity_scores, train_from_labels
from demandloom.llm.warc import read_archives, write_archives


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(_table(spark, sf_dir, "documents"), width=5, similarity=0.8)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = fresh(spark, "warc")
    write_archives(_table(spark, sf_dir, "pages"), archives, least=0)
    return read_archives(spark, archives).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact"
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_groups(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train_from_labels(docs, _table(spark, sf_dir, "labels"))
    return toxicity_scores(docs, model, threshold=0.3).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op7_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_table(spark, sf_dir, "documents"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(_table(spark, sf_dir, "pages"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    # strings of special tokens inside texts are plain text here
    a = TokenizerFile.read(public_tokenizers.path("byte_bpe_50k.json"), special_as_text=True)
    b = TokenizerFile.read(public_tokenizers.path("piece_bpe_32k.model"))
    return token_alignment(_table(spark, sf_dir, "documents"), a, b)


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collocations(_table(spark, sf_dir, "documents"), longest=3, support=10, most=2000, absorbed=50)
    return found.withColumn("rank", F.col("rank").cast("long"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = TokenizerFile.read(public_tokenizers.path("word_bpe_49k.json"))
    # a cache of its own, so that every run encodes all distinct texts
    return token_counts(_table(spark, sf_dir, "documents"), tokenizer, fresh(spark, "token-cache"), limit=2048)


QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_warc": op2_warc,
    "op3_decontamination": op3_decontamination,
    "op4_secret_scan": op4_secret_scan,
    "op5_line_dedup": op5_line_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_entropy_mixing": op7_entropy_mixing,
    "op8_html_text": op8_html_text,
    "op9_exact_topk": op9_exact_topk,
    "op10_license_scan": op10_license_scan,
    "op11_token_alignment": op11_token_alignment,
    "op12_collocations": op12_collocations,
    "op13_token_counts": op13_token_counts,
}
