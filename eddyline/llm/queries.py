"""The registered queries of this folder: thin calls of the operators, from
whose outputs the digest columns are derived."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm import oracles
from eddyline.llm.alignment import align
from eddyline.llm.ann import nearest
from eddyline.llm.bpe import decode_documents, encode_documents
from eddyline.llm.common import read
from eddyline.llm.jaccard import jaccard_components
from eddyline.llm.lexical import rank_documents
from eddyline.llm.licences import scan_licences
from eddyline.llm.mixing import poisson_mix
from eddyline.llm.simhash import near_duplicates
from eddyline.llm.sketch import compare_with_edited
from eddyline.llm.token_counts import token_counts
from eddyline.llm.toxicity import held_out, score_documents
from eddyline.llm.urlfilter import judge_urls
from eddyline.llm.warc import records_from_pages, resolve_revisits


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_edited(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(rows, F.col("vec_id") % 50 == 0, k=5)


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = decode_documents(encode_documents(docs, tokenizer_path()), tokenizer_path())
    return coded.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents").select("text"), tokenizer_path())


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix(read(spark, sf_dir, "documents"), rate_col="rate")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", "toxic")
    return score_documents(docs, labels).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = records_from_pages(read(spark, sf_dir, "pages"))
    lines = F.transform(F.array_sort(F.map_entries("resolved_headers")),
                        lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return resolve_revisits(records).select(
        "record_id", "url", "canonical_url", "kind", F.unix_seconds("fetched_at").alias("fetched_at"),
        "resolution", "refers_to", "resolved_digest", F.array_join(lines, ";").alias("headers"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(read(spark, sf_dir, "documents").select("doc_id", "text"),
                          read(spark, sf_dir, "benchmark").select("item_id", "text"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))[0]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_sketch, op3_ann, op4_licences, op5_bpe, op6_token_counts,
                            op7_mixing, op8_toxicity, op9_url_filter, op10_warc_revisits, op11_lexical,
                            op12_jaccard, op13_alignment)}

ORACLE_SQL: dict[str, str] = {
    "op4_licences": oracles.licences(),
    "op7_mixing": oracles.mixing(),
    "op9_url_filter": oracles.url_filter(),
    "op10_warc_revisits": oracles.warc(),
    "op11_lexical": oracles.lexical(),
}
