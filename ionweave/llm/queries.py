"""The operators over the given tables; (query, SQL twin or None) by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ionweave.llm import (
    jaccard, lexical_search, line_dedup, mixing, packing, pii, quality, secret_scan, sentence_spans, spelling, token_counts,
    token_files, twins, vectors,
)
from ionweave.llm.tokens import tokenizer_path
from ionweave.staging import new_path, stage


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(_table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf_dir, "documents", "doc_id", "text", "source"), stage)


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return vectors.nearest(table, lambda vec_id: vec_id % 100 == 0, stage)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return jaccard.similar_components(docs, stage).select("doc_id", "n_shingles", "component_id")


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return token_files.token_file_rows(docs, new_path(spark, "ids"), tokenizer_path("word_bpe_49k.json"), stage)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality")
    judged = quality.judged(docs, labels, stage, keep=["doc_id"])
    return judged.select(
        "doc_id", *[f"_quality.{c}" for c in quality.MEASURES[:5]], "_quality.base_failed", "_quality.kept"
    )


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    cut = sentence_spans.without_repeated_spans(docs, stage, shared=sentence_spans.SHARED)
    return cut.select("doc_id", "text", "_cut.*")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), stage)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return token_counts.token_counts(docs, tokenizer_path("byte_bpe_50k.json"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality")
    return secret_scan.secrets(docs, secret_scan.train(docs, labels))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents", "doc_id", "text")
    return lexical_search.search(docs, _table(spark, sf_dir, "benchmark", "item_id", "text"), stage)


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(_table(spark, sf_dir, "documents", "doc_id", "text"), stage)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents", "doc_id", "text"), stage)


QUERIES = {
    run.__name__: (run, sql)
    for run, sql in (
        (op1_personal_data, None), (op2_mix, None), (op3_multi_index, None), (op4_jaccard_join, None), (op5_token_files, None),
        (op6_quality, None), (op7_sentence_spans, None), (op8_packing, None), (op9_token_counts, None), (op10_secrets, None),
        (op11_lexical_search, twins.OP11), (op12_line_dedup, twins.OP12), (op13_spelling, twins.OP13),
    )
}
