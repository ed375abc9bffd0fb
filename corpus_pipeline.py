"""A corpus from raw documents to packed training sequences.

Each stage gets what the one before kept, written and read again, and its decisions take effect.  All but the
last return the columns of documents.  SQL cannot express the stages; tests hold them against
plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ionweave.llm import jaccard, mixing, packing, pii, quality
from ionweave.llm.textual import free_name, n_words
from ionweave.llm.tokens import tokenizer_path
from ionweave.staging import stage

ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, among them null and empty texts; repeated rows are judged alike."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    judged = quality.judged(docs, labels, stage)
    return judged.where(F.col(f"{judged.columns[-1]}.kept")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id stays; of equal rows one.

    Documents without words are linked with nothing and all stay.
    """
    found = stage(jaccard.similar_components(docs, stage))
    first = (
        found.where("node IS NOT NULL")
        .groupBy("root")
        .agg(F.min(F.struct("doc_id", "key")).alias("f"))
        .select("f.key")
    )
    empty = found.where("node IS NULL").select("key")
    key = free_name(docs.columns, "_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    kept = keyed.join(first.union(empty).distinct().withColumnRenamed("key", key), key, "left_semi")
    words = n_words(F.col("text")) > 0
    one = kept.where(words).dropDuplicates([key])
    return one.unionByName(kept.where(~words)).select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by the name of their kind; null and empty texts stay, and so does every row."""
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; texts without words, null or empty, are not taken.

    Repeated rows are separate documents; their copies are added up.
    """
    names = [free_name(docs.columns, c) for c in ("_k1", "_k2", "_copies", "_copy")]
    k1, k2, copies, copy = names
    values = [F.col(f"`{c}`") for c in docs.columns]
    values += [v.isNull() for v in values]  # a hash passes over nulls
    keyed = docs.withColumns({k1: F.xxhash64(F.lit(1), *values), k2: F.xxhash64(F.lit(2), *values)})
    sized = stage(
        keyed.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            n_words(F.col("text")).alias("size"), F.col(k1).alias("_k1"), F.col(k2).alias("_k2"),
        )
    )
    taken = mixing.round_copies(sized, stage, (3, 1, 2), 150)
    per_row = taken.groupBy(F.col("_k1").alias(k1), F.col("_k2").alias(k2)).agg(F.sum("copies").alias(copies))  # equal rows are one key
    once = keyed.dropDuplicates([k1, k2])
    repeated = once.join(per_row, [k1, k2]).where(F.col(copies) > 0)
    return repeated.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences; a null or empty text is its end id alone, and every row is a document."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), stage)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("mixing", mix),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each one's result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
