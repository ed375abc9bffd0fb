"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the rescored tables.
PEPTIDE_SCHEMA = "spectrum_id string, peptide string, charge int, protein_list string, `mokapot q-value` double"
PSM_SCHEMA = "spectrum_id string, protein_list string"


def read_columns(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan of the named columns."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_tsv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Tab-separated scan with a header; columns are matched to the schema by position.

    A header that does not agree with the schema fails the job.
    """
    return (
        spark.read.schema(schema)
        .options(sep="\t", header=True, enforceSchema=False, mode="FAILFAST", escape='"')
        .csv(path)
    )


def read_with_position(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan with the stored place of each row: ``file`` and ``row``."""
    df = spark.read.parquet(path)
    chosen = [F.col(c) for c in columns or df.columns]
    return df.select(
        *chosen, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )


def read_jdbc_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    """Whole table of a relational database; the caller brings the driver and its options."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON documents, one file each, checked to parse: (path, document)."""
    from ionweave.functions.documents import checked_json

    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), checked_json(F.col("value")).alias("document")
    )


def literal_document(spark: SparkSession, text: str) -> DataFrame:
    """One JSON document given as text."""
    from ionweave.functions.documents import checked_json

    return spark.range(1).select(F.lit("literal").alias("path"), checked_json(F.lit(text)).alias("document"))


def read_document(spark: SparkSession, source: str) -> DataFrame:
    """A JSON document by path or, if it starts as JSON does, by its text."""
    if source.lstrip()[:1] in ("{", "[", '"'):
        return literal_document(spark, source)
    return read_documents(spark, source)
