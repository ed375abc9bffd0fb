"""Sinks.  All refuse to overwrite unless told to append."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionweave.functions.documents import checked_json
from ionweave.operators.ordering import with_row_index

DEFAULT_COMMAND = "NA"  # fixed value: command of a result that names none


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header."""
    df.write.mode("errorifexists").csv(path, header=True)


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, in the partitions and order the frame has."""
    df.write.mode("errorifexists").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    """Add rows to a parquet table, created if absent."""
    df.write.mode("append").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """JSON, one document per row, nulls included."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)


def write_shards(records: DataFrame, bins: DataFrame, path: str, file: str, seq: str, text: str) -> None:
    """Text shards below ``path/<file>/bin=<n>``, records in order.

    ``bins`` comes from :func:`ionweave.operators.packing.pack`.  A shard is bounded by the limit
    it was packed with, so one task per shard is enough; no file is gathered.
    """
    placed = records.select(file, seq, text).join(bins, [file, seq])
    (
        placed.repartition(file, "bin")
        .sortWithinPartitions(file, "bin", seq)
        .select(file, "bin", F.regexp_replace(text, r"\n\z", "").alias("value"))
        .write.mode("errorifexists")
        .partitionBy(file, "bin")
        .text(path)
    )


def write_spectra(lines: DataFrame, path: str) -> None:
    """Spectrum lines as text files, spectra in order of their id.

    A spectrum stays in one file, as a record of the format must.  Its lines go through an
    external sort, not through memory.
    """
    order = ["MS1_ClusterID", "section", "mz", "intensity", "MS2_ClusterID"]
    parts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (
        lines.repartitionByRange(parts, "MS1_ClusterID")
        .sortWithinPartitions(*order)
        .select("line")
        .write.mode("errorifexists")
        .text(path)
    )


def result_rows(documents: DataFrame, next_id: int = 1) -> DataFrame:
    """Result documents in table form: id, date, command, result, reproducibility.

    ``documents`` has ``result`` and may have ``command`` and ``reproducibility``.  Ids count on
    from ``next_id`` in the order of command and result; the date is the arrival time in whole seconds.
    """
    numbered = with_row_index(_results(documents), ["command", "result"], name="_at", unique=False)
    return numbered.select((F.col("_at") + next_id).alias("id"), "date", "command", "result", "reproducibility")


def _results(documents: DataFrame) -> DataFrame:
    """The columns of result documents but the id."""
    have = documents.columns
    command = F.col("command") if "command" in have else F.lit(DEFAULT_COMMAND)
    extra = F.col("reproducibility") if "reproducibility" in have else F.lit(None).cast("string")
    return documents.select(
        F.date_trunc("second", F.current_timestamp()).alias("date"),
        command.alias("command"),
        checked_json(F.col("result")).alias("result"),
        F.coalesce(extra, F.lit("{}")).alias("reproducibility"),
    )


def append_results(documents: DataFrame, path: str) -> None:
    """Append result documents to a parquet table, created if absent, ids counting on."""
    spark = documents.sparkSession
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)
    last = spark.read.parquet(path).agg(F.max("id")).first()[0] if exists else None
    result_rows(documents, (last or 0) + 1).write.mode("append").parquet(path)


def append_results_jdbc(documents: DataFrame, url: str, table: str, **options: str) -> None:
    """Append result documents to a database table, whose identity column gives the ids."""
    _results(documents).write.format("jdbc").options(url=url, dbtable=table, **options).mode("append").save()
