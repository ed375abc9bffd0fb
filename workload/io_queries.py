"""Scans and sinks: what is written is read back and compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from ionweave.functions.documents import checked_json
from ionweave.operators.filters import filter_edges, in_order, query_tables
from ionweave.operators.packing import pack
from ionweave.operators.summaries import content_digests, edge_counts, sequence_stats
from ionweave.sources import sinks, tables
from ionweave.sources.records import file_digests, read_fasta, read_records
from ionweave.staging import new_path
from workload.fixtures import duck_sql as D
from workload.fixtures import spark_table as T


def column_scan(spark, d):
    return tables.read_columns(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_extendedprice"])


def tsv_scan(spark, d):
    path = new_path(spark, "tsv")
    T(spark, d, "rescored").write.csv(path, sep="\t", header=True)
    return tables.read_tsv(spark, path, tables.PEPTIDE_SCHEMA)


def sql_over_tables(spark, d):
    return query_tables(
        "SELECT ClusterID, mz_wmean AS precursor_mz_wmean, note FROM {ms1} WHERE retention_time_wmean >= 1997",
        ms1=T(spark, d, "ms1"),
    )


def _spectrum_files(spark, d):
    path = new_path(spark, "records")
    text = F.concat(
        F.lit("BEGIN IONS\nTITLE="), F.col("doc_id").cast("string"), F.lit("\n"), "text", F.lit("\nEND IONS")
    )
    T(spark, d, "documents").select(text).write.text(path)
    return path


def record_scan(spark, d):
    lines = F.split("text", "\n", 3)
    body = F.substring(lines[2], F.lit(1), F.length(lines[2]) - len("\nEND IONS\n"))
    return read_records(spark, _spectrum_files(spark, d)).select(
        F.substring(lines[1], 7, 20).cast("bigint").alias("doc_id"),
        F.octet_length("text").cast("bigint").alias("bytes"),
        F.sha2(body, 256).alias("sha256"),
    )


def record_line_ends(spark, d):
    """Records with line ends of all kinds in one folder, and ends that are not alone on their line."""
    kind = F.col("doc_id") % 3
    end = F.when(kind == 0, "\n").when(kind == 1, "\r\n").otherwise("\r")
    words = F.regexp_replace("text", "[\n\r]", " ")
    head = F.concat(F.lit("BEGIN IONS"), end, F.lit("TITLE="), F.col("doc_id").cast("string"), end, words, end)
    path = new_path(spark, "ends")
    T(spark, d, "documents").select(F.concat(head, F.when(kind == 0, " END IONS ").otherwise("END IONS"), F.when(kind == 1, "\r").otherwise(""))).write.text(path)
    return read_records(spark, path).select(
        F.regexp_extract("text", r"TITLE=(\d+)", 1).cast("bigint").alias("doc_id"), F.sha2("text", 256).alias("sha256")
    )


def fasta_summary(spark, d):
    path = new_path(spark, "fasta")
    record = F.concat(
        F.lit(">"),
        F.when(F.col("doc_id") % 10 == 0, "rev_").otherwise(""),
        F.lit("DOC"),
        F.col("doc_id").cast("string"),
        F.lit(" "),
        "source",
        F.lit("\n"),
        F.regexp_replace("text", "[^a-z]", ""),
    )
    T(spark, d, "documents").select(record).write.text(path)
    out = sequence_stats(read_fasta(spark, path))
    return out.withColumn("mean_length", F.round("mean_length", 6))


def json_documents(spark, d):
    parsed = F.from_json(checked_json(F.col("props")), "k bigint")
    return T(spark, d, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(parsed["k"]).alias("k_sum")
    )


def json_files(spark, d):
    """One JSON file per event type, read back as whole documents."""
    counted = T(spark, d, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("value").alias("highest")
    )
    path = new_path(spark, "documents")
    text = F.to_json(F.struct("event_type", "n", "highest")).alias("value")
    counted.select("event_type", text).write.partitionBy("event_type").text(path)
    parsed = F.from_json("document", "event_type string, n bigint, highest double").alias("p")
    return tables.read_document(spark, path).select(parsed).select("p.*")


def csv_round_trip(spark, d):
    path = new_path(spark, "csv")
    sinks.write_csv(edge_counts(T(spark, d, "edges")), path)
    return spark.read.schema("MS1_ClusterID bigint, MS2_ClusterID bigint, edges bigint").csv(path, header=True)


def append_round_trip(spark, d):
    path = new_path(spark, "appended")
    edges = T(spark, d, "edges")
    for low, high in ((0, 10), (10, 25), (25, 1000)):
        sinks.append_table(edges.where((F.col("score") > low) & (F.col("score") <= high)), path)
    return tables.read_columns(spark, path)


def report_round_trip(spark, d):
    path = new_path(spark, "report")
    report = T(spark, d, "edges").groupBy("MS2_ClusterID").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("Y") == 1, F.col("score"))).alias("lowest_positive")
    )
    sinks.write_report(report, path)
    return spark.read.schema("MS2_ClusterID bigint, n bigint, lowest_positive double").json(path)


def text_shards(spark, d):
    path = new_path(spark, "shards")
    records = T(spark, d, "documents").withColumn("record", F.concat("text", F.lit("\n")))
    bins = pack(records, "source", "doc_id", F.octet_length("record"), 50_000)
    sinks.write_shards(records, bins, path, "source", "doc_id", "record")
    # read whole lines back; the partition columns come from the folder names
    lines = spark.read.text(path)
    return lines.groupBy("source", F.col("bin").cast("bigint").alias("bin")).agg(
        F.sum(F.octet_length("value") + 1).alias("bytes")
    )


def result_table(spark, d):
    docs = T(spark, d, "events").select(
        F.col("event_type").alias("command"), F.col("props").alias("result")
    )
    path = new_path(spark, "results")
    sinks.append_results(docs, path)
    stored = spark.read.parquet(path)
    return stored.select("id", "command", "result", "reproducibility", (F.second("date") == F.extract(F.lit("SECOND"), "date")).alias("whole_seconds"))


def sorted_fragments(spark, d):
    path = new_path(spark, "fragments")
    sinks.write_table(in_order(T(spark, d, "fragments"), ["psm_id", "fragment_mz_experimental"]), path)
    return tables.read_columns(spark, path, ["psm_id", "fragment_mz_experimental"])


def content_digest(spark, d):
    return content_digests(T(spark, d, "documents"), "doc_id", "text")


def file_digest(spark, d):
    """Write files of fifty documents each and digest the files."""
    path = new_path(spark, "files")
    docs = T(spark, d, "documents").select(F.floor(F.col("doc_id") / 50).alias("batch"), "doc_id", "text")
    docs.repartition("batch").sortWithinPartitions("batch", "doc_id").select("batch", "text").write.partitionBy("batch").text(path)
    return file_digests(spark, path).select(
        F.regexp_extract("path", r"batch=(\d+)", 1).cast("bigint").alias("batch"), F.col("size").alias("bytes"), "sha256"
    )


PACK_SQL = """
    WITH RECURSIVE r AS (
      SELECT source, doc_id, octet_length(encode(text)) + {extra} AS size,
        row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn
      FROM documents
    ), f AS (
      SELECT source, doc_id, rn, CASE WHEN size < {limit} THEN 0 ELSE 1 END AS bin, size AS cur, size
      FROM r WHERE rn = 1
      UNION ALL
      SELECT r.source, r.doc_id, r.rn,
        CASE WHEN f.cur + r.size < {limit} THEN f.bin ELSE f.bin + 1 END,
        CASE WHEN f.cur + r.size < {limit} THEN f.cur + r.size ELSE r.size END, r.size
      FROM f JOIN r ON r.source = f.source AND r.rn = f.rn + 1
    )"""

QUERIES = {
    "column_scan": (column_scan, "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem"),
    "tsv_scan": (tsv_scan, f"SELECT * FROM {D('rescored')}"),
    "sql_over_tables": (
        sql_over_tables,
        f"SELECT ClusterID, mz_wmean AS precursor_mz_wmean, note FROM {D('ms1')} WHERE retention_time_wmean >= 1997",
    ),
    "record_scan": (
        record_scan,
        """SELECT doc_id, cast(octet_length(encode(text)) + length('BEGIN IONS') + length('TITLE=')
             + length(cast(doc_id AS varchar)) + length('END IONS') + 4 AS bigint) AS bytes,
             sha256(text) AS sha256 FROM documents""",
    ),
    "record_line_ends": (
        record_line_ends,
        r"""SELECT doc_id, sha256(concat('BEGIN IONS', chr(10), 'TITLE=', doc_id, chr(10), replace(replace(text, chr(10), ' '), chr(13), ' '),
              chr(10), CASE WHEN doc_id % 3 = 0 THEN ' END IONS ' ELSE 'END IONS' END, chr(10))) AS sha256 FROM documents""",
    ),
    "fasta_summary": (
        fasta_summary,
        """WITH s AS (SELECT doc_id, length(regexp_replace(text, '[^a-z]', '', 'g')) AS n FROM documents)
           SELECT count(*) AS n_sequences, count(DISTINCT doc_id) AS n_accessions,
             count(*) FILTER (doc_id % 10 = 0) AS n_decoys, cast(sum(n) AS bigint) AS n_residues,
             cast(min(n) AS int) AS min_length, cast(max(n) AS int) AS max_length,
             round(cast(sum(n) AS double) / count(*), 6) AS mean_length FROM s""",
    ),
    "json_documents": (
        json_documents,
        """SELECT event_type, count(*) AS n,
             cast(sum(cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS bigint)) AS bigint) AS k_sum
           FROM events GROUP BY event_type""",
    ),
    "json_files": (
        json_files,
        "SELECT event_type, count(*) AS n, max(value) AS highest FROM events GROUP BY event_type",
    ),
    "csv_round_trip": (
        csv_round_trip,
        f"""SELECT count(DISTINCT MS1_ClusterID) AS MS1_ClusterID,
              count(DISTINCT MS2_ClusterID) AS MS2_ClusterID, count(*) AS edges FROM {D('edges')}""",
    ),
    "append_round_trip": (append_round_trip, f"SELECT * FROM {D('edges')} WHERE score > 0 AND score <= 1000"),
    "report_round_trip": (
        report_round_trip,
        f"""SELECT MS2_ClusterID, count(*) AS n, min(score) FILTER (Y = 1) AS lowest_positive
            FROM {D('edges')} GROUP BY MS2_ClusterID""",
    ),
    "text_shards": (
        text_shards,
        PACK_SQL.format(extra=1, limit=50000)
        + " SELECT source, cast(bin AS bigint) AS bin, cast(sum(size) AS bigint) AS bytes FROM f GROUP BY source, bin",
    ),
    "result_table": (
        result_table,
        """SELECT row_number() OVER (ORDER BY event_type, props) AS id, event_type AS command,
             props AS result, '{}' AS reproducibility, true AS whole_seconds FROM events""",
    ),
    "sorted_fragments": (
        sorted_fragments,
        "SELECT l_orderkey AS psm_id, l_extendedprice AS fragment_mz_experimental FROM lineitem",
    ),
    "content_digest": (content_digest, "SELECT doc_id, sha256(text) AS sha256 FROM documents"),
    "file_digest": (
        file_digest,
        """SELECT doc_id // 50 AS batch, octet_length(encode(t)) AS bytes, sha256(t) AS sha256 FROM (
             SELECT doc_id // 50 * 50 AS doc_id, concat(string_agg(text, chr(10) ORDER BY documents.doc_id), chr(10)) AS t
             FROM documents GROUP BY 1)""",
    ),
}
