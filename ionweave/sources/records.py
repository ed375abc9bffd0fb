"""Scans of text made of multi-line records."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ionweave.operators.joins import small
from ionweave.staging import stage

RECORD_END = "END IONS"  # fixed value: text in the last line of a spectrum


_PIECES = "file string, block bigint, size bigint, span bigint, ends boolean, whole boolean, cr boolean, text string"


class _Pieces:
    """Puts the lines of one split of a file together, batch after batch."""

    def __init__(self, file: str, block: int, size: int):
        self.file, self.block, self.size = file, block, size
        self.open: list[str] = []  # text of the record that goes on
        self.span = 0
        self.whole = block == 0  # the first record of a later split may have begun in the split before

    def add(self, values: pa.Array) -> pa.RecordBatch:
        """Records that end within ``values``, which are lines as they were stored."""
        spans = pc.add(pc.binary_length(values), 1).to_numpy(zero_copy_only=False)
        lines = pc.replace_substring_regex(values, r"\r$", "")
        owner = np.arange(len(lines))
        if pc.any(pc.match_substring(lines, "\r")).as_py():  # ends a line by itself
            parts = pc.split_pattern(lines, "\r")
            owner = pc.list_parent_indices(parts).to_numpy()
            lines = parts.flatten()
        ends = np.flatnonzero(pc.match_substring(lines, RECORD_END).to_numpy(zero_copy_only=False))
        bounds = np.concatenate(([0], ends + 1))
        ended = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), lines.slice(0, int(bounds[-1])))
        texts = [t + "\n" for t in pc.binary_join(ended, "\n").to_pylist()]
        total = np.concatenate(([0], np.cumsum(spans)))
        upto = total[owner[ends] + 1]
        sizes = np.diff(np.concatenate(([0], upto)))
        whole = np.ones(len(texts), bool)
        cr = pc.ends_with(values, "\r").to_numpy(zero_copy_only=False)[owner[ends]]
        if texts:
            texts[0] = "".join([*self.open, texts[0]])
            sizes[0] += self.span
            whole[0] = self.whole
            self.open, self.span, self.whole = [], 0, True
        rest = lines.slice(int(bounds[-1])).to_pylist()
        if rest:
            self.open.append("\n".join(rest) + "\n")
        self.span += int(total[-1] - (upto[-1] if len(upto) else 0))
        return self._batch(texts, sizes, np.ones(len(texts), bool), whole, cr)

    def close(self) -> pa.RecordBatch:
        """What is left at the end of the split."""
        n = int(bool(self.open))
        return self._batch(["".join(self.open)] * n, np.array([self.span] * n), *[np.zeros(n, bool)] * 3)

    def _batch(self, texts: list[str], sizes: np.ndarray, ends: np.ndarray, whole: np.ndarray, cr: np.ndarray) -> pa.RecordBatch:
        n = len(texts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([self.file] * n, pa.string()), pa.array([self.block] * n, pa.int64()), pa.array([self.size] * n, pa.int64()),
                pa.array(sizes, pa.int64()), *(pa.array(x, pa.bool_()) for x in (ends, whole, cr)), pa.array(texts, pa.string()),
            ],
            ["file", "block", "size", "span", "ends", "whole", "cr", "text"],
        )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = None
    for batch in batches:
        files, blocks = batch.column(0).dictionary_encode(), batch.column(1).to_numpy()
        codes = files.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(codes) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
            if a == b:
                continue
            file, block = files.dictionary[int(codes[a])].as_py(), int(blocks[a])
            if at is None or (at.file, at.block) != (file, block):
                if at is not None:
                    yield at.close()
                at = _Pieces(file, block, batch.column(2)[a].as_py())
            yield at.add(batch.column(3).slice(a, b - a))
    if at is not None:
        yield at.close()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Spectra of text files: (file, block, row, text).

    A record is all lines up to and with one that holds ``END IONS``, alone or among other characters; lines behind the last one of
    a file are dropped.  Lines end with a line feed, a carriage return or both, also mixed in one file, and each end is a line feed in ``text``;
    a last line without an end stays so.

    A file is read in splits.  Each task puts the lines of its splits together; only what lies across the borders of
    splits, at most two pieces of a split, is numbered by the record ends before it and joined.  All other text stays where it was read.
    Records are stored once: ``block`` and ``row`` give their order within a file and then no longer depend on how it is split.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), "value",
    )
    pieces = stage(lines.mapInArrow(_pieces, _PIECES).withColumn("row", F.monotonically_increasing_id()), "records")
    # a scan takes the line feeds away; a file is shorter than its lines with one each only if the last had none, but a
    # carriage return may be there in its place
    bare = (
        pieces.groupBy("file")
        .agg(F.sum("span").alias("_span"), F.max("size").alias("_size"), F.max(F.struct("block", "row")).alias("_last"))
        .where(F.col("_span") > F.col("_size"))
        .select("file", "_last.block", "_last.row", F.lit(True).alias("_bare"))
    )
    place = ["file", "block", "row"]
    text = F.when(F.col("_bare") & ~F.col("cr"), F.substring("text", F.lit(1), F.length("text") - 1)).otherwise(F.col("text")).alias("text")
    whole = pieces.where("whole").join(bare, place, "left").select(*place, text)

    crossing = pieces.where("NOT whole")
    before = Window.partitionBy("file").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, -1)  # two rows per split
    numbered = crossing.select(*place, "ends", F.coalesce(F.sum(F.col("ends").cast("bigint")).over(before), F.lit(0)).alias("_record"))
    ended = numbered.where("ends").select("file", "_record")
    members = numbered.join(ended, ["file", "_record"]).select(*place, "_record")
    joined = (
        crossing.join(members, place).join(bare, place, "left").select(*place, "_record", text)
        .groupBy("file", "_record")
        .agg(F.sort_array(F.collect_list(F.struct("block", "row", "text"))).alias("_parts"))
        .select("file", F.col("_parts")[0]["block"].alias("block"), F.col("_parts")[0]["row"].alias("row"), F.concat_ws("", "_parts.text").alias("text"))
    )
    return whole.unionByName(joined)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """Protein sequences: (header, sequence); a record starts at a line beginning with ``>``."""
    raw = spark.read.option("lineSep", "\n>").text(path)
    body = F.regexp_replace("value", r"^>|\r", "")
    lines = F.split(body, "\n", 2)
    return raw.where(F.trim("value") != "").select(
        F.element_at(lines, 1).alias("header"),
        F.regexp_replace(F.coalesce(F.try_element_at(lines, F.lit(2)), F.lit("")), r"\s", "").alias("sequence"),
    )


def _sha256(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each stretch of a file (file, block, size, line), from its lines in order."""
    at, digest, span, first = None, None, 0, True

    def done() -> pa.RecordBatch:
        if span == at[2]:  # a file is shorter than its lines with a line feed each only if the last had none
            digest.update(b"\n")
        values = [[at[0]], [at[1]], [at[2]], [span], [digest.hexdigest()]]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], ["file", "block", "size", "span", "sha256"])

    for batch in batches:
        for file, block, size, line in zip(*(c.to_pylist() for c in batch.columns[:3]), batch.column(3), strict=True):
            if at is None or at[:2] != (file, block):
                if at is not None:
                    yield done()
                at, digest, span, first = (file, block, size), hashlib.sha256(), 0, True
            if not first:
                digest.update(b"\n")
            raw = line.as_buffer()
            digest.update(raw)
            span, first = span + raw.size + 1, False
    if at is not None:
        yield done()


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """SHA-256 of whole files, of any content and size: (path, size, sha256).

    Files are read as streams of lines, and a task keeps nothing but the state of the digest.  A file that one split holds is
    done where it is read; the lines of the others are put in order first, by an external sort, as a digest must see
    them one after the other.  A line, up to the next line feed byte, has to fit into 2 GiB.
    """
    kind = "file string, block bigint, size bigint, span bigint, sha256 string"
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("line"),
    )
    once = stage(lines.mapInArrow(_sha256, kind), "digests")
    per_file = once.groupBy("file").agg(F.count(F.lit(1)).alias("_n"), F.max("size").alias("size"), F.max("sha256").alias("sha256"))
    cut = per_file.where("_n > 1").select("file")
    ordered = (
        lines.withColumn("_row", F.monotonically_increasing_id()).join(small(cut), "file")
        .repartition("file").sortWithinPartitions("file", "block", "_row")
        .select("file", F.lit(0).cast("bigint").alias("block"), "size", "line")
    )
    again = ordered.mapInArrow(_sha256, kind).select("file", "size", "sha256") if not cut.isEmpty() else None
    done = per_file.where("_n = 1").select("file", "size", "sha256")
    read = done if again is None else done.unionByName(again)
    # scans pass over empty files, so these are taken from the list of files that the driver has made for the scan
    names = spark.createDataFrame([(f,) for f in lines.inputFiles()], "listed string")
    listed, named = (F.regexp_replace(c, "^file:/+", "file:/") for c in ("listed", "file"))
    empty = names.join(read.select(named.alias("_file")), listed == F.col("_file"), "left_anti").select(
        listed.alias("file"), F.lit(0).cast("bigint").alias("size"), F.sha2(F.lit("").cast("binary"), 256).alias("sha256")
    )
    return read.unionByName(empty).withColumnRenamed("file", "path")
