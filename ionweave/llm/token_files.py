"""Token ids in binary shards with Elias-Fano document bounds.

A shard holds the ids of consecutive documents one after another, as unsigned numbers of two or four
bytes, the ends of the documents in Elias-Fano code, and the documents' own ids.  Shards follow
one another in ascending document id; null ids come first.  Layout, little-endian:

    magic 8 bytes | 10 counts of 8 bytes | ids | low bits | high bits | select samples | document ids

Documents are sorted by a range shuffle; a repeated id is split by the place of its row, so one
id with very many rows does not end up in one task.  A shard is closed when it has ``shard_ids``
ids, and written under a temporary name first, so a task that runs again replaces its own work.
Texts are encoded in slices; besides one of these a task holds the ids of the shard that is open.

Defined results: a null or empty text has the end id alone; equal rows are separate documents;
an empty table has no shards.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ionweave.llm.elias_fano import EliasFano
from ionweave.llm.textual import give_back, lean, sliced, strings
from ionweave.llm.tokens import encoder

MAGIC = b"IDSHARD1"
SHARD_IDS = 4_000_000  # ids after which a shard is closed: 8 or 16 MB


def pack_shard(parts: list[np.ndarray], doc_ids: list[int | None], width: int) -> bytes:
    """One shard; ``parts`` are the ids of each document, in the order of ``doc_ids``."""
    ends = np.cumsum([len(p) for p in parts], dtype=np.int64)
    bounds = EliasFano.of(ends)
    nulls = sum(d is None for d in doc_ids)  # they come first
    names = np.array([d for d in doc_ids if d is not None], "<i8")
    ids = np.concatenate(parts).astype(f"<u{width}", copy=False) if parts else np.empty(0, f"<u{width}")
    pieces = [ids, bounds.low, bounds.high, bounds.samples.astype("<u4")]
    head = [len(parts), len(ids), width, bounds.low_bits, nulls, *(p.nbytes for p in pieces), 0]
    return b"".join([MAGIC, np.array(head, "<i8"), *pieces, names])


class Shard:
    """A shard read back; ``document(i)`` touches only what it needs."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a shard of token ids")
        head = np.frombuffer(content, "<i8", 10, 8).tolist()
        self.n, self.n_ids, width, low_bits, self.nulls = head[:5]
        at, views = 88, []
        for size, kind in zip(head[5:9], (f"<u{width}", np.uint8, np.uint8, "<u4")):
            views.append(np.frombuffer(content, kind, size // np.dtype(kind).itemsize, at))
            at += size
        self.ids = views[0]
        self.bounds = EliasFano(self.n, low_bits, *views[1:])
        self.names = np.frombuffer(content, "<i8", self.n - self.nulls, at)

    def offsets(self) -> np.ndarray:
        """Start of each document and the end of the last."""
        return np.concatenate(([0], self.bounds.select(0, self.n)))

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.bounds[i - 1] if i else 0 : self.bounds[i]]

    def name(self, i: int) -> int | None:
        return None if i < self.nulls else int(self.names[i - self.nulls])


def _store(folder: str, name: str, content: bytes) -> None:
    """Write a file of the shared folder, in one step as seen from outside."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    hidden = f"{root}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(hidden) as out:
        out.write(content)
    system.move(hidden, f"{root}/{name}")


def write_token_files(
    docs: DataFrame,
    folder: str,
    path: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    shard_ids: int = SHARD_IDS,
) -> DataFrame:
    """Encode, write the shards below the URI ``folder`` and return what was written.

    Runs at once.  The result has a row per shard: its file name, place in the order, documents and ids.
    """
    spark: SparkSession = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    ordered = rows.repartitionByRange(n, "doc_id", "row").sortWithinPartitions("doc_id", "row")

    @lean
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts, names, held, number = encoder(path), [], [], 0, 0
        task = TaskContext.get().partitionId()

        def close() -> pa.RecordBatch:
            nonlocal parts, names, held, number
            file = f"ids-{task:06d}-{number:06d}.bin"
            _store(folder, file, pack_shard(parts, names, own.width))
            done = pa.RecordBatch.from_pydict(
                {"file": [file], "task": [task], "number": [number], "docs": [len(parts)], "ids": [held]}
            )
            parts, names, held, number = [], [], 0, number + 1
            return done

        end = np.array([end_id], own.dtype)
        for batch in sliced(batches, 1):
            doc_ids = batch.column(0).to_pylist()
            for doc_id, ids in zip(doc_ids, own.encode(strings(batch.column(1)))):
                parts.append(np.concatenate((ids, end)))
                names.append(doc_id)
                held += len(ids) + 1
                if held >= shard_ids:
                    yield close()
            give_back()
        if parts:
            yield close()

    kind = "file string, task long, number long, docs long, ids long"
    return ordered.select("doc_id", "text").mapInArrow(write, kind)


def read_token_files(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """Per document, from the shards: doc_id, start (ids before it), n_tokens and the ids' crc32.

    ``shards`` is the stored table of what was written.  Only its counts meet in one task, one row per shard.
    """
    before = Window.orderBy("task", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = shards.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    @lean
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0), batch.column(1)):
                shard = Shard(content.as_buffer())
                offsets = shard.offsets()
                sums = [
                    zlib.crc32(shard.ids[a:b].astype("<u4"))
                    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())
                ]
                names = pa.array([None] * shard.nulls + shard.names.tolist(), pa.int64())
                columns = [
                    pa.array([file.as_py()] * shard.n, pa.string()), names, pa.array(offsets[:-1], pa.int64()),
                    pa.array(np.diff(offsets), pa.int64()), pa.array(sums, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["file", "doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "ids-*.bin").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    kind = "file string, doc_id long, start long, n_tokens long, ids_crc32 long"
    rows = named.mapInArrow(read, kind)
    return rows.join(placed, "file").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_file_rows(docs: DataFrame, folder: str, path: str, stage, end_id: int = 2, **columns: str) -> DataFrame:
    """Write the shards, then read every document back from them; ``stage`` stores a table."""
    spark = docs.sparkSession
    shards = stage(write_token_files(docs, folder, path, end_id, **columns))
    if shards.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(spark, folder, shards)
