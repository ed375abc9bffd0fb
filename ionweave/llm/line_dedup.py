"""Lines that many documents share, found with two Bloom filters.

A line's key is the line without ASCII white space at its ends and with A-Z in lower case.  Keys of at least ``shortest`` code
points that occur in at least ``least`` documents are repeated; their lines go, except in the document of the
largest id among those that hold the key.

1. Each task puts the hashes of its lines into two filters: a hash seen for the first time goes into
   the first, one seen again in another document into the second.  Filters of tasks are merged segment by segment: the first ones are united, and
   what two first ones share joins the second.  Every hash of two documents is then in the second filter.
2. A second pass over the texts asks the second filter.  Only suspected lines, as 128-bit hashes, are shuffled; the
   documents that hold each are counted exactly, map side first, together with the largest id.
3. What is confirmed goes back to the documents with suspected lines; all other documents are never shuffled.

The filters have 16 bits a line, up to ``MOST_BITS``.  Beyond that they fill, more lines are suspected, and more hashes are
shuffled; the result stays exact.  Filters are built by as many tasks as the cluster has cores, so that merging moves a
bounded number of them.  Two different lines share a hash with a probability of 2**-128.

Defined results: a null text stays null and counts as one empty line; an empty text is one empty line; a key counts once per row, and
each row is a document; all rows with the largest id that holds a key keep its lines; a null id is below all others;
if no holder has an id, all keep the line.  Lines that stay keep their characters and order.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType
from xxhash import xxh3_128_digest

from ionweave.llm.bitmaps import MOST_BITS, bits_for
from ionweave.llm.textual import append, free_name, strings

SHORTEST, LEAST = 20, 3
SEGMENT = 1 << 16  # bits of a filter that travel as one row
ROWS_PER_TASK = 20_000_000  # a line with more holders than this is spread over several tasks
_BLANK = " \t\n\r\f\v"

Stage = Callable[[DataFrame], DataFrame]


def line_hashes(text: str, shortest: int) -> list[bytes | None]:
    """Hash of each line's key; none for short keys."""
    keys = (line.strip(_BLANK) for line in text.split("\n"))
    return [xxh3_128_digest(k.encode().lower()) if len(k) >= shortest else None for k in keys]


def _numbers(hashes: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(hashes), "<u8").reshape(-1, 2)


class Filters:
    """Once-seen and twice-seen hashes as two Bloom filters of the same size."""

    def __init__(self, bits: int, probes: int):
        self.bits, self.probes = bits, probes
        self.once, self.twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)

    def _places(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        step = np.arange(self.probes, dtype=np.uint64)[:, None]
        at = (numbers[:, 0] + step * (numbers[:, 1] | np.uint64(1))) & np.uint64(self.bits - 1)
        return (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)

    @staticmethod
    def _set(into: np.ndarray, where: np.ndarray, bit: np.ndarray) -> None:
        np.bitwise_or.at(into, where.ravel(), bit.ravel())

    def add(self, numbers: np.ndarray) -> None:
        """Hashes of one or more documents, each once per document."""
        _, first, count = np.unique(numbers[:, 0], return_index=True, return_counts=True)
        numbers = numbers[first]
        where, bit = self._places(numbers)
        again = (count > 1) | ((self.once[where] & bit) != 0).all(axis=0)
        self._set(self.twice, where[:, again], bit[:, again])
        self._set(self.once, where, bit)

    def suspected(self, numbers: np.ndarray) -> np.ndarray:
        where, bit = self._places(numbers)
        return ((self.twice[where] & bit) != 0).all(axis=0)


def merge(once: np.ndarray, twice: np.ndarray, more_once: np.ndarray, more_twice: np.ndarray) -> None:
    """Join the filters of other lines to ``once`` and ``twice``, in place."""
    twice |= more_twice | (once & more_once)
    once |= more_once


def twice_seen(docs: DataFrame, text_col: str, shortest: int, most_bits: int = MOST_BITS) -> Filters:
    """Filters over all lines; only the second one is filled in.  Runs at once."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    long_lines = F.least(breaks, F.floor(F.length(text) / max(1, shortest)))  # at most so many lines can count
    n = int(docs.agg(F.sum(long_lines)).first()[0] or 0)
    bits = bits_for(n, 16, most_bits)
    probes = min(4, max(1, round(0.35 * bits / max(1, n))))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(bits, probes)
        for batch in batches:
            found: list[bytes] = []
            for t in strings(batch.column(0)).to_pylist():
                found += {h for h in line_hashes(t, shortest) if h}
            if found:
                own.add(_numbers(found))
        size = SEGMENT // 8
        for k in range(bits // SEGMENT):
            part = slice(k * size, (k + 1) * size)
            if own.once[part].any():
                packed = [zlib.compress(x[part].tobytes(), 1) for x in (own.once, own.twice)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int64()), *(pa.array([x], pa.binary()) for x in packed)], ["segment", "once", "twice"]
                )

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, once, twice = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int64()), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())], ["segment", "twice"]
            )

        for batch in batches:  # sorted by segment
            for k, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (a, b))
                if k == at:
                    merge(once, twice, a, b)
                    continue
                if at is not None:
                    yield done()
                at, once, twice = k, a.copy(), b.copy()
        if at is not None:
            yield done()

    tasks = docs.sparkSession.sparkContext.defaultParallelism
    parts = docs.select(text.alias("t")).coalesce(tasks).mapInArrow(build, "segment long, once binary, twice binary")
    merged = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(united, "segment long, twice binary")
    out = Filters(bits, probes)
    for row in merged.toLocalIterator():
        start = row["segment"] * (SEGMENT // 8)
        out.twice[start : start + SEGMENT // 8] = np.frombuffer(zlib.decompress(row["twice"]), np.uint8)
    return out


def without_repeated_lines(
    docs: DataFrame,
    stage: Stage,
    least: int = LEAST,
    shortest: int = SHORTEST,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_task: int = ROWS_PER_TASK,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """All columns of ``docs``, texts without repeated lines, and a struct ``_lines`` of n_lines and n_dropped.

    Runs at once; ``stage`` stores a table.
    """
    if least < 2:
        raise ValueError("least must be 2 or more: a line of one document is in the first filter only")
    spark = docs.sparkSession
    seen = twice_seen(docs, text_col, shortest, most_bits)
    sent = spark.sparkContext.broadcast((seen.bits, seen.probes, seen.twice))  # at most most_bits / 8 bytes
    columns = list(docs.columns)
    row, count, suspects, gone, report = (
        free_name(columns, c) for c in ("_row", "_n_lines", "_suspects", "_gone", "_lines")
    )

    def suspected(texts: list[str]) -> list[list[bytes]]:
        filters = Filters(8, 1)
        filters.bits, filters.probes, filters.twice = sent.value
        hashes = [list({h for h in line_hashes(t, shortest) if h}) for t in texts]
        every = [h for hs in hashes for h in hs]
        if not every:
            return [[] for _ in texts]
        asked = iter(filters.suspected(_numbers(every)).tolist())
        return [[h for h in hs if next(asked)] for hs in hashes]

    found = append(docs, text_col, suspects, ArrayType(BinaryType()), suspected)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    found = stage(
        found.withColumn(row, F.monotonically_increasing_id()).withColumn(
            count, (F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1).cast("long")
        )
    )
    lines = found.select(F.col(row).alias("row"), F.col(f"`{id_col}`").alias("doc"), F.explode(suspects).alias("line"))
    repeated = stage(lines.groupBy("line").agg(F.count("*").alias("n"), F.max("doc").alias("last")).where(F.col("n") >= least))
    dropped = _by_line(lines, repeated, rows_per_task).where(~F.col("doc").eqNullSafe(F.col("last")))
    per_row = dropped.groupBy(F.col("row").alias(row)).agg(F.collect_list("line").alias(gone))

    n_dropped = free_name(columns, "_n_dropped")
    held = found.where(F.size(suspects) > 0).drop(suspects).join(per_row, row, "left").drop(row)
    cut = _cut(held, text_col, gone, n_dropped, shortest)
    rest = found.where(F.size(suspects) == 0).drop(suspects, row).withColumn(n_dropped, F.lit(0).cast("long"))
    both = cut.select(*columns, count, n_dropped).unionByName(rest.select(*columns, count, n_dropped))
    return both.select(
        *[F.col(f"`{c}`") for c in columns],
        F.struct(F.col(count).alias("n_lines"), F.col(n_dropped).alias("n_dropped")).alias(report),
    )


def _by_line(lines: DataFrame, repeated: DataFrame, rows_per_task: int) -> DataFrame:
    """Join of both on the line; lines of very many documents are split over several tasks."""
    parts = F.ceil(F.col("n") / rows_per_task).cast("int")
    hot = repeated.where(F.col("n") > rows_per_task).select("line", parts.alias("parts"))  # one in rows_per_task at most
    if hot.isEmpty():
        return lines.join(repeated, "line")
    split = lines.join(F.broadcast(hot), "line", "left").withColumn("salt", F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(1))))
    copied = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1)))
    return split.join(copied, ["line", "salt"])


def _cut(held: DataFrame, text_col: str, gone: str, n_dropped: str, shortest: int) -> DataFrame:
    """Texts without the lines whose hashes are in the list ``gone``, and how many lines went."""
    names = held.columns
    at, by = names.index(text_col), names.index(gone)
    fields = [f for f in held.schema if f.name != gone]
    schema = StructType([*fields, StructField(n_dropped, LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for text, out in zip(batch.column(at).to_pylist(), batch.column(by).to_pylist(), strict=True):
                drop = set(out or ())
                if not drop:
                    texts.append(text)
                    counts.append(0)
                    continue
                lines = text.split("\n")
                kept = [x for x, h in zip(lines, line_hashes(text, shortest), strict=True) if h not in drop]
                texts.append("\n".join(kept))
                counts.append(len(lines) - len(kept))
            columns = [pa.array(texts, batch.column(i).type) if i == at else c for i, c in enumerate(batch.columns) if i != by]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], schema.names)

    return held.mapInArrow(run, schema)


def digests(docs: DataFrame, stage: Stage) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_dropped`` and ``kept_sha256`` of each document."""
    cut = without_repeated_lines(docs, stage)
    return cut.select("doc_id", "_lines.*", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
