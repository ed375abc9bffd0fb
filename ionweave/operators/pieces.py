"""Large tables that meet smaller ones part by part, moved as packed pieces.

A table of pairs may be far larger than the tables it is held against.  Row by row a shuffle writes tens of bytes of each pair;
here a task sorts up to ``PIECE_ROWS`` rows by their part, and writes the rows of a part as one compressed Arrow stream, a
few bytes a pair.  A part is one task.  It gets the pieces in the order of their kinds, so the small tables come first and are held,
and the large one streams past.  Parts are dealt by the hash of a key; a hot key is spread by a salt, as in ``spread_join``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ionweave.operators.joins import _parts

PIECE_ROWS = 1 << 20  # rows that a task sorts by part at once
HELD_ROWS = 500_000  # rows of the held tables in a part, about
_PIECE = "_part int, _kind int, _rows binary"

Ready = Callable[[pa.RecordBatch], pa.RecordBatch]


def part_of(key: str, salt: str | Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(key, salt), F.lit(parts)).cast("int")


def dealt(df: DataFrame, key: str, by: Sequence[str], hot: list[tuple[int, int]], parts: int) -> DataFrame:
    """Adds ``_part``; the rows of a hot key are salted with the hash of the columns ``by``."""
    if not hot:
        return df.withColumn("_salt", F.lit(0)).withColumn("_part", part_of(key, "_salt", parts)).drop("_salt")
    salted = _parts(df, [key], hot, "_pl").withColumn("_salt", F.pmod(F.xxhash64(*by), F.col("_pl")).cast("int"))
    return salted.withColumn("_part", part_of(key, "_salt", parts)).drop("_pl", "_salt")


def copied(df: DataFrame, key: str, hot: list[tuple[int, int]], parts: int) -> DataFrame:
    """Adds ``_part``; the rows of a hot key go to all parts of their key, once to each."""
    if not hot:
        return dealt(df, key, (), hot, parts)
    salts = F.sequence(F.lit(0), F.col("_pl") - 1)
    theirs = F.array_distinct(F.transform(salts, lambda salt: part_of(key, salt, parts)))  # salts may share a part
    return _parts(df, [key], hot, "_pl").withColumn("_part", F.explode(theirs)).drop("_pl")


def packed(df: DataFrame, kind: int, order: Sequence[str] = (), ready: Ready | None = None) -> DataFrame:
    """Pieces of a table with ``_part``: the part, the kind and the packed rows.  ``ready`` works on batches first, and may add the part.

    Rows of a piece are sorted by the columns ``order``, if these are whole numbers without nulls, so that they pack well.
    """

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        part = rows["_part"].to_numpy()
        sortable = [rows[c] for c in order if pa.types.is_integer(rows.schema.field(c).type) and not rows[c].null_count]
        turn = np.lexsort([*[c.to_numpy() for c in reversed(sortable)], part])
        rows, part = rows.drop_columns(["_part"]).take(pa.array(turn)).combine_chunks(), part[turn]
        cuts = np.flatnonzero(np.diff(part)) + 1
        starts, ends = np.append(0, cuts), np.append(cuts, len(part))
        blobs = []
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_table(rows.slice(a, b - a))
            blobs.append(sink.getvalue().to_pybytes())
        columns = [pa.array(part[starts], pa.int32()), pa.array(np.full(len(starts), kind), pa.int32()), pa.array(blobs, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["_part", "_kind", "_rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            if ready is not None and len(batch):
                batch = ready(batch)
            if len(batch):
                held.append(batch)
                n += len(batch)
            if n >= PIECE_ROWS:
                yield pack(held)
                held, n = [], 0
        if n:
            yield pack(held)

    return df.mapInArrow(run, _PIECE)


def by_part(
    tables: Sequence[DataFrame], parts: int, work: Callable[[Iterator[tuple[int, pa.Table]]], Iterator[pa.Table]], schema: StructType
) -> DataFrame:
    """What ``work`` makes of the (kind, rows) of each part, in the order of the kinds; rows come in pieces."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
        for batch in batches:
            for kind, blob in zip(batch.column("_kind").to_pylist(), batch.column("_rows"), strict=True):
                yield kind, pa.ipc.open_stream(blob.as_buffer()).read_all()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in work(pieces(batches)):
            if len(table):
                yield from table.select(schema.names).combine_chunks().to_batches(max_chunksize=1 << 18)

    met = reduce(DataFrame.unionAll, tables).repartitionById(parts, F.col("_part"))
    return met.sortWithinPartitions("_kind").mapInArrow(run, schema)


class Held:
    """Pieces by kind: those of kinds below ``last`` are held; those of ``last`` come in tables of ``PIECE_ROWS`` rows at least."""

    def __init__(self, pieces: Iterator[tuple[int, pa.Table]], last: int):
        self._pieces, self._last = pieces, last
        self._held: dict[int, list[pa.Table]] = {}

    def streamed(self) -> Iterator[pa.Table]:
        def those() -> Iterator[pa.Table]:
            for kind, rows in self._pieces:
                if kind == self._last:
                    yield rows
                else:
                    self._held.setdefault(kind, []).append(rows)

        yield from gathered(those(), PIECE_ROWS)

    def of(self, *kinds: int, columns: Sequence[str] | None = None) -> pa.Table | None:
        """All rows of some kinds; whole once a streamed table has come, or none will."""
        tables = [t.select(columns) if columns else t for k in kinds for t in self._held.get(k, ())]
        return pa.concat_tables(tables) if tables else None


def gathered(tables: Iterator[pa.Table], rows: int) -> Iterator[pa.Table]:
    """The same rows in tables of at least ``rows`` rows, but for the last."""
    held: list[pa.Table] = []
    n = 0
    for table in tables:
        held.append(table)
        n += len(table)
        if n >= rows:
            yield pa.concat_tables(held)
            held, n = [], 0
    if held:
        yield pa.concat_tables(held)


def is_in(rows: pa.Table, keys: Sequence[str], held: pa.Table | None) -> np.ndarray:
    """Which rows have their key among the rows held?  A key with a null has not."""
    out = np.zeros(len(rows), bool)
    if held is not None and len(held) and len(rows):
        numbered = rows.select(keys).append_column("_at", pa.array(np.arange(len(rows))))
        out[numbered.join(held.select(keys), keys=list(keys), join_type="left semi", use_threads=False)["_at"].to_numpy()] = True
    return out


_ANY = np.int64(1) << np.int64(62)
_MOST_BITS = 1 << 29


class Sieve:
    """Bits of (key hash, bucket of a positive value): tells for sure that no point of a key lies in a range.

    Buckets are equally wide in the logarithm.  ``bits`` are a Bloom filter with two hashes; a range that may hold a point passes,
    and so does one that reaches to 0 or below, or over more than a few buckets.
    """

    def __init__(self, points: DataFrame, key: str, value: str, width: float):
        self.width = width
        n = points.count()
        self.size = size = min(_MOST_BITS, 1 << max(16, (16 * n).bit_length()))
        place = self._places

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, values = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
                bucket, sure = self._bucket(values)
                at = [*place(keys, np.full(len(keys), _ANY)), *place(keys[sure], bucket[sure])]
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(at)) + 1)], ["at"])

        kept = points.where(F.col(key).isNotNull() & F.col(value).isNotNull())
        self.bits = None  # the tasks that find the bits do not need them
        at = kept.select(F.xxhash64(key).alias("k"), F.col(value).cast("double").alias("v")).mapInArrow(run, "at bigint")
        maps = at.groupBy(F.bitmap_bucket_number("at").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("m")).collect()
        bits = np.zeros(size // 8, np.uint8)
        for row in maps:  # 4 kB each, 64 MB at most in all
            from_byte = (row["b"] - 1) * 4096
            found = np.frombuffer(row["m"], np.uint8)
            bits[from_byte : from_byte + 4096] = found[: len(bits) - from_byte]
        self.bits = points.sparkSession.sparkContext.broadcast(bits)

    def _places(self, keys: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = keys.astype(np.int64).view(np.uint64) ^ (bucket.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for by in (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(29))) * by
        x ^= x >> np.uint64(32)
        last = np.uint64(self.size - 1)
        return (x & last).astype(np.int64), ((x >> np.uint64(32)) & last).astype(np.int64)

    def _bucket(self, values: np.ndarray, shift: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        sure = (values > 0) & (values < np.inf)
        bucket = np.floor((np.log(np.where(sure, values, 1.0)) + shift) / self.width)
        return bucket.astype(np.int64), sure

    def _holds(self, keys: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        bits, out = self.bits.value, np.ones(len(keys), bool)
        for at in self._places(keys, bucket):
            out &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return out

    def has_key(self, keys: np.ndarray) -> np.ndarray:
        """Which keys may have points?"""
        return self._holds(keys, np.full(len(keys), _ANY))

    def may_hold(self, keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Which ranges may hold a point of their key?"""
        first, low = self._bucket(lo, -1e-9)  # whatever the logarithm rounded
        last, high = self._bucket(hi, 1e-9)
        out = ~(low & high & (last - first < 8))
        for step in range(8):
            left = np.flatnonzero(~out & (first + step <= last))
            if not len(left):
                break
            out[left] = self._holds(keys[left], first[left] + step)
        return out


def part_count(df: DataFrame, held: int, streamed: int = 0) -> int:
    """Parts for so many rows held and streamed in all."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-held // HELD_ROWS), -(-streamed // (32 * HELD_ROWS)))
