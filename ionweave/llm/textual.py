"""Helpers shared by the text operators: passes over whole texts, words, hashes.

A pass moves the texts to Python in Arrow batches, bounded in rows and bytes by Spark's own
settings, and never needs a second row at the same time.  By default one such batch is a whole split of a
file, so it is worked off in slices of ``SLICE`` bytes.  A worker process lives on between tasks, so a pass
gives the memory that it has freed back to the system.  Nothing here shuffles.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructField, StructType
from xxhash import xxh3_64_intdigest

WORD = r"[^\x20\x09-\x0D]+"
SLICE = 8 << 20  # bytes of texts that are made Python objects at once, about
Pass = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
_WEIGHT = np.uint64(0x9E3779B97F4A7C15)  # odd, so that no bit of a word's hash is lost
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it


def free_name(columns: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column has that name in any case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def append(
    df: DataFrame,
    text_col: str,
    name: str,
    kind: DataType,
    make: Callable[..., Sequence | pa.Array],
    keep: Sequence[str] | None = None,
    arrow_texts: bool = False,
) -> DataFrame:
    """The columns ``keep`` (default: all) and ``name``, which ``make`` gets from a batch's texts.

    A null text counts as empty.  ``make`` returns one value per text.  It gets a list, or with
    ``arrow_texts`` an Arrow array without nulls.
    """
    keep = list(df.columns if keep is None else keep)
    text = free_name(keep, "_text")
    schema = StructType([df.schema[c] for c in keep] + [StructField(name, kind, True)])
    arrow = to_arrow_type(kind)

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, len(keep)):
            texts = strings(batch.column(len(keep)))
            made = make(texts if arrow_texts else texts.to_pylist())
            if not isinstance(made, pa.Array):
                made = pa.array(made, arrow)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], made], [*keep, name])

    quoted = [F.col(f"`{c}`") for c in keep]
    return df.select(*quoted, F.col(f"`{text_col}`").alias(text)).mapInArrow(run, schema)


def sliced(batches: Iterator[pa.RecordBatch], at: int, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in order, in batches with texts of at most ``most`` bytes in column ``at``, or of one row."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(), dtype=np.int64)
        first, done = 0, 0
        while first < len(ends):
            last = max(first + 1, int(np.searchsorted(ends, done + most, "right")))
            yield batch.slice(first, last - first)
            first, done = last, int(ends[last - 1])


def give_back() -> None:
    """Return memory that is free in this process to the system; a few milliseconds."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def lean(run: Pass) -> Pass:
    """The same pass; freed memory goes back after each batch that it makes, and after the last one what it held."""

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = run(batches)
        for out in made:
            yield out
            del out
            give_back()
        give_back()

    return passed


def strings(column: pa.Array) -> pa.Array:
    """A string array without nulls: a null text is empty."""
    return pc.fill_null(column.cast(pa.string()), "")


def words(text: str) -> list[bytes]:
    """Words as UTF-8; bytes.split() splits at exactly the ASCII white space of ``WORD``."""
    return text.encode().split()


def lowered_words(text: str) -> list[bytes]:
    """Words with A-Z in lower case; bytes.lower() leaves every other character."""
    return text.encode().lower().split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, tokens), np.uint64, len(tokens))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` hashes; empty if there are fewer."""
    n = len(hashes) - size + 1
    if n < 1:
        return np.empty(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, size):
        out *= _WEIGHT
        out += hashes[k : n + k]
    out ^= out >> np.uint64(31)
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words, as unsigned numbers.

    A text with fewer words has one: its whole sequence.  Without words there is none.
    Two different runs share a hash with a probability of 2**-64.
    """
    tokens = lowered_words(text)
    if not tokens:
        return np.empty(0, np.uint64)
    if len(tokens) < size:
        return np.array([xxh3_64_intdigest(b" ".join(tokens), seed=len(tokens))], np.uint64)
    return np.unique(windows(word_hashes(tokens), size))


def digest_of_spans(spans: list[tuple[int, int, int]], kinds: Sequence[str]) -> str:
    """``kind:start:end`` by start, then kind as listed, joined by commas."""
    return ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))


def sha256_hex(value: str) -> str:
    return hashlib.sha256(value.encode()).hexdigest()


def n_words(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
