"""Token counts by a two-tier look-up on the map side.

Tier one is a broadcast table of the lengths of frequent pieces of text, of bounded size.  Every task
keeps the most frequent pieces of its own documents, these few are added up, and the most
frequent of all go into the table.  Tier two is the worker's cache: other pieces are encoded there
when they come up.  No piece is shuffled but the few candidates of each task, and the table steers only
speed: counts are exact whatever is in it.

Defined results: a null or empty text has no bytes and no tokens; equal rows get equal results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ionweave.llm.textual import append, strings
from ionweave.llm.tokens import encoder

TABLE = 32_768  # pieces in the broadcast table
PER_TASK = 4_096  # candidates that a task reports
LONGEST = 64  # characters of a piece in the table, so the table has at most 8 MB


def frequent_pieces(docs: DataFrame, path: str, text_col: str = "text", table: int = TABLE) -> dict[str, int]:
    """Lengths of the most frequent pieces; every document is looked at."""

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            pieces, count = encoder(path).piece_counts(strings(batch.column(0)))
            short = pc.utf8_length(pieces).to_numpy(zero_copy_only=False) <= LONGEST
            order = np.argsort(-(count * short), kind="stable")[: 2 * PER_TASK]
            for piece, n in zip(pieces.take(pa.array(order)).to_pylist(), count[order].tolist()):
                seen[piece] += n
            if len(seen) > 8 * PER_TASK:
                seen = Counter(dict(seen.most_common(4 * PER_TASK)))
        top = [(p, n) for p, n in seen.most_common(PER_TASK) if len(p) <= LONGEST]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"]
        )

    found = docs.select(F.col(f"`{text_col}`").alias("t")).mapInArrow(candidates, "piece string, n long")
    best = found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(table)
    return encoder(path).piece_lengths([r["piece"] for r in best.collect()])  # at most ``table`` rows


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
    table: int = TABLE,
) -> DataFrame:
    """Per document: the id, ``n_bytes`` in UTF-8, ``n_tokens``, and whether these exceed ``limit``.

    Special strings inside a text are special tokens, as by the library's default; no tokens are
    added.  ``path`` names the tokenizer file on every machine.
    """
    known = docs.sparkSession.sparkContext.broadcast(frequent_pieces(docs, path, text_col, table))
    kind = StructType([StructField("n_bytes", LongType()), StructField("n_tokens", LongType())])

    def count(texts: pa.Array) -> pa.Array:
        tokens = encoder(path).lengths(texts, known.value)
        return pa.StructArray.from_arrays(
            [pc.binary_length(texts).cast(pa.int64()), pa.array(tokens, pa.int64())], ["n_bytes", "n_tokens"]
        )

    counted = append(docs, text_col, "_n", kind, count, [id_col], arrow_texts=True)
    return counted.select(F.col(f"`{id_col}`"), "_n.*", (F.col("_n.n_tokens") > limit).alias("over_limit"))
