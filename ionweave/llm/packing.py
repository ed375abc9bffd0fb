"""Packing documents into fixed-length sequences with a bounded number of open windows.

Each task reads its documents once.  Stretches of a whole window leave at once; what is left of a
document goes into the open window with the least room that still holds it (best fit).  If none
does and all windows are open, the fullest one gets the head of the piece and is emitted.  At the end of a task its
open windows are merged by cutting, so at most one leftover window per task remains.  These, with
their ids, are merged in groups of ``group`` until one is left.  Nothing grows with the number
of documents: neither the windows of a task nor a group of leftovers.

Defined results: a null or empty text is its end id alone; equal rows are packed separately;
an empty table gives no pieces; very long texts become many whole windows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionweave.llm.textual import lean, sliced, strings
from ionweave.llm.tokens import encoder

WINDOW = 2048
OPEN = 64  # windows that a task keeps open
GROUP = 256  # leftover windows that are merged in one task

_COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "level", "task", "ids")
_KIND = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, level long, task long, ids binary"
)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4"))


class Packer:
    """Windows of one task.  A piece is (doc_id, start, doc_tokens, ids)."""

    def __init__(self, number: Callable[[], int], window: int = WINDOW, most: int = OPEN):
        self.number, self.window, self.most = number, window, most
        self.open: list[tuple[int, int, list]] = []  # (room, tie, pieces) by room
        self.ties = 0
        self.rows: list[tuple] = []

    def add(self, piece: tuple) -> None:
        doc_id, start, total, ids = piece
        whole = len(ids) // self.window * self.window
        for a in range(0, whole, self.window):
            self._emit([(doc_id, start + a, total, ids[a : a + self.window])])
        if whole < len(ids):
            self._place((doc_id, start + whole, total, ids[whole:]))

    def _place(self, piece: tuple) -> None:
        size = len(piece[3])
        at = bisect_left(self.open, (size,))
        if at == len(self.open) and len(self.open) >= self.most:
            room, _, pieces = self.open.pop(0)  # the fullest
            doc_id, start, total, ids = piece
            self._emit([*pieces, (doc_id, start, total, ids[:room])])
            self._place((doc_id, start + room, total, ids[room:]))
            return
        room, pieces = self.window, []
        if at < len(self.open):
            room, _, pieces = self.open.pop(at)
        pieces = [*pieces, piece]
        if room == size:
            self._emit(pieces)
        else:
            self.ties += 1
            insort(self.open, (room - size, self.ties, pieces))

    def _emit(self, pieces: list) -> None:
        sequence, offset = self.number(), 0
        for doc_id, start, total, ids in pieces:
            self.rows.append((doc_id, start, len(ids), crc(ids), total, sequence, offset, None, None, None))
            offset += len(ids)

    def merge(self) -> list:
        """Close all windows but one by cutting; the pieces of that one."""
        left, room = [], self.window
        windows, self.open = self.open, []
        for _, _, pieces in windows:
            for doc_id, start, total, ids in pieces:
                while len(ids) >= room:
                    self._emit([*left, (doc_id, start, total, ids[:room])])
                    ids, start, left, room = ids[room:], start + room, [], self.window
                if len(ids):
                    left.append((doc_id, start, total, ids))
                    room -= len(ids)
        return left

    def take_rows(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def _numbers(level: int, task: int) -> Callable[[], int]:
    """Sequence ids that no other task gives: level, task and a running number."""
    state = {"next": (level << 58) | (task << 32)}

    def number() -> int:
        state["next"] += 1
        return state["next"] - 1

    return number


def _leftover_rows(pieces: list, level: int, task: int) -> list[tuple]:
    rows, offset = [], 0
    for doc_id, start, total, ids in pieces:
        rows.append((doc_id, start, len(ids), crc(ids), total, None, offset, level, task, ids.astype("<u4").tobytes()))
        offset += len(ids)
    return rows


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_COLUMNS)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


_ARROW = pa.schema([(c, pa.binary() if c == "ids" else pa.int64()) for c in _COLUMNS])


def pack_documents(
    docs: DataFrame,
    path: str,
    stage: Callable[[DataFrame], DataFrame],
    end_id: int = 1,
    window: int = WINDOW,
    most_open: int = OPEN,
    group: int = GROUP,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: doc_id, start in its document, length, crc32 of its ids, doc_tokens, sequence_id, offset.

    ``stage`` stores a table; each level is stored once, so that a piece keeps its place.  Runs at once.
    """
    if window < 1 or most_open < 1 or group < 2:
        raise ValueError("window and most_open must be at least 1, group at least 2")

    @lean
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = encoder(path), TaskContext.get().partitionId()
        packer, end = Packer(_numbers(0, task), window, most_open), np.array([end_id], own.dtype)
        for batch in sliced(batches, 1):
            for doc_id, ids in zip(batch.column(0).to_pylist(), own.encode(strings(batch.column(1)))):
                ids = np.concatenate((ids, end))
                packer.add((doc_id, 0, len(ids), ids))
            yield _batch(packer.take_rows(), _ARROW)
        left = packer.merge()
        yield _batch(packer.take_rows() + _leftover_rows(left, 0, task), _ARROW)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    level, stored = 0, stage(rows.mapInArrow(pack, _KIND))
    done = []
    while True:
        done.append(stored.where("task IS NULL").select(*_COLUMNS[:7]))
        left = stored.where("task IS NOT NULL")
        tasks = left.select(F.count_distinct("task").alias("n")).first()["n"]
        if tasks <= 1:
            # the last window stays as it is, the only one with padding
            last = left.withColumn("sequence_id", F.lit((level + 1) << 58))
            done.append(last.select(*_COLUMNS[:7]))
            break
        level += 1
        stored = stage(_merged(left, level, group, window, most_open))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _merged(left: DataFrame, level: int, group: int, window: int, most_open: int) -> DataFrame:
    """Leftovers of the level below, merged in groups of ``group`` tasks."""

    def merge(key: tuple, rows: pa.Table) -> pa.Table:
        task = key[0].as_py()
        packer = Packer(_numbers(level, task), window, most_open)
        rows = rows.sort_by([("task", "ascending"), ("offset", "ascending")]).to_pydict()
        pieces = [
            (d, s, t, np.frombuffer(i, "<u4"))
            for d, s, t, i in zip(rows["doc_id"], rows["start"], rows["doc_tokens"], rows["ids"])
        ]
        packer.open = [(0, 0, pieces)]
        rest = packer.merge()
        out = packer.take_rows() + _leftover_rows(rest, level, task)
        return pa.Table.from_batches([_batch(out, _ARROW)])

    grouped = left.withColumn("g", F.floor(F.col("task") / group)).groupBy("g")
    return grouped.applyInArrow(merge, _KIND)
