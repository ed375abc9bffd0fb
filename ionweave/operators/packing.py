"""Size-bounded packing of an ordered sequence into numbered bins.

A record joins the open bin if the bin stays below the limit; otherwise it opens the
next one, whatever its own size.  Bin 0 starts empty.  Where a bin ends depends on all
records before, so the rule looks sequential per file.  It is run in parallel all the same:

1. Each segment of a file (a bounded run of neighbours) is summed up as a function from
   "bytes in the open bin on entry" to "bins opened here, bytes in the open bin on exit".  That
   function is a short step table: only the place of the first new bin depends on the entry.
2. Step tables compose: two neighbours make one table of the same kind.  ``FAN`` neighbours are composed at a time, level by
   level, until a file has one table.
3. From an empty bin at the start of a file, entry states are handed down the same tree: a group gets its own entry
   state and finds those of its members.
4. Each segment numbers its own records from its entry state.

All steps work on all groups of all files at once, and a file of n segments takes about log(n) levels.  A table has
at most as many steps as a bin has records, so a group stays bounded at every level.  Records carry only their size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ionweave.operators.ordering import int_div, with_row_index
from ionweave.staging import stage

SEGMENT_SPAN = 1 << 16  # positions per segment when the caller names no segment
FAN = 64  # neighbours composed at a time


def _bin_starts(ends: np.ndarray, entry: int, limit: int) -> list[int]:
    """Places of the records that open a bin, for a segment entered with ``entry`` bytes."""
    starts = []
    at = int(np.searchsorted(ends, limit - entry, side="left"))
    while at < len(ends):
        starts.append(at)
        before = int(ends[at - 1]) if at else 0
        at = max(at + 1, int(np.searchsorted(ends, before + limit, side="left")))
    return starts


@dataclass(frozen=True)
class Steps:
    """What a run of records does to the open bin: with entry ``e``, the first ``reach >= limit - e`` applies.

    It opens ``opened`` bins and leaves ``left`` bytes in the last.  If there is none, all ``size`` bytes join the open bin.
    """

    size: int
    reach: np.ndarray
    opened: np.ndarray
    left: np.ndarray

    @classmethod
    def of(cls, row) -> Steps:
        return cls(int(row.bytes), *(np.asarray(x, np.int64) for x in (row.reach, row.opened, row.remaining)))

    def after(self, entry: int, limit: int) -> tuple[int, int]:
        """Bytes in the open bin on exit, and bins opened."""
        at = int(np.searchsorted(self.reach, limit - entry, side="left"))
        return (int(self.left[at]), int(self.opened[at])) if at < len(self.reach) else (entry + self.size, 0)

    def then(self, following: Steps, limit: int) -> Steps:
        """Steps of both runs, one behind the other."""
        at = np.searchsorted(following.reach, limit - self.left, side="left")
        again = at < len(following.reach)
        more = np.minimum(at, max(0, len(following.reach) - 1))
        left, opened = self.left + following.size, self.opened.copy()
        if len(following.reach):
            left = np.where(again, following.left[more], left)
            opened = np.where(again, opened + following.opened[more], opened)
        return _short(
            self.size + following.size,
            np.concatenate([self.reach, following.reach + self.size]),
            np.concatenate([opened, following.opened]),
            np.concatenate([left, following.left]),
            limit,
        )


def _short(size: int, reach: np.ndarray, opened: np.ndarray, left: np.ndarray, limit: int) -> Steps:
    """Without steps that no entry needs: those behind the first that even an empty bin takes, and repeats."""
    k = min(int(np.searchsorted(reach, limit, side="left")) + 1, len(reach))
    reach, opened, left = reach[:k], opened[:k], left[:k]
    last = np.append((np.diff(opened) != 0) | (np.diff(left) != 0), True)[:k]
    return Steps(size, reach[last], opened[last], left[last])


def steps_of(sizes: np.ndarray, limit: int) -> Steps:
    """Steps of a segment, from the sizes of its records in order."""
    ends = sizes.cumsum()
    n = len(ends)
    befores = ends - sizes
    following = np.maximum(np.arange(n) + 1, np.searchsorted(ends, befores + limit, side="left")).tolist()
    opened, final = [1] * n, list(range(n))
    for i in range(n - 1, -1, -1):  # bins opened from a start at i to the end, and the last of them
        j = following[i]
        if j < n:
            opened[i], final[i] = 1 + opened[j], final[j]
    left = ends[-1] - befores[np.array(final, dtype=np.int64)]
    return _short(int(ends[-1]), ends, np.array(opened, dtype=np.int64), left, limit)


def _entries(tables: DataFrame, limit: int, fan: int, file_type: str) -> DataFrame:
    """Entry state of each segment: (file, part, entry, number).  ``tables`` has a step table per (file, part)."""
    state = f"file {file_type}, place bigint, entry bigint, number bigint"
    table = f"file {file_type}, place bigint, bytes bigint, reach array<bigint>, opened array<bigint>, remaining array<bigint>"
    lowest = stage(with_row_index(tables, ["part"], by=["file"], name="place"), "steps")

    def composed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        whole = None
        for row in rows.itertuples(index=False):
            own = Steps.of(row)
            whole = own if whole is None else whole.then(own, limit)
        return pd.DataFrame(
            {
                "file": [key[0]], "place": [key[1]], "bytes": [whole.size], "reach": [whole.reach],
                "opened": [whole.opened], "remaining": [whole.left],
            }
        )

    def handed_down(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        entry, number = int(above["entry"].iat[0]), int(above["number"].iat[0])
        out = []
        for row in rows.sort_values("place").itertuples(index=False):
            out.append((key[0], row.place, entry, number))
            entry, opened = Steps.of(row).after(entry, limit)
            number += opened
        return pd.DataFrame(out, columns=["file", "place", "entry", "number"])

    group = int_div(F.col("place"), fan).alias("group")
    levels = [lowest.drop("part")]
    most = lowest.agg(F.max("place")).first()[0] or 0
    while most > 0:
        above = levels[-1].groupBy("file", group).applyInPandas(composed, table)
        levels.append(stage(above, "steps"))
        most //= fan
    start = F.lit(0).cast("bigint")
    entries = levels.pop().select("file", "place", start.alias("entry"), start.alias("number"))
    for level in reversed(levels):
        above = entries.withColumnRenamed("place", "group").groupBy("file", "group")
        below = level.groupBy("file", group).cogroup(above).applyInPandas(handed_down, state)
        entries = stage(below, "entries")
    found = entries.select(F.col("file").alias("_file"), F.col("place").alias("_place"), "entry", "number")
    same = F.col("file").eqNullSafe(F.col("_file")) & (F.col("place") == F.col("_place"))
    return lowest.join(found, same).select("file", "part", "entry", "number")


def pack(
    records: DataFrame,
    file: str,
    seq: str,
    size: Column,
    limit: float,
    segment: Column | None = None,
    fan: int = FAN,
) -> DataFrame:
    """Bin of each record: (file, seq, bin).

    ``seq`` is the integral position in the file.  ``segment`` is a bigint that grows with the
    position and has a bounded number of rows; by default the position in units of 2**16.
    ``limit`` is in the unit of ``size``.  Step tables are composed ``fan`` at a time.
    """
    if limit <= 0:
        raise ValueError("the limit must be positive")
    if fan < 2:
        raise ValueError("at least two neighbours must be composed at a time")
    whole_limit = int(np.ceil(limit))  # sizes are whole, so "below limit" is the same
    part = segment if segment is not None else int_div(F.col(seq).cast("bigint"), SEGMENT_SPAN)
    sizes = stage(
        records.select(
            F.col(file).alias("file"),
            part.cast("bigint").alias("part"),
            F.col(seq).cast("bigint").alias("seq"),
            size.cast("bigint").alias("size"),
        ),
        "sizes",
    )

    def table(rows: pd.DataFrame) -> pd.DataFrame:
        steps = steps_of(rows.sort_values("seq")["size"].to_numpy(), whole_limit)
        return pd.DataFrame(
            {
                "file": [rows["file"].iat[0]], "part": [rows["part"].iat[0]], "bytes": [steps.size],
                "reach": [steps.reach], "opened": [steps.opened], "remaining": [steps.left],
            }
        )

    def assign(rows: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("seq")
        starts = _bin_starts(rows["size"].to_numpy().cumsum(), int(state["entry"].iat[0]), whole_limit)
        bins = int(state["number"].iat[0]) + np.searchsorted(starts, np.arange(len(rows)), side="right")
        return pd.DataFrame({"file": rows["file"].to_numpy(), "seq": rows["seq"].to_numpy(), "bin": bins})

    file_type = sizes.schema["file"].dataType.simpleString()
    keys = ["file", "part"]
    tables = sizes.groupBy(*keys).applyInPandas(
        table,
        f"file {file_type}, part bigint, bytes bigint, reach array<bigint>, "
        "opened array<bigint>, remaining array<bigint>",
    )
    entries = _entries(tables, whole_limit, fan, file_type)
    return (
        sizes.groupBy(*keys)
        .cogroup(entries.groupBy(*keys))
        .applyInPandas(assign, f"file {file_type}, seq bigint, bin bigint")
        .withColumnsRenamed({"file": file, "seq": seq})
    )
