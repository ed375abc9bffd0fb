"""Order on unordered tables: row index, batches, sortedness, ranks, exact quantiles.

Spark tables have no order, so each function takes the order key.  Global order
comes from one range shuffle on the *whole* key, which also splits a hot leading
key, followed by a written table.  The place of a row is then a stored value: the
slice (range partition) it fell into and its position there.  Running totals over
slices touch one row per slice, never the data.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ionweave.operators.joins import MAX_BROADCAST_ROWS, small, spread_join
from ionweave.staging import stage

SLICE, ROW = "_slice", "_row"
_GROUP_LIMIT = 1000  # from this rank on Spark does not cut groups before the shuffle
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def int_div(value: Column, by: int) -> Column:
    """Whole-number quotient of a bigint, without the detour over doubles."""
    return F.call_function("div", value, F.lit(by))


def _columns(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def _slice_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(
    df: DataFrame,
    keys: Sequence[str | Column],
    unique: Sequence[str] = (),
    local: Callable[[DataFrame], DataFrame] | None = None,
    count: int | None = None,
) -> DataFrame:
    """Sort by ``keys`` into range slices; adds ``_slice`` and ``_row``.  There are ``count`` slices, by default as many as shuffle partitions.

    ``unique`` names the columns of ``keys`` if no two rows may agree in them; the job fails if
    some do.  Equal rows are neighbours by then, so this takes no shuffle of its own.  ``local`` works on the sorted
    rows of each slice before they are written; it keeps their number, order and tasks.
    """
    cols = _columns(keys)
    placed = df.repartitionByRange(count or _slice_count(df), *cols).sortWithinPartitions(*cols)
    place = F.monotonically_increasing_id()
    if unique:
        repeat = F.row_number().over(Window.partitionBy(*unique).orderBy(*unique))
        fault = F.concat(
            F.lit(f"rows with the same {', '.join(unique)}: "), F.to_json(F.struct(*unique))
        )
        placed = placed.withColumn("_repeat", repeat)
        placed = placed.select(
            *df.columns, F.when(F.col("_repeat") == 1, place).otherwise(F.raise_error(fault).cast("bigint")).alias("_place")
        )
    else:
        placed = placed.withColumn("_place", place)
    return (
        stage(local(placed) if local else placed, "slices")
        .withColumn(SLICE, F.shiftright("_place", _ROW_BITS).cast("int"))
        .withColumn(ROW, F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_place")
    )


def running(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Bigint columns without nulls become their running totals within each partition, in the order of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = dict.fromkeys(names, 0)
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            for name in names if len(batch) else ():
                totals = np.cumsum(columns[name].to_numpy()) + carried[name]
                carried[name] = int(totals[-1])
                columns[name] = pa.array(totals)
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return df.mapInArrow(run, df.schema)


def _piece_offsets(staged: DataFrame, by: Sequence[str], size: Column) -> DataFrame:
    """Per (slice, group): rows of the group in earlier slices and in all slices.

    With no group there is one row per slice.  With groups there are at most
    (groups + slices) rows, as only a group at a slice border is in two slices.
    """
    pieces = staged.groupBy(SLICE, *by).agg(size.alias("_size"), F.min(ROW).alias("_first"))
    w = Window.partitionBy(*by)
    before = w.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return pieces.select(
        SLICE,
        *by,
        "_first",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"),
        F.sum("_size").over(w).alias("_total"),
    )


def _with_offsets(staged: DataFrame, offsets: DataFrame, by: Sequence[str]) -> DataFrame:
    if not by:  # one row per slice: as many rows as the range shuffle has partitions
        return staged.join(F.broadcast(offsets), SLICE)
    renamed = offsets.select(
        F.col(SLICE).alias("_s"),
        *[F.col(b).alias(f"_by{i}") for i, b in enumerate(by)],
        "_first",
        "_before",
        "_total",
    )
    same = F.col("_s") == F.col(SLICE)
    for i, b in enumerate(by):
        same = same & F.col(f"_by{i}").eqNullSafe(F.col(b))
    # the join key holds the slice, so no key has more rows than one slice
    return staged.join(renamed, same).drop("_s", *[f"_by{i}" for i in range(len(by))])


def with_row_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    by: Sequence[str] = (),
    name: str = "original_idx",
    size_name: str | None = None,
    unique: bool = True,
) -> DataFrame:
    """Dense index 0..n-1 in the order of ``order_by``, per group when ``by`` is given.

    ``order_by`` together with ``by`` must be a key of the table; rows that share a key of
    plain columns fail the job.  With ``unique=False`` rows may share a key; the table is
    then stored once more first, and the stored place of a row breaks ties, which also splits a
    large run of equal rows.  ``size_name`` adds the row count of the group.
    """
    keys = [*by, *order_by]
    if unique:
        staged = slices(df, keys, keys if all(isinstance(k, str) for k in keys) else ())
    else:
        numbered = stage(df.withColumn("_tie", F.monotonically_increasing_id()), "ties")
        staged = slices(numbered, [*keys, "_tie"])
    joined = _with_offsets(staged, _piece_offsets(staged, by, F.count(F.lit(1))), by)
    extra = [F.col("_total").alias(size_name)] if size_name else []
    index = (F.col("_before") + F.col(ROW) - F.col("_first")).alias(name)
    return joined.select(*df.columns, index, *extra)


def _stored_files(stored: DataFrame) -> DataFrame:
    """Per file of a stored table: ``_path`` and ``_before``, the rows of the files in front of it.

    Files stand in the order of their folders, then of the numbers of their parts, then of their names.
    Only the row counts in the footers are read.
    """
    counts = stored.select(F.col("_metadata.file_path").alias("_path")).groupBy("_path").agg(F.count(F.lit(1)).alias("_n"))
    folder, part = F.regexp_replace("_path", r"[^/]*$", ""), F.regexp_extract("_path", r"part-(\d{1,18})[^/]*$", 1)
    number = F.coalesce(F.expr("try_cast(_part AS bigint)"), F.lit(-1))
    before = Window.orderBy(folder, number, "_path").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = counts.withColumn("_part", part).select("_path", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return stage(placed, "files")


def with_stored_index(stored: DataFrame, name: str = "original_idx") -> DataFrame:
    """Dense index 0..n-1 of a table read from files, in the order in which it is stored.

    The index is the place of a row in its file plus the rows of the files before it; no row is shuffled or sorted.
    """
    placed = stored.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
    indexed = placed.join(small(_stored_files(stored)), "_path")
    return indexed.withColumn(name, F.col("_before") + F.col("_row")).select(*stored.columns, name)


def _rises(values: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
    """Of each row but the first: is its key above that of the row before, and is it the same?  Null is below all, NaN above."""
    n = len(values[0]) - 1
    above, same = np.zeros(n, bool), np.ones(n, bool)

    def flags(x: pa.Array) -> np.ndarray:
        return pc.fill_null(x, False).to_numpy(zero_copy_only=False).astype(bool)

    for column in values:
        steps = [flags(column.is_valid())]
        if pa.types.is_floating(column.type):
            steps.append(flags(pc.is_nan(column)))
        for x in [*steps, column]:
            if isinstance(x, np.ndarray):
                up, level = x[1:] & ~x[:-1], x[1:] == x[:-1]
            else:
                a, b = x.slice(0, n), x.slice(1)
                up, level = flags(pc.greater(b, a)), flags(pc.equal(b, a)) | ~(steps[0][1:] | steps[0][:-1])
                if len(steps) > 1:
                    level |= steps[1][1:] & steps[1][:-1]
            above |= same & up
            same &= level
    return above, same


def check_stored_order(stored: DataFrame, keys: Sequence[str], strict: bool = True) -> DataFrame:
    """Is a table read from files sorted by ``keys`` as it is stored?  A report like that of :func:`check_sorted`.

    A task compares neighbours as it reads them and hands on one row for each stretch of a file; only these are combined.
    """
    ends = StructType([f for f in stored.select(*keys).schema])
    schema = StructType(
        [
            StructField("_path", StringType()), StructField("_row", LongType()), StructField("_lo", ends),
            StructField("_hi", ends), StructField("_bad", LongType()), StructField("_bad_row", LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, last = None, None  # the stretch that goes on, and the row it has reached

        def done() -> pa.RecordBatch:
            rows = [pa.array([open_[k]], t) for k, t in ((0, pa.string()), (1, pa.int64()))]
            rows += [pa.StructArray.from_arrays(list(open_[k].columns), names=list(keys)) for k in (2, 3)]
            rows += [pa.array([open_[k]], pa.int64()) for k in (4, 5)]
            return pa.RecordBatch.from_arrays(rows, schema.names)

        for batch in batches:
            if not len(batch):
                continue
            rows = batch.column(1).to_numpy()
            codes = batch.column(0).dictionary_encode()
            code = codes.indices.to_numpy()
            cuts = np.flatnonzero((np.diff(code) != 0) | (np.diff(rows) != 1)) + 1
            values = batch.select(range(2, batch.num_columns)).rename_columns(list(keys))
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
                path, part = codes.dictionary[int(code[a])].as_py(), values.slice(a, b - a)
                joined = list(part.columns)
                on = open_ is not None and path == open_[0] and int(rows[a]) == last + 1
                if on:
                    joined = [pa.concat_arrays([x, y]) for x, y in zip(open_[3].columns, joined, strict=True)]
                elif open_ is not None:
                    yield done()
                above, same = _rises(joined)
                bad = np.flatnonzero(~(above if strict else above | same))
                first = int(rows[a]) + int(bad[0]) + (0 if on else 1) if len(bad) else None
                if on:
                    open_ = [*open_[:3], part.slice(b - a - 1), open_[4] + len(bad), open_[5] if open_[5] is not None else first]
                else:
                    open_ = [path, int(rows[a]), part.slice(0, 1), part.slice(b - a - 1), len(bad), first]
                last = int(rows[b - 1])
        if open_ is not None:
            yield done()

    placed = stored.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"), *keys)
    runs = placed.mapInArrow(run, schema).join(small(_stored_files(stored)), "_path")
    at = F.struct((F.col("_before") + F.col("_row")).alias("i"))
    bad_at = F.when(F.col("_bad") > 0, F.struct((F.col("_before") + F.col("_bad_row")).alias("i")))
    runs = runs.select(at.alias("_start"), "_lo", "_hi", "_bad", bad_at.alias("_bad_at"))
    ranged = runs.repartitionByRange(_slice_count(stored), "_start").withColumn("_at", F.spark_partition_id())
    whole = _combine_runs(_combine_runs(ranged, ["_at"], strict), [], strict)
    n_bad = F.coalesce(F.col("_bad"), F.lit(0).cast("bigint"))
    return whole.select((n_bad == 0).alias("is_sorted"), n_bad.alias("n_violations"), F.col("_bad_at.i").alias("first_violation_idx"))


def with_batch_id(df: DataFrame, batch_size: int, index: str = "original_idx") -> DataFrame:
    """Number of the ``batch_size`` slice that a row index falls into."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    return df.withColumn("batch_id", int_div(F.col(index), batch_size))


def check_sorted(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    strict: bool = True,
    block_rows: int = 1 << 20,
) -> DataFrame:
    """Is the table, read in the order of ``order_by``, sorted by ``keys``?

    The last column of ``order_by`` is an integer position, unique within the others
    (for stored tables: file and row number).  One row comes back: ``is_sorted``,
    ``n_violations`` and ``first_violation_idx``, the order value of the first row not above
    its predecessor (a struct when ``order_by`` has several columns).

    Positions are cut into blocks of at most ``block_rows`` rows; a block becomes its
    first and last key, and blocks are combined the same way once more.  What is left, at least one
    row per value of the other columns, is combined by range partitions, so that the closing step sees one
    row per partition.
    """
    *outer, position = order_by
    runs = df.select(
        *outer,
        F.col(position).cast("bigint").alias("_at"),
        F.struct(*order_by).alias("_start"),
        F.struct(*keys).alias("_lo"),
        F.struct(*keys).alias("_hi"),
        F.lit(0).cast("bigint").alias("_bad"),
        F.lit(None).cast(_struct_type(df, order_by)).alias("_bad_at"),
    )
    for _ in range(2):
        runs = runs.withColumn("_at", int_div(F.col("_at"), block_rows))
        runs = _combine_runs(runs, [*outer, "_at"], strict)
    if outer:
        ranged = runs.repartitionByRange(_slice_count(df), "_start")
        runs = _combine_runs(ranged.withColumn("_at", F.spark_partition_id()), ["_at"], strict)
    runs = _combine_runs(runs, [], strict)
    first = F.col("_bad_at") if outer else F.col("_bad_at").getField(position)
    bad = F.coalesce(F.col("_bad"), F.lit(0).cast("bigint"))
    return runs.select(
        (bad == 0).alias("is_sorted"), bad.alias("n_violations"), first.alias("first_violation_idx")
    )


def _struct_type(df: DataFrame, names: Sequence[str]):
    return df.select(F.struct(*names).alias("s")).schema["s"].dataType


def _combine_runs(runs: DataFrame, group: list[str], strict: bool) -> DataFrame:
    previous = F.lag("_hi").over(Window.partitionBy(*group).orderBy("_start"))
    step = F.col("_lo") <= F.col("_prev") if strict else F.col("_lo") < F.col("_prev")
    broken = F.col("_prev").isNotNull() & step
    return (
        runs.withColumn("_prev", previous)
        .groupBy(*group)
        .agg(
            F.min("_start").alias("_start_"),
            F.min_by("_lo", "_start").alias("_lo"),
            F.max_by("_hi", "_start").alias("_hi"),
            (F.sum("_bad") + F.sum(broken.cast("bigint"))).alias("_bad"),
            F.least(F.min("_bad_at"), F.min(F.when(broken, F.col("_start")))).alias("_bad_at"),
        )
        .withColumnRenamed("_start_", "_start")
    )


def check_increasing(
    df: DataFrame, column: str, order_by: Sequence[str], block_rows: int = 1 << 20
) -> DataFrame:
    """Is ``column`` strictly increasing in the order of ``order_by``?"""
    return check_sorted(df, [column], order_by, strict=True, block_rows=block_rows)


def require_sorted(report: DataFrame, message: str) -> None:
    """Raise if a report of :func:`check_sorted` says no."""
    row = report.first()
    if not row["is_sorted"]:
        raise ValueError(
            f"{message}: {row['n_violations']} violations, first at {row['first_violation_idx']}"
        )


def top_ranks(
    df: DataFrame,
    by: Sequence[str],
    order_by: Sequence[Column],
    max_rank: int | None = None,
    name: str = "rank",
) -> DataFrame:
    """Rank 1.. of each row in its group, as bigint; with ``max_rank``, only rows up to that rank.

    A rank filter lets Spark keep ``max_rank`` rows per group and map task before the
    shuffle, so a hot group stays small.  Without a cap, or with one above Spark's limit for
    this, the ranks come from the row index, which spreads a hot group over several slices.
    """
    if max_rank is None or max_rank >= _GROUP_LIMIT:
        ranked = with_row_index(df, order_by, by=by, name=name)
        ranked = ranked.withColumn(name, F.col(name) + 1)
        return ranked if max_rank is None else ranked.where(F.col(name) <= max_rank)
    w = Window.partitionBy(*by).orderBy(*order_by)
    return df.withColumn(name, F.row_number().over(w).cast("bigint")).where(F.col(name) <= max_rank)


_FIRST_BINS, _BINS = 4096, 256  # bins of a group, and of a bin that is looked into further
_LISTED = 65_536  # a bin with no more rows is taken apart into its values


def _wanted(start: Column, count: Column, total: Column, steps: int) -> Column:
    """Do the ranks from ``start`` on hold one that a step needs, ``i * (total - 1) div steps`` or the next one?"""
    gaps = total - 1
    first = F.call_function("div", F.greatest(start - 1, F.lit(0)) * steps + F.nullif(gaps, F.lit(0)) - 1, F.nullif(gaps, F.lit(0)))
    return (gaps == 0) | ((first <= steps) & (int_div(first * gaps, steps) < start + count))


def _bin(value: Column, lo: Column, hi: Column, count: Column, bins: int, unit: Column | None) -> Column:
    """Place of a value in its bin: itself if the bin has few rows (``_LISTED``), else one of ``bins`` parts.  It never falls with the value.

    Parts are equally wide, or with ``unit`` so in the logarithm of the value's distance from 0, but for distances below the unit.
    """
    inf = F.lit(float("inf"))
    half = F.when(hi - lo == inf, 0.5).otherwise(1.0)  # the width of a bin may be beyond the largest double
    least = F.greatest(F.greatest(F.abs(lo), F.abs(hi)) * 1e-290, F.lit(5e-324))  # a quotient by it is no infinity

    def size(x: Column) -> Column:
        return F.signum(x) * F.log(F.abs(x) / F.greatest(unit, least) + 1.0)

    share = (value * half - lo * half) / F.nullif(hi * half - lo * half, F.lit(0.0))
    if unit is not None:
        share = F.coalesce((size(value) - size(lo)) / F.nullif(size(hi) - size(lo), F.lit(0.0)), share)
    part = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("double")
    return F.when((count <= _LISTED) | F.isnan(value) | (F.abs(value) == inf), value).otherwise(part)


def _to_bins(rows: DataFrame, bins: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with the columns of their bin; rows of no bin go."""
    if bins.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
        renamed = bins.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(on)})
        same = F.lit(True)
        for i, k in enumerate(on):
            same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        return rows.join(F.broadcast(renamed), same).drop(*[f"_k{i}" for i in range(len(on))])
    key = F.struct(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in on], *[F.col(k).isNull() for k in on])
    return spread_join(rows.withColumn("_k", key), bins.withColumn("_k", key).drop(*on), ["_k"]).drop("_k")


def exact_quantiles(
    df: DataFrame, column: str, steps: int, by: Sequence[str] = (), value_name: str = "value"
) -> DataFrame:
    """Quantiles at 0, 1/steps, .., 1 with linear interpolation, null values left out.

    Columns: ``by``, ``step`` (0..steps), ``probability`` and the value.  Step ``i`` needs the rows at rank
    ``i * (n - 1) div steps`` and the next one, in whole-number arithmetic.  They are found by histograms that
    narrow: values are counted in bins between the least and the largest of a group, the bins that hold a wanted
    rank are cut into bins again, from their own least to their own largest value, and so on down to single values.
    Every second level cuts by the logarithm, so that values of very different size need few levels; the first one does so
    beyond the geometric mean of the group's sizes, which fits normal as well as heavy-tailed values.  Values are never sorted, and are counted map side first; a level has at most ``2 (steps + 1)`` open bins a group.
    NaN counts as the largest value.
    """
    if not by:
        return exact_quantiles(df.withColumn("_all", F.lit(0)), column, steps, ["_all"], value_name).drop("_all")
    value, inf = F.col("_v"), float("inf")
    rows = stage(df.where(F.col(column).isNotNull()).select(*by, F.col(column).cast("double").alias("_v")), "values")
    finite = F.when(~F.isnan(value) & (F.abs(value) != inf), value)
    unit = F.exp(F.avg(F.log(F.nullif(F.abs(finite), F.lit(0.0)))))
    groups = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.min(finite).alias("_lo"), F.max(finite).alias("_hi"), F.coalesce(unit, F.lit(0.0)).alias("_unit")
    )
    groups = groups.where("_n > 0").withColumns({"_total": F.col("_n"), "_from": F.lit(0).cast("bigint"), "_bin": F.monotonically_increasing_id()})
    opened = stage(groups, "bins")
    found, on, bins = None, list(by), _FIRST_BINS
    for level in itertools.count():
        held = ["_bin", "_total", "_from", "_lo", "_hi", "_n", *(["_unit"] if level == 0 else [])]
        placed = _to_bins(rows, opened.select(*dict.fromkeys([*on, *held])), on)
        unit = F.col("_unit") if level == 0 else None if level % 2 else F.lit(0.0)
        part = _bin(value, F.col("_lo"), F.col("_hi"), F.col("_n"), bins, unit)
        placed = placed.withColumn("_part", part)
        counted = placed.groupBy(*by, "_bin", "_total", "_from", "_part").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
        )
        before = Window.partitionBy("_bin").orderBy("_lo").rowsBetween(Window.unboundedPreceding, -1)  # of a bin's parts
        start = F.col("_from") + F.coalesce(F.sum("_n").over(before), F.lit(0))
        chosen = counted.withColumn("_from", start).where(_wanted(F.col("_from"), F.col("_n"), F.col("_total"), steps))
        chosen = stage(chosen.withColumn("_next", F.monotonically_increasing_id()), "bins")
        single = chosen.where(F.col("_lo") == F.col("_hi")).select(*by, F.col("_lo").alias("_v"), "_n", "_from", "_total")
        found = single if found is None else found.unionByName(single)
        wide = chosen.where(F.col("_lo") < F.col("_hi"))
        if wide.isEmpty():
            break
        inner = wide.select("_bin", "_part", "_next")
        rows = stage(_to_bins(placed.select(*by, "_v", "_bin", "_part"), inner, ["_bin", "_part"]).select(*by, "_v", F.col("_next").alias("_bin")), "values")
        opened = wide.drop("_bin").withColumnRenamed("_next", "_bin").drop(*by)
        on, bins = ["_bin"], _BINS
    gaps = F.col("_total") - 1
    lower_rank = int_div(F.col("_i") * gaps, steps)

    end = F.col("_from") + F.col("_n")
    # a contiguous range that covers every step whose lower or upper rank is here; no gap at
    # all (one row) gives null bounds, which greatest and least leave out
    per_gap = F.lit(float(steps)) / F.nullif(gaps, F.lit(0))
    first_step = F.greatest(F.lit(0), (F.ceil((F.col("_from") - 1) * per_gap) - 1).cast("int"))
    last_step = F.least(F.lit(steps), (F.ceil(end * per_gap) + 1).cast("int"))
    candidates = found.where(first_step <= last_step).withColumn(
        "_i", F.explode(F.sequence(first_step, last_step))
    ).withColumn("_i", F.col("_i").cast("bigint"))
    upper_rank = F.least(lower_rank + 1, gaps)
    holds_lower = (lower_rank >= F.col("_from")) & (lower_rank < end)
    holds_upper = (upper_rank >= F.col("_from")) & (upper_rank < end)
    weight = (F.col("_i") * gaps % steps).cast("double") / float(steps)
    low, high = F.col("_low"), F.col("_high")
    return (
        candidates.where(holds_lower | holds_upper)
        .groupBy(*by, "_i")
        .agg(
            F.max(F.when(holds_lower, F.col("_v"))).alias("_low"),
            F.max(F.when(holds_upper, F.col("_v"))).alias("_high"),
            F.max(weight).alias("_w"),
        )
        .select(
            *by,
            F.col("_i").cast("int").alias("step"),
            (F.col("_i") / float(steps)).alias("probability"),
            (low + (high - low) * F.col("_w")).alias(value_name),
        )
    )
