"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 20_000_000  # a key with more rows than this is spread over several tasks
_BUCKETS = 1 << 16
MAX_BROADCAST_ROWS = 1_000_000  # most ids sent to every executor


def hot_keys(df: DataFrame, on: Sequence[str], rows_per_task: int) -> list[tuple[int, int]]:
    """(key hash, number of parts) of the keys with more than ``rows_per_task`` rows.

    Rows are counted by buckets of keys first, so that no more than ``_BUCKETS`` rows a task are shuffled; keys are counted
    exactly in the buckets with more than ``rows_per_task`` rows, mostly none.  At most one key in ``rows_per_task`` rows
    can be hot, which bounds the list.  It only steers how rows are spread; no result depends on it.
    """
    keys = df.select(F.xxhash64(*on).alias("k"))
    bucket = F.pmod("k", F.lit(_BUCKETS)).cast("int")
    crowded = keys.groupBy(bucket.alias("b")).count().where(F.col("count") > rows_per_task).collect()
    if not crowded:
        return []
    buckets = df.sparkSession.createDataFrame([(r["b"],) for r in crowded], "b int")  # _BUCKETS rows at most
    counted = keys.join(F.broadcast(buckets), bucket == F.col("b"), "left_semi").groupBy("k").count()
    found = counted.where(F.col("count") > rows_per_task).collect()
    return [(r["k"], -(-r["count"] // rows_per_task)) for r in found]


def small(table: DataFrame) -> DataFrame:
    """The table, marked for a broadcast if its rows, which are counted, are few."""
    return F.broadcast(table) if table.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else table


def _parts(df: DataFrame, on: Sequence[str], hot: list[tuple[int, int]], name: str) -> DataFrame:
    table = df.sparkSession.createDataFrame(hot, f"_k bigint, {name} int")  # one row in rows_per_task at most
    return (
        df.withColumn("_k", F.xxhash64(*on))
        .join(F.broadcast(table), "_k", "left")
        .withColumn(name, F.coalesce(F.col(name), F.lit(1)))
        .drop("_k")
    )


def _split(df: DataFrame, columns: Sequence[str], parts: str, salt: str) -> DataFrame:
    return df.withColumn(salt, F.pmod(F.xxhash64(*columns), F.col(parts)).cast("int"))


def _copy(df: DataFrame, parts: str, salt: str) -> DataFrame:
    return df.withColumn(salt, F.explode(F.sequence(F.lit(0), F.col(parts) - 1)))


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    both: bool = False,
    sketch: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, on, how)`` with hot left keys spread over several tasks.

    The left rows of a hot key get a salt from a hash of the whole row, and the right rows of
    that key are copied once per salt.  ``both=True`` (inner joins) spreads hot right keys
    as well.  Key types must be equal on both sides.  ``how`` is inner, left, left_semi or
    left_anti: joins that report unmatched right rows cannot copy them.

    The hot keys are looked up in ``sketch``, by default ``left``.  Give a stored table that
    ``left`` was derived from, so that the look-up does not run the derivation.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot spread a {how} join")
    if both and how != "inner":
        raise ValueError("both sides can be spread in inner joins only")
    on = list(on)
    for k in on:
        if left.schema[k].dataType != right.schema[k].dataType:
            raise TypeError(f"key {k} differs in type: {left.schema[k]} and {right.schema[k]}")
    hot_left = hot_keys(left if sketch is None else sketch, on, rows_per_task)
    hot_right = hot_keys(right, on, rows_per_task) if both else []
    if not hot_left and not hot_right:
        return left.join(right, on, how)
    left_columns, right_columns = left.columns, right.columns
    keys = list(on)
    if hot_left:
        left = _split(_parts(left, on, hot_left, "_pl"), left_columns, "_pl", "_sl").drop("_pl")
        right = _copy(_parts(right, on, hot_left, "_pl"), "_pl", "_sl").drop("_pl")
        keys.append("_sl")
    if hot_right:
        right = _split(_parts(right, on, hot_right, "_pr"), right_columns, "_pr", "_sr").drop("_pr")
        left = _copy(_parts(left, on, hot_right, "_pr"), "_pr", "_sr").drop("_pr")
        keys.append("_sr")
    return left.join(right, keys, how).drop("_sl", "_sr")


def attach_lookup(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    value: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Attach ``value`` by ``key``; rows without a match get null.

    When the lookup repeats a key, its largest value counts: the last one in a lookup
    sorted by value.
    """
    unique = lookup.groupBy(key).agg(F.max(value).alias(value))
    return spread_join(df, unique, [key], "left", rows_per_task).select(*df.columns, value)


def matching_keys(
    df: DataFrame, keys: DataFrame, on: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``; repeated keys are merged before they move."""
    return spread_join(df, keys.select(*on).distinct(), on, "left_semi", rows_per_task)


def combine_tables(a: DataFrame, b: DataFrame, key: str = "ClusterID") -> DataFrame:
    """One-to-one join of two tables about the same clusters.

    Raises when a column other than the key is in both, or when a key is missing or
    repeated in either table.
    """
    shared = (set(a.columns) & set(b.columns)) - {key}
    if shared:
        raise ValueError(f"columns in both tables: {sorted(shared)}")
    tagged = a.select(key, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(key, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    per_key = tagged.groupBy(key).agg(F.sum("in_a").alias("in_a"), F.sum("in_b").alias("in_b"))
    wrong = per_key.where((F.col("in_a") != 1) | (F.col("in_b") != 1) | F.col(key).isNull())
    example = wrong.first()
    if example:
        raise ValueError(f"not one row per key in both tables: {example.asDict()}")
    return a.join(b, key)


def edge_features(
    edges: DataFrame,
    ms1: DataFrame,
    ms2: DataFrame,
    diff_columns: Sequence[str] = (),
    ms1_diff: DataFrame | None = None,
    ms2_diff: DataFrame | None = None,
    key: str = "ClusterID",
    broadcast_rows: int | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Statistics of both ends of each edge, plus MS1 - MS2 differences.

    Columns: ``ms1_<c>`` and ``ms2_<c>`` for every column of the node tables,
    ``diff_<c>`` for each of ``diff_columns`` (taken from ``ms1_diff`` and ``ms2_diff``, by
    default the node tables themselves), and the other edge columns.  Every edge must
    find both ends; the job fails otherwise.  ``broadcast_rows`` is for small stored sets of
    edges, such as a sample: if there are no more rows than that, which is checked, the
    edges go to the node tables instead of the other way round.
    """
    def ready(nodes: DataFrame, diffs: DataFrame | None, side: str) -> DataFrame:
        # column names do not tell upper from lower case, so ms1_ClusterID is given out last
        values = [F.col(c).alias(f"{side}_{c}") for c in nodes.columns if c != key]
        node = F.col(key).alias(f"_{side}_node")
        if diffs is None:
            return nodes.select(node, *values, *[F.col(c).alias(f"_{side}_{c}") for c in diff_columns])
        renamed = diffs.select(key, *[F.col(c).alias(f"_{side}_{c}") for c in diff_columns])
        return nodes.select(key, node, *values).join(renamed, key).drop(key)

    small = broadcast_rows is not None and broadcast_rows <= MAX_BROADCAST_ROWS
    small = small and edges.limit(broadcast_rows + 1).count() <= broadcast_rows
    out = edges
    for side, nodes, diffs, end in (
        ("ms1", ms1, ms1_diff, "MS1_ClusterID"),
        ("ms2", ms2, ms2_diff, "MS2_ClusterID"),
    ):
        node = f"_{side}_node"
        right = ready(nodes, diffs, side).withColumn(end, F.col(node))
        if small:  # the edges go to the node table, and only the nodes they need come back
            right = right.join(F.broadcast(edges.select(end).distinct()), end, "left_semi")
            out = out.join(right, end, "left")
        else:
            out = spread_join(out, right, [end], "left", rows_per_task, sketch=edges)
        missing = F.raise_error(F.concat(F.lit(f"edge without {side} node: "), F.col(end).cast("string")))
        out = out.withColumn(node, F.coalesce(node, missing.cast(nodes.schema[key].dataType)))

    def given(nodes: DataFrame, side: str):
        return [F.col(f"_{side}_node" if c == key else f"{side}_{c}").alias(f"{side}_{c}") for c in nodes.columns]

    rest = [c for c in edges.columns if c not in ("MS1_ClusterID", "MS2_ClusterID")]
    return out.select(
        *given(ms1, "ms1"),
        *given(ms2, "ms2"),
        *[(F.col(f"_ms1_{c}") - F.col(f"_ms2_{c}")).alias(f"diff_{c}") for c in diff_columns],
        *rest,
    )
