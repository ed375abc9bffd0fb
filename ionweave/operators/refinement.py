"""Edge refinement after a search, and spectra made of nodes and edges."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from ionweave.operators.filters import confident_targets
from ionweave.operators.joins import ROWS_PER_TASK, _parts, hot_keys, matching_keys, spread_join
from ionweave.operators.ordering import top_ranks
from ionweave.operators.pieces import Held, by_part, copied, dealt, is_in, packed, part_count

MAX_RANK = 12  # fixed value: usual cap on the rank of a precursor at a fragment


def filter_search_results(
    psms: DataFrame, fragments: DataFrame, rows_per_task: int = ROWS_PER_TASK, **confidence
) -> tuple[DataFrame, DataFrame]:
    """Confident target matches, and the fragments that belong to them.

    ``confidence`` goes to :func:`ionweave.operators.filters.confident_targets`.
    """
    kept = confident_targets(psms, **confidence)
    return kept, matching_keys(fragments, kept, ["psm_id"], rows_per_task)


def flag_edges(
    all_edges: DataFrame, filtered_edges: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """All edges with two flags: found by the search, and kept by the refinement.

    An edge is kept if it was found, or if no found edge touches its MS2 cluster.  Edges meet the found ones by MS2 cluster, in
    packed pieces: one pass over them gives both flags.
    """
    pair = ["MS1_ClusterID", "MS2_ClusterID"]
    found = filtered_edges.select(*[F.col(c).cast(all_edges.schema[c].dataType).alias(c) for c in pair]).dropna()
    parts = part_count(all_edges, found.count())
    hot = hot_keys(all_edges, ["MS2_ClusterID"], rows_per_task)
    tables = [
        packed(dealt(found, "MS2_ClusterID", pair[:1], hot, parts), 0, pair[::-1]),
        packed(dealt(all_edges, "MS2_ClusterID", pair[:1], hot, parts), 2, pair[::-1]),
    ]
    if hot:  # the found edges of a hot MS2 cluster are dealt, but all its parts must know that it has some
        hot_nodes = _parts(found.select("MS2_ClusterID").distinct(), ["MS2_ClusterID"], hot, "_n").where("_n > 1").drop("_n")
        tables.insert(1, packed(copied(hot_nodes, "MS2_ClusterID", hot, parts), 1))

    def flag(pieces: Iterator[tuple[int, pa.Table]]) -> Iterator[pa.Table]:
        held = Held(pieces, 2)
        mine = explained = None
        for n, rows in enumerate(held.streamed()):
            if not n:
                mine, nodes = held.of(0), held.of(0, 1, columns=pair[1:])
                explained = nodes.group_by(pair[1:]).aggregate([]) if nodes is not None else None
            is_found = is_in(rows, pair, mine)
            is_kept = is_found | ~is_in(rows, pair[1:], explained)
            yield rows.append_column("is_found", pa.array(is_found)).append_column("is_kept", pa.array(is_kept))

    flags = [StructField(c, BooleanType()) for c in ("is_found", "is_kept")]
    return by_part(tables, parts, flag, StructType([*all_edges.schema.fields, *flags]))


def refine_edges(
    all_edges: DataFrame,
    filtered_edges: DataFrame,
    max_rank: int | None = None,
    rank_by: Column | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> dict[str, DataFrame]:
    """Edges found by the search or touching a fragment that is not yet explained.

    Returns ``edges`` (the columns of ``all_edges``), ``counts`` (one row: total,
    positive, kept) and ``stats``: for each node of both sides the number of its edges, of those found and of those
    that the rule keeps.  ``max_rank`` keeps, per MS2 cluster, the best edges by ``rank_by``.
    """
    flagged = flag_edges(all_edges, filtered_edges, rows_per_task)
    counts = flagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_found").alias("positive"),
        F.count_if("is_kept").alias("kept"),
    )
    kept = flagged.where("is_kept").select(*all_edges.columns)
    if max_rank is not None:
        kept = fragment_ranks(kept, rank_by, max_rank).drop("rank")
    return {"edges": kept, "counts": counts, "stats": node_degrees(flagged)}


def node_degrees(flagged: DataFrame) -> DataFrame:
    """(level, ClusterID, n_edges, n_found, n_kept) of the nodes of both sides, from :func:`flag_edges`.

    Both sides are counted in one pass, in the map tasks first, so that a node with very many edges is one row per task.
    """
    sides = [
        F.struct(F.lit(level).alias("level"), F.col(f"{level}_ClusterID").cast("bigint").alias("ClusterID"))
        for level in ("MS1", "MS2")
    ]
    ends = flagged.select(F.inline(F.array(*sides)), "is_found", "is_kept")
    return ends.groupBy("level", "ClusterID").agg(
        F.count(F.lit(1)).alias("n_edges"), F.count_if("is_found").alias("n_found"), F.count_if("is_kept").alias("n_kept")
    )


def fragment_ranks(
    edges: DataFrame, score: Column | None = None, max_rank: int | None = MAX_RANK
) -> DataFrame:
    """Rank of the precursors of each fragment cluster, best score first, ties by MS1 id."""
    best_first = (F.col("score") if score is None else score).desc_nulls_last()
    return top_ranks(edges, ["MS2_ClusterID"], [best_first, F.col("MS1_ClusterID").asc()], max_rank)


def _plain(value: Column, scale: int = 4) -> Column:
    return value.cast(f"decimal(28,{scale})").cast("string")


def spectrum_lines(
    ms1: DataFrame,
    ms2: DataFrame,
    edges: DataFrame,
    names: Mapping[str, str],
    ms2_mz: str = "mz_wmean",
    ms2_intensity: str = "intensity_sum",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Text lines of one spectrum per precursor that has edges.

    ``names`` maps the header fields PEPMASS, RTINSECONDS and CHARGE to columns of
    ``ms1``.  Columns: MS1_ClusterID, ``section`` (0 header, 1 peak, 2 end), mz, intensity,
    MS2_ClusterID and ``line``.  Sorted by these, in this order, the lines are the file: peaks go up
    by m/z, then intensity.  A spectrum is never put together in memory.
    """
    nodes = ms2.select(
        F.col("ClusterID").alias("MS2_ClusterID"),
        F.col(ms2_mz).cast("double").alias("mz"),
        F.col(ms2_intensity).cast("double").alias("intensity"),
    )
    pairs = edges.select("MS1_ClusterID", "MS2_ClusterID")
    peaks = spread_join(pairs, nodes, ["MS2_ClusterID"], rows_per_task=rows_per_task, sketch=edges)
    head = ms1.join(
        pairs.select(F.col("MS1_ClusterID").alias("ClusterID")).distinct(), "ClusterID", "left_semi"
    )
    blank = [F.lit(None).cast("double").alias(c) for c in ("mz", "intensity")]
    blank.append(F.lit(None).cast(edges.schema["MS2_ClusterID"].dataType).alias("MS2_ClusterID"))
    key = F.col("ClusterID").alias("MS1_ClusterID")
    title = F.concat(F.lit("TITLE=spectrum."), F.col("ClusterID").cast("string"))
    fields = [
        F.concat(F.lit(f"{field}="), F.col(c).cast("string") if field == "CHARGE" else _plain(F.col(c)))
        for field, c in names.items()
    ]
    return (
        head.select(key, F.lit(0).alias("section"), *blank, F.concat_ws("\n", F.lit("BEGIN IONS"), title, *fields).alias("line"))
        .unionByName(
            peaks.select(
                "MS1_ClusterID",
                F.lit(1).alias("section"),
                "mz",
                "intensity",
                "MS2_ClusterID",
                F.concat_ws(" ", _plain(F.col("mz")), _plain(F.col("intensity"))).alias("line"),
            )
        )
        .unionByName(head.select(key, F.lit(2).alias("section"), *blank, F.lit("END IONS").alias("line")))
    )
