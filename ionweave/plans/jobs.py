"""Jobs made of the operators: reports, fragment tables, training sets, shards, refinement."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ionweave.functions.text import cluster_id
from ionweave.operators import calibration, refinement
from ionweave.operators.filters import (
    EDGE_KEY,
    aligned_features,
    confident_targets,
    in_order,
    typed_columns_only,
    with_extents,
)
from ionweave.operators.joins import attach_lookup, combine_tables, edge_features
from ionweave.operators.matching import Axis, map_back, match_ranges
from ionweave.operators.ordering import check_increasing, check_stored_order, require_sorted, with_stored_index
from ionweave.operators.packing import pack
from ionweave.operators.sampling import DRAWS_PER_CLASS, draw_per_class
from ionweave.operators.summaries import cluster_stats, multiplicity, protein_group_stats, psm_stats, search_stats
from ionweave.sources.records import read_records
from ionweave.sources.sinks import write_shards
from ionweave.sources.tables import PEPTIDE_SCHEMA, read_tsv
from ionweave.staging import stage

# Columns that line up between the two node tables.
MS1_ALIGNED = {
    "mz_wmean": "precursor_mz_wmean",
    "scan_wmean": "scan_wmean",
    "retention_time_wmean": "retention_time_wmean",
}
MS2_ALIGNED = {
    "precursor_mz_pred_fastmist": "precursor_mz_wmean",
    "scan_wmean": "scan_wmean",
    "retention_time_wmean": "retention_time_wmean",
}


def fragment_table(psms: DataFrame, fragments: DataFrame) -> DataFrame:
    """Fragments with the MS1 cluster of their match, sorted by cluster and m/z.

    Fragments without a match stay, with a null cluster, at the end.
    """
    known = psms.select("psm_id", cluster_id(F.col("scannr")).alias("MS1_ClusterID"))
    found = attach_lookup(fragments, known, "psm_id", "MS1_ClusterID")
    return in_order(found, ["MS1_ClusterID", "fragment_mz_experimental"])


def rescoring_report(spark: SparkSession, path: str) -> DataFrame:
    """Statistics of the confident peptides of a rescored table on disk."""
    return psm_stats(confident_targets(read_tsv(spark, path, PEPTIDE_SCHEMA)))


def rescored_psm_summary(psms: DataFrame) -> dict[str, DataFrame]:
    """Of rescored matches: the table with cluster ids, group counts, and clusters with several matches."""
    table = psms.withColumn("MS1_ClusterID", cluster_id(F.col("spectrum_id")))
    return {
        "psms": in_order(table, ["MS1_ClusterID", "spectrum_id"]),
        "groups": protein_group_stats(table),
        "clusters": table.agg(F.count_distinct("MS1_ClusterID").alias("MS1_Clusters")),
        "repeated": multiplicity(table, ["MS1_ClusterID"]),
    }


def training_set(
    labelled_edges: DataFrame,
    ms1: DataFrame,
    ms2: DataFrame,
    k: int = DRAWS_PER_CLASS,
    seed: int = 0,
    diff_columns: Sequence[str] = tuple(MS1_ALIGNED.values()),
    ms1_aligned: Mapping[str, str] = MS1_ALIGNED,
    ms2_aligned: Mapping[str, str] = MS2_ALIGNED,
    extents: bool = True,
) -> DataFrame:
    """Balanced draw of labelled edges with the statistics of both ends and their differences.

    The label comes out as ``is_positive``.  Text columns of the node tables are left out.
    """
    drawn = stage(draw_per_class(labelled_edges, k, seed), "drawn").select(
        *EDGE_KEY, F.col("Y").alias("is_positive")
    )
    prepare = with_extents if extents else (lambda df: df)
    return edge_features(
        drawn,
        typed_columns_only(prepare(ms1)),
        typed_columns_only(prepare(ms2)),
        diff_columns,
        typed_columns_only(aligned_features(ms1, ms1_aligned)),
        typed_columns_only(aligned_features(ms2, ms2_aligned)),
        broadcast_rows=2 * k,
    )


def tolerance_update(
    errors: DataFrame,
    config: str | Mapping,
    low: tuple[str, int] = calibration.LOW_QUANTILE,
    high: tuple[str, int] = calibration.HIGH_QUANTILE,
) -> DataFrame:
    """From the errors of both levels to a search configuration with matching tolerances."""
    knots = calibration.error_distributions(errors)
    return calibration.updated_configs(calibration.tolerances(knots, low, high), config)


def filtered_edge_table(
    edges: DataFrame, predicate: str | Column, path: str, order_by: Sequence[str] = EDGE_KEY
) -> DataFrame:
    """Filter edges by a condition on single rows, store them in a new folder, and check the stored order.

    ``edges`` is read from files.  Each edge gets the index it has there; a table that is not stored in the order of
    ``order_by``, without repeats, is refused before anything is written.
    """
    require_sorted(check_stored_order(edges, order_by), "edges are not stored in order")
    kept = with_stored_index(edges).where(predicate)
    parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_index_order = kept.repartitionByRange(parts, "original_idx").sortWithinPartitions("original_idx")
    in_index_order.write.mode("errorifexists").parquet(path)
    stored = edges.sparkSession.read.schema(kept.schema).parquet(path)
    placed = stored.select(
        "original_idx",
        F.regexp_extract("_metadata.file_path", r"part-(\d+)[^/]*$", 1).cast("bigint").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    require_sorted(check_increasing(placed, "original_idx", ["file", "row"]), "stored edges are out of order")
    return stored


def spectrum_shards(spark: SparkSession, source: str, path: str, max_bytes: float) -> DataFrame:
    """Split spectrum files into shards below ``max_bytes``; returns the bin of each record."""
    # file names may repeat in different folders, so a piece of the path hash goes with them
    name = F.concat_ws(".", F.element_at(F.split("file", "/"), -1), F.substring(F.md5("file"), 1, 8))
    records = read_records(spark, source).withColumn("name", name)
    bins = stage(
        pack(records, "name", "row", F.octet_length("text"), max_bytes, segment=F.col("block")), "bins"
    )
    write_shards(records, bins, path, "name", "row", "text")
    return bins


@dataclass(frozen=True)
class GenerationSettings:
    """What a generation needs to know beyond its tables."""

    axes: Mapping[str, str]
    match_axes: Mapping[str, float]  # range name -> grid cell width
    tolerance: float
    header: Mapping[str, str]
    confidence: Mapping[str, object]
    mz_axis: str = "mz"


def first_generation(
    precursor_points: DataFrame,
    fragment_points: DataFrame,
    extra_precursor_stats: DataFrame,
    settings: GenerationSettings,
    same: Mapping[str, Column] | None = None,
) -> dict[str, DataFrame]:
    """Node tables, rough matches and spectra, ready for an external search.

    ``same`` maps names to columns (over the node tables) that must be equal in a match.
    Node tables and matches are stored, as several later steps read them.
    """
    main = stage(cluster_stats(precursor_points, settings.axes), "main")
    ms1 = stage(combine_tables(main, extra_precursor_stats), "ms1")
    ms2 = stage(cluster_stats(fragment_points, settings.axes), "ms2")
    same = same or {}

    def side(stats: DataFrame, level: str) -> DataFrame:
        ends = [
            F.col(f"{a}_{e}").alias(f"{level}_{a}_{e}") for a in settings.match_axes for e in ("min", "max")
        ]
        return stats.select(
            F.col("ClusterID").alias(f"{level}_ClusterID"), *[c.alias(n) for n, c in same.items()], *ends
        )

    axes = [
        Axis((f"MS1_{a}_min", f"MS1_{a}_max"), (f"MS2_{a}_min", f"MS2_{a}_max"), width)
        for a, width in settings.match_axes.items()
    ]
    edges = match_ranges(side(ms1, "MS1"), side(ms2, "MS2"), axes, on=list(same)).select(*EDGE_KEY)
    edges = stage(edges, "edges")
    return {
        "precursor_stats": ms1,
        "fragment_stats": ms2,
        "edges": edges,
        "spectra": refinement.spectrum_lines(ms1, ms2, edges, settings.header, f"{settings.mz_axis}_wmean"),
    }


def refine_generation(
    first: Mapping[str, DataFrame],
    psms: DataFrame,
    fragments: DataFrame,
    settings: GenerationSettings,
    fragment_id: Sequence[str],
    expected_mz: str = "expected_mz",
) -> dict[str, DataFrame]:
    """From the search results of a generation to refined nodes, edges, spectra and errors.

    ``psms`` has psm_id, MS1_ClusterID and the m/z expected for the precursor.  Errors of
    fragment nodes are taken against the mean m/z of the fragments found on an edge.
    """
    mz = f"{settings.mz_axis}_wmean"
    kept = refinement.filter_search_results(psms, fragments, **settings.confidence)
    mapped = map_back(
        stage(kept[0], "psms"),
        stage(kept[1], "fragments"),
        first["fragment_stats"],
        first["edges"],
        settings.tolerance,
        fragment_id,
        node_mz=mz,
    )
    found = stage(mapped["edges"], "found")
    ms1_mz = first["precursor_stats"].select(F.col("ClusterID").alias("MS1_ClusterID"), F.col(mz).alias("_mz"))
    ms2_mz = first["fragment_stats"].select(F.col("ClusterID").alias("MS2_ClusterID"), F.col(mz).alias("_mz"))
    errors = stage(
        calibration.ppm_errors(mapped["precursors"].join(ms1_mz, "MS1_ClusterID"), "_mz", expected_mz, "ms1")
        .unionByName(
            calibration.ppm_errors(found.join(ms2_mz, "MS2_ClusterID"), "_mz", "fragment_mz_mean", "ms2")
        ),
        "errors",
    )
    distributions = stage(calibration.error_distributions(errors), "distributions")
    ms1 = calibration.recalibrated(first["precursor_stats"], distributions, "ms1", mz)
    ms2 = calibration.recalibrated(first["fragment_stats"], distributions, "ms2", mz)
    refined = refinement.refine_edges(first["edges"], found)
    return {
        **{f"mapped_{name}": df for name, df in mapped.items() if name != "edges"},
        "mapped_edges": found,
        "precursor_stats": ms1,
        "fragment_stats": ms2,
        "errors": errors,
        "error_distributions": distributions,
        "edges": refined["edges"],
        "edge_counts": refined["counts"],
        "node_degrees": refined["stats"],
        "spectra": refinement.spectrum_lines(ms1, ms2, refined["edges"], settings.header, mz),
    }


def second_generation(
    first: Mapping[str, DataFrame],
    refined: Mapping[str, DataFrame],
    psms: DataFrame,
    fragments: DataFrame,
    settings: GenerationSettings,
    fragment_id: Sequence[str],
) -> dict[str, DataFrame]:
    """Map the hits of the next search back, and sum them up.

    The hits are held against the rough matches of the first generation and the recalibrated fragment nodes.  Returns ``edges``,
    ``fragments`` and ``precursors`` on them, and ``stats``, in long form.
    """
    kept = refinement.filter_search_results(psms, fragments, **settings.confidence)
    mapped = map_back(
        stage(kept[0], "psms"),
        stage(kept[1], "fragments"),
        refined["fragment_stats"],
        first["edges"],
        settings.tolerance,
        fragment_id,
        node_mz=f"{settings.mz_axis}_wmean",
    )
    found = stage(mapped["edges"], "found")
    return {**mapped, "edges": found, "stats": search_stats(mapped["precursors"], mapped["fragments"], found)}
