"""Look-ups, range matching, mapping back, refinement and spectra."""

from __future__ import annotations

from pyspark.sql import functions as F

from ionweave.functions.text import cluster_id
from ionweave.operators import filters, joins, matching, refinement, summaries
from workload.fixtures import duck_sql as D
from workload.fixtures import spark_table as T

FRAGMENT_ID = ["MS2_ClusterID", "fragment_key", "fragment_ordinals", "fragment_mz_experimental"]
DAY_SECONDS = 3600.0


def lookup(spark, d):
    known = T(spark, d, "psm").where("charge <> 2").select(
        "psm_id", cluster_id(F.col("spectrum_id")).alias("MS1_ClusterID")
    )
    return joins.attach_lookup(T(spark, d, "fragments"), known, "psm_id", "MS1_ClusterID")


def edge_features(spark, d):
    ms1 = filters.typed_columns_only(T(spark, d, "ms1")).select(
        "ClusterID", "mz_wmean", "scan_wmean", "retention_time_wmean"
    )
    ms2 = filters.typed_columns_only(T(spark, d, "ms2")).select(
        "ClusterID", "mz_wmean", "scan_wmean", "retention_time_wmean"
    )
    return joins.edge_features(
        T(spark, d, "edges"), ms1, ms2, ["mz_wmean", "scan_wmean", "retention_time_wmean"]
    )


def combined_stats(spark, d):
    points = T(spark, d, "peaks")
    main = summaries.cluster_stats(points, {"frame": "frame"}).select("ClusterID", "frame_min", "frame_max")
    extra = points.groupBy("ClusterID").agg(F.max("mz").alias("top_mz"))
    return joins.combine_tables(main, extra)


def _ranges(spark, d, kind, prefix):
    points = T(spark, d, "peaks").where(F.col("grp") == kind)
    return points.groupBy("ClusterID").agg(F.min("frame").alias("lo"), F.max("frame").alias("hi")).select(
        F.col("ClusterID").alias(f"{prefix}_ClusterID"),
        (F.col("ClusterID") % 32).alias("day"),
        F.col("lo").alias(f"{prefix}_lo"),
        F.col("hi").alias(f"{prefix}_hi"),
    )


def range_match(spark, d):
    axis = matching.Axis(("MS1_lo", "MS1_hi"), ("MS2_lo", "MS2_hi"), DAY_SECONDS)
    pairs = matching.match_ranges(
        _ranges(spark, d, "purchase", "MS1"), _ranges(spark, d, "signup", "MS2"), [axis], on=["day"]
    )
    return pairs.select("MS1_ClusterID", "MS2_ClusterID")


def range_match_2d(spark, d):
    """Overlap on two axes, plus a relative tolerance as the third."""
    ms1 = T(spark, d, "ms1").select(
        F.col("ClusterID").alias("MS1_ClusterID"),
        F.col("frame_min").alias("a_lo"),
        F.col("frame_max").alias("a_hi"),
        F.col("retention_time_min").alias("b_lo"),
        F.col("retention_time_max").alias("b_hi"),
        (F.col("mz_wmean") / 200).alias("mz1"),
    )
    ms2 = T(spark, d, "ms2").select(
        F.col("ClusterID").alias("MS2_ClusterID"),
        F.col("frame_min").alias("c_lo"),
        F.col("frame_max").alias("c_hi"),
        F.col("retention_time_min").alias("e_lo"),
        F.col("retention_time_max").alias("e_hi"),
        F.col("precursor_mz_pred_fastmist").alias("mz2"),
    )
    axes = [
        matching.Axis(("a_lo", "a_hi"), ("c_lo", "c_hi"), 16),
        matching.Axis(("b_lo", "b_hi"), ("e_lo", "e_hi"), 4),
    ]
    near = F.abs(F.col("mz2") - F.col("mz1")) <= F.col("mz1") * 0.2
    return matching.match_ranges(ms1, ms2, axes, residual=near).select("MS1_ClusterID", "MS2_ClusterID", "mz1", "mz2")


def search_filter_psms(spark, d):
    return _filtered(spark, d)[0]


def search_filter_fragments(spark, d):
    return _filtered(spark, d)[1]


def _filtered(spark, d):
    psms = T(spark, d, "psm").withColumn("MS1_ClusterID", cluster_id(F.col("spectrum_id")))
    return refinement.filter_search_results(psms, T(spark, d, "fragments"), q_column="q_value")


def _mapped(spark, d):
    psms, fragments = _filtered(spark, d)
    return matching.map_back(
        psms, fragments, T(spark, d, "fragment_mz"), T(spark, d, "edges"), 0.02, FRAGMENT_ID
    )


def mapped_edges(spark, d):
    return _mapped(spark, d)["edges"]


def mapped_fragments(spark, d):
    return _mapped(spark, d)["fragments"]


def mapped_precursors(spark, d):
    return _mapped(spark, d)["precursors"]


def search_stats(spark, d):
    mapped = _mapped(spark, d)
    return summaries.search_stats(mapped["precursors"], mapped["fragments"], mapped["edges"])


def refined_edges(spark, d):
    edges = T(spark, d, "edges")
    return refinement.refine_edges(edges, edges.where("Y = 1"))["edges"]


def refined_counts(spark, d):
    edges = T(spark, d, "edges")
    return refinement.refine_edges(edges, edges.where("Y = 1"))["counts"]


def refined_degrees(spark, d):
    edges = T(spark, d, "edges")
    return refinement.refine_edges(edges, edges.where("Y = 1"))["stats"]


def refined_capped(spark, d):
    edges = T(spark, d, "edges")
    return refinement.refine_edges(edges, edges.where("Y = 1"), refinement.MAX_RANK)["edges"]


HEADER = {"PEPMASS": "mz_wmean", "RTINSECONDS": "retention_time_wmean", "CHARGE": "charge"}


def spectra(spark, d):
    return refinement.spectrum_lines(T(spark, d, "ms1"), T(spark, d, "ms2"), T(spark, d, "edges"), HEADER)


def spectrum_files(spark, d):
    """Write the spectra, read them back as records, and count peaks and bytes."""
    from ionweave.sources.records import read_records
    from ionweave.sources.sinks import write_spectra
    from ionweave.staging import new_path

    path = new_path(spark, "spectra")
    write_spectra(spectra(spark, d), path)
    lines = F.split("text", "\n")
    return read_records(spark, path).select(
        F.regexp_extract("text", r"TITLE=spectrum\.(\d+)", 1).cast("bigint").alias("MS1_ClusterID"),
        F.size(F.filter(lines, lambda x: x.rlike(r"^[0-9]"))).cast("bigint").alias("peaks"),
        F.octet_length("text").cast("bigint").alias("bytes"),
        F.sha2("text", 256).alias("sha256"),
    )


_FILTERED = f"""(SELECT *, cast(string_split(spectrum_id, '.')[2] AS bigint) AS "MS1_ClusterID" FROM {D('psm')}
    WHERE q_value < 0.01 AND protein_list NOT LIKE '%rev_%')"""
_OWNED = f"(SELECT f.*, p.MS1_ClusterID FROM {D('fragments')} f JOIN {_FILTERED} p ON f.psm_id = p.psm_id)"
_PAIRS = f"""(SELECT e.MS1_ClusterID, e.MS2_ClusterID, f.psm_id, f.fragment_mz_experimental AS mz,
      f.MS2_ClusterID AS f2, f.fragment_key, f.fragment_ordinals
    FROM {D('edges')} e JOIN {D('fragment_mz')} n ON n.ClusterID = e.MS2_ClusterID
    JOIN {_OWNED} f ON f.MS1_ClusterID = e.MS1_ClusterID
      AND f.fragment_mz_experimental >= n.mz_wmean - n.mz_wmean * 0.02::double
      AND f.fragment_mz_experimental <= n.mz_wmean + n.mz_wmean * 0.02::double)"""
_MAPPED_EDGES = f"""(SELECT MS1_ClusterID, MS2_ClusterID, count(*) AS n_fragments,
      fsum(mz) / count(*) AS mean_mz FROM {_PAIRS} GROUP BY ALL)"""
_MAPPED_FRAGMENTS = f"""(SELECT * FROM {_OWNED} o WHERE EXISTS (SELECT 1 FROM {_PAIRS} p
      WHERE p.psm_id = o.psm_id AND p.f2 = o.MS2_ClusterID AND p.fragment_key = o.fragment_key
        AND p.fragment_ordinals = o.fragment_ordinals AND p.mz = o.fragment_mz_experimental))"""
_MAPPED_PSMS = f"(SELECT * FROM {_FILTERED} WHERE psm_id IN (SELECT psm_id FROM {_MAPPED_FRAGMENTS}))"
_REFINED = f"""(SELECT * FROM {D('edges')} WHERE Y = 1
    OR MS2_ClusterID NOT IN (SELECT MS2_ClusterID FROM {D('edges')} WHERE Y = 1))"""


def _range_sql(kind: str) -> str:
    return f"""(SELECT ClusterID, ClusterID % 32 AS day, min(frame) AS lo, max(frame) AS hi
                FROM {D('peaks')} WHERE grp = '{kind}' GROUP BY ClusterID)"""


def _fixed(x: str) -> str:
    return f"cast(cast({x} AS decimal(28, 4)) AS varchar)"


_LINES = f"""(
    WITH e AS {D('edges')}, a AS (SELECT * FROM {D('ms1')} WHERE ClusterID IN (SELECT MS1_ClusterID FROM e)),
    b AS {D('ms2')}
    SELECT ClusterID AS MS1_ClusterID, 0 AS section, NULL::double AS mz, NULL::double AS intensity,
      NULL::bigint AS MS2_ClusterID, concat('BEGIN IONS', chr(10), 'TITLE=spectrum.', ClusterID, chr(10),
        'PEPMASS=', {_fixed('mz_wmean')}, chr(10), 'RTINSECONDS=', {_fixed('retention_time_wmean')}, chr(10),
        'CHARGE=', charge) AS line FROM a
    UNION ALL
    SELECT e.MS1_ClusterID, 1, b.mz_wmean, b.intensity_sum, e.MS2_ClusterID,
      concat({_fixed('b.mz_wmean')}, ' ', {_fixed('b.intensity_sum')}) FROM e JOIN b ON b.ClusterID = e.MS2_ClusterID
    UNION ALL
    SELECT ClusterID, 2, NULL, NULL, NULL, 'END IONS' FROM a)"""


def search_stats_sql(psms: str, fragments: str, edges: str) -> str:
    from workload.count_queries import stats_sql

    names = [
        "proteins_in_protein_groups", "protein_groups", "peptide_sequences_stripped_of_mods",
        "peptides_with_mods", "charged_peptides_with_mods", "phosphopeptides", "MS1_ClusterID",
    ]
    wide = stats_sql(psms)
    parts = [f"""SELECT '{n}' AS metric, "{n}" AS n FROM ({wide})""" for n in names]
    for t in "yb":
        parts.append(
            f"""SELECT 'unique_{t}_fragments', count(*) FROM (SELECT DISTINCT MS1_ClusterID, fragment_ordinals
                FROM {fragments} WHERE fragment_type = '{t}')"""
        )
    parts.append(f"SELECT 'edges', count(*) FROM {edges}")
    parts.append(
        f"""SELECT 'edges_with_multiply_annotated_fragments', count(*) FROM {edges} WHERE n_fragments > 1"""
    )
    parts.append(
        f"""SELECT 'precursors_with_multiply_annotated_fragments', count(DISTINCT MS1_ClusterID)
            FROM {edges} WHERE n_fragments > 1"""
    )
    return " UNION ALL ".join(parts)


QUERIES = {
    "lookup": (
        lookup,
        f"""SELECT f.*, p.MS1_ClusterID FROM {D('fragments')} f LEFT JOIN (
              SELECT psm_id, cast(string_split(spectrum_id, '.')[2] AS bigint) AS "MS1_ClusterID"
              FROM {D('psm')} WHERE charge <> 2) p ON f.psm_id = p.psm_id""",
    ),
    "edge_features": (
        edge_features,
        f"""SELECT a.ClusterID AS ms1_ClusterID, a.mz_wmean AS ms1_mz_wmean, a.scan_wmean AS ms1_scan_wmean,
              a.retention_time_wmean AS ms1_retention_time_wmean,
              b.ClusterID AS ms2_ClusterID, b.mz_wmean AS ms2_mz_wmean, b.scan_wmean AS ms2_scan_wmean,
              b.retention_time_wmean AS ms2_retention_time_wmean,
              a.mz_wmean - b.mz_wmean AS diff_mz_wmean, a.scan_wmean - b.scan_wmean AS diff_scan_wmean,
              a.retention_time_wmean - b.retention_time_wmean AS diff_retention_time_wmean, e.score, e.Y
            FROM {D('edges')} e JOIN {D('ms1')} a ON a.ClusterID = e.MS1_ClusterID
            JOIN {D('ms2')} b ON b.ClusterID = e.MS2_ClusterID""",
    ),
    "combined_stats": (
        combined_stats,
        f"""SELECT ClusterID, min(frame) AS frame_min, max(frame) AS frame_max, max(mz) AS top_mz
            FROM {D('peaks')} GROUP BY ClusterID""",
    ),
    "range_match": (
        range_match,
        f"""SELECT a.ClusterID AS "MS1_ClusterID", b.ClusterID AS "MS2_ClusterID"
            FROM {_range_sql('purchase')} a JOIN {_range_sql('signup')} b
              ON a.day = b.day AND a.lo <= b.hi AND b.lo <= a.hi""",
    ),
    "range_match_2d": (
        range_match_2d,
        f"""SELECT a.ClusterID AS "MS1_ClusterID", b.ClusterID AS "MS2_ClusterID", a.mz_wmean / 200 AS mz1,
              b.precursor_mz_pred_fastmist AS mz2
            FROM {D('ms1')} a JOIN {D('ms2')} b ON a.frame_min <= b.frame_max AND b.frame_min <= a.frame_max
              AND a.retention_time_min <= b.retention_time_max AND b.retention_time_min <= a.retention_time_max
              AND abs(b.precursor_mz_pred_fastmist - a.mz_wmean / 200) <= a.mz_wmean / 200 * 0.2::double""",
    ),
    "search_filter_psms": (search_filter_psms, f"SELECT * FROM {_FILTERED}"),
    "search_filter_fragments": (
        search_filter_fragments,
        f"SELECT * FROM {D('fragments')} WHERE psm_id IN (SELECT psm_id FROM {_FILTERED})",
    ),
    "mapped_edges": (
        mapped_edges,
        f"""SELECT MS1_ClusterID, MS2_ClusterID, n_fragments, mean_mz AS fragment_mz_mean
            FROM {_MAPPED_EDGES}""",
    ),
    "mapped_fragments": (mapped_fragments, f"SELECT * FROM {_MAPPED_FRAGMENTS}"),
    "mapped_precursors": (mapped_precursors, f"SELECT * FROM {_MAPPED_PSMS}"),
    "search_stats": (search_stats, search_stats_sql(_MAPPED_PSMS, _MAPPED_FRAGMENTS, _MAPPED_EDGES)),
    "refined_edges": (refined_edges, f"SELECT * FROM {_REFINED}"),
    "refined_counts": (
        refined_counts,
        f"""SELECT count(*) AS total, count(*) FILTER (Y = 1) AS positive,
              (SELECT count(*) FROM {_REFINED}) AS kept FROM {D('edges')}""",
    ),
    "refined_degrees": (
        refined_degrees,
        f"""WITH k AS (SELECT *, Y = 1 AS found, Y = 1 OR MS2_ClusterID NOT IN (SELECT MS2_ClusterID FROM {D('edges')} WHERE Y = 1) AS kept
              FROM {D('edges')})
            """
        + " UNION ALL ".join(
            f"""SELECT '{x}' AS level, {x}_ClusterID AS "ClusterID", count(*) AS n_edges, count(*) FILTER (found) AS n_found,
              count(*) FILTER (kept) AS n_kept FROM k GROUP BY {x}_ClusterID"""
            for x in ("MS1", "MS2")
        ),
    ),
    "refined_capped": (
        refined_capped,
        f"""SELECT MS1_ClusterID, MS2_ClusterID, score, Y FROM (SELECT *, row_number()
              OVER (PARTITION BY MS2_ClusterID ORDER BY score DESC, MS1_ClusterID) AS r FROM {_REFINED}) WHERE r <= 12""",
    ),
    "spectra": (spectra, f"SELECT * FROM {_LINES}"),
    "spectrum_files": (
        spectrum_files,
        f"""WITH t AS (SELECT MS1_ClusterID, count(*) FILTER (section = 1) AS peaks,
              string_agg(line || chr(10), '' ORDER BY section, mz, intensity, MS2_ClusterID) AS text
              FROM {_LINES} GROUP BY MS1_ClusterID)
            SELECT MS1_ClusterID, peaks, cast(octet_length(encode(text)) AS bigint) AS bytes, sha256(text) AS sha256 FROM t""",
    ),
}
