"""The composed jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ionweave.operators.filters import EDGE_KEY, in_order
from ionweave.plans import jobs
from ionweave.sources.sinks import write_table
from ionweave.staging import new_path
from workload.count_queries import stats_sql
from workload.fixtures import duck_sql as D
from workload.fixtures import spark_table as T
from workload.io_queries import _spectrum_files
from workload.join_queries import FRAGMENT_ID, HEADER, search_stats_sql
from workload.order_queries import _ERRORS, GRID_SQL, _errors

CONFIG = {
    "database": {"decoy_tag": "rev_", "fasta": None},
    "precursor_tol": {"ppm": [-20.0, 20.0]},
    "fragment_tol": {"ppm": [-30.0, 30.0]},
    "min_peaks": 15,
}


def fragment_table(spark, d):
    psms = T(spark, d, "psm").select("psm_id", F.col("spectrum_id").alias("scannr"))
    return jobs.fragment_table(psms, T(spark, d, "fragments"))


def rescoring_report(spark, d):
    path = new_path(spark, "rescored")
    T(spark, d, "rescored").write.csv(path, sep="\t", header=True)
    return jobs.rescoring_report(spark, path)


def rescored_psms(spark, d):
    return jobs.rescored_psm_summary(T(spark, d, "listed"))["psms"]


def rescored_repeats(spark, d):
    return jobs.rescored_psm_summary(T(spark, d, "listed"))["repeated"]


def training_set(spark, d):
    return jobs.training_set(T(spark, d, "labelled"), T(spark, d, "ms1"), T(spark, d, "ms2"), seed=3).drop(
        "ms2_precursor_mz_pred_fastmist"
    )


def tolerance_update(spark, d):
    out = jobs.tolerance_update(_errors(spark, d), CONFIG)
    back = F.from_json(
        "config",
        "database struct<decoy_tag: string>, precursor_tol struct<ppm: array<double>>, "
        "fragment_tol struct<ppm: array<double>>, min_peaks bigint",
    )
    return out.select(
        back["precursor_tol"]["ppm"][0].alias("ms1_lo"),
        back["precursor_tol"]["ppm"][1].alias("ms1_hi"),
        back["fragment_tol"]["ppm"][0].alias("ms2_lo"),
        back["fragment_tol"]["ppm"][1].alias("ms2_hi"),
        back["database"]["decoy_tag"].alias("decoy_tag"),
        back["min_peaks"].alias("min_peaks"),
    )


def stored_edges(spark, d):
    path = new_path(spark, "sorted")
    write_table(in_order(T(spark, d, "edges"), EDGE_KEY), path)
    return jobs.filtered_edge_table(spark.read.parquet(path), "score > 40", new_path(spark, "edges"))


SHARD_LIMIT = 200_000


def spectrum_shards(spark, d):
    path = new_path(spark, "shards")
    jobs.spectrum_shards(spark, _spectrum_files(spark, d), path, SHARD_LIMIT)
    shard = F.col("_metadata.file_path").alias("shard")
    lines = spark.read.text(path).select(shard, "value")
    per_shard = lines.groupBy("shard").agg(
        F.sum(F.octet_length("value") + 1).alias("bytes"), F.count_if(F.col("value") == "END IONS").alias("records")
    )
    in_bounds = (F.col("bytes") < SHARD_LIMIT) | (F.col("records") == 1)
    return per_shard.agg(
        F.sum("records").alias("records"), F.sum("bytes").alias("bytes"), F.bool_and(in_bounds).alias("in_bounds")
    )


SETTINGS = jobs.GenerationSettings(
    axes={"frame": "frame", "mz": "mz"},
    match_axes={"frame": 10.0},
    tolerance=0.05,
    header={"PEPMASS": "mz_wmean", "RTINSECONDS": "frame_wmean", "CHARGE": "charge"},
    confidence={"q_column": "q_value"},
)


def _first(spark, d):
    one, two = T(spark, d, "precursor_points"), T(spark, d, "fragment_points")
    extra = one.groupBy("ClusterID").agg((F.max("event_id") % 3 + 1).cast("int").alias("charge"))
    return jobs.first_generation(one, two, extra, SETTINGS, {"day": F.col("ClusterID") % 4})


def _both(spark, d):
    first = _first(spark, d)
    hits, fragments = T(spark, d, "hits"), T(spark, d, "fragments")
    return first, jobs.refine_generation(first, hits, fragments, SETTINGS, FRAGMENT_ID)


def _refined(spark, d):
    return _both(spark, d)[1]


def _second(spark, d):
    first, refined = _both(spark, d)
    return jobs.second_generation(first, refined, T(spark, d, "hits"), T(spark, d, "fragments"), SETTINGS, FRAGMENT_ID)


def generation_matches(spark, d):
    return _first(spark, d)["edges"]


def generation_spectra(spark, d):
    return _first(spark, d)["spectra"].groupBy("MS1_ClusterID").agg(
        F.count_if(F.col("section") == 1).alias("peaks"),
        F.sum(F.octet_length("line") + 1).alias("bytes"),
    )


def generation_edges(spark, d):
    return _refined(spark, d)["edges"]


def generation_counts(spark, d):
    return _refined(spark, d)["edge_counts"]


def generation_errors(spark, d):
    out = _refined(spark, d)["error_distributions"]
    return out.select("probability", F.round("ms1", 3).alias("ms1"), F.round("ms2", 3).alias("ms2"))


def second_pass_edges(spark, d):
    return _second(spark, d)["edges"].select("MS1_ClusterID", "MS2_ClusterID", "n_fragments")


def second_pass_stats(spark, d):
    return _second(spark, d)["stats"]


_NODES = """(SELECT ClusterID, ClusterID % 4 AS day, min(frame) AS frame_min, max(frame) AS frame_max,
    fsum(mz * intensity) / cast(sum(intensity) AS double) AS mz_wmean,
    cast(sum(frame * intensity) AS double) / cast(sum(intensity) AS double) AS frame_wmean,
    cast(sum(intensity) AS double) AS intensity_sum{more} FROM {points} GROUP BY ClusterID)"""
_CHARGE = ", cast(max(event_id) % 3 + 1 AS int) AS charge"
_GENERATION = f"""
    WITH n1 AS MATERIALIZED {_NODES.format(points=D('precursor_points'), more=_CHARGE)},
    n2 AS MATERIALIZED {_NODES.format(points=D('fragment_points'), more='')},
    e AS MATERIALIZED (SELECT n1.ClusterID AS m1, n2.ClusterID AS m2, n2.mz_wmean AS mz2 FROM n1 JOIN n2
      ON n1.day = n2.day AND n1.frame_min <= n2.frame_max AND n2.frame_min <= n1.frame_max),
    p AS MATERIALIZED (SELECT h.*, n1.mz_wmean FROM {D('hits')} h JOIN n1 ON n1.ClusterID = h.MS1_ClusterID
      WHERE q_value < 0.01 AND protein_list NOT LIKE '%rev_%'),
    f AS MATERIALIZED (SELECT p.MS1_ClusterID, g.* FROM {D('fragments')} g JOIN p ON p.psm_id = g.psm_id),
    x AS MATERIALIZED (SELECT e.m1, e.m2, e.mz2, f.* FROM e JOIN f ON f.MS1_ClusterID = e.m1
      AND fragment_mz_experimental >= e.mz2 - e.mz2 * 0.05::double AND fragment_mz_experimental <= e.mz2 + e.mz2 * 0.05::double),
    found AS (SELECT m1, m2, mz2, fsum(fragment_mz_experimental) / count(*) AS mean_mz FROM x GROUP BY ALL),
    kept AS (SELECT m1, m2 FROM e WHERE (m1, m2) IN (SELECT (m1, m2) FROM found)
      OR m2 NOT IN (SELECT m2 FROM found)),
    err AS (SELECT 'ms1' AS level, (mz_wmean - expected_mz) / expected_mz * 1e6::double AS error
        FROM p WHERE psm_id IN (SELECT psm_id FROM x)
      UNION ALL SELECT 'ms2', (mz2 - mean_mz) / mean_mz * 1e6::double FROM found)"""
_SECOND = (
    _GENERATION
    + ", "
    + GRID_SQL.format(by="level", value="error", table="err", steps=2).replace("WITH ", "", 1)
    + """,
    y AS MATERIALIZED (SELECT e.m1, e.m2, f.* FROM (
        SELECT m1, m2, mz2 - mz2 * m * cast('1e-6' AS double) AS mz2 FROM e, (SELECT value AS m FROM q WHERE g = 'ms2' AND step = 1)) e
      JOIN f ON f.MS1_ClusterID = e.m1
        AND fragment_mz_experimental >= e.mz2 - e.mz2 * 0.05::double AND fragment_mz_experimental <= e.mz2 + e.mz2 * 0.05::double),
    again AS (SELECT m1 AS "MS1_ClusterID", m2 AS "MS2_ClusterID", count(*) AS n_fragments FROM y GROUP BY ALL),
    hit AS (SELECT * FROM p WHERE psm_id IN (SELECT psm_id FROM y)),
    piece AS (SELECT DISTINCT * EXCLUDE (m1, m2) FROM y)"""
)


def _fixed(x: str) -> str:
    return f"cast(cast({x} AS decimal(28, 4)) AS varchar)"


QUERIES = {
    "fragment_table": (
        fragment_table,
        f"""SELECT f.*, cast(string_split(p.spectrum_id, '.')[2] AS bigint) AS "MS1_ClusterID"
            FROM {D('fragments')} f LEFT JOIN {D('psm')} p ON f.psm_id = p.psm_id""",
    ),
    "rescoring_report": (
        rescoring_report,
        stats_sql(f"(SELECT * FROM {D('psm')} WHERE q_value < 0.01 AND protein_list NOT LIKE '%rev_%')"),
    ),
    "rescored_psms": (
        rescored_psms,
        f"""SELECT *, cast(string_split(spectrum_id, '.')[2] AS bigint) AS "MS1_ClusterID" FROM {D('listed')}""",
    ),
    "rescored_repeats": (
        rescored_repeats,
        f"""SELECT cast(string_split(spectrum_id, '.')[2] AS bigint) AS "MS1_ClusterID", count(*) AS n
            FROM {D('listed')} GROUP BY 1 HAVING count(*) > 1""",
    ),
    "training_set": (
        training_set,
        f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY Y ORDER BY MS1_ClusterID, MS2_ClusterID) - 1 AS rn,
              count(*) OVER (PARTITION BY Y) AS n FROM {D('labelled')}),
            i AS (SELECT Y, n, unnest(range(0, 25000)) AS i FROM (SELECT DISTINCT Y, n FROM r)),
            w AS (SELECT Y, ('0x' || substr(md5(concat('3|', Y, '|', i)), 1, 15))::BIGINT % n AS rn FROM i),
            e AS (SELECT r.* FROM w JOIN r ON r.Y = w.Y AND r.rn = w.rn)
            SELECT """
        + ", ".join(
            f"{t}.{c} AS {p}_{c}"
            for t, p, more in (("a", "ms1", ["charge"]), ("b", "ms2", ["intensity_sum"]))
            for c in [
                "ClusterID", "mz_wmean", "scan_wmean", "retention_time_wmean", "frame_min", "frame_max",
                "retention_time_min", "retention_time_max", "inv_ion_mobility_min", "inv_ion_mobility_max", *more,
            ]
        )
        + ", "
        + ", ".join(
            f"{t}.{x}_max - {t}.{x}_min AS {p}_{x}_extent"
            for t, p in (("a", "ms1"), ("b", "ms2"))
            for x in ("frame", "retention_time", "inv_ion_mobility")
        )
        + f""", a.mz_wmean - b.precursor_mz_pred_fastmist AS diff_precursor_mz_wmean,
              a.scan_wmean - b.scan_wmean AS diff_scan_wmean,
              a.retention_time_wmean - b.retention_time_wmean AS diff_retention_time_wmean, e.Y AS is_positive
            FROM e JOIN {D('ms1')} a ON a.ClusterID = e.MS1_ClusterID JOIN {D('ms2')} b ON b.ClusterID = e.MS2_ClusterID""",
    ),
    "tolerance_update": (
        tolerance_update,
        GRID_SQL.format(by="level", value="error", table=_ERRORS, steps=1000)
        + """ SELECT """
        + ", ".join(
            f"max(round_even(value * 1e4::double, 0) / 1e4::double) FILTER (g = '{y}' AND step = {s}) AS {y}_{end}"
            for y in ("ms1", "ms2")
            for end, s in (("lo", 20), ("hi", 980))
        )
        + ", 'rev_' AS decoy_tag, 15::bigint AS min_peaks FROM q",
    ),
    "stored_edges": (
        stored_edges,
        f"""SELECT * FROM (SELECT *, row_number() OVER (ORDER BY MS1_ClusterID, MS2_ClusterID) - 1 AS original_idx
            FROM {D('edges')}) WHERE score > 40""",
    ),
    "spectrum_shards": (
        spectrum_shards,
        """SELECT count(*) AS records, cast(sum(octet_length(encode(text)) + length('BEGIN IONS') + length('TITLE=')
             + length(cast(doc_id AS varchar)) + length('END IONS') + 4) AS bigint) AS bytes, true AS in_bounds
           FROM documents""",
    ),
    "generation_matches": (
        generation_matches,
        _GENERATION + ' SELECT m1 AS "MS1_ClusterID", m2 AS "MS2_ClusterID" FROM e',
    ),
    "generation_spectra": (
        generation_spectra,
        _GENERATION
        + f""", line AS (
              SELECT ClusterID AS m1, 0 AS peak, length(concat('BEGIN IONS.TITLE=spectrum.', ClusterID, '.PEPMASS=',
                {_fixed('mz_wmean')}, '.RTINSECONDS=', {_fixed('frame_wmean')}, '.CHARGE=', charge, '.END IONS.')) AS bytes
              FROM n1 WHERE ClusterID IN (SELECT m1 FROM e)
              UNION ALL
              SELECT m1, 1, length(concat({_fixed('mz_wmean')}, ' ', {_fixed('intensity_sum')})) + 1
              FROM e JOIN n2 ON n2.ClusterID = m2)
            SELECT m1 AS "MS1_ClusterID", count(*) FILTER (peak = 1) AS peaks, cast(sum(bytes) AS bigint) AS bytes
            FROM line GROUP BY m1""",
    ),
    "generation_edges": (
        generation_edges,
        _GENERATION + ' SELECT m1 AS "MS1_ClusterID", m2 AS "MS2_ClusterID" FROM kept',
    ),
    "generation_counts": (
        generation_counts,
        _GENERATION
        + """ SELECT (SELECT count(*) FROM e) AS total, (SELECT count(*) FROM found) AS positive,
                (SELECT count(*) FROM kept) AS kept""",
    ),
    "second_pass_edges": (second_pass_edges, _SECOND + " SELECT * FROM again"),
    "second_pass_stats": (second_pass_stats, _SECOND + " " + search_stats_sql("(SELECT * FROM hit)", "(SELECT * FROM piece)", "(SELECT * FROM again)")),
    "generation_errors": (
        generation_errors,
        _GENERATION
        + ", "
        + GRID_SQL.format(by="level", value="error", table="err", steps=1000).replace("WITH ", "", 1)
        + """ SELECT probability, round(max(value) FILTER (g = 'ms1'), 3) AS ms1,
                round(max(value) FILTER (g = 'ms2'), 3) AS ms2 FROM q GROUP BY probability""",
    ),
}
