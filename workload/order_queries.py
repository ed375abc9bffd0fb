"""Row index, order checks, ranks, quantiles, interpolation, packing and draws."""

from __future__ import annotations

from pyspark.sql import functions as F

from ionweave.operators import calibration, filters, ordering
from ionweave.operators.packing import pack
from ionweave.operators.refinement import fragment_ranks
from ionweave.operators.sampling import draw_per_class
from workload.fixtures import duck_sql as D
from workload.fixtures import spark_table as T
from workload.io_queries import PACK_SQL


def row_index(spark, d):
    return ordering.with_row_index(T(spark, d, "edges"), filters.EDGE_KEY)


def batches(spark, d):
    indexed = ordering.with_row_index(T(spark, d, "edges"), filters.EDGE_KEY)
    return ordering.with_batch_id(indexed, 700).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("original_idx").alias("first"), F.max("original_idx").alias("last")
    )


def sorted_check(spark, d):
    """Orders read by their key: are they sorted by customer?  They are not."""
    return ordering.check_sorted(T(spark, d, "orders"), ["o_custkey", "o_orderkey"], ["o_orderkey"])


def stored_order(spark, d):
    """Index the edges, sort by it, store, and check the stored files: by key they are in order, by score not."""
    from ionweave.staging import stage

    indexed = row_index(spark, d)
    stored = stage(indexed.repartitionByRange(8, "original_idx").sortWithinPartitions("original_idx"))
    placed = stored.select(
        *filters.EDGE_KEY, "score", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    reports = [
        ordering.check_sorted(placed, keys, ["file", "row"]).select(
            F.lit(name).alias("checked"), "is_sorted", "n_violations"
        )
        for name, keys in (("key", filters.EDGE_KEY), ("score", ["score"]))
    ]
    return filters.stacked(*reports)


def stored_index(spark, d):
    """Index of the given events by their place in the files, without a shuffle of rows."""
    return ordering.with_stored_index(T(spark, d, "events").select("event_id", "user_id", "value"))


def stored_files_order(spark, d):
    """The given tables as they are stored: events rise by id and not by user."""
    reports = [
        ordering.check_stored_order(T(spark, d, "events"), keys).select(F.lit(name).alias("checked"), "is_sorted", "n_violations", "first_violation_idx")
        for name, keys in (("id", ["event_id"]), ("user", ["user_id", "event_id"]))
    ]
    return filters.stacked(*reports)


def increasing_check(spark, d):
    return ordering.check_increasing(T(spark, d, "events"), "ts", ["event_id"])


def not_increasing(spark, d):
    return ordering.check_increasing(T(spark, d, "events"), "user_id", ["event_id"])


def capped_ranks(spark, d):
    return fragment_ranks(T(spark, d, "edges")).drop("Y")


def full_ranks(spark, d):
    return fragment_ranks(T(spark, d, "edges"), max_rank=None).drop("Y")


def sorted_edges(spark, d):
    return filters.in_order(T(spark, d, "edges"), filters.EDGE_KEY)


def first_edges(spark, d):
    return filters.preview(sorted_edges(spark, d))


def quantiles_by_group(spark, d):
    return ordering.exact_quantiles(T(spark, d, "events"), "value", 100, by=["event_type"])


def _knots(spark, d):
    cdf = quantiles_by_group(spark, d)
    return cdf.select("event_type", "probability", F.col("value").alias("ms1"), (F.col("value") * F.col("value")).alias("ms2"))


def interpolation(spark, d):
    return calibration.interpolate(_knots(spark, d), [0.0, 0.0213, 0.5, 0.98765, 1.0], by=["event_type"])


def tolerance_limits(spark, d):
    return calibration.tolerances(_knots(spark, d), ("m", 25), ("c", 98), by=["event_type"])


def _errors(spark, d):
    rows = T(spark, d, "errors")
    one = calibration.ppm_errors(rows.where("level = 'ms1'"), "observed", "expected", "ms1")
    return one.unionByName(calibration.ppm_errors(rows.where("level = 'ms2'"), "observed", "expected", "ms2"))


def error_distributions(spark, d):
    return calibration.error_distributions(_errors(spark, d))


def recalibrated_nodes(spark, d):
    nodes = T(spark, d, "ms1").select("ClusterID", "mz_wmean")
    return calibration.recalibrated(nodes, calibration.error_distributions(_errors(spark, d)), "ms1")


def _bins(spark, d, limit):
    return pack(T(spark, d, "documents"), "source", "doc_id", F.octet_length("text"), limit)


def packing_small(spark, d):
    return _bins(spark, d, 2_000)


def packing_large(spark, d):
    return _bins(spark, d, 50_000)


def class_draws(spark, d):
    return draw_per_class(T(spark, d, "labelled"), k=25_000, seed=7)


# value at each step of a grid, from ranks in whole numbers
GRID_SQL = """
    WITH v AS (SELECT {by} AS g, {value} AS x FROM {table} WHERE {value} IS NOT NULL),
    r AS (SELECT g, x, row_number() OVER (PARTITION BY g ORDER BY x) - 1 AS rn, count(*) OVER (PARTITION BY g) AS n FROM v),
    i AS (SELECT g, n, unnest(range(0, {steps} + 1)) AS step FROM (SELECT DISTINCT g, n FROM r)),
    w AS (SELECT g, step, n, (step * (n - 1)) // {steps} AS lo,
        cast((step * (n - 1)) % {steps} AS double) / {steps}::double AS w FROM i),
    q AS (SELECT w.g, cast(w.step AS int) AS step, w.step / {steps}::double AS probability,
        a.x + (b.x - a.x) * w.w AS value
      FROM w JOIN r a ON a.g = w.g AND a.rn = w.lo JOIN r b ON b.g = w.g AND b.rn = least(w.lo + 1, w.n - 1))"""

_EVENT_GRID = GRID_SQL.format(by="event_type", value="value", table="events", steps=100)
_ERRORS = f"(SELECT level, (observed - expected) / expected * 1e6::double AS error FROM {D('errors')})"
_ERROR_GRID = GRID_SQL.format(by="level", value="error", table=_ERRORS, steps=1000)


def _at(p: str, y: str) -> str:
    """Interpolated value of y at p over the knots k of one group, clamped at the ends."""
    return f"""(SELECT CASE WHEN x0 IS NULL THEN y1 WHEN x1 IS NULL THEN y0
        ELSE ((y1 - y0) / (x1 - x0)) * ({p} - x0) + y0 END
      FROM (SELECT max(probability) FILTER (probability <= {p}) AS x0,
          arg_max({y}, probability) FILTER (probability <= {p}) AS y0,
          min(probability) FILTER (probability > {p}) AS x1,
          arg_min({y}, probability) FILTER (probability > {p}) AS y1
        FROM k WHERE k.event_type = e.event_type))"""


_KNOTS = _EVENT_GRID + """,
    k AS (SELECT g AS event_type, probability, value AS ms1, value * value AS ms2 FROM q),
    e AS (SELECT DISTINCT event_type FROM k)"""

QUERIES = {
    "row_index": (
        row_index,
        f"SELECT *, row_number() OVER (ORDER BY MS1_ClusterID, MS2_ClusterID) - 1 AS original_idx FROM {D('edges')}",
    ),
    "batches": (
        batches,
        f"""SELECT i // 700 AS batch_id, count(*) AS n, min(i) AS first, max(i) AS last FROM (
              SELECT row_number() OVER (ORDER BY MS1_ClusterID, MS2_ClusterID) - 1 AS i FROM {D('edges')}) GROUP BY 1""",
    ),
    "sorted_check": (
        sorted_check,
        """SELECT count(*) FILTER (bad) = 0 AS is_sorted, count(*) FILTER (bad) AS n_violations,
             min(o_orderkey) FILTER (bad) AS first_violation_idx
           FROM (SELECT o_orderkey, (o_custkey, o_orderkey)
               <= lag((o_custkey, o_orderkey)) OVER (ORDER BY o_orderkey) AS bad FROM orders)""",
    ),
    "stored_order": (
        stored_order,
        " UNION ALL ".join(
            f"""SELECT '{name}' AS checked, count(*) FILTER (bad) = 0 AS is_sorted, count(*) FILTER (bad) AS n_violations
                FROM (SELECT {keys} <= lag({keys}) OVER (ORDER BY MS1_ClusterID, MS2_ClusterID) AS bad FROM {D('edges')})"""
            for name, keys in (("key", "(MS1_ClusterID, MS2_ClusterID)"), ("score", "score"))
        ),
    ),
    "stored_index": (
        stored_index,
        "SELECT event_id, user_id, value, row_number() OVER (ORDER BY event_id) - 1 AS original_idx FROM events",
    ),
    "stored_files_order": (
        stored_files_order,
        " UNION ALL ".join(
            f"""SELECT '{name}' AS checked, count(*) FILTER (bad) = 0 AS is_sorted, count(*) FILTER (bad) AS n_violations,
                  min(i) FILTER (bad) AS first_violation_idx
                FROM (SELECT i, {keys} <= lag({keys}) OVER (ORDER BY i) AS bad
                      FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events))"""
            for name, keys in (("id", "event_id"), ("user", "(user_id, event_id)"))
        ),
    ),
    "increasing_check": (
        increasing_check,
        """SELECT count(*) FILTER (bad) = 0 AS is_sorted, count(*) FILTER (bad) AS n_violations,
             min(event_id) FILTER (bad) AS first_violation_idx
           FROM (SELECT event_id, ts <= lag(ts) OVER (ORDER BY event_id) AS bad FROM events)""",
    ),
    "not_increasing": (
        not_increasing,
        """SELECT count(*) FILTER (bad) = 0 AS is_sorted, count(*) FILTER (bad) AS n_violations,
             min(event_id) FILTER (bad) AS first_violation_idx
           FROM (SELECT event_id, user_id <= lag(user_id) OVER (ORDER BY event_id) AS bad FROM events)""",
    ),
    "capped_ranks": (
        capped_ranks,
        f"""SELECT MS1_ClusterID, MS2_ClusterID, score, rank FROM (
              SELECT *, row_number() OVER (PARTITION BY MS2_ClusterID ORDER BY score DESC, MS1_ClusterID) AS rank
              FROM {D('edges')}) WHERE rank <= 12""",
    ),
    "full_ranks": (
        full_ranks,
        f"""SELECT MS1_ClusterID, MS2_ClusterID, score, row_number()
              OVER (PARTITION BY MS2_ClusterID ORDER BY score DESC, MS1_ClusterID) AS rank FROM {D('edges')}""",
    ),
    "sorted_edges": (sorted_edges, f"SELECT * FROM {D('edges')} ORDER BY MS1_ClusterID, MS2_ClusterID"),
    "first_edges": (first_edges, f"SELECT * FROM {D('edges')} ORDER BY MS1_ClusterID, MS2_ClusterID LIMIT 2"),
    "quantiles_by_group": (
        quantiles_by_group,
        _EVENT_GRID + " SELECT g AS event_type, step, probability, value FROM q",
    ),
    "interpolation": (
        interpolation,
        _KNOTS
        + " UNION ALL ".join(
            f" SELECT event_type, {p}::double AS probability, {_at(p + '::double', 'ms1')} AS ms1, "
            f"{_at(p + '::double', 'ms2')} AS ms2 FROM e"
            for p in ("0.0", "0.0213", "0.5", "0.98765", "1.0")
        ),
    ),
    "tolerance_limits": (
        tolerance_limits,
        _KNOTS
        + " SELECT event_type, "
        + ", ".join(
            f"round_even({_at(p + '::double', y)} * 1e4::double, 0) / 1e4::double AS {y}_{end}"
            for y in ("ms1", "ms2")
            for end, p in (("lo", "0.025"), ("hi", "0.98"))
        )
        + " FROM e",
    ),
    "error_distributions": (
        error_distributions,
        _ERROR_GRID
        + """ SELECT probability, max(value) FILTER (g = 'ms1') AS ms1, max(value) FILTER (g = 'ms2') AS ms2
              FROM q GROUP BY probability""",
    ),
    "recalibrated_nodes": (
        recalibrated_nodes,
        GRID_SQL.format(by="level", value="error", table=_ERRORS, steps=2)
        + f""" SELECT ClusterID, mz_wmean - mz_wmean * m * cast('1e-6' AS double) AS mz_wmean
               FROM {D('ms1')}, (SELECT value AS m FROM q WHERE g = 'ms1' AND step = 1)""",
    ),
    "packing_small": (
        packing_small,
        PACK_SQL.format(extra=0, limit=2000) + " SELECT source, doc_id, cast(bin AS bigint) AS bin FROM f",
    ),
    "packing_large": (
        packing_large,
        PACK_SQL.format(extra=0, limit=50000) + " SELECT source, doc_id, cast(bin AS bigint) AS bin FROM f",
    ),
    "class_draws": (
        class_draws,
        f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY Y ORDER BY MS1_ClusterID, MS2_ClusterID) - 1 AS rn,
              count(*) OVER (PARTITION BY Y) AS n FROM {D('labelled')}),
            i AS (SELECT Y, n, unnest(range(0, 25000)) AS i FROM (SELECT DISTINCT Y, n FROM r)),
            w AS (SELECT Y, ('0x' || substr(md5(concat('7|', Y, '|', i)), 1, 15))::BIGINT % n AS rn FROM i)
            SELECT r.MS1_ClusterID, r.MS2_ClusterID, r.Y FROM w JOIN r ON r.Y = w.Y AND r.rn = w.rn""",
    ),
}
