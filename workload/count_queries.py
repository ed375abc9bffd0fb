"""Column functions, filters, projections, counts and set membership."""

from __future__ import annotations

from pyspark.sql import functions as F

from ionweave.functions import numeric, text
from ionweave.functions.documents import with_nested
from ionweave.operators import filters, membership, summaries
from ionweave.operators.compliance import compliance_report
from workload.fixtures import duck_sql as D
from workload.fixtures import spark_table as T

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
NAMES = ("urgent", "high", "medium", "unspecified", "low")


def _customer_sets(spark, d):
    orders = T(spark, d, "orders")
    parts = [orders.where(F.col("o_orderpriority") == p) for p in PRIORITIES]
    return membership.named_tables(parts, NAMES)


def confidence_filter(spark, d):
    return filters.confident_targets(T(spark, d, "rescored"))


def sql_filter(spark, d):
    return filters.query_tables(
        "SELECT * FROM {source} WHERE `mokapot q-value` < 0.005 AND charge >= 2", source=T(spark, d, "rescored")
    )


def edge_filter(spark, d):
    return filters.filter_edges(T(spark, d, "edges"), "score >= 25 OR Y = 1")


def edge_filter_batched(spark, d):
    return filters.filter_edges_batched(
        T(spark, d, "edges"),
        """SELECT MS1_ClusterID, MS2_ClusterID, score, original_idx, batch_id FROM {local_edges}
           WHERE score > (SELECT avg(cast(score AS bigint)) FROM {local_edges})""",
        batch_size=1000,
    )


def class_sizes(spark, d):
    negative, positive = filters.split_classes(T(spark, d, "edges"))
    size = lambda df, name: summaries.table_size(df).select(F.lit(name).alias("class"), "n")
    return filters.stacked(size(negative, "negative"), size(positive, "positive"))


def typed_columns(spark, d):
    return filters.typed_columns_only(T(spark, d, "ms1"))


def extents(spark, d):
    return filters.with_extents(T(spark, d, "ms1"))


def aligned(spark, d):
    one = filters.aligned_features(T(spark, d, "ms1"), {"mz_wmean": "precursor_mz_wmean", "scan_wmean": "scan_wmean"})
    two = filters.aligned_features(
        T(spark, d, "ms2"), {"precursor_mz_pred_fastmist": "precursor_mz_wmean", "scan_wmean": "scan_wmean"}
    )
    return filters.stacked(one.withColumn("level", F.lit(1)), two.withColumn("level", F.lit(2)))


def peptide_columns(spark, d):
    return T(spark, d, "psm").select(
        "psm_id",
        text.cluster_id(F.col("spectrum_id")).alias("MS1_ClusterID"),
        text.strip_modifications(F.col("peptide")).alias("stripped"),
        text.contains_pattern(F.col("peptide"), text.PHOSPHO_PATTERN).alias("phospho"),
        text.modification_tag(F.col("psm_id")).alias("tag"),
        text.modification_tag(F.col("psm_id"), text.SHORT_TAG).alias("short_tag"),
    )


def protein_members(spark, d):
    psms = T(spark, d, "psm")
    return psms.select("psm_id", F.explode(text.comma_members(F.col("protein_list"))).alias("protein"))


def sorted_groups(spark, d):
    return T(spark, d, "listed").select(
        "spectrum_id", F.concat_ws("|", text.protein_group(F.col("protein_list"))).alias("members")
    )


def number_columns(spark, d):
    price = F.col("l_extendedprice") * F.col("l_discount") / 7
    return T(spark, d, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        numeric.dyadic(F.col("l_extendedprice") / 3).alias("grid"),
        numeric.round_half_even(price).alias("rounded"),
    )


def modification_columns(spark, d):
    mods = T(spark, d, "part").select(F.col("p_partkey").alias("id"), (F.col("p_retailprice") / 7).alias("monoisotopic_mass"))
    return filters.with_modification_columns(mods)


def nested_update(spark, d):
    config = F.struct(
        F.col("p_partkey").alias("id"),
        F.struct(F.array(F.lit(-1.0), F.lit(1.0)).alias("ppm"), F.lit("ppm").alias("unit")).alias("precursor_tol"),
    )
    low, high = F.col("p_size") * -0.5, F.col("p_size") * 0.25
    updated = F.to_json(with_nested(config, {"precursor_tol.ppm": F.array(low, high)}))
    back = F.from_json(updated, "id bigint, precursor_tol struct<ppm: array<double>, unit: string>")
    return T(spark, d, "part").select(
        back["id"].alias("id"),
        back["precursor_tol"]["ppm"][0].alias("low"),
        back["precursor_tol"]["ppm"][1].alias("high"),
        back["precursor_tol"]["unit"].alias("unit"),
    )


def edge_counts(spark, d):
    return summaries.edge_counts(T(spark, d, "edges"))


def psm_stats(spark, d):
    return summaries.psm_stats(T(spark, d, "psm"))


def compound_distinct(spark, d):
    return summaries.distinct_counts(T(spark, d, "psm"), {"charged_peptides": ["peptide", "charge"]})


def multiplicity(spark, d):
    return summaries.multiplicity(T(spark, d, "fragments"), ["psm_id", "MS2_ClusterID"])


def protein_groups(spark, d):
    return summaries.protein_group_stats(T(spark, d, "listed"))


def presence_counts(spark, d):
    return membership.presence_counts_by_sql(
        _customer_sets(spark, d),
        {
            "customers": "SELECT o_custkey FROM {table}",
            "customer years": "SELECT o_custkey, year(o_orderdate) AS y FROM {table} WHERE o_totalprice > 100000",
        },
    )


def presence_flags(spark, d):
    return membership.presence(_customer_sets(spark, d), ["o_custkey"])


def presence_pattern(spark, d):
    flags = membership.presence(_customer_sets(spark, d), ["o_custkey"])
    return membership.keys_in_pattern(flags, {"urgent": True, "low": False, "high": True}, ["o_custkey"])


def compliance(spark, d):
    same = compliance_report(T(spark, d, "windows"), T(spark, d, "windows_flat"))
    flat = T(spark, d, "windows_flat")
    high = compliance_report(T(spark, d, "windows"), flat.withColumn("CollisionEnergy", F.col("CollisionEnergy") + 1))
    moved = compliance_report(
        T(spark, d, "windows"),
        T(spark, d, "windows").withColumn(
            "ScanNumBegin", F.col("ScanNumBegin") + F.when(F.col("WindowGroup") == 7, 1).otherwise(0)
        ),
    )
    case = lambda df, name: df.withColumn("case", F.lit(name))
    return filters.stacked(case(same, "same"), case(high, "high"), case(moved, "moved"))


def cluster_stats(spark, d):
    out = summaries.cluster_stats(T(spark, d, "peaks"), {"frame": "frame", "mz": "mz"})
    return out.withColumn("frame_wmean", F.round("frame_wmean", 9)).withColumn("mz_wmean", F.round("mz_wmean", 9))


def table_summary(spark, d):
    out = summaries.summarize_table(T(spark, d, "fragments"))
    return out.withColumn("mean", F.round("mean", 6))


def table_size(spark, d):
    return summaries.table_size(T(spark, d, "edges"))


def marginals(spark, d):
    return summaries.marginal_histograms(T(spark, d, "peaks"), {"frame": (0, 600), "mz": (-5, 2.5), "intensity": (0, 1)})


def histogram(spark, d):
    return summaries.histogram_2d(T(spark, d, "peaks"), ("frame", 0, 3600), ("mz", 0, 5), "intensity")


def _presence_sql(keys: str, where: str = "true") -> str:
    flags = ", ".join(f"bool_or(o_orderpriority = '{p}') AS {n}" for p, n in zip(PRIORITIES, NAMES))
    return f"SELECT {keys}, {flags} FROM orders WHERE {where} GROUP BY ALL"


def _compliance_sql(name: str, calibration: str) -> str:
    return f"""
      SELECT '{name}' AS "case", a.m AS dataset_min_collision_energy, b.m AS calibration_min_collision_energy,
        b.m = b.x AND b.nulls = 0 AS constant_collision_energy, diff.n = 0 AS schemes_agree,
        diff.n = 0 AND a.m >= b.m AS complies
      FROM (SELECT min(CollisionEnergy) AS m FROM {D('windows')}) a,
        (SELECT min(CollisionEnergy) AS m, max(CollisionEnergy) AS x,
           count(*) FILTER (CollisionEnergy IS NULL) AS nulls FROM {calibration}) b,
        (SELECT count(*) AS n FROM (
          (SELECT WindowGroup, ScanNumBegin FROM {D('windows')} EXCEPT ALL SELECT WindowGroup, ScanNumBegin FROM {calibration})
          UNION ALL
          (SELECT WindowGroup, ScanNumBegin FROM {calibration} EXCEPT ALL SELECT WindowGroup, ScanNumBegin FROM {D('windows')}))) diff"""


def _summary_sql(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n, count(*) FILTER ({c} IS NULL) AS n_null,
              count(DISTINCT {c}) AS n_distinct, cast(min({c}) AS double) AS min, cast(max({c}) AS double) AS max,
              round(cast({total}({c}) AS double) / count({c}), 6) AS mean FROM {D(table)}"""
        for c, total in columns.items()
    )


_COUNTED = ", ".join(f"{n}" for n in NAMES)
_STATS = """
    SELECT (SELECT count(DISTINCT p) FROM (SELECT unnest(string_split(protein_list, ',')) AS p FROM {t}))
        AS proteins_in_protein_groups,
      count(DISTINCT protein_list) AS protein_groups,
      count(DISTINCT regexp_replace(peptide, '\\[.*?\\]', '', 'g')) AS peptide_sequences_stripped_of_mods,
      count(DISTINCT peptide) AS peptides_with_mods,
      count(DISTINCT concat(peptide, '/', charge)) AS charged_peptides_with_mods,
      count(DISTINCT peptide) FILTER (regexp_matches(peptide, '79.9663')) AS phosphopeptides,
      count(DISTINCT cast(string_split(spectrum_id, '.')[2] AS bigint)) AS "MS1_ClusterID"
    FROM {t}"""


def stats_sql(table: str) -> str:
    return _STATS.replace("{t}", table)


QUERIES = {
    "confidence_filter": (
        confidence_filter,
        f"""SELECT * FROM {D('rescored')} WHERE "mokapot q-value" < 0.01 AND protein_list NOT LIKE '%rev_%'""",
    ),
    "sql_filter": (
        sql_filter,
        f"""SELECT * FROM {D('rescored')} WHERE "mokapot q-value" < 0.005 AND charge >= 2""",
    ),
    "edge_filter": (
        edge_filter,
        f"""SELECT * FROM (SELECT *, row_number() OVER (ORDER BY MS1_ClusterID, MS2_ClusterID) - 1 AS original_idx
            FROM {D('edges')}) WHERE score >= 25 OR Y = 1""",
    ),
    "edge_filter_batched": (
        edge_filter_batched,
        f"""WITH i AS (SELECT *, row_number() OVER (ORDER BY MS1_ClusterID, MS2_ClusterID) - 1 AS original_idx
              FROM {D('edges')}), b AS (SELECT *, original_idx // 1000 AS batch_id FROM i)
            SELECT MS1_ClusterID, MS2_ClusterID, score, original_idx, batch_id FROM (
              SELECT *, avg(cast(score AS bigint)) OVER (PARTITION BY batch_id) AS usual FROM b) WHERE score > usual""",
    ),
    "class_sizes": (
        class_sizes,
        f"""SELECT CASE WHEN Y = 0 THEN 'negative' ELSE 'positive' END AS class, count(*) AS n
            FROM {D('edges')} GROUP BY 1""",
    ),
    "typed_columns": (typed_columns, f"SELECT * EXCLUDE (note) FROM {D('ms1')}"),
    "extents": (
        extents,
        f"""SELECT frame_max - frame_min AS frame_extent,
              retention_time_max - retention_time_min AS retention_time_extent,
              inv_ion_mobility_max - inv_ion_mobility_min AS inv_ion_mobility_extent, * FROM {D('ms1')}""",
    ),
    "aligned": (
        aligned,
        f"""SELECT ClusterID, mz_wmean AS precursor_mz_wmean, scan_wmean, 1 AS level FROM {D('ms1')}
            UNION ALL SELECT ClusterID, precursor_mz_pred_fastmist, scan_wmean, 2 FROM {D('ms2')}""",
    ),
    "peptide_columns": (
        peptide_columns,
        f"""SELECT psm_id, cast(string_split(spectrum_id, '.')[2] AS bigint) AS "MS1_ClusterID",
              regexp_replace(peptide, '\\[.*?\\]', '', 'g') AS stripped,
              regexp_matches(peptide, '79.9663') AS phospho,
              concat('[UNIMOD:', psm_id, ']') AS tag, concat('[U:', psm_id, ']') AS short_tag FROM {D('psm')}""",
    ),
    "protein_members": (
        protein_members,
        f"SELECT psm_id, unnest(string_split(protein_list, ',')) AS protein FROM {D('psm')}",
    ),
    "sorted_groups": (
        sorted_groups,
        f"""SELECT spectrum_id, array_to_string(list_sort(string_split(
              replace(substr(protein_list, 2, length(protein_list) - 2), '''', ''), ', ')), '|') AS members
            FROM {D('listed')}""",
    ),
    "number_columns": (
        number_columns,
        """SELECT l_orderkey, l_linenumber, l_extendedprice,
             floor(l_extendedprice / 3 * 8192) * pow(2, -13) AS grid,
             round_even(l_extendedprice * l_discount / 7 * 1e4::double, 0) / 1e4::double AS rounded FROM lineitem""",
    ),
    "modification_columns": (
        modification_columns,
        """SELECT p_partkey AS id, p_retailprice / 7 AS monoisotopic_mass, concat('[UNIMOD:', p_partkey, ']') AS tag,
             concat('[U:', p_partkey, ']') AS short_tag,
             floor(p_retailprice / 7 * 8192) * pow(2, -13) AS machine_monoisotopic_mass FROM part""",
    ),
    "nested_update": (
        nested_update,
        "SELECT p_partkey AS id, p_size * -0.5::double AS low, p_size * 0.25::double AS high, 'ppm' AS unit FROM part",
    ),
    "edge_counts": (
        edge_counts,
        f"""SELECT count(DISTINCT MS1_ClusterID) AS "MS1_ClusterID",
              count(DISTINCT MS2_ClusterID) AS "MS2_ClusterID", count(*) AS edges FROM {D('edges')}""",
    ),
    "psm_stats": (psm_stats, stats_sql(D("psm"))),
    "compound_distinct": (
        compound_distinct,
        f"SELECT count(*) AS charged_peptides FROM (SELECT DISTINCT peptide, charge FROM {D('psm')})",
    ),
    "multiplicity": (
        multiplicity,
        f"""SELECT psm_id, MS2_ClusterID, count(*) AS n FROM {D('fragments')} GROUP BY ALL HAVING count(*) > 1""",
    ),
    "protein_groups": (
        protein_groups,
        f"""WITH g AS (SELECT list_sort(string_split(
                replace(substr(protein_list, 2, length(protein_list) - 2), '''', ''), ', ')) AS members FROM {D('listed')})
            SELECT (SELECT count(DISTINCT m) FROM (SELECT unnest(members) AS m FROM g)) AS proteins_in_protein_groups,
              count(DISTINCT members) AS protein_groups, count(DISTINCT members) = count(*) AS groups_are_unique FROM g""",
    ),
    "presence_counts": (
        presence_counts,
        f"""SELECT 'customers' AS sql, {_COUNTED}, count(*) AS count FROM ({_presence_sql('o_custkey')}) GROUP BY ALL
            UNION ALL
            SELECT 'customer years' AS sql, {_COUNTED}, count(*) AS count
            FROM ({_presence_sql('o_custkey, year(o_orderdate) AS y', 'o_totalprice > 100000')}) GROUP BY ALL""",
    ),
    "presence_flags": (presence_flags, _presence_sql("o_custkey")),
    "presence_pattern": (
        presence_pattern,
        f"""SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'
            INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '2-HIGH'
            EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'""",
    ),
    "compliance": (
        compliance,
        " UNION ALL ".join(
            [
                _compliance_sql("same", D("windows_flat")),
                _compliance_sql(
                    "high", f"(SELECT * REPLACE (CollisionEnergy + 1 AS CollisionEnergy) FROM {D('windows_flat')})"
                ),
                _compliance_sql(
                    "moved",
                    f"""(SELECT * REPLACE (ScanNumBegin + CASE WHEN WindowGroup = 7 THEN 1 ELSE 0 END AS ScanNumBegin)
                         FROM {D('windows')})""",
                ),
            ]
        ),
    ),
    "cluster_stats": (
        cluster_stats,
        f"""SELECT ClusterID, count(*) AS size, cast(sum(intensity) AS double) AS intensity_sum,
              round(cast(sum(frame * intensity) AS double) / cast(sum(intensity) AS double), 9) AS frame_wmean,
              min(frame) AS frame_min, max(frame) AS frame_max,
              round(fsum(mz * intensity) / cast(sum(intensity) AS double), 9) AS mz_wmean,
              min(mz) AS mz_min, max(mz) AS mz_max
            FROM {D('peaks')} GROUP BY ClusterID""",
    ),
    "table_summary": (
        table_summary,
        _summary_sql(
            "fragments",
            {
                "psm_id": "sum",
                "fragment_mz_experimental": "fsum",
                "MS2_ClusterID": "sum",
                "fragment_key": "sum",
                "fragment_ordinals": "sum",
            },
        ),
    ),
    "table_size": (table_size, f"SELECT count(*) AS n FROM {D('edges')}"),
    "marginals": (
        marginals,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS axis, cast(floor(({c} - {x}::double) / {w}::double) AS bigint) AS bin, count(*) AS n
                FROM {D('peaks')} GROUP BY 1, 2"""
            for c, x, w in (("frame", "0", "600"), ("mz", "(-5)", "2.5"), ("intensity", "0", "1"))
        ),
    ),
    "histogram": (
        histogram,
        f"""SELECT cast(floor(frame / 3600::double) AS bigint) AS bin_x, cast(floor(mz / 5::double) AS bigint) AS bin_y,
              count(*) AS n, cast(sum(intensity) AS bigint) AS weight FROM {D('peaks')} GROUP BY 1, 2""",
    ),
}
