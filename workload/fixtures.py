"""Tables shaped like identification data, derived from the given ones.

Each text is one SELECT that both engines accept; ``{orders}`` and the like are the given tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SQL = {
    "psm": """
        SELECT o_orderkey AS psm_id,
          concat('run.', cast(o_orderkey AS string), '.', cast(o_custkey AS string)) AS spectrum_id,
          concat('PEP', cast(o_custkey % 50 AS string),
            CASE WHEN o_orderkey % 3 = 0 THEN '[+79.9663]K'
                 WHEN o_orderkey % 3 = 1 THEN '[+15.9949]M' ELSE 'R' END) AS peptide,
          cast(o_orderkey % 4 + 1 AS int) AS charge,
          concat(CASE WHEN o_orderkey % 7 = 0 THEN 'rev_' ELSE '' END, 'P',
            cast(o_custkey % 40 AS string), ',P', cast(o_custkey % 15 AS string)) AS protein_list,
          cast(o_orderkey % 100 AS double) / 4000 AS q_value
        FROM {orders}""",
    "fragments": """
        SELECT l_orderkey AS psm_id, l_extendedprice AS fragment_mz_experimental,
          l_partkey AS MS2_ClusterID, l_suppkey AS fragment_key, l_linenumber AS fragment_ordinals,
          CASE WHEN l_returnflag = 'A' THEN 'b' ELSE 'y' END AS fragment_type
        FROM {lineitem}""",
    "edges": """
        SELECT l_orderkey AS MS1_ClusterID, l_partkey AS MS2_ClusterID, max(l_quantity) AS score,
          max(CASE WHEN l_quantity = 1 AND l_discount = 0 THEN 1 ELSE 0 END) AS Y
        FROM {lineitem} GROUP BY l_orderkey, l_partkey""",
    "labelled": """
        SELECT l_orderkey AS MS1_ClusterID, min(l_partkey) AS MS2_ClusterID, 1 AS Y
        FROM {lineitem} GROUP BY l_orderkey
        UNION ALL
        SELECT l_orderkey AS MS1_ClusterID, max(l_partkey) AS MS2_ClusterID, 0 AS Y
        FROM {lineitem} GROUP BY l_orderkey""",
    "errors": """
        SELECT 'ms1' AS level, o_totalprice AS observed,
          o_totalprice * (1 + (o_orderkey % 21 - 10) * cast('1e-6' AS double)) AS expected FROM {orders}
        UNION ALL
        SELECT 'ms2' AS level, l_extendedprice AS observed,
          l_extendedprice * (1 + (l_orderkey % 31 - 12) * cast('1e-6' AS double)) AS expected FROM {lineitem}
        WHERE l_extendedprice > 0""",
    "ms1": """
        SELECT o_orderkey AS ClusterID, o_totalprice AS mz_wmean, cast(o_custkey AS double) AS scan_wmean,
          cast(year(o_orderdate) AS double) AS retention_time_wmean,
          o_custkey AS frame_min, o_custkey + o_orderkey % 100 AS frame_max,
          cast(o_custkey % 50 AS double) AS retention_time_min,
          cast(o_custkey % 50 + o_orderkey % 10 AS double) AS retention_time_max,
          cast(1 AS double) AS inv_ion_mobility_min,
          cast(1 + o_orderkey % 4 AS double) AS inv_ion_mobility_max,
          cast(o_orderkey % 4 + 1 AS int) AS charge, o_orderpriority AS note
        FROM {orders}""",
    "ms2": """
        SELECT p_partkey AS ClusterID, p_retailprice AS precursor_mz_pred_fastmist,
          cast(p_size AS double) AS scan_wmean, cast(p_partkey % 7 AS double) AS retention_time_wmean,
          cast(p_partkey AS bigint) AS frame_min, p_partkey + p_size AS frame_max,
          cast(p_size AS double) AS retention_time_min, cast(p_size + p_partkey % 9 AS double) AS retention_time_max,
          cast(2 AS double) AS inv_ion_mobility_min, cast(2 + p_partkey % 3 AS double) AS inv_ion_mobility_max,
          p_retailprice AS mz_wmean, cast(p_size AS double) AS intensity_sum, p_brand AS note
        FROM {part}""",
    "fragment_mz": """
        SELECT l_partkey AS ClusterID, max(l_extendedprice) AS mz_wmean FROM {lineitem} GROUP BY l_partkey""",
    "peaks": """
        SELECT user_id * 32 + day(ts) AS ClusterID, event_type AS grp, event_id,
          cast(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS bigint) AS frame,
          value AS mz, cast(event_id % 17 + 1 AS bigint) AS intensity
        FROM {events}""",
    "precursor_points": """
        SELECT l_orderkey AS ClusterID, l_linenumber AS event_id, cast(l_orderkey % 5000 * 10 + l_linenumber AS bigint) AS frame,
          l_extendedprice AS mz, cast(l_suppkey % 17 + 1 AS bigint) AS intensity FROM {lineitem}""",
    "fragment_points": """
        SELECT l_partkey AS ClusterID, cast(l_partkey % 5000 * 10 + l_linenumber AS bigint) AS frame,
          l_extendedprice AS mz, cast(l_linenumber AS bigint) AS intensity FROM {lineitem}""",
    "hits": """
        SELECT p.*, p.psm_id AS MS1_ClusterID, o_totalprice AS expected_mz FROM ({psm}) p JOIN {orders} ON o_orderkey = p.psm_id""",
    "windows": """
        SELECT p_partkey AS WindowGroup, p_size AS ScanNumBegin,
          cast(20 + p_partkey % 25 AS double) AS CollisionEnergy FROM {part}""",
    "windows_flat": """
        SELECT p_partkey AS WindowGroup, p_size AS ScanNumBegin, cast(20 AS double) AS CollisionEnergy
        FROM {part}""",
    "rescored": """
        SELECT spectrum_id, peptide, charge, protein_list, q_value AS `mokapot q-value` FROM ({psm})""",
    "listed": """
        SELECT concat('run.', cast(o_custkey AS string), '.', cast(o_orderkey AS string)) AS spectrum_id,
          CASE WHEN o_orderkey % 2 = 0
            THEN concat('[''P', cast(o_custkey % 40 AS string), ''', ''Q', cast(o_custkey % 15 AS string), ''']')
            ELSE concat('[''Q', cast(o_custkey % 15 AS string), ''', ''P', cast(o_custkey % 40 AS string), ''']')
          END AS protein_list
        FROM {orders}""",
}


def spark_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, or a given one if the name is not among the derived."""
    if name not in SQL:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = SQL[name]
    inputs = {t: spark_table(spark, sf_dir, t) for t in re.findall(r"\{(\w+)\}", text)}
    return spark.sql(text.replace("({psm})", "{psm}"), **inputs)


def duck_sql(name: str) -> str:
    """The same table as a subquery for the other engine."""
    if name not in SQL:
        return name
    text = SQL[name].replace("`", '"').replace("({psm})", "{psm}")
    inputs = {t: duck_sql(t) for t in re.findall(r"\{(\w+)\}", text)}
    return "(" + text.format(**inputs) + ")"
