import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ionweave.functions import numeric, text
from ionweave.functions.documents import checked_json
from ionweave.operators import calibration, filters, membership, sampling, summaries
from ionweave.operators.compliance import compliance_report


def one(df):
    return df.first()


def test_cluster_id(spark):
    df = spark.createDataFrame([("a.12.x",), ("b.007",)], "h string")
    assert [r[0] for r in df.select(text.cluster_id(F.col("h"))).collect()] == [12, 7]
    bad = spark.createDataFrame([("nothing",), ("a.b.c",)], "h string")
    assert [r[0] for r in bad.select(text.cluster_id(F.col("h"), "null")).collect()] == [None, None]
    for h in ("nothing", "a.b.c"):
        with pytest.raises(PySparkException):
            bad.where(F.col("h") == h).select(text.cluster_id(F.col("h"))).collect()
    with pytest.raises(ValueError):
        text.cluster_id(F.col("h"), "skip")


def test_text_columns(spark):
    df = spark.createDataFrame(
        [("[+1.0]AB[+79.9663]C", "a,b,,", "['b', 'a']"), ("79x9663", "x", "['z']"), (None, None, None)],
        "p string, c string, l string",
    )
    rows = df.select(
        text.strip_modifications(F.col("p")),
        F.size(text.comma_members(F.col("c"))),
        text.protein_group(F.col("l")),
        text.contains_pattern(F.col("p"), text.PHOSPHO_PATTERN),
    ).collect()
    assert tuple(rows[0]) == ("ABC", 4, ["a", "b"], True)
    assert tuple(rows[1]) == ("79x9663", 1, ["z"], True)  # the pattern is a regex
    assert rows[2][3] is False


def test_rounding_follows_numpy(spark):
    values = [0.00015, 0.00025, -1.23455, 2.5, 1e6 / 7, 0.00005]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(numeric.round_half_even(F.col("v"))).collect()]
    assert got == [float(np.round(np.float64(v), 4)) for v in values]
    grid = [r[0] for r in df.select(numeric.dyadic(F.col("v"))).collect()]
    assert grid == [math.floor(v * 2**13) * 2.0**-13 for v in values]


def test_edge_counts_count_null_once(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, 2)], "MS1_ClusterID bigint, MS2_ClusterID bigint")
    assert one(summaries.edge_counts(df)).asDict() == {"MS1_ClusterID": 2, "MS2_ClusterID": 2, "edges": 3}
    empty = one(summaries.edge_counts(df.limit(0))).asDict()
    assert empty == {"MS1_ClusterID": 0, "MS2_ClusterID": 0, "edges": 0}


def test_psm_stats_by_hand(spark):
    df = spark.createDataFrame(
        [
            ("r.1.a", "AB[+79.9663]", 2, "P1,P2"),
            ("r.1.b", "AB", 2, "P2,P1"),
            ("r.2.a", "AB", None, "P1,P2"),
            ("r.3.a", "AB", None, "P3,"),
            ("r.3.a", "79-9663", 3, "P3"),
        ],
        "spectrum_id string, peptide string, charge int, protein_list string",
    )
    assert one(summaries.psm_stats(df)).asDict() == {
        "proteins_in_protein_groups": 4,  # P1, P2, P3 and the empty name
        "protein_groups": 4,
        "peptide_sequences_stripped_of_mods": 2,
        "peptides_with_mods": 3,
        "charged_peptides_with_mods": 4,
        "phosphopeptides": 2,
        "MS1_ClusterID": 3,
    }
    assert set(one(summaries.psm_stats(df.limit(0)))) == {0}


def test_protein_groups_ignore_order(spark):
    df = spark.createDataFrame([("['a', 'b']",), ("['b', 'a']",), ("['c']",)], "protein_list string")
    assert tuple(one(summaries.protein_group_stats(df))) == (3, 2, False)
    assert tuple(one(summaries.protein_group_stats(df.where("protein_list <> \"['b', 'a']\"")))) == (3, 2, True)


def test_summary_with_nulls_and_kinds(spark):
    df = spark.createDataFrame([(1, 2.5, "x"), (None, 2.5, "y"), (2**60, None, "z")], "i bigint, d double, s string")
    got = {r["column"]: tuple(r)[1:] for r in summaries.summarize_table(df).collect()}
    assert got["i"][:3] == (3, 1, 2) and got["i"][4] == float(2**60)
    assert got["d"] == (3, 1, 1, 2.5, 2.5, 2.5)
    assert set(got) == {"i", "d"}
    huge = summaries.summarize_table(spark.createDataFrame([(1e300,), (1.0,), (None,)], "d double"))
    assert tuple(one(huge))[1:] == (3, 1, 2, 1.0, 1e300, 5e299)
    with pytest.raises(ValueError):
        summaries.summarize_table(df.select("s"))


def test_cluster_stats_do_not_depend_on_order(spark):
    df = spark.range(2000).selectExpr("id % 7 AS ClusterID", "id * 0.1 AS mz", "id % 13 + 1 AS intensity")
    stats = lambda d: sorted(map(tuple, summaries.cluster_stats(d, {"mz": "mz"}).collect()))
    assert stats(df) == stats(df.orderBy(F.rand(3)))


def test_means_keep_all_digits(spark):
    points = [(1, 500.00004, 1.0), (1, 500.00004, 7.0), (2, 3.0, 1e-5), (2, 5.0, 3e-5), (3, None, 1.0), (3, None, None)]
    df = spark.createDataFrame(points, "ClusterID long, mz double, intensity double")
    got = {r["ClusterID"]: r for r in summaries.cluster_stats(df, {"mz": "mz"}).collect()}
    assert got[1]["mz_wmean"] == 500.00004 and got[1]["intensity_sum"] == 8.0 and got[1]["size"] == 2
    assert got[2]["mz_wmean"] == pytest.approx(4.5, rel=1e-15)
    assert (got[3]["mz_wmean"], got[3]["mz_min"], got[3]["intensity_sum"]) == (None, None, 1.0)


def test_means_of_values_of_all_sizes(spark):
    rng = np.random.default_rng(2)
    wide = [float(x) for x in rng.normal(size=500) * 10.0 ** rng.integers(-300, 290, 500)]
    columns = {
        "small": [1e-5, 3e-5], "wide": wide, "cancel": [1e300, 1.0, -1e300, 0.0], "least": [5e-324, 5e-324, None],
        "none": [None, None], "endless": [float("inf"), 1.0], "mixed": [float("inf"), -float("inf")],
    }
    for name, values in columns.items():
        df = spark.createDataFrame([(v,) for v in values], "d double")
        row = one(summaries.summarize_table(df))
        present = [v for v in values if v is not None]
        assert row["n"] == len(values) and row["n_null"] == len(values) - len(present)
        if name == "none":
            assert row["mean"] is None
        elif name in ("endless", "mixed"):
            assert str(row["mean"]) == ("inf" if name == "endless" else "nan")
        else:
            assert row["mean"] == pytest.approx(math.fsum(present) / len(present), rel=1e-14, abs=0), name
            assert one(summaries.summarize_table(df.orderBy(F.rand(3))))["mean"] == row["mean"]


def test_histograms_leave_out_nulls(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.9, 1.0), (-0.1, None)], "x double, y double")
    got = sorted(map(tuple, summaries.marginal_histograms(df, {"x": (0, 1), "y": (0, 1)}).collect()))
    assert got == [("x", -1, 1), ("x", 0, 2), ("y", 1, 2)]
    assert sorted(map(tuple, summaries.histogram_2d(df, ("x", 0, 1), ("y", 0, 1)).collect())) == [(0, 1, 2)]


def test_presence_sums_to_the_union(spark):
    tables = {
        "a": spark.createDataFrame([(1, "x"), (1, "x"), (None, "n")], "k int, v string"),
        "b": spark.createDataFrame([(1, "x"), (2, "y"), (None, "n")], "k int, v string"),
        "c": spark.createDataFrame([], "k int, v string"),
    }
    flags = membership.presence(tables, ["k", "v"])
    assert flags.count() == 3
    counts = {tuple(r)[:3]: r["count"] for r in membership.presence_counts(tables, ["k", "v"]).collect()}
    assert counts == {(True, True, False): 2, (False, True, False): 1}
    only_b = membership.keys_in_pattern(flags, {"b": True, "a": False}, ["k"])
    assert [r["k"] for r in only_b.collect()] == [2]
    with pytest.raises(ValueError):
        membership.named_tables([tables["a"], tables["b"]], ["a", "a"])
    with pytest.raises(ValueError):
        membership.named_tables([tables["a"]], ["a", "b"])


def test_compliance(spark):
    schema = "WindowGroup int, CollisionEnergy double"
    a = spark.createDataFrame([(1, 20.0), (1, 25.0), (2, 30.0)], schema)
    flat = spark.createDataFrame([(1, 20.0), (1, 20.0), (2, 20.0)], schema)
    assert tuple(one(compliance_report(a, flat))) == (20.0, 20.0, True, True, True)
    nulls = spark.createDataFrame([(1, 20.0), (1, None), (2, 20.0)], schema)
    assert not one(compliance_report(a, nulls))["constant_collision_energy"]
    fewer = compliance_report(a, flat.distinct())
    assert not one(fewer)["schemes_agree"]  # repeats count
    other = flat.withColumnRenamed("WindowGroup", "Group")
    assert not one(compliance_report(a, other))["schemes_agree"]
    with pytest.raises(ValueError, match="different"):
        compliance_report(a, flat.distinct(), strict=True)
    with pytest.raises(ValueError, match="below"):
        compliance_report(a, flat.withColumn("CollisionEnergy", F.lit(20.5)), strict=True)
    with pytest.raises(PySparkException, match="empty"):
        compliance_report(a, flat.limit(0)).collect()


def test_draws_are_exact_and_repeatable(spark):
    df = spark.range(40).selectExpr("id AS MS1_ClusterID", "id * 2 AS MS2_ClusterID", "cast(id % 2 AS int) AS Y")
    draw = lambda seed: sorted(map(tuple, sampling.draw_per_class(df, 100, seed).collect()))
    first = draw(1)
    assert len(first) == 200 and sum(r[2] for r in first) == 100
    assert first == draw(1) != draw(2)
    assert len(set(first)) < 200  # with replacement
    with pytest.raises(ValueError):
        sampling.draw_per_class(df.where("id <> 0".replace("id", "MS1_ClusterID")), 5)
    with pytest.raises(ValueError):
        sampling.draw_per_class(df.limit(0), 5)


def test_interpolation_follows_numpy(spark):
    x = [0.0, 0.1, 0.1, 0.5, 0.9]
    y = [-3.0, -1.0, 0.5, 2.0, 7.0]
    knots = spark.createDataFrame(list(zip(x, y, [v * 2 for v in y])), "probability double, ms1 double, ms2 double")
    q = [0.0, 0.05, 0.1, 0.3, 0.77, 0.9, 1.0]
    got = {r["probability"]: (r["ms1"], r["ms2"]) for r in calibration.interpolate(knots.repartition(3), q).collect()}
    for p in q:
        assert got[p] == (np.interp(p, x, y), np.interp(p, x, [v * 2 for v in y]))


def test_quantile_arguments():
    assert calibration.probability("m", 25) == 0.025
    for tag, value in (("c", 101), ("d", -1), ("x", 1)):
        with pytest.raises(ValueError):
            calibration.probability(tag, value)
    with pytest.raises(ValueError, match="not below"):
        calibration.tolerances(None, ("d", 5), ("c", 50))


def test_config_keeps_other_fields(spark):
    import json

    limits = spark.createDataFrame([(-1.0, 1.5, -2.0, 2.25)], "ms1_lo double, ms1_hi double, ms2_lo double, ms2_hi double")
    config = {"a": {"b": None, "c": [1, 2]}, "precursor_tol": {"ppm": [-9.0, 9.0], "k": 1}, "fragment_tol": {"ppm": [0.0, 1.0]}}
    got = json.loads(one(calibration.updated_configs(limits, config))["config"])
    config["precursor_tol"]["ppm"], config["fragment_tol"]["ppm"] = [-1.0, 1.5], [-2.0, 2.25]
    assert got == config


def test_batched_filter_checks(spark):
    edges = spark.range(20).selectExpr("id AS MS1_ClusterID", "id AS MS2_ClusterID", "id % 5 AS s")
    kept = filters.filter_edges_batched(
        edges,
        "SELECT * FROM (SELECT *, max(s) OVER (PARTITION BY batch_id) AS top FROM {local_edges}) WHERE s = top",
        batch_size=4,
    )
    assert sorted(r["original_idx"] for r in kept.collect()) == [3, 4, 9, 14, 19]
    with pytest.raises(ValueError, match="dropped"):
        filters.filter_edges_batched(edges, "SELECT MS1_ClusterID FROM {local_edges}", 4)
    with pytest.raises(ValueError, match="repeats"):
        filters.filter_edges_batched(edges, "SELECT * FROM {local_edges} UNION ALL SELECT * FROM {local_edges}", 4)
    with pytest.raises(PySparkException, match="same MS1_ClusterID"):
        filters.filter_edges(edges.union(edges), "s > 1").collect()


def test_batched_filter_runs_the_sql_on_each_batch(spark, monkeypatch):
    scores = [1, 2, 3, 4, 5, 60, 70, 80, 90, 100]
    edges = spark.createDataFrame([(i, i, s) for i, s in enumerate(scores)], "MS1_ClusterID long, MS2_ClusterID long, s long")
    sql = "SELECT * FROM {local_edges} WHERE s > (SELECT avg(s) FROM {local_edges})"
    kept = sorted(r["s"] for r in filters.filter_edges_batched(edges, sql, 5).collect())
    assert kept == [4, 5, 90, 100]
    monkeypatch.setattr(filters, "BATCHES_PER_JOB", 1)
    assert sorted(r["s"] for r in filters.filter_edges_batched(edges, sql, 5).collect()) == kept
    assert filters.filter_edges_batched(edges.limit(0), sql, 5).count() == 0


def test_batched_filter_is_one_query_over_all_batches(spark, monkeypatch):
    """Per-batch subqueries and windows need no query per batch; other SQL still runs on each batch."""
    edges = spark.range(60).selectExpr("id AS MS1_ClusterID", "id AS MS2_ClusterID", "IF(id % 11 = 3, NULL, id * 7 % 13) AS s")
    calls, plain = [], filters.query_tables
    monkeypatch.setattr(filters, "query_tables", lambda sql, **t: calls.append(sql) or plain(sql, **t))
    value = {i: None if i % 11 == 3 else i * 7 % 13 for i in range(60)}
    batches = [[i for i in range(60) if i // 4 == b] for b in range(15)]
    known = [[value[i] for i in ids if value[i] is not None] for ids in batches]

    def kept(sql):
        calls.clear()
        return sorted(r["original_idx"] for r in filters.filter_edges_batched(edges, sql, 4).collect())

    le = "{local_edges}"
    mean = [i for ids, v in zip(batches, known) for i in ids if value[i] is not None and value[i] > sum(v) / len(v)]
    assert kept(f"SELECT * FROM {le} WHERE s > (SELECT avg(s) FROM {le})") == mean and len(calls) <= 2
    rare = [i for ids, v in zip(batches, known) for i in ids if sum(x > 9 for x in v) == 0]
    assert kept(f"SELECT * FROM '{le}' WHERE (SELECT count(*) FROM {le} WHERE s > 9) = 0") == rare and len(calls) <= 2
    top = [i for ids, v in zip(batches, known) for i in ids if value[i] == max(v)]
    assert kept(f"SELECT * FROM (SELECT *, max(s) OVER () AS top FROM {le}) WHERE s = top") == top and len(calls) > 15
    assert kept(f"SELECT max(original_idx) AS original_idx FROM {le}") == [ids[-1] for ids in batches]
    shared = f"WITH t AS (SELECT max(s) AS m FROM {le}) SELECT * FROM {le} WHERE s = (SELECT m FROM t)"
    assert kept(shared) == top


def test_filter_is_pushed_to_the_scan(spark, plan, tmp_path):
    path = f"file:{tmp_path}/t"
    spark.range(100).selectExpr("id", "id / 1000 AS q", "'P' AS protein_list", "id AS unused").write.parquet(path)
    df = filters.confident_targets(spark.read.parquet(path), q_column="q").select("id")
    text = plan(df)
    assert "LessThan(q" in text and "unused" not in text


def test_sql_with_quoted_names(spark):
    df = spark.range(5)
    assert filters.query_tables("SELECT * FROM '{t}' WHERE id > 2", t=df).count() == 2


def test_json_check(spark):
    df = spark.createDataFrame([('{"a": 1}',), ("nope{",)], "t string")
    assert df.where("t like '{%'").select(checked_json(F.col("t"))).first()[0] == '{"a": 1}'
    with pytest.raises(PySparkException, match="not a JSON"):
        df.select(checked_json(F.col("t"))).collect()
