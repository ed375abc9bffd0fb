import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ionweave.operators import joins, matching, refinement
from ionweave.operators.refinement import filter_search_results, refine_edges, spectrum_lines


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("limit", [5, 10**9])
def test_spread_join_equals_join(spark, how, limit):
    left = spark.range(200).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    right = spark.range(0, 100, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    left = left.withColumn("k", F.col("k").cast("bigint"))
    want = rows(left.join(right, "k", how))
    assert rows(joins.spread_join(left, right, ["k"], how, limit).select(*left.join(right, "k", how).columns)) == want


def test_hot_keys_are_found_and_split(spark):
    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).cast("bigint").alias("k"), "id")
    hot = joins.hot_keys(left, ["k"], 1000)
    assert len(hot) == 1 and hot[0][1] >= 3
    spread = joins._split(joins._parts(left, ["k"], hot, "p"), left.columns, "p", "s")
    per_part = spread.where("k = 7").groupBy("s").count().toPandas()["count"]
    assert len(per_part) == hot[0][1] and per_part.max() < 1500


def test_both_sides_spread(spark):
    left = spark.range(60).select((F.col("id") % 2).alias("k"), F.col("id").alias("a"))
    right = spark.range(50).select((F.col("id") % 2).alias("k"), F.col("id").alias("b"))
    got = joins.spread_join(left, right, ["k"], rows_per_task=7, both=True)
    assert rows(got.select("a", "b")) == rows(left.join(right, "k").select("a", "b"))


def test_spread_join_refuses(spark):
    a, b = spark.range(1), spark.range(1).select(F.col("id").cast("int"))
    with pytest.raises(TypeError):
        joins.spread_join(a, b, ["id"])
    with pytest.raises(ValueError):
        joins.spread_join(a, a, ["id"], "full")


def test_lookup_takes_the_largest(spark):
    frag = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "d")], "psm_id bigint, f string")
    known = spark.createDataFrame([(1, 10), (1, 12), (2, 5), (9, 9)], "psm_id bigint, m bigint")
    got = joins.attach_lookup(frag, known, "psm_id", "m")
    assert {r["f"]: r["m"] for r in got.collect()} == {"a": 12, "b": 5, "c": None, "d": None}


def test_combine_tables(spark):
    a = spark.createDataFrame([(1, 1.0), (2, 2.0)], "ClusterID bigint, x double")
    b = spark.createDataFrame([(2, 20.0), (1, 10.0)], "ClusterID bigint, y double")
    assert rows(joins.combine_tables(a, b)) == [(1, 1.0, 10.0), (2, 2.0, 20.0)]
    with pytest.raises(ValueError, match="both"):
        joins.combine_tables(a, a)
    for wrong in (b.where("ClusterID = 1"), b.union(b)):
        with pytest.raises(ValueError, match="one row per key"):
            joins.combine_tables(a, wrong)


@pytest.mark.parametrize("small", [None, 100])
def test_edge_features(spark, small):
    ms1 = spark.createDataFrame([(1, 5.0), (2, 7.0)], "ClusterID bigint, mz double")
    ms2 = spark.createDataFrame([(8, 1.0), (9, 2.0)], "ClusterID bigint, mz double")
    edges = spark.createDataFrame([(1, 8, 1), (1, 9, 0), (2, 8, 1), (2, 8, 1)], "MS1_ClusterID bigint, MS2_ClusterID bigint, Y int")
    got = joins.edge_features(edges, ms1, ms2, ["mz"], broadcast_rows=small)
    assert got.columns == ["ms1_ClusterID", "ms1_mz", "ms2_ClusterID", "ms2_mz", "diff_mz", "Y"]
    assert rows(got) == [(1, 5.0, 8, 1.0, 4.0, 1), (1, 5.0, 9, 2.0, 3.0, 0)] + [(2, 7.0, 8, 1.0, 6.0, 1)] * 2
    lost = edges.union(spark.createDataFrame([(3, 8, 0)], edges.schema))
    with pytest.raises(PySparkException, match="edge without ms1 node: 3"):
        joins.edge_features(lost, ms1, ms2, ["mz"], broadcast_rows=small).collect()


def brute(left, right, extra=lambda a, b: True):
    return sorted(
        (a[0], b[0]) for a in left for b in right
        if a[1] <= b[2] and b[1] <= a[2] and a[1] <= a[2] and b[1] <= b[2] and extra(a, b)
    )


spans = st.lists(st.tuples(st.integers(-50, 50), st.sampled_from([0, 0, 1, 3, 9, 40, 700, -2])), max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(spans, spans, st.sampled_from([1.0, 4.0, 30.0]), st.sampled_from([3, 10**6]))
def test_range_match_equals_brute_force(spark, one, two, width, limit):
    left = [(i, lo, lo + n) for i, (lo, n) in enumerate(one)]
    right = [(i, lo, lo + n) for i, (lo, n) in enumerate(two)]
    a = spark.createDataFrame(left, "i bigint, a_lo bigint, a_hi bigint")
    b = spark.createDataFrame(right, "j bigint, b_lo bigint, b_hi bigint")
    axis = matching.Axis(("a_lo", "a_hi"), ("b_lo", "b_hi"), width)
    got = matching.match_ranges(a, b, [axis], rows_per_task=limit).select("i", "j")
    assert sorted(map(tuple, got.collect())) == brute(left, right)


def test_range_match_on_two_axes_with_hot_cell(spark):
    rng = np.random.default_rng(0)

    def table(n, p):
        x = np.where(np.arange(n) % 3 == 0, 10.0, rng.uniform(0, 300, n))
        y = np.where(np.arange(n) % 3 == 0, 5.0, rng.uniform(0, 50, n))
        w = rng.choice([0.0, 1.0, 5.0, 250.0], n, p=[0.3, 0.4, 0.28, 0.02])
        return pd.DataFrame({f"{p}": np.arange(n), f"{p}x0": x, f"{p}x1": x + w, f"{p}y0": y, f"{p}y1": y + w / 4})

    a, b = table(150, "a"), table(120, "b")
    axes = [matching.Axis(("ax0", "ax1"), ("bx0", "bx1"), 2), matching.Axis(("ay0", "ay1"), ("by0", "by1"), 1)]
    df = matching.match_ranges(
        spark.createDataFrame(a), spark.createDataFrame(b), axes, residual=F.col("a") != F.col("b"), rows_per_task=20
    )
    joined = a.merge(b, how="cross").query(
        "ax0 <= bx1 and bx0 <= ax1 and ay0 <= by1 and by0 <= ay1 and a != b"
    )
    assert sorted(map(tuple, df.select("a", "b").collect())) == sorted(map(tuple, joined[["a", "b"]].values.tolist()))


def test_long_range_adds_one_level(spark):
    """One very long range costs every row of the other side one copy, not one per level."""
    a = spark.range(200).selectExpr("id AS i", "id AS a_lo", "id + 1 AS a_hi").union(spark.createDataFrame([(999, 0, 10**9)], "i long, a_lo long, a_hi long"))
    b = spark.range(200).selectExpr("id AS j", "id AS b_lo", "id + 1 AS b_hi")
    axes = [matching.Axis(("a_lo", "a_hi"), ("b_lo", "b_hi"), 4)]
    left, right = matching._ends(a, axes, "left", []), matching._ends(b, axes, "right", [])
    assert matching._levels(right, axes) == [[0]] and len(matching._levels(left, axes)[0]) == 2
    assert matching._cells(right, axes, matching._levels(left, axes), []).count() <= 2 * 2 * 200
    got = matching.match_ranges(a, b, axes)
    assert got.where("i = 999").count() == 200 and got.where("i <> 999").count() == 598


@pytest.mark.parametrize("shape", ["points", "one axis", "spread"])
def test_crowded_cell_is_split(spark, shape):
    """A third of all rows in one cell: parts stay small, and the pairs are those of brute force."""
    rng = np.random.default_rng(2)
    n = 3_000

    def table(p):
        x = np.where(np.arange(n) % 3 == 0, rng.uniform(0, 1, n) if shape == "spread" else 0.5, rng.uniform(0, 3_000, n))
        y = rng.uniform(0, 1, n) if shape != "points" else np.zeros(n)
        w = 0.001
        return pd.DataFrame({f"{p}": np.arange(n), f"{p}x0": x, f"{p}x1": x + w, f"{p}y0": y, f"{p}y1": y + w})

    a, b = table("a"), table("b")
    axes = [matching.Axis(("ax0", "ax1"), ("bx0", "bx1"), 1), matching.Axis(("ay0", "ay1"), ("by0", "by1"), 1)]
    got = matching.match_ranges(spark.createDataFrame(a), spark.createDataFrame(b), axes, rows_per_task=200).select("a", "b")
    ax, bx, ay, by = (t[c].to_numpy() for t, c in ((a, "ax0"), (b, "bx0"), (a, "ay0"), (b, "by0")))
    near = (np.abs(ax[:, None] - bx[None, :]) <= 0.001) & (np.abs(ay[:, None] - by[None, :]) <= 0.001)
    sure = (np.abs(np.abs(ax[:, None] - bx[None, :]) - 0.001) > 1e-9) & (np.abs(np.abs(ay[:, None] - by[None, :]) - 0.001) > 1e-9)
    assert sure.all()
    pairs = got.toPandas()
    assert len(pairs) == near.sum() and near[pairs["a"], pairs["b"]].all() and not pairs.duplicated().any()


def test_parts_of_a_crowded_cell_are_small(spark):
    rows = spark.range(20_000).select(F.col("id").alias("i"), (F.rand(3) * F.rand(4)).alias("a_lo")).withColumn("a_hi", F.col("a_lo") + 1e-5)
    other = spark.range(20_000).select(F.col("id").alias("j"), (F.rand(5) * F.rand(6)).alias("b_lo")).withColumn("b_hi", F.col("b_lo") + 1e-5)
    axes = [matching.Axis(("a_lo", "a_hi"), ("b_lo", "b_hi"), 1.0)]
    a, b = matching._ends(rows, axes, "left", []), matching._ends(other, axes, "right", [])
    a, b = matching._cells(a, axes, [[0]], []), matching._cells(b, axes, [[0]], [])
    bit = 2
    while not (crowded := matching._crowded(a, b, 500)).isEmpty():
        cuts = matching._cuts(a, b, crowded, 1)
        assert not cuts.isEmpty() and bit < 8
        a, b = (matching._split(s, cuts, 1, bit) for s in (a, b))
        bit += 1
    assert a.count() < 1.2 * 20_000  # few copies


def test_sweep_lists_what_overlaps():
    rng = np.random.default_rng(1)
    for k in range(40):
        n = int(rng.integers(1, 60))
        cell = np.sort(rng.integers(0, 4, n))
        _, cell = np.unique(cell, return_inverse=True)
        lo = [rng.integers(0, 12, n).astype(float) for _ in range(2)]
        hi = [x + rng.integers(0, 5, n) for x in lo]
        is_left = rng.random(n) < 0.5
        got = sorted(p for one, other in matching._Sweep(cell, lo, hi, is_left).pairs() for p in zip(one.tolist(), other.tolist()))
        want = [
            (i, j) for i in range(n) for j in range(n)
            if is_left[i] and not is_left[j] and cell[i] == cell[j] and all(lo[x][i] <= hi[x][j] and lo[x][j] <= hi[x][i] for x in (0, 1))
        ]
        assert got == want


def test_range_match_is_an_equi_join(spark, plan):
    a = spark.range(1000).selectExpr("id AS i", "id AS a_lo", "id + 3 AS a_hi")
    b = spark.range(1000).selectExpr("id AS j", "id AS b_lo", "id + 3 AS b_hi")
    text = plan(matching.match_ranges(a, b, [matching.Axis(("a_lo", "a_hi"), ("b_lo", "b_hi"), 4)]))
    assert "NestedLoop" not in text and "Cartesian" not in text
    far = b.withColumn("b_hi", F.lit(float("inf")))
    with pytest.raises(ValueError, match="finite"):
        matching.match_ranges(a, far, [matching.Axis(("a_lo", "a_hi"), ("b_lo", "b_hi"), 4)])
    with pytest.raises(ValueError, match="rename"):
        matching.match_ranges(a, a, [])


def test_sweep_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    n, m = 400, 300
    pts = pd.DataFrame({"g": np.where(np.arange(n) % 3 == 0, 1, rng.integers(0, 9, n)), "p": np.arange(n), "value": rng.integers(0, 60, n).astype(float)})
    rgs = pd.DataFrame({"g": np.where(np.arange(m) % 3 == 0, 1, rng.integers(0, 9, m)), "r": np.arange(m), "lo": rng.integers(0, 60, m).astype(float)})
    rgs["hi"] = rgs.lo + rng.integers(-1, 8, m)
    by_range, by_point = matching.sweep(spark.createDataFrame(pts), spark.createDataFrame(rgs), "g", ["p"], ["r"])
    pairs = pts.merge(rgs, on="g").query("lo <= value and value <= hi")
    want = pairs.groupby("r").value.agg(["size", "sum"])
    for row in by_range.collect():
        size, total = (want.loc[row["r"]] if row["r"] in want.index else (0, 0))
        assert row["n_points"] == size and float(row["sum_points"]) == total
    assert by_range.count() == (rgs.lo <= rgs.hi).sum()
    per_point = pairs.groupby("p").size()
    assert {r["p"]: r["n_ranges"] for r in by_point.collect()} == {p: per_point.get(p, 0) for p in pts.p}


def test_map_back(spark):
    psms = spark.createDataFrame([(1, 100), (2, 200)], "psm_id bigint, MS1_ClusterID bigint")
    frags = spark.createDataFrame([(1, 0, 500.0), (1, 1, 900.0), (2, 0, 500.0), (3, 0, 500.0)], "psm_id bigint, n int, mz double")
    nodes = spark.createDataFrame([(7, 500.001), (8, 700.0), (9, 900.0)], "ClusterID bigint, mz_wmean double")
    edges = spark.createDataFrame([(100, 7), (100, 8), (200, 9), (300, 7)], "MS1_ClusterID bigint, MS2_ClusterID bigint")
    out = matching.map_back(psms, frags, nodes, edges, 1e-5, ["n"], fragment_mz="mz")
    assert rows(out["edges"]) == [(100, 7, 1, 500.0)]
    assert rows(out["fragments"]) == [(1, 0, 500.0, 100)]
    assert rows(out["precursors"]) == [(1, 100)]


def test_refinement_keeps_what_was_found(spark):
    edges = spark.createDataFrame([(1, 1), (2, 1), (1, 2), (3, 3)], "MS1_ClusterID bigint, MS2_ClusterID bigint")
    found = edges.where("MS1_ClusterID = 1 AND MS2_ClusterID = 1")
    out = refine_edges(edges, found.union(found))
    assert rows(out["edges"]) == [(1, 1), (1, 2), (3, 3)]
    assert out["counts"].first().asDict() == {"total": 4, "positive": 1, "kept": 3}
    nothing = refine_edges(edges, found.limit(0))
    assert nothing["edges"].count() == 4
    hot = refine_edges(edges, found, rows_per_task=1)
    assert rows(hot["edges"]) == [(1, 1), (1, 2), (3, 3)]


def test_search_filter(spark):
    psms = spark.createDataFrame(
        [(1, 0.001, "P1"), (2, 0.01, "P1"), (3, 0.001, "rev_P1,P2"), (4, None, "P1"), (5, 0.001, None), (6, 0.0, "revXP")],
        "psm_id bigint, q double, protein_list string",
    )
    frags = spark.createDataFrame([(1, 1.0), (1, 2.0), (3, 1.0)], "psm_id bigint, mz double")
    kept, mine = filter_search_results(psms, frags, q_column="q")
    assert [r["psm_id"] for r in kept.collect()] == [1]  # an underscore in LIKE is any character
    assert mine.count() == 2


def test_spectrum_lines_order(spark):
    ms1 = spark.createDataFrame([(1, 400.5, 12.0, 2), (2, 1.0, 1.0, 1)], "ClusterID bigint, mz double, rt double, z int")
    ms2 = spark.createDataFrame([(5, 300.0, 7.0), (6, 100.25, 9.0), (7, 100.25, 3.0)], "ClusterID bigint, mz_wmean double, intensity_sum double")
    edges = spark.createDataFrame([(1, 5), (1, 6), (1, 7)], "MS1_ClusterID bigint, MS2_ClusterID bigint")
    out = spectrum_lines(ms1, ms2, edges, {"PEPMASS": "mz", "RTINSECONDS": "rt", "CHARGE": "z"})
    text = "\n".join(r["line"] for r in out.orderBy("MS1_ClusterID", "section", "mz", "intensity", "MS2_ClusterID").collect())
    assert text == (
        "BEGIN IONS\nTITLE=spectrum.1\nPEPMASS=400.5000\nRTINSECONDS=12.0000\nCHARGE=2\n"
        "100.2500 3.0000\n100.2500 9.0000\n300.0000 7.0000\nEND IONS"
    )


def test_all_hot_keys_are_found(spark):
    many = spark.range(300_000).select((F.col("id") % 500).alias("k"))
    assert len(joins.hot_keys(many, ["k"], 500)) == 500
    one = spark.range(300_000).select(F.lit(7).alias("k"))
    assert [n for _, n in joins.hot_keys(one, ["k"], 100_000)] == [3]


def test_presence_in_many_tables(spark):
    from ionweave.operators.membership import presence

    tables = {f"t{i}": spark.createDataFrame([(i,), (1000,)], "k long") for i in range(130)}
    found = {r["k"]: [i for i in range(130) if r[f"t{i}"]] for r in presence(tables, ["k"]).collect()}
    assert found == {i: [i] for i in range(130)} | {1000: list(range(130))}


def test_flags_of_edges_with_hot_null_and_repeated_keys(spark, plan):
    """One pass in packed pieces, whatever the spread; before, all edges went through two joins."""
    rng = np.random.default_rng(5)
    pairs = [(int(rng.integers(0, 40)), 7 if i % 3 == 0 else int(rng.integers(0, 30))) for i in range(600)]
    pairs += [(None, 7), (3, None), (None, None), (3, 29), (3, 29)]
    edges = spark.createDataFrame([(a, b, str(i)) for i, (a, b) in enumerate(pairs)], "MS1_ClusterID long, MS2_ClusterID long, note string")
    chosen = [(a, 7) for a in range(0, 40, 9)] + [(3, 29), (3, 29), (999, 4), (None, 5), (None, None)]
    found = spark.createDataFrame(chosen, "MS1_ClusterID long, MS2_ClusterID long")
    known = {p for p in chosen if None not in p}
    explained = {b for _, b in known}
    want = sorted((str(i), p in known, p in known or p[1] not in explained) for i, p in enumerate(pairs))
    for limit in (10**9, 20):
        out = refinement.flag_edges(edges, found, rows_per_task=limit)
        assert out.columns == [*edges.columns, "is_found", "is_kept"]
        assert sorted(map(tuple, out.select("note", "is_found", "is_kept").collect())) == want
    assert "Join" not in plan(refinement.flag_edges(edges, found))


@pytest.mark.parametrize("limit", [10**9, 30])
def test_map_back_sorts_fragments_only(spark, monkeypatch, limit):
    """Windows are looked up; before, both ends of every window were sorted with the fragments.  Repeats count as they did."""
    rng = np.random.default_rng(6)
    psms = pd.DataFrame({"psm_id": np.arange(60), "MS1_ClusterID": np.where(np.arange(60) % 3 == 0, 1, np.arange(60) % 11)})
    frags = pd.DataFrame({"psm_id": rng.integers(0, 80, 300), "n": np.arange(300), "mz": rng.integers(90, 400, 300).astype(float)})
    nodes = pd.DataFrame({"ClusterID": np.arange(50), "mz_wmean": rng.integers(80, 420, 50).astype(float)})
    nodes.loc[0, "mz_wmean"], nodes.loc[1, "mz_wmean"] = -5.0, 0.0
    edges = pd.DataFrame({"MS1_ClusterID": rng.integers(0, 14, 400), "MS2_ClusterID": np.where(np.arange(400) % 3 == 0, 9, rng.integers(0, 55, 400))})
    sorted_rows, plain = [], matching.slices
    monkeypatch.setattr(matching, "slices", lambda df, *a, **k: sorted_rows.append(df.count()) or plain(df, *a, **k))
    out = matching.map_back(
        spark.createDataFrame(psms), spark.createDataFrame(frags), spark.createDataFrame(nodes), spark.createDataFrame(edges), 0.02, ["n"],
        fragment_mz="mz", rows_per_task=limit,
    )
    owned = frags.merge(psms, on="psm_id")
    assert sorted_rows == [len(owned)]
    met = edges.drop_duplicates().merge(nodes, left_on="MS2_ClusterID", right_on="ClusterID").merge(owned, on="MS1_ClusterID")
    met = met[(met.mz >= met.mz_wmean - met.mz_wmean * 0.02) & (met.mz <= met.mz_wmean + met.mz_wmean * 0.02)]
    want = met.groupby(["MS1_ClusterID", "MS2_ClusterID"]).mz.agg(["size", "sum"]).reset_index()
    assert rows(out["edges"]) == sorted(((int(a), int(b), int(n), s / n) for a, b, n, s in want.values.tolist()), key=str)
    assert out["fragments"].count() == met.n.nunique() and out["precursors"].count() == met.psm_id.nunique()


def test_sweep_over_few_rows(spark):
    """No points, no ranges, text keys, NaN, infinite ends, and ranges over many slices."""
    empty = matching.sweep(spark.createDataFrame([], "g long, p long, value double"), spark.createDataFrame([(1, 1, 0.0, 1.0)], "g long, r long, lo double, hi double"), "g", ["p"], ["r"])
    assert rows(empty[0]) == [(1, 1, 0, 0.0)] and empty[1].count() == 0
    pts = [("a", i, float(i)) for i in range(40)] + [("b", 90, float("nan")), ("b", 91, 2.0), ("b", 92, float("inf")), (None, 93, 1.0)]
    rgs = [("a", 0, -1.0, 100.0), ("a", 1, 3.0, 30.0), ("a", 2, 50.0, 60.0), ("b", 3, 1.0, float("inf")), ("b", 4, 0.0, float("nan")), ("b", 5, 2.0, 2.0), ("c", 6, 0.0, 9.0), ("a", 7, 9.0, 8.0)]
    by_range, by_point = matching.sweep(
        spark.createDataFrame(pts, "g string, p long, value double"), spark.createDataFrame(rgs, "g string, r long, lo double, hi double"), "g", ["p"], ["r"]
    )
    got = {r["r"]: (r["n_points"], str(r["sum_points"])) for r in by_range.collect()}
    assert got == {0: (40, "780.0"), 1: (28, "462.0"), 2: (0, "0.0"), 3: (2, "nan"), 4: (3, "nan"), 5: (1, "2.0"), 6: (0, "0.0")}
    inside = {r["p"]: r["n_ranges"] for r in by_point.collect()}
    assert inside == {i: 1 + (3 <= i <= 30) for i in range(40)} | {90: 1, 91: 3, 92: 2}
