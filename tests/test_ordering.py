import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ionweave.operators import ordering
from ionweave.operators.refinement import fragment_ranks
from ionweave.staging import stage


def hot_edges(spark, n=3000, seed=1):
    """Unique edges, a third of them with the same MS1 id."""
    rng = np.random.default_rng(seed)
    a = np.where(np.arange(n) % 3 == 0, 500, rng.integers(0, 1000, n))
    pdf = pd.DataFrame({"a": a, "b": rng.permutation(n), "s": rng.integers(0, 20, n).astype(float)})
    return spark.createDataFrame(pdf).repartition(5), pdf


def test_row_index_and_balance(spark):
    df, pdf = hot_edges(spark)
    out = ordering.with_row_index(df, ["a", "b"])
    got = out.orderBy("original_idx").toPandas()
    want = pdf.sort_values(["a", "b"]).reset_index(drop=True)
    assert (got[["a", "b"]].values == want[["a", "b"]].values).all()
    assert (got.original_idx == np.arange(len(pdf))).all()
    sizes = ordering.slices(df, ["a", "b"]).groupBy("_slice").count().toPandas()["count"]
    assert len(sizes) == 8 and sizes.max() < 2 * len(pdf) / 8  # the hot key is split


def test_row_index_per_group(spark):
    df, pdf = hot_edges(spark)
    got = ordering.with_row_index(df, ["b"], by=["a"], name="i", size_name="n").toPandas().sort_values("b")
    want = pdf.sort_values("b")
    assert (got.i.values == want.groupby("a").cumcount().sort_index().reindex(want.index).values).all()
    assert (got.n.values == want.groupby("a").b.transform("size").values).all()


def test_row_index_rejects_equal_keys_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "k int, v string")
    with pytest.raises(PySparkException, match="same k"):
        ordering.with_row_index(df, ["k"]).collect()
    out = ordering.with_row_index(df, ["k"], unique=False).toPandas()
    assert sorted(out.original_idx) == [0, 1, 2] and out[out.v == "z"].original_idx.item() == 2


def test_row_index_of_nothing(spark):
    df = spark.createDataFrame([], "k int")
    assert ordering.with_row_index(df, ["k"]).count() == 0
    row = ordering.check_sorted(df, ["k"], ["k"]).first()
    assert row["is_sorted"] and row["n_violations"] == 0 and row["first_violation_idx"] is None


def test_index_plan_has_no_single_task_window(spark, plan):
    df, _ = hot_edges(spark)
    text = plan(ordering.with_row_index(df, ["a", "b"]))
    # the only unpartitioned window runs on one row per slice, above the per-slice aggregate
    window = text[text.index("Window"):]
    assert "HashAggregate(keys=[_slice" in window
    assert text.count("Window [") == 1


@pytest.mark.parametrize("block", [3, 7, 1 << 20])
def test_planted_faults_are_found(spark, block):
    keys = list(range(0, 200, 2))
    for at in (7, 21, 63):
        keys[at] = keys[at - 1]  # equal to its predecessor
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i bigint, k int").repartition(4)
    row = ordering.check_sorted(df, ["k"], ["i"], block_rows=block).first()
    assert (row["is_sorted"], row["n_violations"], row["first_violation_idx"]) == (False, 3, 7)
    loose = ordering.check_sorted(df, ["k"], ["i"], strict=False, block_rows=block).first()
    assert loose["is_sorted"]
    with pytest.raises(ValueError, match="3 violations"):
        ordering.require_sorted(ordering.check_increasing(df, "k", ["i"], block), "keys")


def test_shuffled_table_against_pandas(spark):
    rng = np.random.default_rng(3)
    k1, k2 = rng.integers(0, 4, 500), rng.integers(0, 5, 500)
    df = spark.createDataFrame(pd.DataFrame({"i": np.arange(500) * 3, "k1": k1, "k2": k2}))
    pairs = list(zip(k1, k2))
    bad = [i for i in range(1, 500) if pairs[i] <= pairs[i - 1]]
    row = ordering.check_sorted(df, ["k1", "k2"], ["i"], block_rows=16).first()
    assert row["n_violations"] == len(bad) and row["first_violation_idx"] == bad[0] * 3


def test_stored_files_are_checked_by_place(spark):
    df = spark.range(1000).repartitionByRange(4, "id").sortWithinPartitions("id")
    stored = stage(df)
    placed = stored.select("id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    assert ordering.check_sorted(placed, ["id"], ["file", "row"], block_rows=50).first()["is_sorted"]
    down = stage(spark.range(1000).repartitionByRange(4, F.desc("id")).sortWithinPartitions(F.desc("id")))
    placed = down.select("id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    row = ordering.check_sorted(placed, ["id"], ["file", "row"], block_rows=50).first()
    assert row["n_violations"] == 999 and row["first_violation_idx"]["row"] == 1


def test_faults_between_and_in_many_files(spark, plan):
    rows = [(f, r, 10 * f + r) for f in range(300) for r in range(5)]
    rows = [(f, r, k - 500 if (f, r) == (40, 3) else k - 2000 if (f, r) == (200, 0) else k) for f, r, k in rows]
    df = spark.createDataFrame(rows, "file int, row long, k long").repartition(6)
    report = ordering.check_sorted(df, ["k"], ["file", "row"], block_rows=2)
    assert "_at" in plan(report) and "rangepartitioning(_start" in plan(report)
    got = report.first()
    assert got["n_violations"] == 2 and tuple(got["first_violation_idx"]) == (40, 3)


def test_batches(spark):
    df = ordering.with_batch_id(spark.range(10).withColumnRenamed("id", "original_idx"), 4)
    assert [r["batch_id"] for r in df.orderBy("original_idx").collect()] == [0] * 4 + [1] * 4 + [2] * 2
    with pytest.raises(ValueError):
        ordering.with_batch_id(df, 0)


def test_ranks_keep_few_rows_before_the_shuffle(spark, plan):
    df, pdf = hot_edges(spark)
    edges = df.selectExpr("b AS MS1_ClusterID", "a AS MS2_ClusterID", "s AS score")
    capped = fragment_ranks(edges, max_rank=12)
    text = plan(capped)
    assert "WindowGroupLimit" in text and "Partial" in text
    got = capped.toPandas().sort_values(["MS2_ClusterID", "rank"])
    full = fragment_ranks(edges, max_rank=None).toPandas().sort_values(["MS2_ClusterID", "rank"])
    assert len(full) == len(pdf)
    assert (got.values == full[full["rank"] <= 12].values).all()
    assert fragment_ranks(edges, max_rank=1000).count() == (full["rank"] <= 1000).sum()
    hot = full[full.MS2_ClusterID == 500]
    assert (hot["rank"].values == np.arange(1, len(hot) + 1)).all()
    assert hot.score.is_monotonic_decreasing


@pytest.mark.parametrize("steps", [1, 2, 10, 1000])
def test_quantiles_against_numpy(spark, steps):
    rng = np.random.default_rng(5)
    values = {
        "hot": np.where(np.arange(999) % 3 == 0, 2.5, rng.normal(size=999)),
        "one": np.array([7.0]),
        "two": np.array([1.0, 4.0]),
        "same": np.full(50, -3.0),
    }
    pdf = pd.concat([pd.DataFrame({"g": g, "x": x}) for g, x in values.items()])
    df = spark.createDataFrame(pdf).union(spark.createDataFrame([("hot", None)], "g string, x double"))
    got = ordering.exact_quantiles(df, "x", steps, by=["g"]).toPandas()
    for g, x in values.items():
        part = got[got.g == g].sort_values("step")
        assert (part.step.values == np.arange(steps + 1)).all()
        assert np.allclose(part.value.values, np.quantile(x, np.arange(steps + 1) / steps), rtol=0, atol=1e-12)


def plain_quantiles(values, steps):
    """Ranks of a sorted list, NaN last, with linear interpolation in doubles."""
    x = sorted(values, key=lambda v: (v != v, v))
    out = []
    for i in range(steps + 1):
        low = i * (len(x) - 1) // steps
        a, b = x[low], x[min(low + 1, len(x) - 1)]
        out.append(a + (b - a) * ((i * (len(x) - 1) % steps) / steps))
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_quantiles_of_awkward_values(spark, monkeypatch, broadcast):
    """Ties, outliers, denormal, infinite and missing values; small bins, so that several levels are needed."""
    monkeypatch.setattr(ordering, "_FIRST_BINS", 64)
    monkeypatch.setattr(ordering, "_BINS", 32)
    if not broadcast:
        monkeypatch.setattr(ordering, "MAX_BROADCAST_ROWS", 0)
    rng = np.random.default_rng(6)
    groups = {
        "ties": [5.0] * 400 + [1.0] * 200 + [7.0],
        "far": [10.0**k for k in range(-300, 300, 3)] + [-(10.0**k) for k in range(0, 300, 5)],
        "widest": [-1.7e308, 1.7e308, 0.0, 1.0, 2.0] * 9,
        "tiny": [k * 5e-324 for k in range(40)],
        "odd": [float("nan")] * 3 + [float("inf"), float("-inf")] * 4 + rng.normal(size=300).tolist(),
        "one": [3.0],
        "two": [2.0, 1.0],
        None: rng.exponential(size=500).tolist(),
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("ties", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    got = {}
    for r in ordering.exact_quantiles(df, "x", 20, by=["g"]).orderBy("step").collect():
        got.setdefault(r["g"], []).append(r["value"])
    assert got.keys() == groups.keys()
    for g, values in groups.items():
        assert np.array_equal(got[g], plain_quantiles(values, 20), equal_nan=True), g


def test_quantiles_do_not_sort_values(spark, plan):
    df = spark.range(5000).selectExpr("cast(id % 3 AS string) AS g", "cast(id * 7 % 4999 AS double) AS x")
    text = plan(ordering.exact_quantiles(df, "x", 100, by=["g"]))
    assert "rangepartitioning" not in text


def test_quantiles_without_groups(spark):
    got = ordering.exact_quantiles(spark.range(101).selectExpr("cast(id AS double) AS x"), "x", 4)
    assert [r["value"] for r in got.orderBy("step").collect()] == [0.0, 25.0, 50.0, 75.0, 100.0]


def test_draws_leave_other_labels_out(spark):
    from ionweave.operators.sampling import draw_per_class

    rows = [(i, i, y) for i, y in enumerate([0, 1, 2, None] * 6)]
    edges = spark.createDataFrame(rows, "MS1_ClusterID long, MS2_ClusterID long, Y int")
    got = [tuple(r) for r in draw_per_class(edges, 5).collect()]
    assert sorted(y for _, _, y in got) == [0] * 5 + [1] * 5
    assert got == sorted(got)


def test_missing_median_fails(spark):
    from ionweave.operators.calibration import recalibrated

    stats = spark.createDataFrame([(100.0,)], "mz_wmean double")
    odd = spark.createDataFrame([(0.4, 2.0), (0.6, 3.0)], "probability double, ms1 double")
    with pytest.raises(Exception, match="no median"):
        recalibrated(stats, odd, "ms1").collect()
    assert recalibrated(stats, odd.limit(0), "ms1").first()[0] == 100.0


def test_configuration_keeps_its_fields(spark):
    import json

    from ionweave.operators.calibration import updated_configs

    config = {"static_mods": {}, "x": {"k": {}}, "mixed": [1, "a", None], "precursor_tol": {"ppm": [0, 0], "z": 1.5}}
    limits = spark.createDataFrame([(-1.0, 1.0, -2.0, 2.5)], "ms1_lo double, ms1_hi double, ms2_lo double, ms2_hi double")
    got = json.loads(updated_configs(limits, config).first()["config"])
    assert got == config | {"precursor_tol": {"ppm": [-1.0, 1.0], "z": 1.5}, "fragment_tol": {"ppm": [-2.0, 2.5]}}


def test_stored_index_follows_files(spark, tmp_path, plan):
    """Places of rows over several files and splits, without an exchange of rows."""
    path = f"file:{tmp_path}/t"
    spark.range(0, 5_000, numPartitions=12).selectExpr("id", "id * 3 AS x").write.parquet(path)
    for split in ("2000", "100000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            indexed = ordering.with_stored_index(spark.read.parquet(path), "i")
            assert indexed.columns == ["id", "x", "i"]
            text = plan(indexed)
            assert "hashpartitioning" not in text and "rangepartitioning" not in text
            assert all(r["i"] == r["id"] and r["x"] == 3 * r["id"] for r in indexed.collect())
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("batch", [7, 10_000])
def test_stored_order_against_plain_order(spark, tmp_path, batch):
    rng = np.random.default_rng(batch)
    odd = [None, float("nan"), float("inf"), -1.0, -1.0, 0.0, 2.5]
    cases = {
        "rising": [(i // 3, float(i % 3)) for i in range(200)],
        "ties": [(i // 4, float(i % 4 // 2)) for i in range(200)],
        "odd": [(None, None), (None, 1.0), (None, float("nan")), (0, None), (0, -1.0), (0, float("nan")), (1, 0.0)],
        "mixed": [(None if k == 5 else int(k), odd[j]) for k, j in zip(rng.integers(0, 6, 300), rng.integers(0, 7, 300))],
        "one": [(1, 1.0)], "none": [],
    }
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        for name, rows in cases.items():
            path = f"file:{tmp_path}/{name}"
            spark.createDataFrame(rows, "a long, b double").coalesce(1).write.option("maxRecordsPerFile", 61).parquet(path)
            key = [(r[0] is not None, r[0] or 0, r[1] is not None, r[1] is not None and r[1] != r[1], 0.0 if r[1] is None or r[1] != r[1] else r[1]) for r in rows]
            for strict in (True, False):
                bad = [i for i in range(1, len(key)) if not (key[i - 1] < key[i] or (not strict and key[i - 1] == key[i]))]
                got = ordering.check_stored_order(spark.read.parquet(path), ["a", "b"], strict).first()
                assert tuple(got) == (not bad, len(bad), bad[0] if bad else None), (name, strict)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
