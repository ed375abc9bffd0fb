import hashlib
import io
import json

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from ionweave.operators import packing
from ionweave.operators.packing import pack
from ionweave.operators.ordering import int_div
from ionweave.plans import jobs
from ionweave.sources import sinks, tables
from ionweave.sources.records import file_digests, read_fasta, read_records


def next_fit(sizes, limit):
    """Reference rule for one file, record by record."""
    bins, current, number = [], 0, 0
    for size in sizes:
        if current + size < limit:
            current += size
        else:
            number, current = number + 1, size
        bins.append(number)
    return bins


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.lists(st.integers(0, 30), max_size=60), min_size=1, max_size=4),
    st.sampled_from([1, 7, 20, 33.5, 100, 5000]),
    st.sampled_from([1, 3, 8, 1000]),
    st.sampled_from([2, 5, 64]),
)
def test_packing_equals_the_sequential_rule(spark, files, limit, span, fan):
    rows = [(f"f{i}", j, s) for i, sizes in enumerate(files) for j, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "file string, seq bigint, size bigint").repartition(4)
    got = pack(df, "file", "seq", F.col("size"), limit, segment=int_div(F.col("seq"), span), fan=fan)
    want = sorted((f"f{i}", j, b) for i, sizes in enumerate(files) for j, b in enumerate(next_fit(sizes, limit)))
    assert sorted(map(tuple, got.collect())) == want


def test_packing_of_one_hot_file(spark):
    rng = np.random.default_rng(4)
    sizes = np.where(rng.random(30_000) < 0.01, 5_000, rng.integers(1, 90, 30_000))
    rows = [("big", i * 3, int(s)) for i, s in enumerate(sizes)] + [("small", 0, 10_000)]
    df = spark.createDataFrame(rows, "file string, seq bigint, size bigint").repartition(8)
    for limit in (1_000, 10_000):
        got = pack(df, "file", "seq", F.col("size"), limit, segment=int_div(F.col("seq"), 2000)).orderBy("file", "seq")
        bins = [r["bin"] for r in got.collect()]
        assert bins[:-1] == next_fit(sizes.tolist(), limit) and bins[-1] == 1  # bin 0 stays empty


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=12), min_size=1, max_size=9), st.sampled_from([1, 7, 20, 100, 5000]))
def test_steps_compose(runs, limit):
    """A tree of steps, in whatever grouping, does what its records do one by one."""
    parts = [packing.steps_of(np.array(sizes), limit) for sizes in runs]
    forward = parts[0]
    for p in parts[1:]:
        forward = forward.then(p, limit)
    backward = parts[-1]
    for p in reversed(parts[:-1]):
        backward = p.then(backward, limit)
    flat = [s for sizes in runs for s in sizes]
    for entry in (0, 1, limit // 2, limit - 1, limit, 3 * limit):
        current, number = entry, 0
        for size in flat:
            if current + size < limit:
                current += size
            else:
                current, number = size, number + 1
        assert forward.after(entry, limit) == backward.after(entry, limit) == (current, number)
    assert len(forward.reach) <= 1 + sum(c < limit for c in np.cumsum(flat))


def test_packing_in_many_levels(spark):
    """One file of 3 000 segments in groups of 7: no group has more members, also with a null file."""
    rng = np.random.default_rng(8)
    sizes = rng.integers(0, 40, 9_000)
    rows = [(None, i, int(s)) for i, s in enumerate(sizes)] + [("other", i, 5) for i in range(20)]
    df = spark.createDataFrame(rows, "file string, seq bigint, size bigint").repartition(8)
    got = pack(df, "file", "seq", F.col("size"), 300, segment=int_div(F.col("seq"), 3), fan=7).collect()
    assert [r["bin"] for r in sorted((r for r in got if r["file"] is None), key=lambda r: r["seq"])] == next_fit(sizes.tolist(), 300)
    assert len(got) == len(rows) and {r["bin"] for r in got if r["file"]} == {0}
    with pytest.raises(ValueError):
        pack(df, "file", "seq", F.col("size"), 300, fan=1)


def spectrum(i, n=3):
    peaks = "".join(f"{100 + j}.5 {j + 1}\n" for j in range(n))
    return f"BEGIN IONS\nTITLE=s.{i}\n{peaks}END IONS\n"


def records_of(raw):
    """The rule line by line, as text files are read in Python."""
    out, lines = [], []
    for line in io.TextIOWrapper(io.BytesIO(raw), encoding="utf-8"):
        lines.append(line)
        if "END IONS" in line:
            out.append("".join(lines))
            lines = []
    return out


@pytest.mark.parametrize("split", ["150", "100000"])
def test_records_of_all_line_ends(spark, tmp_path, split):
    """Ends with blanks and more, all kinds of line ends, mixed ends, tails, no record at all, and records across several splits."""
    rng = np.random.default_rng(int(split))
    bodies = {
        "plain": "".join(spectrum(i, i % 5) for i in range(12)),
        "blanks": "".join(spectrum(i, 2).replace("END IONS", " END IONS \t" if i % 2 else "xEND IONSx") for i in range(8)),
        "tail": spectrum(1) + "BEGIN IONS\nTITLE=cut\n1 2\n", "blank_tail": spectrum(2) + "\n  \n",
        "bare": spectrum(3) + spectrum(4)[:-1], "one": "END IONS", "none": "no record\n" * 30, "empty": "", "unicode": "é\n" + spectrum(5),
    }
    want = []
    for name, body in bodies.items():
        for kind, end in (("lf", "\n"), ("crlf", "\r\n"), ("cr", "\r"), ("mixed", None)):
            ends = [end or ("\n", "\r\n", "\r")[k] for k in rng.integers(0, 3, body.count("\n") + 1)]
            raw = "".join(x + (e if i < body.count("\n") else "") for i, (x, e) in enumerate(zip(body.split("\n"), ends))).encode()
            (tmp_path / f"{name}.{kind}").write_bytes(raw)
            want += [(f"{name}.{kind}", t) for t in records_of(raw)]
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = read_records(spark, f"file:{tmp_path}")
        rows = df.orderBy("file", "block", "row").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = [(r["file"].rpartition("/")[2], r["text"]) for r in rows]
    assert sorted(got) == sorted(want)
    for name in {n for n, _ in want}:
        assert [t for n, t in got if n == name] == [t for n, t in want if n == name]
    assert len({(r["file"], r["row"]) for r in rows}) == len(rows)


@pytest.mark.parametrize("split", ["3000", "100000000"])
def test_digests_of_files(spark, tmp_path, split):
    """Text and raw bytes, with and without a last line feed, empty files, and files cut into several splits."""
    rng = np.random.default_rng(9)
    files = {
        "a.txt": b"one\ntwo\n", "b.txt": b"one\ntwo", "c.txt": b"\n", "d.txt": b"\n\nx", "e.txt": b"", "f.bin": rng.bytes(20_000),
        "g.bin": rng.bytes(9_000) + b"\n", "h.txt": b"no line feed at all" * 500, "i.txt": "é\r\nü\r".encode(),
    }
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = file_digests(spark, f"file:{tmp_path}").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {r["path"].rpartition("/")[2]: (r["size"], r["sha256"]) for r in rows}
    assert len(rows) == len(files) and got == {n: (len(x), hashlib.sha256(x).hexdigest()) for n, x in files.items()}


def test_shards_read_back(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for name in "ab":
        (source / f"{name}.mgf").write_text("".join(spectrum(i, i % 7) for i in range(50)))
    bins = jobs.spectrum_shards(spark, f"file:{source}", f"file:{out}", 400)
    for name in "ab":
        folder = next(out.glob(f"name={name}.mgf*"))
        shards = sorted(folder.glob("bin=*"), key=lambda p: int(p.name[4:]))
        text = "".join(next(s.glob("*.txt")).read_text() for s in shards)
        assert text == "".join(spectrum(i, i % 7) for i in range(50))
        sizes = [next(s.glob("*.txt")).stat().st_size for s in shards]
        assert max(sizes) < 400 and len(sizes) == len({r["bin"] for r in bins.collect()})
    with pytest.raises(AnalysisException):
        jobs.spectrum_shards(spark, f"file:{source}", f"file:{out}", 400)  # no overwriting


def test_fasta(spark, tmp_path):
    (tmp_path / "p.fasta").write_text(">P1 one\nACD\nEF\n>rev_P1 two\n\n>P3\nGG>X\r\nT")
    got = sorted(map(tuple, read_fasta(spark, f"file:{tmp_path}/p.fasta").collect()))
    assert got == [("P1 one", "ACDEF"), ("P3", "GG>XT"), ("rev_P1 two", "")]


def test_tsv_schema_is_checked(spark, tmp_path):
    path = tmp_path / "p.txt"
    path.write_text("spectrum_id\tpeptide\tcharge\tprotein_list\tmokapot q-value\nr.1\tAB\t2\tP1,P2\t0.001\n")
    row = tables.read_tsv(spark, f"file:{path}", tables.PEPTIDE_SCHEMA).first()
    assert row["mokapot q-value"] == 0.001 and row["charge"] == 2
    path.write_text("wrong\tpeptide\tcharge\tprotein_list\tmokapot q-value\nr.1\tAB\t2\tP1,P2\t0.001\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="header does not conform"):
        tables.read_tsv(spark, f"file:{path}", tables.PEPTIDE_SCHEMA).collect()


def test_documents(spark, tmp_path):
    (tmp_path / "r.json").write_text('{\n "a": [1, 2]\n}')
    assert json.loads(tables.read_document(spark, f"file:{tmp_path}/r.json").first()["document"]) == {"a": [1, 2]}
    assert tables.read_document(spark, '{"b": 1}').first()["document"] == '{"b": 1}'
    with pytest.raises(PySparkException, match="not a JSON"):
        tables.read_document(spark, '{"b": 1').collect()


def test_sinks_refuse_to_overwrite(spark, tmp_path):
    df = spark.range(3)
    for i, write in enumerate((sinks.write_csv, sinks.write_table, sinks.write_report)):
        path = f"file:{tmp_path}/{i}"
        write(df, path)
        with pytest.raises(AnalysisException):
            write(df, path)
    sinks.append_table(df, f"file:{tmp_path}/1")
    assert spark.read.parquet(f"file:{tmp_path}/1").count() == 6


def test_result_ids_count_on(spark, tmp_path):
    path = f"file:{tmp_path}/results"
    docs = spark.createDataFrame([("run", '{"a": 1}'), ("run", '{"a": 1}')], "command string, result string")
    sinks.append_results(docs, path)
    sinks.append_results(docs.drop("command"), path)
    rows = spark.read.parquet(path).orderBy("id").collect()
    assert [r["id"] for r in rows] == [1, 2, 3, 4]
    assert [r["command"] for r in rows] == ["run", "run", "NA", "NA"]
    assert all(r["date"].microsecond == 0 and r["reproducibility"] == "{}" for r in rows)


def test_results_must_be_json(spark, tmp_path):
    docs = spark.createDataFrame([("{",)], "result string")
    with pytest.raises(PySparkException, match="not a JSON"):
        sinks.append_results(docs, f"file:{tmp_path}/bad")


def test_report_keeps_nulls(spark, tmp_path):
    path = tmp_path / "r"
    sinks.write_report(spark.createDataFrame([(1, None)], "a int, b int"), f"file:{path}")
    lines = [line for f in path.glob("*.json") for line in f.read_text().splitlines()]
    assert [json.loads(line) for line in lines] == [{"a": 1, "b": None}]


def test_filtered_edges_are_stored_in_order(spark, tmp_path):
    edges = spark.range(500).selectExpr("id % 50 AS MS1_ClusterID", "id AS MS2_ClusterID", "id % 3 AS s")
    in_order = edges.orderBy("MS1_ClusterID", "MS2_ClusterID").collect()
    edges.repartitionByRange(6, "MS1_ClusterID", "MS2_ClusterID").sortWithinPartitions("MS1_ClusterID", "MS2_ClusterID").write.parquet(f"file:{tmp_path}/in")
    out = jobs.filtered_edge_table(spark.read.parquet(f"file:{tmp_path}/in"), "s = 1", f"file:{tmp_path}/e")
    got = sorted((r["original_idx"], r["MS1_ClusterID"], r["MS2_ClusterID"]) for r in out.collect())
    assert got == [(i, r[0], r[1]) for i, r in enumerate(in_order) if r["s"] == 1]
    for name, wrong in (("shuffled", edges.repartition(6)), ("twice", edges.where("MS1_ClusterID < 1").union(edges.where("MS1_ClusterID < 1")).coalesce(1))):
        wrong.write.parquet(f"file:{tmp_path}/{name}")
        with pytest.raises(ValueError, match="not stored in order"):
            jobs.filtered_edge_table(spark.read.parquet(f"file:{tmp_path}/{name}"), "s = 1", f"file:{tmp_path}/{name}-out")
        assert not (tmp_path / f"{name}-out").exists()


def test_positions_of_stored_rows(spark, tmp_path):
    path = f"file:{tmp_path}/t"
    spark.range(10).coalesce(1).write.parquet(path)
    rows = tables.read_with_position(spark, path, ["id"]).collect()
    assert sorted((r["id"], r["row"]) for r in rows) == [(i, i) for i in range(10)]


def test_shards_keep_blank_last_lines(spark, tmp_path):
    from ionweave.sources.sinks import write_shards

    rows = [("f", 0, "abc\n\n"), ("f", 1, "x\n"), ("f", 2, "\n\n\n")]
    records = spark.createDataFrame(rows, "file string, seq long, text string")
    bins = spark.createDataFrame([("f", i, 0) for i in range(3)], "file string, seq long, bin long")
    write_shards(records, bins, str(tmp_path / "out"), "file", "seq", "text")
    (shard,) = (tmp_path / "out").glob("file=f/bin=0/part-*.txt")
    assert shard.read_text() == "".join(r[2] for r in rows)


def test_records_do_not_depend_on_later_splits(spark, tmp_path):
    from ionweave.plans.jobs import spectrum_shards
    from ionweave.sources.records import read_records

    for f in range(3):
        (tmp_path / f"in{f}.mgf").write_text("".join(f"BEGIN IONS\nT={f}.{i}\nEND IONS\n" for i in range(400)))
    source = str(tmp_path / "in*.mgf")
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        records = read_records(spark, source)
        before = sorted(records.collect())
        spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
        assert sorted(records.collect()) == before and len(before) == 1200
        bins = spectrum_shards(spark, source, str(tmp_path / "out"), 2000)
        assert bins.count() == 1200
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    text = "".join(p.read_text() for p in sorted((tmp_path / "out").rglob("part-*.txt")))
    assert text.count("END IONS") == 1200 == len({x for x in text.split("\n") if x.startswith("T=")})


def test_stored_edges_refuse_a_folder_in_use(spark, tmp_path):
    from ionweave.plans.jobs import filtered_edge_table

    edges = spark.createDataFrame([(i, i, 1.0) for i in range(50)], "MS1_ClusterID long, MS2_ClusterID long, score double")
    edges.coalesce(1).write.parquet(str(tmp_path / "in"))
    edges = spark.read.parquet(str(tmp_path / "in"))
    assert filtered_edge_table(edges, "score > 0", str(tmp_path / "e")).count() == 50
    with pytest.raises(Exception, match="(?i)exist"):
        filtered_edge_table(edges, "score > 0", str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "e")).count() == 50
