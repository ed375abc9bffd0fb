"""Every operator against a plain version, on the smallest tables and on awkward rows."""

import ctypes
import os
import random
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql.types import LongType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import plain
from ionweave.llm import (
    elias_fano, jaccard, mixing, packing, pii, quality, queries, secret_scan, sentence_spans, textual, token_counts,
    token_files, vectors,
)
from ionweave.llm.components import components
from ionweave.llm.tokens import Encoder, encoder, tokenizer_path
from ionweave.staging import new_path, stage

SF = "/root/testdata/sf0.001"
WORDS, BYTES = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and columns named as in results."""
    long = " ".join(f"word{i}" for i in range(60_000))
    near = " ".join(f"n{i}" for i in range(100))
    rows = [
        (1, None, "a", 1), (2, "", "a", 2), (3, "  \n\t ", None, 3), (4, "one two", None, 4), (5, "one two", "b", 5),
        (6, long, "b", 6), (7, "é ü   İ ß", "b", 7), (7, "é ü   İ ß", "b", 7), (None, "no id here", "a", 8),
        (9, near, "c", 9), (10, near + " extra", "c", 10), (11, near.upper(), "c", 11), (None, near, "c", 12),
        (13, "double  space\n\nlines \t tab <|endoftext|> x", "a", 13), (14, "x@y.zz +1 234 567 8901 4111 1111 1111 1111", "a", 14),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long").withColumnsRenamed({})


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def both(documents, awkward):
    return [documents.select("doc_id", "text", "source"), awkward]


def empty(df):
    return df.limit(0)


def texts(df):
    return [(r["doc_id"], r["text"] or "") for r in df.collect()]


# 1 and 10: spans


def test_private_parsers_equal_patterns():
    draws = random.Random(5)
    bits = ["a", "b.", "@", "@x.y", ".", "+", "1", "23", "255", "-", " ", "(", ")", "4111111111111111", "é", "9.8.7.6", "0"]
    for _ in range(20_000):
        text = "".join(draws.choice(bits) for _ in range(draws.randint(0, 30)))
        assert [s for s in pii.find(text) if s[1] < 4] == plain.private(text), text


def test_private_extra_kinds():
    text = "at 12 High Oak Street, IBAN: GB82 WEST 1234 5698 7654 32, SSN 123-45-6789, ftp://bob:pw@host.org/x mailto:jo@x.org"
    found = {pii.KINDS[k] for _, k, _ in pii.find(text)}
    assert found == {"street", "account", "url", "email"}
    assert not pii.find("IBAN: GB83 WEST 1234 5698 7654 32 and https://host.org/x and 12 high street")
    assert pii.redacted("to a@b.cc now") == "to [email] now"


def test_private_rows(documents, awkward):
    for docs in both(documents, awkward):
        rows = pii.personal_data(docs).collect()
        want = sorted((str(i), plain.digest(plain.private(t), pii.KINDS), len(plain.private(t))) for i, t in texts(docs))
        got = sorted((str(r["doc_id"]), r["base_sha256"], sum(r[f"n_{k}"] for k in pii.BASE)) for r in rows)
        assert got == want
        assert pii.personal_data(empty(docs)).count() == 0


def test_redacted_texts_hold_no_base_data(documents, awkward):
    for docs in both(documents, awkward):
        clean = pii.redact(docs)
        assert clean.columns == docs.columns and clean.count() == docs.count()
        assert not any(plain.private(t) for _, t in texts(clean))
        assert clean.where("text IS NULL").count() == docs.where("text IS NULL").count()


def test_secret_rows(spark, documents, awkward):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    ratios = secret_scan.train(documents, labels)
    for docs in both(documents, awkward):
        rows = secret_scan.secrets(docs, ratios).collect()
        want = sorted((str(i), plain.digest(plain.secret(t), secret_scan.KINDS)) for i, t in texts(docs))
        assert sorted((str(r["doc_id"]), r["base_sha256"]) for r in rows) == want
    assert secret_scan.train(documents, empty(labels)) is None
    assert secret_scan.secrets(empty(documents), None).count() == 0


def test_secret_patterns():
    draws = random.Random(6)
    bits = ["token", "PassWord", "api_key", "apikey", "=", ":", " ", "'", '"', "abcdef1", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "K", "ſecret"]
    for _ in range(20_000):
        text = "".join(draws.choice(bits) for _ in range(draws.randint(0, 12)))
        assert secret_scan.base_spans(text) == plain.secret(text), text


def test_covered_characters():
    draws = random.Random(3)
    for _ in range(300):
        spans = [(a, 0, a + draws.randint(1, 6)) for a in (draws.randint(0, 40) for _ in range(draws.randint(0, 8)))]
        own = secret_scan.Covered(spans)
        for _ in range(40):
            a = draws.randint(0, 45)
            b = a + draws.randint(1, 8)
            assert own.meets(a, b) == any(x < b and a < y for x, _, y in spans)


def test_markov_models_on_held_out_samples(spark, documents):
    """Random strings that were not trained on are found; identifiers of other documents are left alone."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    ratios, odds = secret_scan.train(documents, labels, sample_documents=30), -np.log(1e-4)
    strings = [secret_scan.random_string(i) for i in range(10_000, 10_500)]
    found = sum(secret_scan.find(f"is {s} it", ratios, odds) != [] for s in strings)
    assert found >= 0.99 * len(strings)
    names = ["internationalisation_of_names", "getElementsByTagNameAndClass", "----------------------------"]
    assert not any(secret_scan.find(n, ratios, odds) for n in names)
    held = [t for _, t in texts(documents.join(labels.where("quality = 1"), "doc_id"))]
    assert not any(k == 3 for t in held for _, k, _ in secret_scan.find(t, ratios, odds))


# 2: mixing


def test_mix(spark, documents, awkward):
    for docs in both(documents, awkward):
        rows = mixing.mixed(docs, stage).collect()
        assert len(rows) == docs.count()
        sizes, taken, largest = {}, {}, {}
        for r in rows:
            sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
            taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
            largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
            assert r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        want = plain.targets(sizes)
        for r in rows:
            assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        for s in sizes:
            assert abs(taken[s] - want[s]) <= largest[s]
        again = mixing.mixed(docs.repartition(5), stage).collect()
        assert sorted(map(str, again)) == sorted(map(str, rows))
        assert mixing.mixed(empty(docs), stage).count() == 0


def test_mix_through_many_levels(documents):
    docs = documents.select("doc_id", "text", "source")
    rows = mixing.mixed(docs, stage, bucket=2).collect()
    taken, want = {}, {}
    for r in rows:
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        want[r["source"]] = r["target"]
    largest = max(r["size"] for r in rows)
    assert all(abs(taken[s] - want[s]) <= largest for s in taken)


def test_ranks_of_many_sources(spark):
    """More sources than a range shuffle samples: places are those of the code points, and reruns agree."""
    n = 40_000
    names = spark.range(n).selectExpr("IF(id = 5, NULL, concat(chr(97 + id % 26), xxhash64(id))) AS source", "id % 50 AS words", "1 AS docs")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = {r["source"]: r["rank"] for r in mixing._ranked(names, stage).collect()}
        targets = [sorted(map(str, mixing.targets(names, stage, (3, 1, 2), 150).collect())) for _ in range(2)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = sorted((x for x in got if x is not None), key=str.encode) + [None]
    assert got == {x: i for i, x in enumerate(want)} and len(want) == n
    assert targets[0] == targets[1]


def test_equal_rows_spread_over_buckets(spark, monkeypatch):
    rows = spark.range(3_000).selectExpr("CAST(NULL AS long) AS doc_id", "'same words in all of them' AS text", "'a' AS source")
    other = spark.createDataFrame([(1, "x " * 9_000, "b")], "doc_id long, text string, source string")
    seen = []

    def counting(df, seed, level):
        if level == 0:
            seen.extend(r["count"] for r in df.where("source = 'a'").groupBy("bucket").count().collect())
        return real(df, seed, level)

    real = mixing._bucket_rounding
    monkeypatch.setattr(mixing, "_bucket_rounding", counting)
    out = mixing.mixed(rows.unionByName(other), stage, bucket=100).collect()
    assert len(out) == 3_001 and len(seen) == 30 and max(seen) < 200
    taken = sum(r["taken"] for r in out if r["source"] == "a")
    assert abs(taken - next(r["target"] for r in out if r["source"] == "a")) <= 5


def test_rounding_keeps_words_and_probabilities():
    size = np.array([5.0, 9.0, 2.0, 30.0, 11.0, 7.0, 7.0])
    share = np.full(7, 0.37)
    runs = np.array([mixing.round_pairs(size, share, np.random.default_rng(i)) for i in range(4000)])
    assert ((runs > 0) & (runs < 1)).sum(axis=1).max() <= 1
    assert np.allclose(runs @ size, share @ size)
    assert np.allclose(runs.mean(axis=0), share, atol=0.03)


# 3: vectors


def exact_neighbours(rows, query, top):
    q = np.array(rows[query])
    found = sorted((float(np.sqrt(((np.array(v) - q) ** 2).sum())), i) for i, v in rows.items() if i != query)
    return found[:top]


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = {r["vec_id"]: r["embedding"] for r in table.collect()}
    got = vectors.nearest(table, lambda i: i % 100 == 0, stage, visit=100).collect()
    hit = total = 0
    for query in {r["query_id"] for r in got}:
        want = {i for _, i in exact_neighbours(rows, query, 10)}
        own = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == query)
        assert [r for r, _, _ in own] == list(range(1, len(own) + 1))
        hit, total = hit + len(want & {i for _, i, _ in own}), total + 10
    assert total == 10 * len([i for i in rows if i % 100 == 0])


def test_recall_of_the_query(spark):
    """As registered, about half of these vectors are visited."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    pairs = sorted((r["vec_id"], r["embedding"]) for r in table.collect())
    points = np.array([v for _, v in pairs], np.float64)
    got = queries.op3_multi_index(spark, "/root/testdata/sf0.1").collect()
    asked = [i for i, (v, _) in enumerate(pairs) if v % 100 == 0]
    hit = 0
    for i in asked:
        apart = np.sqrt(((points - points[i]) ** 2).sum(1))
        apart[i] = np.inf
        hit += len({pairs[k][0] for k in np.argsort(apart)[:10]} & {r["vec_id"] for r in got if r["query_id"] == pairs[i][0]})
    assert hit >= 0.9 * 10 * len(asked)


def test_recall_over_many_tiles(spark):
    """A tenth of a table in clusters is visited, over tens of tiles, and no row outside the walked cells is returned."""
    draws = np.random.default_rng(4)
    centres = draws.normal(size=(60, 16))
    points = centres[draws.integers(0, 60, 4_000)] + 0.3 * draws.normal(size=(4_000, 16))
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    hit = {}
    for visit in (20, 400):
        got = vectors.nearest(table, lambda i: i % 100 == 0, stage, visit=visit, share=0.0, tile=100).collect()
        hit[visit] = 0
        for query in range(0, 4_000, 100):
            apart = np.sqrt(((points - points[query]) ** 2).sum(1))
            apart[query] = np.inf
            hit[visit] += len(set(np.argsort(apart)[:10].tolist()) & {r["vec_id"] for r in got if r["query_id"] == query})
    assert hit[400] >= 0.9 * 400 and hit[20] < hit[400]


def test_rows_that_share_an_id_are_found(spark):
    rows = [(7, [0.0, 1.1]), (7, [5.0, 5.0]), (8, [5.0, 5.1]), (200, [5.0, 5.0]), (100, [0.0, 1.0]), (100, [5.0, 5.2]), (100, [5.0, 5.2])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in vectors.nearest(table, lambda i: i % 100 == 0, stage, top=2).collect()]
    assert [r[2] for r in sorted(got) if r[0] == 200] == [7, 8]
    first = sorted((r[2], round(r[3], 3)) for r in got if r[0] == 100 and r[1] == 1)
    assert first == [(7, 0.1), (8, 0.1)] and len(got) == 6


def test_neighbours_of_awkward_vectors(spark):
    draws = random.Random(8)
    rows = [(i, [draws.random() for _ in range(4)]) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(40)]  # copies of a query
    bad = [(900, None), (901, [0.0] * 4), (902, [1.0, None, 1.0, 1.0]), (903, [float("nan")] * 4), (904, [1.0]), (None, [1.0] * 4), (1000, [float("inf")] * 4)]
    table = spark.createDataFrame(rows + bad + rows[:5], "vec_id long, embedding array<double>")
    got = vectors.nearest(table, lambda i: i % 100 == 0, stage, visit=10_000, tile=16).collect()
    held = dict(rows)
    for query in (0, 100, 200, 300):
        own = [(r["score"], r["vec_id"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == query]
        want = exact_neighbours(held, query, 10)
        assert [i for _, i in own] == [i for _, i in want]
        assert np.allclose([s for s, _ in own], [s for s, _ in want])
    assert {r["query_id"] for r in got} == {0, 100, 200, 300}
    few = vectors.nearest(spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>"), lambda i: i == 0, stage)
    assert sorted(r["vec_id"] for r in few.collect()) == [1, 2]
    assert vectors.nearest(empty(table), lambda i: i == 0, stage).count() == 0


# 4: similar documents


def component_rows(docs, **more):
    found = jaccard.similar_components(docs, stage, **more)
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found.collect()), key=str)


def test_components_equal_all_pairs(documents, awkward):
    for docs in both(documents, awkward):
        assert component_rows(docs) == plain.jaccard_components(texts(docs))
        assert component_rows(empty(docs)) == []


def test_chains_of_similar_texts(spark):
    """Neighbours in a chain are similar, its ends are not; and one base has copies that are only like it."""
    words = [f"c{i}" for i in range(400)]
    rows = [(100 + k, " ".join(words[8 * k : 8 * k + 120])) for k in range(30)]
    draws = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows.append((5000, " ".join(base)))
    for k in range(60):
        copy = list(base)
        for at in draws.sample(range(100), 3):
            copy[at] = f"z{k}_{at}"
        rows.append((4000 + k, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain.jaccard_components(rows)
    assert component_rows(docs) == want
    assert component_rows(docs.repartition(7)) == want


def test_random_small_sets(spark):
    draws = random.Random(10)
    rows = [(i, " ".join(draws.choice("ab") for _ in range(draws.randint(0, 14)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert component_rows(docs) == plain.jaccard_components(rows)


def test_bitmaps_never_bound_too_low():
    draws = np.random.default_rng(4)
    for _ in range(300):
        common = draws.integers(0, 2**63, draws.integers(0, 200), dtype=np.uint64)
        a, b = (np.unique(np.concatenate((common, draws.integers(0, 2**63, draws.integers(1, 300), dtype=np.uint64)))) for _ in "ab")
        bound = jaccard.overlap_bound(jaccard._bitmap(a), jaccard._bitmap(b), len(a), len(b))
        assert len(np.intersect1d(a, b)) <= bound <= min(len(a), len(b))


def test_components_of_links(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 300), (200, 300), (7, 7)] + [(1000, 1000 + i) for i in range(1, 200)]
    found = components(spark.createDataFrame(links, "a long, b long"), stage).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(found) == len(roots)
    assert roots == {i: 0 for i in range(51)} | {i: 100 for i in (100, 200, 300)} | {i: 1000 for i in range(1000, 1200)}


# 5, 8, 9: tokens


@pytest.mark.parametrize("path", [WORDS, BYTES])
def test_ids_equal_the_library(path):
    draws = random.Random(2)
    bits = ["a", "é", " ", "  ", "\n", "\t", "the", "'s", "'S", "12", "!!", ".", ",", "<|endoftext|>", "<|startoftext|>", "İ", "Σ", "ß"]
    bits += ["́", "\x1c", " ", "​", "😀", "中", "\r\n", "\x0b", "\x00", "½", "don't", "ﬁ", "\x01", "\x02", " x.\nY"]
    own = Encoder(path, limit=40)
    for _ in range(40):
        some = ["".join(draws.choice(bits) for _ in range(draws.randint(0, 14))) for _ in range(50)]
        for text, ids, n in zip(some, own.encode(pa.array(some)), own.lengths(pa.array(some))):
            assert ids.tobytes() == own.by_library(text), text
            assert n == len(ids)


def library_ids(path, docs):
    own = encoder(path).tokenizer
    return [(i, own.encode(t, add_special_tokens=False).ids) for i, t in texts(docs)]


def test_counts(documents, awkward):
    for docs in both(documents, awkward):
        rows = token_counts.token_counts(docs, BYTES).collect()
        lengths = dict()
        want = sorted((str(i), len(ids), len(ids) > 512) for i, ids in library_ids(BYTES, docs))
        assert sorted((str(r["doc_id"]), r["n_tokens"], r["over_limit"]) for r in rows) == want
        assert sum(r["n_bytes"] for r in rows) == sum(len(t.encode()) for _, t in texts(docs))
        assert token_counts.token_counts(empty(docs), BYTES).count() == 0
    assert lengths == {}


def test_counts_do_not_depend_on_the_table(documents):
    a, b = (token_counts.token_counts(documents, BYTES, table=n) for n in (1, 5000))
    assert sorted(a.collect()) == sorted(b.collect())


def test_token_files(spark, documents, awkward):
    for docs in both(documents, awkward):
        rows = token_files.token_file_rows(docs, new_path(spark, "t"), WORDS, stage).collect()
        ids = {}
        for i, found in library_ids(WORDS, docs):
            ids.setdefault(i, []).append(plain.crc([*found, 2]))
        got = {}
        for r in rows:
            got.setdefault(r["doc_id"], []).append(r["ids_crc32"])
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in ids.items()}
        order = sorted(rows, key=lambda r: r["start"])
        assert [r["start"] for r in order] == list(np.cumsum([0] + [r["n_tokens"] for r in order])[:-1])
        known = [r["doc_id"] for r in order if r["doc_id"] is not None]
        assert known == sorted(known) and [r["doc_id"] for r in order[: len(order) - len(known)]] == [None] * (len(order) - len(known))
        assert token_files.token_file_rows(empty(docs), new_path(spark, "t"), WORDS, stage).count() == 0


def test_small_shards_give_the_same_rows(spark, documents):
    folder = new_path(spark, "t")
    shards = stage(token_files.write_token_files(documents, folder, WORDS, shard_ids=3000))
    whole = token_files.token_file_rows(documents, new_path(spark, "t"), WORDS, stage)
    assert shards.count() > 8
    assert sorted(token_files.read_token_files(spark, folder, shards).collect()) == sorted(whole.collect())


def test_token_files_encode_slices_and_give_memory_back(spark, monkeypatch, tmp_path):
    """One Arrow batch with 24 MB of texts is encoded in slices, and little stays held after the task."""
    rollup, trim = "/proc/self/smaps_rollup", getattr(ctypes.CDLL(None), "malloc_trim", None)
    sizes, used = [], []

    class Own:
        width, dtype = 2, np.dtype("<u2")

        def encode(self, texts):
            sizes.append(pc.sum(pc.binary_length(texts)).as_py())
            blocks = [np.ones(250) for _ in range(60_000)]  # 120 MB
            used.extend(blocks[::20_000] + blocks[-1:])
            return [np.array([i], "<u2") for i in range(len(texts))]

    class Task:
        @staticmethod
        def get():
            return type("Context", (), {"partitionId": lambda self: 0})()

    def held():
        with open(rollup) as f:
            return next(int(x.split()[1]) for x in f if x.startswith("Anonymous:")) >> 10

    runs = []
    docs = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append(run))
    monkeypatch.setattr(token_files, "encoder", lambda path: Own())
    monkeypatch.setattr(token_files, "TaskContext", Task)
    token_files.write_token_files(docs, f"file://{tmp_path}", WORDS)
    batch = pa.RecordBatch.from_pydict({"doc_id": range(2400), "text": ["word " * 2000] * 2400})
    measured = trim and os.path.exists(rollup)
    if measured:
        trim(0)
        before = held()
    out = pa.Table.from_batches(runs[0](iter([batch])))
    assert sum(out["docs"].to_pylist()) == 2400 and sum(out["ids"].to_pylist()) == 4800
    assert sum(sizes) == 24_000_000 and max(sizes) <= textual.SLICE
    if measured:
        assert held() - before < 40


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
def test_elias_fano(n):
    draws = np.random.default_rng(n)
    for top in (1, 10, 10_000):
        values = np.cumsum(draws.integers(0, top + 1, n))
        code = elias_fano.EliasFano.of(values)
        assert code.select(0, n).tolist() == values.tolist()
        assert [code[i] for i in range(0, n, 97)] == values[::97].tolist()
    with pytest.raises(ValueError):
        elias_fano.EliasFano.of(np.array([2, 1]))


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(1).integers(1, 2000, 100_000))
    code = elias_fano.EliasFano.of(values)
    bits = 8 * (code.low.nbytes + code.high.nbytes + code.samples.nbytes) / len(values)
    assert bits < 2.3 + np.log2(values[-1] / len(values))


def test_shard_random_access():
    parts = [np.arange(n, dtype="<u2") for n in (3, 0, 5, 1)]
    shard = token_files.Shard(token_files.pack_shard(parts, [None, 4, 4, 9], 2))
    assert [shard.document(i).tolist() for i in range(4)] == [p.tolist() for p in parts]
    assert [shard.name(i) for i in range(4)] == [None, 4, 4, 9]


def check_packing(rows, ids, window):
    """Every id in exactly one piece, sequences gapless and not too long; the number of padded places."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for found in sequences.values():
        at = 0
        for r in sorted(found, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= window
    for doc, all_ids in ids:
        own = [r for r in rows if r["doc_id"] == doc and r["doc_tokens"] == len(all_ids) + 1]
        copies = sum(d == doc and i == all_ids for d, i in ids)
        assert sum(r["length"] for r in own) == copies * (len(all_ids) + 1)
        if copies == 1:
            assert all(r["ids_crc32"] == plain.crc([*all_ids, 1][r["start"] : r["start"] + r["length"]]) for r in own)
    return sum(window - sum(r["length"] for r in s) for s in sequences.values())


def test_packing(documents, awkward):
    for docs in both(documents, awkward):
        rows = packing.pack_documents(docs.repartition(6), WORDS, stage).collect()
        assert check_packing(rows, library_ids(WORDS, docs), 2048) < 2048
        assert packing.pack_documents(empty(docs), WORDS, stage).count() == 0


def test_packing_with_few_windows_and_levels(documents):
    rows = packing.pack_documents(documents.repartition(9), WORDS, stage, window=50, most_open=3, group=2).collect()
    assert check_packing(rows, library_ids(WORDS, documents), 50) < 50


# 6: quality


def test_measures(documents, awkward):
    for docs in both(documents, awkward):
        for _, text in texts(docs):
            got = quality.measure(text)
            assert {k: got[k] for k in plain.measures(text)} == plain.measures(text)
    for text in ("a b c d e f a b c d e f", "x " * 9, "a b c d e a b c d e", "l\nl\n\nl \n l"):
        got = quality.measure(text)
        assert {k: got[k] for k in plain.measures(text)} == plain.measures(text)


def test_binomial_bound_is_exact():
    from math import comb

    for n, k, p in ((10, 0, 0.1), (50, 3, 0.2), (200, 1, 0.01)):
        want = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.binomial_below(k, n, p) == pytest.approx(want)
    assert quality.most_allowed(5, 0.01, 1e-3) == -1
    k = quality.most_allowed(5000, 0.01, 1e-4)
    assert quality.binomial_below(k, 5000, 0.01) <= 1e-4 < quality.binomial_below(k + 1, 5000, 0.01)


def test_cutoffs_keep_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.judged(docs, labels, stage, risk=0.3).join(labels, "doc_id").select("doc_id", "quality", "_quality.*").collect()
    good = [r for r in rows if r["quality"] == 1 and not r["base_failed"]]
    bad = [r for r in rows if r["quality"] == 0]
    assert sum(not r["kept"] for r in good) <= 0.1 * len(good)
    assert sum(not r["kept"] for r in bad) >= 0.3 * len(bad)


def test_rejected_good_documents_are_few(spark):
    """With many labels: a rule cuts bad documents, and good ones only up to the risk."""
    rows = [(i, f"Document {i} has one plain sentence of more than ten words here, and ends.", "x") for i in range(4000)]
    rows += [(5000 + i, f"{i} " + " ".join(f"w{i}_{j}###" for j in range(40)), "x") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 5000)) for i, _, _ in rows], "doc_id long, quality int")
    kept = {r["doc_id"]: r["_quality"]["kept"] for r in quality.judged(docs, labels, stage).collect()}
    assert all(kept[i] for i in range(4000))
    assert not any(kept[5000 + i] for i in range(300))


def test_every_language_has_rules(spark):
    """A few hundred good labels suffice: bad documents that pass the limits are caught, few good ones are lost."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.judged(docs, labels, stage).join(labels, "doc_id").select("lang", "quality", "_quality.*").collect()
    for lang in {r["lang"] for r in rows}:
        good = [r for r in rows if r["lang"] == lang and r["quality"] == 1 and not r["base_failed"]]
        bad = [r for r in rows if r["lang"] == lang and r["quality"] == 0 and not r["base_failed"]]
        print(lang, len(good), sum(not r["kept"] for r in good), len(bad), sum(not r["kept"] for r in bad))
        assert sum(not r["kept"] for r in good) <= 0.02 * len(good)
        assert sum(not r["kept"] for r in bad) >= 0.9 * len(bad)


def test_steps_end_at_the_first_that_fails():
    codes = np.array([[0, 0], [3, 0], [0, 5], [0, 11]])
    bad, good = (codes, np.zeros(4, int), np.array([0, 40, 9, 9])), np.array([400, 0, 0, 0])
    many = np.concatenate((codes, codes, codes)), np.repeat([0, 1, 2], 4), np.concatenate((bad[2], good // 4, good))
    assert quality.chosen(*many, 0.02, 0.05 / 4) == [float(quality.GRID[2]), float(quality.GRID[4])]
    lost = np.concatenate((bad[2], good // 4, [400, 0, 20, 0]))
    assert quality.chosen(*many[:2], lost, 0.02, 0.05 / 4) == [float(quality.GRID[2]), None]
    few = np.concatenate((bad[2], good // 4, [216, 0, 0, 0]))
    assert quality.chosen(*many[:2], few, 0.02, 0.05 / 4) == [None, None]


def test_copies_of_labelled_rows_are_one_trial(spark):
    """Ten rows of each labelled id show no more than one: with so few labels no rule gets a cutoff."""
    good = [(i, " ".join(f"word{j}" for j in range(40)) + f" {i}") for i in range(60)]
    bad = [(100 + i, " ".join(f"#{j}" for j in range(40)) + f" {i}") for i in range(20)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id long, quality int")
    for times in (1, 10):
        docs = spark.createDataFrame([(*r, "en") for r in (good + bad) * times], "doc_id long, text string, lang string")
        kept = quality.judged(docs, labels, stage).where("_quality.kept").count()
        assert kept == 80 * times


def test_quality_of_awkward_rows(spark, awkward):
    docs = awkward.withColumnRenamed("source", "lang").withColumnRenamed("n_words", "_quality")
    labels = spark.createDataFrame([(1, 1), (1, 0), (6, None), (None, 1)], "doc_id long, quality int")
    for used in (labels, empty(labels)):
        judged = quality.judged(docs, used, stage)
        assert judged.columns == [*docs.columns, "__quality"]
        rows = judged.select("text", "__quality.kept", "__quality.base_failed").collect()
        assert len(rows) == docs.count()
        for r in rows:
            m = plain.measures(r["text"])
            assert r["base_failed"] == (m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"])
            assert r["kept"] == (not r["base_failed"])
    assert quality.judged(empty(docs), labels, stage).count() == 0


# 7: sentence spans


def test_repeated_spans_are_cut(documents, awkward):
    docs = documents.select("doc_id", "text", "source")
    rows = texts(docs)
    want = plain.repeated_sentences(rows)
    got = {r["doc_id"]: r for r in sentence_spans.without_repeated_spans(docs, stage).collect()}
    assert sum(map(len, want.values())) > 0
    for doc, text in rows:
        bounds = sentence_spans.sentences(text)
        assert got[doc]["text"] == "".join(text[a:b] for i, (a, b) in enumerate(bounds) if i not in want[doc])
        assert got[doc]["_cut"]["n_removed"] == len(want[doc])


def test_spans_of_awkward_rows(awkward):
    out = sentence_spans.without_repeated_spans(awkward, stage)
    assert out.columns == [*awkward.columns, "_cut"]
    assert sorted(map(str, out.drop("_cut").collect())) == sorted(map(str, awkward.collect()))
    assert sentence_spans.without_repeated_spans(empty(awkward), stage).count() == 0


def test_passage_within_other_texts(spark):
    passage = "This passage is here. It has some sentences. They are not very long. Yet they repeat. And go on and on."
    rows = [(1, f"First start. {passage} First end."), (2, f"Other words\n{passage}\nMore."), (3, "Nothing of it. At all. Is here. Or there.")]
    out = sentence_spans.without_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), stage)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == {1: rows[0][1], 2: "Other words\nMore.", 3: rows[2][1]}


def repeated_words(rows, size=50):
    """(doc_id, first word, word behind) of the stretches whose runs of ``size`` words all occur in an earlier row."""
    seen, found = set(), []
    for doc, text in sorted(rows):
        tokens = textual.lowered_words(text)
        runs = [tuple(tokens[i : i + size]) for i in range(len(tokens) - size + 1)]
        for i in (i for i, r in enumerate(runs) if r in seen):
            if found and found[-1][0] == doc and found[-1][2] == i + size - 1:
                found[-1][2] += 1
            else:
                found.append([doc, i, i + size])
        seen.update(runs)
    return found


def left_of(text, removed):
    """Whether each word lies outside all removed stretches."""
    gone = [tuple(map(int, r.split(":"))) for r in removed.split(",") if r]
    return [not any(a <= m.start() < b for a, b in gone) for m in plain.WORD.finditer(text)]


def test_no_repeated_stretch_of_50_words_stays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = texts(docs)
    words = [f"w{i}" for i in range(400)]  # no sentence at all, one, and other white space and case
    rows += [(10**9, " ".join(words)), (10**9 + 1, "a b " + "\n".join(words[90:140]).upper() + " c"), (10**9 + 2, "d. " + " ".join(words[200:251]) + ". e")]
    found = repeated_words(rows)
    assert len(found) > 20
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = sentence_spans.without_repeated_spans(docs, stage, shared=50).collect()
    given = dict(rows)
    left = {r["doc_id"]: left_of(given[r["doc_id"]], r["_cut"]["removed"]) for r in out}
    missed = [f for f in found if "1" * 50 in "".join(map(str, map(int, left[f[0]][f[1] : f[2]])))]
    assert not missed
    for r in out:
        gone = [tuple(map(int, x.split(":"))) for x in r["_cut"]["removed"].split(",") if x]
        assert len(r["text"]) == len(given[r["doc_id"]]) - sum(b - a for a, b in gone)
    less = sentence_spans.without_repeated_spans(docs, stage).collect()
    assert {r["doc_id"]: r["text"] for r in less} != {r["doc_id"]: r["text"] for r in out}


def test_runs_reach_the_words_that_count(spark):
    short = "Thank you. See you soon. Good bye."
    long = " ".join(f"Sentence {k} of this passage goes on for {k} words or so." for k in range(10, 18))
    rows = [(1, f"One text. {short}"), (2, f"Another text. {short}"), (3, f"It begins here. {long} It ends."), (4, f"Other start. {long} Other end.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in sentence_spans.without_repeated_spans(docs, stage, shared=50).collect()}
    assert got == {**dict(rows), 4: "Other start. Other end."}
    counts = {1: "a b. ", 2: "c d e. ", 3: "f. ", 4: "g h i j k. "}
    text = "".join(counts.values())
    assert sentence_spans._runs(text, sentence_spans.sentences(text), 2, 6).tolist() == [3, 4, 4]
    assert sentence_spans._runs(text, sentence_spans.sentences(text), 2, None).tolist() == [2, 3, 4]
    assert sentence_spans._runs("", [], 2, 6).tolist() == []


def test_word_form_of_awkward_rows(awkward):
    out = sentence_spans.without_repeated_spans(awkward, stage, shared=50)
    assert out.columns == [*awkward.columns, "_cut"] and out.count() == awkward.count()
    kept = [(r["doc_id"], r["text"]) for r in out.select("doc_id", "text").collect()]
    given = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    assert sum(t is None for _, t in kept) == sum(t is None for _, t in given)
    few = [x for x in given if x[1] is not None and len(x[1].split()) < 21]
    assert all(kept.count(x) >= given.count(x) for x in few)  # short texts are never cut
    assert sentence_spans.without_repeated_spans(empty(awkward), stage, shared=50).count() == 0


def test_equal_rows_and_repeated_words(spark):
    text, same = " ".join(f"w{i}" for i in range(120)), "ha " * 99 + "ha"
    rows = [(1, text, "x"), (1, text, "y"), (1, text, "y"), (2, same, "z"), (3, None, "z"), (3, None, "z"), (4, "few words", "z"), (4, "few words", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _at string")
    out = sentence_spans.without_repeated_spans(docs, stage, shared=50)
    assert out.columns == [*docs.columns, "_cut"]
    got = sorted((r["doc_id"], r["text"] or "") for r in out.collect())
    assert got[:3] == [(1, ""), (1, ""), (1, text)] and got[4:] == [(3, ""), (3, ""), (4, "few words"), (4, "few words")]
    assert 21 <= len(got[3][1].split()) < 50


def test_words_of_a_window_always_share_a_span():
    draws = random.Random(11)
    for shared in (5, 23, 50):
        wide, narrow, least = sentence_spans.reach(shared)
        assert narrow >= 1 and least >= wide >= 1 and wide + 2 * narrow + least <= shared + 1
        for _ in range(300):
            common = [draws.choice("abcd") + draws.choice(["", "", "", "."]) + str(draws.randint(0, 9)) + draws.choice(["", "", "."]) for _ in range(shared)]
            a, b = ([f"{side}{i}" + draws.choice(["", "."]) for i in range(draws.randint(0, 40))] for side in "xy")
            one, two = " ".join(a + common + b), " ".join(b + common + a)
            x, y = (sentence_spans.word_spans(t, shared)[0] for t in (one, two))
            assert set(x.tolist()) & set(y.tolist())


def test_sentences_make_up_the_text():
    for text in ("", "a", "a. b", "a.b c!? d\n\n e.", "\n", ". . .", "x.\n"):
        assert "".join(text[a:b] for a, b in sentence_spans.sentences(text)) == text


def test_helpers(spark):
    assert textual.free_name(["_x", "__X"], "_x") == "___x"
    docs = spark.createDataFrame([("a  b c\td",), (None,), ("",), (" \n",)], "text string")
    assert [r[0] for r in docs.select(textual.n_words(docs["text"])).collect()] == [3, 0, 0, 0]


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_runs(spark, name):
    df = queries.QUERIES[name][0](spark, SF)
    assert df.count() > 0


def test_whole_splits_are_worked_off_in_slices(spark):
    """One Arrow batch with 40 MB of texts never becomes Python strings as a whole, and all rows stay."""
    def batch():
        texts = [f"{i} " + "word " * 2000 for i in range(4000)]
        texts[1], texts[2], texts[3] = None, "", "x" * (textual.SLICE + 1)
        return pa.RecordBatch.from_pydict({"id": range(4000), "text": texts})

    whole = batch()
    parts = list(textual.sliced(iter([whole]), 1))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([whole]))
    sizes = [sum(len(t or "") for t in p.column(1).to_pylist()) for p in parts]
    assert all(n <= textual.SLICE or p.num_rows == 1 for n, p in zip(sizes, parts)) and len(parts) < 20

    docs = spark.createDataFrame([(i, f"{i} " + "word " * 2000) for i in range(1200)], "doc_id long, text string")
    seen = textual.append(docs.coalesce(1), "text", "n", LongType(), lambda texts: [sum(map(len, texts))] * len(texts))
    rows = seen.select("doc_id", "n").collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(1200))
    assert max(r["n"] for r in rows) <= textual.SLICE


def test_repeated_shingles_are_those_of_two_sets_or_more():
    draws = np.random.default_rng(5)
    sets = [np.unique(draws.integers(0, 300, n).astype(np.uint64)) for n in (0, 1, 50, 200, 200)]
    value, n = np.unique(np.concatenate(sets), return_counts=True)
    found, times = jaccard.repeated(list(sets))
    assert found.tolist() == value[n > 1].tolist() and times.tolist() == n[n > 1].tolist()
    assert all(len(x) == 0 for x in jaccard.repeated([]))


def test_passes_give_freed_memory_back(spark, monkeypatch):
    """A worker keeps little more after a task than what is still used, though blocks between are."""
    rollup, trim = "/proc/self/smaps_rollup", getattr(ctypes.CDLL(None), "malloc_trim", None)
    if not trim or not os.path.exists(rollup):
        pytest.skip("needs glibc and Linux")

    def held():
        with open(rollup) as f:
            return next(int(x.split()[1]) for x in f if x.startswith("Anonymous:")) >> 10

    used = []

    def make(texts):
        blocks = [np.ones(250) for _ in range(60_000)]  # 120 MB
        used.extend(blocks[::20_000] + blocks[-1:])
        return [len(t) for t in texts]

    runs = []
    docs = spark.createDataFrame([], "doc_id long, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append(run))
    textual.append(docs, "text", "n", LongType(), make)
    trim(0)
    before = held()
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["a b", None], "_text": ["a b", None]})
    out = list(runs[0](iter([batch])))
    assert out[0].column("n").to_pylist() == [3, 0]
    assert held() - before < 40
