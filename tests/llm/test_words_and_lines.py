"""Ranked search, repeated lines and spelling variants against plain versions, also on awkward rows."""

import os
import sys

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import plain
from ionweave.llm import bitmaps, lexical_search, line_dedup, queries, spelling
from ionweave.staging import stage

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, n long, rank string, _row long, _lines int, word string, score int"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows and ids, ties, and columns named as in results."""
    line, other = "This line is in some of the documents.", "Another line that is long enough"
    long = " ".join(f"wordnumber{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]} x{i}" for i in range(30_000))
    texts = [
        (1, None), (2, ""), (3, " \n\t \n"), (4, line), (5, f"  {line.upper()}\t\nkeep me"), (6, f"{line}\n{line}\r\n{other}"),
        (7, other), (7, other), (7, f"{other}\nand more"), (None, line), (None, line), (None, "é ü İ ß Æquator ænigmaticus"),
        (8, long), (9, long + "\n" + "z" * 30_000), (10, "z" * 30_000), (11, "z" * 29_999), (12, "separate seperate separate " * 30),
        (13, "Separate; SEPARATE seperate’separat\xa0separates"), (14, "a b c 1 2 3 ñandú ñandúes ÑANDÚES ×÷ naïvely naïvely naively naively " * 3),
        (14, "a b c 1 2 3 ñandú ñandúes ÑANDÚES ×÷ naïvely naïvely naively naively " * 3), (15, "\n".join(["x" * 19, "y" * 20, "y" * 21])),
        (16, "y" * 20), (17, " " + "Y" * 20), (18, "only null\x00between\x00words and\x85more words"),
    ]
    return spark.createDataFrame([(*t, 1, "r", 2, 3, "w", 4) for t in texts], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def items(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def plainly(rows):
    return sorted(map(str, rows))


# search


def test_search(spark, documents, awkward, items):
    own = [(5, "this LINE separate"), (5, "this LINE separate"), (None, "ñandú naïvely"), (6, None), (7, ""), (8, " .,"), (9, "nowhere9 x7"), (10, "a b c d é y")]
    strange = spark.createDataFrame([(*x, 0, 0) for x in own], "item_id long, text string, doc_id int, terms int")
    for docs in (documents, awkward):
        for asked in (items, strange) if docs is awkward else (items,):
            pairs = [(r["item_id"], r["text"]) for r in asked.collect()]
            want = plainly(plain.ranked(texts(docs), pairs))
            for settings in ({}, {"slice_docs": 3, "bundle_items": 2, "owners": 4}) if asked is strange else ({},):
                found = lexical_search.search(docs, asked, stage, **settings)
                assert plainly(tuple(r) for r in found.collect()) == want
    assert lexical_search.search(awkward.limit(0), items, stage).count() == 0
    assert lexical_search.search(awkward, items.limit(0), stage).count() == 0
    with pytest.raises(ValueError):
        lexical_search.search(documents, items, stage, owners=1)


def test_ranks_of_ties(spark):
    docs = spark.createDataFrame([(i % 97, "same words here") for i in range(300)] + [(None, "same words here")], "doc_id long, text string")
    rows = lexical_search.search(docs, spark.createDataFrame([(1, "words")], "item_id long, text string"), stage).collect()
    assert [(r["rank"], r["doc_id"]) for r in sorted(rows, key=lambda r: r["rank"])] == list(zip(range(1, 51), sorted(i % 97 for i in range(300))))
    few = lexical_search.search(docs.where("doc_id is null or doc_id < 2"), spark.createDataFrame([(1, "words")], "item_id long, text string"), stage)
    assert few.orderBy("rank").collect()[-1]["doc_id"] is None


def test_contributions_are_whole_numbers():
    tf, m = np.array([1, 2, 10**9], np.int64), np.array([50, 10**6, 3], np.int64)
    got = lexical_search.contributions(np.array([7, 25_000, 25_000], np.int64), tf, m)
    assert got.tolist() == [w * ((10**9 * t) // (1000 * t + 20 * k)) for w, t, k in zip((7, 25_000, 25_000), tf.tolist(), m.tolist())]


# lines


def test_lines(documents, awkward):
    for docs in (documents, awkward, awkward.limit(0)):
        want = plainly(plain.without_lines(texts(docs)))
        for settings in ({}, {"most_bits": 1 << 16, "rows_per_task": 2}) if docs is awkward else ({},):
            out = line_dedup.without_repeated_lines(docs, stage, **settings)
            report = out.columns[-1]
            got = [(r["doc_id"], r[report]["n_lines"], r[report]["n_dropped"], r["text"] or "") for r in out.collect()]
            assert plainly(got) == want
            assert out.columns[:-1] == docs.columns
            assert out.where("text is null").count() == docs.where("text is null").count()
    with pytest.raises(ValueError):
        line_dedup.without_repeated_lines(documents, stage, least=1)


def test_filters_lose_no_repeat():
    draws = np.random.default_rng(3)
    parts = [draws.integers(0, 1 << 63, (2_000, 2)).astype(np.uint64) for _ in range(4)]
    parts[1][:50], parts[3][50:80], parts[2][-1] = parts[0][:50], parts[1][100:130], parts[2][0]
    whole = line_dedup.Filters(1 << 18, 4)
    for p in parts:
        own = line_dedup.Filters(1 << 18, 4)
        own.add(p)
        line_dedup.merge(whole.once, whole.twice, own.once, own.twice)
    repeats = np.concatenate([parts[0][:50], parts[3][50:80], parts[2][:1]])
    assert whole.suspected(repeats).all()
    assert whole.suspected(draws.integers(0, 1 << 63, (5_000, 2)).astype(np.uint64)).mean() < 0.01
    assert whole.suspected(np.concatenate(parts)).mean() < 0.2


# spelling


def test_spelling(documents, awkward):
    for docs in (documents, awkward, awkward.limit(0)):
        want = plainly(plain.spelling(texts(docs)))
        for settings in ({"symbols": 1}, {"symbols": 40}) if docs is awkward else ({},):
            got = [tuple(r) for r in spelling.variants(docs, stage, **settings).collect()]
            assert plainly(got) == want


def test_chains_of_forms(spark):
    rows = [(n, w) for w, n in (("abcdefgh", 30_000), ("abcdefgx", 2_000), ("abcdefyx", 150), ("abcdezyx", 12), ("abcdezyxw", 2))]
    table = spark.createDataFrame(rows, "n long, word string").withColumn("wid", F.monotonically_increasing_id())
    table = stage(spelling.forms(stage(table)))
    got = {r["word"]: r["root"] for r in spelling.roots(table, stage).collect()}
    assert got == {"abcdefgx": "abcdefgh", "abcdefyx": "abcdefgh", "abcdezyx": "abcdefgh"}


def test_neighbourhood_holds_every_edit():
    draws = np.random.default_rng(5)
    for length in (1, 2, 3, 7, 8, 12):
        for _ in range(40):
            word = "".join(draws.choice(list("abcdeé"), length))
            keys = {int(k) for made in spelling.Words([word], 3).neighbours(0, length + 1) for k in made.ravel()}
            in_parts = {int(k) for p in range(0, length + 1, 2) for made in spelling.Words([word], 3).neighbours(p, p + 2) for k in made.ravel()}
            assert keys == in_parts
            for near in plain.one_edit(word, "abcdeé"):
                if near:
                    assert keys & {int(k[0]) for k in spelling.Words([near], 3).own()}


def test_bitmaps(spark):
    keys = spark.range(1000).selectExpr("xxhash64(id) as k")
    bitmap = bitmaps.key_bitmap(keys, keys["k"], 1 << 20)
    numbers = np.array([r[0] for r in keys.collect()], np.int64).view(np.uint64)
    assert bitmaps.is_set(bitmap, numbers).all() and 900 < np.unpackbits(bitmap).sum() <= 1000
    assert bitmaps.bits_for(0, 16) == 1 << 16 and bitmaps.bits_for(1 << 40, 16) == bitmaps.MOST_BITS


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_line_dedup", "op13_spelling"])
def test_twins(spark, name):
    run, sql = queries.QUERIES[name]
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = run(spark, SF), con.sql(sql)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert plainly(tuple(r) for r in got.select(*columns).collect()) == plainly(want.select(*columns).fetchall())
