"""Each stage of the pipeline against a plain version, on what the stage before kept."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import plain

import corpus_pipeline
from ionweave.staging import stage

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    step = dict(corpus_pipeline.STAGES)

    good = stage(step[names[0]](spark, docs, SF))
    assert good.columns == docs.columns
    kept = {r["doc_id"] for r in good.collect()}
    for r in docs.collect():
        m = plain.measures(r["text"])
        failed = m["n_words"] < 10 or 100 * m["n_repeat_words"] > 20 * m["n_words"]
        assert not (failed and r["doc_id"] in kept)

    single = stage(step[names[1]](spark, good, SF))
    want = {c for _, n, c in plain.jaccard_components([(r["doc_id"], r["text"]) for r in good.collect()]) if n}
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(want)

    clean = stage(step[names[2]](spark, single, SF))
    assert clean.columns == docs.columns and clean.count() == single.count()
    assert not any(plain.private(r["text"]) for r in clean.collect())

    mixed = stage(step[names[3]](spark, clean, SF))
    assert mixed.columns == docs.columns
    sizes, taken, largest = {}, {}, {}
    for rows, into in ((clean, sizes), (mixed, taken)):
        for r in rows.collect():
            n = len(plain.WORD.findall(r["text"]))
            into[r["source"]] = into.get(r["source"], 0) + n
            largest[r["source"]] = max(largest.get(r["source"], 0), n)
    for s, target in plain.targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= largest[s]

    packed = step[names[4]](spark, mixed, SF).collect()
    assert sum(r["length"] for r in packed if r["start"] == 0) > 0
    per_sequence = {}
    for r in packed:
        per_sequence[r["sequence_id"]] = per_sequence.get(r["sequence_id"], 0) + r["length"]
    assert max(per_sequence.values()) <= 2048
    assert sum(2048 - n for n in per_sequence.values()) < 2048


def test_components_without_ids_of_their_own(spark):
    """Unlike texts with null ids or the same id all stay; copies among them go."""
    def text(name):
        return " ".join(f"{name}{i}" for i in range(40))

    rows = [(None, text("a")), (None, text("b")), (None, text("b") + " end"), (7, text("c")), (7, text("d")), (8, text("d")), (None, ""), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()]
    assert len(kept) == 6
    assert {(None, text("a")), (7, text("c")), (7, text("d")), (None, ""), (7, None)} < set(kept)
    assert sum((t or "").startswith("b0 ") for _, t in kept) == 1
