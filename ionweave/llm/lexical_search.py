"""Ranked search for words, with the terms dealt over owners that work one after another.

Posting lists belong to owners of terms.  Items travel in bundles from owner to owner; each adds what its own terms
contribute and hands on the sparse accumulators (document, score) with the terms that are still to come.  Every
step is a cogroup of bundles with the owner's postings.  Terms of more than one in ``FREQUENT`` documents belong to the last owner, all
others are dealt by hash over the owners before it, so that accumulators are short while they travel.

Bundles and postings are cut by slices of documents, by a hash of a stored row number: no task holds more than ``BUNDLE`` items and
about ``SLICE`` documents, however many documents hold a term.  The last owner keeps the best ``top`` of each item and slice,
and a window with a group limit the best of all slices.

A term is a run of characters other than ASCII signs and white space, with A-Z in lower case.  With N documents that hold a
term, L terms in them, n terms of one document, df documents of a term, tf places of the term in a document::

    w = floor(1000 * ln((2 N + 2) / (2 df + 1)))        m = 100 - 50 + (50 n N) div L
    score = sum over the item's distinct terms of w * ((1000000000 tf) div (1000 tf + 20 m))

Contributions are 64-bit integers, so their order is of no account.  Of the documents' terms only those that may be in an item are kept, told by a bounded
bitmap of hashes; other terms that pass it are dropped by name.  The set of frequent terms, which tasks get
whole, has at most ``FREQUENT`` times as many terms as a document has different terms of items on average.

Defined results: a null or empty text has no terms, and is neither counted nor found; a null or empty item finds nothing; each row of
either table counts for itself, also with a repeated or null id; equal scores go by ascending document id, null
last, then by stored row; documents of score 0 are left out.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType
from xxhash import xxh64_intdigest

from ionweave.llm.bitmaps import bits_for, is_set, key_bitmap
from ionweave.llm.textual import append, strings
from ionweave.llm.tokens import Kept

TOP = 50
BUNDLE = 256  # items that travel together, about
SLICE = 8_192  # documents that meet a bundle in one task, about
OWNERS = 3
FREQUENT = 64

_SEED = 42  # of Spark's xxhash64
_TERM = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)

Stage = Callable[[DataFrame], DataFrame]


def terms(text: str) -> list[bytes]:
    """Terms of a text, in order, as UTF-8."""
    return text.encode().translate(_TERM).split()


def _lists(sizes: list[int], values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), values)


def postings(docs: DataFrame, wanted: np.ndarray, rare_owners: int, id_col: str, text_col: str) -> DataFrame:
    """Per document with a term: ``doc_id``, ``n``, and its terms that may be in an item with ``tf`` and owner by hash."""
    bitmap = docs.sparkSession.sparkContext.broadcast(wanted)
    schema = "doc_id long, n long, terms array<string>, tf array<long>, owner array<byte>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def owner_of(term: bytes) -> int:
            h = xxh64_intdigest(term, _SEED)
            return h % rare_owners if is_set(bitmap.value, np.array([h], np.uint64))[0] else -1

        owners = Kept(owner_of, 500_000)
        for batch in batches:
            rows, n, sizes, flat, tf, own = [], [], [], [], [], []
            for i, text in enumerate(strings(batch.column(1)).to_pylist()):
                found = terms(text)
                if not found:
                    continue
                rows.append(i)
                n.append(len(found))
                kept = [(t, k, o) for t, k in Counter(found).items() if (o := owners[t]) >= 0]
                sizes.append(len(kept))
                flat += [x[0] for x in kept]
                tf += [x[1] for x in kept]
                own += [x[2] for x in kept]
            names = pa.array(flat, pa.binary()).cast(pa.string())
            lists = [_lists(sizes, v) for v in (names, pa.array(tf, pa.int64()), pa.array(own, pa.int8()))]
            ids = batch.column(0).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), *lists], ["doc_id", "n", "terms", "tf", "owner"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`")).mapInArrow(run, schema)


def weights(items: DataFrame, posted: DataFrame, n_docs: int) -> DataFrame:
    """``term``, ``df`` and ``w`` of the terms of items, also of those in no document."""
    df = posted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    wanted = items.select(F.explode("terms").alias("term")).distinct().join(df, "term", "left")
    wanted = wanted.withColumn("df", F.coalesce("df", F.lit(0).cast("long")))
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    return wanted.withColumn("w", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long"))


def _each(n: int) -> Column:
    """Rows for 0 to n - 1."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _of_owner(posted: DataFrame, owner: int, last: int, frequent: list[str], n_bundles: int) -> DataFrame:
    """The owner's postings for every bundle; the last owner names all documents that can be found."""
    sent = posted.sparkSession.sparkContext.broadcast(frequent)
    schema = "slice long, row long, doc_id long, n long, terms array<string>, tf array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = pa.array(sent.value, pa.string())
        for batch in batches:
            lists = batch.column(4)
            names, tf, own = lists.flatten(), batch.column(5).flatten(), batch.column(6).flatten()
            parent = pc.list_parent_indices(lists).to_numpy()
            often = pc.is_in(names, value_set=common).to_numpy(zero_copy_only=False).astype(bool)
            mine = often if owner == last else ~often & (own.to_numpy() == owner)
            sizes = np.bincount(parent[mine], minlength=len(batch))
            rows = pa.array(np.arange(len(batch)) if owner == last else np.flatnonzero(sizes))
            at = pa.array(np.flatnonzero(mine))
            made = [_lists(sizes[rows.to_numpy()], v.take(at)) for v in (names, tf)]
            yield pa.RecordBatch.from_arrays([*(c.take(rows) for c in batch.columns[:4]), *made], ["slice", "row", "doc_id", "n", "terms", "tf"])

    held = posted.where(F.size("terms") > 0).select("slice", "row", "doc_id", "n", "terms", "tf", "owner")
    own = held.mapInArrow(run, schema)
    return own.withColumn("bundle", _each(n_bundles))


_TRAVELS = (
    "slice long, bundle long, item long, item_id long, terms array<string>, w array<long>, owner array<byte>, "
    "docs array<long>, scores array<long>"
)
_FOUND = "item long, item_id long, doc_id long, row long, score long"


def contributions(w: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def _flat(column: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray]:
    """Values of a column of lists, and the row of each."""
    lists = column.combine_chunks()
    return lists.flatten(), pc.list_parent_indices(lists).to_numpy().astype(np.int64)


def _visit(items: pa.Table, docs: pa.Table, owner: int, n_docs: int, n_terms: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows of documents, and each item's scores over them after this owner has added its terms."""
    own_rows = docs["row"].to_numpy().astype(np.int64)
    before, before_of = _flat(items["docs"])
    before = before.to_numpy().astype(np.int64)
    scores = items["scores"].combine_chunks().flatten().to_numpy()
    rows = np.unique(np.concatenate([own_rows, before]))

    held, doc_of = _flat(docs["terms"])
    tf = docs["tf"].combine_chunks().flatten().to_numpy().astype(np.int64)
    asked, item_of = _flat(items["terms"])
    mine = items["owner"].combine_chunks().flatten().to_numpy() == owner
    asked, item_of = asked.take(pa.array(np.flatnonzero(mine))), item_of[mine]
    w_asked = items["w"].combine_chunks().flatten().to_numpy()[mine]
    vocabulary = pc.unique(asked)
    code_asked = pc.index_in(asked, value_set=vocabulary).to_numpy().astype(np.int64)
    w = np.zeros(len(vocabulary), np.int64)
    w[code_asked] = w_asked
    code = pc.fill_null(pc.index_in(held, value_set=vocabulary), -1).to_numpy().astype(np.int64)
    known = np.flatnonzero(code >= 0)
    known = known[np.argsort(code[known], kind="stable")]
    code, doc_of = code[known], doc_of[known]
    m = np.array([50 + 50 * n * n_docs // n_terms for n in docs["n"].to_pylist()], np.int64)
    value = contributions(w[code], tf[known], m[doc_of])
    place = np.searchsorted(rows, own_rows)[doc_of]
    bounds = np.searchsorted(code, np.arange(len(vocabulary) + 1))

    item_starts = np.searchsorted(item_of, np.arange(items.num_rows + 1))
    before_starts = np.searchsorted(before_of, np.arange(items.num_rows + 1))
    before_place = np.searchsorted(rows, before)
    out = []
    for i in range(items.num_rows):
        total = np.zeros(len(rows), np.int64)
        own = slice(before_starts[i], before_starts[i + 1])
        total[before_place[own]] = scores[own]
        for c in code_asked[item_starts[i] : item_starts[i + 1]]:
            term = slice(bounds[c], bounds[c + 1])
            total[place[term]] += value[term]  # a document has one posting of a term
        out.append(total)
    return rows, out


def _hand_on(owner: int, n_docs: int, n_terms: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(items: pa.Table, docs: pa.Table) -> pa.Table:
        rows, totals = _visit(items, docs, owner, n_docs, n_terms)
        at = [np.flatnonzero(t) for t in totals]
        sizes = [len(a) for a in at]
        kept = pa.array(rows[np.concatenate(at)] if at else [], pa.int64())
        scores = pa.array(np.concatenate([t[a] for t, a in zip(totals, at, strict=True)]) if at else [], pa.int64())
        later = pa.array(np.flatnonzero(items["owner"].combine_chunks().flatten().to_numpy() > owner))
        parent = _flat(items["owner"])[1][later.to_numpy()]
        left = np.bincount(parent, minlength=items.num_rows)
        lists = {c: _lists(left, items[c].combine_chunks().flatten().take(later)) for c in ("terms", "w", "owner")}
        lists |= {"docs": _lists(sizes, kept), "scores": _lists(sizes, scores)}
        for name, values in lists.items():
            items = items.set_column(items.column_names.index(name), name, values)
        return items

    return run


def _finish(owner: int, n_docs: int, n_terms: int, top: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(items: pa.Table, docs: pa.Table) -> pa.Table:
        rows, totals = _visit(items, docs, owner, n_docs, n_terms)
        order = np.argsort(docs["row"].to_numpy())
        no_id = docs["doc_id"].is_null().to_numpy().astype(bool)[order]
        ids = pc.fill_null(docs["doc_id"], 0).to_numpy()[order]
        chosen, scores = [], []
        for total in totals:
            at = np.flatnonzero(total)
            if len(at) > top:
                at = at[total[at] >= np.partition(total[at], -top)[-top]]
            at = at[np.lexsort((rows[at], ids[at], no_id[at], -total[at]))][:top]
            chosen.append(at)
            scores.append(total[at])
        sizes = [len(a) for a in chosen]
        at = np.concatenate(chosen) if chosen else np.empty(0, np.int64)
        of = pa.array(np.repeat(np.arange(items.num_rows), sizes))
        found_ids = pa.array(ids[at], pa.int64(), mask=no_id[at])
        score = np.concatenate(scores) if scores else np.empty(0, np.int64)
        return pa.table(
            [items["item"].take(of), items["item_id"].take(of), found_ids, pa.array(rows[at], pa.int64()), pa.array(score, pa.int64())],
            ["item", "item_id", "doc_id", "row", "score"],
        )

    return run


def search(
    docs: DataFrame,
    items: DataFrame,
    stage: Stage,
    top: int = TOP,
    owners: int = OWNERS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    slice_docs: int = SLICE,
    bundle_items: int = BUNDLE,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id`` and ``score`` of each item's best ``top`` documents.  Ids are integers.  Runs at once; ``stage`` stores a table."""
    if owners < 2:
        raise ValueError("owners must be 2 or more")
    spark = docs.sparkSession
    named = items.select(F.col(f"`{item_id_col}`").cast("long").alias("item_id"), F.col(f"`{item_text_col}`").alias("text"))
    listed = append(named, "text", "terms", ArrayType(StringType()), lambda ts: [sorted({t.decode() for t in terms(x)}) for x in ts], ["item_id"])
    listed = stage(listed.withColumn("item", F.monotonically_increasing_id()))
    n_items, n_wanted = listed.agg(F.count("*"), F.sum(F.size("terms"))).first()
    last = owners - 1
    asked = listed.select(F.explode("terms").alias("term"))
    wanted = key_bitmap(asked, F.xxhash64("term"), bits_for(n_wanted or 0, 64))

    posted = stage(postings(docs, wanted, last, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    n_docs, n_terms = posted.agg(F.count("*"), F.sum("n")).first()
    n_slices = max(-(-n_docs // slice_docs), int(spark.conf.get("spark.sql.shuffle.partitions")))
    n_bundles = max(1, -(-n_items // bundle_items))
    posted = posted.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(n_slices)))
    weighed = stage(weights(listed, posted, n_docs))
    often = F.col("df") * FREQUENT > n_docs
    frequent = [r["term"] for r in weighed.where(often).select("term").toLocalIterator()]

    hashed = F.xxhash64("term")  # signed, while the tasks take it as unsigned
    unsigned = F.when(hashed >= 0, F.pmod(hashed, F.lit(last))).otherwise(
        F.pmod(F.pmod(hashed, F.lit(last)) + F.lit((1 << 64) % last), F.lit(last))
    )
    owned = weighed.select("term", "w", F.when(often, F.lit(last)).otherwise(unsigned).cast("byte").alias("owner"))
    parts = listed.select("item", "item_id", F.explode("terms").alias("term")).join(owned, "term")
    bundles = (
        parts.groupBy("item", "item_id")
        .agg(F.array_sort(F.collect_list(F.struct("term", "w", "owner"))).alias("t"))
        .select(
            _each(n_slices).alias("slice"),
            F.pmod(F.xxhash64("item"), F.lit(n_bundles)).alias("bundle"), "item", "item_id",
            F.col("t.term").alias("terms"), F.col("t.w").alias("w"), F.col("t.owner").alias("owner"),
            F.array().cast("array<long>").alias("docs"), F.array().cast("array<long>").alias("scores"),
        )
    )
    key = ["slice", "bundle"]
    for owner in range(owners):
        lists = _of_owner(posted, owner, last, frequent, n_bundles)
        meet = bundles.groupBy(*key).cogroup(lists.groupBy(*key))
        if owner < last:
            bundles = meet.applyInArrow(_hand_on(owner, n_docs, n_terms), _TRAVELS)
        else:
            found = meet.applyInArrow(_finish(owner, n_docs, n_terms, top), _FOUND)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
