"""N-gram Jaccard join: documents whose sets of word shingles are similar, and their components.

1. Documents with equal sets are one node.  A node's shingles are put into one order for all: those
   found often last, by how often, else by hash.  Only the first ones (a quarter at 75 percent) are kept;
   two similar sets must share one of them.
2. Shingles that only one node has are dropped.  Sizes and the positions of a shared shingle bound the overlap
   from above.  The nodes of a shingle that at most ``FEW`` have are sorted by size and paired at once.
   Others make tiles of (shingle, size band): a node is in those of its own band and of the bands
   of smaller partners.
3. In each tile all nodes are first compared with one leader, which has the fewest rare shingles.  Nodes
   found similar join a component.  Then only pairs of a tile in different components are left: a large
   group of copies is done after one comparison per copy, and no link between components is missed.
4. A pair is compared by bitmaps of hashed shingles first: bits that one has and the other lacks bound
   the overlap from above.  Pairs that pass are decided by exact intersection of the sorted arrays.

The table of frequent shingles has at most ``FREQUENT`` rows, the bitmaps that tell which shingles and documents are
worth moving have ``FILTER_BITS`` bits; nothing else gets to the driver.  Both only save work: a full bitmap lets more
rows through, and never changes a result.  Shingles and nodes are 64-bit hashes.

Defined results: a null or empty text has an empty set and is linked with nothing, its component is its
own id; equal rows share a component; a component's id ignores null ids.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ionweave.llm.components import components
from ionweave.llm.textual import lean, shingles, sliced

FREQUENT = 1_000_000  # rows of the table of frequent shingles, at most
OFTEN = 2  # a task reports shingles that so many of its documents have, 2 at least
FILTER_BITS = 1 << 27  # 16 MB
FEW = 16  # nodes of a shingle that are paired at once
BUCKET = 4_000_000  # shingles that meet in one task, about
_BITS_PER_SHINGLE = 2

Stage = Callable[[DataFrame], DataFrame]


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def frequent_shingles(
    docs: DataFrame, size: int, stage: Stage, text_col: str = "text"
) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles that many documents have, and how many have them.

    A count of shingles per class of frequency shows from which class on the table has ``FREQUENT`` rows
    at most; only these rows get to the driver.
    """

    @lean
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            value, n = repeated([shingles(t.as_py() or "", size) for t in batch.column(0)])
            often = n >= OFTEN
            kept.append(np.stack([_signed(value[often]), n[often]]))
        if kept:
            value, n = np.concatenate(kept, axis=1)
            yield pa.RecordBatch.from_pydict({"s": value, "n": n})

    reported = docs.select(F.col(f"`{text_col}`").alias("t")).mapInArrow(count, "s long, n long")
    often = F.floor(8 * F.log2("n")).cast("int")  # below 8 * 64
    counted = stage(reported.groupBy("s").agg(F.sum("n").alias("n")).withColumn("class", often))
    rows, least = 0, 8 * 64
    for r in sorted(counted.groupBy("class").agg(F.count("*").alias("rows")).collect(), reverse=True):
        rows += r["rows"]
        if rows > FREQUENT:
            break
        least = r["class"]
    top = counted.where(F.col("class") >= least).select("s", "n").toArrow()
    value, n = top["s"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(value)
    return value[order], n[order]


def repeated(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted values that more than one set has, and how many have them; ``sets`` is emptied to save its memory."""
    value = np.concatenate([np.empty(0, np.uint64), *sets])
    sets.clear()
    value.sort()
    again, n = np.unique(value[1:][value[1:] == value[:-1]], return_counts=True)  # each once less than in ``value``
    return again, n + 1


def prefix(found: np.ndarray, percent: int, value: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the common order, as many as a similar set cannot avoid."""
    size = len(found)
    keep = size - -(-percent * size // 100) + 1
    if not len(value):
        return found[:keep]
    at = np.minimum(np.searchsorted(value, found), len(value) - 1)
    often = np.where(value[at] == found, n[at], 0)
    return found[np.lexsort((found, often))[:keep]]


def _key(found: np.ndarray) -> int:
    """Node of a set, as a signed number."""
    return int(np.uint64(xxh3_64_intdigest(found.tobytes())).astype(np.int64))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a key that equal rows share."""
    ids, text = F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    return docs.select(ids, text, F.xxhash64(f"`{id_col}`", f"`{text_col}`").alias("key"))


def shingled(docs: DataFrame, frequent, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Per document: doc_id, key, node, n_shingles and, once per node and task, first shingles and bitmap."""
    rows = _rows(docs, id_col, text_col).select("doc_id", "key", "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, n = frequent.value
        seen: set[int] = set()  # one number for each distinct set of the task
        for batch in sliced(batches, 2):
            nodes, sizes, firsts, bits = [], [], [], []
            for text in batch.column(2).to_pylist():
                found = shingles(text or "", size)
                node = _key(found) if len(found) else None
                nodes.append(node)
                sizes.append(len(found))
                new = node is not None and node not in seen
                seen.add(node)
                firsts.append(_signed(prefix(found, percent, value, n)) if new else None)
                bits.append(_bitmap(found) if new else None)
            columns = [
                *batch.columns[:2], pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                pa.array(firsts, pa.list_(pa.int64())), pa.array(bits, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "node", "n_shingles", "first", "bits"])

    kind = f"doc_id {id_type}, key long, node long, n_shingles long, first array<long>, bits binary"
    return rows.mapInArrow(run, kind)


def _bitmap(found: np.ndarray) -> bytes:
    """Set bits at hashed places; a power of two of them, so that a longer one folds onto a shorter one."""
    bits = 1 << max(6, int(_BITS_PER_SHINGLE * len(found) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[((found >> np.uint64(13)) & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags).tobytes()


def overlap_bound(a: bytes, b: bytes, n_a: int, n_b: int) -> int:
    """At least the number of common shingles: each bit that one lacks stands for a shingle of the other."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] | y[len(y) // 2 :]
    return min(n_a - int(np.bitwise_count(x & ~y).sum()), n_b - int(np.bitwise_count(y & ~x).sum()))


def marked(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap with the place of every number of the single column set; its size is fixed."""
    place = F.pmod(F.col(keys.columns[0]), F.lit(bits)) + 1
    maps = keys.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m")
    )
    out = np.zeros(bits // 8, np.uint8)
    for r in maps.toLocalIterator():  # bits / 32768 rows of 4 KB at most
        out[(r["b"] - 1) * 4096 : r["b"] * 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    return out


def _among(values: np.ndarray, bitmap: np.ndarray) -> np.ndarray:
    """Whether the place of each number is set."""
    place = values & (8 * len(bitmap) - 1)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def shared_shingles(members: DataFrame) -> DataFrame:
    """The first shingles that more than one row has, in one shuffle of bare numbers.

    A batch sends a shingle on twice at most, so one that all documents have is no burden.
    """
    total = members.agg(F.sum(F.size("first"))).first()[0] or 0
    buckets = -(-total // BUCKET) * 2 + 1

    @lean
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, n = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            value = np.concatenate((value, value[n > 1]))
            bucket = (value.view(np.uint64) >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            value, bucket = value[order], bucket[order].astype(np.int64)
            own, first = np.unique(bucket, return_index=True)
            parts = np.split(value, first[1:]) if len(own) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int64()), pa.array([p.tobytes() for p in parts], pa.binary())], ["bucket", "some"]
            )

    def meet(table: pa.Table) -> pa.Table:
        value = np.concatenate([np.frombuffer(v, np.int64) for v in table.column("some").to_pylist()])
        value, n = np.unique(value, return_counts=True)
        return pa.table({"s": value[n > 1]})

    dealt = members.where("first IS NOT NULL").select("first").mapInArrow(deal, "bucket long, some binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "s long")


def shared_rows(members: DataFrame, frequent) -> DataFrame:
    """node, n, s, pos of the first shingles that may be shared; ``often`` if more than ``FEW`` nodes have it for sure."""
    bitmap = members.sparkSession.sparkContext.broadcast(marked(shared_shingles(members)))

    @lean
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, count = frequent.value
        hot = np.sort(_signed(value[count > FEW]))
        for batch in batches:
            lists = batch.column(2)
            bounds = lists.offsets.to_numpy().astype(np.int64)
            value = lists.flatten().to_numpy()
            owner = np.repeat(np.arange(len(lists)), np.diff(bounds))
            pos = np.arange(len(value)) - (bounds[:-1] - bounds[0])[owner]
            keep = np.flatnonzero(_among(value, bitmap.value))
            own, value = pa.array(owner[keep]), value[keep]
            often = np.isin(value, hot)
            columns = [batch.column(0).take(own), batch.column(1).take(own), *map(pa.array, (value, pos[keep], often))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "s", "pos", "often"])

    listed = members.where("first IS NOT NULL").select("node", "n_shingles", "first")
    return listed.mapInArrow(pick, "node long, n long, s long, pos long, often boolean")


def paired(rows: DataFrame, percent: int) -> DataFrame:
    """Possible pairs ``a``, ``b`` of the nodes of each shingle; the rows of shingles that more than ``FEW`` have.

    Pairs have null in ``s``, rows have their node in ``a`` and null in ``b``.  Rows come sorted by shingle and
    size, and a task holds no more than a batch and ``FEW`` rows.
    """

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = np.empty((0, 4), np.int64), None
        for batch in batches:
            held = np.concatenate((held, np.stack([c.to_numpy() for c in batch.columns], axis=1)))
            tail = held[:, 0] == held[-1, 0] if len(held) else np.empty(0, bool)
            wait = tail & (tail.sum() <= FEW) & (held[:, 0] != many)
            out, many = _meet(held[~wait], many, percent)
            held = held[wait]
            yield out
        if len(held):
            yield _meet(held, many, percent)[0]

    ordered = rows.select("s", "n", "pos", "node").repartition("s").sortWithinPartitions("s", "n", "node")
    return ordered.mapInArrow(run, "a long, b long, s long, n long, pos long")


def _meet(rows: np.ndarray, many: int | None, percent: int) -> tuple[pa.RecordBatch, int | None]:
    """Pairs and rows of whole groups, and the last group that is too large, which may go on."""
    s, n, pos, node = rows.T if len(rows) else np.empty((4, 0), np.int64)
    starts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.empty(0, np.int64)
    size = np.repeat(np.diff(np.concatenate((starts, [len(s)]))), np.diff(np.concatenate((starts, [len(s)]))))
    large = (size > FEW) | ((s == many) if many is not None else np.zeros(len(s), bool))
    pairs = [np.empty((0, 2), np.int64)]
    for d in range(1, FEW):
        i = np.flatnonzero((s[d:] == s[:-d]) & ~large[d:] & (node[d:] != node[:-d]))
        if not len(i):
            continue
        j, need = i + d, percent * (n[i] + n[i + d])  # n[j] is the larger one
        fits = (percent * n[j] <= 100 * n[i]) & ((100 + percent) * (n[i] - pos[i]) >= need)
        fits &= (100 + percent) * (n[j] - pos[j]) >= need
        pairs.append(np.sort(np.stack([node[i[fits]], node[j[fits]]], axis=1), axis=1))
    found, left = np.unique(np.concatenate(pairs), axis=0), np.flatnonzero(large)
    none, blank = pa.nulls(len(found), pa.int64()), pa.nulls(len(left), pa.int64())
    columns = [
        pa.concat_arrays([pa.array(x, pa.int64()), y])
        for x, y in (
            (found[:, 0], pa.array(node[left], pa.int64())), (found[:, 1], blank),
        )
    ] + [pa.concat_arrays([none, pa.array(c[left], pa.int64())]) for c in (s, n, pos)]
    out = pa.RecordBatch.from_arrays(columns, ["a", "b", "s", "n", "pos"])
    return out, (int(s[left[-1]]) if len(left) else many)


def node_sets(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """node and sorted set of the documents whose ``key`` is in ``wanted``, and of a few others."""
    bitmap = docs.sparkSession.sparkContext.broadcast(marked(wanted))

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in sliced(batches, 1):
            batch = batch.filter(pa.array(_among(batch.column(0).to_numpy(), bitmap.value)))
            nodes, sets = [], []
            for text in batch.column(1).to_pylist():
                found = shingles(text or "", size)
                node = _key(found)
                if node not in seen:
                    seen.add(node)
                    nodes.append(node)
                    sets.append(_signed(found))
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["node", "found"]
            )

    return _rows(docs, id_col, text_col).select("key", "text").mapInArrow(run, "node long, found array<long>")


def _similar(inner: Column, total: Column, percent: int) -> Column:
    """Whether ``inner`` common shingles of sets with ``total`` members together are enough."""
    return (100 + percent) * inner >= percent * total


def _sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """The pairs with columns of both nodes: those of ``a`` with a 1 behind their names, of ``b`` with a 2."""
    for side, number in (("a", 1), ("b", 2)):
        own = table.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}{number}") for c in columns])
        pairs = pairs.join(own, side)
    return pairs


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` that their bitmaps do not rule out."""

    @lean
    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                (100 + percent) * overlap_bound(x, y, n, m) >= percent * (n + m)
                for x, y, n, m in zip(*(c.to_pylist() for c in batch.columns[2:]))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = _sides(pairs, nodes, "bits", "n").select("a", "b", "bits1", "bits2", "n1", "n2")
    return both.mapInArrow(bounded, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose sets are similar, by exact intersection of the sorted arrays."""

    @lean
    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                inner = len(np.intersect1d(x, y, assume_unique=True))
                keep.append((100 + percent) * inner >= percent * (len(x) + len(y)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = _sides(pairs, sets, "found").select("a", "b", "found1", "found2")
    return both.mapInArrow(exact, "a long, b long")


def similar_components(
    docs: DataFrame,
    stage: Stage,
    size: int = 5,
    percent: int = 75,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: the id, ``n_shingles``, ``component_id`` (smallest id reachable by links), ``node``, ``key`` and ``root``.

    Ids may be null or repeat, so ``component_id`` names a component but does not tell it from others; ``root``, its
    smallest node, does.  ``stage`` stores a table; the steps run at once.
    """
    if not 0 < percent <= 100 or size < 1:
        raise ValueError("percent must be in 1..100 and size at least 1")
    frequent = docs.sparkSession.sparkContext.broadcast(frequent_shingles(docs, size, stage, text_col))  # at most 16 MB
    members = stage(shingled(docs, frequent, size, percent, id_col, text_col))
    nodes = stage(
        members.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.max("n_shingles").alias("n"), F.min("doc_id").alias("least"), F.min("key").alias("key"),
            F.first("bits", ignorenulls=True).alias("bits"),
        )
    )
    rows = stage(shared_rows(members, frequent))
    met = stage(paired(rows.where(~F.col("often")), percent))
    many = rows.where("often").select("node", "n", "s", "pos").union(
        met.where("s IS NOT NULL").select(F.col("a").alias("node"), "n", "s", "pos")
    )
    tiled = stage(_tiles(many, percent))

    leaders = tiled.groupBy("s", "band").agg(F.min(F.struct("pos", "node", "n")).alias("l"))
    starred = tiled.join(leaders, ["s", "band"]).where("node <> l.node")
    close = _possible(F.col("n"), F.col("pos"), F.col("l.n"), F.col("l.pos"), percent)
    stars = _pairs(starred.where(close), F.col("node"), F.col("l.node"))
    first = stage(met.where("s IS NULL").select("a", "b").union(stars).distinct())

    def links_of(pairs: DataFrame) -> DataFrame:
        pairs = stage(likely(pairs, nodes, percent))
        used = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        wanted = nodes.select("node", "key").join(used, "node").select("key")
        sets = stage(node_sets(docs, wanted, size, id_col, text_col))
        found, distinct = sets.agg(F.count("*"), F.count_distinct("node")).first()
        if found > distinct:  # rows repeated in several tasks
            sets = stage(sets.dropDuplicates(["node"]))
        return stage(verified(pairs, sets, percent))

    links = links_of(first)
    roots = components(links, stage)

    placed = stage(tiled.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    mixed = placed.groupBy("s", "band").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi")
    open_tiles = stage(placed.join(mixed.select("s", "band"), ["s", "band"], "left_semi"))
    x, y = open_tiles.alias("x"), open_tiles.where("own").alias("y")
    close = _possible(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"), percent)
    smaller = (F.col("y.n") < F.col("x.n")) | ((F.col("y.n") == F.col("x.n")) & (F.col("y.node") < F.col("x.node")))
    same_tile = (F.col("x.s") == F.col("y.s")) & (F.col("x.band") == F.col("y.band"))
    apart = x.join(y, same_tile & (F.col("x.root") != F.col("y.root")) & smaller & close)
    second = stage(_pairs(apart, F.col("x.node"), F.col("y.node")).join(first, ["a", "b"], "left_anti"))
    if not second.isEmpty():
        links = stage(links.union(links_of(second)))
        roots = components(links, stage)
    return _named(members, nodes, roots)


def _tiles(rows: DataFrame, percent: int) -> DataFrame:
    """Rows in the tiles of their size band and of the bands of smaller partners; ``own`` marks the first."""
    step = math.log(100 / percent) if percent < 100 else 1.0

    def band(n: Column) -> Column:
        return F.floor(F.log(n) / F.lit(step)).cast("int")

    least = F.ceil(F.col("n") * percent / 100)
    spread = rows.withColumn("band", F.explode(F.sequence(band(least), band(F.col("n")))))
    return spread.withColumn("own", F.col("band") == band(F.col("n")))


def _possible(n: Column, pos: Column, m: Column, at: Column, percent: int) -> Column:
    """Whether two sets can be similar whose first common shingle stands at ``pos`` and ``at``."""
    total = n + m
    sizes = (100 * F.least(n, m)) >= (percent * F.greatest(n, m))
    return sizes & _similar(n - pos, total, percent) & _similar(m - at, total, percent)


def _pairs(df: DataFrame, a: Column, b: Column) -> DataFrame:
    return df.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _named(members: DataFrame, nodes: DataFrame, roots: DataFrame) -> DataFrame:
    """Give every document the smallest id of its component."""
    linked = nodes.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("component"))
    of_node = linked.join(smallest, "root").select("node", "component", "root")
    return members.join(of_node, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        "node", "key", "root",
    )
