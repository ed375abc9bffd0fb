"""Mixing sources to target weights by pivotal rounding.

A source's documents should give a target number of words.  A document then has ``target / source size``
copies on average: the whole part is certain, the fraction is its probability of one more copy.  The
pivotal method makes these fractions 0 or 1: of two documents of a source with fractions left, words move
from one to the other, in a random direction, until one of the two is whole.  Words are kept in
every step and probabilities on average.  Documents of a source are split into buckets of bounded
size; a bucket leaves at most one document with a fraction, and these residuals meet in buckets again, up
a tree, until a source has one.  It is rounded by its own probability.  So a source's words differ from
its target by less than one document.

Random numbers are hashes of ids, sizes, texts and a number among equal rows: the same table gives the same mix, whatever the
partitions, and rows that share an id, also a null one, spread over the buckets.

Defined results: a null or empty text has size 0 and takes nothing; a null source is a source of its own,
after all others; equal rows are separate documents; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ionweave.llm.textual import n_words

BUCKET = 50_000  # documents that meet in one task, about
SPREAD = 32  # parts in which the documents of a source are joined with its target

Stage = Callable[[DataFrame], DataFrame]


def round_pairs(size: np.ndarray, share: np.ndarray, draws: np.random.Generator) -> np.ndarray:
    """Fractions of one bucket made whole but for one at most; the sum of size x fraction stays.

    All pairs of a level are treated at once, and the survivors meet in the next level.
    """
    share = share.copy()
    left = np.flatnonzero((share > 0) & (share < 1))
    while len(left) > 1:
        a, b = left[: len(left) // 2 * 2 : 2], left[1::2]
        words_a, words_b = share[a] * size[a], share[b] * size[b]
        up = np.minimum(size[a] - words_a, words_b)  # words that can move from b to a
        down = np.minimum(words_a, size[b] - words_b)
        to_a = draws.random(len(a)) * (up + down) < down
        moved = np.where(to_a, up, -down)
        full_a = np.where(to_a, up == size[a] - words_a, False)
        none_a = np.where(to_a, False, down == words_a)
        none_b = np.where(to_a, up == words_b, False)
        full_b = np.where(to_a, False, down == size[b] - words_b)
        share[a] = np.where(full_a, 1.0, np.where(none_a, 0.0, (words_a + moved) / size[a]))
        share[b] = np.where(full_b, 1.0, np.where(none_b, 0.0, (words_b - moved) / size[b]))
        left = left[(share[left] > 0) & (share[left] < 1)]
    return share


def targets(sources: DataFrame, stage: Stage, weights: Sequence[int], percent: int) -> DataFrame:
    """``source``, ``source_size``, ``docs``, ``target``; sources have ``words`` and ``docs``.

    Weights repeat along the sources in the order of their code points, null last.  Their share of
    ``percent`` percent of all words stops at twice the source's words; what is above goes to the others
    by weight, until none is above.  A round is one aggregation; the driver gets three sums.
    """
    if any(w <= 0 for w in weights) or not 0 <= percent <= 200:
        raise ValueError("weights must be positive and percent in 0..200")
    ordered = stage(_ranked(sources, stage))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = stage(ordered.withColumn("weight", weight.cast("double")))
    total = table.agg(F.sum("words")).first()[0] or 0
    level = float("-inf")
    while True:
        above = 2.0 * F.col("words") <= F.lit(level) * F.col("weight")
        capped, free = table.agg(
            F.sum(F.when(above, 2.0 * F.col("words"))), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if not free:
            break
        wanted = (total * percent / 100 - (capped or 0.0)) / free
        if wanted <= level:
            break
        level = wanted
    target = F.least(2.0 * F.col("words"), F.lit(level) * F.col("weight"))
    return table.select("source", F.col("words").alias("source_size"), "docs", target.alias("target"))


def _ranked(sources: DataFrame, stage: Stage) -> DataFrame:
    """Place of each source by code point, null last: a range sort, numbered by slice and place in it.

    The slices are stored: a range shuffle draws its bounds anew each time that it runs.
    """
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.col("source").isNull(), F.encode(F.col("source"), "utf-8")
    keyed = sources.withColumn("_none", key[0]).withColumn("_code", key[1])
    sliced = stage(keyed.repartitionByRange(n, "_none", "_code").withColumn("_slice", F.spark_partition_id()))
    placed = sliced.withColumn("_place", F.row_number().over(Window.partitionBy("_slice").orderBy("_none", "_code")) - 1)
    counts = sliced.groupBy("_slice").agg(F.count("*").alias("_n"))  # one row per slice
    before = counts.withColumn(
        "_before", F.coalesce(F.sum("_n").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    joined = placed.join(F.broadcast(before.select("_slice", "_before")), "_slice")
    return joined.withColumn("rank", F.col("_before") + F.col("_place")).drop("_none", "_code", "_slice", "_place", "_before")


def _bucket_rounding(df: DataFrame, seed: int, level: int) -> DataFrame:
    """Round within each (source, bucket); ``open`` marks what is left with a fraction."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("h", "doc_id", "size")])
        entropy = [seed, level, key[1].as_py(), len(rows), *(key[0].as_py() or "").encode()]
        size = rows["size"].to_numpy().astype(np.float64)
        share = round_pairs(size, rows["share"].to_numpy(), np.random.default_rng(entropy))
        names = rows.column_names
        rows = rows.set_column(names.index("share"), "share", pa.array(share))
        return rows.set_column(names.index("open"), "open", pa.array((share > 0) & (share < 1)))

    return df.groupBy("source", "bucket").applyInArrow(run, df.schema)


def mixed(
    docs: DataFrame,
    stage: Stage,
    weights: Sequence[int] = (3, 1, 2),
    percent: int = 150,
    seed: int = 7,
    bucket: int = BUCKET,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Per document: id, source, size, source_size, target of its source, copies, and words taken.

    ``copies`` counts how often the mix repeats the document, at most twice.  Runs at once; ``stage``
    stores a table.
    """
    sized = stage(
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.col(f"`{source_col}`").cast("string").alias("source"),
            n_words(F.col(f"`{text_col}`")).alias("size"), F.xxhash64(F.col(f"`{text_col}`")).alias("_mark"),
        )
    )
    return round_copies(sized, stage, weights, percent, seed, bucket).drop("_mark")


def round_copies(
    sized: DataFrame, stage: Stage, weights: Sequence[int], percent: int, seed: int = 7, bucket: int = BUCKET
) -> DataFrame:
    """As ``mixed``, from a stored table of doc_id, source, size; its other columns stay and should tell rows apart."""
    extra = [c for c in sized.columns if c not in ("doc_id", "source", "size")]
    sources = stage(
        targets(sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs")), stage, weights, percent)
    )
    same = sized.groupBy(*sized.columns).agg(F.count("*").alias("_same"))  # equal rows are told apart by a number
    numbered = same.withColumn("_number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_same"))))
    hashed = numbered.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "size", *extra, "_number")).drop("_same", "_number")
    salted = hashed.withColumn("_part", F.pmod("h", F.lit(SPREAD)).cast("int"))
    copies = sources.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))))
    joined = salted.withColumnRenamed("source", "_s").join(
        copies, F.col("_s").eqNullSafe(F.col("source")) & (salted["_part"] == copies["_part"])
    )
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.when(F.col("size") > 0, F.floor(ratio)).otherwise(0).cast("long")
    level0 = joined.select(
        "doc_id", "source", "size", *extra, "source_size", "target", "h", whole.alias("whole"),
        F.when(F.col("size") > 0, ratio - F.floor(ratio)).otherwise(0.0).alias("share"),
        F.pmod(F.shiftright("h", 20), F.ceil(F.col("docs") / bucket)).cast("long").alias("bucket"),
        F.lit(False).alias("open"),
    )
    level, stored, done = 0, stage(_bucket_rounding(level0, seed, 0)), []
    fanout = 4096
    while True:
        done.append(stored.where(~F.col("open")))
        left = stored.where("open")
        most = left.agg(F.max("bucket")).first()[0]
        if most is None or most == 0:
            chance = F.pmod(F.xxhash64(F.lit(seed + 1), "h", "source"), F.lit(1 << 30)) / float(1 << 30)
            last = left.withColumn("share", F.when(chance < F.col("share"), 1.0).otherwise(0.0))
            done.append(last)
            break
        level += 1
        merged = left.withColumn("bucket", F.floor(F.col("bucket") / fanout).cast("long"))
        stored = stage(_bucket_rounding(merged, seed, level))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    copies = F.col("whole") + F.col("share").cast("long")
    return out.select(
        "doc_id", "source", "size", *extra, "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
