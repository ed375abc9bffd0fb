"""Quality rules with risk-controlled cutoffs.

Fixed limits come first (``base_failed``).  Each rule then has a score per document, higher being worse, and per
stratum a cutoff above which documents go.  Cutoffs come from labelled documents in two steps.

1. A fifth of the good documents (by a hash of the id, the pilot) and the bad ones that pass the limits fix an order
   of steps for the stratum.  Each step lowers one cutoff, first where the bad documents caught are most for the pilot
   documents lost, so the documents rejected by all rules together only get more.
2. The other good documents are tested in this order: a step is taken if an exact binomial test shows that the share
   of good documents that all rules together reject is at most ``risk``, and the first that fails ends the order.
   The order does not depend on these documents, so one level holds for all of it: ``error`` divided by the strata.

So with probability ``1 - error`` no stratum loses more than ``risk`` of its good documents by these rules.  At
2 and 5 percent and four strata, 217 tested documents without a loss suffice, about 272 good labels.  A stratum with
too few labels has no cutoffs; one without bad ones takes the steps that lose the fewest pilot documents first.

Defined results: a null or empty text has no words and fails the fixed limits; a null stratum is a stratum;
null labels are left out, and of contradicting labels the lowest counts; a labelled id is one trial, with the highest scores of its rows; equal rows get
equal results; without labels only the fixed limits apply.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ionweave.llm.textual import append, free_name, windows, word_hashes, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", "n_ends")
_KIND = StructType([StructField(m, LongType()) for m in MEASURES])
_SPACE = " \t\n\r\v\f"
_CAPITAL = re.compile(r"[A-Z]")

#: Percent that a rule's score can be cut at.
GRID = (1, 2, 3, 5, 8, 12, 18, 25, 35, 50, 70)
PILOT = 5  # one of so many good documents
RULES = ("symbols", "dup_lines", "repeats", "capitals", "long_words", "unended")


def measure(text: str) -> dict[str, int]:
    """Counts of one text; a word is a run of anything but ASCII white space."""
    tokens = words(text)
    n = len(tokens)
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    repeated = 0
    if n > 5:
        runs = windows(word_hashes(tokens), 5)
        _, place, count = np.unique(runs, return_inverse=True, return_counts=True)
        again = np.flatnonzero(count[place] > 1)
        if len(again):
            steps = np.zeros(n + 1, np.int64)
            np.add.at(steps, again, 1)
            np.add.at(steps, again + 5, -1)
            repeated = int((np.cumsum(steps[:-1]) > 0).sum())
    return {
        "n_words": n,
        "word_chars": len(text) - sum(map(text.count, _SPACE)),
        "n_symbols": sum(map(text.count, "#*$%&|<>")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated,
        "n_lines": len(lines),
        "n_capitals": len(_CAPITAL.findall(text)),
        "n_ends": sum(map(text.count, ".!?")),
    }


def with_measures(docs: DataFrame, name: str, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) and a struct ``name`` of the counts of each text."""
    return append(docs, text_col, name, _KIND, lambda texts: [measure(t) for t in texts], keep)


def base_failed(m: Callable[[str], Column]) -> Column:
    """Fewer than 10 words, or more than a fifth of them in repeated windows."""
    return (m("n_words") < 10) | (100 * m("n_repeat_words") > 20 * m("n_words"))


def scores(m: Callable[[str], Column]) -> dict[str, Column]:
    """Percent, from 0 to 100, for each rule; whole-number counts only, so no score depends on order."""

    def share(a: Column, b: Column) -> Column:
        return F.when(b > 0, F.least(F.lit(100.0), 100.0 * a / b)).otherwise(0.0)

    return {
        "symbols": share(m("n_symbols"), m("word_chars")),
        "dup_lines": share(m("n_dup_lines"), m("n_lines")),
        "repeats": share(m("n_repeat_words"), m("n_words")),
        "capitals": share(m("n_capitals"), m("word_chars")),
        "long_words": share(m("word_chars"), 20 * m("n_words")),  # 100: 20 characters a word or more
        "unended": share(F.greatest(m("n_words") - 40 * m("n_ends"), F.lit(0)), m("n_words")),
    }


def binomial_below(k: int, n: int, share: float) -> float:
    """Chance of at most ``k`` among ``n``."""
    if k >= n:
        return 1.0
    logs = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(share) + (n - i) * math.log1p(-share)
        for i in range(k + 1)
    ]
    top = max(logs)
    return min(1.0, math.exp(top) * sum(math.exp(v - top) for v in logs))


def most_allowed(n: int, share: float, level: float) -> int:
    """The largest number among ``n`` that shows a share of at most ``share`` at ``level``; -1 if none does."""
    low, high = -1, n
    while high - low > 1:
        middle = (low + high) // 2
        if binomial_below(middle, n, share) <= level:
            low = middle
        else:
            high = middle
    return low


def steps(codes: np.ndarray, pilot: np.ndarray, bad: np.ndarray) -> list[list[int]]:
    """Vectors of cutoffs, each with one lower than the one before; a row of ``codes`` goes if one is above its cutoff.

    ``codes`` has a column per rule: how many values of the grid are below the score.  ``pilot`` and ``bad`` are numbers
    of documents per row.  With bad documents, a step has to catch a larger share of them than it loses of the pilot.
    """
    cut, gone = [len(GRID)] * codes.shape[1], np.zeros(len(codes), bool)
    all_bad, all_pilot, path = int(bad.sum()), int(pilot.sum()), []
    while True:
        best = None
        for r, now in enumerate(cut):
            for c in range(now - 1, -1 if all_bad else max(now - 2, -1), -1):
                new = ~gone & (codes[:, r] > c)
                caught, lost = int(bad[new].sum()), int(pilot[new].sum())
                if all_bad and (not caught or caught * all_pilot <= lost * all_bad):
                    continue
                worth = (caught / (lost + 1) if all_bad else -lost, c)
                if best is None or worth > best[0]:
                    best = worth, r, c, new
        if best is None:
            return path
        _, r, c, new = best
        cut[r] = c
        gone |= new
        path.append(list(cut))


def chosen(codes: np.ndarray, kind: np.ndarray, n: np.ndarray, risk: float, level: float) -> list[float | None]:
    """Cutoff of each rule from rows of ``n`` labelled documents; ``kind`` is 0 if bad, 1 in the pilot, 2 if tested."""
    tested = np.where(kind == 2, n, 0)
    most = most_allowed(int(tested.sum()), risk, level)
    taken = [len(GRID)] * codes.shape[1]
    for cut in steps(codes, np.where(kind == 1, n, 0), np.where(kind == 0, n, 0)):
        if tested[(codes > cut).any(axis=1)].sum() > most:
            break
        taken = cut
    return [float(GRID[c]) if c < len(GRID) else None for c in taken]


def cutoffs(measured: DataFrame, labels: DataFrame, m: Callable[[str], Column], risk: float, error: float) -> DataFrame:
    """``stratum``, ``rule``, ``cutoff`` from ``measured`` (doc_id, stratum and counts) and labels."""
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    score = scores(m)
    codes = [F.aggregate(F.array(*[(score[r] > float(g)).cast("int") for g in GRID]), F.lit(0), lambda a, x: a + x) for r in RULES]
    pilot = F.pmod(F.xxhash64("doc_id"), F.lit(PILOT)) == 0
    kind = F.when(F.col("quality") != 1, F.when(~base_failed(m), 0)).when(pilot, 1).otherwise(2)
    rows = measured.join(known.where("quality IS NOT NULL"), "doc_id").select(
        "doc_id", F.struct(F.array(*codes).alias("codes"), "stratum", kind.alias("kind")).alias("x")
    )
    # a label is one trial, however many rows have its id; of these the one with the highest scores counts
    trials = rows.where("x.kind IS NOT NULL").groupBy("doc_id").agg(F.max("x").alias("x")).select("x.*")
    counted = trials.groupBy("stratum", "kind", "codes").agg(F.count("*").alias("n"))
    per_stratum = counted.groupBy("stratum").agg(  # bounded by the grid
        F.collect_list(F.struct("kind", "codes", "n")).alias("x"), F.max("kind").alias("good")
    ).where("good > 0")
    strata = per_stratum.agg(F.count("*")).first()[0]
    level = error / max(1, strata)

    def choose(x):
        x = sorted((r["kind"], tuple(r["codes"]), r["n"]) for r in x)
        return chosen(*(np.array(v) for v in ([r[1] for r in x], [r[0] for r in x], [r[2] for r in x])), risk, level)

    cuts = per_stratum.select("stratum", F.udf(choose, "array<double>")("x").alias("cuts"))
    named = F.array(*[F.struct(F.lit(r).alias("rule"), F.col("cuts")[i].alias("cutoff")) for i, r in enumerate(RULES)])
    return cuts.select("stratum", F.explode(named).alias("y")).select("stratum", "y.*").where("cutoff IS NOT NULL")


def judged(
    docs: DataFrame,
    labels: DataFrame,
    stage: Callable[[DataFrame], DataFrame],
    stratum_col: str = "lang",
    id_col: str = "doc_id",
    text_col: str = "text",
    risk: float = 0.02,
    error: float = 0.05,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) and a struct ``_quality``: the counts, base_failed, kept.

    ``stage`` stores the counts once; the texts are read once.  Should a column be called ``_quality``
    already, the struct's name gets more underscores; it is the last column.
    """
    keep = list(docs.columns if keep is None else keep)
    name = free_name(keep, "_quality")
    id_name, stratum = free_name(keep, "_id"), free_name(keep, "_stratum")
    named = docs.withColumns({id_name: F.col(f"`{id_col}`"), stratum: F.col(f"`{stratum_col}`").cast("string")})
    table = stage(with_measures(named, name, text_col, [*keep, id_name, stratum]))

    def m(count: str) -> Column:
        return F.col(f"{name}.{count}")

    holdout = table.select(F.col(id_name).alias("doc_id"), F.col(stratum).alias("stratum"), F.col(name))
    limits = stage(cutoffs(holdout, labels, m, risk, error))
    wide = limits.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_cut_{r}") for r in RULES]
    ).withColumnRenamed("stratum", "_s")
    score = scores(m)
    bad = base_failed(m)
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(score[r] > F.col(f"_cut_{r}"), F.lit(False))
    out = table.join(F.broadcast(wide) if limits.count() <= 10_000 else wide, F.col(stratum).eqNullSafe(F.col("_s")), "left")
    fields = [m(c).alias(c) for c in MEASURES]
    return out.select(
        *[F.col(f"`{c}`") for c in keep],
        F.struct(*fields, bad.alias("base_failed"), (~bad & ~rejected).alias("kept")).alias(name),
    )
