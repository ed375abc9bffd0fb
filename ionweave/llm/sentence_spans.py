"""Substring removal by sliding sentence spans.

A text is cut into sentences, and every run of ``run`` consecutive sentences is a span.  The first place of a span
among all documents, by document and position, stays; the sentences of every other place go.  A
passage of several sentences that repeats is so removed from all documents but the first, wherever it stands.

With ``shared`` words given, a run goes on until it holds that many words as well, so that a few short sentences that
many texts have are left alone, and stretches without such a run count too.  A text is cut behind words that
end a sentence, and where there is none in a window of words, at the smallest hash of two neighbouring words in it;
so cuts are at most a window apart and agree wherever the words around them do.  Cuts by a wide window start word
spans; each reaches to the first cut by a narrow window that is far enough, and one more ends with the text.  Windows
and reach follow from ``shared`` (see ``reach``): two places with ``shared`` equal words, apart from ASCII case and
white space, always have a word span in common, and less than ``shared`` words in a row stay of a longer passage.

Only hashes travel: one row per span, added up before they are shuffled, so a passage of a third of all documents is
one row per task.  Spans that occur once are dropped before anything is joined.

Defined results: a null text stays null and an empty one empty; a document is identified by its id and text; null ids
come first; texts with fewer sentences than ``run``, or words than ``shared``, have no span of sentences.  Without ``shared``, equal rows are one
document and are cut alike; with it, they are stored with a number and all but one lose every span.  A word span that
overlaps the place before it of the same words in the same text is no place.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ionweave.llm.textual import WORD, free_name, lowered_words, windows, word_hashes

RUN = 3
SHARED = 50  # words that op7 finds wherever they repeat
_WORD = re.compile(WORD)
_FIRST_WORDS = 1 << 40  # ``at`` of the first word span of a text
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_ENDS = re.compile(r"[.!?]+\s+|\n\s*")


def sentences(text: str) -> list[tuple[int, int]]:
    """Bounds of the sentences; together they make up the text.

    A sentence ends behind a full stop, exclamation or question mark before white space, or at a line end.
    """
    cuts = [m.end() for m in _ENDS.finditer(text)]
    if not cuts or cuts[-1] < len(text):
        cuts.append(len(text))
    return [(a, b) for a, b in zip([0, *cuts[:-1]], cuts) if b > a]


def _hashes(text: str, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Hash of each sentence, without regard to case and white space at its ends."""
    return np.fromiter((xxh3_64_intdigest(text[a:b].strip().lower()) for a, b in bounds), np.uint64, len(bounds))


def _runs(text: str, bounds: list[tuple[int, int]], run: int, shared: int | None) -> np.ndarray:
    """Sentence behind the run that starts with each sentence; the last ones may start none.

    It depends on the sentences of the run alone, so equal sentences make equal runs in all texts.
    """
    least = run + np.arange(len(bounds))
    if shared is not None:
        counts = np.fromiter((len(_WORD.findall(text, a, b)) for a, b in bounds), np.int64, len(bounds))
        sums = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
        least = np.maximum(least, np.searchsorted(sums, sums[:-1] + shared))
    return least[least <= len(bounds)]


def reach(shared: int) -> tuple[int, int, int]:
    """Wide window, narrow window and least length of word spans, so that ``shared`` equal words hold one.

    The first wide window within them has a start, the span ends less than a narrow window behind its least length,
    and narrow cuts less than a window from the last word may differ: these four have to fit.
    """
    if shared < 5:
        raise ValueError("shared must be at least 5")
    wide, narrow = 2 * shared // 5, max(1, shared // 10)
    return wide, narrow, shared + 1 - wide - 2 * narrow


def _cuts(rank: np.ndarray, window: int) -> np.ndarray:
    """Words before which a text is cut: all ranks of 0, else the first smallest one of each window; the text's ends."""
    chosen = rank == 0
    if len(rank) >= window:
        views = np.lib.stride_tricks.sliding_window_view(rank, window)
        for at in range(0, len(views), 65_536):
            part = views[at : at + 65_536]
            chosen[at + np.arange(len(part)) + part.argmin(axis=1)] = True
    return np.concatenate(([0], np.flatnonzero(chosen) + 1, [len(rank) + 1]))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _stretches(hashes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hash of each stretch of ``hashes``, by its parts and its length."""
    n = len(hashes)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, n), dtype=np.uint64)))
    found = (sums[stops] - sums[starts]) * _powers(_BACK, n)[starts]
    return windows(np.stack([found, (stops - starts).astype(np.uint64)], axis=1).ravel(), 2)[::2]


def word_spans(text: str, shared: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and word behind the last one of each word span, by place."""
    wide, narrow, least = reach(shared)
    tokens = lowered_words(text)
    n = len(tokens)
    if n < least:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = word_hashes(tokens)
    rank = windows(hashes, 2) | np.uint64(1)  # of the place before words 1, 2 ... n - 1
    ends = np.fromiter((t.endswith((b".", b"!", b"?")) for t in tokens[:-1]), bool, n - 1)
    rank[ends] = 0
    starts, cuts = _cuts(rank, wide), _cuts(rank, narrow)
    starts = starts[starts <= n - least]
    stops = cuts[np.searchsorted(cuts, starts + least)]
    if stops[-1] < n:  # the last start reaches the end as well
        starts, stops = np.append(starts, starts[-1]), np.append(stops, n)
    return _stretches(hashes, starts, stops), starts, stops


def _places(found: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Numbers of the word spans without those that overlap the place before of the same words."""
    value, kind, count = np.unique(found, return_inverse=True, return_counts=True)
    if len(value) == len(found):
        return np.arange(len(found))
    keep, free = count[kind] == 1, {}
    for i in np.flatnonzero(~keep).tolist():
        if starts[i] >= free.get(kind[i], 0):
            keep[i], free[kind[i]] = True, stops[i]
    return np.flatnonzero(keep)


def _found(text: str, run: int, shared: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and places of the spans of one text."""
    bounds = sentences(text)
    hashes = _hashes(text, bounds)
    if shared is None:
        hashes = windows(hashes, run)
        return hashes, np.arange(len(hashes))
    ends = _runs(text, bounds, run, shared)
    at = np.arange(len(ends))
    hashes = _stretches(hashes, at, ends) if len(ends) else np.empty(0, np.uint64)
    found, starts, stops = word_spans(text, shared)
    places = _places(found, starts, stops)
    return np.concatenate((hashes, found[places])), np.concatenate((at, _FIRST_WORDS + places))


def spans(
    docs: DataFrame, run: int = RUN, id_col: str = "doc_id", text_col: str = "text", shared: int | None = None
) -> DataFrame:
    """``span`` (hash), ``doc_id``, ``key``, ``at`` (number of its first sentence) of every run of sentences.

    With ``shared``, those of word spans too; their ``at`` is their number in the text, from ``_FIRST_WORDS`` on.
    """
    ids = F.col(f"`{id_col}`").cast("long").alias("doc_id")
    rows = docs.select(ids, F.xxhash64(f"`{id_col}`", f"`{text_col}`").alias("key"), F.col(f"`{text_col}`").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, places = [], []
            for text in batch.column(2).to_pylist():
                hashes, at = _found(text or "", run, shared)
                found.append(hashes.view(np.int64))
                places.append(at)
            counts = list(map(len, places))
            if not sum(counts):
                continue
            owner = pa.array(np.repeat(np.arange(len(counts)), counts))
            at = pa.array(np.concatenate(places))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found)), batch.column(0).take(owner), batch.column(1).take(owner), at],
                ["span", "doc_id", "key", "at"],
            )

    return rows.mapInArrow(cut, "span long, doc_id long, key long, at long")


def without_repeated_spans(
    docs: DataFrame,
    stage: Callable[[DataFrame], DataFrame],
    run: int = RUN,
    id_col: str = "doc_id",
    text_col: str = "text",
    shared: int | None = None,
) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text_col``, and a struct ``_cut`` behind its columns.

    The struct has ``n_sentences``, ``n_removed`` (sentences that lose anything) and ``removed`` (``start:end`` of each
    removed stretch in the given text, code points).  ``stage`` stores the spans; the steps run at once.
    """
    table = stage(spans(docs, run, id_col, text_col, shared))
    first = table.groupBy("span").agg(F.min(F.struct("doc_id", "key", "at")).alias("f"), F.count("*").alias("n"))
    repeated = first.where("n > 1").select("span", "f")
    own = (F.col("key") == F.col("f.key")) & (F.col("at") == F.col("f.at"))
    again = table.select("span", "key", "at").join(repeated, "span").where(~own)
    covered = stage(again.groupBy("key").agg(F.collect_set("at").alias("at")))  # bounded by one document's spans

    key, name = free_name(docs.columns, "_key"), free_name(docs.columns, "_cut")
    at, whole = free_name(docs.columns, "_at"), free_name(docs.columns, "_whole")
    keyed = docs.withColumn(key, F.xxhash64(f"`{id_col}`", f"`{text_col}`")).withColumn(whole, F.lit(False))
    if shared is not None:
        keyed = _numbered(keyed, key, whole, stage)
    marks = covered.select(F.col("key").alias(key), F.col("at").alias(at))
    marked = keyed.join(marks, key, "left").select(*[F.col(f"`{c}`") for c in docs.columns], at, whole)
    return _removed(marked, docs, run, text_col, name, shared)


def _numbered(keyed: DataFrame, key: str, whole: str, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``keyed`` with ``whole`` true for all but one of the rows of a key; only repeated rows are stored."""
    repeated = stage(keyed.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key))
    if repeated.isEmpty():
        return keyed
    number, least = free_name(keyed.columns, "_number"), free_name(keyed.columns, "_least")
    copies = stage(keyed.join(repeated, key, "left_semi").withColumn(number, F.monotonically_increasing_id()))
    kept = copies.groupBy(key).agg(F.min(number).alias(least))
    told = copies.join(kept, key).withColumn(whole, F.col(number) > F.col(least)).select(*keyed.columns)
    return keyed.join(repeated, key, "left_anti").select(*keyed.columns).unionByName(told)


def cut_text(
    text: str, starts: list[int], run: int, shared: int | None = None, whole: bool = False
) -> tuple[str, int, int, str]:
    """The text without the spans at ``starts``, or without all; sentences, those that lose anything, removed stretches."""
    bounds = sentences(text)
    runs = _runs(text, bounds, run, shared) if whole or any(s < _FIRST_WORDS for s in starts) else []
    chosen = range(len(runs)) if whole else [s for s in starts if s < _FIRST_WORDS]
    ranges = {bounds[i] for s in chosen for i in range(s, runs[s])}
    if shared is not None and (whole or any(s >= _FIRST_WORDS for s in starts)):
        _, firsts, stops = word_spans(text, shared)
        at = [m.start() for m in _WORD.finditer(text)] + [len(text)]
        numbers = range(len(firsts)) if whole else [s - _FIRST_WORDS for s in starts if s >= _FIRST_WORDS]
        ranges |= {(at[firsts[k]], at[stops[k]]) for k in numbers}
    stretches: list[list[int]] = []
    for a, b in sorted(ranges):
        if stretches and stretches[-1][1] >= a:
            stretches[-1][1] = max(b, stretches[-1][1])
        else:
            stretches.append([a, b])
    kept, end, gone, i = [], 0, 0, 0
    for a, b in stretches:
        kept.append(text[end:a])
        end = b
    kept.append(text[end:])
    for a, b in bounds:
        while i < len(stretches) and stretches[i][1] <= a:
            i += 1
        gone += i < len(stretches) and stretches[i][0] < b
    return "".join(kept), len(bounds), gone, ",".join(f"{a}:{b}" for a, b in stretches)


def _removed(marked: DataFrame, docs: DataFrame, run: int, text_col: str, name: str, shared: int | None) -> DataFrame:
    """``marked`` has the columns of ``docs``, the places to remove and whether all go."""
    columns = docs.columns
    at = columns.index(text_col)
    kind = "struct<n_sentences:bigint,n_removed:bigint,removed:string>"
    schema = docs.withColumn(name, F.lit(None).cast(kind)).schema

    def run_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut_type = pa.struct([("n_sentences", pa.int64()), ("n_removed", pa.int64()), ("removed", pa.string())])
        for batch in batches:
            texts, cuts = [], []
            for text, starts, whole in zip(*(batch.column(c).to_pylist() for c in (at, len(columns), len(columns) + 1))):
                kept, n, gone, removed = cut_text(text or "", starts or [], run, shared, whole)
                texts.append(None if text is None else kept)
                cuts.append({"n_sentences": n, "n_removed": gone, "removed": removed})
            out = list(batch.columns[: len(columns)])
            out[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*out, pa.array(cuts, cut_type)], [*columns, name])

    return marked.mapInArrow(run_, schema)
