"""Words that are a spelling variant of a more frequent word, found over a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols, so a word becomes a reduced word, and two words one edit apart have reduced
words at most one edit apart.  Every word generates the full one-edit neighbourhood of its reduced word, the reduced word
itself included, and these are joined with the reduced words of the vocabulary.  What meets is verified on the
original strings.

Many words share a reduced word, so each key also holds half of the original letters: an edit in the second
half leaves the first half of a word as it is, and one in the first half the second.  Halves are those of the word that is looked for, whose length
the neighbour tells.  So only words that agree in half of their letters and nearly in the rest meet, and no group lists all its
pairs.  Keys are 64-bit hashes; a chance match fails the verification.

A table of words with their counts comes from one pass, added up in the tasks first.  Neighbourhoods hold word numbers only, and a
bounded bitmap of the vocabulary's keys drops most neighbours before they are shuffled.

Defined results: a null or empty text has no words; a null id is written as nothing before the colon; every row counts, also repeated
ones; a word without a near word has none as form and is its own root.  Forms lead to words at least ten
times as frequent, so there are no circles and a chain has at most about 19 steps.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ionweave.llm.bitmaps import bits_for, is_set, key_bitmap
from ionweave.llm.textual import strings

SYMBOLS = 4
SHORTEST, LEAST, TIMES = 7, 2, 10
DELETE_EACH = 31  # one in so many runs of a document loses a letter

_FLUSH = 300_000  # different words that a task adds up before it hands them on
_AT_ONCE = 1 << 21  # neighbours made at a time
_LETTERS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
_OTHER = re.compile(rb"[\xc2\xc4-\xf4][\x80-\xbf]+")  # characters beyond ASCII, but for U+00C0 to U+00FF
_BASE, _EXACT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))

Stage = Callable[[DataFrame], DataFrame]


def runs(text: str) -> list[bytes]:
    """Runs of letters, A-Z in lower case, as UTF-8."""
    raw = text.encode()
    if not raw.isascii():
        raw = _OTHER.sub(b" ", raw)
    return raw.translate(_LETTERS).split()


def spelled(run: bytes, doc: int) -> bytes:
    """The run without one letter, if the hash of it and of the document's prefix says so; ``doc`` is the prefix's crc32."""
    h = zlib.crc32(run, doc)
    if h % DELETE_EACH:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(docs: DataFrame, id_col: str, text_col: str, shortest: int) -> DataFrame:
    """``word`` and ``n`` of all words."""

    def table(found: Counter) -> pa.RecordBatch:
        words = pa.array(list(found), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(found.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), strings(batch.column(1)).to_pylist(), strict=True):
                prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                long_runs = [r for r in runs(text) if len(r) >= shortest]  # bytes: at least the letters
                for r, k in Counter(long_runs).items():
                    word = spelled(r, prefix)
                    if len(word) >= shortest and (word.isascii() or len(word.decode()) >= shortest):
                        found[word] += k
                if len(found) > _FLUSH:
                    yield table(found)
                    found = Counter()
        yield table(found)

    pairs = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(run, "word string, n long")
    return pairs.groupBy("word").agg(F.sum("n").alias("n"))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, base, np.uint64))))


class Words:
    """Words of one length as a matrix of letters, with hashes of their reduced forms and halves."""

    def __init__(self, words: list[str], symbols: int):
        self.n, self.length, self.symbols = len(words), len(words[0]), symbols
        letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(self.n, self.length).astype(np.uint64)
        self.exact = _mixed(letters + np.uint64(1))
        self.reduced = self.exact % np.uint64(symbols) + np.uint64(1)
        self.power = _powers(_BASE, self.length + 1)
        self.sum = np.concatenate([np.zeros((self.n, 1), np.uint64), np.cumsum(self.reduced * self.power[:-2], axis=1)], axis=1)

    def half(self, a: int, b: int) -> np.ndarray:
        """Hash of the original letters from a to b."""
        return _mixed((self.exact[:, a:b] * _powers(_EXACT, b - a)[:-1]).sum(axis=1, dtype=np.uint64))

    def halves(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """The first letters, and the last, of the halves of a word of the given length."""
        q = length // 2
        return self.half(0, min(q, self.length)), self.half(self.length - (length - q), self.length)

    def keys(self, reduced: np.ndarray, length: int, last: bool, half: np.ndarray) -> np.ndarray:
        seed = np.uint64(2 * length + last)
        return _mixed(reduced + _mixed(seed + half)[:, None])

    def own(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys under which the words are found: by the first half, and by the second."""
        first, last = self.halves(self.length)
        whole = self.sum[:, -1:]
        return self.keys(whole, self.length, False, first)[:, 0], self.keys(whole, self.length, True, last)[:, 0]

    def neighbours(self, start: int, end: int) -> Iterator[np.ndarray]:
        """Keys of the reduced words one edit away, for edits at places from ``start`` to ``end``, and of the reduced words themselves."""
        n, own, p = self.length, self.sum[:, -1:], self.power
        symbols = np.arange(1, self.symbols + 1, dtype=np.uint64)

        def dealt(reduced: np.ndarray, at: np.ndarray, length: int) -> Iterator[np.ndarray]:
            first, last = self.halves(length)
            late = at >= length // 2  # the first half is as it was
            yield self.keys(reduced[:, late], length, False, first)
            yield self.keys(reduced[:, ~late], length, True, last)

        if start == 0:
            yield np.stack(self.own(), axis=1)
        at = np.arange(start, min(end, n))
        if len(at):
            shorter = np.concatenate([self.reduced[:, 1:] * p[: n - 1], np.zeros((self.n, 1), np.uint64)], axis=1)
            rest = np.cumsum(shorter[:, ::-1], axis=1)[:, ::-1][:, at]  # letters behind a place, one place to the left
            yield from dealt(self.sum[:, at] + rest, at, n - 1)
            moved = (symbols[None, None, :] - self.reduced[:, at, None]) * p[at][None, :, None]
            other = (own[:, :, None] + moved).reshape(self.n, -1)
            yield from dealt(other, np.repeat(at, self.symbols), n)
        at = np.arange(start, min(end, n + 1))
        if len(at):
            longer = np.concatenate([self.reduced * p[1:-1], np.zeros((self.n, 1), np.uint64)], axis=1)
            rest = np.cumsum(longer[:, ::-1], axis=1)[:, ::-1][:, at]  # letters from a place on, one to the right
            added = (self.sum[:, at] + rest)[:, :, None] + symbols[None, None, :] * p[at][None, :, None]
            yield from dealt(added.reshape(self.n, -1), np.repeat(at, self.symbols), n + 1)


def _by_length(words: list[str], most: int) -> Iterator[np.ndarray]:
    """Places of words of equal length, in parts of at most ``most`` letters or one word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    cuts = np.flatnonzero(np.diff(sizes[order])) + 1
    for group in np.split(order, cuts):
        step = max(1, most // max(1, int(sizes[group[0]])))
        for k in range(0, len(group), step):
            yield group[k : k + step]


def targets(words: DataFrame, symbols: int) -> DataFrame:
    """Two rows per word: ``key``, ``last`` (by the second half), ``near`` and ``near_n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for at in _by_length(names, _AT_ONCE) if names else ():
                rows = batch.take(pa.array(at))
                for last, keys in enumerate(Words([names[i] for i in at], symbols).own()):
                    columns = [pa.array(keys.view(np.int64)), pa.array(np.full(len(at), bool(last))), rows.column(0), rows.column(1)]
                    yield pa.RecordBatch.from_arrays(columns, ["key", "last", "near", "near_n"])

    return words.select("word", "n").mapInArrow(run, "key long, last boolean, near string, near_n long")


def neighbours(words: DataFrame, symbols: int, wanted: np.ndarray) -> DataFrame:
    """``wid`` and ``key`` for the neighbourhoods of all words, without most keys that no word has."""
    bitmap = words.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = bitmap.value
        for batch in batches:
            names, ids = batch.column(1).to_pylist(), batch.column(0).to_numpy()
            each = 2 * symbols + 1
            for at in _by_length(names, _AT_ONCE // each) if names else ():
                group, own = Words([names[i] for i in at], symbols), ids[at]
                step = max(1, _AT_ONCE // (each * len(at)))
                of, keys = [], []
                for start in range(0, group.length + 1, step):
                    for made in group.neighbours(start, start + step):
                        row, column = np.nonzero(is_set(asked, made))
                        of.append(own[row])
                        keys.append(made[row, column])
                of, keys = np.concatenate(of), np.concatenate(keys)
                order = np.lexsort((keys, of))
                of, keys = of[order], keys[order]
                once = np.ones(len(of), bool)
                once[1:] = (of[1:] != of[:-1]) | (keys[1:] != keys[:-1])  # different edits can lead to one word
                yield pa.RecordBatch.from_arrays([pa.array(of[once]), pa.array(keys[once].view(np.int64))], ["wid", "key"])

    return words.select("wid", "word").mapInArrow(run, "wid long, key long")


def near_words(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """``wid``, ``near`` and ``near_n``: each word's near words, once each.  ``words`` is stored, with wid, word and n."""
    found = targets(words, symbols)
    n = words.count()
    wanted = key_bitmap(found, F.col("key"), bits_for(2 * n, 32))
    met = neighbours(words, symbols, wanted).join(found, "key").drop("key")
    pairs = met.join(words.select("wid", "word"), "wid")
    half = F.floor(F.length("near") / 2).cast("int")
    twice = F.col("last") & (F.substring(F.col("word"), F.lit(1), half) == F.substring(F.col("near"), F.lit(1), half))
    return pairs.where((F.levenshtein("word", "near", 1) == 1) & ~twice).select("wid", "near", "near_n")


def forms(words: DataFrame, symbols: int = SYMBOLS, times: int = TIMES) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form`` and ``form_n`` of all words."""
    near = near_words(words, symbols)
    best = near.groupBy("wid").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("b"))
    joined = words.join(best, "wid", "left")
    good = -F.col("b.m") >= times * F.col("n")
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(good, F.col("b.near")).alias("form"), F.when(good, -F.col("b.m")).alias("form_n"),
    )


def roots(table: DataFrame, stage: Stage) -> DataFrame:
    """``word`` and ``root`` of the words with a form: pointers are doubled until none moves."""
    found = stage(table.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        on = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(found.join(on, "root", "left"))
        found = moved.select("word", F.coalesce("next", "root").alias("root"))
        if moved.where("next IS NOT NULL").isEmpty():
            return found


def variants(
    docs: DataFrame,
    stage: Stage,
    id_col: str = "doc_id",
    text_col: str = "text",
    shortest: int = SHORTEST,
    least: int = LEAST,
    times: int = TIMES,
    symbols: int = SYMBOLS,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of all words.  Runs at once; ``stage`` stores a table."""
    counted = word_counts(docs, id_col, text_col, shortest).where(F.col("n") >= least)
    words = stage(counted.withColumn("wid", F.monotonically_increasing_id()))
    table = stage(forms(words, symbols, times))
    joined = table.join(roots(table, stage), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
