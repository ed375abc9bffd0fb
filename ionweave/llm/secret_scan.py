"""Secrets: fixed patterns, and character Markov models for the rest.

Two first-order models over the characters of identifiers are trained here: one on ordinary
identifiers, which are words of labelled good documents, one on random strings, which are digests
in the usual alphabets.  A long token that no pattern took is a secret (kind ``random``) if the
logarithm of its likelihood ratio exceeds that of the prior odds against a secret.

Training uses at most ``sample_documents`` labelled documents, chosen by a hash of their id, and
``random_strings`` digests.  The scan covers every whole text.

Defined results: a null or empty text has no spans; without an ordinary sample no random
spans are added; equal rows get equal results; positions are code points, end exclusive.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ionweave.llm.textual import append, digest_of_spans, sha256_hex

KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
_CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a maximal run of 24 or more; shorter runs fail anyway
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}")
_IDENTIFIER = re.compile(r"[A-Za-z0-9+/_=-]{4,}")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_STATES = len(ALPHABET) + 1  # the last one is the start
_CODE = np.full(128, -1, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) by the fixed patterns."""
    found, small = [], text.lower()
    if any(cue in small for cue in _CUES):  # no match without one
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def _steps(token: str) -> np.ndarray:
    """Cell of the transition table for each character of the token."""
    codes = _CODE[np.frombuffer(token.encode("ascii"), np.uint8)]
    return np.concatenate(([_STATES - 1], codes[:-1])) * _STATES + codes


def random_string(n: int) -> str:
    """The ``n``-th random sample: a digest in base64, URL-safe base64, capitals, small letters or hex."""
    raw = hashlib.sha512(f"sample {n}".encode()).digest()
    forms = (
        lambda: base64.b64encode(raw[:30]).decode(),
        lambda: base64.urlsafe_b64encode(raw[:30]).decode(),
        lambda: base64.b32encode(raw[:25]).decode(),
        lambda: base64.b64encode(raw).decode().replace("+", "").replace("/", "").rstrip("=")[:40],
        lambda: raw[:20].hex(),
    )
    return forms[n % len(forms)]()


def random_counts(n: int) -> np.ndarray:
    counts = np.zeros(_STATES * _STATES, np.int64)
    for i in range(n):
        np.add.at(counts, _steps(random_string(i)), 1)
    return counts


class Covered:
    """Characters that lie in a span, as disjoint ranges in order."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, _, b in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        """Is any character from a to b covered?"""
        i = bisect_right(self.ends, a)
        return i < len(self.starts) and self.starts[i] < b


def ordinary_identifiers(text: str) -> list[str]:
    """Identifiers of a text, without those in a span of the fixed patterns or with many digits."""
    taken, out = Covered(base_spans(text)), []
    for m in _IDENTIFIER.finditer(text):
        if not taken.meets(*m.span()):
            if sum(c.isdigit() for c in m[0]) * 4 <= len(m[0]):
                out.append(m[0])
    return out


def log_ratios(ordinary: np.ndarray, random: np.ndarray) -> np.ndarray:
    """Log-likelihood ratio of each transition; every transition is counted once more than seen."""

    def log_rows(counts: np.ndarray) -> np.ndarray:
        table = counts.reshape(_STATES, _STATES)[:, : _STATES - 1] + 1.0
        return np.log(table / table.sum(axis=1, keepdims=True))

    full = np.zeros((_STATES, _STATES))
    full[:, : _STATES - 1] = log_rows(random) - log_rows(ordinary)
    return full.ravel()


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_documents: int = 1000,
    random_strings: int = 5000,
) -> np.ndarray | None:
    """Table of log ratios, or None if there is no ordinary sample.

    Ordinary samples come from documents labelled with quality 1, at most ``sample_documents`` of
    them in the order of a hash.  Their transitions are counted where the documents are; the
    driver gets one number per transition.
    """
    good = labels.where((F.col("quality") == 1) & F.col(id_col).isNotNull())
    ids = (
        good.select(F.col(id_col).alias("_id"), F.xxhash64(F.lit("ordinary"), id_col).alias("_h"))
        .distinct()
        .orderBy("_h", "_id")
        .limit(sample_documents)
        .select("_id")
    )
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(
        F.broadcast(ids), "_id"  # at most sample_documents numbers
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for token in ordinary_identifiers(text or ""):
                    total.update(_steps(token).tolist())
        if total:
            yield pa.RecordBatch.from_pydict({"cell": list(total), "n": list(total.values())})

    cells = sample.select("_text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    ordinary = np.zeros(_STATES * _STATES, np.int64)
    for row in cells.collect():  # at most one row per transition
        ordinary[row["cell"]] = row["n"]
    if not ordinary.any():
        return None
    return log_ratios(ordinary, random_counts(random_strings))


def find(text: str, ratios: np.ndarray | None, odds: float) -> list[tuple[int, int, int]]:
    """All spans: those of the patterns, and tokens outside them that the models call random."""
    spans = base_spans(text)
    if ratios is None:
        return spans
    extra, taken = [], Covered(spans)
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        joined = (a and text[a - 1].isalnum()) or text[b : b + 1].isalnum()
        if joined or taken.meets(a, b):
            continue
        if ratios[_steps(m[0])].sum() > odds:
            extra.append((a, 3, b))
    return sorted(spans + extra)


_ROW = StructType(
    [StructField(f"n_{k}", LongType()) for k in KINDS]
    + [StructField("base_sha256", StringType()), StructField("spans", StringType())]
)


def _row(text: str, ratios: np.ndarray | None, odds: float) -> dict:
    spans = find(text, ratios, odds)
    row = {f"n_{k}": 0 for k in KINDS}
    for _, kind, _ in spans:
        row[f"n_{KINDS[kind]}"] += 1
    row["base_sha256"] = sha256_hex(digest_of_spans([s for s in spans if s[1] < len(BASE)], KINDS))
    row["spans"] = digest_of_spans(spans, KINDS)
    return row


def secrets(
    docs: DataFrame,
    ratios: np.ndarray | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    prior_odds: float = 1e-4,
) -> DataFrame:
    """Per document: the id, counts per kind, the digest of the base spans, all spans as text.

    ``prior_odds``: how often a long token is a secret before its characters are looked at.
    """
    spark: SparkSession = docs.sparkSession
    table, odds = spark.sparkContext.broadcast(ratios), -float(np.log(prior_odds))  # 37 KB
    found = append(
        docs, text_col, "_found", _ROW, lambda texts: [_row(t, table.value, odds) for t in texts], [id_col]
    )
    return found.select(F.col(f"`{id_col}`"), "_found.*")
