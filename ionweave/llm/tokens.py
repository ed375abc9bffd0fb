"""Fast exact token ids of whole texts with a public tokenizer file.

The two families of pre-tokenizers used here never join characters across certain
white space, so a text is the concatenation of pieces that can be encoded alone:

* byte level: a space goes with the characters behind it, up to the next space;
* word level: white space is dropped.

Arrow splits a batch of texts and finds its distinct pieces; only these are looked at one by one.
The ids of their parts are kept in a bounded cache per worker.  New parts are encoded by the
tokenizers library: those of printable ASCII and Latin-1 letters, which its normalizer can only
lower, by its model alone, the others by the whole library.  A text with white space outside ASCII, or
in places where pieces cannot be told apart, goes through the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

_SPACE = " \t\n\r\f\v"
_FIRST, _NEXT_LINE = "\x01", "\x02"  # stand before the first piece of a text, and of a line
_ODD = r"[\x{01}\x{02}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]"
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGN = r"!-/:-@\[-`{-~"
_BYTE_PARTS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[{_SIGN}]+|\n")
_WORD_PARTS = re.compile(
    rf"'[sS]|'[tT]|'[rR][eE]|'[vV][eE]|'[mM]|'[lL][lL]|'[dD]|[{_LETTER}]+|[0-9]|[{_SIGN}]+"
)
_LONGEST_KEPT = 64  # characters of a part that may be kept
_WORDS_AT_ONCE = 250_000  # pieces whose ids are put together at a time


def _byte_letters() -> str:
    """Letter that stands for each byte: printable Latin-1 for itself, the others from 256 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return "".join(chr(b if b in own else next(rest)) for b in range(256))


_LETTERS = _byte_letters()


class Kept(dict):
    """Cache of bounded size: when full, its entries become the old ones and the oldest go."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= _LONGEST_KEPT:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Ids of texts, as unsigned numbers of the smallest width that holds the vocabulary."""

    def __init__(self, path: str, limit: int = 250_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.width = 2 if self.tokenizer.get_vocab_size() <= 65536 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        setup = json.loads(self.tokenizer.to_str())
        self.family = _family(setup)
        self.coded = [i.to_bytes(self.width, "little") for i in range(self.tokenizer.get_vocab_size())]
        marks = "".join(re.escape(c) for c in sorted({t["content"][0] for t in setup["added_tokens"]}))
        plain = f"(?:(?![{marks}])[!-~{_LETTER[6:]}])+" if marks else f"[!-~{_LETTER[6:]}]+"
        self.plain = re.compile(f" ?{plain}" if self.family == "byte" else plain)
        self.parts = Kept(self._part, limit // 4)
        self.words = Kept(self._spaced_word if self.family == "byte" else self._word, limit)

    def by_library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct pieces, place of each piece among them, first piece of each text, texts not to be cut."""
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False).astype(bool)
        if self.family == "word":
            lists = pc.ascii_split_whitespace(texts)
        else:
            marked = pc.binary_join_element_wise(pa.scalar(_FIRST, texts.type), texts, "")
            lists = pc.split_pattern(pc.replace_substring(marked, "\n", " " + _NEXT_LINE), " ")
        found = lists.flatten().dictionary_encode()
        bounds = lists.offsets.to_numpy().astype(np.int64)
        return found.dictionary, found.indices.to_numpy(), bounds - bounds[0], odd

    def _halves(self, pieces: pa.Array) -> tuple[list[bytes | None], np.ndarray, np.ndarray]:
        """Ids of units, and the two units that make up each piece.

        A word with a full stop or a comma is two units, so that words are looked up once; any
        other piece is one.  Unit 0 is empty.
        """
        word = pc.match_substring_regex(pieces, f"^[{_LETTER}]+[.,]?$").to_numpy(zero_copy_only=False).astype(bool)
        bare = pc.utf8_rtrim(pieces, ".,")
        signed = word & (pc.utf8_length(bare).to_numpy() < pc.utf8_length(pieces).to_numpy())
        if self.family == "word":
            bare = pc.utf8_lower(bare)
        found = pc.if_else(pa.array(word), bare, pa.scalar(None, pieces.type)).dictionary_encode()
        units: list[bytes | None] = [b"", self.parts["."], self.parts[","]]
        units += map(self.words.__getitem__, found.dictionary.to_pylist())
        one = found.indices.fill_null(0).to_numpy().astype(np.int64) + 3
        two = np.zeros(len(pieces), np.int64)
        two[signed] = np.where(pc.ends_with(pieces, ".").to_numpy(zero_copy_only=False)[signed], 1, 2)
        rest = np.flatnonzero(~word)
        one[rest] = np.arange(len(units), len(units) + len(rest))
        units += list(map(self._piece, pieces.take(pa.array(rest)).to_pylist()))
        return units, one, two

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string array without nulls."""
        if self.family == "other":
            return [np.frombuffer(self.by_library(t), self.dtype) for t in texts.to_pylist()]
        pieces, place, bounds, odd = self._pieces(texts)
        units, one, two = self._halves(pieces)
        odd |= _any_in(np.fromiter((u is None for u in units), bool, len(units))[one][place], bounds)
        units = [u or b"" for u in units]
        size = np.fromiter(map(len, units), np.int64, len(units)) // self.width
        start = np.cumsum(size) - size
        blob = np.frombuffer(b"".join(units), self.dtype)
        out: list[np.ndarray] = []
        first = 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + _WORDS_AT_ONCE, "right")) - 1)
            own = place[bounds[first] : bounds[last]]
            both = np.empty(2 * len(own), np.int64)
            both[::2], both[1::2] = one[own], two[own]
            sizes = size[both]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            ids = blob[np.repeat(start[both] - ends + sizes, sizes) + np.arange(total)]
            cuts = np.concatenate(([0], ends))[2 * (bounds[first : last + 1] - bounds[first])]
            out += [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
            first = last
        for i in np.flatnonzero(odd).tolist():
            out[i] = np.frombuffer(self.by_library(texts[i].as_py()), self.dtype)
        return out

    def lengths(self, texts: pa.Array, known: Mapping[str, int] | None = None) -> np.ndarray:
        """Number of ids of each text; ``known`` holds the lengths of frequent pieces."""
        if self.family == "other":
            return np.array([len(i) for i in self.encode(texts)], np.int64)
        pieces, place, bounds, odd = self._pieces(texts)
        size = np.full(len(pieces), -2, np.int64)
        if known:
            size = np.fromiter((known.get(p, -2) for p in pieces.to_pylist()), np.int64, len(pieces))
        missed = np.flatnonzero(size == -2)
        units, one, two = self._halves(pieces.take(pa.array(missed)))
        own = np.fromiter((-1 if u is None else len(u) // self.width for u in units), np.int64, len(units))
        size[missed] = own[one] + own[two]
        out = np.diff(np.concatenate(([0], np.cumsum(size[place])))[bounds])
        odd |= _any_in((size < 0)[place], bounds)
        for i in np.flatnonzero(odd).tolist():
            out[i] = len(self.by_library(texts[i].as_py())) // self.width
        return out

    def piece_counts(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Distinct pieces of a batch and how often they occur; none for other layouts."""
        if self.family == "other":
            return pa.array([], pa.string()), np.empty(0, np.int64)
        pieces, place, _, _ = self._pieces(texts)
        return pieces, np.bincount(place, minlength=len(pieces))

    def piece_lengths(self, pieces: list[str]) -> dict[str, int]:
        """Number of ids of each piece; -1 if it cannot be told from its neighbours."""
        values = {p: self._piece(p) for p in pieces}
        return {p: -1 if v is None else len(v) // self.width for p, v in values.items()}

    def _piece(self, piece: str) -> bytes | None:
        """Ids of a piece; None if it cannot be told from its neighbours."""
        before = b""
        if self.family == "byte":
            mark = piece[:1]
            if mark == _FIRST and len(piece) == 1:
                return b""
            piece = piece[1:] if mark in (_FIRST, _NEXT_LINE) else " " + piece
            if not piece.strip(" ") or piece[-1] in _SPACE or piece.lstrip(" ")[0] in _SPACE:
                return None
            if mark == _NEXT_LINE:
                before = self.parts["\n"]
        if not piece:
            return b""
        last, word = piece[-1], piece[:-1]
        if last in ".," and word[-1:] <= "ÿ" and word.lstrip(" ").isalpha():  # the usual end of a word
            return before + self.parts[word] + self.parts[last]
        if piece.isalpha() or not self.plain.fullmatch(piece):
            return before + self.parts[piece]
        cut = (_BYTE_PARTS if self.family == "byte" else _WORD_PARTS).findall(piece)
        return b"".join([before, *map(self.parts.__getitem__, cut)])

    def _part(self, part: str) -> bytes:
        """Ids of one pre-token, or of anything that the fast path does not know."""
        if not self.plain.fullmatch(part) and part != "\n":
            return self.by_library(part)
        if self.family == "word":
            part = part.lower()
        return self._word(part)

    def _word(self, part: str) -> bytes:
        """Ids of a pre-token of printable ASCII, Latin-1 letters and spaces, by the model."""
        if not (part.isascii() and part.isalpha()):
            part = part.encode().decode("latin-1").translate(_LETTERS)
        coded = self.coded
        return b"".join([coded[t.id] for t in self.model.tokenize(part)])

    def _spaced_word(self, word: str) -> bytes:
        return self._word(" " + word)


def _any_in(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether any flag is set between each two bounds."""
    return np.diff(np.concatenate(([0], np.cumsum(flags)))[bounds]) > 0


def _family(setup: dict) -> str:
    """``byte`` or ``word`` for the two layouts whose pieces are known to be independent, else ``other``."""
    normalizer, pre = setup["normalizer"], setup["pre_tokenizer"]
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in setup["added_tokens"]):
        return "other"
    if any(set(t["content"]) & set(_SPACE) for t in setup["added_tokens"]) or setup["model"]["type"] != "BPE":
        return "other"
    if normalizer is None and pre and pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]:
        return "byte"
    steps = [n["type"] for n in (normalizer or {}).get("normalizers", [])]
    if steps == ["NFC", "Replace", "Lowercase"] and pre and pre["type"] == "Sequence":
        split, level = pre["pretokenizers"]
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        if split.get("pattern") == {"Regex": pattern} and level["type"] == "ByteLevel" and not level["use_regex"]:
            return "word"
    return "other"


@cache
def encoder(path: str) -> Encoder:
    """One per worker and file."""
    return Encoder(path)


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
