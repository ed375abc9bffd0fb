"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, plus signs, digits,
URL schemes and identifier cues.  From each anchor a parser of fixed rules grows to the left
and right, checks what it found, and never reads a character of a run twice, so time
is linear in the text.

Kinds, in the order that breaks ties: email, ip, card, phone (the base kinds, leftmost and without
overlap within a kind), then url (with a user part, or mailto:, tel:, sip:), street and
account (IBAN with its check digits, US social security numbers, account numbers after a cue).

Defined results: a null or empty text has no spans; equal rows get equal results;
positions are code points with the end exclusive; spans of different kinds may overlap.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ionweave.llm.textual import append, digest_of_spans, free_name, sha256_hex

KINDS = ("email", "ip", "card", "phone", "url", "street", "account")
BASE = KINDS[:4]
EMAIL, IP, CARD, PHONE, URL, STREET, ACCOUNT = range(7)

#: Words that announce an identifier, and words that end a street's name.
IBAN_CUES = ("iban",)
NUMBER_CUES = ("account", "acct", "konto", "cuenta", "compte")
SOCIAL_CUES = ("ssn", "social security")
STREET_CUES = ("street", "avenue", "road", "lane", "boulevard", "drive")
USER_SCHEMES = ("mailto:", "tel:", "sip:")

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_SCHEME = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PARTS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_AUTHORITY = re.compile(r"[A-Za-z0-9._~%!$&'()*+,;=:-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?::[0-9]+)?(?:[/?#][^\s\"<>]*)?")
_USER = re.compile(r"[A-Za-z0-9._%+@-]*[A-Za-z0-9]")
_IBAN = re.compile(r"[\s:#.]{0,4}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
_NUMBER = re.compile(r"(?:\s?(?:no\.?|number|nr\.?|#))?\s?[:#=]?\s?([0-9](?:[ -]?[0-9]){5,19})(?![0-9])", re.I | re.A)
_SOCIAL = re.compile(r"(?:\s?(?:no\.?|number|#))?\s?[:#=]?\s?([0-9]{3}-[0-9]{2}-[0-9]{4})(?![0-9])", re.I | re.A)
_HOUSE = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,5} (?:[A-Z][A-Za-z'.-]{0,24} ){1,4}\Z", re.A)
_HOUSE_CHARS = 120  # longer than any match of _HOUSE


@cache
def _anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    for kind, cues in (
        ("iban", IBAN_CUES), ("number", NUMBER_CUES), ("social", SOCIAL_CUES),
        ("street", STREET_CUES), ("user", USER_SCHEMES),
    ):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
                found.add_word(form, (kind, len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def iban_holds(value: str) -> bool:
    """Length and check digits; value without spaces."""
    if not 15 <= len(value) <= 34:
        return False
    turned = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _bounded(text: str, start: int) -> bool:
    return start == 0 or not text[start - 1].isalnum()


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every span."""
    spans: list[tuple[int, int, int]] = []
    email_from = last_at = phone_from = ip_from = card_from = url_from = 0
    for end, (kind, length) in _anchors().iter(text):
        start = end - length + 1
        if kind == "digit":
            if start >= ip_from:
                run = _PARTS.match(text, start)
                ip_from = run.end()
                if ip_from - start >= 7:
                    _addresses(text, start, ip_from, spans)
            if start >= card_from:
                run = _CARD.match(text, start)
                card_from = run.end() if run else start + 1
                if card_from - start >= 12:
                    digits = run[0].replace(" ", "").replace("-", "")
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        spans.append((start, CARD, card_from))
        elif kind == "at":
            before = text[max(email_from, last_at) : start]
            size = len(before) - len(before.rstrip(_LOCAL))
            last_at = start + 1
            if size and (domain := _DOMAIN.match(text, start + 1)):
                email_from = domain.end()
                spans.append((start - size, EMAIL, email_from))
        elif kind == "plus":
            if start >= phone_from and (run := _PHONE.match(text, start)):
                phone_from = run.end()
                if 9 <= sum(map(run[0].count, "0123456789")) <= 15:
                    spans.append((start, PHONE, phone_from))
        elif kind == "scheme":
            before = text[max(url_from, start - 32) : start]
            size = len(before) - len(before.rstrip(_SCHEME))
            if size and start >= url_from and (rest := _AUTHORITY.match(text, end + 1)):
                url_from = rest.end()
                spans.append((start - size, URL, url_from))
        elif kind == "user":
            if start >= url_from and _bounded(text, start) and (rest := _USER.match(text, end + 1)):
                value = rest[0]
                if "@" in value or sum(c.isdigit() for c in value) >= 7:
                    url_from = rest.end()
                    spans.append((start, URL, url_from))
        elif kind == "street":
            if not text[end + 1 : end + 2].isalnum():
                house = _HOUSE.search(text, max(0, start - _HOUSE_CHARS), start)
                if house:
                    spans.append((house.start(), STREET, end + 1))
        elif _bounded(text, start):
            pattern = {"iban": _IBAN, "number": _NUMBER, "social": _SOCIAL}[kind]
            found = pattern.match(text, end + 1)
            if found and (kind != "iban" or iban_holds(found[1].replace(" ", ""))):
                if kind != "social" or (found[1][:3] not in ("000", "666") and found[1][0] != "9"):
                    spans.append((found.start(1), ACCOUNT, found.end(1)))
    return sorted(set(spans))


def _addresses(text: str, start: int, end: int, spans: list) -> None:
    """Each four parts of a dotted run are an address if no part is above 255."""
    parts, at = text[start:end].split("."), start
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        size = sum(map(len, four)) + 3
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
            spans.append((at, IP, at + size))
        at += size + 1


def redacted(text: str) -> str:
    """The text with each stretch covered by spans replaced by ``[kind]`` of its first span."""
    out, at, i = [], 0, 0
    spans = find(text)
    while i < len(spans):
        start, kind, end = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][2])
            i += 1
        out += (text[at:start], f"[{KINDS[kind]}]")
        at = end
    return text if not out else "".join([*out, text[at:]])


_ROW = StructType(
    [StructField(f"n_{k}", LongType()) for k in KINDS]
    + [StructField("base_sha256", StringType()), StructField("spans", StringType())]
)


def _rows(texts: list[str]) -> list[dict]:
    out = []
    for text in texts:
        spans = find(text)
        row = {f"n_{k}": 0 for k in KINDS}
        for _, kind, _ in spans:
            row[f"n_{KINDS[kind]}"] += 1
        row["base_sha256"] = sha256_hex(digest_of_spans([s for s in spans if s[1] < len(BASE)], KINDS))
        row["spans"] = digest_of_spans(spans, KINDS)
        out.append(row)
    return out


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, counts per kind, the digest of the base spans, all spans as text."""
    found = append(docs, text_col, "_found", _ROW, _rows, [id_col])
    return found.select(F.col(f"`{id_col}`"), "_found.*")


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in ``text_col``; a null text stays null, all other columns stay."""
    name = free_name(docs.columns, "_redacted")
    done = append(docs, text_col, name, StringType(), lambda texts: [redacted(t) for t in texts])
    clean = F.when(F.col(f"`{text_col}`").isNotNull(), F.col(name)).alias(text_col)
    return done.select(*[clean if c == text_col else F.col(f"`{c}`") for c in docs.columns])
