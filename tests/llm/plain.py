"""Plain versions of the operators, row by row, to hold results against."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"
    r"[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def digits(text):
    return [int(c) for c in text if c in "0123456789"]


def luhn(text):
    total = 0
    for i, d in enumerate(reversed(digits(text))):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def private(text):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 12 <= len(digits(m[0])) <= 19 and luhn(m[0])]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(out)


def secret(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def digest(spans, kinds):
    return hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def targets(sizes, weights=(3, 1, 2), percent=150):
    """Source to target; excess is shared again until none is above."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, target = sum(sizes.values()) * percent / 100, set(order), {}
    while open_:
        each = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if weight[s] * each >= 2 * sizes[s]}
        if not above:
            target |= {s: weight[s] * each for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in above}
        left -= sum(2.0 * sizes[s] for s in above)
        open_ -= above
    return target


def shingles(text, n=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def jaccard_components(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 4 * min(len(a), len(b)) >= 3 * max(len(a), len(b)):
                inner = len(a & b)
                if 100 * inner >= 75 * (len(a) + len(b) - inner):
                    parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(sets):
        r = root(i)
        least[r] = min((x for x in (least.get(r), doc) if x is not None), default=None)
    return sorted(((d, len(s), least[root(i)]) for i, (d, s) in enumerate(sets)), key=str)


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(runs)
    covered = {i + k for i, r in enumerate(runs) if count[r] > 1 for k in range(5)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)), "n_repeat_words": len(covered),
    }


def crc(ids):
    return zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))


def repeated_sentences(rows, run=3):
    """doc -> numbers of sentences in a run that occurred before, by (doc_id, position)."""
    from ionweave.llm.sentence_spans import sentences

    seen, gone = set(), defaultdict(set)
    for doc, text in sorted(rows):
        low = [text[a:b].strip().lower() for a, b in sentences(text or "")]
        for i in range(len(low) - run + 1):
            key = tuple(low[i : i + run])
            if key in seen:
                gone[doc] |= set(range(i, i + run))
            seen.add(key)
    return gone


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def ranked(docs, items, top=50):
    """(item_id, rank, doc_id, score)."""
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    counts = [(i, Counter(term.findall(low(t or "")))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(n for *_, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c, n in counts:
            m, score = 50 + (50 * n * n_docs) // n_terms, 0
            for t in set(term.findall(low(text or ""))) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, i, -s) for k, (s, _, _, i) in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return out


def without_lines(rows, shortest=20, least=3):
    """(doc_id, n_lines, n_dropped, text)."""
    keyed = [(i, [(x, low(x.strip(" \t\n\r\f\v"))) for x in (t or "").split("\n")]) for i, t in rows]
    holders = defaultdict(list)
    for i, lines in keyed:
        for key in {k for _, k in lines if len(k) >= shortest}:
            holders[key].append(i)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items() if len(ids) >= least}
    out = []
    for i, lines in keyed:
        kept = [x for x, k in lines if k not in last or last[k] == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def one_edit(word, letters):
    """All words one edit away."""
    out = {word[:p] + word[p + 1 :] for p in range(len(word))}
    for p in range(len(word) + 1):
        out |= {word[:p] + c + word[p:] for c in letters} | {word[:p] + c + word[p + 1 :] for c in letters if p < len(word)}
    return out - {word}


def spelling(rows):
    """(word, form, root, n, n_near, form_n)."""
    counts = Counter()
    for i, t in rows:
        for run in map(low, re.findall("[A-Za-z\u00C0-\u00FF]+", t or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    by_length = defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)

    def are_near(a, b):
        if len(a) > len(b):
            a, b = b, a
        p = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
        return a != b and a[p + (len(a) == len(b)) :] == b[p + 1 :]

    near = {w: [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if are_near(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= 10 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return out
