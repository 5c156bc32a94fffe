"""Plain forms of the operators, for small tables."""

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}
LAST = 1 << 63


def key(doc):
    return LAST if doc is None else doc


def removed(rows, width):
    """Covered symbols of each row; rows: (id, symbols)."""
    first = {}
    for d, s in rows:
        for i in range(len(s) - width + 1):
            w = s[i:i + width]
            first[w] = min(first.get(w, LAST), key(d))
    out = []
    for d, s in rows:
        gone = [False] * len(s)
        for i in range(len(s) - width + 1):
            if first[s[i:i + width]] < key(d):
                gone[i:i + width] = [True] * width
        out.append(gone)
    return out


def suffix_dedup(rows, width=50):
    raw = [(d, (t or "").encode()) for d, t in rows]
    out = []
    for (d, b), gone in zip(raw, removed(raw, width)):
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def substring_dedup(rows, width=13):
    words = [(d, tuple(WORD.findall(t or ""))) for d, t in rows]
    return [(d, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
            for (d, w), gone in zip(words, removed(words, width))]


def shingle_set(text, width):
    w = tuple(WORD.findall((text or "").translate(LOWER)))
    if len(w) < width:
        return frozenset([w] if w else [])
    return frozenset(w[i:i + width] for i in range(len(w) - width + 1))


def components(rows, width, percent=80):
    sets = {d: shingle_set(t, width) for d, t in rows}
    up = {d: d for d in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    has = defaultdict(list)
    for d in sorted(sets):
        common = Counter(e for s in sets[d] for e in has[s])
        for e, n in common.items():
            if 100 * n >= percent * (len(sets[d]) + len(sets[e]) - n):
                a, b = sorted((find(d), find(e)))
                up[b] = a
        for s in sets[d]:
            has[s].append(d)
    return {d: (len(sets[d]), find(d)) for d in sets}


def rules(text):
    t = text or ""
    w = WORD.findall(t)
    count = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    gone = [False] * len(w)
    for i in range(len(w) - 4):
        if count[tuple(w[i:i + 5])] > 1:
            gone[i:i + 5] = [True] * 5
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), sum(gone)
