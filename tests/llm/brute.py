"""Plain single-process versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(b: bytes | str) -> str:
    return hashlib.sha256(b.encode() if isinstance(b, str) else b).hexdigest()


def distinct(rows):
    """One (doc_id, text) per named document, ascending."""
    return sorted({(d, t or "") for d, t in rows if d is not None})


def passages(rows, size=50):
    first, words, out = {}, {}, {}
    for d, t in distinct(rows):
        words[d] = w = WORD.findall(t)
        for i in range(len(w) - size + 1):
            first.setdefault(tuple(w[i : i + size]), d)
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone[i : i + size] = [True] * size
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def repeated_bytes(rows, size=100):
    seen, out = set(), {}
    for d, t in distinct(rows):
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            k = b[i : i + size]
            if k in seen:
                gone[i : i + size] = b"\x01" * size
            seen.add(k)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), sha(kept), kept)
    return out


def near_groups(rows, shingle, percent=80):
    sets = {}
    for d, t in distinct(rows):
        w = WORD.findall(t.translate(LOWER))
        sets[d] = {tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} if w else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            m, x, y = len(sets[a] & sets[b]), len(sets[a]), len(sets[b])
            if m and 100 * m >= percent * (x + y - m):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {d: (len(sets[d]), find(d)) for d in sets}


def leaks(rows, items, similarity=0.8):
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    grams = lambda w, k: Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = defaultdict(float)
    for i, t in {(i, t) for i, t in items}:
        item = split(t)
        k = min(5, len(item))
        if not item:
            continue
        own = grams(item, k)
        for d, text in distinct(rows):
            w = split(text)
            m = min(len(item), len(w))
            for s in range(len(w) - m + 1 if m >= k else 0):
                g = grams(w[s : s + m], k)
                n = sum((g & own).values())
                v = n / (sum(g.values()) + sum(own.values()) - n)
                if v >= similarity:
                    out[d, i] = max(out[d, i], v)
    return dict(out)
