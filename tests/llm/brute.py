"""Plain Python versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SOLID = re.compile(r"[^\x20\x09-\x0D]+")


def alnum_words(text):
    return ALNUM.findall((text or "").translate(LOW))


def solid_words(text):
    return SOLID.findall((text or "").translate(LOW))


def op1(docs, items, n=10):
    """docs, items: [(id, text)] -> {id: (n_words, n_hit, n_items, sha, contaminated)}"""
    known = {}
    for item, text in items:
        w = alnum_words(text)
        for i in range(max(1, len(w) - n + 1) if w else 0):
            known.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    sizes = {len(k) for k in known}
    out = {}
    for doc, text in docs:
        w = alnum_words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                got = known.get(tuple(w[i:i + size]))
                if got:
                    hit.update(range(i, i + size))
                    found |= got
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), sha, bool(hit))
    return out


def shingles(text, size=5):
    w = solid_words(text)
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def op9(docs, size=5, percent=75):
    """docs: [(id, text)] -> {id: (n, component)}"""
    sets = {d: shingles(t, size) for d, t in docs}
    at = {}
    for d, s in sets.items():
        for x in s:
            at.setdefault(x, []).append(d)
    up = {d: d for d in sets}

    def root(d):
        while up[d] != d:
            up[d] = up[up[d]]
            d = up[d]
        return d

    for d, s in sets.items():
        both = {}
        for x in s:
            for o in at[x]:
                if o < d:
                    both[o] = both.get(o, 0) + 1
        for o, n in both.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                a, b = sorted((root(d), root(o)))
                up[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def op10(text, phrases):
    """(n_words, [(label, start)]) of the exact phrases."""
    w = alnum_words(text)
    places = []
    for phrase, label in phrases.items():
        p = phrase.split()
        places += [(label, i) for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    return len(w), places


def remainder(doc_id, by):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % by
