"""License notices in texts, exact and with small edits.

A text is read as words of letters and digits, lower-cased.  Exact search counts
the places where a phrase's words stand one after another.  Fuzzy search allows
k character edits for a notice (one in ``EDIT_EVERY`` characters): a notice is
cut into k + 1 pieces, and by the pigeonhole principle a place with at most k
edits holds one piece unchanged.  The pieces are searched exactly; around each
find, the regex library matches the whole notice with at most k errors on whole
words, and reports span and number of edits.

The score is the best match's 1 - edits / length of the notice: 1 for an exact
phrase, 0 if nothing is found.

Defined results: a null or empty text has no words, labels or score (0);
matches of one label that overlap are one span.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from metricstore.llm.arrays import ALNUM, LOWER, fresh, with_struct

#: Exact phrases and their labels (fixed values).
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Notices searched with edits, and their labels (fixed values).
NOTICES = {
    "under the mit license": "mit",
    "the mit license mit": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
    "creative commons attribution noncommercial": "cc-by-nc",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "bsd 3 clause license": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
}
EDIT_EVERY = 8

FIELDS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("places", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType())]))),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()), T.StructField("edits", T.IntegerType())]))),
    T.StructField("score", T.DoubleType()),
])
#: Every byte outside words becomes a blank, A-Z become a-z.
_BLANKED = bytes(int(b) if ALNUM[b] else 0x20 for b in LOWER)


def normal(text: bytes) -> bytes:
    """The words, each with a blank before it, and a blank at the end."""
    found = text.translate(_BLANKED).split()
    return b" " + b" ".join(found) + b" " if found else b" "


def exact(words: bytes, phrases: dict[str, str]) -> Iterator[tuple[str, int, int]]:
    """(label, first word, word after the last) of every place of a phrase, overlapping ones too."""
    for phrase, label in phrases.items():
        sought = b" " + phrase.encode() + b" "
        at = words.find(sought)
        seen, n = 0, 0
        while at >= 0:
            n += words.count(b" ", seen, at)
            seen = at
            yield label, n, n + phrase.count(" ") + 1
            at = words.find(sought, at + 1)


class FuzzySearch:
    def __init__(self, notices: dict[str, str], edit_every: int):
        import regex

        self.notices = []
        for notice, label in notices.items():
            k = max(1, len(notice) // edit_every)
            edges = np.linspace(0, len(notice), k + 2).astype(int).tolist()
            pieces = [(s, notice[s:e].encode()) for s, e in zip(edges, edges[1:])]
            pattern = regex.compile(rf"(?b)(?<= )(?:{regex.escape(notice, special_only=True)}){{e<={k}}}(?= )")
            self.notices.append((label, notice, k, pieces, pattern))

    def find(self, words: bytes) -> Iterator[tuple[str, int, int, int, float]]:
        """(label, first word, word after the last, edits, likeness)."""
        for label, notice, k, pieces, pattern in self.notices:
            near = []
            for offset, piece in pieces:
                at = words.find(piece)
                while at >= 0:
                    near.append((at - offset - k, at - offset + len(notice) + k))
                    at = words.find(piece, at + 1)
            for s, e in _joined(near):
                # to whole words, with a blank on either side
                s = words.rfind(b" ", 0, max(1, s))
                e = words.find(b" ", min(max(e, s + 1), len(words) - 1)) + 1
                part = words[s:e].decode("utf-8", "replace")
                for start, found, edits in _best_first(pattern, part):
                    first = words.count(b" ", 0, s + len(part[:start].encode())) - 1
                    yield label, first, first + found.strip().count(" ") + 1, edits, max(0.0, 1 - edits / len(notice))


def _best_first(pattern, part: str) -> Iterator[tuple[int, str, int]]:
    """(start, text, edits) of the best match, then of those before it and behind it."""
    left = [(0, len(part))]
    while left:
        start, end = left.pop()
        m = pattern.search(part, start, end)
        if m is None:
            continue
        if m.end() <= m.start():
            left.append((m.end() + 1, end))
            continue
        if m.group().strip():
            yield m.start(), m.group(), sum(m.fuzzy_counts)
        left += [(start, m.start()), (m.end(), end)]


def _joined(near: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    near.sort()
    now = None
    for s, e in near:
        if now and s <= now[1]:
            now = (now[0], max(e, now[1]))
        else:
            if now:
                yield now
            now = (s, e)
    if now:
        yield now


def _merged(spans: list[tuple]) -> list[dict]:
    out: list[dict] = []
    for label, start, end, edits, _ in sorted(spans):
        last = out[-1] if out else None
        if last and last["label"] == label and start < last["end"]:
            last["end"], last["edits"] = max(end, last["end"]), min(edits, last["edits"])
        else:
            out.append({"label": label, "start": start, "end": end, "edits": edits})
    return out


def find_notices(docs: DataFrame, name: str = "licenses", text: str = "text", phrases: dict[str, str] = PHRASES,
                 notices: dict[str, str] = NOTICES, edit_every: int = EDIT_EVERY) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (FIELDS; places are exact, spans fuzzy, both in words), and its name."""
    col, place = fresh(docs.columns, name), docs.columns.index(text)
    place_kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    span_kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                    ("edits", pa.int32())]))

    def make():
        search = FuzzySearch(notices, edit_every)

        def one(batch: pa.RecordBatch) -> pa.Array:
            n_words, places, spans, scores = [], [], [], []
            for text in batch.column(place).cast(pa.binary()):
                words = normal(text.as_py() or b"")
                n_words.append(words.count(b" ") - 1)
                sure = list(exact(words, phrases))
                close = list(search.find(words))
                places.append([{"label": a, "start": s, "end": e} for a, s, e in sure])
                spans.append(_merged(close))
                scores.append(max([1.0] * bool(sure) + [x[4] for x in close], default=0.0))
            return pa.StructArray.from_arrays(
                [pa.array(n_words, pa.int64()), pa.array(places, place_kind), pa.array(spans, span_kind),
                 pa.array(scores, pa.float64())], names=["n_words", "places", "spans", "score"])

        return one

    return with_struct(docs, col, FIELDS, make), col
