"""Language identification by rank-order profiles.

A language's profile is the list of its ``top`` most frequent character n-grams
(1 to ``longest`` letters, words padded with blanks), counted over all training
documents.  A document is compared by out-of-place distance: its own ``top`` most
frequent n-grams, of all it holds, are ranked, and each of them adds how far its
rank is from the one in the profile, or ``top`` if the profile lacks it.  The
nearest language is the prediction.  Ties in rank go by the n-gram's code.

The score is 1 - distance / (largest possible distance): 1 for a document whose
ranks equal the profile's, 0 for one that shares nothing with it.

Defined results: ``und`` and score 0 for a null text, one without a letter, or
when no profile was learned; training rows with a null language or text teach
nothing; a tie between languages goes to the first by code point.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.llm.arrays import Cache, fresh, mix, with_struct

UND = "und"
FIELDS = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
_CHARS = 1 << 18
_LETTERS_END = 0x40000  # letters lie in the first four planes
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_tables: dict[str, np.ndarray] = Cache()


def _letters() -> np.ndarray:
    """Of every code point: its lower-case letter, or 0 if it is none."""
    if "lower" not in _tables:
        out = np.zeros(sys.maxunicode + 1, np.uint32)
        for c in range(_LETTERS_END):
            if (s := chr(c)).isalpha():
                low = s.lower()
                out[c] = ord(low) if len(low) == 1 else c
        _tables["lower"] = out
    return _tables["lower"]


def _text_runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    row = 0
    while row < len(texts):
        end, size = row, 0
        while end < len(texts) and (end == row or size + len(texts[end] or "") <= _CHARS):
            size += len(texts[end] or "")
            end += 1
        yield row, end
        row = end


def _words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(letters, word starts, word ends, text of each word) of a run of texts."""
    sizes = np.array([len(t or "") + 1 for t in texts], np.int64)
    points = np.frombuffer("\n".join([*(t or "" for t in texts), ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _letters()[points]
    inside = (low > 0).astype(np.int8)
    edge = np.diff(np.concatenate([[0], inside, [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return low, starts, ends, np.searchsorted(np.cumsum(sizes), starts, "right")


def _distinct(low, starts, ends) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct word, number of each word's distinct one), by a 64-bit hash."""
    power = np.full(len(low) + 1, _PRIME, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    back = np.full(len(low) + 1, np.uint64(pow(int(_PRIME), -1, 1 << 64)), np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(low.astype(np.uint64) * power[:-1])])
    _, place, of = np.unique(mix((total[ends] - total[starts]) * back[starts]), return_index=True, return_inverse=True)
    return place, of


def _grams(low, starts, ends, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, n-gram code) of every n-gram of the given words; letters are 21 bits, the blank is 1.

    A word's n-grams are those of the word with a blank before and after it, except the blank alone.
    """
    size = ends - starts + 2
    first = np.cumsum(size) - size
    flat = np.ones(int(size.sum()), np.uint64)
    word = np.repeat(np.arange(len(starts)), size)
    at = np.arange(len(flat)) - first[word]
    body = (at > 0) & (at < size[word] - 1)
    flat[body] = low[starts[word[body]] + at[body] - 1]
    left = size[word] - at
    codes, of = [flat[body]], [word[body]]
    code = flat
    for n in range(2, longest + 1):
        code = (code[:-1] << np.uint64(21)) | flat[n - 1:]
        keep = left[:len(code)] >= n
        codes.append(code[keep])
        of.append(word[:len(code)][keep])
    return np.concatenate(of), np.concatenate(codes)


def gram_counts(docs: DataFrame, lang: str, text: str, longest: int) -> DataFrame:
    """(lang, gram, n) over all rows with a language and a text; pre-added in each run of texts."""
    schema = "lang string, gram long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for row, end in _text_runs(texts):
                names = sorted(set(langs[row:end]))
                of_text = np.array([names.index(x) for x in langs[row:end]])
                low, starts, ends, text_of = _words(texts[row:end])
                if not len(starts):
                    continue
                place, word_of = _distinct(low, starts, ends)
                word, code = _grams(low, starts[place], ends[place], longest)
                known, gram = np.unique(code, return_inverse=True)
                times = np.bincount(of_text[text_of] * len(place) + word_of, minlength=len(names) * len(place))
                for k, name in enumerate(names):
                    n = np.bincount(gram, times[k * len(place):(k + 1) * len(place)][word], len(known)).astype(np.int64)
                    some = n > 0
                    yield pa.RecordBatch.from_arrays([
                        pa.array([name] * int(some.sum()), pa.string()), pa.array(known[some].view(np.int64)),
                        pa.array(n[some])], names=["lang", "gram", "n"])

    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    return rows.mapInArrow(run, schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(docs: DataFrame, lang: str = "lang", text: str = "text", top: int = 400,
                   longest: int = 3) -> dict[str, list[int]]:
    """The profile of each language: n-gram codes, the most frequent first. ``top`` codes a language reach the driver."""
    if not 1 <= longest <= 3:
        raise ValueError("n-grams have 1 to 3 letters")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    counts = gram_counts(docs, lang, text, longest)
    out: dict[str, list[int]] = {}
    for r in counts.withColumn("rank", rank).where(F.col("rank") <= top).orderBy("lang", "rank").collect():
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


class Ranker:
    def __init__(self, profiles: dict[str, list[int]], top: int, longest: int):
        self.names = sorted(profiles)
        self.top, self.longest = top, longest
        self.grams = np.array(sorted({g for p in profiles.values() for g in p}), np.uint64)
        self.ranks = np.full((len(self.names), len(self.grams)), -1, np.int64)
        for k, name in enumerate(self.names):
            self.ranks[k, np.searchsorted(self.grams, np.array(profiles[name], np.uint64))] = np.arange(len(profiles[name]))

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        for row, end in _text_runs(texts):
            yield from self._run(texts[row:end])

    def _run(self, texts):
        low, starts, ends, text_of = _words(texts)
        n = len(texts)
        if not len(starts) or not self.names:
            yield from [(UND, 0.0)] * n
            return
        place, word_of = _distinct(low, starts, ends)
        word, code = _grams(low, starts[place], ends[place], self.longest)
        order = np.argsort(word, kind="stable")
        word, code = word[order], code[order]
        coded = pa.array(code.view(np.int64)).dictionary_encode()
        codes = coded.dictionary.to_numpy().view(np.uint64)
        by_code = np.argsort(codes)
        number = np.empty(len(codes), np.int64)
        number[by_code] = np.arange(len(codes))
        gram, codes = number[coded.indices.to_numpy()], codes[by_code]
        known = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        ranks = np.where(self.grams[known] == codes, self.ranks[:, known], -1)
        first = np.searchsorted(word, np.arange(len(place) + 1))
        bound = np.searchsorted(text_of, np.arange(n + 1))
        step = max(1, (1 << 18) // max(1, len(codes)))
        for s in range(0, n, step):
            e = min(n, s + step)
            yield from self._rows(e - s, text_of[bound[s]:bound[e]] - s, word_of[bound[s]:bound[e]], first, gram, ranks)

    def _rows(self, n, text_of, word_of, first, gram, ranks):
        pairs, times = np.unique(text_of * len(first) + word_of, return_counts=True)
        of, word = pairs // len(first), pairs % len(first)
        size = first[word + 1] - first[word]
        at = np.repeat(first[word] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
        wide = ranks.shape[1]
        count = np.bincount(np.repeat(of, size) * wide + gram[at], np.repeat(times, size), n * wide).astype(np.int64).reshape(n, wide)
        sought = -(count * wide - np.arange(wide))  # by frequency, then by code
        if wide > self.top:
            order = np.argpartition(sought, self.top - 1, axis=1)[:, :self.top]
            order = np.take_along_axis(order, np.argsort(np.take_along_axis(sought, order, 1), axis=1), 1)
        else:
            order = np.argsort(sought, axis=1)
        there = np.take_along_axis(count, order, 1) > 0
        own = np.arange(order.shape[1])
        far = np.empty((len(self.names), n), np.int64)
        for k in range(len(self.names)):
            rank = ranks[k][order]
            off = np.where(rank < 0, self.top, np.abs(rank - own[None, :]))
            far[k] = (off * there).sum(axis=1)
        most = there.sum(axis=1) * self.top
        letters = np.zeros(n, bool)
        letters[text_of] = True
        best = far.argmin(axis=0)
        for r in range(n):
            if not letters[r]:
                yield UND, 0.0
            else:
                yield self.names[best[r]], 1.0 - float(far[best[r], r]) / most[r] if most[r] else 0.0


def identify(docs: DataFrame, profiles: dict[str, list[int]], name: str = "language", text: str = "text",
             top: int = 400, longest: int = 3) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (lang, score), and the column's name. Only the text is looked at."""
    col, place = fresh(docs.columns, name), docs.columns.index(text)

    def make():
        ranker = Ranker(profiles, top, longest)

        def one(batch: pa.RecordBatch) -> pa.Array:
            found = list(ranker.predict(batch.column(place).to_pylist()))
            return pa.StructArray.from_arrays(
                [pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                names=["lang", "score"])

        return one

    return with_struct(docs, col, FIELDS, make), col
