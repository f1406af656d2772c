"""Benchmark decontamination.

A benchmark item is read as windows of ``n`` consecutive words; an item with
fewer words, but not none, is one window.  The windows of all items form a hash
set that every task gets; training texts are scanned window by window, and each
hash hit is verified on the words themselves.

The benchmark's bytes are counted first.  Up to ``block_bytes`` of it travel in
one broadcast; a larger benchmark is taken in blocks of that size, each scanned
against all documents and written before the next, so no broadcast grows with
it.

Defined results: a null or empty text has no words and no hits; an item without
words matches nothing; repeated items and repeated rows count each; an empty
benchmark leaves every document clean; input columns pass through unchanged and
the result is one struct column whose name gets underscores if it is taken.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.llm.arrays import ALNUM, constants, fresh, runs, windows, with_struct, words
from metricstore.llm.store import stored

FIELDS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])
_BITS = 20


class WindowSet:
    """Hashes of all windows of a block of items, and the words behind each."""

    def __init__(self, items: list[tuple[str, str]], n: int):
        self.mult = constants(n, 1)
        self.items: dict[bytes, set[str]] = {}
        found: dict[int, list[np.ndarray]] = {}
        col = pa.array([t for _, t in items], pa.string())
        for row, end, buf, offs in runs(col):
            w = words(buf, offs, ALNUM)
            count = np.diff(w.first)
            for size in {min(n, int(c)) for c in count if c}:
                at, hashes = windows(w, size, self.mult)
                of = np.searchsorted(w.first, at, "right") - 1
                mine = (count[of] == size) | (size == n)
                found.setdefault(size, []).append(hashes[mine])
                for i, r in zip(at[mine], of[mine]):
                    self.items.setdefault(w.window(i, size), set()).add(items[row + r][0])
        self.hashes = {size: np.unique(np.concatenate(x)) for size, x in found.items()}
        self.maybe = {}
        for size, x in self.hashes.items():
            self.maybe[size] = np.zeros(1 << _BITS, bool)
            self.maybe[size][x >> np.uint64(64 - _BITS)] = True

    def hits(self, w):
        """(first word, number of words, items) of every verified occurrence."""
        for size, known in self.hashes.items():
            at, hashes = windows(w, size, self.mult)
            near = self.maybe[size][hashes >> np.uint64(64 - _BITS)]
            at, hashes = at[near], hashes[near]
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for i in at[known[place] == hashes]:
                items = self.items.get(w.window(i, size))
                if items:
                    yield int(i), size, items


def _scan(text: int, windows_of, before: int | None):
    """The function of a batch; ``before``: the column with the result of earlier blocks."""

    def one(batch: pa.RecordBatch) -> pa.Array:
        n_words, n_hit, items, spans = [], [], [], []
        old = batch.column(before).to_pylist() if before is not None else None
        known = windows_of()
        for row, end, buf, offs in runs(batch.column(text)):
            w = words(buf, offs, ALNUM)
            edge = np.zeros(len(w.starts) + 1, np.int64)
            mine: dict[int, set[str]] = {}
            for i, size, ids in known.hits(w):
                edge[i] += 1
                edge[i + size] -= 1
                r = int(np.searchsorted(w.first, i, "right")) - 1
                mine.setdefault(r, set()).update(ids)
            for r in range(end - row) if old else ():
                for s in (old[row + r] or {}).get("spans") or ():
                    edge[w.first[r] + s["start"]] += 1
                    edge[w.first[r] + s["end"]] -= 1
                if (old[row + r] or {}).get("items"):
                    mine.setdefault(r, set()).update(old[row + r]["items"])
            hit = np.cumsum(edge[:-1]) > 0
            upto = np.concatenate([[0], np.cumsum(hit)])
            n_words += np.diff(w.first).tolist()
            n_hit += (upto[w.first[1:]] - upto[w.first[:-1]]).tolist()
            for r in range(end - row):
                items.append(sorted(mine.get(r, ())))
                spans.append(_spans(hit[w.first[r]:w.first[r + 1]]) if r in mine else [])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
             pa.array(items, pa.list_(pa.string())), pa.array(spans, kind)],
            names=["n_words", "n_hit", "items", "spans"])

    return one


def _spans(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2])]


def find_hits(docs: DataFrame, benchmark: DataFrame, name: str = "decontam", text: str = "text",
              item: str = "item_id", item_text: str = "text", n: int = 10,
              block_bytes: int = 2 << 20) -> tuple[DataFrame, str]:
    """``docs`` with a struct column of hits (see FIELDS; spans count words), and its name."""
    spark: SparkSession = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("id"),
                             F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))
    out = docs
    before: str | None = None
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        shared = spark.sparkContext.broadcast([(r["id"], r["text"]) for r in part.collect()])
        col = fresh(out.columns, name)
        place, old = docs.columns.index(text), out.columns.index(before) if before else None
        made = with_struct(out, col, FIELDS, _task(shared, n, place, old))
        out = made.drop(before) if before else made
        before = col
        if blocks > 1:
            out = stored(out, "decontam")
    return out, before


def _task(shared, n: int, place: int, old: int | None):
    def make():
        cache = []

        def windows_of() -> WindowSet:
            if not cache:
                cache.append(WindowSet(shared.value, n))
            return cache[0]

        return _scan(place, windows_of, old)

    return make


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    out, hits = find_hits(docs, benchmark, **options)
    return out.where(F.col(hits)["n_hit"] == 0).select(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents; the words inside hits, and what stands between them, are cut from the text."""
    out, hits = find_hits(docs, benchmark, text=text, **options)
    place, where = out.columns.index(text), out.columns.index(hits)
    col = fresh(out.columns, "clean")

    def make():
        def one(batch: pa.RecordBatch) -> pa.Array:
            spans = batch.column(where).to_pylist()
            texts: list[str | None] = []
            known = batch.column(place).is_valid().to_pylist()
            for row, end, buf, offs in runs(batch.column(place)):
                w = words(buf, offs, ALNUM)
                for r in range(end - row):
                    keep, at = [], int(offs[r])
                    for s in spans[row + r]["spans"]:
                        keep.append(buf[at:w.starts[w.first[r] + s["start"]]].tobytes())
                        at = int(w.ends[w.first[r] + s["end"] - 1])
                    keep.append(buf[at:offs[r + 1]].tobytes())
                    texts.append(b"".join(keep).decode() if known[row + r] else None)
            return pa.StructArray.from_arrays([pa.array(texts, pa.string())], names=["text"])

        return one

    out = with_struct(out, col, T.StructType([T.StructField("text", T.StringType())]), make)
    return out.select(*[F.col(col)["text"].alias(c) if c == text else F.col(c) for c in docs.columns])
