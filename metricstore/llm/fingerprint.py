"""Quartile bucket digests of documents, and their likeness.

Byte triplets from a sliding window are hashed into ``BUCKETS`` counters.  The
digest is hexadecimal: a byte for the length (logarithmic, bounded), a byte for
the ratios of the counters' quartiles, then two bits per bucket for the quarter
its count falls in.  The difference of two digests adds the distances of their
buckets (opposite quarters count double), lengths and ratios, and is bounded by
``FAR``; likeness is 1 at no difference and 0 at ``FAR`` or more.

Defined results: a null or empty text, and one under three bytes, has no
triplets: all counts are 0 and its digest says only its length.  Equal texts
have equal digests.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.llm.arrays import runs
from metricstore.llm.store import stored

BUCKETS = 128
FAR = 256
#: Places of a triplet's bytes in the window, and the hash's start for each.
_TRIPLETS = ((0, 1, 2, 0x2F0B), (0, 1, 3, 0x6C37), (0, 2, 3, 0xB5A1))


def _counts(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(rows, BUCKETS) counts of hashed triplets."""
    n = len(offsets) - 1
    out = np.zeros(n * BUCKETS, np.int64)
    wide = buf.astype(np.uint32)
    row = np.repeat(np.arange(n, dtype=np.int64) * BUCKETS, np.diff(offsets))
    left = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(buf))  # bytes up to the row's end
    for i, j, k, salt in _TRIPLETS:
        m = len(buf) - k
        if m <= 0:
            continue
        h = wide[i:m + i] * np.uint32(0x01000193) + wide[j:m + j]
        h = h * np.uint32(0x85EBCA6B) + wide[k:m + k] + np.uint32(salt)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0xC2B2AE35)
        h >>= np.uint32(25)
        inside = left[:m] > k
        out += np.bincount(row[:m][inside] + h[inside], minlength=n * BUCKETS)
    return out.reshape(n, BUCKETS)


def digests(col: pa.Array) -> np.ndarray:
    """(rows, 2 + BUCKETS) small integers: length code, ratio code, quarter of each bucket."""
    parts = []
    for _, _, buf, offs in runs(col):
        counts = _counts(buf, offs)
        ranks = np.sort(counts, axis=1)
        q = ranks[:, [BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
        quarter = (counts[:, :, None] > q[:, None, :]).sum(axis=2)
        length = np.minimum(255, np.round(np.log1p(np.diff(offs)) * 10))
        top = np.maximum(q[:, 2], 1)
        ratio = (q[:, 0] * 15 // top) * 16 + q[:, 1] * 15 // top
        parts.append(np.column_stack([length, ratio, quarter]).astype(np.uint8))
    return np.concatenate(parts) if parts else np.empty((0, 2 + BUCKETS), np.uint8)


def as_hex(d: np.ndarray) -> list[str]:
    q = d[:, 2:].reshape(len(d), -1, 4)
    packed = q[:, :, 0] * 64 + q[:, :, 1] * 16 + q[:, :, 2] * 4 + q[:, :, 3]
    return [x.tobytes().hex() for x in np.column_stack([d[:, :2], packed.astype(np.uint8)])]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """0 to 1 for rows of two arrays of digests."""
    x, y = a.astype(np.int64), b.astype(np.int64)
    buckets = np.abs(x[:, 2:] - y[:, 2:])
    total = np.where(buckets == 3, 6, buckets).sum(axis=1)
    total += np.abs(x[:, 0] - y[:, 0]) + np.abs(x[:, 1] // 16 - y[:, 1] // 16) + np.abs(x[:, 1] % 16 - y[:, 1] % 16)
    return 1 - np.minimum(total, FAR) / FAR


def fingerprints(docs: DataFrame, name: str = "fingerprint", text: str = "text") -> DataFrame:
    """``docs`` with the digest of its text, in a new column ``name``."""
    place = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hexes = pa.array(as_hex(digests(batch.column(place))), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, hexes], names=schema.names)

    return docs.mapInArrow(run, schema)


def edited(text: str | None, other: str | None) -> str:
    """The last quarter of a text replaced by as much of the start of another."""
    text, other = text or "", other or ""
    cut = len(text) // 4
    return text[:len(text) - cut] + other[:cut]


_NAMES = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_KINDS = [T.LongType(), T.StringType(), T.StringType(), T.StringType(), T.DoubleType(), T.DoubleType()]


def _results(texts: list, nexts: list, own: np.ndarray, then: np.ndarray) -> list[pa.Array]:
    new = [edited(a, b) for a, b in zip(texts, nexts)]
    other = digests(pa.array(new, pa.string()))
    return [pa.array([len(t or "") for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
            pa.array(as_hex(own), pa.string()), pa.array(as_hex(other), pa.string()),
            pa.array(likeness(own, other)), pa.array(likeness(own, then))]


def edited_likeness(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document against its edited text and the next document, in ascending id order (last: the first).

    Documents are dealt out by ranges of their ids and sorted; each task pairs
    neighbours as they stream by.  A range's first and last document come back
    with their texts, and a second, small pass pairs each range's last with the
    next one's first.  Rows that repeat an id are ordered by their text.
    """
    docs = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([
        docs.schema["id"], *[T.StructField(n, k) for n, k in zip(_NAMES, _KINDS)],
        T.StructField("part", T.IntegerType()), T.StructField("edge", T.StringType()), T.StructField("text", T.StringType())])

    def frame(of, ids, results, part, edge, texts) -> pa.RecordBatch:
        n = len(ids)
        results = results or [pa.nulls(n, t) for t in (pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64())]
        return pa.RecordBatch.from_arrays([
            pa.array(ids, of), *results, pa.array([part] * n, pa.int32()), pa.array([edge] * n, pa.string()),
            pa.array(texts, pa.string())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held, of = TaskContext.get().partitionId(), None, None
        for batch in batches:
            of = batch.column(0).type
            for row, end, _, _ in runs(batch.column(1)):
                ids = batch.column(0).slice(row, end - row).to_pylist()
                col = batch.column(1).slice(row, end - row)
                texts, own = col.to_pylist(), digests(col)
                if held is None:
                    yield frame(of, ids[:1], None, part, "first", texts[:1])
                else:
                    ids, texts, own = [held[0], *ids], [held[1], *texts], np.vstack([held[2], own])
                if len(ids) > 1:
                    yield frame(of, ids[:-1], _results(texts[:-1], texts[1:], own[:-1], own[1:]), part, None,
                                [None] * (len(ids) - 1))
                held = ids[-1], texts[-1], own[-1:]
        if held is not None:
            yield frame(of, [held[0]], None, part, "last", [held[1]])

    made = stored(docs.repartitionByRange("id").sortWithinPartitions("id", "text").mapInArrow(run, schema), "fingerprints")
    inner = made.where("edge is null").select("id", *_NAMES)
    # Two rows per range from here on.
    parts = sorted(r["part"] for r in made.where("edge = 'first'").select("part").collect())
    order = made.sparkSession.range(1).select(F.explode(F.from_json(
        F.lit(json.dumps(dict(zip(parts, parts[1:] + parts[:1])))), "map<string,int>")).alias("part", "follows")).select(F.col("part").cast("int").alias("part"), "follows")
    last = made.where("edge = 'last'").select("id", "part", "text")
    first = made.where("edge = 'first'").select(F.col("part").alias("follows"), F.col("text").alias("next"))
    pairs = last.join(order, "part").join(first, "follows").select("id", "text", "next")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, nexts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            results = _results(texts, nexts, digests(batch.column(1)), digests(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *results], names=["id", *_NAMES])

    return inner.unionAll(pairs.mapInArrow(ends, T.StructType(schema.fields[:1 + len(_NAMES)])))
