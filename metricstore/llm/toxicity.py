"""Toxicity scores from a character n-gram linear classifier on naive Bayes features.

A text's features are its distinct runs of ``SIZES`` characters (A-Z and other
letters lower-cased, white space as blanks, a blank at both ends), hashed into
``BUCKETS``.  Each feature's value is its naive Bayes log-count ratio: the log of
how much likelier a document with label 1 holds it than one with label 0.  A
logistic regression over these scaled features gives the score.

Training: the ratios are counted over all labelled texts, as one partial count
per task and bucket.  The regression's weights are fitted on a bounded sample
of at most ``sample_docs`` texts of each label, of at most ``sample_bytes`` bytes
each, picked by a hash of id and text and weighted back to the labels' shares.
The model is ``2 * BUCKETS`` numbers whatever the corpus.

Defined results: a text without characters (null or empty) has no features and
scores by the intercept alone; labels that are null, neither 0 nor 1, or of ids
without a text teach nothing; an id labelled twice counts once a label; without
labels of both kinds every score is the share of label 1 among all labels (0
if there are none); rows that repeat an id are scored one by one; other columns
are left alone, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.llm.arrays import constants, fresh, mix, runs, with_struct
from metricstore.llm.store import SMALL_BATCHES
from metricstore.sinks.store import session_settings

BITS = 18
BUCKETS = 1 << BITS
SIZES = (2, 3, 4, 5)
#: Labels up to this many rows are broadcast (some 32 bytes each); beyond it, texts and labels are shuffled.
BROADCAST_LABELS = 1_000_000
_MULT = {n: constants(n, 40 + n) for n in SIZES}


def features(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, row of each feature from 0, its bucket) of runs of rows; a row's buckets are distinct."""
    if not len(col):
        return
    texts = pc.fill_null(col, "")
    texts = pc.utf8_lower(texts)
    texts = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, " ", ""))
    for row, end, buf, offs in runs(texts):
        letters = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        at = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[offs]  # rows' first letters
        wide = np.where((letters >= 9) & (letters <= 13), 32, letters).astype(np.uint64)
        of = np.repeat(np.arange(end - row), np.diff(at))
        keys = []
        for n in SIZES:
            m = len(wide) - n + 1
            if m <= 0:
                continue
            total = wide[:m] * _MULT[n][0]
            for k in range(1, n):
                total += wide[k:m + k] * _MULT[n][k]
            inside = of[:m] == of[n - 1:]
            bucket = (mix(total[inside]) >> np.uint64(64 - BITS)).astype(np.int64)
            keys.append((of[:m][inside] << BITS) | bucket)
        keys = np.sort(np.concatenate(keys)) if keys else np.empty(0, np.int64)
        if len(keys):
            keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        yield row, end, keys >> BITS, keys & (BUCKETS - 1)


@dataclass
class Model:
    """weight: of a bucket's presence (regression weight times log-count ratio)."""

    weight: np.ndarray
    intercept: float

    def scores(self, col: pa.Array) -> np.ndarray:
        out = np.full(len(col), self.intercept)
        for row, end, of, bucket in features(col):
            out[row:end] += np.bincount(of, self.weight[bucket], end - row)
        return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def log_count_ratios(counts: np.ndarray, totals: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    """Of (2, BUCKETS) documents of label 0 and 1 that hold each bucket."""
    share = (counts + smooth) / (totals[:, None] + 2 * smooth)
    ratio = np.log(share[1]) - np.log(share[0])
    return np.where(counts.sum(axis=0) > 0, ratio, 0.0)


def fit(row: np.ndarray, bucket: np.ndarray, label: np.ndarray, weight: np.ndarray, ratio: np.ndarray,
        ridge: float = 0.1, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights of the buckets and the intercept of a weighted logistic regression on the scaled features (L-BFGS)."""
    weight = weight / weight.sum()
    sign = 2.0 * label - 1
    ridge /= len(label)

    def loss(w):
        z = sign * (np.bincount(row, (w[:-1] * ratio)[bucket], len(label)) + w[-1])
        pull = -sign * weight / (1 + np.exp(np.clip(z, -50, 50)))
        grad = np.append(np.bincount(bucket, pull[row], BUCKETS) * ratio + ridge * w[:-1], pull.sum())
        return (weight * np.logaddexp(0, -z)).sum() + ridge / 2 * (w[:-1] ** 2).sum(), grad

    w = np.zeros(BUCKETS + 1)
    share = float((weight * label).sum())
    w[-1] = np.log(share / (1 - share))
    now, grad = loss(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        q, kept = grad.copy(), []
        for s, y in reversed(steps):
            a = s @ q / (s @ y)
            q -= a * y
            kept.append(a)
        if steps:
            s, y = steps[-1]
            q *= s @ y / (y @ y)
        for (s, y), a in zip(steps, reversed(kept)):
            q += s * (a - y @ q / (s @ y))
        slope, size = -grad @ q, 1.0
        while size > 1e-8:
            then, new = loss(w - size * q)
            if then <= now + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = -size * q, new - grad
        if s @ y > 1e-18:
            steps = [*steps[-9:], (s, y)]
        w, gain, now, grad = w + s, now - then, then, new
        if gain < 1e-7:
            break
    return w[:-1] * ratio, float(w[-1])


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          sample_docs: int = 1500, sample_bytes: int = 64 << 10) -> Model:
    """The classifier of the texts of ``docs`` whose ids ``labels`` marks."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    marks = labels.select(F.col(f"`{doc_id}`").alias("of"), F.col(f"`{label}`").cast("int").alias("y")).where("y in (0, 1)").distinct()
    if marks.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS:
        marks = F.broadcast(marks)
    marked = texts.join(marks, F.col("id") == F.col("of")).select("id", "text", "y")
    schema = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n0", T.LongType()),
                           T.StructField("n1", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, BUCKETS + 1), np.int64)
        for batch in batches:
            y = batch.column(1).to_numpy()
            n[:, BUCKETS] += np.bincount(y, minlength=2)
            for row, end, of, bucket in features(batch.column(0)):
                for k in (0, 1):
                    n[k, :BUCKETS] += np.bincount(bucket[y[row:end][of] == k], minlength=BUCKETS)
        used = np.flatnonzero(n.any(axis=0))
        for k in range(0, len(used), 1 << 16):
            part = used[k:k + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(n[0, part]), pa.array(n[1, part])],
                                             names=schema.names)

    with session_settings(spark, SMALL_BATCHES):
        # A row per bucket, at most BUCKETS + 1.
        table = (marked.select("text", "y").mapInArrow(count, schema).groupBy("bucket")
                 .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow())
    counts = np.zeros((2, BUCKETS + 1))
    at = table.column("bucket").to_numpy()
    counts[0, at], counts[1, at] = table.column("n0").to_numpy(), table.column("n1").to_numpy()
    totals = counts[:, BUCKETS]
    if not totals.all():
        share = totals[1] / max(totals.sum(), 1)
        return Model(np.zeros(BUCKETS), float(np.log(max(share, 1e-21) / max(1 - share, 1e-21))))
    ratio = log_count_ratios(counts[:, :BUCKETS], totals)
    # By their hash about twice as many as wanted, of which the first are taken.
    most = 1 << 30
    hashed = F.pmod(F.xxhash64("id", "text"), F.lit(most))
    edge = F.when(F.col("y") == 1, F.lit(min(most, int(most * 2 * sample_docs / totals[1])))).otherwise(
        F.lit(min(most, int(most * 2 * sample_docs / totals[0]))))
    near = (marked.where(F.octet_length("text") <= sample_bytes).withColumn("h", hashed).where(F.col("h") < edge))
    halves = [near.where(F.col("y") == k).orderBy("h", "text").limit(sample_docs) for k in (0, 1)]
    fitted = T.StructType([T.StructField("weight", T.BinaryType()), T.StructField("intercept", T.DoubleType())])

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, buckets, ys, n = [], [], [], 0
        for batch in batches:
            for row, _, of, bucket in features(batch.column(0)):
                rows.append(of + (n + row))
                buckets.append(bucket)
            ys.append(batch.column(1).to_numpy())
            n += batch.num_rows
        y = np.concatenate(ys) if ys else np.empty(0, np.int32)
        have = np.bincount(y, minlength=2)
        if have.all():
            weight, intercept = fit(np.concatenate(rows), np.concatenate(buckets), y, (totals / have)[y], ratio)
        else:  # every text of a label is longer than the sample takes: naive Bayes itself
            weight, intercept = ratio, float(np.log(totals[1] / totals[0]))
        yield pa.RecordBatch.from_arrays([pa.array([weight.tobytes()], pa.binary()), pa.array([intercept])], names=fitted.names)

    with session_settings(spark, SMALL_BATCHES):
        row = halves[0].unionAll(halves[1]).select("text", "y").coalesce(1).mapInArrow(train, fitted).first()
    if row is None:
        return Model(ratio, float(np.log(totals[1] / totals[0])))
    return Model(np.frombuffer(row["weight"]), row["intercept"])


def score_texts(docs: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column (score) and that column's name."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    place = docs.columns.index(text)
    name = fresh(docs.columns, "toxicity")

    def make():
        known = shared.value

        def one(batch: pa.RecordBatch) -> pa.Array:
            return pa.StructArray.from_arrays([pa.array(known.scores(batch.column(place)))], names=["score"])

        return one

    return with_struct(docs, name, T.StructType([T.StructField("score", T.DoubleType())]), make), name


def toxic(docs: DataFrame, labels: DataFrame, learns_from: Column, text: str = "text",
          least: float = 0.3, **options) -> tuple[DataFrame, str, Column]:
    """``docs`` scored by a model learned from the labelled rows that fulfil ``learns_from``: (rows, name, is toxic)."""
    model = learn(docs.where(learns_from), labels, text=text, **options)
    out, name = score_texts(docs, model, text)
    return out, name, F.col(name)["score"] >= least
