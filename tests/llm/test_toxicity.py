"""Toxicity: features against a plain version, held-out labels, edges."""

import math

import numpy as np
import pyarrow as pa
import pytest
from brute import remainder

from metricstore.llm import queries, toxicity

WORDS = "the of and to in is that for it as was with be by on not he his but at are this have from".split()


def corpus(n):
    import random

    rng = random.Random(5)
    out = []
    for i in range(n):
        words = [rng.choice(WORDS) for _ in range(rng.randint(5, 60))]
        bad = i % 5 == 0
        if bad:
            for k in range(1 + len(words) // 10):
                words.insert(rng.randrange(len(words)), "grmpf" + rng.choice(["ed", "ing", "s"]))
        out.append((i, " ".join(words), int(bad)))
    return out


def plain_counts(texts, sizes=toxicity.SIZES):
    """Distinct n-grams of each text."""
    out = []
    for t in texts:
        t = "".join(" " if "\t" <= c <= "\r" else c for c in f" {t.lower()} ") if t else ""
        out.append({t[i:i + n] for n in sizes for i in range(len(t) - n + 1)})
    return out


def test_features_are_distinct_runs_of_letters():
    texts = ["Über die ÄPFEL\nund", "", None, "a", "x" * 5000, "漢字 漢字 漢", "aba" * 3]
    want = plain_counts(texts)
    got = [set() for _ in texts]
    for row, end, of, bucket in toxicity.features(pa.array(texts)):
        for r, b in zip(of.tolist(), bucket.tolist()):
            assert b not in got[row + r]
            got[row + r].add(b)
    for w, g in zip(want, got):
        assert len(w) - 2 <= len(g) <= len(w)  # at most a rare shared bucket
    assert not got[1] and not got[2]


def test_ratios_and_fit_against_plain_versions():
    rows = corpus(300)
    texts, y = [t for _, t, _ in rows], np.array([b for _, _, b in rows])
    grams = plain_counts(texts)
    counts = np.zeros((2, toxicity.BUCKETS))
    every = [(row + of, bucket) for row, _, of, bucket in toxicity.features(pa.array(texts))]
    row, bucket = (np.concatenate(x) for x in zip(*every))
    for k in (0, 1):
        counts[k] = np.bincount(bucket[y[row] == k], minlength=toxicity.BUCKETS)
    ratio = toxicity.log_count_ratios(counts, np.bincount(y).astype(float))
    bad = sum("grmp" in g for g, b in zip(grams, y) if b)
    at = next(iter(b for _, _, of, bs in toxicity.features(pa.array(["grmp"])) for b in bs if counts[0][b] == 0))
    assert counts[1][at] <= bad
    assert ratio[at] == pytest.approx(math.log((counts[1][at] + 1) / (y.sum() + 2)) - math.log(1 / (len(y) - y.sum() + 2)))

    weight, intercept = toxicity.fit(row, bucket, y, np.ones(len(y)), ratio, rounds=200)

    def loss(w, b):  # of each text, in full
        z = np.bincount(row, w[bucket], len(y)) + b
        scaled = np.divide(w, ratio, out=np.zeros_like(w), where=ratio != 0)
        return np.logaddexp(0, -(2 * y - 1) * z).mean() + 0.1 / len(y) / 2 * (scaled ** 2).sum()

    best = loss(weight, intercept)
    assert best < 0.1
    rng = np.random.default_rng(1)
    for _ in range(20):  # no nearby point is better
        step = rng.normal(size=len(weight)) * np.abs(weight) * 0.05
        assert loss(weight + step, intercept + rng.normal() * 0.05) > best - 1e-5


def test_learns_and_scores(spark):
    rows = corpus(600)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(1000, None, "x"), (1001, "", "x"), (None, "grmpfing the", "x"),
                                 (1002, "of the grmpfes " * 20000, "x"), (5, "of the", "x"), (5, "of the", "x")],
                                 "doc_id long, text string, toxicity string")
    labels = spark.createDataFrame([(i, b) for i, _, b in rows if i % 3] + [(0, None), (9, 7), (None, 1), (7777, 1)],
                                   "doc_id long, toxic int")
    model = toxicity.learn(docs, labels, sample_docs=200)
    out, name = toxicity.score_texts(docs, model)
    assert out.columns == ["doc_id", "text", "toxicity", name]
    got = [(r["doc_id"], r[name]["score"]) for r in out.collect()]
    assert len(got) == 606 and all(0 <= s <= 1 for _, s in got)
    score = dict(got)
    for i, _, b in rows:
        if i % 3 == 0 and i != 5:
            assert (score[i] >= 0.3) == bool(b)
    assert score[1000] == score[1001] < 0.3 <= min(score[None], score[1002])
    again = toxicity.learn(docs.repartition(7), labels, sample_docs=200)
    assert np.array_equal(model.weight, again.weight) or np.allclose(model.weight, again.weight)
    # No labels at all, and labels of one kind.
    for kind, want in (("false", 0.0), ("toxic = 1", 1.0), ("toxic = 0", 0.0)):
        flat = toxicity.learn(docs, labels.where(kind))
        s = [r[name]["score"] for r in toxicity.score_texts(docs, flat)[0].collect()]
        assert max(s) - min(s) == 0 and abs(s[0] - want) < 1e-9
    assert toxicity.score_texts(docs.where("false"), model)[0].count() == 0
    # Shuffled labels give the same model.
    old = toxicity.BROADCAST_LABELS
    try:
        toxicity.BROADCAST_LABELS = 0
        other = toxicity.learn(docs, labels, sample_docs=200)
    finally:
        toxicity.BROADCAST_LABELS = old
    assert np.allclose(model.weight, other.weight)


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in queries.op11_toxicity(spark, sf).collect()}
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    assert set(got) == set(docs)
    assert all(r["held_out"] == (remainder(d, 4) == 2) and r["predicted"] == int(r["score"] >= 0.3) for d, r in got.items())
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic").collect()
    held = [(got[r["doc_id"]]["predicted"], r["toxic"], docs[r["doc_id"]]) for r in labels if remainder(r["doc_id"], 4) == 2]
    english = [p for p, y, lang in held if y == 1 and lang == "en"]
    assert sum(english) / len(english) > 0.9  # the others hold no such words
    clean = [p for p, y, _ in held if y == 0]
    assert sum(clean) / len(clean) < 0.01
