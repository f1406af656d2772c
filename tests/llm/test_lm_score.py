"""Language-model scores: the baseline against a plain version, the model as a probability, held-out texts, edges."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from brute import remainder, solid_words
from pyspark.sql import functions as F

from metricstore.llm import lm_score, queries
from metricstore.llm.arrays import buffers


def plain(docs, trains):
    """{id: (n_tokens, n_known, train_tokens, base)}; the end token is None."""
    counts = Counter()
    for d, text in docs:
        if trains(d):
            counts.update(solid_words(text) + [None])
    n, v = sum(counts.values()), len(counts)
    out = {}
    for d, text in docs:
        tokens = solid_words(text) + [None]
        out[d] = (len(tokens), sum(counts[t] > 0 for t in tokens), n,
                  sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens))
    return out


def check(rows, docs, trains):
    want = plain(docs, trains)
    assert len(rows) == len(docs)
    for r in rows:
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.op2_lm_score(spark, sf).collect()
    check(rows, docs, lambda d: remainder(d, 5) != 1)
    assert all(r["held_out"] == (remainder(r["doc_id"], 5) == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    size = sum(-r["score"] / math.log10(2) / r["bits_per_byte"] for r in held)
    assert sum(-r["score"] / math.log10(2) for r in held) / size < 2.5


def model(texts):
    tree = lm_score.Tree(np.bincount(np.frombuffer(" ".join(texts).encode(), np.uint8), minlength=256))
    s = lm_score.Stream(*buffers(pa.array(texts)))
    counts = np.zeros((1 << 16, 256), np.int64)
    np.add.at(counts, (lm_score.triples(s.x, s.starts), s.x), 1)
    triple = lm_score.stretched(*tree.fold(counts)).ravel()
    return lm_score.Model(tree, triple, np.zeros(1 << lm_score.WORD_BITS, np.int16))


TEXTS = ["the cat sat on the mat and the cat sat again", "", "a b c a b c a b c", "ünï cödé", "x" * 3000 + " y z " * 900]


def test_the_next_byte_has_probability_one_in_all():
    m = model(TEXTS)
    prefix = "the cat sat on the ca"
    every = [m.score(lm_score.Stream(np.frombuffer(prefix.encode(), np.uint8), np.array([0, len(prefix)])))[0]]
    x = np.frombuffer(prefix.encode() + b"?", np.uint8).copy()
    total = 0.0
    starts = np.array([0])
    for b in range(256):
        x[-1] = b
        ctx = lm_score.contexts(x, starts)
        _, sign, st, gate = m._bits(x[-1:], *(c[-1:] for c in ctx))
        mixed = (m.weights[gate, :-1] * st.T).sum(axis=1) + m.weights[gate, -1]
        total += float(np.prod(1 / (1 + np.exp(sign * mixed))))
    assert total == pytest.approx(1, abs=1e-4) and every[0] < 0


def test_a_score_depends_on_the_own_text_alone():
    m = model(TEXTS)
    together = m.score(lm_score.Stream(*buffers(pa.array(TEXTS + TEXTS[::-1]))))
    alone = [m.score(lm_score.Stream(*buffers(pa.array([t]))))[0] for t in TEXTS]
    assert together == pytest.approx(alone + alone[::-1], rel=1e-5)


def test_stream_of_tokens():
    texts = ["  Ab\tc ", None, "d", " ", "é\n\nf"]
    s = lm_score.Stream(*buffers(pa.array(texts)))
    assert bytes(s.x) == "ab c \nd \n".replace("\nd", "\n\nd").encode() + b"\n" + "é f \n".encode()
    assert s.words.tolist() == [2, 0, 1, 0, 2] and s.sizes.tolist() == [6, 1, 3, 1, 6]
    coded = s.tokens()
    assert [coded.dictionary[i].as_py() for i in coded.indices.to_pylist()] == ["ab", "c", "d", "é", "f"]


@pytest.mark.parametrize("run_bytes", [64, 4 << 20])
def test_edges(spark, run_bytes):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "One one ONE two"), (5, "ñ 漢字 \U0001f600"), (6, "w" * 500_000),
            (7, "a b " * 100_000), (None, "two one"), (8, "unseen words here"), (4, "One one ONE two")]
    df = spark.createDataFrame([(*d, 1, 0.0) for d in docs], "doc_id long, text string, n int, score double")
    rows = lm_score.score_texts(df, F.col("doc_id") != 8, run_bytes=run_bytes).collect()
    assert len(rows) == len(docs)
    check([r for r in rows], [(d, t) for d, t in docs], lambda d: d is not None and d != 8)
    assert lm_score.score_texts(df.where("false"), F.lit(True)).count() == 0
    none = lm_score.score_texts(df.where("doc_id in (1, 4)"), F.lit(False)).collect()
    check(none, [(1, None), (4, "One one ONE two"), (4, "One one ONE two")], lambda d: False)


def test_pairs_of_bytes_predict():
    texts = ["zq zq zq zq", "the cat sat"]
    tree, word = model(texts).tree, np.zeros(1 << lm_score.WORD_BITS, np.int16)
    s = lm_score.Stream(*buffers(pa.array(texts)))
    counts = np.zeros((1 << 16, 256), np.int64)
    np.add.at(counts, (lm_score.pairs(s.x, s.starts), s.x), 1)
    even = np.zeros(1 << 24, np.int8)
    pair = lm_score.stretched(*tree.fold(counts)).ravel()
    with_pairs, without = (lm_score.Model(tree, even, word, None, p).score(s) for p in (pair, even))
    assert (with_pairs > without).all()


def test_refined_after_512_2048_and_8192_bytes(monkeypatch):
    seen = []
    monkeypatch.setattr(lm_score.Model, "_bits", lambda self, x, *a, f=lm_score.Model._bits: seen.append(len(x)) or f(self, x, *a))
    model(TEXTS).score(lm_score.Stream(*buffers(pa.array(["a b " * 2500]))))
    assert seen == [512, 1536, 6144, 10_001 - 8192]


def test_only_the_documents_of_the_weights_stay_out_of_the_tables(spark):
    df = spark.createDataFrame([(i, "a b " * (1 + 20 * (i % 2))) for i in range(4000)] + [(None, None)] * 9,
                               "doc_id long, text string")
    rows = lm_score._rows(df, F.col("doc_id") % 5 != 1, "doc_id", "text", 10, 40).collect()
    held = [r for r in rows if r["held"]]
    assert len(rows) == 4009 and len(held) == 10
    assert all(r["trains"] and r["id"] % 2 == 0 for r in held)
    few = [r for r in lm_score._rows(df, F.lit(True), "doc_id", "text", 256, 1000).collect() if r["held"]]
    assert 10 < len(few) < 4009 / 32


def test_weights_come_from_every_training_document(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lm_score, "mixing_weights", lambda at, n, f=lm_score.mixing_weights: seen.append((at, n)) or f(at, n))
    docs = [(i, "a b " * (1 + 7 * (i % 5)) + "w" * (i % 3)) for i in range(600)] + [(None, None), (601, "long word " * 9000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    trains = F.coalesce(F.col("doc_id") % 5 != 1, F.lit(False))
    rows = lm_score.score_texts(df, trains).collect()
    assert len(rows) == len(docs)
    learned = [t for i, t in docs if i is not None and i % 5 != 1]
    s = lm_score.Stream(*buffers(pa.array(learned)))
    tree = lm_score.Tree(np.bincount(s.x, minlength=256))
    (at, n), = seen
    assert n.sum() == tree.size[s.x].sum()  # every bit of every training document, the long one too
    ones = int((tree.bits[np.concatenate([np.arange(f, f + k) for f, k in zip(tree.first[s.x], tree.size[s.x])])] == 1).sum())
    assert n[at & 1 == 1].sum() == ones


def test_places_of_the_tally_are_the_bits_predictions_and_gates():
    m = model(TEXTS)
    s = lm_score.Stream(*buffers(pa.array([t for t in TEXTS if t])))
    ctx = lm_score.contexts(s.x, s.starts)
    _, sign, st, gate = m._bits(s.x, *ctx)
    at = m._places(s.x, *ctx)
    assert (at & 1).tolist() == (sign < 0).astype(int).tolist()
    at = at >> 1
    assert (at % 3 - 1).tolist() == st[3].tolist()
    assert (at // 3 >> 15).tolist() == gate.tolist()
    for by, i in ((10, 0), (5, 1), (0, 2)):
        middle = ((at // 3 >> by & 31) - 15.5) * 0.5
        assert np.abs(middle - st[i]).max() <= 0.5


def test_weights_learn_which_prediction_to_trust():
    # Gate 0: the second prediction is right three times in four, the others say nothing.
    def place(second, value):
        return ((((16 << 5 | second) << 5 | 16) * 3 + 1) << 1) | value

    at = np.array([place(20, 1), place(20, 0), place(11, 0), place(11, 1)])
    w = lm_score.mixing_weights(at, np.array([75_000, 25_000, 75_000, 25_000]))
    assert w[0, 1] * 2.25 == pytest.approx(np.log(3), abs=0.15)
    assert (w[1:] == lm_score.START).all()


def test_contexts_that_come_again_are_mixed_once():
    rng = np.random.default_rng(3)
    m = model(TEXTS)
    m.pair = rng.integers(-127, 128, 1 << 24).astype(np.int8)
    m.word = rng.integers(-508, 508, 1 << lm_score.WORD_BITS).astype(np.int16)
    m.weights = rng.normal(0.3, 0.1, m.weights.shape).astype(np.float32)
    s = lm_score.Stream(*buffers(pa.array([t for t in TEXTS if t] * 3 + ["the dog sat on the cat " * 9])))
    ctx = lm_score.contexts(s.x, s.starts)
    keys = lm_score.context_keys(s.x, s.starts)
    x, pair, triple, word, place, match, trust = lm_score.of_keys(keys)
    for have, want in zip((x, pair, triple, word, place, trust), (s.x, *ctx[:4], ctx[5])):
        assert have.tolist() == want.tolist()
    assert match[trust > 0].tolist() == ctx[4][trust > 0].tolist()
    assert len(np.unique(keys)) < len(keys) / 3
    for have, want in zip(lm_score.Known(m, keys).bits(np.arange(len(keys))), m._mixed(s.x, *ctx)):
        assert have.tolist() == want.tolist()
    counts, plain = (np.zeros(lm_score.TALLY, np.uint32) for _ in range(2))
    m.tally(s, counts)
    np.add.at(plain, m._places(s.x, *ctx), np.uint32(1))
    assert (counts == plain).all()


def test_score_of_many_bytes_is_that_of_few(monkeypatch):
    m = model(TEXTS)
    s = lm_score.Stream(*buffers(pa.array(TEXTS * 9)))
    many = m.score(s)
    monkeypatch.setattr(lm_score, "_PART", 1)  # each document by itself, in fewer bytes than are taken together
    assert len(s.x) > lm_score._STEP > s.sizes.max() and m.score(s).tolist() == many.tolist()


def test_stream_made_of_pieces(monkeypatch):
    texts = pa.array(["  Ab\tc ", None, "d", " ", "é\n\nf", "", "ab c ab"])
    whole = lm_score.Stream(*buffers(texts))
    monkeypatch.setattr(lm_score, "_PART", 4)
    pieces = lm_score.Stream.of(texts)
    for k in ("x", "starts", "sizes", "words", "packed", "word_offsets"):
        assert getattr(pieces, k).tolist() == getattr(whole, k).tolist()
    assert pieces.tokens().to_pylist() == whole.tokens().to_pylist()


def test_tasks_hold_few_entries_and_write_the_rest(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"word{i} some ä{i * 7919} text " * (1 + i % 9)) for i in range(300)], "doc_id long, text string")
    want = {r["doc_id"]: r for r in lm_score.score_texts(docs, F.col("doc_id") % 5 != 1).collect()}
    sizes = []

    class Small(lm_score.Sums):
        def add(self, name, keys, n):
            super().add(name, keys, n)
            sizes.append(self.size)

    monkeypatch.setattr(lm_score, "HOLD", 64)
    sums, total = Small(), {}
    for k in range(200):
        sums.add(k % 2, np.arange(k, k + 10), np.full(10, 3))
        if sums.full:
            for name, keys, n in sums.take():
                for a, b in zip(keys.tolist(), n.tolist()):
                    total[name, a] = total.get((name, a), 0) + b
    for name, keys, n in sums.take():
        for a, b in zip(keys.tolist(), n.tolist()):
            total[name, a] = total.get((name, a), 0) + b
    assert max(sizes) <= 64 + 10 and sum(total.values()) == 200 * 30
    assert all(n == 3 * sum(k % 2 == name and k <= a < k + 10 for k in range(200)) for (name, a), n in total.items())
    again = lm_score.score_texts(docs, F.col("doc_id") % 5 != 1, run_bytes=500, buckets_each=1).collect()
    assert len(again) == 300
    for r in again:
        assert r["base_score"] == pytest.approx(want[r["doc_id"]]["base_score"], rel=1e-9)
        assert r["score"] == pytest.approx(want[r["doc_id"]]["score"], rel=1e-6)


def test_word_tables_hold_only_what_is_seen(spark):
    # Before, a task made whole tables of 64 to 256 MB whatever it read.
    made = lm_score._runs(lm_score._halves(spark.createDataFrame([(i, "a few words") for i in range(40)], "doc_id long, text string"),
                                           F.col("doc_id") != 3, "doc_id", "text"), 1 << 20)
    assert {r["kind"] for r in made.collect()} == {0, 1, 2}
    rows = lm_score._byte_tables(made).collect()
    sums = {0: 0, 2: 0}
    for r in rows:
        _, n = lm_score._unpack(r["counts"])
        sums[r["tab"] % 3] += int(n.sum())
    assert sums == {0: 39 * len("a few words \n"), 2: 39 * len("a few words \n")}
