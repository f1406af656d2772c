"""Language identification: held-out accuracy, edges, and a plain rank-order version."""

from collections import Counter

import pytest
from brute import remainder

from metricstore.llm import langid, queries


def plain_grams(text, longest=3):
    out, word = Counter(), ""
    for c in (text or "") + "\n":
        if c.isalpha():
            word += c.lower() if len(c.lower()) == 1 else c
        elif word:
            padded = f"\x01{word}\x01"
            out.update(word)
            for n in range(2, longest + 1):
                out.update(padded[i:i + n] for i in range(len(padded) - n + 1))
            word = ""
    return out


def code(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def plain_profiles(docs, top):
    by = {}
    for text, lang in docs:
        if lang is not None and text is not None:
            by.setdefault(lang, Counter()).update({code(g): n for g, n in plain_grams(text).items()})
    return {k: [g for g, _ in sorted(v.items(), key=lambda x: (-x[1], x[0]))[:top]] for k, v in by.items() if v}


def plain_predict(text, profiles, top):
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0
    own = [(code(g), n) for g, n in plain_grams(text).items()]
    own = [g for g, _ in sorted(own, key=lambda x: (-x[1], x[0]))[:top]]
    best = None
    for lang in sorted(profiles):
        rank = {g: i for i, g in enumerate(profiles[lang])}
        far = sum(abs(rank[g] - i) if g in rank else top for i, g in enumerate(own))
        if best is None or far < best[1]:
            best = lang, far
    return best[0], 1 - best[1] / (top * len(own)) if own else 0.0


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()


def test_query_equals_plain_version_and_is_right_on_held_out_rows(spark, docs):
    profiles = plain_profiles([(r["text"], r["lang"]) for r in docs if remainder(r["doc_id"], 3) != 1], 400)
    rows = {r["doc_id"]: r for r in queries.op5_language_id(spark, "/root/testdata/sf0.01").collect()}
    right = total = 0
    for d in docs:
        r = rows[d["doc_id"]]
        assert r["held_out"] == (remainder(d["doc_id"], 3) == 1)
        lang, score = plain_predict(d["text"], profiles, 400)
        assert r["lang_pred"] == lang and r["score"] == pytest.approx(score)
        total += r["held_out"]
        right += r["held_out"] and r["lang_pred"] == d["lang"]
    assert right / total > 0.97


def test_other_alphabets_are_far_from_every_profile(docs):
    profiles = langid.Ranker(plain_profiles([(r["text"], r["lang"]) for r in docs], 400), 400, 3)
    other = "это текст на другом языке и он довольно длинный чтобы его узнать the of " * 20
    (_, far), (_, near) = profiles.predict([other, next(r["text"] for r in docs if r["lang"] == "en" and len(r["text"]) > 2000)])
    assert far < 0.15 < 0.4 < near


def test_edges(spark):
    texts = [None, "", "123 !!", "ÀÉ ñ", "abc abc", "漢字 ひらがな", "x" * 400_000, "abc " * 200_000, "İstanbul ß", "abc abc"]
    df = spark.createDataFrame([(t, "en", 1.0) for t in texts], "text string, language string, score double")
    train = spark.createDataFrame([("abc abd", "en"), ("xyz xyy", "zz"), (None, "en"), ("aaa", None), ("", "q")],
                                  "text string, lang string")
    profiles = langid.learn_profiles(train, top=20)
    assert profiles == plain_profiles([tuple(r) for r in train.collect()], 20)
    out, col = langid.identify(df, profiles, top=20)
    assert col == "language_" and out.columns[:3] == df.columns
    got = [(r["text"], *r[col]) for r in out.collect()]
    assert sorted(map(str, got)) == sorted(str((t, *plain_predict(t, profiles, 20))) for t in texts)
    none, col = langid.identify(df, {})
    assert {r[col]["lang"] for r in none.collect()} == {"und"}
    assert langid.learn_profiles(train.where("false")) == {}
    assert langid.identify(df.where("false"), profiles)[0].count() == 0
