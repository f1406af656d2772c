"""License notices: exact places against a plain version, edits found, edges."""

import pytest
from brute import op10

from metricstore.llm import licenses, queries


def test_query_base_columns(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = {r["doc_id"]: r for r in queries.op10_license_scan(spark, sf).collect()}
    some = 0
    for d in docs:
        n, places = op10(d["text"], licenses.PHRASES)
        r = rows[d["doc_id"]]
        at = [i for _, i in places]
        assert (r["n_words"], r["n_base"]) == (n, len(places))
        assert (r["first_word"], r["last_word"]) == ((min(at), max(at)) if at else (None, None))
        base = {x for x, _ in places}
        assert r["base_labels"] == ",".join(sorted(base))
        assert base <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and (r["score"] == 1) >= bool(places) and (r["score"] > 0) == bool(r["labels"])
        some += bool(places)
    assert some > 20


def find(spark, texts):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, licenses string")
    out, col = licenses.find_notices(df)
    assert out.columns[:3] == df.columns
    return [r[col] for r in out.orderBy("doc_id").collect()]


@pytest.mark.parametrize("text,label,edits,span", [
    ("Released undr the MIT Licence, ok", "mit", 2, (1, 5)),
    ("ñ apache licence version 2", "apache-2", 1, (1, 5)),
    ("a GNU  General-Public License b", "gpl", 0, (1, 5)),
    ("redistribution and use in sorce and binary forms", "bsd", 1, (0, 8)),
])
def test_edited_notices(spark, text, label, edits, span):
    got = find(spark, [text])[0]
    hit = [s for s in got["spans"] if s["label"] == label]
    assert len(hit) == 1 and hit[0]["edits"] == edits and (hit[0]["start"], hit[0]["end"]) == span
    assert 0 < got["score"] <= 1


def test_neighbouring_notices_are_all_reported(spark):
    text = "gnu generl public license gnu general public license mit licence x gnu genral publc license and the mit license"
    got = find(spark, [text])[0]
    assert [(s["label"], s["start"], s["end"]) for s in got["spans"] if s["label"] == "gpl"] == [
        ("gpl", 0, 4), ("gpl", 4, 8), ("gpl", 11, 15)]


def test_edges(spark):
    texts = [None, "", "...", "under the mit license", "under the mit license under the mit license", "CC BY-NC 4.0",
             "plain words about nothing", "the the the the", "x " * 300_000 + "under the MIT license",
             "under-the-mit-license" * 3, "y" * 2_000_000]
    got = find(spark, texts)
    assert [len(g["places"]) for g in got] == [len(op10(t, licenses.PHRASES)[1]) for t in texts]
    assert [g["n_words"] for g in got] == [op10(t, {})[0] for t in texts]
    assert got[6]["score"] == 0 and not got[6]["spans"] and got[0]["score"] == 0
    assert licenses.find_notices(spark.createDataFrame([], "doc_id long, text string"))[0].count() == 0
