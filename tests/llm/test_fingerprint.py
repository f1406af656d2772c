"""Fingerprints: edited texts and pairs against a plain version, digest properties."""

import hashlib

import pytest

from metricstore.llm import fingerprint, queries


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out = []
    for i, (d, text) in enumerate(rows):
        text, other = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 4
        new = text[:len(text) - cut] + other[:cut]
        out.append((d, len(text), hashlib.sha256(new.encode()).hexdigest(), text, new, other))
    return out


def check(spark, got, rows):
    want = plain(rows)
    texts = sorted({t for r in want for t in r[3:]})
    code = {r["text"]: r["fingerprint"] for r in fingerprint.fingerprints(
        spark.createDataFrame([(t,) for t in texts], "text string")).collect()}
    key = lambda r: (str(r[0]), r[1], r[2])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, (d, n, sha, text, new, other) in zip(got, want):
        assert (g["id"], g["n_chars"], g["edited_sha256"]) == (d, n, sha)
        assert (g["fingerprint"], g["edited_fingerprint"]) == (code[text], code[new])
        assert g["near_edited"] == 1.0 if text == new else 0 <= g["near_edited"] <= 1
        assert g["near_next"] == 1.0 if code[text] == code[other] else 0 <= g["near_next"] < 1


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op8_fingerprints(spark, sf).withColumnRenamed("doc_id", "id").collect()
    check(spark, got, rows)
    mean = lambda c: sum(r[c] for r in got) / len(got)
    assert mean("near_edited") > 0.7 > 0.5 > mean("near_next")


@pytest.mark.parametrize("n", [1, 2, 9])
def test_edges(spark, n):
    rows = [(5, "ñandú " * 300), (1, None), (2, ""), (3, "ab"), (9, "x" * 1_000_000), (9, "y" * 10), (9, "y" * 10), (None, "no id"),
            (4, "漢字漢字漢字漢字")][:n]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, part int")
    check(spark, fingerprint.edited_likeness(df).collect(), rows)
    assert fingerprint.edited_likeness(df.where("false")).count() == 0
