"""Benchmark decontamination against a plain version, and its edge cases."""

import pytest
from brute import alnum_words, op1

from metricstore.llm import decontam, queries
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

EDGE_ITEMS = [(1, "One two, three FOUR five six seven eight nine ten eleven"), (2, "short item"), (3, ""), (4, None),
              (5, "short item"), (6, "Ünïcode wörds ñ")]
EDGE_DOCS = [
    (0, None), (1, ""), (2, "!!! ..."), (3, "a SHORT  item, b"), (4, "short items"), (5, "ünïcode wörds ñ"),
    (6, "x one two three four five six seven eight nine ten eleven y short item"),
    (7, "one two three four five six seven eight nine"), (8, "short"), (9, "item short"),
    (10, "word " * 300_000 + "short item"), (11, "short item short item"), (12, "short item short item"),
    (13, "x" * 3_000_000 + " short item"),
]


@pytest.fixture(scope="module")
def edge(spark):
    docs = spark.createDataFrame([(i, t, "keep") for i, t in EDGE_DOCS], "doc_id long, text string, decontam string")
    return docs, spark.createDataFrame(EDGE_ITEMS, "item_id long, text string")


def test_query_equals_plain_version(spark):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op1_decontamination(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    assert got == op1([tuple(r) for r in docs], [tuple(r) for r in items])
    assert any(r[4] for r in got.values())


@pytest.mark.parametrize("block", [2 << 20, 40])
def test_edges_and_blocks(edge, block):
    docs, items = edge
    out, hits = decontam.find_hits(docs, items, block_bytes=block)
    assert hits != "decontam" and out.columns[:3] == docs.columns
    want = op1(EDGE_DOCS, EDGE_ITEMS)
    for r in out.collect():
        assert (r[hits]["n_words"], r[hits]["n_hit"], len(r[hits]["items"])) == want[r["doc_id"]][:3], r["doc_id"]


def test_remove_documents_and_spans(edge):
    docs, items = edge
    want = op1(EDGE_DOCS, EDGE_ITEMS)
    left = decontam.remove_documents(docs, items)
    assert left.columns == docs.columns
    assert {r["doc_id"] for r in left.collect()} == {d for d, w in want.items() if not w[4]}
    cut = {r["doc_id"]: r["text"] for r in decontam.remove_spans(docs, items).collect()}
    assert cut[0] is None and cut[3] == "a , b" and cut[6] == "x  y " and cut[4] == "short items"
    for d, text in cut.items():
        assert len(alnum_words(text)) == want[d][0] - want[d][1]


def test_empty_tables(edge):
    docs, items = edge
    out, hits = decontam.find_hits(docs, items.where("false"))
    assert out.where(F.col(hits)["n_hit"] > 0).isEmpty() and out.count() == len(EDGE_DOCS)
    assert decontam.find_hits(docs.where("false"), items)[0].count() == 0
