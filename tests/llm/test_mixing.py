"""Source mixing: targets by hand, totals near targets, no document above the limit, reruns agree."""

from collections import defaultdict

import pytest
from brute import solid_words

from metricstore.llm import mixing, queries


def targets(sizes, weights=(1, 2, 3), most=3.0):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    given = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in out]
        left = total - sum(out.values())
        w = sum(given[s] for s in free)
        above = [s for s in free if left * given[s] / w > most * sizes[s]]
        if not above:
            return out | {s: left * given[s] / w for s in free}
        out |= {s: most * sizes[s] for s in above}


def check(rows, docs, source_of):
    size = {d: len(solid_words(t)) for d, t, _ in docs}
    sums = defaultdict(int)
    for d, _, s in docs:
        sums[s] += size[d]
    want, taken, largest = targets(dict(sums)), defaultdict(int), defaultdict(int)
    for r in rows:
        s = source_of[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == sums[s]
        assert r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s, n in want.items():
        assert abs(taken[s] - n) <= max(1, largest[s]) / 2 + 1e-6, s


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = queries.op4_source_mixing(spark, sf).collect()
    assert len(rows) == len(docs)
    check(rows, docs, {d: s for d, _, s in docs})
    assert sorted(rows) == sorted(queries.op4_source_mixing(spark, sf).collect())


@pytest.mark.parametrize("bucket", [3, 4096])
def test_caps_nulls_and_empty_sources(spark, bucket):
    docs = [(i, "w " * (i % 7), s) for i, s in enumerate(["b"] * 300 + ["a"] * 3 + [None] * 10 + ["é"] * 40 + ["Z"] * 2)]
    docs += [(1000, None, "none"), (1001, "", "none"), (1002, " \t", "none")]
    df = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, source string, size int, target int")
    rows, _ = mixing.mix_plan(df, bucket_docs=bucket)
    rows = rows.withColumnRenamed("id", "doc_id").collect()
    assert len(rows) == len(docs)
    check(rows, docs, {d: s for d, _, s in docs})
    mixed = mixing.mixed_documents(df, bucket_docs=bucket)
    assert mixed.columns == df.columns
    words = defaultdict(int)
    for r in mixed.collect():
        words[r["doc_id"]] += len(solid_words(r["text"]))
    assert {r["doc_id"]: r["taken"] for r in rows if r["taken"]} == {d: n for d, n in words.items() if n}


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b", "s")] * 5 + [(None, "a", "s")] * 2 + [(2, "c d e", "t")],
                               "doc_id long, text string, source string")
    rows, _ = mixing.mix_plan(df)
    assert rows.count() == 8
    assert mixing.mix_plan(df.where("false"))[0].count() == 0
    assert mixing.mixed_documents(df.where("false")).count() == 0


def by_sorting(sized, plan):
    """Copies of each (source, id, size, key) that sorting every source by key gives: {row: times of all its copies}."""
    out = defaultdict(int)
    for p in plan:
        rows = sorted((r["key"], (r["id"] is not None, r["id"] or 0), r["size"], r["id"]) for r in sized if r["source"] == p["source"])
        rest = max(0.0, p["target"] - p["epochs"] * p["source_size"])
        at = 0
        for key, _, size, i in rows:
            more = rest > 0 and (at + size <= rest or rest - at > at + size - rest)
            at += size
            out[(p["source"], i, size, key)] += p["epochs"] + int(more)
    return dict(out)


@pytest.mark.parametrize("bucket", [3, 4096])
def test_samples_equal_those_of_sorting(spark, bucket):
    docs = [(i % 150 if i % 11 else None, "w " * (1 + i % 5), "abc"[i * i % 3]) for i in range(700)] + [(7, "eq eq eq eq", "d")] * 300
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(6)
    rows, plan = mixing.mix_plan(df, bucket_docs=bucket)
    sized = mixing._sized(df, "doc_id", "source", "text", None, 17).collect()
    want = by_sorting(sized, plan.collect())
    key = {(r["source"], r["id"], r["size"]): r["key"] for r in sized}  # one text a size here
    assert len(key) == len(want)
    got = defaultdict(int)
    source_of = {p["source_size"]: p["source"] for p in plan.collect()}
    for r in rows.collect():
        s = source_of[r["source_size"]]
        got[(s, r["id"], r["size"], key[s, r["id"], r["size"]])] += r["times"]
    assert got == want
    mixed = defaultdict(int)
    for r in mixing.mixed_documents(df, bucket_docs=bucket).collect():
        n = len(solid_words(r["text"]))
        mixed[(r["source"], r["doc_id"], n, key[r["source"], r["doc_id"], n])] += 1
    assert mixed == {k: n for k, n in want.items() if n}


def test_equal_rows_are_taken_up_to_the_target(spark):
    df = spark.createDataFrame([(None, "a b c d", "s")] * 100 + [(i, "w " * 60, "t") for i in range(5)], "doc_id long, text string, source string")
    for parts in (1, 7):
        rows, plan = mixing.mix_plan(df.repartition(parts), weights=(2, 5), most=3.0)
        target = {p["source"]: p["target"] for p in plan.collect()}["s"]
        taken = sum(r["taken"] for r in rows.where("id is null").collect())
        assert 0 < target < 400 and abs(taken - target) <= 2
        assert mixing.mixed_documents(df.repartition(parts), weights=(2, 5), most=3.0).where("doc_id is null").count() == taken / 4


def test_quality_weights_prefer_good_documents(spark):
    from pyspark.sql import functions as F

    df = spark.range(4000).selectExpr("id as doc_id", "if(id % 2 = 0, 'good words here now', '## $$ %% 11') as text",
                                      "if(id < 3000, 'a', 'b') as source")
    rows, _ = mixing.mix_plan(df)
    by = {r["even"]: r["n"] for r in rows.where("id < 3000").groupBy((F.col("id") % 2 == 0).alias("even")).agg(
        F.sum("times").alias("n")).collect()}
    assert by[True] > 1.3 * by.get(False, 0)
