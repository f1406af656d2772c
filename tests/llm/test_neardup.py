"""Near-duplicates against a plain all-pairs version."""

import random

import pytest
from brute import op9

from metricstore.llm import neardup, queries


def as_map(df):
    return {r["id"]: (r["n"], r["component"]) for r in df.collect()}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_equals_plain_version(spark, sf):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op9_near_duplicates(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert got == op9([tuple(r) for r in docs])
    assert any(d != c for d, (_, c) in got.items())


def family(seed, n, words, edits, vocabulary=500):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(vocabulary)}x{seed}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"e{rng.randrange(10**9)}"
        out.append(" ".join(w))
    return out


def test_families_at_the_border_in_small_blocks(spark):
    texts = [t for k in range(6) for t in family(k, 60, 80 + 40 * k, 6 + 2 * k)]
    random.Random(5).shuffle(texts)
    docs = list(enumerate(texts))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = op9(docs)
    assert as_map(neardup.near_duplicates(df, block_sets=16)) == want
    assert as_map(neardup.near_duplicates(df)) == want


def test_an_id_that_is_the_smallest_of_its_keys_stays(spark):
    table = spark.createDataFrame([(3, 1), (7, 1), (5, 2), (7, 2), (8, 3), (9, 3), (4, 4)], "id long, key long")
    assert {r["id"]: r["cluster"] for r in neardup._clusters(table).collect()} == {3: 3, 5: 3, 7: 3, 8: 8, 9: 8}


def test_chains_whose_smaller_ends_do_not_meet(spark):
    docs = []
    for k in range(40):  # the ends share half their shingles, and three quarters with the middle
        w = [f"c{k}w{j}" for j in range(204)]
        docs += [(3 * k, " ".join(w[50:])), (3 * k + 1, " ".join(w[:-50])), (3 * k + 2, " ".join(w))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = op9(docs)
    assert {c for _, c in want.values()} == set(range(0, 120, 3))
    assert as_map(neardup.near_duplicates(df)) == want


def test_edges(spark):
    docs = [(3, None), (1, ""), (2, " \t"), (10, "one two"), (5, "One  TWO"), (7, "one two three"),
            (20, "a b c d e f"), (21, "a b c d e"), (22, "A b c d e f"), (30, "x " * 400_000), (31, "x x x x x x"),
            (None, "one two"), (40, "again again"), (40, "again again")]
    df = spark.createDataFrame([(i, t, 0, 1) for i, t in docs], "doc_id long, text string, n int, component int")
    rows = neardup.near_duplicates(df).collect()
    got = {r["id"]: (r["n"], r["component"]) for r in rows}
    assert len(rows) == len(docs) and got[None] == (1, None)
    assert {k: v for k, v in got.items() if k} == op9([d for d in docs if d[0]])
    kept = neardup.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(
        [None, 1, 2, 3, 5, 7, 20, 21, 30, 40, 40], key=str)
    assert neardup.near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize("hot,most", [(1000, 1_000_000), (3, 1_000_000), (3, 0)])
def test_components_of_hubs_paths_and_random_graphs(spark, monkeypatch, hot, most):
    import random

    from metricstore.llm import components

    monkeypatch.setattr(components, "HOT", hot)
    monkeypatch.setattr(components, "MOST_HOT", most)
    rng = random.Random(hot)
    edges = [(50, 1000 + i) for i in range(200)] + [(2000 + i, 2001 + i) for i in range(40)] + [(7, 7), (1003, 2)]
    edges += [(rng.randrange(5000, 5100), rng.randrange(5000, 5100)) for _ in range(60)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        up[hi] = lo
    got = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}


def test_labels_that_agree_along_every_edge_take_no_further_round(spark, monkeypatch):
    from metricstore.llm import components

    written = []
    monkeypatch.setattr(components, "stored", lambda df, name, f=components.stored: written.append(name) or f(df, name))
    stars = spark.createDataFrame([(1, 2), (1, 3), (4, 5), (6, 4)], "a long, b long")
    got = {r["id"]: r["component"] for r in components.components(stars).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4}
    assert written == ["component-edges", "component-hot", "component-labels", "component-step"]
