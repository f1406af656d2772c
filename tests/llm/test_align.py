"""Token alignment against a plain version over whole texts."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from metricstore.llm import align, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(rows):
    """[(id, text)] -> sorted rows of the result."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = align.byte_of_letter()

    def of_a(i):
        return bytes(byte[c] for c in tokenizer.id_to_token(i))

    def of_b(i):
        p = model.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()

    docs, held = [], Counter()
    for d, text in rows:
        groups = []
        if text:
            a, b = tokenizer.encode(" " + text, add_special_tokens=False).ids, model.encode(text)
            raw = (" " + text).encode()
            if b"".join(map(of_a, a)) == raw == b"".join(map(of_b, b)):
                ends = []
                for ids, of in ((a, of_a), (b, of_b)):
                    at, e = 0, []
                    for i in ids:
                        at += len(of(i))
                        e.append(at)
                    ends.append(e)
                both = sorted(set(ends[0]) & set(ends[1]))
                start = 0
                for cut in both:
                    groups.append(([i for i, e in zip(a, ends[0]) if start < e <= cut],
                                   [i for i, e in zip(b, ends[1]) if start < e <= cut]))
                    start = cut
        links = Counter((x, y) for g in groups for x in g[0] for y in g[1])
        held.update(links.keys())
        docs.append((d, groups, links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for d, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((d, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


EDGES = [
    (1, None), (2, ""), (3, " "), (4, "a"), (5, "a  b   c\n\nd\t e "), (6, "<|endoftext|> x <s> </s>"), (7, "one ▁ two"),
    (8, "漢字漢字 漢"), (9, "é ﬁ \U00013000 x"), (10, "x" * 20_000), (11, "don't can't, (that); 12345 "),
    (12, "ñandú café Über " * 300), (12, "twice"), (12, "twice"), (None, "no id"), (13, "   lead and trail   "), (14, "\x00\x01 nul")]


def got(df):
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_edges(spark):
    df = spark.createDataFrame([(d, t, 1, "c") for d, t in EDGES], "doc_id long, text string, chunk int, pairs string")
    assert got(align.align(df, A, B)) == plain(EDGES)
    assert got(align.align(df.repartition(5), A, B)) == plain(EDGES)
    assert align.align(df.where("false"), A, B).count() == 0
    assert got(align.align(df.where("text is null"), A, B)) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op13_token_alignment(spark, sf).withColumnRenamed("doc_id", "id")) == plain(rows)


def test_cuts_are_common_ends(spark):
    df = spark.createDataFrame([(d, t) for d, t in EDGES], "a_ids long, text string")
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    for r in align.cuts(df, "found", A, B).collect():
        f = r["found"]
        if r["text"] and f["a_ids"]:
            assert f["a_ids"] == tokenizer.encode(" " + r["text"], add_special_tokens=False).ids
            assert f["byte_ends"][-1] == len(r["text"].encode()) + 1
            assert f["a_ends"][-1] == len(f["a_ids"]) and f["b_ends"][-1] == len(f["b_ids"])
            assert f["byte_ends"] == sorted(set(f["byte_ends"]))
        else:
            assert f["a_ids"] == f["byte_ends"] == []


@pytest.mark.parametrize("n", [0, 1, 7])
def test_lockstep(n):
    import random

    import numpy as np

    rng = random.Random(n)
    ends, firsts = ([], []), ([0], [0])
    at, want = 0, 0
    for _ in range(n):
        size = rng.randint(1, 60)
        sides = [sorted({*rng.sample(range(1, size + 1), rng.randint(1, size)), size}) for _ in range(2)]
        for e, f, s in zip(ends, firsts, sides):
            e += [at + x for x in s]
            f.append(len(e))
        want += len(set(sides[0]) & set(sides[1]))
        at += size
    a, b = (np.array(e, np.int64) for e in ends)
    groups = align.lockstep(a, np.array(firsts[0]), b, np.array(firsts[1]))
    assert len(groups) == want
    assert all(a[g[1] - 1] == b[g[3] - 1] for g in groups)
    assert [g[0] for g in groups[1:]] == [g[1] for g in groups[:-1]]
