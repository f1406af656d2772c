"""The pipeline, stage by stage, against plain versions; edge tables through all stages."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from brute import op1, op9, solid_words
from test_langid import plain_predict, plain_profiles
from test_mixing import targets
from tokenizers import Tokenizer

import corpus_pipeline
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def token_rows(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, out = 0, []
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "")):
        ids = np.array(t.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_stages_equal_plain_versions(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("text", F.when(F.col("doc_id") == 7, "12 34")
                                                                    .otherwise(F.col("text")))
    before, columns = docs.collect(), docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / str(k))
        docs = stage(spark, docs, SF)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        after = docs.collect()
        assert name == "token_output" or docs.columns == columns
        ids = Counter(r["doc_id"] for r in after)
        pairs = [(r["doc_id"], r["text"]) for r in before]
        if name == "language_id":
            profiles = plain_profiles([(r["text"], r["lang"]) for r in before], 400)
            told = {d: plain_predict(t, profiles, 400) for d, t in pairs}
            assert set(ids) == {d for d, (lang, score) in told.items() if lang != "und" and score >= 0.2}
            assert 7 not in ids and len(ids) == len(before) - 1
        elif name == "near_dedup":
            assert set(ids) == {d for d, (_, c) in op9(pairs).items() if d == c} and len(ids) < len(before)
        elif name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(ids) == {d for d, w in op1(pairs, items).items() if not w[4]} and len(ids) < len(before)
        elif name == "source_mixing":
            size = {r["doc_id"]: len(solid_words(r["text"])) for r in before}
            sums, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
            for r in before:
                sums[r["source"]] += size[r["doc_id"]]
                largest[r["source"]] = max(largest[r["source"]], size[r["doc_id"]])
            for r in after:
                taken[r["source"]] += size[r["doc_id"]]
            assert max(ids.values()) <= 3 and set(ids) <= set(size)
            assert all(abs(taken[s] - n) <= largest[s] / 2 + 1e-6 for s, n in targets(dict(sums)).items())
        else:
            assert sorted(tuple(r) for r in after) == sorted(token_rows(before))
        before = after


def test_run_gives_the_last_stages_rows(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    rows = sorted(got.collect(), key=lambda r: r["start"])
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(len(rows))]
    assert sorted(got.collect()) == sorted(corpus_pipeline.run(spark, SF).collect())


def test_edge_tables_pass_every_stage(spark, tmp_path):
    rows = [(1, None, "en", "a", 0), (2, "", None, None, 0), (3, "some words here", "en", "a", 1),
            (3, "some words here", "en", "a", 1), (None, "no id here", "en", "b", 2), (4, "more words there", None, "b", 3),
            (5, "x " * 200_000, "en", "b", 4)]
    ddl = "doc_id long, text string, lang string, source string, component long"
    for case, frame in enumerate((spark.createDataFrame(rows, ddl), spark.createDataFrame(rows[1:2], ddl),
                                  spark.createDataFrame([], ddl))):
        docs, counts = frame, []
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = str(tmp_path / f"{case}-{k}")
            stage(spark, docs, SF).write.parquet(path)
            docs = spark.read.parquet(path)
            counts.append(docs.count())
            assert name == "token_output" or docs.columns == frame.columns
        assert counts[0] == (5, 1, 0)[case] and counts[3] == counts[4]
