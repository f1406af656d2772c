"""Web archives: round trip, revisits, byte ranges."""

import base64
import hashlib

from metricstore.llm import queries, warc


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        b = (html or "").encode()
        if len(b) >= least and i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, _, html in rows:
        b = (html or "").encode()
        again = i is not None and first.get(b, i) != i
        out.append((i, len(b), digest(b), "revisit" if again else "response", first[b] if again else None))
    return out


def test_query(spark):
    for sf in ("/root/testdata/sf0.01",):
        rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
        got = [tuple(r) for r in queries.op6_warc(spark, sf).select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
        assert sorted(got) == sorted(expected(rows))


PAGES = [(3, "http://a/\r\nX: y", "same"), (1, None, "same"), (2, "", "same"), (9, "u", None), (8, "ü", ""),
         (5, "v", "a\r\n\r\nWARC/1.1\r\nb\r\n\r\n"), (6, "w", "ñ漢\U0001f600"), (7, "x", "y" * 3_000_000), (4, "z", "same"),
         (12, "dup", "dup"), (12, "dup", "dup"), (None, "n", "alone")]


def test_edges_and_selection(spark, tmp_path):
    df = spark.createDataFrame([(*p, "d", 5) for p in PAGES], "page_id long, url string, html string, digest string, size int")
    for least in (0, 5):
        path = str(tmp_path / f"warc{least}")
        warc.write_archives(df.repartition(3), path, least=least)
        index = warc.index_archives(spark, path, chunk=64)
        back = warc.read_records(index).collect()
        number = lambda x: None if x is None else int(x)
        got = [(number(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], number(r["refers_to"])) for r in back]
        assert sorted(map(str, got)) == sorted(map(str, expected(PAGES, least)))
        html = {p[0]: (p[2] or "").encode() for p in PAGES}
        for r in back:
            assert (r["payload"] is None) == (r["record_type"] == "revisit")
            assert r["payload"] is None or r["payload"] == html[number(r["page_id"])]
    some = warc.read_records(index.where("page_id in ('6', '7', '3')"), gap=0, most=100).collect()
    assert sorted(r["page_id"] for r in some) == ["3", "6", "7"]
    assert {r["url"] for r in some} == {"http://a/ X: y".replace(" X", "  X"), "w", "x"}


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(df, str(tmp_path / "w"))
    assert warc.read_records(warc.index_archives(spark, str(tmp_path / "w"))).count() == 0


def test_archives_are_read_by_several_tasks(spark, tmp_path):
    import pyspark.sql.functions as F

    pages = spark.range(600).select(F.col("id").alias("page_id"), F.lit("u").alias("url"),
                                    F.concat(F.col("id").cast("string"), F.repeat(F.lit("some html "), 1500)).alias("html"))
    path = str(tmp_path / "w")
    warc.write_archives(pages.repartition(4), path, per_file=40)
    index = warc.index_archives(spark, path)
    made = index.select(F.input_file_name().alias("f")).distinct().count()
    assert made > 1  # a file per task that indexed
    read = warc.read_records(index).select(F.spark_partition_id().alias("p"), "page_id", "payload_bytes")
    assert read.select("p").distinct().count() > 1
    assert read.count() == 600 == read.select("page_id").distinct().count()
