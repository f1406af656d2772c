"""The registered queries of the operators, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricstore.llm import align, decontam, fingerprint, langid, licenses, lm_score, merkle, mixing, neardup, secrets, token_store, toxicity, warc
from metricstore.llm.store import small_batches
from metricstore.plans.scratch import scratch_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    out, hits = decontam.find_hits(docs, _read(spark, sf_dir, "benchmark"))
    hit = F.col(hits)
    return out.select(
        "doc_id", hit["n_words"].alias("n_words"), hit["n_hit"].alias("n_hit"),
        F.size(hit["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(hit["items"], ","), 256).alias("items_sha256"),
        (hit["n_hit"] > 0).alias("contaminated"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _remainder("doc_id", 5) == 1
    found = lm_score.score_texts(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score",
                        "score", "bits_per_byte")


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "llm/tokens")
    token_store.write_tokens(_read(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_store.read_tokens(spark, path, payload=False).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = mixing.mix_plan(_read(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def _remainder(column: str, by: int):
    return F.crc32(F.col(column).cast("string").cast("binary")) % by


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = _remainder("doc_id", 3) == 1
    profiles = langid.learn_profiles(docs.where(~held_out))
    out, found = langid.identify(docs.select("doc_id", "text"), profiles)
    return out.select("doc_id", held_out.alias("held_out"), F.col(found)["lang"].alias("lang_pred"),
                      F.col(found)["score"].alias("score"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm/warc")
    pages = _read(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    warc.write_archives(pages, path)
    back = warc.read_records(warc.index_archives(spark, path), payloads=False)
    return back.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.col("refers_to").cast(kind).alias("refers_to"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "word", F.length("value").cast("long").alias("n_chars"),
                        F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_likeness(_read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = neardup.near_duplicates(docs)
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, found = licenses.find_notices(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    f = F.col(found)
    base = F.array_sort(F.array_distinct(f["places"]["label"]))
    both = F.array_sort(F.array_union(base, f["spans"]["label"]))
    return out.select(
        "doc_id", f["n_words"].alias("n_words"), F.size(f["places"]).cast("long").alias("n_base"),
        F.array_min(f["places"]["start"]).alias("first_word"), F.array_max(f["places"]["start"]).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(both, ",").alias("labels"), f["score"].alias("score"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = _remainder("doc_id", 4) == 2
    model = toxicity.learn(docs.where(~held_out), _read(spark, sf_dir, "labels"))
    out, found = toxicity.score_texts(docs, model)
    score = F.col(found)["score"]
    return out.select("doc_id", held_out.alias("held_out"), score.alias("score"),
                      F.when(score >= 0.3, 1).otherwise(0).alias("predicted"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "llm/merkle")
    docs = _read(spark, sf_dir, "documents")
    shorn = F.when(_remainder("doc_id", 2) == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    presented = merkle.leaf_digest({c: shorn if c == "text" else F.col(c) for c in merkle.LEAF_COLUMNS})
    merkle.write_manifest(docs, path, carry={"presented": presented})
    found = merkle.verify(spark, path, "presented")
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root",
        F.sha2(merkle.proof_text(F.col("proof")), 256).alias("proof_sha256"), "folded_root", "verified")


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    found = align.align(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_lm_score": op2_lm_score,
    "op3_token_output": op3_token_output,
    "op4_source_mixing": op4_source_mixing,
    "op5_language_id": op5_language_id,
    "op6_warc": op6_warc,
    "op7_secret_scan": op7_secret_scan,
    "op8_fingerprints": op8_fingerprints,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_license_scan": op10_license_scan,
    "op11_toxicity": op11_toxicity,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_token_alignment": op13_token_alignment,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words_sql(pattern: str) -> str:
    return f"coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{pattern}'), [])"


_ALNUM_SQL = _words_sql(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SOLID_SQL = _words_sql(r"[^\x20\x09-\x0D]+")



def _field_sql(column: str) -> str:
    return f"coalesce(concat(octet_length(encode(cast({column} as varchar))), ':', cast({column} as varchar)), '-')"


#: CRC-32 of the decimal doc_id, bit by bit (DuckDB has no such function).
_CRC32_SQL = """xor(list_reduce(
            list_transform(range(1, length(cast(doc_id as varchar)) + 1), lambda i: cast(ascii(cast(doc_id as varchar)[i]) as bigint)),
            lambda c, b: list_reduce(range(8), lambda e, k: xor(e >> 1, (e & 1) * 3988292384), xor(c, b)),
            4294967295), 4294967295)"""
_FIELDS_SQL = ", ".join(map(_field_sql, ("doc_id", "source", "lang", "n_chars")))

ORACLES: dict[str, str] = {
    "op1_decontamination": f"""
        with d as (select doc_id, {_ALNUM_SQL} as w from documents),
        b as (select cast(item_id as varchar) as item, {_ALNUM_SQL} as w from benchmark),
        win as (
          select distinct item, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as g
          from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as t(i) where len(w) > 0),
        sizes as (select distinct n from win),
        places as (
          select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as g
          from d, sizes, unnest(range(1, len(w) - n + 2)) as t(i)),
        hits as (select doc_id, i, p.n, item from places p join win using (n, g)),
        words as (select distinct doc_id, p from hits, unnest(range(i, i + n)) as t(p)),
        n_hit as (select doc_id, count(*) as n_hit from words group by 1),
        items as (
          select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
          from (select distinct doc_id, item from hits) group by 1)
        select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
               coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from d left join n_hit using (doc_id) left join items using (doc_id)""",
    "op9_near_duplicates": f"""
        with recursive d as (select doc_id, {_SOLID_SQL} as w from documents),
        sh as (
          select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
          from d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as t(i) where len(w) > 0),
        n as (select doc_id, count(*) as n from sh group by 1),
        pairs as (
          select a.doc_id as a, b.doc_id as b, count(*) as x
          from sh a join sh b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
        links as (
          select pairs.a, pairs.b from pairs join n na on na.doc_id = pairs.a join n nb on nb.doc_id = pairs.b
          where 100 * x >= 75 * (na.n + nb.n - x)),
        edges as (select a, b from links union all select b, a from links),
        reach(doc_id, other) as (
          select doc_id, doc_id from documents
          union
          select r.doc_id, e.b from reach r join edges e on r.other = e.a),
        comp as (select doc_id, min(other) as component_id from reach group by 1)
        select d.doc_id, coalesce(n.n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
        from d join comp using (doc_id) left join n using (doc_id)""",
    "op12_merkle_manifest": f"""
        with recursive
        docs as (
          select *, case when {_CRC32_SQL} % 2 = 0 then replace(text, chr(10), '') else text end as shorn
          from documents),
        leaves as (
          select doc_id, dense_rank() over (order by source nulls first) - 1 as s,
                 row_number() over (partition by source order by doc_id nulls first) - 1 as r,
                 count(*) over (partition by source) as n,
                 sha256(concat({_FIELDS_SQL}, {_field_sql('text')})) as leaf,
                 sha256(concat({_FIELDS_SQL}, {_field_sql('shorn')})) as shown
          from docs),
        low(s, h, r, n, digest) as (
          select s, 0, r, n, leaf from leaves
          union all
          select s, h + 1, r // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' order by r))
          from low where n > 1 group by s, h, r // 3),
        subroots as (select s, h, digest from low where n = 1),
        high(h, r, n, digest) as (
          select 0, s, count(*) over (), digest from subroots
          union all
          select h + 1, r // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' order by r))
          from high where n > 1 group by h, r // 3),
        steps as (
          select l.s, l.h, l.r, coalesce(string_agg(o.digest, '' order by o.r) filter (where o.r < l.r), '') as lo,
                 coalesce(string_agg(o.digest, '' order by o.r) filter (where o.r > l.r), '') as hi
          from low l left join low o on o.s = l.s and o.h = l.h and o.r // 3 = l.r // 3 and o.r <> l.r
          where l.n > 1 group by l.s, l.h, l.r
          union all
          select t.s, t.h + l.h, l.r, coalesce(string_agg(o.digest, '' order by o.r) filter (where o.r < l.r), ''),
                 coalesce(string_agg(o.digest, '' order by o.r) filter (where o.r > l.r), '')
          from subroots t join high l on cast(floor(t.s / pow(3, l.h)) as bigint) = l.r
          left join high o on o.h = l.h and o.r // 3 = l.r // 3 and o.r <> l.r
          where l.n > 1 group by t.s, t.h, l.h, l.r),
        fold(doc_id, s, r, top, h, place, acc, proof) as (
          select doc_id, leaves.s, r, subroots.h, 0, r, shown, '' from leaves join subroots using (s)
          union all
          select f.doc_id, f.s, f.r, top, f.h + 1, place // 3,
                 sha256(concat(p.lo, acc, p.hi)), concat(proof, p.lo, p.hi)
          from (select * replace (case when h = top then s else place end as place) from fold) f
          join steps p on p.s = f.s and p.h = f.h and p.r = f.place),
        ends as (select doc_id, last(acc order by h) as folded_root, last(proof order by h) as proof from fold group by 1)
        select doc_id, leaf, subroots.digest as subroot, high.digest as root, sha256(proof) as proof_sha256,
               folded_root, folded_root = high.digest as verified
        from leaves join subroots using (s) join high on high.n = 1 join ends using (doc_id)""",
}
