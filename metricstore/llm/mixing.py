"""Mixing sources to target weights by weighted sampling without replacement.

Targets: sources in code-point order (null last) take weights in turn and share
``share`` times all words by weight; a target stops at ``most`` times its
source's words, and what exceeds that is shared again by weight until no target
is above.

Sampling: each document draws an exponential key, divided by its quality weight
(Efraimidis and Spirakis): small keys first is a weighted sample without
replacement.  A target of e whole epochs and a rest takes every document e
times; the rest goes to the documents with the smallest keys, up to the one
whose end comes nearest to the target.  Keys come from a hash of the id, so
reruns agree.

The rest's cut is found without sorting a source in one task: keys fall into
buckets of about ``bucket_docs`` documents, the buckets' words are summed, and
only documents within a bucket are sorted.  The resulting plan has a row per
source, and a document's share follows from its own key and that row.

Rows equal in id and text share a key.  The cut may fall among them: then they are
numbered, within the parts of a written table they lie in and by the parts'
numbers of rows, and as many are taken as come nearest to the target.

Defined results: a null or empty text has size 0 and takes 0; a source without
words has target 0; rows that repeat an id with other texts, and null ids, are
documents of their own; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricstore.llm.store import stored

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: str | Column) -> Column:
    col = F.col(text) if isinstance(text, str) else text
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(WORD)).cast("long")


def letter_share(text: str | Column) -> Column:
    """A quality weight from 0.1 to 1: the share of letters among the characters that aren't white space."""
    solid = F.regexp_replace(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"[\x20\x09-\x0D]+", "")
    letters = F.length(F.regexp_replace(solid, r"\P{L}+", ""))
    return F.lit(0.1) + F.lit(0.9) * F.coalesce(F.try_divide(letters, F.length(solid)), F.lit(0.0))


def sample_key(doc_id: str, text: str, weight: Column, seed: int) -> Column:
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(unit) / weight


def _sized(docs: DataFrame, doc_id: str, source: str, text: str, quality: Column | None, seed: int) -> DataFrame:
    weight = letter_share(text) if quality is None else quality
    return docs.select(F.col(doc_id).alias("id"), F.col(source).alias("source"), n_words(text).alias("size"),
                       sample_key(doc_id, text, weight, seed).alias("key"), weight.alias("weight"))


def _targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Sources with weight and target; rounds of sharing run as sums over the source table."""
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # a row per source
    given = F.array(*[F.lit(float(w)) for w in weights])
    sources = stored(sources.withColumn("turn", turn).withColumn(
        "given", F.element_at(given, F.pmod("turn", F.lit(len(weights))) + 1)), "mix-sources")
    cap = F.col("source_size") * F.lit(most)
    total, every = sources.agg(F.sum("source_size"), F.sum("given")).first()
    goal, level, full = share * float(total or 0), share * float(total or 0) / (every or 1.0), -1.0
    while True:
        above = F.col("given") * F.lit(level) > cap
        row = sources.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("given")))).first()
        if row[1] is None or (row[0] or 0.0) == full:
            break
        full = float(row[0] or 0.0)
        level = (goal - full) / row[1]
    return sources.withColumn("target", F.least(F.col("given") * F.lit(level), cap))


def _plan(sized: DataFrame, weights: tuple[float, ...], share: float, most: float, bucket_docs: int) -> DataFrame:
    """(source, source_size, target, epochs, cut_key, cut_id, cut_size), a row per source."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"),
                                          F.avg("weight").alias("mean"))
    targets = _targets(sources, weights, share, most)
    epochs = F.floor(F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0)) + F.lit(1e-12))
    targets = stored(targets.withColumn("epochs", epochs).withColumn(
        "rest", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")))
        .withColumn("buckets", F.ceil(F.col("docs") / bucket_docs)), "mix-targets")
    s, t = sized.alias("s"), targets.alias("t")
    part = F.floor((1 - F.exp(-F.col("s.key") * F.col("t.mean"))) * F.col("t.buckets"))
    placed = s.join(t, F.expr("s.source <=> t.source")).where("t.rest > 0").select(
        "s.source", "s.id", "s.size", "s.key", "t.rest", part.alias("bucket"))
    over = Window.partitionBy("source").orderBy("bucket")
    sums = (placed.groupBy("source", "bucket").agg(F.sum("size").alias("n"), F.first("rest").alias("rest"))
            .withColumn("end", F.sum("n").over(over)).withColumn("before", F.col("end") - F.col("n"))
            .where("before < rest and end >= rest").select("source", "bucket", "before", "rest"))
    # One bucket of each source holds the cut; equal rows are one row with their number.
    p, c = placed.alias("p"), sums.alias("c")
    inside = p.join(c, F.expr("p.source <=> c.source and p.bucket = c.bucket")).groupBy(
        "p.source", "p.key", "p.id", "p.size", "c.before", "c.rest").agg(F.count(F.lit(1)).alias("rows"))
    row = Window.partitionBy("source").orderBy("key", "id", "size")
    end = F.col("before") + F.sum(F.col("rows") * F.col("size")).over(row.rowsBetween(Window.unboundedPreceding, 0))
    # Rows up to the end nearest to the rest; half-way, the shorter.
    fits = F.when(F.col("end") <= F.col("rest"), F.col("rows")).otherwise(F.greatest(F.lit(0), F.ceil(
        (F.col("rest") - (F.col("end") - F.col("rows") * F.col("size"))) / F.greatest(F.lit(1), "size") - 0.5))).cast("long")
    taken = (inside.withColumn("end", end).withColumn("take", fits).where("take > 0")
             .groupBy("source").agg(F.max(F.struct("key", "id", "size", "rows", "take")).alias("cut")))
    # Nothing of the cut's bucket taken: everything below its first key.
    low = inside.groupBy("source").agg(F.min("key").alias("first_key"))
    t, k, f = targets.alias("t"), taken.alias("k"), low.alias("f")
    return stored(t.join(k, F.expr("t.source <=> k.source"), "left").join(f, F.expr("t.source <=> f.source"), "left").select(
        "t.source", "t.source_size", "t.target", "t.epochs", F.coalesce("k.cut.key", "f.first_key").alias("cut_key"),
        F.col("k.cut.id").alias("cut_id"), F.col("k.cut.size").alias("cut_size"),
        F.col("k.cut.rows").alias("cut_rows"), F.col("k.cut.take").alias("cut_take")), "mix-plan")


#: A row of ``d`` is one of the equal rows at the cut of the plan ``p``, of which some are not taken.
_AT_CUT = """coalesce(d.key = p.cut_key and p.cut_size is not null and struct(d.id, d.size) = struct(p.cut_id, p.cut_size)
             and p.cut_take < p.cut_rows, false)"""
#: Copies of a row of ``d`` that the plan ``p`` takes: whole epochs, and one more up to the cut.
_TIMES = """p.epochs + cast(coalesce(d.key < p.cut_key or (d.key = p.cut_key and p.cut_size is not null and
            struct(d.id, d.size) <= struct(p.cut_id, p.cut_size)), false) as bigint)"""


def _numbered(rows: DataFrame, group: str) -> DataFrame:
    """Rows with ``number``, from 0 within their group: by the parts of a written table, so a large group is not one task's."""
    placed = stored(rows.withColumn("at", F.monotonically_increasing_id()), "mix-equal").withColumn(
        "part", F.shiftright("at", 33))
    parts = placed.groupBy(F.col(group).alias("g"), F.col("part").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    parts = parts.withColumn("before", F.sum("n").over(Window.partitionBy("g").orderBy("p")) - F.col("n"))
    own = F.row_number().over(Window.partitionBy(group, "part").orderBy("at")) - 1
    return (placed.withColumn("own", own).join(parts, F.col(group).eqNullSafe(F.col("g")) & (F.col("part") == F.col("p")))
            .withColumn("number", F.col("own") + F.col("before")).drop("at", "part", "own", "g", "p", "n", "before"))


def _times(joined: DataFrame, plan: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and times of rows joined with the plan; equal rows at a cut get their share by number."""
    out = joined.where(F.expr(f"not {_AT_CUT}")).select(*keep, F.expr(_TIMES).alias("times"))
    if plan.where("cut_take < cut_rows").isEmpty():
        return out
    equal = _numbered(joined.where(F.expr(_AT_CUT)).select(*keep, F.col("p.source").alias("of"), "p.epochs", "p.cut_take"), "of")
    names = [k.split(".")[-1] for k in keep]
    return out.unionAll(equal.select(*names, (F.col("epochs") + (F.col("number") < F.col("cut_take")).cast("long")).alias("times")))


def mix_plan(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
             weights: tuple[float, ...] = (1, 2, 3), share: float = 1.0, most: float = 3.0,
             quality: Column | None = None, seed: int = 17, bucket_docs: int = 4096) -> tuple[DataFrame, DataFrame]:
    """(a row per document: id, size, source_size, target, times, taken; the plan, a row per source)."""
    sized = stored(_sized(docs, doc_id, source, text, quality, seed), "mix-sizes")
    plan = _plan(sized, weights, share, most, bucket_docs)
    joined = sized.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source"))
    rows = _times(joined, plan, ["d.id", "d.size", "p.source_size", "p.target"])
    return rows.withColumn("taken", F.col("size") * F.col("times")), plan


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
                    quality: Column | None = None, seed: int = 17, **options) -> DataFrame:
    """The documents the mix takes, once for each time, with their own columns; texts aren't moved."""
    _, plan = mix_plan(docs, doc_id, source, text, quality=quality, seed=seed, **options)
    weight = letter_share(text) if quality is None else quality
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    d = docs.select(row, F.col(doc_id).alias("id"), F.col(source).alias("source"), n_words(text).alias("size"),
                    sample_key(doc_id, text, weight, seed).alias("key")).alias("d")
    joined = d.join(plan.alias("p"), F.expr("d.source <=> p.source"))
    taken = _times(joined, plan, ["d.row"]).where("times > 0")
    return taken.select(F.explode(F.array_repeat("row", F.col("times").cast("int"))).alias("row")).select("row.*")
