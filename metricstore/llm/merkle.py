"""A Merkle manifest of a dataset: content-addressed nodes, proofs by descent, verification.

Every row is a leaf: the SHA-256 (lowercase hexadecimal) of its columns, each
``-`` if null, else its UTF-8 byte count, ``:`` and its value.  The leaves of a
group (``source``) stand in ascending id order; every ``FANOUT`` consecutive
nodes become the digest of their digests until one is left, the group's
subroot.  The subroots, ordered by group (null first, bytewise), give the root
in the same way.  A group of one leaf has that leaf as its subroot.

Layout below ``path`` (Parquet):

- ``leaves``: ``tree`` (the group, a number in group order), ``n`` (its leaves),
  ``rank``, id, group, ``leaf`` and the carried columns;
- ``nodes/top=.../pass=...``: ``height`` (levels above the leaves), ``digest`` and
  ``children`` (digests); equal nodes are stored once;
- ``heads``: ``tree``, ``n``, ``rank`` (in the upper tree), ``digest`` (subroot);
- ``root``: one row, ``n`` (groups) and ``digest``.

Ranks come from a range partitioning: a leaf's place in its range plus the
leaves of the group in the ranges before, so a hot group is spread over many
tasks.  Four levels are hashed a pass; a pass moves one row per 81 nodes of the
one before.

Proofs descend from the root: each step looks up the digests reached so far
among the nodes of that height, follows the children that the requested ranks'
base-``FANOUT`` digits name, and collects the children left aside.  Requests that
share a path share its row until they part, so the root is looked up once and
no digest is a hot key.  The collected segments, reversed, lead from the leaf
to the root.

Defined results: rows that repeat an id are separate leaves, ordered by their
digest; a null id comes first in its group; a null group is a group; an empty
table has no leaves, no root and no proofs; columns beyond the named ones are
left alone.  Everything runs as DataFrame functions; the plan grows with the
logarithm of the largest group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricstore.llm.arrays import fresh
from metricstore.llm.store import stored

FANOUT = 3
LEVELS = 4  # hashed in one pass
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(columns: dict[str, Column] | list[str] | tuple[str, ...] = LEAF_COLUMNS) -> Column:
    """The leaf of a row, from columns by name or from expressions."""
    cols = columns.values() if isinstance(columns, dict) else [F.col(f"`{c}`") for c in columns]
    parts = []
    for c in cols:
        value = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(F.transform(digests, _hex), ""), 256))


def height_of(n: Column) -> Column:
    """Levels above ``n`` leaves: the least h with FANOUT ** h >= n."""
    powers = F.array(*[F.lit(FANOUT ** k) for k in range(39)])
    return F.size(F.filter(powers, lambda p: p < n))


def ranked(df: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``df`` with ``tree`` (the group, a number in group order), ``rank`` in it from 0, and ``n``, its rows.

    Only one row per range and group goes through a window.
    """
    dealt = stored(df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
                   .withColumn("at", F.monotonically_increasing_id()), "merkle-order")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    stats = dealt.groupBy(F.col(group).alias("g"), F.col("part").alias("p")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    by = "partition by g"
    stats = stats.selectExpr(
        "g", "p", "first", f"min(first) over ({by}) as tree", f"sum(rows) over ({by}) as n",
        f"sum(rows) over ({by} order by p) - rows as before")
    return (dealt.join(stats, dealt[group].eqNullSafe(stats["g"]) & (dealt["part"] == stats["p"]))
            .withColumn("rank", F.col("at") - F.col("first") + F.col("before"))
            .drop("at", "part", "g", "p", "first", "before"))


def _runs(digests: Column) -> Column:
    """FANOUT consecutive digests at a time; the last run may be shorter."""
    last = F.ceil(F.size(digests) / FANOUT).cast("int") - 1
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(digests, i * FANOUT + 1, FANOUT))


def _nodes(runs: Column, digests: Column, height: int) -> Column:
    return F.transform(runs, lambda children, i: F.struct(
        F.lit(height).alias("height"), F.get(digests, i).alias("digest"), children.alias("children")))


def _hash_levels(rows: DataFrame, base: int) -> DataFrame:
    """Blocks of FANOUT ** LEVELS consecutive nodes of height ``base``, with ``made`` (their nodes above) and ``digest``.

    A level is hashed only while its tree has several nodes there.
    """
    span = FANOUT ** LEVELS
    out = rows.groupBy("tree", "n", F.expr(f"rank div {span}").alias("rank")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("rank").alias("r"), "digest"))).alias("l"))
    out = out.select("tree", "n", "rank", F.col("l")["digest"].alias("d0"))
    made = []
    for k in range(LEVELS):
        below, above, runs = F.col(f"d{k}"), F.col(f"d{k + 1}"), F.col(f"c{k}")
        several = F.col("n") > FANOUT ** (base + k)
        out = out.withColumn(f"c{k}", F.when(several, _runs(below)))
        out = out.withColumn(f"d{k + 1}", F.when(several, F.transform(runs, _joined)).otherwise(below))
        made.append(F.when(several, _nodes(runs, above, base + k + 1)))
    nothing = F.array().cast("array<struct<height:int,digest:binary,children:array<binary>>>")
    return out.select("tree", "n", "rank", F.col(f"d{LEVELS}")[0].alias("digest"),
                      F.concat(*[F.coalesce(m, nothing) for m in made]).alias("made"))


def _build(rows: DataFrame, path: str) -> DataFrame:
    """Write the nodes above (tree, n, rank, digest); return (tree, n, digest) of the trees' last nodes."""
    spark = rows.sparkSession
    most = rows.agg(F.max("n")).first()[0] or 0
    base = 0
    while True:
        if FANOUT ** base >= most:
            return rows.select("tree", "n", "digest")
        done = stored(_hash_levels(rows, base), "merkle-pass")
        (done.select(F.explode("made").alias("m")).select("m.*").dropDuplicates(["height", "digest"])
         .write.parquet(f"{path}/pass={base}"))
        rows = done.select("tree", "n", "rank", "digest")
        base += LEVELS


def write_manifest(docs: DataFrame, path: str, doc_id: str = "doc_id", group: str = "source",
                   columns: list[str] | tuple[str, ...] = LEAF_COLUMNS, carry: dict[str, Column] | None = None) -> None:
    """Write the manifest of ``docs`` at ``path``; ``carry`` names small expressions of a row kept with its leaf."""
    leaves = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{group}`").alias("group"),
                         leaf_digest(columns).alias("leaf"), *[c.alias(f"carried_{k}") for k, c in (carry or {}).items()])
    ranked(leaves, "group", ["id", "leaf"]).write.parquet(f"{path}/leaves")
    spark = docs.sparkSession
    leaves = spark.read.parquet(f"{path}/leaves")
    subroots = _build(leaves.select("tree", "n", "rank", F.unhex("leaf").alias("digest")), f"{path}/nodes/top=0")
    heads = ranked(subroots.select(F.lit(0).alias("all"), F.col("tree").alias("t"), F.col("n").alias("n_leaves"), "digest"),
                   "all", ["t"])
    heads.select(F.col("t").alias("tree"), F.col("n_leaves"), F.lit(0).cast("long").alias("top"), "n", "rank",
                 "digest").write.parquet(f"{path}/heads")
    heads = spark.read.parquet(f"{path}/heads")
    _build(heads.select(F.col("top").alias("tree"), "n", "rank", "digest"), f"{path}/nodes/top=1").select(
        "n", "digest").write.parquet(f"{path}/root")


def _descend(spark: SparkSession, starts: DataFrame, path: str, most: int, wanted: DataFrame | None) -> DataFrame:
    """(tree, rank, digest, segments) of leaves, from ``starts`` (tree, n, digest, segments) at their trees' heights.

    ``wanted`` (tree, rank): follow the paths to these ranks alone.
    """
    top = 0
    while FANOUT ** top < most:
        top += 1
    starts = starts.withColumn("height", height_of(F.col("n")))
    asked = {}
    if wanted is not None:
        asked[0] = wanted.select("tree", "rank").distinct()
        for h in range(1, top + 1):
            asked[h] = asked[h - 1].select("tree", F.expr(f"rank div {FANOUT}").alias("rank")).distinct()
    frontier = None
    cols = ["tree", F.lit(0).cast("long").alias("rank"), "digest", "segments"]
    for h in range(top, -1, -1):
        entering = starts.where(F.col("height") == h).select(*cols)
        frontier = entering if frontier is None else frontier.unionByName(entering)
        if wanted is not None:
            frontier = frontier.join(asked[h], ["tree", "rank"], "left_semi")
        if h == 0:
            return frontier
        nodes = (spark.read.parquet(f"{path}/pass={(h - 1) // LEVELS * LEVELS}").where(F.col("height") == h)
                 .select("digest", "children"))
        below = frontier.join(nodes, "digest").select(
            "tree", "rank", "segments", "children", F.posexplode("children").alias("digit", "child"))
        # FANOUT - 1 siblings at most, apart by the side they stand on
        left = F.slice("children", F.lit(1), F.col("digit"))
        right = F.slice("children", F.col("digit") + 2, F.lit(FANOUT))
        segment = F.struct(*[F.aggregate(side, F.lit(b""), lambda acc, x: F.concat(acc, x)).alias(name)
                             for side, name in ((left, "left"), (right, "right"))])
        frontier = below.select("tree", (F.col("rank") * FANOUT + F.col("digit")).alias("rank"),
                                F.col("child").alias("digest"),
                                F.concat("segments", F.array(segment)).alias("segments"))
    return frontier


def proofs(spark: SparkSession, path: str, requests: DataFrame | None = None) -> DataFrame:
    """One row per leaf: the columns of ``leaves``, subroot, root and ``proof``.

    ``proof``: segments from the leaf up to the root, each with the digests that
    stand ``left`` and ``right`` of the path's node, joined as binary.
    ``requests`` (tree, rank): the proofs of these leaves alone; repeated
    requests give one row.
    """
    leaves = spark.read.parquet(f"{path}/leaves")
    heads, root = spark.read.parquet(f"{path}/heads"), spark.read.parquet(f"{path}/root")
    sizes = leaves.agg(F.max("n").alias("a")).first()["a"]
    if sizes is None:
        kind = "array<struct<left:binary,right:binary>>"
        return leaves.select("*", F.lit("").alias("subroot"), F.lit("").alias("root"), F.array().cast(kind).alias("proof"))
    end = root.first()
    none = F.array().cast("array<struct<left:binary,right:binary>>")
    groups = requests.select("tree").distinct() if requests is not None else None
    first = root.select(F.lit(0).cast("long").alias("tree"), "n", "digest", none.alias("segments"))
    asked = None
    if groups is not None:
        asked = heads.join(groups, "tree", "left_semi").select(F.col("top").alias("tree"), "rank")
    reached = _descend(spark, first, f"{path}/nodes/top=1", end["n"], asked)
    starts = heads.select(F.col("tree").alias("own"), "n_leaves", "rank").join(
        reached.select("rank", "digest", "segments"), "rank")
    starts = stored(starts.select(F.col("own").alias("tree"), F.col("n_leaves").alias("n"), "digest", "segments"),
                    "merkle-subroots")
    found = _descend(spark, starts, f"{path}/nodes/top=0", sizes, requests)
    subroots = starts.select("tree", _hex(F.col("digest")).alias("subroot"))
    return (leaves.join(found.select("tree", "rank", F.reverse("segments").alias("proof")), ["tree", "rank"])
            .join(subroots, "tree").withColumn("root", F.lit(bytes(end["digest"]).hex())))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf (hexadecimal) and its proof give."""
    return F.aggregate(proof, leaf, lambda acc, s: F.sha2(
        F.concat(_hex(s["left"]), acc, _hex(s["right"])), 256))


def proof_text(proof: Column) -> Column:
    """All siblings from leaf to root, left to right, as hexadecimal text."""
    return F.array_join(F.transform(proof, lambda s: _hex(F.concat(s["left"], s["right"]))), "")


def verify(spark: SparkSession, path: str, presented: str = "leaf", requests: DataFrame | None = None) -> DataFrame:
    """``proofs`` with ``folded_root`` of the ``presented`` leaf (``leaf`` or a carried name) and ``verified``."""
    name = presented if presented == "leaf" else f"carried_{presented}"
    out = proofs(spark, path, requests)
    name_ = fresh(out.columns, "folded_root")
    return out.withColumn(name_, folded(F.col(name), F.col("proof"))).withColumn("verified", F.col(name_) == F.col("root"))
