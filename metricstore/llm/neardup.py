"""MinHash near-duplicate detection with tensored banding.

A document's set holds its distinct ``size``-word shingles (64-bit hashes of the
lower-cased words).  Banding with L tables of 2t minhashes each would need 2tL
minhashes.  Here two collections A and B of ``keys`` half keys are made, each
half key from t minhashes, and every pair (A_i, B_j) is the key of a table:
keys**2 tables from 2 * t * keys minhashes.  Two sets of similarity J meet in a
table with probability (1 - (1 - J**t)**keys)**2: at t = 4, keys = 32 and
J = 0.75, all but 1 in 100,000.

Steps:

1. one pass over the texts writes a sketch per document: set size, a 128-bit
   hash of the set, the half keys;
2. documents with equal sets form a class; its smallest id goes on;
3. half keys A_i that two classes share are found first, and only those are
   paired with all B_j into table keys; classes that meet in a table are
   candidates, and tables that overlap form clusters;
4. the full sets of clustered classes are built again from the texts and
   compared exactly, in blocks of bounded size: first within each block, and
   with the cluster's most central class; then every class not yet connected to
   that one is compared with all blocks of the cluster.  A pair of classes is
   skipped only when both are already in one component, so no component is lost
   and no list of all pairs is made;
5. components of the confirmed links.

Defined results: a null or empty text has an empty set and is its own
component; a text of fewer words than ``size`` has one shingle, all its words;
rows of one id that repeats share one component; rows with a null id are in
no component (null) and are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.llm.arrays import SOLID, Words, constants, mix, runs, windows, words
from metricstore.llm.components import components
from metricstore.llm.store import stored

#: Largest block of sets compared at once: sets, and shingles of all together.
BLOCK_SETS, BLOCK_SHINGLES = 2048, 1 << 20


def shingle_sets(w: Words, size: int, mult: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first) with the sorted distinct shingles of row r in hashes[first[r]:first[r + 1]]."""
    at, hashes = windows(w, size, mult)
    begin = np.searchsorted(at, w.first)
    count = np.diff(w.first)
    short: dict[int, np.ndarray] = {}
    for n in range(1, size):
        at_n, hashes_n = windows(w, n, mult) if (count == n).any() else (at[:0], hashes[:0])
        for r in np.flatnonzero(count == n):
            i = np.searchsorted(at_n, w.first[r])
            short[int(r)] = hashes_n[i:i + 1]
    sets = []
    for r in range(len(count)):
        if count[r] >= size:
            x = np.sort(hashes[begin[r]:begin[r + 1]])
            sets.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        else:
            sets.append(short.get(r, hashes[:0]))
    first = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
    return (np.concatenate(sets) if sets else hashes[:0]), first


def _half_keys(hashes: np.ndarray, first: np.ndarray, keys: int, t: int, side: int) -> np.ndarray:
    """(rows, keys): each the mixed minima of t multiplicative hashes; rows must not be empty."""
    mult, put = constants(keys * t, 10 + side), constants(t, 20 + side)
    out = np.zeros((len(first) - 1, keys), np.uint64)
    buf = np.empty_like(hashes)
    for k in range(keys):
        for j in range(t):
            np.multiply(hashes, mult[k * t + j], out=buf)
            out[:, k] += mix(np.minimum.reduceat(buf, first[:-1])) * put[j]
    return mix(out + np.arange(1, keys + 1, dtype=np.uint64))


def sketches(docs: DataFrame, doc_id: str, text: str, size: int, keys: int, t: int) -> DataFrame:
    """(id, n, h1, h2, a, b) per row; a and b are empty where the set is."""
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([
        T.StructField("id", kind), T.StructField("n", T.LongType()),
        T.StructField("h1", T.LongType()), T.StructField("h2", T.LongType()),
        T.StructField("a", T.ArrayType(T.LongType())), T.StructField("b", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult = constants(size, 2)
        for batch in batches:
            for row, end, buf, offs in runs(batch.column(1)):
                hashes, first = shingle_sets(words(buf, offs, SOLID), size, mult)
                n = np.diff(first)
                full = n > 0
                start = first[:-1][full]
                h = np.zeros((2, len(n)), np.uint64)
                a, b = np.zeros((0, keys), np.uint64), np.zeros((0, keys), np.uint64)
                if full.any():
                    h[0, full] = np.add.reduceat(mix(hashes), start)
                    h[1, full] = np.bitwise_xor.reduceat(mix(hashes * mult[0]), start)
                    edges = np.append(start, len(hashes))
                    a, b = (_half_keys(hashes, edges, keys, t, side) for side in (0, 1))
                upto = pa.array(np.concatenate([[0], np.cumsum(full)]) * keys, pa.int32())
                b = (b >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(row, end - row), pa.array(n, pa.int64()),
                    pa.array(h[0].view(np.int64)), pa.array(h[1].view(np.int64)),
                    pa.ListArray.from_arrays(upto, pa.array(a.ravel().view(np.int64))),
                    pa.ListArray.from_arrays(upto, pa.array(b.ravel()))], names=schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


def _sets(members: DataFrame, size: int) -> DataFrame:
    """(id, cluster, leader, blocks, n, shingles) of (id, text, cluster, leader, blocks)."""
    kinds = {f.name: f for f in members.schema.fields}
    schema = T.StructType([*(kinds[c] for c in ("id", "cluster", "leader", "blocks")),
                           T.StructField("n", T.LongType()), T.StructField("shingles", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mult = constants(size, 2)
        for batch in batches:
            for row, end, buf, offs in runs(batch.column(1)):
                hashes, first = shingle_sets(words(buf, offs, SOLID), size, mult)
                sets = [hashes[s:e].tobytes() for s, e in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(k).slice(row, end - row) for k in (0, 2, 3, 4)),
                    pa.array(np.diff(first), pa.int64()), pa.array(sets, pa.binary())], names=schema.names)

    return members.mapInArrow(run, schema)


def _links(ids: list, sets: list[np.ndarray], left: np.ndarray, percent: int) -> list[tuple]:
    """Links (id, smallest id of its part) among sets of which one at least is on the left."""
    sizes = np.array([len(x) for x in sets])
    every, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(every, kind="stable")
    every, row = every[order], row[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, row = column[shared], row[shared]
    column = np.cumsum(np.concatenate([[True], column[1:] != column[:-1]])) - 1 if len(column) else column
    lefts = np.flatnonzero(left)
    place = np.full(len(sets), -1)
    place[lefts] = np.arange(len(lefts))
    both = np.zeros((len(lefts), len(sets)), np.float32)
    step = 4096
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        s, e = np.searchsorted(column, (c, c + step))
        x = np.zeros((len(sets), step), np.float32)
        x[row[s:e], column[s:e] - c] = 1
        both += x[lefts] @ x.T
    both = both.astype(np.int64)
    near = 100 * both >= percent * (sizes[lefts][:, None] + sizes[None, :] - both)
    part = np.arange(len(sets))
    while True:  # smallest index among linked ones, until it settles
        low = np.where(near, part[None, :], len(sets)).min(axis=1, initial=len(sets))
        now = part.copy()
        now[lefts] = np.minimum(now[lefts], low)
        up = np.where(near, now[lefts][:, None], len(sets)).min(axis=0, initial=len(sets))
        now = np.minimum(now, up)
        now = now[now]
        if (now == part).all():
            break
        part = now
    return [(ids[i], ids[p]) for i, p in enumerate(part) if i != p]


def _compare(blocks: DataFrame, key: list[str], percent: int) -> DataFrame:
    """Links (a, b) within each group of ``key``; rows: key columns, id, left, shingles."""
    kind = blocks.schema["id"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])
    blocks = blocks.repartition(*key).sortWithinPartitions(*key).select(*key, "id", "left", "shingles")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            order = sorted(range(len(ids)), key=ids.__getitem__)
            order = [i for n, i in enumerate(order) if not n or ids[i] != ids[order[n - 1]]]
            left = {ids[i] for i, x in enumerate(lefts) if x}
            found = _links([ids[i] for i in order], [np.frombuffer(sets[i], np.uint64) for i in order],
                           np.array([ids[i] in left for i in order]), percent)
            return pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in found], out)

        out, now = None, None
        ids, lefts, sets = [], [], []
        for batch in batches:
            if out is None:
                of = batch.schema.field("id").type
                out = pa.schema([("a", of), ("b", of)])
            columns = [batch.column(k).to_pylist() for k in range(len(key))]
            group = list(zip(*columns))
            for g, i, left, s in zip(group, *(batch.column(k).to_pylist() for k in ("id", "left", "shingles"))):
                if g != now and len(ids) > 1:
                    yield done()
                if g != now:
                    now, ids, lefts, sets = g, [], [], []
                ids.append(i)
                lefts.append(left)
                sets.append(s)
        if len(ids) > 1:
            yield done()

    return blocks.mapInArrow(run, schema)


def _blocks(n_sets, n_shingles, block_sets: int, block_shingles: int):
    return F.greatest(F.ceil(n_sets / block_sets), F.ceil(n_shingles / block_shingles), F.lit(1)).cast("int")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5,
                    percent: int = 75, keys: int = 32, t: int = 4, block_sets: int = BLOCK_SETS,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(id, n, component): a row per input row; component: the smallest id linked directly or through others."""
    sketch = stored(sketches(docs, doc_id, text, size, keys, t), "neardup-sketches")
    known = sketch.where("n > 0 and id is not null")
    classes = stored(known.groupBy("h1", "h2", "n").agg(
        F.min("id").alias("rep"), F.min_by(F.struct("a", "b"), "id").alias("keys")), "neardup-classes")
    alone = classes.select(F.col("rep").alias("id"), "n", "keys.a", "keys.b")

    # Both sides of these joins grow with the corpus, so they are shuffled at every size.
    half = alone.select("id", F.explode("a").alias("key"))
    met = half.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("key")
    central = half.join(met.hint("merge"), "key").groupBy("id").agg(F.collect_set("key").alias("met"))
    table = (alone.select("id", "b").join(central.hint("merge"), "id")
             .select("id", F.size("met").alias("degree"), F.explode("met").alias("i"), "b")
             .select("id", "degree", "i", F.posexplode("b").alias("j", "half"))
             .select("id", "degree", F.xxhash64("i", "j", "half").alias("key")))
    table = stored(table, "neardup-tables")
    found = _confirmed(docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")), _clusters(table),
                       alone.select("id", "n"), table.groupBy("id").agg(F.max("degree").alias("degree")), size,
                       percent, block_sets, block_shingles)
    # rows of one id with different texts join their classes
    named = known.select("id", "h1", "h2", "n").join(classes.drop("keys"), ["h1", "h2", "n"])
    top = named.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        "id", F.coalesce("component", "rep").alias("component"))
    top = top.groupBy("id").agg(F.min("component").alias("component"))
    return sketch.select("id", "n").join(top, "id", "left").select(
        "id", "n", F.coalesce("component", "id").alias("component"))


def _clusters(table: DataFrame) -> DataFrame:
    """(id, cluster) of the ids that meet another in a table key (id, key).

    Every id meets the smallest id of each of its keys.  Ids with the same
    smallest of those are a part, named by it; parts then join the parts of all
    the others they meet, an edge per part and id met.  The smallest id of a key
    meets itself there, so it is in a part, too.
    """
    lows = table.groupBy("key").agg(F.min("id").alias("b"), F.max("id").alias("hi")).where("b < hi").drop("hi")
    meets = stored(table.select("id", "key").join(lows.hint("merge"), "key").select("id", "b"), "neardup-meets")
    parts = stored(meets.groupBy("id").agg(F.min("b").alias("part")), "neardup-parts")
    met = meets.join(parts.hint("merge"), "id").select("part", "b").distinct()
    other = parts.select(F.col("id").alias("b"), F.col("part").alias("other"))
    joined = components(met.join(other, "b").where("part <> other").select(F.col("part").alias("a"), F.col("other").alias("b")))
    return parts.join(joined.withColumnRenamed("id", "part"), "part", "left").select(
        "id", F.coalesce("component", "part").alias("cluster"))


def _confirmed(texts: DataFrame, clusters: DataFrame, sizes: DataFrame, degrees: DataFrame, size: int,
               percent: int, block_sets: int, block_shingles: int) -> DataFrame:
    """(id, component) of the ids with a confirmed link."""
    known = stored(clusters.join(sizes.dropDuplicates(["id"]), "id").join(degrees, "id"), "neardup-clusters")
    shape = known.groupBy("cluster").agg(
        F.max_by("id", F.struct("degree", "id")).alias("leader"),
        _blocks(F.count("*"), F.sum("n"), block_sets, block_shingles).alias("blocks"))
    placed = stored(known.join(shape, "cluster").select("id", "cluster", "leader", "blocks"), "neardup-placed")
    members = texts.join(placed.hint("merge"), "id").select("id", "text", "cluster", "leader", "blocks")
    sets = stored(_sets(members, size).dropDuplicates(["id"]), "neardup-sets")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    first = sets.select("cluster", "id", "leader", "shingles", F.lit(True).alias("left"), F.explode(
        F.when(F.col("id") == F.col("leader"), every).otherwise(F.array(own))).alias("block"))
    part = components(stored(_compare(first, ["cluster", "block"], percent), "neardup-links"))
    if placed.where("blocks > 1").isEmpty():
        return part
    # Classes that the leader's component lacks, against every block of their cluster.
    large = sets.where("blocks > 1").join(part, "id", "left").withColumn("part", F.coalesce("component", "id"))
    main = large.where("id = leader").select("cluster", F.col("part").alias("main"))
    large = large.join(main, "cluster")
    outer = large.where("part <> main").groupBy("cluster").agg(
        _blocks(F.count("*"), F.sum("n"), block_sets, block_shingles).alias("outer_blocks"))
    large = stored(large.join(outer, "cluster").select(
        "cluster", "id", "shingles", "blocks", "outer_blocks", (F.col("part") != F.col("main")).alias("outside")),
        "neardup-large")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    outer_own = F.pmod(F.xxhash64("id"), F.col("outer_blocks")).cast("int")
    right = large.select("cluster", "id", F.lit(False).alias("left"), "shingles", own.alias("block"),
                         F.explode(F.sequence(F.lit(0), F.col("outer_blocks") - 1)).alias("outer"))
    left = large.where("outside").select("cluster", "id", F.lit(True).alias("left"), "shingles",
                                         outer_own.alias("outer"),
                                         F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    more = stored(_compare(left.unionByName(right), ["cluster", "outer", "block"], percent), "neardup-links")
    return part if more.isEmpty() else components(part.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(more))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents whose id is their component's smallest, and those without an id."""
    found = near_duplicates(docs, doc_id, text, **options)
    drop = found.where("id <> component").select("id").distinct()
    return docs.join(drop, docs[doc_id] == drop["id"], "left_anti")
