"""Connected components of an edge table, by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricstore.llm.store import stored

#: A key with more rows than this is dealt out in parts of about this many.
HOT = 1000
#: Up to this many hot keys are broadcast (16 bytes each); there are at most rows / HOT of them.
MOST_HOT = 1_000_000


def _hot(rows: DataFrame, key: str) -> DataFrame | None:
    """(hot, parts) of the keys of more than HOT rows, or None."""
    found = stored(rows.groupBy(F.col(key).alias("hot")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT)
                   .select("hot", F.ceil(F.col("n") / HOT).cast("int").alias("parts")), "component-hot")
    n = found.count()
    if not n:
        return None
    return F.broadcast(found) if n <= MOST_HOT else found.hint("merge")


def _joined(many: DataFrame, one: DataFrame, key: str, by: str, hot: DataFrame | None) -> DataFrame:
    """``many`` with the row of ``one`` for its key; rows of a hot key go by ``by`` to parts that each get a copy of it."""
    if hot is None:
        return many.join(one, key)
    own = F.coalesce(F.pmod(F.xxhash64(by), F.col("parts")), F.lit(0)).cast("int")
    left = many.join(hot, F.col(key) == F.col("hot"), "left").withColumn("part", own).drop("hot", "parts")
    every = F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)
    right = one.join(hot, F.col(key) == F.col("hot"), "left").withColumn("part", F.explode(every)).drop("hot", "parts")
    return left.join(right, [key, "part"]).drop("part")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (a, b); component: the smallest reachable id.

    Each round takes the smallest label among a node's neighbours, then the
    label of its label, so a path of length d needs about log(d) rounds.  Once
    no neighbour has a smaller label, labels are equal along every edge, and a
    component's smallest id has kept its own: that is the end.  A round's labels
    are written before the next, and only counts reach the driver.  A node of
    many edges, and a label of many nodes, are split over several tasks.  An
    empty edge table gives no rows.
    """
    both = edges.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionAll(
        edges.select(F.col("b").alias("src"), F.col("a").alias("dst")))
    both = stored(both.where("src <> dst").distinct(), "component-edges")
    hubs = _hot(both, "dst")
    labels = stored(both.groupBy("src").agg(F.min("dst").alias("low"))
                    .select(F.col("src").alias("id"), F.least("src", "low").alias("label")), "component-labels")
    while True:
        near = (_joined(both, labels.select(F.col("id").alias("dst"), "label"), "dst", "src", hubs)
                .groupBy("src").agg(F.min("label").alias("low")))
        step = stored(labels.join(near, F.col("id") == F.col("src")).select(
            "id", F.col("label").alias("old"), F.least("label", "low").alias("label")), "component-step")
        if step.where("label < old").isEmpty():
            return labels.select("id", F.col("label").alias("component"))
        up = step.select(F.col("id").alias("label"), F.col("label").alias("top"))
        labels = stored(_joined(step, up, "label", "id", _hot(step, "label")).select("id", F.col("top").alias("label")),
                        "component-labels")
