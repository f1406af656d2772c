"""Exact percentiles of groups that may be very large.

``approx_percentile`` merges one summary per map task for every key in one
reducer, and a sketch's result may change between runs.  Here equal values are
counted first (a partial aggregate, so a hot value is one row per task), and
the value at the wanted rank is found by narrowing.  A value is taken as the
64-bit integer that orders like it; a round counts the values still in question
by the next ``bits`` bits in which they differ, and only the range that holds the
rank goes on.  So 64 bits need at most 7 rounds, whatever the magnitudes, and a
round reads what the one before left.  Where every group has at most
``2 ** bits`` distinct values left, a window over them ends it at once.  The result
is ``quantile_disc`` (the smallest value whose rank reaches the percentage), the
same on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricstore.plans.scratch import scratch_path


def _order(value: Column) -> Column:
    """A long that orders as the double does; NaN is the largest, -0.0 equals 0.0."""
    one_zero = F.when(value == F.lit(0.0), F.lit(0.0)).otherwise(value)
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), one_zero).cast("long")
    return F.when(bits < 0, bits.bitwiseXOR(F.lit(0x7FFFFFFFFFFFFFFF))).otherwise(bits)


def _length(differing: Column) -> Column:
    """Number of bits up to the highest one set."""
    return F.when(differing < 0, 64).otherwise(F.length(F.bin(differing)))


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "quantiles")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[Column | str],
    value: Column | str,
    percentages: dict[str, float],
    *,
    bits: int = 10,
    count_alias: str | None = "sample_size",
) -> DataFrame:
    """One row per key with a column per requested percentage (and a count of rows).

    ``keys`` may be expressions; name them with ``alias``.  Null values count
    as rows but have no rank; a key without any other value has null
    percentiles.  NaN is the largest value.  ``bits``: by which a round tells
    values apart; it moves at most ``2 ** bits`` counts per key and percentage.
    """
    if not 1 <= bits <= 20:
        raise ValueError("bits must be between 1 and 20")
    for name, p in percentages.items():
        if not 0.0 <= p <= 1.0:
            raise ValueError(f"percentage {name}={p} outside [0, 1]")
    key_cols = [F.col(c) if isinstance(c, str) else c for c in keys]
    val = (F.col(value) if isinstance(value, str) else value).cast("double")
    names = df.select(*key_cols).columns
    whole = df.select(F.struct(*key_cols).alias("_k"), val.alias("_v"))
    counts = _stored(whole.groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_n"))
                     .withColumn("_b", F.when(F.col("_v").isNotNull(), _order(F.col("_v")))))
    groups = counts.groupBy("_k").agg(
        F.sum("_n").alias("_rows"), F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))).alias("_all"),
        F.min("_b").alias("_lo"), F.max("_b").alias("_hi"))
    wanted = F.explode(F.array(*[F.struct(F.lit(n).alias("_p"), F.lit(float(p)).alias("_q")) for n, p in percentages.items()]))
    state = _stored(groups.where("_all is not null").select("_k", "_lo", "_hi", "_all", wanted.alias("_w")).select(
        "_k", "_w._p", "_lo", "_hi", F.lit(0).cast("long").alias("_before"),
        F.greatest(F.lit(1), F.ceil(F.col("_w._q") * F.col("_all"))).cast("long").alias("_rank")))
    of = Window.partitionBy("_k", "_p")
    inside = counts.where("_v is not null").join(state.withColumnRenamed("_k", "_g"), F.col("_k").eqNullSafe(F.col("_g"))).drop("_g")
    done = None
    while done is None:
        most = inside.groupBy("_k", "_p").agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()[0] or 0
        if most <= 1 << bits:
            upto = F.col("_before") + F.sum("_n").over(of.orderBy("_b"))
            done = (inside.withColumn("_end", upto).where("_end >= _rank and _end - _n < _rank").select("_k", "_p", "_v"))
            break
        # The highest bits in which a group's values differ.
        shift = F.greatest(F.lit(0), _length(F.col("_lo").bitwiseXOR(F.col("_hi"))) - bits)
        binned = inside.withColumn("_bin", F.call_function("shiftright", F.col("_b"), shift))
        ranges = binned.groupBy("_k", "_p", "_before", "_rank", "_bin").agg(
            F.sum("_n").alias("_n"), F.min("_b").alias("_lo"), F.max("_b").alias("_hi"))
        ranges = ranges.withColumn("_end", F.col("_before") + F.sum("_n").over(of.orderBy("_bin")))
        state = _stored(ranges.where("_end >= _rank and _end - _n < _rank").select(
            F.col("_k").alias("_g"), F.col("_p").alias("_h"), "_lo", "_hi", (F.col("_end") - F.col("_n")).alias("_before"), "_rank"))
        left = inside.select("_k", "_p", "_v", "_b", "_n").join(
            state, F.col("_k").eqNullSafe(F.col("_g")) & (F.col("_p") == F.col("_h")) & F.col("_b").between(F.col("_lo"), F.col("_hi")))
        inside = _stored(left.drop("_g", "_h"))
    found = done.groupBy("_k").agg(*[F.max(F.when(F.col("_p") == F.lit(n), F.col("_v"))).alias(n) for n in percentages])
    result = groups.select(F.col("_k").alias("_g"), "_rows").join(found, F.col("_g").eqNullSafe(F.col("_k")), "left")
    out = [F.col(f"_g.`{n}`").alias(n) for n in names] + [F.col(n) for n in percentages]
    if count_alias:
        out.append(F.col("_rows").alias(count_alias))
    return result.select(*out)
