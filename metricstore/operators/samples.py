"""Bounded samples of a group's distinct values, with their exact number.

A set of all distinct values (``collect_set``) grows with its group.  Here a group
keeps the ``k`` values whose hashes are smallest: the same values on every run,
spread over the domain, and mergeable, so each task sends at most ``k`` values a
group (Spark plans a group limit before the shuffle).  Values are made distinct
first, by key and value, so a hot group is spread over its values and a hot
value is one row per task; the exact number of distinct values comes from the
same distinct rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_hash(value: Column) -> Column:
    """MD5 of the value as text, in hexadecimal: any SQL engine can rank by it."""
    return F.md5(value.cast("string").cast("binary"))


def distinct_samples(
    df: DataFrame,
    keys: Sequence[Column | str],
    value: Column | str,
    k: int = 100,
    *,
    samples: str = "samples",
    distinct: str = "distinct_count",
    count: str | None = "sample_size",
) -> DataFrame:
    """One row per key: up to ``k`` distinct values in hash order, their exact number, and the number of rows.

    Null values count as rows alone; a key without any other value has an
    empty sample.  Values that share a hash are in the order of the values.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    key_cols = [F.col(c) if isinstance(c, str) else c for c in keys]
    val = F.col(value) if isinstance(value, str) else value
    names = df.select(*key_cols).columns
    taken = {samples, distinct, count} & set(names)
    if taken:
        raise ValueError(f"{sorted(taken)} name both a key and a result")
    rows = df.select(F.struct(*key_cols).alias("_k"), val.alias("_v"))
    values = rows.groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_n"))
    totals = values.groupBy("_k").agg(F.sum("_n").alias("_rows"), F.count("_v").alias("_distinct"))
    place = Window.partitionBy("_k").orderBy("_h", "_v")
    smallest = (values.where("_v is not null").select("_k", "_v", value_hash(F.col("_v")).alias("_h"))
                .withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= k))
    # at most k rows a key
    kept = smallest.groupBy(F.col("_k").alias("_of")).agg(
        F.array_sort(F.collect_list(F.struct("_place", "_v")))["_v"].alias("_samples"))
    out = totals.join(kept, F.col("_k").eqNullSafe(F.col("_of")), "left")
    empty = F.array().cast(kept.schema["_samples"].dataType)
    result = [F.col(f"_k.`{n}`").alias(n) for n in names]
    result += [F.coalesce("_samples", empty).alias(samples), F.col("_distinct").alias(distinct)]
    if count:
        result.append(F.col("_rows").alias(count))
    return out.select(*result)
