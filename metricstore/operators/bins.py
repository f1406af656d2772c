"""Value bins whose edges come from the data: as many rows in each as ties allow.

A group's edges are its exact percentiles at 1/n, 2/n, ... (``exact_quantiles``, so
no group is seen by one task), one row per group; rows get their bin by a join
with that row, whose side is unique, so a hot group can be split.  Ties stay
together: a value equal to an edge belongs to the bin that ends there, and a bin
that an earlier edge has swallowed stays empty.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricstore.operators.quantiles import exact_quantiles


def bin_edges(df: DataFrame, keys: Sequence[Column | str], value: Column | str, n: int, *, edges: str = "edges") -> DataFrame:
    """One row per group: its keys and the ``n - 1`` inner edges, ascending; null for a group without values."""
    if n < 1:
        raise ValueError("n must be at least 1")
    names = {f"_edge{i:06d}": i / n for i in range(1, n)} or {"_edge000000": 0.0}
    found = exact_quantiles(df, keys, value, names, count_alias=None)
    inner = F.array(*[F.col(c) for c in names]) if n > 1 else F.array().cast("array<double>")
    return found.withColumn(edges, F.when(F.col(next(iter(names))).isNotNull(), inner)).drop(*names)


def equal_frequency_bins(df: DataFrame, keys: Sequence[str], value: str, n: int, *, name: str = "bin", edges: str = "edges") -> DataFrame:
    """``df`` with the number of each row's bin (from 1) among its group's, and the group's edges.

    ``keys`` are columns; null keys are a group.  A null value has a null bin; NaN
    is the largest value.
    """
    taken = {name, edges} & set(df.columns)
    if taken:
        raise ValueError(f"{sorted(taken)} are columns already")
    found = bin_edges(df, keys, value, n, edges=edges)
    found = found.select(*[F.col(f"`{k}`").alias(f"_of_{i}") for i, k in enumerate(keys)], edges)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_of_{i}"))
    v = F.col(f"`{value}`").cast("double")
    place = F.when(v.isNotNull(), 1 + F.size(F.filter(F.col(edges), lambda e: e < v))).cast("long")
    return df.join(found, same).select(*[F.col(f"`{c}`") for c in df.columns], place.alias(name), edges)
