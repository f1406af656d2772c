"""Percentiles and distinct counts at several levels, from mergeable summaries.

Percentiles and distinct counts of a level cannot be computed from those of the
finer level, but their summaries can be merged.  The finest groups are summarised
once (a KLL sketch of the values, a HyperLogLog sketch of the distinct ones,
both partial aggregates), and only the summaries are expanded to the levels and
merged upwards: the rows are read and shuffled once however many levels there
are.  A hot group is merged map-side, one summary per task.

The summaries can be stored (``summaries``) and merged later, over time as well:
``merge_summaries`` takes any finer groups.

Bounds (of the sketches' authors, at 99 % confidence): the rank of a percentile
from a KLL sketch of size k is off by at most ``rank_bound(k)`` of the rows; a
distinct count by ``distinct_bound(lg_k)`` of itself.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricstore.operators.envelope import LEVEL_SETS, column
from metricstore.operators.levels import MERGES, _columns, level_of_grouping


@dataclass(frozen=True)
class Percentile:
    """``percentage`` of the non-null values of ``column``: the value whose rank reaches it."""

    column: str
    percentage: float

    def __post_init__(self):
        if not 0.0 <= self.percentage <= 1.0:
            raise ValueError(f"percentage {self.percentage} outside [0, 1]")


@dataclass(frozen=True)
class Distinct:
    """Number of distinct non-null values of ``column`` (of any atomic type, by its text)."""

    column: str


@dataclass(frozen=True)
class Plain:
    """A sum, count, min or max of ``column``, exact."""

    kind: str
    column: str

    def __post_init__(self):
        if self.kind not in MERGES:
            raise ValueError(f"{self.kind} is none of {sorted(MERGES)}")


Measure = Percentile | Distinct | Plain


def rank_bound(k: int) -> float:
    """Share of the rows by which a percentile's rank is off at most (99 %)."""
    return 2.296 / k ** 0.9723


def distinct_bound(lg_k: int) -> float:
    """Share by which a merged distinct count is off at most (99 %: 2.576 standard errors)."""
    return 2.576 * 1.04 / (1 << lg_k) ** 0.5


def _sources(measures: dict[str, Measure]) -> dict[Measure | str, str]:
    """Columns of a summary: percentiles of one column share a sketch."""
    out: dict[Measure | str, str] = {}
    for m in measures.values():
        key = f"kll {m.column}" if isinstance(m, Percentile) else m
        out.setdefault(key, f"_summary{len(out)}")
    return out


def summaries(df: DataFrame, keys: Sequence[str], measures: dict[str, Measure], *, k: int = 200, lg_k: int = 12) -> DataFrame:
    """One row per key with the measures' summaries (binary columns, and plain numbers), to be stored or merged."""
    aggs = []
    for source, name in _sources(measures).items():
        if isinstance(source, Distinct):
            aggs.append(F.hll_sketch_agg(column(source.column).cast("string"), lg_k).alias(name))
        elif isinstance(source, Plain):
            aggs.append(getattr(F, source.kind)(column(source.column)).alias(name))
        else:
            value = column(source[len("kll "):]).cast("double")
            aggs.append(F.kll_sketch_agg_double(value, F.lit(k)).alias(name))
    return df.groupBy(*[column(c) for c in keys]).agg(*aggs)


def _merged(measures: dict[str, Measure]) -> list[Column]:
    out = []
    for source, name in _sources(measures).items():
        if isinstance(source, Distinct):
            out.append(F.hll_union_agg(name).alias(name))
        elif isinstance(source, Plain):
            out.append(MERGES[source.kind](name).alias(name))
        else:
            out.append(F.kll_merge_agg_double(name).alias(name))
    return out


def merge_summaries(finer: DataFrame, keys: Sequence[str], measures: dict[str, Measure]) -> DataFrame:
    """Summaries of coarser groups from those of finer ones."""
    return finer.groupBy(*[column(c) for c in keys]).agg(*_merged(measures))


def estimates(merged: DataFrame, measures: dict[str, Measure]) -> DataFrame:
    """The measures by name, in place of their summaries; a group without any value has a null percentile."""
    sources = _sources(measures)
    out = [column(c) for c in merged.columns if c not in set(sources.values())]
    for name, m in measures.items():
        summary = F.col(sources[f"kll {m.column}" if isinstance(m, Percentile) else m])
        if isinstance(m, Percentile):
            some = F.kll_sketch_get_n_double(summary) > 0
            out.append(F.when(some, F.kll_sketch_get_quantile_double(summary, F.lit(float(m.percentage)))).alias(name))
        elif isinstance(m, Distinct):
            out.append(F.hll_sketch_estimate(summary).alias(name))
        else:
            out.append(summary.alias(name))
    return merged.select(*out)


def sketch_levels(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    measures: dict[str, Measure],
    *,
    k: int = 200,
    lg_k: int = 12,
    level_column: str = "horizontal_level",
) -> DataFrame:
    """As :func:`metricstore.operators.levels.roll_up_levels`, with percentiles and distinct counts too."""
    columns = _columns(sets)
    finest = summaries(df, columns, measures, k=k, lg_k=lg_k)
    level = level_of_grouping(sets, columns).alias(level_column, metadata={LEVEL_SETS: json.dumps([list(s) for s in sets])})
    grouped = finest.groupingSets([[column(c) for c in s] for s in sets], *[column(c) for c in columns])
    return estimates(grouped.agg(*_merged(measures), level), measures)
