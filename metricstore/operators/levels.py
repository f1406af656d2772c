"""One metric at several levels of an aggregation hierarchy.

The same measure aggregated by different sets of attributes (e.g. total per
hour, per hour and location, per hour, location and bin) is one metric at
different horizontal levels.  All levels come out of a single
``GROUPING SETS`` aggregation - one scan, one shuffle, partial aggregation on
the map side - and the level of each row is derived from ``grouping_id``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricstore.operators.envelope import LEVEL_SETS, column


def level_of_grouping(sets: Sequence[Sequence[str]], columns: Sequence[str]) -> Column:
    """CASE over ``grouping_id()`` giving each grouping set's position."""
    n = len(columns)
    expr = None
    for level, chosen in enumerate(sets):
        gid = sum(1 << (n - 1 - j) for j, c in enumerate(columns) if c not in chosen)
        cond = F.grouping_id() == F.lit(gid)
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return expr.cast("long")


def _columns(sets: Sequence[Sequence[str]]) -> list[str]:
    if not sets:
        raise ValueError("levels need at least one grouping set")
    if len({tuple(sorted(s)) for s in sets}) != len(sets):
        raise ValueError("grouping sets must be distinct")
    return list(dict.fromkeys(c for s in sets for c in s))


def at_levels(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    aggregates: Sequence[Column],
    level_column: str = "horizontal_level",
) -> DataFrame:
    """Aggregate ``df`` once per grouping set; level = index in ``sets``.

    Columns absent from a set are null in its rows.  Pass the result to
    :func:`metricstore.operators.envelope.to_envelope` with
    ``horizontal_level=level_column``; the level column carries the sets as
    metadata, so each record names just its own level's attributes.
    """
    columns = _columns(sets)
    grouped = df.groupingSets([[column(c) for c in s] for s in sets], *[column(c) for c in columns])
    level = level_of_grouping(sets, columns).alias(level_column, metadata={LEVEL_SETS: json.dumps([list(s) for s in sets])})
    return grouped.agg(*aggregates, level)


#: Aggregates that can be built from the results of finer groups, and what adds those up.
MERGES = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def roll_up_levels(
    df: DataFrame,
    sets: Sequence[Sequence[str]],
    measures: dict[str, tuple[str, str]],
    level_column: str = "horizontal_level",
) -> DataFrame:
    """As :func:`at_levels` for sums, counts, minima and maxima: ``measures`` maps names to (aggregate, column).

    The finest groups are aggregated first, and only their results are
    expanded to the levels: one more shuffle, of the reduced rows.
    """
    unknown = sorted({kind for kind, _ in measures.values()} - set(MERGES))
    if unknown:
        raise ValueError(f"{unknown} cannot be rolled up; use at_levels")
    columns = _columns(sets)
    finest = df.groupBy(*[column(c) for c in columns]).agg(
        *[getattr(F, kind)(column(c)).alias(name) for name, (kind, c) in measures.items()])
    return at_levels(finest, sets, [MERGES[kind](column(name)).alias(name) for name, (kind, _) in measures.items()],
                     level_column)
