"""Keep the newest run of each stored measurement.

Re-running a metric appends; ``compute_hour`` is a partition column, so a
re-run in another hour lands in another directory.  A measurement is
identified by metric, version, levels, measurement time and group values; the
newest ``compute_time`` wins, with ALL records of that run: a measurement may
have several, told apart by functional variables (value bins, say) or, for
row-level metrics, by nothing but being rows.

The group's values, which may hold maps, enter the identity as two independent
64-bit hashes beside the group's keys and the plain columns.  The newest time per
identity is a hash aggregate of numbers and short texts; records then join it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricstore.functions.values import PAYLOAD_FIELDS
from metricstore.operators.envelope import ENVELOPE_COLUMNS

MEASUREMENT_KEY = ("id", "version", "horizontal_level", "vertical_level", "measure_time")


def _hashable(value: Column) -> Column:
    """A tagged value without maps, which have no order."""
    fields = [value["type"].alias("type")]
    for name in PAYLOAD_FIELDS:
        payload = value[name]
        fields.append((F.array_sort(F.map_entries(payload)) if name.startswith("map_") else payload).alias(name))
    return F.struct(*fields)


def latest_records(records: DataFrame) -> DataFrame:
    # maps have no order: the group's values follow the key list
    group = F.struct("group_keys", F.transform("group_keys", lambda k: _hashable(F.col("group_map")[k])))
    hashes = [F.xxhash64(group).alias("_h1"), F.xxhash64(F.lit(1), group).alias("_h2")]
    keyed = records.select(*ENVELOPE_COLUMNS, *hashes)
    key = [*MEASUREMENT_KEY, "_h1", "_h2"]
    newest = keyed.groupBy(*[F.col(k).alias(f"_of_{k}") for k in key]).agg(F.max("compute_time").alias("_newest"))
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    # rows without a compute time count as older than any with one
    return (
        keyed.join(newest, same)
        .where(F.col("compute_time").eqNullSafe(F.col("_newest")))
        .select(*ENVELOPE_COLUMNS)
    )
