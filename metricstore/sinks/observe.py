"""Row counts and partitions of a write, observed while it runs.

The write observes, per marked stage, the row count and the distinct partition
tuples: as many values as it makes folders.  Nothing has to be listed or read
afterwards, so a write that has succeeded can always be reported.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from metricstore.operators.envelope import PARTITION_COLUMNS

MARKER = "_stage"


@dataclass(frozen=True)
class WriteResult:
    rows: int
    #: the partitions written, in order
    partitions: tuple[dict, ...] = ()
    counts: dict = field(default_factory=dict)  # rows per marker
    places: dict = field(default_factory=dict)  # partitions per marker


def _in_order(places: list[dict]) -> tuple[dict, ...]:
    unique = {tuple(p[c] for c in PARTITION_COLUMNS): p for p in places}
    return tuple(unique[k] for k in sorted(unique, key=lambda t: tuple((v is not None, v) for v in t)))


class ObservedWrite:
    """``frame`` is the records without marker, to be written once; then ``result()``."""

    def __init__(self, records: DataFrame, markers: int = 0) -> None:
        self.markers = markers
        self.observation = Observation(f"metricstore-{uuid.uuid4().hex[:8]}")
        marker = F.col(MARKER) if markers else F.lit(0)
        measures = [F.count(F.lit(1)).alias("rows"),
                    F.collect_set(F.struct(marker.alias(MARKER), *PARTITION_COLUMNS)).alias("places")]
        measures += [F.count_if(F.col(MARKER) == F.lit(i)).alias(f"rows{i}") for i in range(markers)]
        self.frame = records.observe(self.observation, *measures).drop(MARKER)

    def result(self) -> WriteResult:
        got = self.observation.get
        places: dict[int, list[dict]] = {}
        for row in got.get("places") or []:
            place = row.asDict()
            places.setdefault(place.pop(MARKER), []).append(place)
        return WriteResult(
            int(got.get("rows") or 0), _in_order([p for ps in places.values() for p in ps]),
            {i: int(got.get(f"rows{i}") or 0) for i in range(self.markers)},
            {i: _in_order(places.get(i, [])) for i in range(self.markers)})
