"""The metric record ("envelope"): one native projection of a stage result.

A stage result is any DataFrame with a ``val`` and a ``measure_time`` column.
Every other column is classified *once, at plan time, from the schema*:

1. ``val`` and ``measure_time`` are managed columns;
2. functional variables are the declared names (in declaration order) followed
   by every other column whose name starts with ``func_var_``; a declared name
   missing from the result is skipped; the map key drops the prefix;
3. all remaining columns form the group map, keyed by column name, in input
   column order.

The record is then a single ``select`` of built-in expressions, so it stays
inside one codegen'd ``Project`` directly above the stage plan: filters and
column pruning on the record still reach the source scan, and no row ever
leaves the JVM.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricstore.functions.timebins import epoch_of
from metricstore.functions.values import (
    PAYLOAD_FIELDS,
    VALUE_MAP_TYPE,
    VALUE_TYPE,
    payload_as_text,
    value_struct,
)

# --- fixed values: the stored record (names, order and types) -------------
ENVELOPE = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("measure_time", T.LongType(), True),
        T.StructField("compute_time", T.LongType(), True),
        T.StructField("compute_date", T.StringType(), True),
        T.StructField("compute_hour", T.LongType(), True),
        T.StructField("time_window", T.LongType(), True),
        T.StructField("val", T.DoubleType(), True),
        T.StructField("group_map", VALUE_MAP_TYPE, True),
        T.StructField("group_keys", T.ArrayType(T.StringType(), True), True),
        T.StructField("func_expr", T.StringType(), True),
        T.StructField("func_vars", VALUE_MAP_TYPE, True),
        T.StructField("horizontal_level", T.LongType(), True),
        T.StructField("vertical_level", T.LongType(), True),
        T.StructField("version", T.StringType(), True),
    ]
)
ENVELOPE_COLUMNS = tuple(f.name for f in ENVELOPE.fields)
PARTITION_COLUMNS = ("id", "compute_date", "compute_hour", "horizontal_level", "vertical_level")
FUNC_VAR_PREFIX = "func_var_"
MANAGED_COLUMNS = ("val", "measure_time")
#: Column metadata of a level column: the attributes of each level, by position, as JSON.
LEVEL_SETS = "metricstore.level_sets"
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Plan-time classification of a stage result's columns."""

    func_vars: tuple[tuple[str, str], ...]  # (map key, source column)
    groups: tuple[str, ...]
    level_columns: tuple[str, ...] = ()


def classify(
    columns: Sequence[str],
    func_vars: Iterable[str] = (),
    level_columns: Iterable[str] = (),
) -> Layout:
    """Split ``columns`` into functional variables and group attributes."""
    columns = list(columns)
    seen: dict[str, str] = {}
    for name in columns:
        folded = name.lower()
        if folded in seen:
            raise ValueError(
                f"stage result has duplicate or case-variant columns {seen[folded]!r} and {name!r}"
            )
        seen[folded] = name
    missing = [m for m in MANAGED_COLUMNS if m not in columns]
    if missing:
        raise ValueError(f"stage result lacks required column(s) {missing}; has {columns}")
    level_columns = tuple(level_columns)
    for name in level_columns:
        if name not in columns:
            raise ValueError(f"level column {name!r} is not in the stage result {columns}")

    declared = list(func_vars)
    candidates = declared + [
        c for c in columns if c.startswith(FUNC_VAR_PREFIX) and c not in declared
    ]
    present = set(columns)
    by_key: dict[str, str] = {}
    for name in candidates:
        if name not in present:
            continue  # declared but not produced by this stage: skipped
        key = name[len(FUNC_VAR_PREFIX):] if name.startswith(FUNC_VAR_PREFIX) else name
        by_key[key] = name  # a later column for the same key wins, first position kept
    excluded = set(MANAGED_COLUMNS) | set(candidates) | set(level_columns)
    groups = tuple(c for c in columns if c not in excluded)
    return Layout(tuple(by_key.items()), groups, level_columns)


def column(name: str) -> Column:
    """Reference a column by its exact name (dots, spaces and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _converted(x: Column, dtype: T.DataType, what: str, result: Column | None = None) -> Column:
    """``x`` cast to ``dtype`` (or ``result``); a value that does not convert fails the job, ANSI mode or not."""
    out = x.try_cast(dtype)
    bad = F.concat(F.lit(f"{what} does not convert: "), x.cast("string"))
    return F.when(x.isNotNull() & out.isNull(), F.raise_error(bad).cast(dtype)).otherwise(out if result is None else result)


def epoch_seconds(x: Column, dtype: T.DataType) -> Column:
    """Epoch seconds (long, floored) of a time given as timestamp or as epoch number."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return epoch_of(x)
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return x.cast(T.LongType())
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        return _converted(x, T.LongType(), "measure_time", F.floor(x).cast(T.LongType()))
    raise TypeError(
        f"measure_time must be a timestamp or epoch seconds, not {dtype.simpleString()}"
    )


def _val_expr(x: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.NumericType, T.BooleanType, T.NullType)):
        return x.cast(T.DoubleType())
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return _converted(x, T.DoubleType(), "val")
    raise TypeError(f"val must be numeric, not {dtype.simpleString()}")


def _not_null(x: Column, what: str) -> Column:
    return F.when(x.isNull(), F.raise_error(F.lit(f"null {what} in a metric record"))).otherwise(x)


def _value_map(entries: Sequence[tuple[str, Column]]) -> Column:
    if not entries:
        return F.create_map().cast(VALUE_MAP_TYPE)
    args: list[Column] = []
    for key, value in entries:
        args += [F.lit(key), value]
    return F.create_map(*args)


def _only_keys(entries: Column, keys: Column) -> Column:
    return F.map_filter(entries, lambda k, v: F.array_contains(keys, k))


def _level_expr(level: int | str, pick=column) -> Column:
    if isinstance(level, bool):
        raise TypeError("a level is an integer or a column name")
    if isinstance(level, int):
        return F.lit(level).cast(T.LongType())
    return pick(level).cast(T.LongType())


@dataclass(frozen=True)
class ComputeStamp:
    """One compute time per run: epoch seconds plus its date and hour."""

    epoch: int
    date: str
    hour: int

    @classmethod
    def of(cls, when: datetime | int | float | None, time_zone: str = "UTC") -> "ComputeStamp":
        zone = ZoneInfo(time_zone)
        if when is None:
            when = datetime.now(timezone.utc)
        if isinstance(when, (int, float)):
            moment = datetime.fromtimestamp(int(when), timezone.utc)
        elif when.tzinfo is None:
            moment = when.replace(tzinfo=zone)
        else:
            moment = when
        epoch = int(moment.timestamp())
        local = datetime.fromtimestamp(epoch, zone)
        return cls(epoch, local.strftime("%Y-%m-%d"), local.hour)

    @classmethod
    def for_session(cls, spark, when=None) -> "ComputeStamp":
        if isinstance(when, ComputeStamp):
            return when
        return cls.of(when, spark.conf.get("spark.sql.session.timeZone", "UTC"))


def envelope_columns(
    schema: T.StructType,
    *,
    metric_id: str,
    time_window: int | None,
    func_expr: str | None,
    version: str | None,
    func_vars: Iterable[str] = (),
    horizontal_level: int | str = 0,
    vertical_level: int | str = 0,
    stamp: ComputeStamp | None,
    strict: bool = False,
    json_columns: Iterable[str] = (),
    within: str | None = None,
) -> list[Column]:
    """The 14 record columns, in schema order, for a stage result schema.

    ``within``: the stage result's columns are the fields of this struct column.

    ``stamp=None`` takes the compute time from ``current_timestamp()``; on a
    streaming DataFrame that is the micro-batch time, fixed in the offset log,
    so a retried batch gets the same stamp.
    """
    pick = column if within is None else column(within).getField
    level_cols = [lv for lv in (horizontal_level, vertical_level) if isinstance(lv, str)]
    layout = classify(schema.names, func_vars, level_cols)
    types = {f.name: f.dataType for f in schema.fields}
    as_json = set(json_columns)
    unknown = as_json - set(schema.names)
    if unknown:
        raise ValueError(f"json_columns not in the stage result: {sorted(unknown)}")

    def encoded(name: str) -> Column:
        return value_struct(pick(name), types[name], as_json=name in as_json)

    measure = epoch_seconds(pick("measure_time"), types["measure_time"])
    val = _val_expr(pick("val"), types["val"])
    if strict:
        measure, val = _not_null(measure, "measure_time"), _not_null(val, "val")
    names = T.ArrayType(T.StringType())
    group_keys = F.array(*[F.lit(g) for g in layout.groups]).cast(names)
    group_map = _value_map([(g, encoded(g)) for g in layout.groups])
    for level in dict.fromkeys(level_cols):
        sets = schema[level].metadata.get(LEVEL_SETS)
        if sets is None:
            continue
        own = F.lit(None).cast(names)
        for position, chosen in enumerate(json.loads(sets)):
            keys = F.array(*[F.lit(g) for g in layout.groups if g in chosen]).cast(names)
            own = F.when(pick(level) == F.lit(position), keys).otherwise(own)
        group_keys = F.array_intersect(group_keys, F.coalesce(own, group_keys))
        group_map = _only_keys(group_map, group_keys)
    if stamp is None:
        now = F.current_timestamp()
        compute = [
            F.unix_timestamp(now).alias("compute_time"),
            F.date_format(now, "yyyy-MM-dd").alias("compute_date"),
            F.hour(now).cast(T.LongType()).alias("compute_hour"),
        ]
    else:
        compute = [
            F.lit(stamp.epoch).cast(T.LongType()).alias("compute_time"),
            F.lit(stamp.date).alias("compute_date"),
            F.lit(stamp.hour).cast(T.LongType()).alias("compute_hour"),
        ]
    return [
        F.lit(metric_id).cast(T.StringType()).alias("id"),
        measure.alias("measure_time"),
        *compute,
        F.lit(time_window).cast(T.LongType()).alias("time_window"),
        val.alias("val"),
        group_map.alias("group_map"),
        group_keys.alias("group_keys"),
        F.lit(func_expr).cast(T.StringType()).alias("func_expr"),
        _value_map([(k, encoded(c)) for k, c in layout.func_vars]).alias("func_vars"),
        _level_expr(horizontal_level, pick).alias("horizontal_level"),
        _level_expr(vertical_level, pick).alias("vertical_level"),
        F.lit(version).cast(T.StringType()).alias("version"),
    ]


def to_envelope(
    df: DataFrame,
    metric,
    *,
    horizontal_level: int | str = 0,
    vertical_level: int | str = 0,
    compute_time: datetime | int | ComputeStamp | None = None,
    strict: bool = False,
    json_columns: Iterable[str] = (),
) -> DataFrame:
    """Map every row of a stage result to one metric record.

    ``metric`` is a :class:`metricstore.plans.spec.MetricSpec` (or anything
    with ``metric_id, time_window, func_expr, version, func_vars``).  Levels
    are integers, or the name of a column of ``df`` that supplies the level
    per row (used by :func:`metricstore.operators.levels.at_levels`).
    A ``val`` or ``measure_time`` that does not convert fails the job;
    ``strict=True`` also refuses nulls, which are kept otherwise.

    A level column that carries grouping sets (``at_levels`` adds them) limits
    ``group_keys`` and ``group_map`` of each row to its own level's attributes.
    """
    if df.isStreaming and compute_time is None:
        stamp = None  # per micro-batch
    elif isinstance(compute_time, ComputeStamp):
        stamp = compute_time
    else:
        stamp = ComputeStamp.for_session(df.sparkSession, compute_time)
    cols = envelope_columns(
        df.schema,
        metric_id=metric.metric_id,
        time_window=metric.time_window,
        func_expr=metric.func_expr,
        version=None if metric.version is None else str(metric.version),
        func_vars=metric.func_vars,
        horizontal_level=horizontal_level,
        vertical_level=vertical_level,
        stamp=stamp,
        strict=strict,
        json_columns=json_columns,
    )
    return df.select(*cols)


def check_envelope(df: DataFrame) -> None:
    """Raise if ``df`` does not have the record's names, order and types."""
    # nullability may be tighter than the declared schema (literals, maps)
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in ENVELOPE.fields]
    if got != want:
        raise ValueError(f"not a metric record schema:\n got  {got}\n want {want}")


# --- long format ------------------------------------------------------------

LONG_COLUMNS = (
    "id",
    "measure_time",
    "compute_time",
    "time_window",
    "val",
    "horizontal_level",
    "vertical_level",
    "version",
    "kind",
    "key",
    "type",
) + PAYLOAD_FIELDS + ("text",)


def to_long(records: DataFrame) -> DataFrame:
    """Explode records into one row per group attribute / functional variable.

    Columns: the record's scalars, ``kind`` (``group`` or ``func``), ``key``,
    ``type``, the 12 payload columns and ``text`` (whichever payload is set,
    as text: atomic values cast, collections as JSON).  A single ``explode_outer`` over the
    concatenated entries: one pass, no union; a record without any entry is
    kept as one row with null ``kind``.
    """
    entry = T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("key", T.StringType()),
            T.StructField("value", VALUE_TYPE),
        ]
    )

    def tagged_entries(map_col: str, kind: str) -> Column:
        return F.transform(
            F.map_entries(F.col(map_col)),
            lambda e: F.struct(
                F.lit(kind).alias("kind"), e["key"].alias("key"), e["value"].alias("value")
            ).cast(entry),
        )

    entries = F.concat(tagged_entries("group_map", "group"), tagged_entries("func_vars", "func"))
    scalars = [c for c in LONG_COLUMNS[:8]]
    exploded = records.select(*scalars, F.explode_outer(entries).alias("_e"))
    return exploded.select(
        *scalars,
        F.col("_e.kind").alias("kind"),
        F.col("_e.key").alias("key"),
        F.col("_e.value.type").alias("type"),
        *[F.col(f"_e.value.{p}").alias(p) for p in PAYLOAD_FIELDS],
        payload_as_text(F.col("_e.value")).alias("text"),
    )
