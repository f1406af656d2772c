"""Metric and stage definitions.

A metric definition is plain data: the metric's identity (id, time window,
defining expression, version, declared functional variables) and an ordered
list of stages.  Definitions arrive as dicts (e.g. parsed YAML) and are
validated here, on the driver, before any Spark work starts.  A whole table
of definitions can also be checked as a DataFrame job, see
:func:`check_definitions`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace
from enum import Enum
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class StageKind(str, Enum):
    SQL = "sql"  # Spark SQL over the catalog and earlier views
    REMOTE = "remote"  # a query run by another engine (JDBC, connector format)
    PYTHON = "python"  # a Python callable / module producing a DataFrame or views


class OutputKind(str, Enum):
    VIEW = "view"
    STORE = "store"
    CACHED_VIEW = "cached_view"


# --- fixed values: stage type names accepted in definitions ----------------
STAGE_KIND_ALIASES = {
    "sql": StageKind.SQL,
    "spark_sql": StageKind.SQL,
    "remote": StageKind.REMOTE,
    "presto_sql": StageKind.REMOTE,
    "big_query": StageKind.REMOTE,
    "jdbc": StageKind.REMOTE,
    "python": StageKind.PYTHON,
}
# the remote engine implied by the legacy stage type names
REMOTE_FORMAT_BY_ALIAS = {"presto_sql": "jdbc", "big_query": "bigquery", "jdbc": "jdbc"}
OUTPUT_KINDS = {"view": OutputKind.VIEW, "store": OutputKind.STORE, "cached_view": OutputKind.CACHED_VIEW}
# ---------------------------------------------------------------------------

_STAGE_KEYS = {
    "stage_type",
    "output_type",
    "sql_query",
    "sql",
    "py_mod",
    "py_stage_args",
    "view_name",
    "cached_view_name",
    "horizontal_level",
    "vertical_level",
    "stage_id",
    "source",
    "params",
    "json_columns",
    "region",
    "workspace_dataset",
}
_METRIC_KEYS = {
    "id",
    "metric_id",
    "description",
    "func_expr",
    "time_window",
    "version",
    "func_vars",
    "stages",
}


@dataclass(frozen=True)
class SourceSpec:
    """Where a remote stage runs: a DataFrameReader format plus options.

    ``format`` is e.g. ``jdbc`` (with ``url``, ``driver``, ``user``,
    ``password``) or a connector name such as ``bigquery``; the stage SQL is
    passed as the reader's ``query`` option, so the remote engine runs it.
    """

    format: str = "jdbc"
    options: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class StageSpec:
    kind: StageKind
    output: OutputKind = OutputKind.VIEW
    sql: str | None = None
    python: Callable[..., Any] | str | None = None
    python_args: Mapping[str, Any] = field(default_factory=dict)
    view_name: str | None = None
    cached_view_name: str | None = None
    horizontal_level: int | str = 0
    vertical_level: int | str = 0
    stage_id: str | None = None
    source: SourceSpec | None = None
    params: Mapping[str, Any] = field(default_factory=dict)
    json_columns: tuple[str, ...] = ()

    def validate(self) -> "StageSpec":
        where = f"stage {self.stage_id or '?'}"
        if not isinstance(self.kind, StageKind):
            raise ValueError(f"{where}: unknown stage kind {self.kind!r}")
        if not isinstance(self.output, OutputKind):
            raise ValueError(f"{where}: unknown output kind {self.output!r}")
        if self.kind is StageKind.PYTHON:
            if self.python is None:
                raise ValueError(f"{where}: a python stage needs py_mod (a module path or callable)")
        elif self.kind is StageKind.REMOTE:
            if self.source is None:
                raise ValueError(f"{where}: a remote stage needs a source (format and options)")
            reads_table = any(k in self.source.options for k in ("dbtable", "table", "path"))
            if not self.sql and not reads_table:
                raise ValueError(f"{where}: a remote stage needs sql_query or a table/path option")
        elif not self.sql:
            raise ValueError(f"{where}: a {self.kind.value} stage needs sql_query")
        if self.output is OutputKind.VIEW and self.kind is not StageKind.PYTHON and not self.view_name:
            raise ValueError(f"{where}: a view stage needs view_name")
        if self.output is OutputKind.CACHED_VIEW and not (self.cached_view_name or self.view_name):
            raise ValueError(f"{where}: a cached_view stage needs cached_view_name or view_name")
        for level in (self.horizontal_level, self.vertical_level):
            if isinstance(level, bool) or not isinstance(level, (int, str)):
                raise ValueError(f"{where}: levels are integers or column names, got {level!r}")
        return self

    @classmethod
    def from_dict(
        cls,
        d: Mapping[str, Any],
        *,
        sql_loader: Callable[[str], str] | None = None,
        sources: Mapping[str, SourceSpec] | None = None,
    ) -> "StageSpec":
        unknown = set(d) - _STAGE_KEYS
        if unknown:
            raise ValueError(f"unknown stage field(s) {sorted(unknown)}")
        type_name = d.get("stage_type")
        if type_name not in STAGE_KIND_ALIASES:
            raise ValueError(f"unknown stage_type {type_name!r}")
        output_name = d.get("output_type", "view")
        if output_name not in OUTPUT_KINDS:
            raise ValueError(f"unknown output_type {output_name!r}")
        kind = STAGE_KIND_ALIASES[type_name]
        sql = d.get("sql") or d.get("sql_query")
        if sql is not None and sql_loader is not None and d.get("sql") is None:
            sql = sql_loader(sql)
        source = d.get("source")
        if isinstance(source, str):
            if not sources or source not in sources:
                raise ValueError(f"unknown source {source!r}")
            source = sources[source]
        elif isinstance(source, Mapping):
            source = SourceSpec(source.get("format", "jdbc"), dict(source.get("options", {})))
        if kind is StageKind.REMOTE and source is None and sources:
            fmt = REMOTE_FORMAT_BY_ALIAS.get(type_name)
            source = sources.get(type_name) or (sources.get(fmt) if fmt else None)
        if source is not None:
            extra = {k: str(d[k]) for k in ("region", "workspace_dataset") if d.get(k) is not None}
            if extra:
                source = replace(source, options={**source.options, **extra})
        return cls(
            kind=kind,
            output=OUTPUT_KINDS[output_name],
            sql=sql,
            python=d.get("py_mod"),
            python_args=dict(d.get("py_stage_args") or {}),
            view_name=d.get("view_name"),
            cached_view_name=d.get("cached_view_name"),
            horizontal_level=d.get("horizontal_level", 0),
            vertical_level=d.get("vertical_level", 0),
            stage_id=d.get("stage_id"),
            source=source,
            params=dict(d.get("params") or {}),
            json_columns=tuple(d.get("json_columns") or ()),
        )


@dataclass(frozen=True)
class MetricSpec:
    metric_id: str
    time_window: int
    func_expr: str
    version: str
    func_vars: tuple[str, ...] = ()
    description: str | None = None
    stages: tuple[StageSpec, ...] = ()

    def __post_init__(self) -> None:
        # deterministic stage ids: "<metric id>/<position>"
        stages = tuple(
            s if s.stage_id else replace(s, stage_id=f"{self.metric_id}/{i}")
            for i, s in enumerate(self.stages)
        )
        object.__setattr__(self, "stages", stages)
        object.__setattr__(self, "func_vars", tuple(self.func_vars))
        object.__setattr__(self, "version", None if self.version is None else str(self.version))

    def with_stages(self, *stages: StageSpec) -> "MetricSpec":
        return replace(self, stages=tuple(self.stages) + tuple(stages))

    def validate(self) -> "MetricSpec":
        if not isinstance(self.metric_id, str) or not self.metric_id:
            raise ValueError("metric id must be a non-empty string")
        if isinstance(self.time_window, bool) or not isinstance(self.time_window, int):
            raise ValueError(f"{self.metric_id}: time_window must be an integer")
        if not isinstance(self.func_expr, str):
            raise ValueError(f"{self.metric_id}: func_expr must be a string")
        if not all(isinstance(v, str) for v in self.func_vars):
            raise ValueError(f"{self.metric_id}: func_vars must be strings")
        if not self.stages:
            raise ValueError(f"{self.metric_id}: no stages")
        ids = [s.stage_id for s in self.stages]
        if len(set(ids)) != len(ids):
            raise ValueError(f"{self.metric_id}: duplicate stage ids {ids}")
        for s in self.stages:
            s.validate()
        return self

    @classmethod
    def from_dict(
        cls,
        d: Mapping[str, Any],
        *,
        sql_loader: Callable[[str], str] | None = None,
        sources: Mapping[str, SourceSpec] | None = None,
    ) -> "MetricSpec":
        if not isinstance(d, Mapping):
            raise ValueError(f"a metric definition is a mapping, got {type(d).__name__}")
        unknown = set(d) - _METRIC_KEYS
        if unknown:
            raise ValueError(f"unknown metric field(s) {sorted(unknown)}")
        metric_id = d.get("metric_id", d.get("id"))
        for name, value in (("id", metric_id), ("time_window", d.get("time_window")),
                            ("func_expr", d.get("func_expr")), ("version", d.get("version"))):
            if value is None:
                raise ValueError(f"missing field {name} in definition {metric_id or d}")
        stages = d.get("stages")
        if not isinstance(stages, list):
            raise ValueError(f"{metric_id}: stages must be a list")
        func_vars = d.get("func_vars") or []
        if not isinstance(func_vars, list):
            raise ValueError(f"{metric_id}: func_vars must be a list")
        spec = cls(
            metric_id=metric_id,
            time_window=d["time_window"],
            func_expr=d["func_expr"],
            version=str(d["version"]),
            func_vars=tuple(func_vars),
            description=d.get("description"),
            stages=tuple(StageSpec.from_dict(s, sql_loader=sql_loader, sources=sources) for s in stages),
        )
        return spec.validate()


def load_definitions(
    data: Mapping[str, Any] | Iterable[Mapping[str, Any]] | str,
    *,
    sql_loader: Callable[[str], str] | None = None,
    sources: Mapping[str, SourceSpec] | None = None,
) -> list[MetricSpec]:
    """Definitions from one mapping, a list of mappings, or YAML text."""
    if isinstance(data, str):
        import yaml  # optional; only needed for YAML text

        data = yaml.safe_load(data)
    if isinstance(data, Mapping):
        data = [data]
    specs = [MetricSpec.from_dict(d, sql_loader=sql_loader, sources=sources) for d in data]
    ids = [s.metric_id for s in specs]
    dupes = sorted({i for i in ids if ids.count(i) > 1})
    if dupes:
        raise ValueError(f"duplicate metric ids {dupes}")
    return specs


def sql_folder_loader(folder: str) -> Callable[[str], str]:
    """A ``sql_loader`` reading ``sql_query`` names as files below ``folder``."""
    import os

    root = os.path.abspath(folder)

    def load(name: str) -> str:
        path = os.path.abspath(os.path.join(root, name))
        if not path.startswith(root + os.sep):
            raise ValueError(f"sql file {name!r} is outside {folder!r}")
        with open(path, encoding="utf-8") as handle:
            return handle.read()

    return load


# --- definitions as a table -------------------------------------------------

DEFINITIONS_DDL = (
    "metric_id string, description string, time_window bigint, func_expr string, version string, "
    "func_vars array<string>, stages array<struct<stage_id:string, stage_type:string, "
    "output_type:string, sql_query:string, py_mod:string, view_name:string, "
    "cached_view_name:string, horizontal_level:string, vertical_level:string, "
    "source:struct<format:string, options:map<string,string>>>>"
)


#: Source options that are not recorded (fixed values).
SECRET_OPTIONS = {"password", "credentials", "token", "accesstoken", "secret"}


def definitions_frame(spark, specs: Iterable[MetricSpec]) -> DataFrame:
    """Definitions as rows (one per metric), e.g. to keep beside the store.

    Python-stage callables are recorded by their qualified name, a remote
    stage's source with its options except passwords and the like.
    """

    def py_name(target) -> str | None:
        if target is None or isinstance(target, str):
            return target
        return f"{getattr(target, '__module__', '?')}.{getattr(target, '__qualname__', repr(target))}"

    rows = [
        (
            m.metric_id, m.description, m.time_window, m.func_expr, m.version, list(m.func_vars),
            [
                (s.stage_id, s.kind.value, s.output.value, s.sql, py_name(s.python), s.view_name,
                 s.cached_view_name, str(s.horizontal_level), str(s.vertical_level),
                 s.source and (s.source.format, {k: str(v) for k, v in s.source.options.items() if v is not None
                                                 and k.lower() not in SECRET_OPTIONS}))
                for s in m.stages
            ],
        )
        for m in specs
    ]
    return spark.createDataFrame(rows, DEFINITIONS_DDL)


def _problem(cond: Column, text: str) -> Column:
    return F.when(cond, F.lit(text))


def check_definitions(defs: DataFrame) -> DataFrame:
    """Validate a table of definitions as one DataFrame job.

    ``defs`` has a column ``metric_id`` (or ``id``), ``time_window``,
    ``func_expr``, ``version`` and ``stages`` (array of structs with at least
    ``stage_type`` and ``output_type``; optional ``sql_query``, ``py_mod``,
    ``view_name``, ``cached_view_name``).  Returns one row per violation:
    ``metric_id, stage_index (null for metric-level), problem``.  Metric ids
    that occur more than once are reported too (one shuffle on the id).
    """
    cols = set(defs.columns)
    mid = F.col("metric_id") if "metric_id" in cols else F.col("id")
    metric = defs.select(
        mid.cast("string").alias("metric_id"),
        *[
            (F.col(c) if c in cols else F.lit(None)).alias(c)
            for c in ("time_window", "func_expr", "version", "stages")
        ],
    )
    tw = F.col("time_window")
    metric_problems = F.array_compact(
        F.array(
            _problem(F.col("metric_id").isNull(), "missing id"),
            _problem(tw.isNull(), "missing time_window"),
            _problem(tw.isNotNull() & tw.cast("string").rlike("[^0-9-]"), "time_window is not an integer"),
            _problem(F.col("func_expr").isNull(), "missing func_expr"),
            _problem(F.col("version").isNull(), "missing version"),
            _problem(F.col("stages").isNull() | (F.size("stages") == 0), "no stages"),
        )
    )
    metric_rows = metric.select(
        "metric_id", F.lit(None).cast("int").alias("stage_index"),
        F.explode(metric_problems).alias("problem"),
    )

    stage_fields = set()
    stages_type = metric.schema["stages"].dataType
    if hasattr(stages_type, "elementType") and hasattr(stages_type.elementType, "names"):
        stage_fields = set(stages_type.elementType.names)

    def sf(name: str) -> Column:
        return F.col(f"s.{name}") if name in stage_fields else F.lit(None).cast("string")

    stype, otype = sf("stage_type"), sf("output_type")
    is_python = stype == F.lit("python")
    # a remote stage may read a table or path named in its source's options
    reads_table = F.lit(False)
    if "source" in stage_fields:
        options = F.col("s.source.options")
        reads_table = F.coalesce(F.arrays_overlap(
            F.map_keys(options), F.array(F.lit("dbtable"), F.lit("table"), F.lit("path"))), F.lit(False))
    known_types = F.lit(sorted(STAGE_KIND_ALIASES))
    known_outputs = F.lit(sorted(OUTPUT_KINDS))
    stage_problems = F.array_compact(
        F.array(
            _problem(stype.isNull() | ~F.array_contains(known_types, stype), "unknown stage_type"),
            _problem(otype.isNotNull() & ~F.array_contains(known_outputs, otype), "unknown output_type"),
            _problem(is_python & sf("py_mod").isNull(), "python stage without py_mod"),
            _problem(~is_python & sf("sql_query").isNull() & ~reads_table, "sql stage without sql_query"),
            _problem(
                (F.coalesce(otype, F.lit("view")) == F.lit("view")) & ~is_python & sf("view_name").isNull(),
                "view stage without view_name",
            ),
            _problem(
                (otype == F.lit("cached_view")) & sf("cached_view_name").isNull() & sf("view_name").isNull(),
                "cached_view stage without a name",
            ),
        )
    )
    stage_rows = (
        metric.select("metric_id", F.posexplode("stages").alias("stage_index", "s"))
        .select("metric_id", "stage_index", F.explode(stage_problems).alias("problem"))
    )
    dupes = (
        metric.where(F.col("metric_id").isNotNull())
        .groupBy("metric_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .select("metric_id", F.lit(None).cast("int").alias("stage_index"),
                F.lit("duplicate metric id").alias("problem"))
    )
    return metric_rows.unionByName(stage_rows).unionByName(dupes)
