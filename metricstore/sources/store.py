"""Read the metric store back.

The store is ORC partitioned by ``id, compute_date, compute_hour,
horizontal_level, vertical_level``.  It is always read with the record schema
given explicitly: inferring partition types would turn an id ``"007"`` into
the number 7 and ``compute_date`` into a date.  Filters on the partition
columns prune directories; others are pushed into the ORC reader.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricstore.operators.dedupe import latest_records
from metricstore.operators.envelope import ENVELOPE, ENVELOPE_COLUMNS
from metricstore.sinks.runlog import committed, log_path, read_log


#: Characters that Spark escapes as %XX in the folder name of a partition value (fixed values).
_ESCAPED = set('"#%\'*/:=?\\{[]^') | {chr(c) for c in range(1, 32)} | {"\x7f"}
#: More folders than this are left to the partition filters.
_MOST_FOLDERS = 1000


def _folder(value) -> str:
    if value is None or value == "":
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in str(value))


def _load(spark: SparkSession, path: str, fmt: str, ids, dates) -> DataFrame:
    """The store, or just the folders of the named metrics and dates: only those are listed."""
    reader = spark.read.schema(ENVELOPE).format(fmt)
    if ids is not None:
        root = path.rstrip("/")
        folders = [f"{root}/id={_folder(i)}" for i in ids]
        if dates is not None:
            folders = [f"{f}/compute_date={_folder(d)}" for f in folders for d in dates]
        if 0 < len(folders) <= _MOST_FOLDERS:
            try:
                return reader.option("basePath", root).load(folders)
            except AnalysisException as exc:
                if exc.getCondition() != "PATH_NOT_FOUND":
                    raise
                # one of them was never written: the filters below settle it
    return spark.read.schema(ENVELOPE).format(fmt).load(path)


def read_metrics(
    spark: SparkSession,
    path: str,
    *,
    ids: Iterable[str] | None = None,
    dates: Iterable[str] | None = None,
    date_range: tuple[str | None, str | None] | None = None,
    hours: Iterable[int] | None = None,
    horizontal_levels: Iterable[int] | None = None,
    vertical_levels: Iterable[int] | None = None,
    measure_range: tuple[int | None, int | None] | None = None,
    latest: bool = False,
    fmt: str = "orc",
    run_log: str | bool | None = None,
) -> DataFrame:
    """Records of the store at ``path`` with the 14 columns in schema order.

    ``date_range`` and ``measure_range`` are half-open ``[start, end)``.
    With ``ids`` (and ``dates``) only those folders of the store are listed.
    ``latest=True`` keeps, per metric, version, level, measurement time and
    group, only the records of the newest run (re-runs append, they do not
    replace).

    ``run_log``: only records of committed runs count (``sinks.runlog``).  By
    default the log beside the store is used if there is one; a path names
    another, ``True`` insists on the store's own, ``False`` reads all files.
    """
    ids = None if ids is None else list(ids)
    dates = None if dates is None else list(dates)
    df = _load(spark, path, fmt, ids, dates)
    log = None
    if run_log is not False:
        log = read_log(spark, run_log if isinstance(run_log, str) else log_path(path))
    if log is not None or run_log:
        log = None if log is None else _filtered(log, ids, dates)
        df = committed(df, log, "store")
    return _selected(df, ids, dates, date_range, hours, horizontal_levels, vertical_levels, measure_range, latest)


def stored_files(spark: SparkSession, path: str, ids: Iterable[str], dates: Iterable[str], fmt: str = "orc") -> DataFrame | None:
    """All files of these metrics and dates, committed or not, with ``_metadata`` in reach; None without a store."""
    ids, dates = list(ids), list(dates)
    try:
        df = _load(spark, path, fmt, ids, dates)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return df.where(F.col("id").isin(ids) & F.col("compute_date").isin(dates))


def _filtered(log: DataFrame, ids, dates) -> DataFrame:
    for name, values in (("id", ids), ("compute_date", dates)):
        if values is not None:
            log = log.where(F.col(name).isin(values))
    return log


def read_table(
    spark: SparkSession,
    table: str,
    *,
    ids: Iterable[str] | None = None,
    dates: Iterable[str] | None = None,
    date_range: tuple[str | None, str | None] | None = None,
    hours: Iterable[int] | None = None,
    horizontal_levels: Iterable[int] | None = None,
    vertical_levels: Iterable[int] | None = None,
    measure_range: tuple[int | None, int | None] | None = None,
    latest: bool = False,
    run_log: str | None = None,
    target: str = "table",
) -> DataFrame:
    """As :func:`read_metrics` for a registered store or central table: the catalog prunes partitions.

    ``run_log``: path of the log of the runs that count; ``target`` is ``store``
    for a registered store, whose files are the store's.
    """
    ids = None if ids is None else list(ids)
    dates = None if dates is None else list(dates)
    df = spark.table(table)
    if run_log is not None:
        log = read_log(spark, run_log)
        df = committed(df, None if log is None else _filtered(log, ids, dates), target)
    return _selected(df, ids, dates, date_range, hours, horizontal_levels, vertical_levels,
                     measure_range, latest)


def _selected(df, ids, dates, date_range, hours, horizontal_levels, vertical_levels, measure_range, latest) -> DataFrame:
    lists = {"id": ids, "compute_date": dates, "compute_hour": hours, "horizontal_level": horizontal_levels,
             "vertical_level": vertical_levels}
    ranges = {"compute_date": date_range, "measure_time": measure_range}
    for name, values in lists.items():
        if values is not None:
            df = df.where(F.col(name).isin(list(values)))
    for name, (lo, hi) in ((k, v) for k, v in ranges.items() if v is not None):
        if lo is not None:
            df = df.where(F.col(name) >= F.lit(lo))
        if hi is not None:
            df = df.where(F.col(name) < F.lit(hi))
    df = df.select(*ENVELOPE_COLUMNS)
    return latest_records(df) if latest else df
