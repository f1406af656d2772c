"""Stages whose query runs on another engine.

The remote engine (a JDBC database, a warehouse connector) runs the stage
query as a whole and Spark reads only its result.  Everything goes through
``DataFrameReader`` with a format and options; no client library is wrapped.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from metricstore.plans.spec import SourceSpec

# --- fixed values: reader kinds and their DataFrameReader format -----------
READER_FORMATS = {
    "spark": None,  # the session's own catalog: the stage is Spark SQL
    "jdbc": "jdbc",
    "presto": "jdbc",
    "bigquery": "bigquery",
}
# file formats read a path or table; they have no query to push down
FILE_FORMATS = {"parquet", "orc", "json", "csv", "text", "avro", "binaryFile", "xml", "delta"}
# ---------------------------------------------------------------------------


def remote_query(
    spark: SparkSession,
    source: SourceSpec,
    query: str | None = None,
) -> DataFrame:
    """Read the result of ``query`` (or a table named in the options).

    With the options ``partitionColumn``, ``lowerBound``, ``upperBound`` and
    ``numPartitions``, a query is read by that many connections, each taking a
    range of the column from the query as a subquery; without them the whole
    result comes through one connection, which suits small results.
    """
    return spark.read.format(source.format).options(**remote_options(source, query)).load()


def remote_options(source: SourceSpec, query: str | None = None) -> dict[str, str]:
    """The reader options for ``query`` against ``source``."""
    options = {k: str(v) for k, v in source.options.items() if v is not None}
    if query is not None:
        if source.format in FILE_FORMATS:
            raise ValueError(
                f"a {source.format} source reads files and cannot run a query; "
                "register it as a view and query the view in a sql stage"
            )
        if "dbtable" in options or "table" in options:
            raise ValueError("give either a query or a table option, not both")
        if "partitionColumn" in options:
            missing = sorted({"lowerBound", "upperBound", "numPartitions"} - set(options))
            if missing:
                raise ValueError(f"a partitioned query needs {missing}")
            # the reader refuses "query" together with a partition column
            options["dbtable"] = f"({query.strip().rstrip(';')}) stage_query"
        else:
            options["query"] = query
    return options


def jdbc_source(
    url: str,
    *,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    fetch_size: int | None = None,
    options: Mapping[str, str] | None = None,
) -> SourceSpec:
    """A JDBC source; the stage SQL is sent to the database as one query."""
    opts = {"url": url}
    if driver:
        opts["driver"] = driver
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    opts.update(options or {})
    return SourceSpec("jdbc", opts)


def jdbc_table(
    spark: SparkSession,
    source: SourceSpec,
    table: str,
    *,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
) -> DataFrame:
    """Scan a whole table over JDBC, split into range reads on a numeric column.

    Without a partition column the table comes through a single connection and
    a single task, which only suits small tables.
    """
    options = dict(source.options)
    options["dbtable"] = table
    if partition_column is not None:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("a partitioned JDBC scan needs lower_bound, upper_bound and num_partitions")
        options.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return spark.read.format("jdbc").options(**options).load()


def reader_source(
    kind: str,
    options: Mapping[str, str] | None = None,
    *,
    uri: str | None = None,
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
) -> SourceSpec | None:
    """The source for a reader kind; ``None`` for the session's own catalog.

    JDBC-based kinds (``jdbc``, ``presto``) take the connection URI, user,
    password and driver class; other kinds take their connector options.
    """
    if kind not in READER_FORMATS:
        raise ValueError(f"unknown reader kind {kind!r}; known: {sorted(READER_FORMATS)}")
    fmt = READER_FORMATS[kind]
    if fmt is None:
        return None
    if fmt == "jdbc" and uri is not None:
        return jdbc_source(uri, driver=driver, user=user, password=password, options=options)
    opts = dict(options or {})
    if uri is not None:
        opts.setdefault("url", uri)
    return SourceSpec(fmt, opts)
