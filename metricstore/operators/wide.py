"""Records as typed rows: one column per group attribute and functional variable.

The keys and their tags are found by one aggregation (a row per kind, key and tag),
and each key becomes a column of the type its tags agree on:

- one tag: its payload (``json`` is text);
- ``long`` and ``double``: double, and so for elements of ``vec_*`` and ``map_*``, if
  every long is exact as a double;
- ``vec_string`` beside ``vec_long``, ``vec_double`` or ``vec_bool`` (a collection that is
  empty or holds a null is stored as JSON texts): the typed collection, if every
  text is null or such a value; ``map_*`` likewise;
- ``json`` and ``string``: text;
- any other mix is a conflict: refused, or the text of each value
  (``on_conflict="text"``).

So a metric's stored records read back as the rows its stage made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricstore.functions.values import payload_as_text

#: Longs up to this are exact as doubles (fixed value).
EXACT = 1 << 53


#: What the texts of a collection may be read as.
_READ = ("long", "double", "boolean")


def value_keys(records: DataFrame) -> DataFrame:
    """(kind, key, type, n, wide, not_long, not_double, not_boolean): the keys of records with their tags.

    ``wide`` counts values with longs beyond ``EXACT``, ``not_...`` collections of
    texts with an element that is neither null nor such a value.
    """
    entries = F.concat(_entries("group_map", "group"), _entries("func_vars", "func"))
    v = F.col("e.value")
    beyond = F.array(v["long"], F.array_max(F.transform(v["vec_long"], F.abs)),
                     F.array_max(F.transform(F.map_values(v["map_long"]), F.abs)))
    texts = F.coalesce(v["vec_string"], F.map_values(v["map_string"]))

    def fails(kind: str) -> Column:
        return F.coalesce(F.exists(texts, lambda t: (t != F.lit("null")) & t.try_cast(kind).isNull()), F.lit(False))

    return records.select(F.explode(entries).alias("e")).groupBy(
        F.col("e.kind").alias("kind"), F.col("e.key").alias("key"), F.col("e.value.type").alias("type")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.exists(beyond, lambda x: F.abs(x) > EXACT), F.lit(False))).alias("wide"),
        *[F.count_if(fails(k)).alias(f"not_{k}") for k in _READ])


def _entries(map_column: str, kind: str) -> Column:
    return F.transform(F.map_entries(F.col(map_column)), lambda e: F.struct(
        F.lit(kind).alias("kind"), e["key"].alias("key"), e["value"].alias("value")))


def _typed(value: Column, tags: set[str], bad: dict[str, int], where: str, on_conflict: str) -> Column:
    """One expression for a key's values, whichever of its tags they have."""
    if tags <= {"json", "string"}:
        return value["string"]
    if len(tags) == 1:
        return value[next(iter(tags))]
    prefix = next((p for p in ("vec_", "map_") if all(t.startswith(p) for t in tags)), "")
    kinds = {t[len(prefix):] for t in tags}
    numbers = kinds - {"string"} if prefix else kinds
    kind = {frozenset({"long"}): "long", frozenset({"double"}): "double", frozenset({"long", "double"}): "double",
            frozenset({"bool"}): "boolean"}.get(frozenset(numbers))
    exact = kind is not None and not (kind == "double" and "long" in numbers and bad["wide"])
    if exact and not ("string" in kinds and bad[f"not_{kind}"]):
        whole = {"": kind, "vec_": f"array<{kind}>", "map_": f"map<string,{kind}>"}[prefix]
        found = [value[f"{prefix}{k}"].cast(whole) for k in sorted(numbers)]
        if "string" in kinds and prefix == "vec_":
            found.append(F.transform(value["vec_string"], lambda t: t.try_cast(kind)))
        elif "string" in kinds:
            found.append(F.transform_values(value["map_string"], lambda _, t: t.try_cast(kind)))
        return F.coalesce(*found)
    if on_conflict == "text":
        return payload_as_text(value)
    raise ValueError(f"{where} has values of types {sorted(tags)}; on_conflict='text' gives their texts")


def to_wide(records: DataFrame, *, scalars: tuple[str, ...] = (), func_prefix: str = "", on_conflict: str = "refuse",
            most_keys: int = 2000) -> DataFrame:
    """``measure_time``, ``val``, the chosen ``scalars`` and a column per key, groups first, each by name.

    ``func_prefix`` is put before functional variables' names.  Runs one
    aggregation to find the keys; more than ``most_keys`` of them are refused, as
    are names that would clash.  Records without a key have null there.
    """
    if on_conflict not in ("refuse", "text"):
        raise ValueError("on_conflict is 'refuse' or 'text'")
    unknown = set(scalars) - set(records.columns)
    if unknown:
        raise ValueError(f"{sorted(unknown)} are no record columns")
    found = value_keys(records).limit(13 * most_keys + 1).collect()
    tags: dict[tuple[str, str], set[str]] = {}
    bad: dict[tuple[str, str], dict[str, int]] = {}
    for r in found:
        at = (r["kind"], r["key"])
        tags.setdefault(at, set()).add(r["type"])
        counts = bad.setdefault(at, dict.fromkeys(("wide", *(f"not_{k}" for k in _READ)), 0))
        for k in counts:
            counts[k] += r[k]
    if len(tags) > most_keys:
        raise ValueError(f"more than {most_keys} keys")
    out, names = [F.col(c) for c in ("measure_time", "val", *scalars)], ["measure_time", "val", *scalars]
    for kind, key in sorted(tags, key=lambda x: (x[0] != "group", x[1])):
        name = key if kind == "group" else func_prefix + key
        value = F.col("group_map" if kind == "group" else "func_vars")[key]
        out.append(_typed(value, tags[kind, key], bad[kind, key], f"{kind} key {key!r}", on_conflict).alias(name))
        names.append(name)
    folded = [n.lower() for n in names]
    clash = sorted({n for n in names if folded.count(n.lower()) > 1})
    if clash:
        raise ValueError(f"several columns would be named {clash}; use func_prefix")
    return records.select(*out)
