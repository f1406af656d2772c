"""Tagged-union values as native column expressions.

Every grouping attribute and functional variable of a metric record is stored
as one struct with a ``type`` tag and exactly one populated payload field; the
other payloads are null.  The tag is derived from the Spark type of the source
column at plan time, and where the reference semantics depend on the row
(decimals that happen to be integral, arrays or maps holding a null, empty
collections) the tag is a ``CASE`` over the row, so no Python runs per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: layout of a tagged value (names, order and types must
# --- stay exactly like this for stored records to be exchangeable) ---------
#   type        string
#   long        long
#   double      double
#   bool        boolean
#   string      string
#   vec_long    array<long>
#   vec_double  array<double>
#   vec_bool    array<boolean>
#   vec_string  array<string>
#   map_long    map<string, long>
#   map_double  map<string, double>
#   map_bool    map<string, boolean>
#   map_string  map<string, string>
# Tags are the payload names plus "json" (JSON text kept in ``string``).
ATOMIC_KINDS = ("long", "double", "bool", "string")
JSON_TAG = "json"

_ATOMIC_SPARK = {
    "long": T.LongType(),
    "double": T.DoubleType(),
    "bool": T.BooleanType(),
    "string": T.StringType(),
}


def _payload_type(name: str) -> T.DataType:
    if name in _ATOMIC_SPARK:
        return _ATOMIC_SPARK[name]
    shape, kind = name.split("_", 1)
    if shape == "vec":
        return T.ArrayType(_ATOMIC_SPARK[kind], True)
    return T.MapType(T.StringType(), _ATOMIC_SPARK[kind], True)


PAYLOAD_FIELDS = tuple(ATOMIC_KINDS) + tuple(
    f"{shape}_{kind}" for shape in ("vec", "map") for kind in ATOMIC_KINDS
)
VALUE_TYPE = T.StructType(
    [T.StructField("type", T.StringType(), True)]
    + [T.StructField(name, _payload_type(name), True) for name in PAYLOAD_FIELDS]
)
VALUE_MAP_TYPE = T.MapType(T.StringType(), VALUE_TYPE, True)

_LONG_MIN = Decimal(-(2**63))
_LONG_MAX = Decimal(2**63 - 1)


def atomic_kind(dtype: T.DataType) -> str | None:
    """Tag of a Spark type that maps to one atomic payload, else ``None``."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "long"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "string"
    return None


def tagged(tag: Column | str, **payloads: Column) -> Column:
    """Build a value struct: ``tag`` plus the given payloads, all others null.

    Every field is cast to its declared type so all branches of a row-dependent
    tag produce the identical struct type.
    """
    unknown = set(payloads) - set(PAYLOAD_FIELDS)
    if unknown:
        raise ValueError(f"unknown payload fields: {sorted(unknown)}")
    tag_col = F.lit(tag) if isinstance(tag, str) else tag
    fields = [tag_col.cast(T.StringType()).alias("type")]
    for name in PAYLOAD_FIELDS:
        expr = payloads.get(name)
        if expr is None:
            expr = F.lit(None)
        fields.append(expr.cast(_payload_type(name)).alias(name))
    return F.struct(*fields)


def json_scalar(x: Column) -> Column:
    """JSON text of one scalar (``"a"``, ``1.5``, ``true``, ``null``).

    ``to_json`` rejects bare scalars, so the value is wrapped in a one-element
    array and the brackets are cut off again.
    """
    text = F.to_json(F.array(x))
    return F.substr(text, F.lit(2), F.length(text) - F.lit(2))


def json_text(x: Column, dtype: T.DataType) -> Column:
    """JSON text of a value of any supported type; null becomes ``null``."""
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.to_json(x), F.lit("null"))
    return json_scalar(x)


def _check_supported(dtype: T.DataType, where: str) -> None:
    if isinstance(dtype, (T.BinaryType, T.CalendarIntervalType)):
        raise TypeError(f"{where}: values of type {dtype.simpleString()} cannot be stored")
    if isinstance(dtype, T.ArrayType):
        _check_supported(dtype.elementType, where)
    elif isinstance(dtype, T.MapType):
        _check_supported(dtype.keyType, where)
        _check_supported(dtype.valueType, where)
    elif isinstance(dtype, T.StructType):
        for f in dtype.fields:
            _check_supported(f.dataType, where)


def _decimal_value(x: Column, dtype: T.DecimalType) -> Column:
    # integral decimals inside the long range become ``long``, all others
    # ``double``; a null decimal keeps the ``double`` tag with a null payload
    if dtype.scale == 0 and dtype.precision <= 18:
        return tagged("long", long=x)
    integral = (x % F.lit(1)) == F.lit(0) if dtype.scale > 0 else F.lit(True)
    if dtype.precision - dtype.scale > 18:
        integral = integral & x.between(F.lit(_LONG_MIN), F.lit(_LONG_MAX))
    integral = F.coalesce(integral, F.lit(False))
    return tagged(
        F.when(integral, F.lit("long")).otherwise(F.lit("double")),
        long=F.when(integral, x),
        double=F.when(~integral, x),
    )


def _array_value(x: Column, dtype: T.ArrayType) -> Column:
    element = dtype.elementType
    kind = atomic_kind(element)
    if kind is None:
        # nested, decimal or temporal elements: a list of JSON texts
        return tagged("vec_string", vec_string=F.transform(x, lambda e: json_text(e, element)))
    as_text = F.size(x) == F.lit(0)
    if dtype.containsNull:
        as_text = as_text | F.exists(x, lambda e: e.isNull())
    typed_name = f"vec_{kind}"
    texts = F.transform(x, json_scalar)
    tag = F.when(as_text, F.lit("vec_string")).otherwise(F.lit(typed_name))
    if kind == "string":
        return tagged(tag, vec_string=F.when(as_text, texts).otherwise(x))
    payloads = {typed_name: F.when(~as_text, x), "vec_string": F.when(as_text, texts)}
    return tagged(tag, **payloads)


def _map_value(x: Column, dtype: T.MapType) -> Column:
    if not isinstance(dtype.keyType, (T.StringType, T.CharType, T.VarcharType)):
        x = F.transform_keys(x, lambda k, v: k.cast(T.StringType()))
    value_type = dtype.valueType
    kind = atomic_kind(value_type)
    if kind is None:
        return tagged(
            "map_string",
            map_string=F.transform_values(x, lambda k, v: json_text(v, value_type)),
        )
    as_text = F.size(x) == F.lit(0)
    if dtype.valueContainsNull:
        as_text = as_text | F.exists(F.map_values(x), lambda v: v.isNull())
    typed_name = f"map_{kind}"
    texts = F.transform_values(x, lambda k, v: json_scalar(v))
    tag = F.when(as_text, F.lit("map_string")).otherwise(F.lit(typed_name))
    if kind == "string":
        return tagged(tag, map_string=F.when(as_text, texts).otherwise(x))
    payloads = {typed_name: F.when(~as_text, x), "map_string": F.when(as_text, texts)}
    return tagged(tag, **payloads)


def value_struct(x: Column | str, dtype: T.DataType, as_json: bool = False) -> Column:
    """Encode column ``x`` of Spark type ``dtype`` as one tagged value.

    ``as_json=True`` stores the JSON text of the value under the ``json`` tag.
    Raises ``TypeError`` at plan time for types that cannot be stored.
    """
    col = F.col(x) if isinstance(x, str) else x
    _check_supported(dtype, "value_struct")
    if as_json:
        return tagged(JSON_TAG, string=json_text(col, dtype))
    kind = atomic_kind(dtype)
    if kind is not None:
        return tagged(kind, **{kind: col})
    if isinstance(dtype, T.DecimalType):
        return _decimal_value(col, dtype)
    if isinstance(dtype, T.ArrayType):
        return _array_value(col, dtype)
    if isinstance(dtype, T.MapType):
        return _map_value(col, dtype)
    if isinstance(dtype, T.StructType):
        return tagged(JSON_TAG, string=F.to_json(col))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return tagged("string", string=col.cast(T.StringType()))
    if isinstance(dtype, T.NullType):
        return tagged("string")
    if isinstance(dtype, (T.DayTimeIntervalType, T.YearMonthIntervalType)):
        return tagged("string", string=col.cast(T.StringType()))
    raise TypeError(f"value_struct: unsupported type {dtype.simpleString()}")


def payload_as_text(value: Column) -> Column:
    """One text rendering of whatever payload a tagged value carries.

    Atomic payloads as their cast text, collections as JSON; handy for
    long-format exports and comparisons.
    """
    branches = F.when(value.getField("type") == F.lit(JSON_TAG), value.getField("string"))
    for name in PAYLOAD_FIELDS:
        field = value.getField(name)
        text = field.cast(T.StringType()) if name in ATOMIC_KINDS else F.to_json(field)
        branches = branches.when(value.getField("type") == F.lit(name), text)
    return branches
