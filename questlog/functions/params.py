"""Key/value event parameters: pack, look up, flatten and explode.

``event_params`` is ``array<struct<key, value struct<int_value,
float_value, double_value, string_value>>>``. Every operation here is a
higher-order built-in expression evaluated inside the row's own task: no
UDF, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARAMS_COLUMN = "event_params"
VALUE_FIELDS = ("int_value", "float_value", "double_value", "string_value")


def param(key: str, kind: str = "string", params: str = PARAMS_COLUMN) -> Column:
    """Value of the first entry whose key is ``key``; NULL when absent.

    ``kind`` picks the typed field: ``int``, ``double`` (``float_value``, else
    ``double_value``, else ``int_value``: a whole price is logged as an int) or
    ``string``. This is the scalar subquery
    ``(SELECT value.x FROM UNNEST(event_params) WHERE key = k)`` as a position
    in the array of keys: no lambda per key, and ``get`` (not ``[0]``) keeps a
    missing key NULL under ANSI mode.
    """
    at = F.array_position(F.col(params)["key"], key) - 1
    value = F.get(F.col(params), at.cast("int"))["value"]
    if kind == "int":
        return value["int_value"]
    if kind in ("double", "float"):
        return F.coalesce(value["float_value"], value["double_value"], value["int_value"].cast("double"))
    if kind == "string":
        return value["string_value"]
    raise ValueError(f"unknown param kind {kind!r}")


def _param_entry(key: str, column: Column, dtype: T.DataType) -> Column:
    """One packed entry, typed by the column's declared type: integral (and
    boolean) -> int_value, fractional -> float_value, anything else ->
    string_value."""
    nul_long = F.lit(None).cast("long")
    nul_double = F.lit(None).cast("double")
    nul_string = F.lit(None).cast("string")
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)):
        fields = (column.cast("long"), nul_double, nul_double, nul_string)
    elif isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        fields = (nul_long, column.cast("double"), nul_double, nul_string)
    else:
        fields = (nul_long, nul_double, nul_double, column.cast("string"))
    value = F.struct(*[f.alias(n) for f, n in zip(fields, VALUE_FIELDS)])
    return F.when(column.isNotNull(), F.struct(F.lit(key).alias("key"), value.alias("value")))


def to_event_params(df: DataFrame, columns: Mapping[str, str] | Sequence[str]) -> Column:
    """Pack columns of ``df`` into an ``event_params`` array.

    ``columns`` maps param key -> column name (or lists names used as keys).
    NULL columns produce no entry, as a key absent from the event.
    """
    mapping = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    types = {f.name: f.dataType for f in df.schema.fields}
    entries = [_param_entry(k, F.col(c), types[c]) for k, c in mapping.items()]
    return F.filter(F.array(*entries), lambda e: e.isNotNull())


def flatten_params(
    df: DataFrame,
    spec: Mapping[str, tuple[str, str]],
    cast: Mapping[str, str] | None = None,
    params: str = PARAMS_COLUMN,
) -> DataFrame:
    """Turn keys into nullable columns: ``spec`` = {column: (key, kind)}.
    Optional ``cast`` = {column: spark type}. One narrow projection."""
    cast = cast or {}
    cols = []
    for name, (key, kind) in spec.items():
        c = param(key, kind, params)
        if name in cast:
            c = c.try_cast(cast[name])
        cols.append(c.alias(name))
    return df.select("*", *cols)


def explode_params(df: DataFrame, keep: Sequence[str] = (), params: str = PARAMS_COLUMN) -> DataFrame:
    """One row per parameter (``CROSS JOIN UNNEST(event_params)``): events
    without parameters produce no row."""
    p = F.explode(F.col(params)).alias("param")
    return df.select(*keep, p).select(
        *keep,
        F.col("param.key").alias("key"),
        *[F.col(f"param.value.{f}").alias(f) for f in VALUE_FIELDS],
    )
