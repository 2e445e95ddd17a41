"""N01 to N03 for logs whose parameters are not known beforehand: each line is read as a VARIANT, so a key that no spec
names is kept with its type, and a key whose type changes is read instead of becoming NULL."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .params import VALUE_FIELDS



def parsed(lines: DataFrame, line: str = "value", name: str = "v") -> DataFrame:
    """``lines`` with the line as a VARIANT; NULL where it is no JSON."""
    return lines.withColumn(name, F.try_parse_json(F.col(line)))


def _content(value: Column) -> Column:
    """What a parameter's value holds: its typed field, whichever is filled, or the value itself where it is no such object."""
    fields = [F.try_variant_get(value, f"$.{f}", "variant") for f in VALUE_FIELDS]
    return F.coalesce(*fields, value)


def param_entries(lines: DataFrame, keep: Iterable[str] = (), name: str = "v") -> DataFrame:
    """One row a parameter: (``keep``, event_name, key, content: VARIANT). Lines without parameters have none."""
    v = F.col(name)
    each = lines.select(*keep, F.try_variant_get(v, "$.event_name", "string").alias("event_name"), F.explode(F.try_variant_get(v, "$.event_params", "array<variant>")).alias("p"))
    return each.select(*keep, "event_name", F.try_variant_get("p", "$.key", "string").alias("key"), _content(F.try_variant_get("p", "$.value", "variant")).alias("content"))


def kind_of(content: Column) -> Column:
    """A VARIANT's type: numbers with a point are NUMBER whatever their digits; objects and arrays with what they hold."""
    return F.regexp_replace(F.schema_of_variant(content), r"\bDECIMAL\(\d+,\d+\)|\bDOUBLE\b|\bFLOAT\b", "NUMBER")


def param_inventory(lines: DataFrame, known: Iterable[str] = ()) -> DataFrame:
    """(key, type, events, known): every key and type of the log's parameters, how often, and whether ``known`` names the key."""
    rows = param_entries(lines).where(F.col("key").isNotNull())
    counts = rows.groupBy("key", kind_of(F.col("content")).alias("type")).agg(F.count(F.lit(1)).alias("events"))
    return counts.withColumn("known", F.col("key").isin(list(known)))


def merged_types(lines: DataFrame) -> DataFrame:
    """(key, type): one type a key that all its values fit; VARIANT where it drifts between types that have none."""
    return param_entries(lines).where(F.col("key").isNotNull()).groupBy("key").agg(F.schema_of_variant_agg("content").alias("type"))


def drifting_params(lines: DataFrame, spec: Mapping[str, str], keep: Iterable[str] = (), name: str = "v") -> DataFrame:
    """N03 by VARIANT: (``keep``, one column for each key of ``spec``), the key's first value cast to the type asked for, from
    whatever type it has in the line; NULL where it is absent or can't be cast."""
    params = F.try_variant_get(F.col(name), "$.event_params", "array<variant>")
    at = lambda key: F.get(F.filter("_params", lambda p: F.try_variant_get(p, "$.key", "string") == key), F.lit(0))
    cols = [F.try_variant_get(_content(F.try_variant_get(at(key), "$.value", "variant")), "$", kind).alias(key) for key, kind in spec.items()]
    return lines.withColumn("_params", params).select(*keep, *cols)
