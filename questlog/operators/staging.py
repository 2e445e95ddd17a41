"""Staging: nested event log -> typed ``master_events`` (one narrow
projection, no shuffle)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import event_time_from_micros, parse_yyyymmdd
from ..functions.params import param
from ..schemas import CORRUPT_COLUMN

# master_events column -> (param key, typed field, cast). The source's
# ``status`` and ``price`` params are renamed win_loss_status and revenue.
DEFAULT_PARAM_SPEC: dict[str, tuple[str, str, str | None]] = {
    "level_id": ("level_id", "int", "long"),
    "gold_earned": ("gold_earned", "int", "long"),
    "win_loss_status": ("status", "string", None),
    "revenue": ("price", "double", "decimal(18,2)"),
    "gold_reward": ("gold_reward", "int", "long"),
    "placement": ("placement", "string", None),
    "product_id": ("product_id", "string", None),
    "pack": ("product_id", "string", None),
    "ad_revenue": ("ad_revenue", "double", "decimal(18,2)"),
    "duration": ("duration", "double", "double"),
    "difficulty": ("difficulty", "string", None),
    "weapon_used": ("weapon_used", "string", None),
    "death_reason": ("death_reason", "string", None),
    "time_spent_sec": ("time_spent_sec", "int", "long"),
    "ga_session_id": ("ga_session_id", "int", "long"),
}


def is_corrupt(raw: DataFrame):
    """Rows the JSON reader could not parse, whose date is missing or not
    yyyyMMdd, or that name no event."""
    bad = parse_yyyymmdd("event_date").isNull() | F.col("event_name").isNull()
    if CORRUPT_COLUMN in raw.columns:
        return F.col(CORRUPT_COLUMN).isNotNull() | bad
    return bad


def quarantine(raw: DataFrame) -> DataFrame:
    """The rows :func:`build_master_events` drops, kept for inspection."""
    return raw.where(is_corrupt(raw))


def build_master_events(
    raw: DataFrame,
    spec: Mapping[str, tuple[str, str, str | None]] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Parse the date, flatten the parameters, project struct fields and
    cast money; corrupt rows are left out (see :func:`quarantine`).

    Without an ``event_id`` in the log (or in ``keep``) each event gets a hash
    of its fields as one: a tie-break that is the same on every run. The result
    has every column of the ``master_events`` contract, so all marts read it.

    ``event_date`` stays the session's date from the log: it is never
    derived from ``event_timestamp`` (late events of a session copy it).
    """
    spec = dict(DEFAULT_PARAM_SPEC if spec is None else spec)
    cols = [
        F.col("user_id"),
        F.col("user_pseudo_id"),
        parse_yyyymmdd("event_date").alias("event_date"),
        event_time_from_micros("event_timestamp").alias("event_ts"),
        F.col("event_name"),
    ]
    for name, (key, kind, cast) in spec.items():
        c = param(key, kind)
        if cast:
            c = c.try_cast(cast)  # a value out of range is NULL, not a failed job
        cols.append(c.alias(name))
    fields = {f.name for f in raw.schema.fields}
    if "geo" in fields:
        cols += [F.col("geo.country").alias("country"), F.col("geo.city").alias("city")]
    if "device" in fields:
        cols += [F.col("device.mobile_os").alias("os"), F.col("device.category").alias("device_category")]
    cols += [F.col(c) for c in keep]
    if "event_id" not in keep:
        own = F.col("event_id") if "event_id" in fields else F.xxhash64(*[c for c in raw.columns if c != CORRUPT_COLUMN])
        cols.append(own.alias("event_id"))
    return raw.where(~is_corrupt(raw)).select(*cols)


def events_since(raw: DataFrame, yyyymmdd: str, date_col: str = "event_date") -> DataFrame:
    """``WHERE event_date >= 'yyyyMMdd'`` on the raw string column; a plain
    comparison so it reaches the Parquet scan as a pushed filter."""
    return raw.where(F.col(date_col) >= F.lit(yyyymmdd))


__all__ = ["build_master_events", "events_since", "quarantine", "is_corrupt", "DEFAULT_PARAM_SPEC"]
