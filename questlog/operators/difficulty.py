"""Level difficulty curve (K08) and pinch points."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..schemas import FAIL, LEVEL_COMPLETE, LEVEL_FAIL, WIN

OUTCOME_EVENTS = (LEVEL_COMPLETE, LEVEL_FAIL)


def outcome_counts(ev: DataFrame, events: Sequence[str] = OUTCOME_EVENTS, by: Sequence[str] = ("level_id",)) -> DataFrame:
    """Attempts, wins and fails by level (or finer)."""
    rows = ev.where(F.col("event_name").isin(list(events)) & F.col("level_id").isNotNull())
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_attempts"),
        F.count_if(F.col("win_loss_status") == WIN).alias("wins"),
        F.count_if(F.col("win_loss_status") == FAIL).alias("fails"),
    )


def difficulty(ev: DataFrame, events: Sequence[str] = OUTCOME_EVENTS) -> DataFrame:
    """Attempts (completions + fails), wins, fails and the two rates
    as fractions rounded to 2 places, per level."""
    return rates(outcome_counts(ev, events)).orderBy("level_id")


def rates(counts: DataFrame) -> DataFrame:
    """The two rates beside the counts they come from."""
    return counts.select(
        "level_id",
        "total_attempts",
        "wins",
        "fails",
        ratio("wins", "total_attempts", 2).alias("win_rate"),
        ratio("fails", "total_attempts", 2).alias("fail_rate"),
    )


def pinch_points(
    ev: DataFrame,
    threshold: float = 0.30,
    min_attempts: int = 0,
    events: Sequence[str] = OUTCOME_EVENTS,
) -> DataFrame:
    """Levels whose unrounded win rate is below ``threshold`` (and with
    at least ``min_attempts`` attempts), hardest first."""
    agg = outcome_counts(ev, events)
    hard = agg.where(
        (F.col("wins") < F.lit(Decimal(str(threshold))) * F.col("total_attempts")) & (F.col("total_attempts") >= min_attempts)
    )
    return hard.select(
        "level_id",
        "total_attempts",
        "wins",
        "fails",
        ratio("wins", "total_attempts", 4).alias("win_rate"),
    ).orderBy("win_rate", "level_id")
