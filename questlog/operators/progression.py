"""Player progression marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import LEVEL_COMPLETE, LEVEL_FAIL


def user_max_level(ev: DataFrame) -> DataFrame:
    """Highest level seen per user (NULL when the user has none)."""
    return ev.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.max("level_id").alias("max_level"))


def level_funnel(ev: DataFrame, max_level: int | None = None) -> DataFrame:
    """D10 + D11: users whose highest level is at least L, for every L from 1
    to the highest level seen (or to ``max_level``, the report's length), and
    each step as a percentage of the previous step.

    One aggregate to a histogram of highest levels, a spine from its maximum
    and a running sum from the top: no users x levels theta join. The windows
    run over one row per level.
    """
    histogram = (
        user_max_level(ev).where("max_level is not null").groupBy("max_level").agg(F.count(F.lit(1)).alias("n"))
    )
    top = F.max("max_level") if max_level is None else F.greatest(F.max("max_level"), F.lit(max_level).cast("long"))
    spine = histogram.agg(top.alias("top"))
    if max_level is not None:  # the report has all its steps even without a user
        spine = spine.select(F.coalesce("top", F.lit(max_level).cast("long")).alias("top"))
    spine = spine.where("top >= 1").select(F.explode(F.sequence(F.lit(1).cast("long"), F.col("top").cast("long"))).alias("level"))
    steps = spine.join(histogram, F.col("level") == F.col("max_level"), "left")
    above = Window.orderBy(F.col("level").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = steps.select("level", F.coalesce(F.sum("n").over(above), F.lit(0)).alias("users"))
    prev = F.lag("users").over(Window.orderBy("level"))
    funnel = steps.select(
        F.col("level").cast("int").alias("level"),
        F.concat(F.lit("Lvl "), F.col("level").cast("string")).alias("level_label"),
        F.col("users").cast("long").alias("users"),
        F.round(F.try_divide(F.col("users").cast("decimal(24,0)") * 100, prev.cast("decimal(24,0)")), 2)
        .cast("double")
        .alias("pct_previous"),
    )
    return (funnel if max_level is None else funnel.where(F.col("level") <= max_level)).orderBy("level")


def churn_levels(ev: DataFrame, n: int | None = None) -> DataFrame:
    """Users whose highest level is L, for every level (or, as the
    source's report has it, for the ``n`` lowest)."""
    levels = (
        user_max_level(ev)
        .where(F.col("max_level").isNotNull())
        .groupBy(F.col("max_level").alias("level_id"))
        .agg(F.count(F.lit(1)).alias("churned_users"))
        .orderBy("level_id")
    )
    return levels if n is None else levels.limit(n)


def level_outcomes(
    ev: DataFrame, n: int | None = None, outcomes: Sequence[str] = (LEVEL_COMPLETE, LEVEL_FAIL)
) -> DataFrame:
    """Per level that has any event (or the report's ``n`` lowest), the
    number of each outcome event (0 when none).

    This is ``pivot(event_name, outcomes).count()`` with the values given,
    written as one conditional count per outcome: no job discovers the
    values, a missing outcome is a 0 column, and a level seen only in other
    events still gets its row (as the source's unstack gives it).
    """
    rows = ev.where(F.col("level_id").isNotNull())
    counts = [F.count_if(F.col("event_name") == o).alias(o) for o in outcomes]
    levels = rows.groupBy("level_id").agg(*counts).orderBy("level_id")
    return levels if n is None else levels.limit(n)
