"""Physical-plan checks: what a query's plan must not contain at scale."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# Nodes that do not belong in these plans: all-pairs joins, Python
# row-at-a-time work, and the row-multiplying Expand of multi-distinct
# aggregates.
FORBIDDEN = {
    "CartesianProduct": "all-pairs join",
    "BroadcastNestedLoopJoin": "nested-loop join",
    "BatchEvalPython": "row-at-a-time Python UDF",
    "ArrowEvalPython": "Python UDF in the hot path",
    "FlatMapGroupsInPandas": "Python group function",
    "Expand": "row-multiplying Expand (several distinct aggregates)",
}


@dataclass
class PlanReport:
    text: str
    exchanges: int = 0
    forbidden: dict[str, str] = field(default_factory=dict)
    scans: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.forbidden


def physical_plan(df: DataFrame) -> str:
    """The physical plan as text, with scan metadata (pushed filters, read
    schema) printed in full rather than cut at 100 characters."""
    spark = df.sparkSession
    key = "spark.sql.maxMetadataStringLength"
    previous = spark.conf.get(key, None)
    spark.conf.set(key, "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    finally:
        if previous is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, previous)


def inspect(df: DataFrame, allow: tuple[str, ...] = ()) -> PlanReport:
    text = physical_plan(df)
    rep = PlanReport(text=text)
    rep.exchanges = len(re.findall(r"\bExchange\b", text))
    for node, why in FORBIDDEN.items():
        if node in allow:
            continue
        if re.search(rf"\b{node}\b", text):
            rep.forbidden[node] = why
    rep.scans = re.findall(r"FileScan \w+ [^\n]*", text)
    return rep


def read_schema_of_scans(df: DataFrame) -> list[str]:
    """The ``ReadSchema`` of each file scan (column pruning check)."""
    return re.findall(r"ReadSchema: (struct<[^>]*>)", physical_plan(df))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", physical_plan(df))
