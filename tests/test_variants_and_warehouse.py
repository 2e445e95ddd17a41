"""Parameters that no spec names, and tables and reports by name."""

from __future__ import annotations

import datetime as dt
import json

from conftest import SF_SMALL
from questlog.functions import variants
from questlog.operators import monetization
from questlog.plans import warehouse
from questlog.plans.explain import physical_plan
from questlog.sources.driver_tables import DriverTables


def lines(spark, *events):
    text = [x if isinstance(x, str) else json.dumps({"event_name": "e", "event_params": x}) for x in events]
    return variants.parsed(spark.createDataFrame(list(enumerate(text)), "id long, value string"))


def param(key, **value):
    return {"key": key, "value": value}


def test_keys_and_types_no_spec_names(spark):
    log = lines(
        spark,
        [param("a", int_value=1), param("b", string_value="x"), {"key": "bare", "value": 5}],
        [param("a", string_value="2"), param("b", string_value=None), {"key": "deep", "value": {"list": [1, 2.5]}}],
        [param("a", float_value=1.25), param("a", double_value=1e300), {"key": None, "value": 1}, {"value": {"int_value": 1}}],
        "{", "[]", "null", "{}", '{"event_params": 7}', '{"event_params": [3]}', [],
    )
    got = {(r.key, r.type): (r.events, r.known) for r in variants.param_inventory(log, {"a"}).collect()}
    assert got[("a", "BIGINT")] == (1, True) and got[("a", "STRING")] == (1, True) and got[("a", "NUMBER")] == (2, True)
    assert got[("bare", "BIGINT")] == (1, False) and got[("deep", "OBJECT<list: ARRAY<NUMBER>>")] == (1, False)
    assert {k for k, _ in got} == {"a", "b", "bare", "deep"}
    merged = {r.key: r.type for r in variants.merged_types(log).collect()}
    assert merged["a"] == "VARIANT" and merged["bare"] == "BIGINT"


def test_a_key_whose_type_changes_is_read(spark):
    log = lines(
        spark, [param("level_id", int_value=1)], [param("level_id", string_value="2")], [param("level_id", float_value=3.0)],
        [{"key": "level_id", "value": 4}], [param("level_id", string_value="five")], [], "{", [param("other", int_value=1), param("level_id", int_value=6), param("level_id", int_value=7)],
    )
    got = variants.drifting_params(log, {"level_id": "bigint"}, ["id"]).orderBy("id").collect()
    assert [r.level_id for r in got] == [1, 2, 3, 4, None, None, None, 6]


def test_reports_take_parameters(spark):
    db = warehouse.driver_warehouse(spark, SF_SMALL)
    assert warehouse.driver_warehouse(spark, SF_SMALL) == db  # registered once
    t = DriverTables(spark, SF_SMALL)
    for start, end in (("2024-01-01", "2024-01-30"), ("2024-01-05", "2024-01-06"), ("2030-01-01", "2030-01-02")):
        want = monetization.ua_roas(t.master_events(), t.user_acquisition(), start, end).collect()
        got = spark.sql("SELECT * FROM ua_roas_kpi(:a, :b, 'iap_purchase')", {"a": dt.date.fromisoformat(start), "b": dt.date.fromisoformat(end)}).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    assert spark.sql("SELECT * FROM economy_balance('no such event')").collect() == []
    for name in ("economy_balance(cast(null as string))", "retention_kpi(null, null, null)"):
        spark.sql(f"SELECT * FROM {name}").collect()


def test_untagged_facts_are_filtered_at_the_scan(spark):
    from questlog.operators import audience
    from questlog.session import scan_filter_session

    t = DriverTables(scan_filter_session(spark), SF_SMALL)
    df = audience.filter_by_tier(t.master_events_live(), t.user_acquisition(), ["Tier 2"]).select("event_id")
    got = sorted(r.event_id for r in df.collect())
    tagged = audience.filter_tagged_by_tier(DriverTables(spark, SF_SMALL).acquired_events(), ["Tier 2"])
    assert got == sorted(r.event_id for r in tagged.collect()) and got
    plan = physical_plan(df)
    assert plan.index("Exchange hashpartitioning(user_id") < plan.index("might_contain")  # below the facts' shuffle
    # most of the other tiers' events don't reach the shuffle: no more rows than the chosen users' and a few
    nodes, rows = [df._jdf.queryExecution().executedPlan()], []
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            nodes.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        if name == "ShuffleExchangeExec" and "might_contain" in node.toString():
            rows.append(node.metrics().apply("shuffleRecordsWritten").value())
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    assert rows and rows[0] <= len(got) * 1.1 + 10 < t.master_events_live().count()


def test_tables_have_partitions_and_statistics(spark):
    db = warehouse.driver_warehouse(spark, SF_SMALL)
    rows = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE EXTENDED {db}.master_events user_id").collect()}
    assert int(rows["distinct_count"]) > 0 and rows["num_nulls"] == "0"
    days = spark.sql(f"SHOW PARTITIONS {db}.master_events").count()
    assert days == DriverTables(spark, SF_SMALL).master_events().select("event_date").distinct().count()
    plan = physical_plan(spark.sql(f"SELECT count(*) FROM {db}.master_events WHERE event_date = DATE'2024-01-10' AND event_name = 'level_fail'"))
    assert "PartitionFilters: [isnotnull(event_date" in plan and "EqualTo(event_name,level_fail)" in plan
