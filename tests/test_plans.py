"""Plan-shape checks: the scale properties the design relies on."""

import re

import pytest

from boxoffice.plans.registry import REGISTRY

BATCH = sorted(n for n in REGISTRY if not n.startswith(("stream_", "landing_")))
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "Window", "PythonUDF",
             "BatchEvalPython", "ArrowEvalPython", "CollectLimit"]


# Sums over one order's own tickets; no other key has a window.
WINDOWS = {"tickets_flat"}


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pairs_windows_or_python(tables, name):
    plan = _plan(REGISTRY[name](tables))
    found = [k for k in FORBIDDEN if k in plan and not (name in WINDOWS and k == "Window")]
    assert not found, f"{name}: {found}"


def test_tickets_are_read_and_shuffled_once(tables):
    """The face value and the join with the orders share one shuffle of the tickets, by order id."""
    plan = _plan(REGISTRY["tickets_flat"](tables))
    assert plan.count("FileScan") == 2
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(keys) in (["order_id"], ["order_id", "order_id"]) and "windowspecdefinition(order_id#" in plan


def _reads(df) -> set[str]:
    """The landed tables that a query reads."""
    return {f.rsplit("/", 2)[1] for f in df.inputFiles()}


def test_enriched_orders_join_two_landed_inputs(tables):
    """The landed page files and the landed details, never the same table twice."""
    df = REGISTRY["orders_enriched"](tables)
    assert _reads(df) == {"order_pages", "order_details", "event_sizes"}
    assert _plan(df).count("FileScan json") == 2  # the pages, and the page numbers that end the lists


@pytest.mark.parametrize("name", ["orders_enriched", "pages_flatten", "order_page_audit", "checkin_page_audit"])
def test_pages_are_shuffled_without_what_is_not_needed(spark, tables, name):
    """The join with the ends of the lists carries no tickets, and for an audit no rows at all."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the shuffled join of large inputs
    try:
        plan = _plan(REGISTRY[name](tables))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    carried = re.findall(r"Exchange hashpartitioning\(event_id#\d+, _big_salt#\d+.*\n\W*Project \[(.*)\]", plan)
    assert carried
    made = set(re.findall(r"transform\(rows#.*? AS rows#(\d+)", plan))
    for columns in carried:
        rows = set(re.findall(r"\brows#(\d+)", columns))
        assert not rows if name.endswith("audit") else rows and rows <= made, columns


@pytest.mark.parametrize("name", ["delivery_outcomes", "control_after_batch", "empty_manifests"])
def test_a_tick_reads_no_tickets(tables, name):
    assert "event_sizes" in _reads(REGISTRY[name](tables)) and "tickets" not in _reads(REGISTRY[name](tables))


def test_nested_tickets_are_reshaped_within_their_row(tables):
    """No ticket table, no aggregate by order: the arrays come with the landed pages."""
    df = REGISTRY["tickets_unnested"](tables)
    plan = _plan(df)
    assert "tickets" not in _reads(df) and "collect_list" not in plan and "Generate explode" in plan


def test_manifest_aggregates_before_the_event_join(tables):
    """The tickets are shuffled on all line keys (map-side combined), never on the
    event id alone, so one hot event does not end up in one task."""
    plan = _plan(REGISTRY["event_manifest"](tables))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    line_shuffles = [e for e in exchanges if "ticket_name" in e]
    assert line_shuffles, exchanges
    assert all("price" in e and "surcharge" in e for e in line_shuffles)
    assert "partial_count" in plan


def test_filters_and_columns_reach_the_scan(spark, tables):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # do not truncate the filter list
    plan = _plan(REGISTRY["candidate_events"](tables))
    # only the columns the query uses are read from the landed events
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert scans and all("name" in s for s in scans)
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "In(organization_id" in pushed
    assert "GreaterThanOrEqual(event_date" in pushed and "LessThanOrEqual(event_date" in pushed


def test_update_of_control_is_one_join(tables):
    """One join of the control table with its changes; no aggregate or window over the table."""
    from boxoffice.operators import delivery as dv

    ok = tables.spark.createDataFrame([("1", "preliminary_succeeded", False)], "event_id string, outcome string, manifest_empty boolean")
    plan = _plan(dv.apply_outcomes(tables.control, ok))
    assert len(re.findall(r"Join[ (]", plan)) == 1 and "Aggregate" not in plan


def test_ticket_types_read_the_tickets_once(tables):
    plan = _plan(REGISTRY["ticket_types_dim"](tables))
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_events_without_orders_reduces_orders_first(tables):
    plan = _plan(REGISTRY["events_without_orders"](tables))
    assert "HashAggregate(keys=[id" in plan


def test_marketing_reduces_tickets_before_the_joins(tables):
    plan = _plan(REGISTRY["marketing_new"](tables))
    assert "HashAggregate(keys=[k_order_id" in plan


def test_report_dates_come_from_the_event_alone(tables):
    """No date bound on orders or tickets: their copied date may be from before a reschedule."""
    plan = _plan(REGISTRY["upcoming_sales"](tables))
    assert plan.count("GreaterThanOrEqual(event_date") == 1
