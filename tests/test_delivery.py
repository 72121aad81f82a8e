"""Delivery rules on hand-made rows: repeated candidates, reschedules, empty manifests, parameters."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from boxoffice.functions.time import ts
from boxoffice.operators import delivery as dv
from boxoffice.operators import ingest as ig
from boxoffice.operators import manifest as mf
from boxoffice.operators import reports as rp
from boxoffice.params import AS_OF
from boxoffice.plans import registry
from boxoffice.sources.tables import Tables


@pytest.fixture
def own(spark, tables):
    """A bundle over the landed copy whose tables a test may replace."""
    return Tables(spark, tables.root, landed_at=tables.landed_at)


def _rows(df):
    return sorted(map(str, df.collect()))


def test_repeated_event_rows_give_one_decision(tables, own):
    before = _rows(dv.delivery_categories(tables))
    own.events = tables.events.union(tables.events)
    assert before and _rows(dv.delivery_categories(own)) == before


def test_last_row_of_an_event_counts(tables, own):
    moved = tables.events.withColumn("start_utc", F.date_format(ts("start_utc") + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd HH:mm:ss"))
    own.events = tables.events.union(moved)
    later = {r.event_id: r.event_start_utc_timestamp for r in dv.delivery_categories(own).collect()}
    once = {r.event_id: r.event_start_utc_timestamp for r in dv.delivery_categories(tables).collect()}
    assert later.keys() == once.keys()
    assert all(later[k] == once[k] + dt.timedelta(hours=3) for k in once)


def test_due_exactly_six_minutes_before_a_cutoff(tables, own):
    """D-3 at its edge: due at the cutoff is due, a second later is not."""
    cut = AS_OF + dt.timedelta(days=1) - dt.timedelta(minutes=6)
    at = lambda s: tables.events.withColumn("start_utc", F.lit((cut + dt.timedelta(seconds=s)).strftime("%Y-%m-%d %H:%M:%S")))
    for second, want in ((0, "send_preliminary"), (1, "preliminary_is_not_yet_due")):
        own.events = at(second)
        got = {r.category for r in dv.delivery_categories(own).filter("report_status is null").collect()}
        assert got == {want}


def test_empty_manifest_is_marked_even_if_the_attempt_fails(tables_mid):
    t = tables_mid
    empty = {r.event_id: r.category for r in dv.empty_manifests(t).collect()}
    assert empty
    outcomes = {r.event_id: r.outcome for r in dv.delivery_outcomes(t).collect()}
    after = {r.event_key: r for r in dv.control_after_batch(t).collect()}
    for event in empty:
        assert after[event].report_status == "prelim_sent" and after[event].preliminary_sent_at == AS_OF
        assert outcomes[event]
    failed = t.attempts.select("event_id", *[F.lit(False).alias(c) for c in ("preliminary_ok", "accounting_ok", "final_ok")])
    bundle = Tables(t.spark, t.root, landed_at=t.landed_at)
    bundle.attempts = failed
    assert {r.event_key for r in dv.control_after_batch(bundle).filter(F.col("preliminary_sent_at") == F.lit(AS_OF)).collect()} >= set(empty)


def test_missing_answers_count_as_failures(tables, own):
    own.attempts = tables.attempts.limit(0)
    assert {r.outcome for r in dv.delivery_outcomes(own).collect()} <= {"preliminary_failed", "final_failed"}


def test_rescheduled_event_keeps_its_sales(tables, own):
    """An event moved into the horizon shows its sales, though its orders carry the old date."""
    past = tables.events.filter(F.col("event_date") < F.lit(AS_OF.date()))
    key = past.join(tables.tickets, past.id == tables.tickets.event_id).filter(past.organization_id.isin(rp.VENUE_IDS)).select(past.id).first()[0]
    new = (AS_OF + dt.timedelta(days=5))
    hit = F.col("id") == key
    own.events = tables.events.withColumn("start", F.when(hit, F.lit(new.strftime("%Y-%m-%d %H:%M:%S"))).otherwise(F.col("start"))) \
        .withColumn("event_date", F.when(hit, F.lit(new.date())).otherwise(F.col("event_date")))
    name = own.events.filter(hit).first().name
    sold = rp.upcoming_sales(own).filter(F.col("event_name") == name).agg(F.sum("quantity_sold")).first()[0]
    assert sold == tables.tickets.filter(F.col("event_id") == key).count()


def test_event_and_organization_parameters(tables):
    one = mf.event_manifest(tables).first().event_id
    lines = mf.event_manifest(tables, one)
    assert {r.event_id for r in lines.collect()} == {one}
    assert _rows(lines) == _rows(mf.event_manifest(tables).filter(F.col("event_id") == one))
    org = tables.events.first().organization_id
    got = ig.events_in_range(tables, "upcoming", organization_id=org)
    assert {r.organization_id for r in got.collect()} <= {org}
    assert _rows(got) == _rows(ig.events_in_range(tables, "upcoming").filter(F.col("organization_id") == org))


def test_preliminary_only(tables):
    every, some = dv.delivery_categories(tables), dv.delivery_categories(tables, prelim_only=True)
    assert _rows(some) == _rows(every.filter("category <> 'send_final'"))


@pytest.mark.parametrize("name", sorted(registry.ORDER_BY))
def test_presented_order(tables, name):
    """O-1 .. O-5: the listing comes in the reference's order."""
    rows = registry.present(name, registry.REGISTRY[name](tables)).select(*registry.ORDER_BY[name]).collect()
    key = [tuple((v is not None, v) for v in r) for r in rows]
    assert key == sorted(key)


def test_nested_events_come_by_first_date_then_name(tables):
    flat = {}
    for r in rp.upcoming_sales(tables).collect():
        k = (r.venue_name, r.event_name, r.event_date - dt.timedelta(days=(r.event_date.weekday() + 1) % 7))
        flat[k] = min(flat.get(k, r.event_date), r.event_date)
    for r in rp.sales_rollup_nested(tables).collect():
        order = [(flat[(r.venue_name, e.event_name, r.week_start)], e.event_name) for e in r.events]
        assert order == sorted(order)
