"""What landings and queries over the pages leave on disk and carry through shuffles."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from boxoffice.operators import facts as fc
from boxoffice.operators import ingest as ig
from boxoffice.sources import raw
from boxoffice.sources.tables import Tables, land_table, load_tables


@pytest.fixture
def shop(spark, tmp_path):
    """Own rows: event 3 (with a stray page) has 250 orders, event 4 has 200, event 5 none; two lines an order."""
    customers = [(3, "c3", 0), (4, "c4", 0), (5, "c5", 1)]
    orders = [(k, 3 if k <= 250 else 4, "F", 12.5) for k in range(1, 451)]
    lines = [(k, n, 10 * n + k % 16, 1, dt.datetime(2024, 1, 1), 0.1, 0.0 if n == 1 else None, "R", "F")
             for k in range(1, 451) for n in (1, 2)]
    for name, rows, kind in (
            ("customer", customers, "c_custkey long, c_name string, c_nationkey int"),
            ("nation", [(0, "N0"), (1, "N1")], "n_nationkey int, n_name string"),
            ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double"),
            ("lineitem", lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_shipdate timestamp, "
                                "l_tax double, l_discount double, l_returnflag string, l_linestatus string")):
        spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    return load_tables(spark, str(tmp_path))


def _shuffle_files(spark) -> int:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(files.apply(i).getName().startswith("shuffle_") for i in range(files.length()))


def test_a_landing_leaves_no_shuffle_files(spark, shop):
    """What was shuffled for a landed table does not stay until the driver collects its garbage."""
    before = _shuffle_files(spark)
    for name in ("orders", "tickets", "event_sizes", "order_places", "order_pages"):
        land_table(spark, shop.root, shop.landed_at, name)
    for _ in range(40):  # they go in the background
        left = _shuffle_files(spark) - before
        if left <= 0:
            break
        time.sleep(0.25)
    assert left <= 0
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_places_are_numbered_once(shop):
    """The pages read the landed places; only these number the orders."""
    plan = raw.order_pages(shop)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan


def test_pages_of_own_rows(shop):
    pages = {(r.event_id, r.page_no): r for r in shop.order_pages.collect()}
    assert {k: (r.error, len(r.rows)) for k, r in pages.items()} == {
        ("3", 1): (None, 100), ("3", 2): (None, 100), ("3", 3): (None, 50), ("3", 6): (None, 100),
        ("4", 1): (None, 100), ("4", 2): (None, 100), ("4", 3): (None, 0), ("5", 1): ("no_data", 0)}
    key = lambda o: int(o.id)
    assert [int(o.id) for o in sorted(pages["3", 2].rows, key=key)] == list(range(101, 201))
    first, again = (sorted(pages["3", n].rows, key=key) for n in (1, 6))
    assert [o.id for o in first] == [o.id for o in again] and all(len(o.ticket) == 2 for o in first + again)
    o = first[9]  # order 10
    assert o.line_item_fees == '{"Let Tax": "9.99", "Surcharge": "4.00", "LET Tax": "1.25", "Venue Fee": "3.00"}'
    k = min(o.ticket, key=lambda k: k.id)
    assert (k.id, k.price, k.ticket_type_price, k.tickettype.name, k.redeemed, k.promo_code, k.line_item_fees) == (
        "10-1-20-1-2024-01-01", "0.00", "0.00", "PARTY PASS Weekend", True, "PROMO", '{"Sales Tax": "1.10"}')


def _nodes(plan):
    plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan
    yield plan
    for i in range(plan.children().length()):
        yield from _nodes(plan.children().apply(i))


def test_ticket_arrays_are_shuffled_once(spark, shop):
    """Of the joins of bi_ticket_unnested only the last one moves the orders' tickets."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the shuffled joins of large inputs
    try:
        plan = fc.bi_ticket_unnested(shop)._jdf.queryExecution().executedPlan()
        moved = [n for n in _nodes(plan) if n.nodeName() == "Exchange" and "ticket#" in n.output().mkString(",")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(moved) == 1


def _repeated(spark) -> Tables:
    """Pages, details, events and charges with repeated and null keys; order 1 is on a page after the end as well."""
    fees = '{"Surcharge": "4.00", "LET Tax": "1.25", "Gratuity": "5.00"}'
    sale = lambda i: (i, "20.00", "tt-1", "tp-1", "20.00", ("VIP",), True, None, "{}")
    o = lambda i, e, n=2: (i, e, fees, [sale(f"{i}-{x}") for x in range(n)])
    full = [o(f"f{x}", "e") for x in range(100)]
    pages = [("e", 1, None, full), ("e", 2, None, [o("1", "e"), o("1", "e"), o("2", "other"), o("3", "e", 0), o(None, "e"), o("4", None)]),
             ("e", 2, None, [o("5", "e"), o("1", "e")]), ("e", 5, None, [o("1", "e"), o("6", "e")]), ("e", None, None, [o("7", "e")]),
             (None, 1, None, [o("8", "e"), o("1", "other")]), (None, None, None, [o("9", "e")]), ("other", 1, "no_data", [o("10", "e")]),
             ("unlisted", 1, None, [o("11", "unlisted")])]
    t = Tables(spark, "nowhere")
    t.order_pages = spark.createDataFrame(pages, raw.ORDER_PAGE)
    ids = [str(x) for x in range(1, 12)] + [f"f{x}" for x in range(100)]
    t.order_details = spark.createDataFrame([(i, f"n{i}", "l", "2024-01-02 03:00:00") for i in [*ids, "1", "5", None]],
                                            "id string, first_name string, last_name string, paid_date_utc string")
    t.events = spark.createDataFrame([("e", "E", "V", "2024-01-01 22:30:00"), ("e", "E again", None, None), ("other", "O", "V", None), (None, "N", "V", None)],
                                     "id string, name string, organization_name string, start string")
    t.charges = spark.createDataFrame([("1", "pi-1"), ("1", "pi-2"), ("2", "pi-3"), (None, "pi-4")], "ticketsauce_order_id string, payment_intent string")
    t.event_sizes = spark.createDataFrame([("e", 1000, 1000)], "event_id string, orders long, all_orders long")
    return t


def test_unnested_tickets_of_repeated_keys(spark):
    """Row for row what joining the listed orders, with their tickets, one table after the other gives."""
    t = _repeated(spark)
    j = ig.listed_orders(t).join(t.order_details, "id").join(t.events.withColumnRenamed("id", "event_id"), "event_id").join(
        t.charges, F.col("id") == F.col("ticketsauce_order_id"), "left")
    want = j.select("id", "event_id", "name", "organization_name", "first_name", "payment_intent", F.explode("ticket.id").alias("k"))
    got = fc.bi_ticket_unnested(t)
    assert set(got.select("shared_surcharge", "shared_let_tax_amount_currency", "sales_tax_currency", "service_charge_currency").distinct().collect()) == {
        ("4.00", "1.25", None, None)}
    got = got.select("ticketsauce_order_id", "event_id", "event_title", "venue_title", "order_first_name", "stripe_charge_payment_intent", F.col("id").alias("k"))
    rows = sorted(map(repr, map(tuple, got.collect())))
    assert rows == sorted(map(repr, map(tuple, want.collect())))
    # order 1: three times on the event's list (two details, two charges, two events), once on another's
    assert sum(r.startswith("('1', 'e'") for r in rows) == 3 * 2 * 2 * 2 * 2 and sum(r.startswith("('1', 'other'") for r in rows) == 2 * 2 * 2
