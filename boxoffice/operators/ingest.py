"""Ingest reshaping: raw API shapes -> typed flat tables.

Every step is a projection, an equi-join on the order id, or a map-side
combined aggregate. Ticket arrays are never built: those that come with the
listed orders are reshaped within their row, and landed tickets are joined by
order id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from boxoffice.functions.money import money_or_zero, money_text, sum_money
from boxoffice.functions.text import underscore_slug, url_slug
from boxoffice.functions.time import ts, ts_lit
from boxoffice.params import (AS_OF, CHARGE_LOOKBACK_DAYS, CHECKINS_PER_PAGE, ORDERS_PER_PAGE, CHARGE_LOOKBACK_DEFAULT,
                              CHARGES_TABLE, EVENT_RANGE_PRESETS, EVENT_RANGE_TEST, EVENTS_TABLE,
                              EXCLUDED_DESCRIPTOR, FEE_TYPES, UNKNOWN_VENUE)
from boxoffice.operators.joins import salted_join
from boxoffice.sources import raw
from boxoffice.sources.fixtures import EVENT_COLUMNS
from boxoffice.sources.landing import event_parts
from boxoffice.sources.tables import Tables

FEE_MAP = T.MapType(T.StringType(), T.StringType())


def normalize_fees(fee_json: Column) -> list[Column]:
    """N-1: raw fee object -> the seven fee columns in fixed order.

    Keys become underscore slugs (colliding keys: the later one wins, by the
    session's LAST_WIN map-key policy); unknown keys are dropped; a missing
    key or a null object gives null.
    """
    m = F.transform_keys(F.from_json(fee_json, FEE_MAP), lambda k, _v: underscore_slug(k))
    return [m.getItem(f).alias(f) for f in FEE_TYPES]


def fees_normalized(t: Tables) -> DataFrame:
    """N-1 over every order's raw fee object."""
    return raw.order_list(t).select(F.col("id").alias("order_id"),
                                    *normalize_fees(F.col("line_item_fees")))


def listed_pages(pages: DataFrame, size: int, hot: DataFrame) -> DataFrame:
    """S-8: the pages of each event up to its first short one, which ends the list, with that ``end``.

    The end is an aggregate over the page numbers, and a range condition keeps
    the pages; no event's pages are gathered. An event without a short page has
    not come to its end: all its pages count, and ``end`` is null. Answers with
    an error are none. ``hot``: events that hold a large share of the pages.
    """
    pages = pages.filter(F.col("error").isNull())
    ends = pages.filter(F.size("rows") < size).groupBy(F.col("event_id").alias("_event")).agg(F.min("page_no").alias("end"))
    return salted_join(pages, ends, "event_id", "_event", ["page_no"], hot, "left").drop("_event").filter(
        F.col("end").isNull() | (F.col("page_no") <= F.col("end")))


def page_audit(pages: DataFrame, size: int, hot: DataFrame) -> DataFrame:
    """S-8 per event: where its list ends, the rows listed, pages missing before the end and pages after it.

    Without a short page the list is taken to go on after the last page that came.
    """
    good = pages.filter(F.col("error").isNull()).select("event_id", "page_no", F.size("rows").alias("_size"))  # no rows in the shuffle
    last = good.groupBy(F.col("event_id").alias("_event")).agg(
        F.min(F.when(F.col("_size") < size, F.col("page_no"))).alias("end"), F.max("page_no").alias("last"))
    within = F.col("end").isNull() | (F.col("page_no") <= F.col("end"))
    g = salted_join(good, last, "event_id", "_event", ["page_no"], hot).groupBy("event_id", "end", "last").agg(
        F.sum(F.when(within, F.col("_size")).otherwise(0)).alias("n_rows"),
        F.count(F.when(within, 1)).alias("n_pages"), F.count(F.when(~within, 1)).alias("after_end"))
    return g.select("event_id", F.col("end").alias("end_page"), F.col("n_rows").cast("long").alias("n_rows"), "n_pages",
                    (F.coalesce("end", "last") - F.col("n_pages")).alias("missing"), "after_end")


def listed_orders(t: Tables, *columns: str) -> DataFrame:
    """S-8: the orders of the landed pages, with their raw fees and tickets and the page they are on (``page_event``, ``page_no``).

    With ``columns`` only those of the orders are carried through the shuffle of the pages.
    """
    pages = t.order_pages
    if columns:
        pages = pages.withColumn("rows", F.transform("rows", lambda o: F.struct(*[o[c].alias(c) for c in columns])))
    return _orders_of(listed_pages(pages, ORDERS_PER_PAGE, t.hot_events("orders")))


def answered_orders(t: Tables) -> DataFrame:
    """The orders of all landed pages but errors, those after the end of a list too, with their page as in ``listed_orders``."""
    return _orders_of(t.order_pages.filter(F.col("error").isNull()))


def _orders_of(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("event_id").alias("page_event"), "page_no", F.explode("rows").alias("o")).select("page_event", "page_no", "o.*")


def pages_flatten(t: Tables) -> DataFrame:
    """S-8 over the landed order pages."""
    return listed_orders(t, "id", "event_id").select("id", "event_id", "page_no")


def checkin_pages_flatten(t: Tables) -> DataFrame:
    """S-8 over the landed check-in pages."""
    p = listed_pages(t.checkin_pages, CHECKINS_PER_PAGE, t.hot_events("tickets"))
    return p.select(F.explode("rows").alias("ticket_id"), "event_id", "page_no")


def order_page_audit(t: Tables) -> DataFrame:
    return page_audit(t.order_pages, ORDERS_PER_PAGE, t.hot_events("orders"))


def checkin_page_audit(t: Tables) -> DataFrame:
    return page_audit(t.checkin_pages, CHECKINS_PER_PAGE, t.hot_events("tickets"))


def orders_enriched(t: Tables) -> DataFrame:
    """N-2/N-3/N-9: the listed orders (of the landed pages) joined to their landed details on the
    order id (never by position), with the normalised fees merged in (the right side wins)."""
    det = t.order_details.drop("event_id")
    j = listed_orders(t, "id", "event_id", "line_item_fees").drop("page_event", "page_no").join(det, "id")
    return j.select("id", "event_id", "total_paid", "first_name", "last_name", "email", "phone",
                    "opted_in", "opted_in_sms", "paid_date_utc",
                    *normalize_fees(F.col("line_item_fees")))


def nested_orders(t: Tables) -> DataFrame:
    """N-3: the listed orders with their details, and the array of their tickets reshaped in place.

    Every ticket gets its order's fields and face value and the seven fee
    columns, and loses its raw fees; all within the row. The arrays come with
    the pages; none is collected.
    """
    cents = lambda x: (money_or_zero(x) * 100).cast("long")
    total = F.aggregate("ticket", F.lit(0).cast("long"), lambda acc, k: acc + cents(k["price"]))
    face = money_text(total.cast("decimal(38,0)") * F.lit(0.01).cast("decimal(2,2)"))
    j = listed_orders(t).join(t.order_details.drop("event_id"), "id").withColumn("_face", face)

    def shaped(k: Column) -> Column:
        k = (k.withField("order_id", F.col("id")).withField("event_id", F.col("event_id"))
              .withField("name", k["tickettype"]["name"]).withField("ticket_type_name", k["tickettype"]["name"])
              .withField("order_total_paid", F.col("total_paid")).withField("order_total_face_value", F.col("_face")))
        for f in FEE_TYPES:
            k = k.withField(f, k["_fees"].getItem(f))
        return k.dropFields("line_item_fees", "tickettype", "_fees")

    fees = lambda k: F.transform_keys(F.from_json(k["line_item_fees"], FEE_MAP), lambda n, _v: underscore_slug(n))
    ticket = F.transform(F.transform("ticket", lambda k: k.withField("_fees", fees(k))), shaped)
    return j.select("id", "event_id", "total_paid", "first_name", "last_name", "email", "phone", "opted_in", "opted_in_sms", "paid_date_utc",
                    *normalize_fees(F.col("line_item_fees")), ticket.alias("ticket"))


def tickets_unnested(t: Tables) -> DataFrame:
    """N-4/N-10: the tickets of the nested orders, one row each."""
    return nested_orders(t).select(F.explode("ticket").alias("k")).select("k.*")


def order_face_value(t: Tables) -> DataFrame:
    """N-5: sum of an order's ticket prices as ``%.2f`` text (partial aggregation)."""
    return (t.tickets.groupBy("order_id")
            .agg(sum_money(money_or_zero("price")).alias("fv"))
            .select("order_id", money_text("fv").alias("order_total_face_value")))


def tickets_flat(t: Tables, parts: DataFrame | None = None) -> DataFrame:
    """N-4: one row per ticket with its order's total, face value and event, the
    ticket ``name`` overwritten by the ticket type name, fees normalised.

    One shuffle of the tickets, by order id, serves the face value (a sum over
    the order's own tickets) and the join with the orders. It carries the landed
    columns; what is made of them follows. With ``parts`` (``_event_id`` and more
    columns of the events) each ticket gets its event's, through its order.
    """
    order = Window.partitionBy("order_id")
    dealt = raw.gathered(t.tickets, "order_id")
    k = raw.ticket_sales(t, dealt).drop("event_id").withColumn("order_total_face_value", money_text(sum_money(money_or_zero("price"), order)))
    o = t.orders.select(F.col("id").alias("order_id"), F.col("event_id"),
                        F.col("total_paid").alias("order_total_paid"))
    more = parts.columns if parts is not None else []
    if parts is not None:
        o = salted_join(o, parts, "event_id", "_event_id", ["order_id"], t.hot_events("orders"))
    return k.join(o, "order_id").select(
        "id", "order_id", "event_id", "price",
        F.col("tickettype.name").alias("name"),
        "ticket_type_id",
        F.col("tickettype.name").alias("ticket_type_name"),
        "ticket_type_price", "ticket_type_price_id", "redeemed", "promo_code",
        "order_total_paid", "order_total_face_value",
        *normalize_fees(F.col("line_item_fees")), *more)


def ticket_types_dim(t: Tables) -> DataFrame:
    """N-6: distinct ticket types per event on (type id, price id); the first
    ticket (smallest id) supplies name and price. ``min_by`` combines map-side,
    so a hot event does not need one task."""
    g = raw.ticket_sales(t).groupBy("event_id", "ticket_type_id", "ticket_type_price_id").agg(
        F.min_by(F.struct(F.col("tickettype.name").alias("ticket_type_name"),
                          F.col("ticket_type_price")), F.col("id")).alias("first"))
    return g.select("ticket_type_id", "ticket_type_price_id", "event_id",
                    "first.ticket_type_name", "first.ticket_type_price")


def checkins(t: Tables) -> DataFrame:
    """N-7: check-in ids (redeemed tickets) with their event, under which they are landed."""
    return t.tickets.filter(F.col("redeemed")).select(F.col("id").alias("ticket_id"), "event_id")


def events_without_orders(t: Tables) -> DataFrame:
    """N-8: events that land only their event row."""
    with_orders = t.orders.select(F.col("event_id").alias("id")).distinct()  # combines map-side
    return (t.events.join(with_orders, "id", "left_anti")
            .select(*EVENT_COLUMNS))


def event_range_bounds(preset: str | None, as_of: dt.datetime = AS_OF):
    """P-14: (first day, last day) of a preset; None = unbounded side."""
    if preset == "test":
        return tuple(dt.date.fromisoformat(d) for d in EVENT_RANGE_TEST)
    if preset in EVENT_RANGE_PRESETS:
        lo, hi = EVENT_RANGE_PRESETS[preset]
        day = as_of.date()
        return (day + dt.timedelta(days=lo) if lo is not None else None,
                day + dt.timedelta(days=hi) if hi is not None else None)
    return (None, None)


def events_in_range(t: Tables, preset: str | None = "current", as_of: dt.datetime = AS_OF,
                    organization_id: str | None = None) -> DataFrame:
    """P-14/P-16: events whose start date falls in the preset's day range."""
    lo, hi = event_range_bounds(preset, as_of)
    d = F.col("event_date")  # typed start date: the bounds reach the parquet scan
    e = t.events
    if lo is not None:
        e = e.filter(d >= F.lit(lo))
    if hi is not None:
        e = e.filter(d <= F.lit(hi))
    if organization_id is not None:
        e = e.filter(F.col("organization_id") == organization_id)
    return e.select(*EVENT_COLUMNS)


def charges_extract(raw_charges: DataFrame) -> DataFrame:
    """S-7: succeeded charges whose descriptor does not match the excluded one
    (case-insensitive); a null descriptor is kept."""
    keep = (F.col("status") == "succeeded") & \
        ~F.coalesce(F.col("statement_descriptor"), F.lit("")).rlike(f"(?i){EXCLUDED_DESCRIPTOR}")
    return raw_charges.filter(keep).select(
        "id", F.timestamp_seconds("created").alias("created"),
        F.col("meta_event_start").alias("event_date"), "payment_intent",
        F.col("meta_order_id").alias("ticketsauce_order_id"))


def charges_in_range(t: Tables, preset: str | None = "current",
                     as_of: dt.datetime = AS_OF) -> DataFrame:
    """P-15: charges created at or after ``as_of`` minus the preset's look-back."""
    days = CHARGE_LOOKBACK_DAYS.get(preset, CHARGE_LOOKBACK_DEFAULT)
    return t.charges.filter(F.col("created") >= ts_lit(as_of - dt.timedelta(days=days)))


def event_partition_columns(events: DataFrame) -> DataFrame:
    """S-2 for events: venue slug, year, English month name, zero-padded day."""
    return events.select(F.lit(EVENTS_TABLE).alias("table_name"), url_slug("id").alias("key"), *event_parts())


def charge_partition_columns(charges: DataFrame) -> DataFrame:
    """S-2 for charges: ``venue=unknown`` and an unpadded day."""
    return charges.select(F.lit(CHARGES_TABLE).alias("table_name"), url_slug("id").alias("key"),
                          F.lit(UNKNOWN_VENUE).alias("venue"),
                          F.date_format("created", "yyyy").alias("year"),
                          F.date_format("created", "MMMM").alias("month"),
                          F.date_format("created", "d").alias("day"))


def partition_columns(t: Tables) -> DataFrame:
    return event_partition_columns(t.events).unionByName(charge_partition_columns(t.charges))


def new_partitions(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """S-5: partitions of incoming events (starting after ``as_of``) that the
    already-landed events (starting at or before it) do not have."""
    start = ts("start")
    return missing_partitions(event_partition_columns(t.events.filter(start > ts_lit(as_of))),
                              event_partition_columns(t.events.filter(start <= ts_lit(as_of))))


def missing_partitions(incoming: DataFrame, landed: DataFrame) -> DataFrame:
    """S-5: the partitions of ``incoming`` rows that ``landed`` rows do not have."""
    parts = ["venue", "year", "month", "day"]
    return incoming.select(*parts).distinct().join(landed.select(*parts).distinct(), parts, "left_anti")


def landing_rows(t: Tables, table: str, again: DataFrame | None = None) -> DataFrame:
    """S-1: the rows of one of the six landed tables with their partition columns.

    Rows of an event lie under the event's venue and start date; charges under
    ``venue=unknown`` and the day they were made. ``_event_id`` tells the event
    (null for charges). ``again`` (``_again``, event ids) is joined to the events,
    before they meet the rows: null where an event is not among them.
    """
    if table == "charges":
        made = F.col("created")
        return t.charges.select("*", F.lit(UNKNOWN_VENUE).alias("venue"), F.date_format(made, "yyyy").alias("year"),
                                F.date_format(made, "MMMM").alias("month"), F.date_format(made, "d").alias("day"),
                                F.lit(None).cast("string").alias("_event_id"))
    parts = t.events.select(F.col("id").alias("_event_id"), *event_parts())
    if again is not None:
        parts = parts.join(again, F.col("_event_id") == F.col("_again"), "left")
    if table == "events":
        return t.events.select(*EVENT_COLUMNS).join(parts, F.col("id") == F.col("_event_id"))
    if table == "tickets":
        return tickets_flat(t, parts)
    rows, spread, hot = {"orders": (orders_enriched, "id", "orders"), "ticket_types": (ticket_types_dim, "ticket_type_id", "tickets"),
                         "checkin_ids": (checkins, "ticket_id", "tickets")}[table]
    out = salted_join(rows(t), parts, "event_id", "_event_id", [spread], t.hot_events(hot))
    return out.drop("event_id") if table == "checkin_ids" else out
