"""Daily sales report: weekly party-pass summary, upcoming sales, nested rollup.

The reference reads the engine clock; here ``as_of`` is explicit. Venue
filtering is an ``isin`` on the organization id, which Catalyst pushes to the
event side before the joins.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.money import money, money18
from boxoffice.functions.text import ljust, short_venue, strip_spaces, underscore_slug, url_slug
from boxoffice.functions.time import (from_pacific, iso_millis_z, to_pacific, ts, ts_lit,
                                      week_start_mon,
                                      week_start_sun)
from boxoffice.params import AS_OF, RECENT_SALES_HOURS, REPORT_HORIZON_DAYS, VENUE_IDS
from boxoffice.operators.joins import salted_join
from boxoffice.operators.ordinals import numbered
from boxoffice.sources.tables import Tables


def _sales(t: Tables, venues: list[str], first_day: dt.date, last_day: dt.date) -> DataFrame:
    """Tickets with their event and order fields, for listed venues and events whose
    start date is within [first_day, last_day] (a pushable superset of the exact
    start-time window each report applies). Only the event's own date decides: the
    date copied onto orders and tickets may be that before a reschedule. Each ticket
    joins its order on the order id and its event on its own event id."""
    days = F.col("event_date").between(F.lit(first_day), F.lit(last_day))
    e = t.events.filter(F.col("organization_id").isin(venues) & days).select(
        F.col("id").alias("e_id"), "name", "organization_name", "start")
    o = t.orders.select(F.col("id").alias("o_id"), "paid_date_utc")
    k = t.tickets.select(F.col("order_id").alias("k_order_id"), F.col("event_id").alias("k_event_id"),
                         "ticket_type_name", "price")
    # the event filter first: what is left of the tickets is small against the orders
    return salted_join(k, e, "k_event_id", "e_id", ["k_order_id"], t.hot_events("tickets")).join(o, F.col("k_order_id") == o.o_id)


def _recent(as_of: dt.datetime):
    return ts("paid_date_utc") >= ts_lit(as_of - dt.timedelta(hours=RECENT_SALES_HOURS))


def party_pass_weekly(t: Tables, as_of: dt.datetime = AS_OF,
                      venues: list[str] = VENUE_IDS) -> DataFrame:
    """A-8: party-pass sales per Monday-week and ticket type for events in the
    next 60 days (open lower bound). The reference's arbitrary price pick
    (first element of an unordered array) is made deterministic as ``min``."""
    start = ts("start")
    horizon = as_of + dt.timedelta(days=REPORT_HORIZON_DAYS)
    s = _sales(t, venues, as_of.date(), horizon.date()).filter(
        F.lower("ticket_type_name").contains("party pass")
        & (start > ts_lit(as_of)) & (start <= ts_lit(horizon)))
    return s.groupBy(F.date_format(F.date_trunc("week", start), "yyyy-MM-dd").alias("week_start"),
                     "ticket_type_name").agg(
        money18(F.min(money("price"))).alias("price"),
        F.count("*").alias("tickets_sold"),
        F.count_if(_recent(as_of)).alias("sales_last_24_hours"))


def upcoming_sales(t: Tables, as_of: dt.datetime = AS_OF,
                   venues: list[str] = VENUE_IDS) -> DataFrame:
    """A-9/A-10: sales per event, venue, date, ticket type and price for events
    starting in [as_of, as_of + 60 days], with the last-24-hours count."""
    start = ts("start")
    horizon = as_of + dt.timedelta(days=REPORT_HORIZON_DAYS)
    s = _sales(t, venues, as_of.date(), horizon.date()).filter(
        start.between(ts_lit(as_of), ts_lit(horizon)))
    return s.groupBy(F.col("name").alias("event_name"),
                     F.col("organization_name").alias("venue_name"),
                     F.to_date(start).alias("event_date"),
                     "ticket_type_name",
                     money18(money("price")).alias("price")).agg(
        F.count("*").alias("quantity_sold"),
        F.count_if(_recent(as_of)).alias("sales_last_24_hours"))


def sales_rollup(t: Tables, as_of: dt.datetime = AS_OF,
                 venues: list[str] = VENUE_IDS) -> DataFrame:
    """A-15: week (Sunday start) -> venue -> event title -> ticket lines.

    One grouping-sets aggregate over the upcoming-sales rows gives the line,
    event and venue levels. Events are keyed by title within a venue-week; the
    event level carries the latest date seen for that title.
    """
    u = upcoming_sales(t, as_of, venues).withColumn("week_start", week_start_sun("event_date"))
    keys = ["week_start", "venue_name", "event_name", "event_date", "ticket_type_name", "price"]
    g = u.groupingSets([keys, keys[:3], keys[:2]], *keys).agg(
        F.sum("quantity_sold").alias("quantity_sold"),
        F.sum("sales_last_24_hours").alias("sales_last_24_hours"),
        F.max("event_date").alias("last_event_date"),
        F.grouping("event_name").alias("g_event"),
        F.grouping("ticket_type_name").alias("g_line"))
    level = (F.when(F.col("g_event") == 1, F.lit("venue"))
             .when(F.col("g_line") == 1, F.lit("event")).otherwise(F.lit("line")))
    return g.select(
        level.alias("level"), "week_start",
        F.date_add("week_start", 6).alias("week_end"),
        "venue_name", "event_name",
        F.when(F.col("g_line") == 1, F.col("last_event_date"))
         .otherwise(F.col("event_date")).alias("event_date"),
        "ticket_type_name", "price",
        F.col("quantity_sold").cast("bigint").alias("quantity_sold"),
        F.col("sales_last_24_hours").cast("bigint").alias("sales_last_24_hours"))


def sales_rollup_nested(t: Tables, as_of: dt.datetime = AS_OF,
                        venues: list[str] = VENUE_IDS) -> DataFrame:
    """A-15 nested form: one row per (week, venue) holding its events, each with
    its ticket lines. Events are listed by their first date, then their name (O-6:
    first occurrence in the upcoming sales, which come in that order). A chain of two aggregates over the upcoming-sales rows
    (lines -> events -> venue-weeks); each collected list is bounded by the
    aggregated lines of one event or the events of one venue-week."""
    u = upcoming_sales(t, as_of, venues).withColumn("week_start", week_start_sun("event_date"))
    line = F.struct("event_date", "ticket_type_name", "price", "quantity_sold", "sales_last_24_hours")
    ev = u.groupBy("week_start", "venue_name", "event_name").agg(
        F.min("event_date").alias("first_date"), F.max("event_date").alias("event_date"),
        F.sum("quantity_sold").cast("bigint").alias("event_quantity_sold"),
        F.sum("sales_last_24_hours").cast("bigint").alias("event_sales_last_24_hours"),
        F.sort_array(F.collect_list(line)).alias("tickets"))
    event = F.struct("first_date", "event_name", "event_date", "event_quantity_sold",
                     "event_sales_last_24_hours", "tickets")
    return ev.groupBy("week_start", "venue_name").agg(
        F.sum("event_quantity_sold").cast("bigint").alias("quantity_sold"),
        F.sum("event_sales_last_24_hours").cast("bigint").alias("sales_last_24_hours"),
        F.transform(F.sort_array(F.collect_list(event)), lambda e: e.dropFields("first_date")).alias("events")) \
        .withColumn("week_end", F.date_add("week_start", 6))


def week_label(d) -> F.Column:
    """Week label of the reference's (unused) calendar: Monday after ``d - wday``
    (so a Sunday maps to the next day) through the following Sunday."""
    d = F.to_date(d) if isinstance(d, str) else d
    monday = F.date_add(F.date_sub(d, F.dayofweek(d) - 1), 1)
    return F.concat(monday.cast("string"), F.lit(" to "), F.date_add(monday, 6).cast("string"))


def scalar_probe(t: Tables) -> DataFrame:
    """Every column helper of SURVEY 2.8 projected over the events."""
    start = ts("start")
    start_utc = ts("start_utc")
    return t.events.select(
        "id",
        url_slug("organization_name").alias("venue_slug"),
        underscore_slug("name").alias("name_underscore"),
        week_start_mon(start).alias("week_start_mon"),
        week_start_sun(start).alias("week_start_sun"),
        week_label(F.to_date(start)).alias("week_label"),
        from_pacific(start).alias("start_as_utc"),
        to_pacific(start_utc).alias("start_utc_as_pacific"),
        F.date_format(start, "yy/MM/dd").alias("yy_mm_dd"),
        F.date_format(start, "MM-dd-yyyy").alias("display_date"),
        F.date_format(start, "MMddyyyy").alias("filename_date"),
        F.upper(F.date_format(start, "EEE dd-MMM")).alias("subject_date"),
        F.date_format(start, "hh:mma").alias("open_time_12h"),
        F.date_format(start, "MMMdd_HH:mm").alias("short_local_start"),
        ljust(F.concat(F.date_format(start, "MMMdd_HH:mm"), F.lit("_"), short_venue("location")),
              25, "_").alias("padded_label"),
        short_venue("location").alias("short_venue"),
        strip_spaces("location").alias("venue_no_spaces"),
        iso_millis_z(start_utc).alias("iso_instant"),
        F.date_format(start_utc, "yyyy-MM-dd HH:mm").alias("utc_minutes"),
    )


def result_text_rows(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """S-11: a result in the original's text shapes, one row per result row: a
    name -> text map (hash form) and the text cells in column order (array form;
    the header is the column list). Every value is text, as the query service
    returned it."""
    u = upcoming_sales(t, as_of)
    texts = [F.col(c).cast("string") for c in u.columns]
    return u.select(F.create_map(*[x for c, v in zip(u.columns, texts) for x in (F.lit(c), v)])
                    .alias("row"),
                    F.array(*texts).alias("cells"))


def _in_order(t: Tables, as_of: dt.datetime) -> tuple[DataFrame, list[str]]:
    """The upcoming sales in their result order, numbered from 1; ties by the other columns."""
    u = upcoming_sales(t, as_of)
    order = ["event_date", "event_name", "ticket_type_name"]
    return numbered(u, order + [c for c in u.columns if c not in order]), u.columns


def result_rows_in_order(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """S-11, array form with its header: row 0 holds the column names, rows from 1 the text cells in result order."""
    rows, names = _in_order(t, as_of)
    header = rows.sparkSession.range(1).select(F.lit(0).cast("long").alias("row_no"), F.array(*[F.lit(c) for c in names]).alias("cells"))
    return header.unionByName(rows.select("row_no", F.array(*[F.col(c).cast("string") for c in names]).alias("cells")))


def result_flat_cells(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """S-11, flat form: every cell of the header and the rows, one after the other."""
    rows = result_rows_in_order(t, as_of)
    return rows.select("row_no", F.size("cells").alias("n"), F.posexplode("cells").alias("i", "cell")).select(
        (F.col("row_no") * F.col("n") + F.col("i")).alias("position"), "cell")
