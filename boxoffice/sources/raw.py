"""Raw shapes as the ticketing and card APIs deliver them, derived from the fixtures.

* order list rows carry the raw fee object as JSON text with display-name keys
  (including an unknown fee, a pair of keys that collide after slugging, and
  orders without any fee object) and their tickets as an array, each with its
  own raw fee JSON;
* order details carry the buyer fields;
* order pages and check-in pages are the answers of the paged lists, one JSON
  line each: full pages, a short (or empty) last one, a ``no_data`` answer for
  an event without orders, and for some events a stray page after the end.

The pages are built once, when they are first read (``Tables.derive``); queries
read the landed page files. Places in an event's list are numbered
within ranges of order keys, whose counts give the offsets, so no task numbers
all of an event. The places are landed before the pages, which then need them
more than once.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from boxoffice.params import CHECKINS_PER_PAGE, ORDERS_PER_PAGE

if TYPE_CHECKING:
    from boxoffice.sources.tables import Tables


def _piece(key: str, value: Column, cond: Column | None = None) -> Column:
    """``"key": "value"`` or null (``concat_ws`` skips nulls)."""
    p = F.concat(F.lit(f'"{key}": "'), value, F.lit('"'))
    return p if cond is None else F.when(cond, p)


def order_fee_json(k: Column, surcharge: Column, let_tax: Column, sales_tax: Column,
                   venue_fee: Column) -> Column:
    """The order's raw fee object; ``k`` is the numeric order key.

    Document order matters: ``Let Tax`` precedes ``LET Tax``; both slug to
    ``let_tax`` and the later one wins.
    """
    body = F.concat_ws(", ",
                       _piece("Ticketing Fee", F.lit("1.00"), k % 12 == 0),
                       _piece("Let Tax", F.lit("9.99"), k % 10 == 0),
                       _piece("Surcharge", surcharge),
                       _piece("LET Tax", let_tax),
                       _piece("Sales Tax", sales_tax),
                       _piece("Venue Fee", venue_fee),
                       _piece("Admin Fee (Not a Gratuity)", F.lit("2.00"), k % 8 == 0),
                       _piece("Gratuity", F.lit("5.00"), k % 9 == 0),
                       _piece("Processing Charge", F.lit("0.50"), k % 6 == 0))
    return F.when(k % 19 == 0, F.lit(None).cast("string")) \
            .otherwise(F.concat(F.lit("{"), body, F.lit("}")))


def order_list(t: Tables) -> DataFrame:
    """Order list rows: id, event id and the raw fee JSON."""
    o = t.orders
    k = F.col("id").cast("bigint")
    return o.select("id", "event_id",
                    order_fee_json(k, F.col("fee_surcharge"), F.col("fee_let_tax"),
                                   F.col("fee_sales_tax"), F.col("fee_venue_fee"))
                    .alias("line_item_fees"))


def order_details(t: Tables) -> DataFrame:
    """Per-order detail call results (buyer fields)."""
    return t.orders.select("id", "event_id", "total_paid", "first_name", "last_name", "email",
                           "phone", "opted_in", "opted_in_sms", "paid_date_utc")


def _sale(of: Callable[[str], Column]) -> list[Column]:
    """A ticket as listed inside its order, with its raw fee JSON; ``of`` gives a landed column."""
    body = F.concat_ws(", ",
                       _piece("Surcharge", of("surcharge")),
                       _piece("LET Tax", of("let_tax")),
                       _piece("Sales Tax", of("sales_tax")),
                       _piece("Venue Fee", of("venue_fee")))
    return [of("id").alias("id"), of("price").alias("price"), of("ticket_type_id").alias("ticket_type_id"),
            of("ticket_type_price_id").alias("ticket_type_price_id"),
            of("price").alias("ticket_type_price"),
            F.struct(of("ticket_type_name").alias("name")).alias("tickettype"),
            of("redeemed").alias("redeemed"), of("promo_code").alias("promo_code"),
            F.concat(F.lit("{"), body, F.lit("}")).alias("line_item_fees")]


def ticket_sales(t: Tables, tickets: DataFrame | None = None) -> DataFrame:
    """Ticket sales (all, or the given ``tickets``) as listed inside orders, each with its raw fee JSON."""
    return (t.tickets if tickets is None else tickets).select("order_id", "event_id", *_sale(F.col))


def fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


TEXT = T.StringType()
SALE_TYPE = fields(id=TEXT, price=TEXT, ticket_type_id=TEXT, ticket_type_price_id=TEXT, ticket_type_price=TEXT, tickettype=fields(name=TEXT),
                   redeemed=T.BooleanType(), promo_code=TEXT, line_item_fees=TEXT)
ORDER_TYPE = fields(id=TEXT, event_id=TEXT, line_item_fees=TEXT, ticket=T.ArrayType(SALE_TYPE))
ORDER_PAGE, CHECKIN_PAGE = (fields(event_id=TEXT, page_no=T.LongType(), error=TEXT, rows=T.ArrayType(row)) for row in (ORDER_TYPE, TEXT))
PAGE_FILES = {"order_pages": ORDER_PAGE, "checkin_pages": CHECKIN_PAGE}

# Order keys numbered in one task; events (id modulo, rest) with a stray page after the end of their list.
KEY_RANGE = 100_000
STRAY_EVENT_MOD = (17, 3)


def _numbered(rows: DataFrame, key: Column, order: list[str], size: int) -> DataFrame:
    """``rows`` (event_id, ...) with the page that they are on, in the order of ``order``."""
    rows = rows.withColumn("_range", F.floor(key / KEY_RANGE))
    counts = rows.groupBy("event_id", "_range").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("event_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("event_id", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("event_id", "_range").orderBy(*order)) - 1
    return rows.join(counts, ["event_id", "_range"]).withColumn("page_no", F.floor(place / size).cast("long") + 1).drop("_range", "_before")


def gathered(rows: DataFrame, *key: str) -> DataFrame:
    """``rows`` with those of a key next to each other, so that its list is collected without a table of all keys."""
    return rows.repartition(*key).sortWithinPartitions(*key)


def _paged(events: DataFrame, places: DataFrame, rows_of, schema: T.StructType, size: int) -> DataFrame:
    """Page answers of every event.

    ``places`` has event_id, page_no and the columns by which ``rows_of`` adds what
    a row needs; it gives the rows, what of one is gathered, and the list made of
    a page's. All that follows from the numbers of rows is told by ``places``
    alone, and every row is shuffled to its page once, in its landed columns.
    """
    rows = schema["rows"].dataType
    none, no_rows = F.lit(None).cast("string"), F.array().cast(rows)
    ends = places.groupBy("event_id", "page_no").agg(F.count("*").alias("n")).groupBy("event_id").agg(
        F.max("page_no").alias("last"), F.max_by("n", "page_no").alias("n"))
    full = ends.filter(F.col("n") == size).select("event_id", (F.col("last") + 1).alias("page_no"), none.alias("error"), no_rows.alias("rows"))
    empty = events.select(F.col("id").alias("event_id")).join(ends, "event_id", "left_anti").select(
        "event_id", F.lit(1).cast("long").alias("page_no"), F.lit("no_data").alias("error"), no_rows.alias("rows"))
    mod, rest = STRAY_EVENT_MOD
    strays = F.col("event_id").cast("long") % mod == rest
    # the stray page brings the first one again
    again = places.filter(strays & (F.col("page_no") == 1)).drop("page_no").join(
        ends.filter(strays).select("event_id", (F.col("last") + 3).alias("page_no")), "event_id")
    full_rows, row, listed = rows_of(places.unionByName(again))
    pages = gathered(full_rows, "event_id", "page_no").groupBy("event_id", "page_no").agg(F.collect_list(row).alias("rows"))  # at most ``size``
    pages = pages.select("event_id", "page_no", none.alias("error"), listed(F.col("rows")).cast(rows).alias("rows"))
    return pages.unionByName(full).unionByName(empty)


# Landed columns of an order and of a ticket, of which their answers are made when they have come to their page.
ORDER_FEES = ["fee_surcharge", "fee_let_tax", "fee_sales_tax", "fee_venue_fee"]
SALE_COLUMNS = ["id", "price", "ticket_type_id", "ticket_type_price_id", "ticket_type_name", "redeemed", "promo_code",
                "surcharge", "let_tax", "sales_tax", "venue_fee"]


def order_places(t: Tables) -> DataFrame:
    """Orders with the page of the order list that they are on."""
    key = t.orders.select("event_id", F.col("id").cast("long").alias("_key"), F.col("id").alias("_id"))
    pages = _numbered(key, F.col("_key"), ["_key"], ORDERS_PER_PAGE).select("_id", "page_no")
    return t.orders.select("id", "event_id", *ORDER_FEES).join(pages, F.col("id") == F.col("_id")).drop("_id")


def checkin_places(t: Tables) -> DataFrame:
    """Ids of redeemed tickets with the page of the check-in list that they are on."""
    ids = t.tickets.filter(F.col("redeemed")).select("event_id", "id", F.col("order_id").cast("long").alias("_key"))
    return _numbered(ids, F.col("_key"), ["_key", "id"], CHECKINS_PER_PAGE).select("id", "event_id", "page_no")


def order_pages(t: Tables) -> DataFrame:
    """Answers of the order list: pages of 100 orders with their tickets."""
    kept = t.tickets.select("order_id", *SALE_COLUMNS)
    none = F.array().cast(T.ArrayType(kept.select(F.struct(*SALE_COLUMNS)).schema[0].dataType))

    def with_tickets(placed: DataFrame) -> tuple[DataFrame, Column, Callable[[Column], Column]]:
        sold = gathered(kept, "order_id").groupBy("order_id").agg(F.collect_list(F.struct(*SALE_COLUMNS)).alias("ticket"))  # one order's tickets
        row = F.struct("id", *ORDER_FEES, F.coalesce("ticket", none).alias("ticket"))
        return placed.join(sold, F.col("id") == F.col("order_id"), "left"), row, lambda rows: F.transform(rows, listed)

    def listed(o: Column) -> Column:
        fees = order_fee_json(o["id"].cast("bigint"), *[o[f] for f in ORDER_FEES])
        return F.struct(o["id"].alias("id"), F.col("event_id"), fees.alias("line_item_fees"),
                        F.transform(o["ticket"], lambda k: F.struct(*_sale(lambda c: k[c]))).alias("ticket"))

    return _paged(t.events, t.order_places, with_tickets, ORDER_PAGE, ORDERS_PER_PAGE)


def checkin_pages(t: Tables) -> DataFrame:
    """Answers of the check-in list: pages of 5000 ticket ids."""
    return _paged(t.events, t.checkin_places, lambda rows: (rows, F.col("id"), lambda ids: ids), CHECKIN_PAGE, CHECKINS_PER_PAGE)
