"""Fact tables: ticket fact, order fact, remittance, marketing lists, BI dataset.

All are joins of events, orders, tickets and card charges followed by a
projection or a grouped aggregate. Joins are plain equi-joins: Catalyst picks
the strategy and AQE turns a sort-merge join into a broadcast one only when
the measured side is small, and splits skewed partitions (a hot event or a
hot order) instead of sending them to one task. Duplicate charges of one
order fan its tickets out, as in the reference (kept for parity).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.money import (money, money18, money38, money_or_zero, sum_money,
                                       zero_then_money)
from boxoffice.functions.time import ts
from boxoffice.params import FEE_TYPES, PAYMENT_GATEWAY, VOID_TEXT
from boxoffice.operators.joins import salted_join
from boxoffice.sources.raw import gathered
from boxoffice.sources.tables import Tables

W = "decimal(38,2)"


def _events(t: Tables) -> DataFrame:
    return t.events.select(F.col("id").alias("e_id"), "name", "organization_name", "start")


def _orders(t: Tables, *cols: str) -> DataFrame:
    return t.orders.select(F.col("id").alias("o_id"), F.col("event_id").alias("o_event_id"), *cols)


def _charges(t: Tables) -> DataFrame:
    return t.charges.select(F.col("ticketsauce_order_id").alias("c_order_id"), "payment_intent")


def ticket_fact(t: Tables) -> DataFrame:
    """A-1: one row per ticket (x charge), 31 columns."""
    e = _events(t)
    o = _orders(t, "first_name", "last_name", "paid_date_utc")
    k = t.tickets.select(F.col("id").alias("k_id"), F.col("order_id").alias("k_order_id"),
                         "price", "surcharge", "let_tax", "sales_tax", "venue_fee",
                         "ticket_type_name", "ticket_type_id", "redeemed", "promo_code")
    j = (salted_join(o, e, "o_event_id", "e_id", ["o_id"], t.hot_events("orders"))
          .join(k, k.k_order_id == o.o_id)
          .join(_charges(t), o.o_id == F.col("c_order_id"), "left"))
    price = money_or_zero("price")
    parts = [money_or_zero(c) for c in ("price", "surcharge", "let_tax", "sales_tax", "venue_fee")]
    paid = ts("paid_date_utc")
    return j.select(
        F.col("o_id").alias("ticketsauce_order_id"),
        F.col("payment_intent").alias("stripe_charge_payment_intent"),
        F.coalesce("payment_intent", "o_id").alias("order_id"),
        F.col("organization_name").alias("venue_title"),
        F.col("name").alias("event_title"),
        F.lower("name").alias("lowercase_event_title"),
        F.to_date(ts("start")).alias("event_date"),
        F.lit(1).alias("quantity"),
        money18(price).alias("shared_price_per_ticket"),
        money18(price).alias("face_value_subtotal"),
        money18(parts[1]).alias("shared_surcharge"),
        money18(parts[2]).alias("shared_let_tax_amount_currency"),
        money18(parts[3]).alias("sales_tax_currency"),
        money18(parts[4]).alias("service_charge_currency"),
        F.lit(0).alias("donation_charity"),
        money18(parts[0] + parts[1] + parts[2] + parts[3] + parts[4]).alias("total"),
        F.col("ticket_type_name"),
        F.lower("ticket_type_name").alias("lowercase_ticket_type_name"),
        F.col("ticket_type_id"),
        F.col("ticket_type_name").alias("ticket_holder_name"),  # tickets.name holds the type name
        F.col("first_name").alias("order_first_name"),
        F.col("last_name").alias("order_last_name"),
        paid.alias("final_at_UTC"),
        F.lit(VOID_TEXT).alias("void"),
        F.lit(PAYMENT_GATEWAY).alias("payment_gateway"),
        F.lit("").alias("learned_from"),
        F.col("k_id").alias("id"),
        paid.alias("created_at_UTC"),
        F.col("o_event_id").alias("event_id"),
        F.col("redeemed").alias("ticket_redeemed"),
        F.col("promo_code").alias("ticket_promo_code"),
    )


def order_subtotals(t: Tables) -> DataFrame:
    """P-6: ``total_paid - (surcharge + let + sales tax + venue fee)``; null total stays null.

    Order ids are unique, so the reference's self-join is a column expression.
    """
    fees = [money_or_zero(f"fee_{c}") for c in ("surcharge", "let_tax", "sales_tax", "venue_fee")]
    return t.orders.select(F.col("id").alias("order_id"),
                           money18(money("total_paid") - (fees[0] + fees[1] + fees[2] + fees[3]))
                           .alias("subtotal"))


def ticket_counts(t: Tables) -> DataFrame:
    """Tickets per order (the length of an order's ticket array), map-side combined."""
    return t.tickets.groupBy(F.col("order_id").alias("n_order_id")).agg(F.count("*").alias("n_tickets"))


def order_fact(t: Tables) -> DataFrame:
    """A-2: per order x payment intent, 18 group keys, ``SUM(len(ticket))``."""
    e = _events(t)
    o = _orders(t, "total_paid", "first_name", "last_name", "email", "opted_in", "opted_in_sms",
                "paid_date_utc", "fee_surcharge", "fee_let_tax", "fee_sales_tax", "fee_venue_fee")
    fees = [money_or_zero(f"fee_{c}") for c in ("surcharge", "let_tax", "sales_tax", "venue_fee")]
    o = o.withColumn("subtotal", money18(money("total_paid") - (fees[0] + fees[1] + fees[2] + fees[3])))
    n = ticket_counts(t)
    j = (salted_join(o, e, "o_event_id", "e_id", ["o_id"], t.hot_events("orders"))
          .join(_charges(t), o.o_id == F.col("c_order_id"), "left")
          .join(n, o.o_id == n.n_order_id, "left"))
    keys = ["o_id", "payment_intent", "organization_name", "name", "start", "fee_surcharge",
            "fee_let_tax", "fee_sales_tax", "fee_venue_fee", "total_paid", "first_name", "email",
            "opted_in", "opted_in_sms", "last_name", "paid_date_utc", "o_event_id", "subtotal"]
    g = j.groupBy(*keys).agg(F.sum(F.coalesce("n_tickets", F.lit(0))).alias("quantity"))
    paid = ts("paid_date_utc")
    return g.select(
        F.col("o_id").alias("ticketsauce_order_id"),
        F.col("payment_intent").alias("stripe_charge_payment_intent"),
        F.col("organization_name").alias("venue_title"),
        F.col("name").alias("event_title"),
        F.lower("name").alias("lowercase_event_title"),
        F.to_date(ts("start")).alias("event_date"),
        F.col("quantity").cast("bigint").alias("quantity"),
        F.col("subtotal"),
        F.coalesce("fee_surcharge", F.lit("0.00")).alias("surcharge"),
        F.coalesce("fee_let_tax", F.lit("0.00")).alias("LET"),
        F.coalesce("fee_sales_tax", F.lit("0.00")).alias("sales_tax"),
        F.coalesce("fee_venue_fee", F.lit("0.00")).alias("service_charge"),
        F.lit(0).alias("donation_charity"),
        F.col("total_paid"),
        F.col("first_name").alias("order_first_name"),
        F.col("last_name").alias("order_last_name"),
        F.col("email").alias("order_email"),
        "opted_in", "opted_in_sms",
        paid.alias("final_at_UTC"),
        F.lit(VOID_TEXT).alias("void"),
        F.lit(PAYMENT_GATEWAY).alias("payment_gateway"),
        F.lit("").alias("learned_from"),
        paid.alias("created_at_UTC"),
        F.col("o_event_id").alias("event_id"),
    )


TICKET_KEYS = ["ticket_type_id", "ticket_type_name", "price", "surcharge", "let_tax",
               "venue_fee", "sales_tax"]
REMIT_KEYS = ["start", "organization_name", "name"] + TICKET_KEYS


def charge_weights(t: Tables) -> DataFrame:
    """Charges per order: the fan-out of the left join of orders with charges."""
    return t.charges.groupBy(F.col("ticketsauce_order_id").alias("w_order_id")) \
                    .agg(F.count("*").alias("n_charges"))


def _remit(t: Tables, conv) -> DataFrame:
    """A-3/A-4: grouped by the raw text columns; ``conv`` turns text into money.

    Same rows as the reference's join-then-group, computed in two aggregates:

    * tickets join their order (order id) and are weighted by the order's charge
      count (at least 1: the left join keeps orders without a charge), which is
      exactly the fan-out of the join with the charges;
    * they are aggregated per event and ticket attributes (map-side combined,
      so one hot event does not need one task), then joined to the events and
      re-aggregated on the reference's keys (two events may share start, venue
      and name).

    With ``zero_then_money`` a null and a ``'0.00'`` fee stay separate groups
    that print identically (A-5), as in the reference.
    """
    k = t.tickets.select(F.col("order_id").alias("k_order_id"), *TICKET_KEYS)
    o = _orders(t)
    w = F.greatest(F.coalesce(F.col("n_charges"), F.lit(0)), F.lit(1))
    j = (k.join(o, k.k_order_id == o.o_id)
          .join(charge_weights(t), o.o_id == F.col("w_order_id"), "left"))
    per_event = j.groupBy("o_event_id", *TICKET_KEYS).agg(
        F.sum(w).alias("sold"),
        *[sum_money(conv(c) * w).alias(f"s_{c}")
          for c in ("price", "let_tax", "venue_fee", "surcharge", "sales_tax")])
    e = _events(t)
    g = per_event.join(e, per_event.o_event_id == e.e_id).groupBy(*REMIT_KEYS).agg(
        F.sum("sold").alias("sold"),
        money38(F.sum("s_price")).alias("face_value_admissions_total"),
        money38(F.sum("s_let_tax")).alias("let_total"),
        money38(F.sum("s_venue_fee")).alias("service_charge_total"),
        money38(F.sum("s_surcharge")).alias("surcharge_total"),
        money38(F.sum("s_sales_tax")).alias("sales_tax_total"))
    start = ts("start")
    return g.select(
        F.concat(F.date_format(start, "yy/MM/dd"), F.lit(" "), F.col("name")).alias("event_details"),
        F.to_date(start).alias("event_date"),
        F.col("organization_name").alias("venue"),
        F.col("name").alias("event"),
        "ticket_type_id", "ticket_type_name",
        money18(conv("price")).alias("price_per_ticket"),
        money18(conv("surcharge")).alias("surcharge_per_ticket"),
        money18(conv("let_tax")).alias("let_per_ticket"),
        money18(conv("venue_fee")).alias("service_charge_per_ticket"),
        money18(conv("sales_tax")).alias("sales_tax_per_ticket"),
        F.col("sold").cast("bigint").alias("sold"),
        "face_value_admissions_total", "let_total", "service_charge_total",
        "surcharge_total", "sales_tax_total")


def remit_original(t: Tables) -> DataFrame:
    """A-3: remittance with nulls kept (sum of all-null is null)."""
    return _remit(t, money)


def remit_new(t: Tables) -> DataFrame:
    """A-4/A-5: remittance with missing fees as 0.00, grouped by the raw text."""
    return _remit(t, zero_then_money)


def _marketing_joined(t: Tables) -> DataFrame:
    e = _events(t)
    o = _orders(t, "first_name", "last_name", "email", "phone", "opted_in", "opted_in_sms")
    # all but the ticket type depends on the order: tickets become distinct types per order first
    k = t.tickets.select(F.col("order_id").alias("k_order_id"), "ticket_type_name").distinct()
    return salted_join(o, e, "o_event_id", "e_id", ["o_id"], t.hot_events("orders")).join(k, k.k_order_id == o.o_id)


def marketing_original(t: Tables) -> DataFrame:
    """A-6: per venue, event, order, email, ticket type: max of the rest."""
    return _marketing_joined(t).groupBy(
        F.col("organization_name").alias("venue_name"), F.col("name").alias("event_name"),
        F.col("o_id").alias("ticketsauce_order_id"), "email", "ticket_type_name",
    ).agg(F.max(ts("start")).alias("event_date"),
          F.max("first_name").alias("first_name"), F.max("last_name").alias("last_name"),
          F.max("phone").alias("phone"), F.max("opted_in").alias("opted_in"),
          F.max("opted_in_sms").alias("opted_in_sms"))


def marketing_new(t: Tables) -> DataFrame:
    """A-7: group by all eleven outputs, i.e. distinct rows."""
    return _marketing_joined(t).select(
        F.col("organization_name").alias("venue_name"), F.col("name").alias("event_name"),
        ts("start").alias("event_date"), F.col("o_id").alias("ticketsauce_order_id"),
        "first_name", "last_name", "email", "phone", "opted_in", "opted_in_sms",
        "ticket_type_name").distinct()


def bi_ticket_dataset(t: Tables) -> DataFrame:
    """A-16 / N-10: price per ticket with the *order-level* fees repeated on each ticket.

    The unnest of the order's ticket array is the equi-join of tickets on
    their order id (orders without tickets drop out, as with UNNEST).
    """
    e = _events(t)
    o = _orders(t, "first_name", "last_name", "paid_date_utc", "fee_surcharge", "fee_let_tax",
                "fee_sales_tax", "fee_venue_fee")
    k = t.tickets.select(F.col("id").alias("k_id"), F.col("order_id").alias("k_order_id"),
                         "price", "ticket_type_name", "ticket_type_id", "redeemed", "promo_code")
    j = (salted_join(o, e, "o_event_id", "e_id", ["o_id"], t.hot_events("orders"))
          .join(k, k.k_order_id == o.o_id)
          .join(_charges(t), o.o_id == F.col("c_order_id"), "left"))
    return _bi_columns(j)


def bi_ticket_unnested(t: Tables) -> DataFrame:
    """N-10: the same from the listed orders, by a true unnest of their ticket arrays; the order's
    fees are those of its raw fee object.

    What belongs to an order (its details, event and charges, and that its page is within the
    list) is joined without the arrays. They are shuffled once, to meet it.
    """
    from boxoffice.operators.ingest import answered_orders, listed_orders, normalize_fees

    place = ["id", "event_id", "page_event", "page_no"]
    o = gathered(listed_orders(t, "id", "event_id").select(*place), "id").distinct().join(
        t.order_details.select("id", "first_name", "last_name", "paid_date_utc"), "id").join(
        _charges(t), F.col("id") == F.col("c_order_id"), "left")
    o = salted_join(o, _events(t), "event_id", "e_id", ["id"], t.hot_events("orders")).select(
        F.col("id").alias("o_id"), F.col("event_id").alias("o_event_id"), F.col("page_event").alias("o_page_event"),
        F.col("page_no").alias("o_page_no"), "first_name", "last_name", "paid_date_utc", "payment_intent", "name", "organization_name", "start")
    sale = lambda k: F.struct(k["id"].alias("k_id"), k["tickettype"]["name"].alias("ticket_type_name"),
                              *[k[c].alias(c) for c in ("price", "ticket_type_id", "redeemed", "promo_code")])
    fees = ("surcharge", "let_tax", "sales_tax", "venue_fee")
    sold = answered_orders(t).filter(F.size("ticket") > 0).select(*place, "line_item_fees", F.transform("ticket", sale).alias("ticket")).select(
        *place, *[f.alias(f"fee_{n}") for n, f in zip(FEE_TYPES, normalize_fees(F.col("line_item_fees"))) if n in fees], "ticket")
    j = sold.join(o, (F.col("id") == F.col("o_id")) & (F.col("event_id") == F.col("o_event_id"))
                  & F.col("page_event").eqNullSafe(F.col("o_page_event")) & F.col("page_no").eqNullSafe(F.col("o_page_no")))
    rest = [c for c in j.columns if c not in ("ticket", *place)]
    return _bi_columns(j.select(*rest, F.explode("ticket").alias("k")).select(*rest, "k.*"))


def _bi_columns(j: DataFrame) -> DataFrame:
    """The columns of the BI dataset from a ticket with its order, event and charge."""
    total = (money_or_zero("price") + money_or_zero("fee_surcharge") + money_or_zero("fee_let_tax")
             + money_or_zero("fee_sales_tax") + money_or_zero("fee_venue_fee"))
    paid = ts("paid_date_utc")
    return j.select(
        F.col("o_id").alias("ticketsauce_order_id"),
        F.col("payment_intent").alias("stripe_charge_payment_intent"),
        F.coalesce("payment_intent", "o_id").alias("order_id"),
        F.col("organization_name").alias("venue_title"),
        F.col("name").alias("event_title"),
        F.to_date(ts("start")).alias("event_date"),
        F.lit(1).alias("quantity"),
        F.col("price").alias("shared_price_per_ticket"),
        F.col("price").alias("face_value_subtotal"),
        F.col("fee_surcharge").alias("shared_surcharge"),
        F.col("fee_let_tax").alias("shared_let_tax_amount_currency"),
        F.col("fee_sales_tax").alias("sales_tax_currency"),
        F.col("fee_venue_fee").alias("service_charge_currency"),
        F.lit(0).alias("donation_charity"),
        money18(total).alias("total"),
        "ticket_type_name", "ticket_type_id",
        F.col("ticket_type_name").alias("ticket_holder_name"),
        F.col("first_name").alias("order_first_name"),
        F.col("last_name").alias("order_last_name"),
        paid.alias("final_at_UTC"),
        F.lit(VOID_TEXT).alias("void"),
        F.lit(PAYMENT_GATEWAY).alias("payment_gateway"),
        F.lit("").alias("learned_from"),
        F.col("k_id").alias("id"),
        paid.alias("created_at_UTC"),
        F.col("o_event_id").alias("event_id"),
        F.col("redeemed").alias("ticket_redeemed"),
        F.col("promo_code").alias("ticket_promo_code"),
    )
