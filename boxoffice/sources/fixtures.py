"""Ticket-sales shapes derived from the driver's TPC-H-like tables.

customer+nation -> events (venue = nation), orders -> orders and card charges,
lineitem -> tickets, customer -> control rows. Row-local projections plus one
equi-join (lineitem-orders on the order key); nothing is grouped. The same
derivation is written as SQL for the oracle in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

S = "string"
BASE_DATE = "2024-01-01"
EXCLUDED_EVENT_MOD = (50, 7)  # orders of customers with custkey % 50 = 7 do not exist
UNNAMED_EVENT_MOD = (41, 5)  # events of customers with custkey % 41 = 5 have no organization name
UNPAID_ORDER_MOD = (23, 4)  # orders with orderkey % 23 = 4 have no total
CONTROL_SENT_AT = "2024-01-09 08:00:00"  # when the control rows' mails were sent


def _day(offset: Column) -> Column:
    """``CAST(DATE '2024-01-01' + offset AS STRING)``."""
    return F.date_add(F.lit(BASE_DATE).cast("date"), offset.cast("int")).cast(S)


def _event_date(custkey: Column) -> Column:
    """The (typed) local start date of the event ``custkey``; carried on events and,
    denormalised at landing, on their orders and tickets."""
    return F.date_add(F.lit(BASE_DATE).cast("date"), (custkey % 55).cast("int"))


def _money_text(x: Column) -> Column:
    return x.cast("decimal(10,2)").cast(S)


# The event record's own fields (``event_date`` is a derived, typed column).
EVENT_COLUMNS = ["id", "name", "organization_id", "organization_name", "location", "start",
                 "start_utc"]


def events(customer: DataFrame, nation: DataFrame) -> DataFrame:
    c, n = customer.alias("c"), nation.alias("n")
    k = F.col("c.c_custkey")
    m, r = UNNAMED_EVENT_MOD
    return (c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey"))
            .select(k.cast(S).alias("id"),
                    F.col("c.c_name").alias("name"),
                    F.concat(F.lit("org-"), F.col("c.c_nationkey").cast(S)).alias("organization_id"),
                    F.when(k % m != r, F.col("n.n_name")).alias("organization_name"),
                    F.concat(F.col("n.n_name"), F.lit(" Hall")).alias("location"),
                    F.concat(_day(k % 55), F.lit(" 22:30:00")).alias("start"),
                    F.concat(_day(k % 55 + 1), F.lit(" 06:30:00")).alias("start_utc"),
                    # typed local start date ([decision] in SURVEY 4): date-range filters
                    # on it reach the parquet scan, unlike a cast of the start text
                    _event_date(k).alias("event_date")))


def _fee(k: Column, mod: int, value: str) -> Column:
    return F.when(k % mod == 0, F.lit(None).cast(S)).otherwise(F.lit(value))


def orders(orders_raw: DataFrame) -> DataFrame:
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    m, r = EXCLUDED_EVENT_MOD
    return (orders_raw.filter(ck % m != r)
            .select(k.cast(S).alias("id"),
                    ck.cast(S).alias("event_id"),
                    F.when(k % UNPAID_ORDER_MOD[0] != UNPAID_ORDER_MOD[1], _money_text(F.col("o_totalprice"))).alias("total_paid"),
                    F.concat(F.lit("First"), (ck % 97).cast(S)).alias("first_name"),
                    F.concat(F.lit("Last"), (ck % 89).cast(S)).alias("last_name"),
                    F.concat(F.lit("c"), ck.cast(S), F.lit("@example.com")).alias("email"),
                    F.concat(F.lit("555-"), ck.cast(S)).alias("phone"),
                    (F.col("o_orderstatus") == "F").alias("opted_in"),
                    (F.col("o_orderstatus") == "P").alias("opted_in_sms"),
                    F.concat(_day(k % 15), F.lit(" "), F.lpad((k % 24).cast(S), 2, "0"),
                             F.lit(":00:00")).alias("paid_date_utc"),
                    _fee(k, 3, "4.00").alias("fee_surcharge"),
                    _fee(k, 4, "1.25").alias("fee_let_tax"),
                    _fee(k, 5, "0.75").alias("fee_sales_tax"),
                    _fee(k, 7, "3.00").alias("fee_venue_fee"),
                    _event_date(ck).alias("event_date")))


# Ticket type names by l_partkey % 8 (fixed fixture values, in order 0..7).
TICKET_TYPE_NAMES = [
    "Las Vegas Party Pass",
    "VIP Entry + Bar Card",
    "General Admission",
    "vip bar card (lower case)",
    "PARTY PASS Weekend",
    "Early Bird",
    "Complimentary",
    "Late Entry",
]
COMPLIMENTARY_TYPE = 6
COMPLIMENTARY_EVENT_MOD = (10, 3)  # events of customers with custkey % 10 = 3 give all tickets away


def tickets(lineitem: DataFrame, orders_raw: DataFrame) -> DataFrame:
    m, r = EXCLUDED_EVENT_MOD
    o = orders_raw.select("o_orderkey", "o_custkey").filter(F.col("o_custkey") % m != r)
    # through the shuffle goes what is told by the line itself, in few bytes
    li = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         F.col("l_shipdate").cast("date").alias("shipped"),
                         (F.col("l_tax") > 0).alias("taxed"), (F.col("l_discount") > 0).alias("discounted"),
                         (F.col("l_returnflag") == "R").alias("returned"),
                         (F.col("l_linestatus") == "F").alias("promoted"))
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    tt = F.col("l_partkey") % 8
    base_price = (F.lit(20) + F.lit(5) * tt)
    name = F.lit(TICKET_TYPE_NAMES[-1])
    for i in range(len(TICKET_TYPE_NAMES) - 2, -1, -1):
        name = F.when(tt == i, F.lit(TICKET_TYPE_NAMES[i])).otherwise(name)
    cm, cr = COMPLIMENTARY_EVENT_MOD
    comp = (tt == COMPLIMENTARY_TYPE) | (F.col("o_custkey") % cm == cr)
    ln = F.col("l_linenumber")
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast(S), ln.cast(S), F.col("l_partkey").cast(S),
                    F.col("l_suppkey").cast(S),
                    F.col("shipped").cast(S)).alias("id"),
        F.col("l_orderkey").cast(S).alias("order_id"),
        F.col("o_custkey").cast(S).alias("event_id"),
        F.concat(F.lit("tt-"), tt.cast(S)).alias("ticket_type_id"),
        F.concat(F.lit("tp-"), (F.col("l_partkey") % 16).cast(S)).alias("ticket_type_price_id"),
        name.alias("ticket_type_name"),
        F.when(comp, F.lit("0.00")).otherwise(_money_text(base_price)).alias("price"),
        F.when(ln == 1, F.lit(None).cast(S)).when(ln == 2, F.lit("0.00"))
         .otherwise(F.lit("2.50")).alias("surcharge"),
        F.when(comp, F.lit(None).cast(S))
         .otherwise(_money_text(base_price.cast("decimal(10,0)") * F.lit(0.09).cast("decimal(3,2)")))
         .alias("let_tax"),
        F.when(F.col("taxed"), F.lit("1.10")).alias("sales_tax"),
        F.when(F.col("discounted"), F.lit("3.00")).alias("venue_fee"),
        F.col("returned").alias("redeemed"),
        F.when(F.col("promoted"), F.lit("PROMO")).alias("promo_code"),
        _event_date(F.col("o_custkey")).alias("event_date"),
    )


def raw_charges(orders_raw: DataFrame) -> DataFrame:
    """Card charges as the processor lists them: 0, 1 or 2 per order.

    Charge 1 exists unless orderkey % 5 = 0, charge 2 when orderkey % 50 = 1.
    Written as a row-local generator (explode of the charge numbers), no join.
    """
    m, r = EXCLUDED_EVENT_MOD
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    o = orders_raw.select("o_orderkey", "o_custkey").filter(ck % m != r)
    o = o.withColumn("k", F.explode(F.array(F.lit(1), F.lit(2))))
    o = o.filter(((F.col("k") == 1) & (k % 5 != 0)) | ((F.col("k") == 2) & (k % 50 == 1)))
    suffix = F.concat(k.cast(S), F.lit("-"), F.col("k").cast(S))
    return o.select(
        F.concat(F.lit("ch-"), suffix).alias("id"),
        F.concat(F.lit("pi-"), suffix).alias("payment_intent"),
        (F.lit(1704067200) + F.lit(3600) * (k % 360)).alias("created"),
        k.cast(S).alias("meta_order_id"),
        F.concat(_day(ck % 55), F.lit(" 22:30:00")).alias("meta_event_start"),
        F.when(k % 11 == 0, F.lit("failed")).otherwise(F.lit("succeeded")).alias("status"),
        F.when(k % 17 == 0, F.lit(None).cast(S)).when(k % 13 == 0, F.lit("TICKET DRIVER LV"))
         .otherwise(F.lit("BOX OFFICE")).alias("statement_descriptor"),
    )


# Control status by custkey % 7 (1..5); other residues have no control row.
CONTROL_STATUS_BY_MOD = {1: "initialized", 2: "prelim_sent", 3: "report_canceled",
                         4: "final_sent", 5: "paused"}


def control(customer: DataFrame) -> DataFrame:
    ck = F.col("c_custkey")
    st, sent = F.lit(None).cast(S), F.lit(CONTROL_SENT_AT).cast("timestamp")
    for mod in sorted(CONTROL_STATUS_BY_MOD, reverse=True):
        st = F.when(ck % 7 == mod, F.lit(CONTROL_STATUS_BY_MOD[mod])).otherwise(st)
    return (customer.select("c_custkey").filter((ck % 7 >= 1) & (ck % 7 <= 5))
            .select(ck.cast(S).alias("event_key"), st.alias("report_status"),
                    F.when(st.isin("prelim_sent", "final_sent"), sent).alias("preliminary_sent_at"),
                    F.when(st == "final_sent", sent).alias("final_sent_at")))


def attempts(customer: DataFrame) -> DataFrame:
    """Answers of the mail service for an event's mails: preliminary fails for
    custkey % 9 = 0, accounting for custkey % 13 = 0, final for custkey % 11 = 0."""
    ck = F.col("c_custkey")
    return customer.select(ck.cast(S).alias("event_id"), (ck % 9 != 0).alias("preliminary_ok"),
                           (ck % 13 != 0).alias("accounting_ok"), (ck % 11 != 0).alias("final_ok"))


# Commands by custkey % 11 (0..5).
FIRST_COMMANDS = ["cancel", "mark_preliminary_sent", "mark_final_sent",
                  "force_reset_to_preliminary_sent", "force_forward_to_final_sent", "delete"]


def commands(customer: DataFrame) -> DataFrame:
    """Commands (event_key, seq, op): custkey % 11 picks the first; custkey % 22 = 0
    adds a second and custkey % 33 = 0 a third, so order and delete-then-update occur."""
    ck = F.col("c_custkey")
    first = F.element_at(F.array(*[F.lit(o) for o in FIRST_COMMANDS]), (ck % 11 + 1).cast("int"))
    ops = F.filter(F.array(
        F.struct(F.lit(1).alias("seq"), F.when(ck % 11 < len(FIRST_COMMANDS), first).alias("op")),
        F.struct(F.lit(2).alias("seq"), F.when(ck % 22 == 0, F.lit("mark_preliminary_sent")).alias("op")),
        F.struct(F.lit(3).alias("seq"), F.when(ck % 33 == 0, F.lit("mark_final_sent")).alias("op"))),
        lambda c: c.op.isNotNull())
    return customer.select(ck.cast(S).alias("event_key"), F.explode(ops).alias("c")).select("event_key", "c.seq", "c.op")
