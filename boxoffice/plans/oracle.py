"""DuckDB oracle SQL for every SQL-expressible query key.

Each statement starts from the driver's pre-registered views and derives the
ticket-sales shapes with the same CTEs as ``sources/fixtures.py`` (the text in
FIXTURES.md part 2). Money outputs are DECIMAL(38,2), integer sums BIGINT.
The oracle avoids zone functions: starts are in January-February, where
Pacific time is UTC-8.
"""

from __future__ import annotations

from boxoffice.params import AS_OF_SQL, VENUE_IDS

VENUES_SQL = "(" + ", ".join(f"'{v}'" for v in VENUE_IDS) + ")"

FX = {
    "fx_events": """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
       'org-' || CAST(c_nationkey AS VARCHAR) AS organization_id,
       CASE WHEN c_custkey % 41 <> 5 THEN n_name END AS organization_name, n_name || ' Hall' AS location,
       CAST(DATE '2024-01-01' + CAST(c_custkey % 55 AS INT) AS VARCHAR) || ' 22:30:00' AS start,
       CAST(DATE '2024-01-01' + CAST(c_custkey % 55 + 1 AS INT) AS VARCHAR) || ' 06:30:00' AS start_utc
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "fx_orders": """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS event_id,
       CASE WHEN o_orderkey % 23 <> 4 THEN CAST(CAST(o_totalprice AS DECIMAL(10,2)) AS VARCHAR) END AS total_paid,
       'First' || CAST(o_custkey % 97 AS VARCHAR) AS first_name,
       'Last' || CAST(o_custkey % 89 AS VARCHAR) AS last_name,
       'c' || CAST(o_custkey AS VARCHAR) || '@example.com' AS email,
       '555-' || CAST(o_custkey AS VARCHAR) AS phone,
       o_orderstatus = 'F' AS opted_in, o_orderstatus = 'P' AS opted_in_sms,
       CAST(DATE '2024-01-01' + CAST(o_orderkey % 15 AS INT) AS VARCHAR) || ' '
         || lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0') || ':00:00' AS paid_date_utc,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '4.00' END AS fee_surcharge,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE '1.25' END AS fee_let_tax,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '0.75' END AS fee_sales_tax,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE '3.00' END AS fee_venue_fee
FROM orders WHERE o_custkey % 50 <> 7""",
    "fx_tickets": """
SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-'
         || CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) || '-'
         || CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS id,
       CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS event_id,
       'tt-' || CAST(l_partkey % 8 AS VARCHAR) AS ticket_type_id,
       'tp-' || CAST(l_partkey % 16 AS VARCHAR) AS ticket_type_price_id,
       CASE l_partkey % 8 WHEN 0 THEN 'Las Vegas Party Pass' WHEN 1 THEN 'VIP Entry + Bar Card'
         WHEN 2 THEN 'General Admission' WHEN 3 THEN 'vip bar card (lower case)'
         WHEN 4 THEN 'PARTY PASS Weekend' WHEN 5 THEN 'Early Bird'
         WHEN 6 THEN 'Complimentary' ELSE 'Late Entry' END AS ticket_type_name,
       CASE WHEN l_partkey % 8 = 6 OR o_custkey % 10 = 3 THEN '0.00'
            ELSE CAST(CAST(20 + 5 * (l_partkey % 8) AS DECIMAL(10,2)) AS VARCHAR) END AS price,
       CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '0.00' ELSE '2.50' END AS surcharge,
       CASE WHEN l_partkey % 8 = 6 OR o_custkey % 10 = 3 THEN NULL
            ELSE CAST(CAST((20 + 5 * (l_partkey % 8)) * 0.09 AS DECIMAL(10,2)) AS VARCHAR) END AS let_tax,
       CASE WHEN l_tax > 0 THEN '1.10' END AS sales_tax,
       CASE WHEN l_discount > 0 THEN '3.00' END AS venue_fee,
       l_returnflag = 'R' AS redeemed,
       CASE WHEN l_linestatus = 'F' THEN 'PROMO' END AS promo_code
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey % 50 <> 7""",
    "fx_raw_charges": """
SELECT 'ch-' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(k AS VARCHAR) AS id,
       'pi-' || CAST(o_orderkey AS VARCHAR) || '-' || CAST(k AS VARCHAR) AS payment_intent,
       1704067200 + 3600 * (o_orderkey % 360) AS created,
       CAST(o_orderkey AS VARCHAR) AS meta_order_id,
       CAST(DATE '2024-01-01' + CAST(o_custkey % 55 AS INT) AS VARCHAR) || ' 22:30:00' AS meta_event_start,
       CASE WHEN o_orderkey % 11 = 0 THEN 'failed' ELSE 'succeeded' END AS status,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'TICKET DRIVER LV'
            ELSE 'BOX OFFICE' END AS statement_descriptor
FROM orders JOIN (SELECT 1 AS k UNION ALL SELECT 2 AS k) n
  ON (k = 1 AND o_orderkey % 5 <> 0) OR (k = 2 AND o_orderkey % 50 = 1)
WHERE o_custkey % 50 <> 7""",
    "fx_charges": """
SELECT id, make_timestamp(CAST(created AS BIGINT) * 1000000) AS created,
       meta_event_start AS event_date, payment_intent, meta_order_id AS ticketsauce_order_id
FROM fx_raw_charges
WHERE status = 'succeeded'
  AND NOT regexp_matches(coalesce(statement_descriptor, ''), 'ticket driver', 'i')""",
    "fx_control": """
SELECT CAST(c_custkey AS VARCHAR) AS event_key,
       CASE c_custkey % 7 WHEN 1 THEN 'initialized' WHEN 2 THEN 'prelim_sent'
         WHEN 3 THEN 'report_canceled' WHEN 4 THEN 'final_sent' ELSE 'paused' END AS report_status,
       CASE WHEN c_custkey % 7 IN (2, 4) THEN TIMESTAMP '2024-01-09 08:00:00' END AS preliminary_sent_at,
       CASE WHEN c_custkey % 7 = 4 THEN TIMESTAMP '2024-01-09 08:00:00' END AS final_sent_at
FROM customer WHERE c_custkey % 7 BETWEEN 1 AND 5""",
}


def with_fx(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix a statement with the fixture CTEs (DuckDB skips unused ones)."""
    ctes = dict(FX)
    if extra:
        ctes.update(extra)
    parts = ",\n".join(f"{k} AS ({v.strip()})" for k, v in ctes.items())
    return f"WITH {parts}\n{body.strip()}"


AS_OF = AS_OF_SQL
M = "DECIMAL(10,2)"
R = "DECIMAL(18,2)"
W = "DECIMAL(38,2)"


def coalesced(col: str) -> str:
    return f"COALESCE(CAST({col} AS {M}), 0.00)"


ORACLE: dict[str, str] = {}

# --- manifest ----------------------------------------------------------------
MANIFEST_LINES = f"""
manifest_src AS (
  SELECT e.location AS venue, e.id AS event_id, e.name AS event,
         CAST(CAST(e.start AS TIMESTAMP) AS DATE) AS event_date,
         CAST(e.start AS TIMESTAMP) AS event_open_time,
         t.ticket_type_name AS ticket_name, t.id AS ticket_id,
         {coalesced('t.price')} AS price, {coalesced('t.surcharge')} AS surcharge,
         {coalesced('t.let_tax')} AS let_tax, {coalesced('t.sales_tax')} AS sales_tax,
         {coalesced('t.venue_fee')} AS venue_fee
  FROM fx_events e JOIN fx_tickets t ON t.event_id = e.id),
manifest_lines AS (
  SELECT venue, event_id, event, event_date, event_open_time, ticket_name,
         CAST(price AS {R}) AS price, CAST(surcharge AS {R}) AS surcharge,
         CAST(let_tax AS {R}) AS per_ticket_let,
         COUNT(ticket_id) AS quantity,
         CAST(SUM(price) AS {W}) AS sum_subtotal,
         CAST(SUM(surcharge) AS {W}) AS sum_surcharge,
         CAST(SUM(let_tax) AS {W}) AS sum_let_tax,
         CAST(CAST((CAST(SUM(let_tax) * 100 AS BIGINT) * 20000 + CAST(SUM(price) * 100 AS BIGINT))
                   // (CAST(SUM(price) * 100 AS BIGINT) * 2) AS DECIMAL(38,0)) * 0.01 AS {W})
           AS let_tax_rate_observed,
         CAST(SUM(sales_tax) AS {W}) AS sum_sales_tax,
         CAST(SUM(venue_fee) AS {W}) AS sum_venue_fee
  FROM manifest_src WHERE price > 0.00
  GROUP BY venue, event_id, event, event_date, event_open_time, ticket_name, price, surcharge, let_tax),
manifest_split AS (
  SELECT *, CAST(CASE WHEN regexp_matches(ticket_name, 'VIP.*Bar.*Card') THEN 100.00 * quantity
                      ELSE 0 END AS {W}) AS sum_bar_card,
         CAST(sum_subtotal - CAST(CASE WHEN regexp_matches(ticket_name, 'VIP.*Bar.*Card')
                                       THEN 100.00 * quantity ELSE 0 END AS {W}) AS {W})
           AS subtotal_minus_bar_card
  FROM manifest_lines),
manifest_totals AS (
  SELECT event_id, CAST(SUM(quantity) AS BIGINT) AS total_sold,
         CAST(SUM(subtotal_minus_bar_card) AS {W}) AS total_face_value,
         CAST(SUM(sum_let_tax) AS {W}) AS total_let,
         CAST(SUM(sum_bar_card) AS {W}) AS total_bar_card,
         CAST(SUM(sum_sales_tax) AS {W}) AS total_sales_tax,
         CAST(SUM(sum_venue_fee) AS {W}) AS total_venue_fee,
         CAST(SUM(sum_surcharge) AS {W}) AS total_surcharge
  FROM manifest_split GROUP BY event_id),
manifest_desc AS (
  SELECT min(venue) AS venue, min(event) AS event_title, event_id,
         strftime(min(event_date), '%Y-%m-%d') AS event_date,
         strftime(min(event_date), '%m-%d-%Y') AS display_date,
         strftime(min(event_date), '%m%d%Y') AS filename_date_part,
         replace(min(venue), ' ', '') AS filename_venue_part,
         upper(strftime(min(event_date), '%a %d-%b')) AS subject_date_part,
         strftime(min(event_open_time), '%I:%M%p') AS subject_open_time_part
  FROM manifest_lines GROUP BY event_id)"""


def _with_extra(extra_ctes: str, body: str) -> str:
    parts = ",\n".join(f"{k} AS ({v.strip()})" for k, v in FX.items())
    return f"WITH {parts},\n{extra_ctes.strip()}\n{body.strip()}"


ORACLE["event_manifest"] = _with_extra(MANIFEST_LINES, "SELECT * FROM manifest_lines")
ORACLE["manifest_revenue_split"] = _with_extra(MANIFEST_LINES, "SELECT * FROM manifest_split")
ORACLE["manifest_totals"] = _with_extra(MANIFEST_LINES, "SELECT * FROM manifest_totals")
ORACLE["manifest_description"] = _with_extra(MANIFEST_LINES, "SELECT * FROM manifest_desc")
ORACLE["manifest_header"] = _with_extra(MANIFEST_LINES, """
SELECT d.event_id, v.report_variant, d.venue, d.event_title, d.event_date, d.display_date,
       t.total_sold, t.total_face_value, t.total_let, t.total_bar_card, t.total_sales_tax,
       t.total_venue_fee, t.total_surcharge, v.label_as_final, v.has_pdf, v.has_surcharge_csv,
       v.has_final_csv,
       CASE WHEN v.label_as_final THEN 'FINAL' ELSE 'PRELIMINARY' END AS variant_title,
       CASE WHEN v.label_as_final THEN 'FINAL' ELSE 'PRELIMINARY' END || ' TICKET SALES MANIFEST_'
         || d.filename_date_part || '_' || d.filename_venue_part AS filename_full,
       CASE WHEN v.label_as_final THEN 'FINAL' ELSE 'PRELIMINARY' END || ' TICKET SALES MANIFEST_'
         || d.filename_date_part || '_' || d.filename_venue_part || '.pdf' AS filename_pdf,
       CASE WHEN v.label_as_final THEN 'FINAL' ELSE 'PRELIMINARY' END || ' TICKET SALES MANIFEST_'
         || d.filename_date_part || '_' || d.filename_venue_part || '.csv' AS filename_csv,
       d.venue || ' ' || d.subject_date_part || ' ' || d.event_title || ' | '
         || CASE WHEN v.label_as_final THEN 'FINAL' ELSE 'PRELIMINARY' END
         || ' TICKET SALES MANIFEST ' || d.subject_open_time_part AS email_subject_with_open_time
FROM manifest_desc d JOIN manifest_totals t ON d.event_id = t.event_id
CROSS JOIN (VALUES ('preliminary', false, true, true, false), ('final', true, true, false, true),
                   ('accounting', true, false, true, false))
  AS v(report_variant, label_as_final, has_pdf, has_surcharge_csv, has_final_csv)""")

_CSV_DETAIL = """
SELECT event_id, 0 AS row_kind, venue, event, strftime(event_date, '%Y-%m-%d') AS event_date,
       ticket_name AS ticket, CAST(price AS VARCHAR) AS price,
       CAST(per_ticket_let AS VARCHAR) AS per_ticket_let, CAST(quantity AS VARCHAR) AS sold,
       CAST(sum_bar_card AS VARCHAR) AS total_bar_card,
       CAST(subtotal_minus_bar_card AS VARCHAR) AS total_face_value,
       CAST(sum_let_tax AS VARCHAR) AS total_let, CAST(sum_surcharge AS VARCHAR) AS total_surcharge,
       CAST(sum_sales_tax AS VARCHAR) AS total_sales_tax,
       CAST(sum_venue_fee AS VARCHAR) AS total_service_charge
FROM manifest_split
UNION ALL
SELECT event_id, 1, '', '', '', '', '', '', CAST(total_sold AS VARCHAR),
       CAST(total_bar_card AS VARCHAR), CAST(total_face_value AS VARCHAR),
       CAST(total_let AS VARCHAR), CAST(total_surcharge AS VARCHAR),
       CAST(total_sales_tax AS VARCHAR), CAST(total_venue_fee AS VARCHAR)
FROM manifest_totals"""
ORACLE["manifest_csv_surcharge"] = _with_extra(MANIFEST_LINES, f"SELECT * FROM ({_CSV_DETAIL})")
ORACLE["manifest_csv_final"] = _with_extra(
    MANIFEST_LINES, f"SELECT * EXCLUDE (total_surcharge) FROM ({_CSV_DETAIL})")

# --- facts -------------------------------------------------------------------
def _c(col: str) -> str:
    return coalesced(col)


ORACLE["ticket_fact"] = with_fx(f"""
SELECT o.id AS ticketsauce_order_id, c.payment_intent AS stripe_charge_payment_intent,
       COALESCE(c.payment_intent, o.id) AS order_id, e.organization_name AS venue_title,
       e.name AS event_title, lower(e.name) AS lowercase_event_title,
       CAST(CAST(e.start AS TIMESTAMP) AS DATE) AS event_date, 1 AS quantity,
       CAST({_c('t.price')} AS {R}) AS shared_price_per_ticket,
       CAST({_c('t.price')} AS {R}) AS face_value_subtotal,
       CAST({_c('t.surcharge')} AS {R}) AS shared_surcharge,
       CAST({_c('t.let_tax')} AS {R}) AS shared_let_tax_amount_currency,
       CAST({_c('t.sales_tax')} AS {R}) AS sales_tax_currency,
       CAST({_c('t.venue_fee')} AS {R}) AS service_charge_currency,
       0 AS donation_charity,
       CAST({_c('t.price')} + {_c('t.surcharge')} + {_c('t.let_tax')} + {_c('t.sales_tax')}
            + {_c('t.venue_fee')} AS {R}) AS total,
       t.ticket_type_name, lower(t.ticket_type_name) AS lowercase_ticket_type_name,
       t.ticket_type_id, t.ticket_type_name AS ticket_holder_name,
       o.first_name AS order_first_name, o.last_name AS order_last_name,
       CAST(o.paid_date_utc AS TIMESTAMP) AS "final_at_UTC", 'false' AS void,
       'Stripe' AS payment_gateway, '' AS learned_from, t.id AS id,
       CAST(o.paid_date_utc AS TIMESTAMP) AS "created_at_UTC", o.event_id AS event_id,
       t.redeemed AS ticket_redeemed, t.promo_code AS ticket_promo_code
FROM fx_events e JOIN fx_orders o ON e.id = o.event_id
JOIN fx_tickets t ON t.order_id = o.id
LEFT JOIN fx_charges c ON o.id = c.ticketsauce_order_id""")

_SUBTOTAL = (f"CAST(CAST(o.total_paid AS {M}) - ({_c('o.fee_surcharge')} + {_c('o.fee_let_tax')}"
             f" + {_c('o.fee_sales_tax')} + {_c('o.fee_venue_fee')}) AS {R})")

ORACLE["order_subtotals"] = with_fx(f"SELECT o.id AS order_id, {_SUBTOTAL} AS subtotal FROM fx_orders o")

ORACLE["order_fact"] = with_fx(f"""
SELECT o.id AS ticketsauce_order_id, c.payment_intent AS stripe_charge_payment_intent,
       e.organization_name AS venue_title, e.name AS event_title,
       lower(e.name) AS lowercase_event_title,
       CAST(CAST(e.start AS TIMESTAMP) AS DATE) AS event_date,
       CAST(SUM(COALESCE(n.n_tickets, 0)) AS BIGINT) AS quantity,
       os.subtotal AS subtotal,
       COALESCE(o.fee_surcharge, '0.00') AS surcharge, COALESCE(o.fee_let_tax, '0.00') AS "LET",
       COALESCE(o.fee_sales_tax, '0.00') AS sales_tax,
       COALESCE(o.fee_venue_fee, '0.00') AS service_charge,
       0 AS donation_charity, o.total_paid AS total_paid,
       o.first_name AS order_first_name, o.last_name AS order_last_name, o.email AS order_email,
       o.opted_in AS opted_in, o.opted_in_sms AS opted_in_sms,
       CAST(o.paid_date_utc AS TIMESTAMP) AS "final_at_UTC", 'false' AS void,
       'Stripe' AS payment_gateway, '' AS learned_from,
       CAST(o.paid_date_utc AS TIMESTAMP) AS "created_at_UTC", o.event_id AS event_id
FROM fx_events e JOIN fx_orders o ON e.id = o.event_id
LEFT JOIN fx_charges c ON o.id = c.ticketsauce_order_id
LEFT JOIN (SELECT o.id AS order_id, {_SUBTOTAL} AS subtotal FROM fx_orders o) os ON o.id = os.order_id
LEFT JOIN (SELECT order_id, COUNT(*) AS n_tickets FROM fx_tickets GROUP BY order_id) n
  ON o.id = n.order_id
GROUP BY o.id, c.payment_intent, e.organization_name, e.name, e.start, o.fee_surcharge,
         o.fee_let_tax, o.fee_sales_tax, o.fee_venue_fee, o.total_paid, o.first_name, o.email,
         o.opted_in, o.opted_in_sms, o.last_name, o.paid_date_utc, o.event_id, os.subtotal""")


def _remit_sql(conv) -> str:
    cols = ", ".join([
        f"CAST({conv('t.price')} AS {R}) AS price_per_ticket",
        f"CAST({conv('t.surcharge')} AS {R}) AS surcharge_per_ticket",
        f"CAST({conv('t.let_tax')} AS {R}) AS let_per_ticket",
        f"CAST({conv('t.venue_fee')} AS {R}) AS service_charge_per_ticket",
        f"CAST({conv('t.sales_tax')} AS {R}) AS sales_tax_per_ticket",
        "COUNT(*) AS sold",
        f"CAST(SUM({conv('t.price')}) AS {W}) AS face_value_admissions_total",
        f"CAST(SUM({conv('t.let_tax')}) AS {W}) AS let_total",
        f"CAST(SUM({conv('t.venue_fee')}) AS {W}) AS service_charge_total",
        f"CAST(SUM({conv('t.surcharge')}) AS {W}) AS surcharge_total",
        f"CAST(SUM({conv('t.sales_tax')}) AS {W}) AS sales_tax_total",
    ])
    return with_fx(f"""
SELECT strftime(CAST(e.start AS TIMESTAMP), '%y/%m/%d') || ' ' || e.name AS event_details,
       CAST(CAST(e.start AS TIMESTAMP) AS DATE) AS event_date,
       e.organization_name AS venue, e.name AS event, t.ticket_type_id, t.ticket_type_name,
       {cols}
FROM fx_events e JOIN fx_orders o ON e.id = o.event_id
JOIN fx_tickets t ON t.order_id = o.id
LEFT JOIN fx_charges c ON o.id = c.ticketsauce_order_id
GROUP BY e.start, e.organization_name, e.name, t.ticket_type_id, t.ticket_type_name, t.price,
         t.surcharge, t.let_tax, t.venue_fee, t.sales_tax""")


ORACLE["remit_original"] = _remit_sql(lambda c: f"CAST({c} AS {M})")
ORACLE["remit_new"] = _remit_sql(lambda c: f"CAST(COALESCE({c}, '0.00') AS {M})")

ORACLE["marketing_original"] = with_fx("""
SELECT e.organization_name AS venue_name, e.name AS event_name,
       MAX(CAST(e.start AS TIMESTAMP)) AS event_date, o.id AS ticketsauce_order_id,
       MAX(o.first_name) AS first_name, MAX(o.last_name) AS last_name, o.email AS email,
       MAX(o.phone) AS phone, MAX(o.opted_in) AS opted_in, MAX(o.opted_in_sms) AS opted_in_sms,
       t.ticket_type_name AS ticket_type_name
FROM fx_events e JOIN fx_orders o ON e.id = o.event_id JOIN fx_tickets t ON t.order_id = o.id
GROUP BY e.organization_name, e.name, o.id, o.email, t.ticket_type_name""")

ORACLE["marketing_new"] = with_fx("""
SELECT e.organization_name AS venue_name, e.name AS event_name,
       CAST(e.start AS TIMESTAMP) AS event_date, o.id AS ticketsauce_order_id,
       o.first_name, o.last_name, o.email, o.phone, o.opted_in, o.opted_in_sms,
       t.ticket_type_name AS ticket_type_name
FROM fx_events e JOIN fx_orders o ON e.id = o.event_id JOIN fx_tickets t ON t.order_id = o.id
GROUP BY ALL""")

ORACLE["bi_ticket_dataset"] = with_fx(f"""
SELECT o.id AS ticketsauce_order_id, c.payment_intent AS stripe_charge_payment_intent,
       COALESCE(c.payment_intent, o.id) AS order_id, e.organization_name AS venue_title,
       e.name AS event_title, CAST(CAST(e.start AS TIMESTAMP) AS DATE) AS event_date,
       1 AS quantity, t.price AS shared_price_per_ticket, t.price AS face_value_subtotal,
       o.fee_surcharge AS shared_surcharge, o.fee_let_tax AS shared_let_tax_amount_currency,
       o.fee_sales_tax AS sales_tax_currency, o.fee_venue_fee AS service_charge_currency,
       0 AS donation_charity,
       CAST({_c('t.price')} + {_c('o.fee_surcharge')} + {_c('o.fee_let_tax')}
            + {_c('o.fee_sales_tax')} + {_c('o.fee_venue_fee')} AS {R}) AS total,
       t.ticket_type_name, t.ticket_type_id, t.ticket_type_name AS ticket_holder_name,
       o.first_name AS order_first_name, o.last_name AS order_last_name,
       CAST(o.paid_date_utc AS TIMESTAMP) AS "final_at_UTC", 'false' AS void,
       'Stripe' AS payment_gateway, '' AS learned_from, t.id AS id,
       CAST(o.paid_date_utc AS TIMESTAMP) AS "created_at_UTC", o.event_id AS event_id,
       t.redeemed AS ticket_redeemed, t.promo_code AS ticket_promo_code
FROM fx_events e JOIN fx_orders o ON e.id = o.event_id
JOIN fx_tickets t ON t.order_id = o.id
LEFT JOIN fx_charges c ON o.id = c.ticketsauce_order_id""")

# --- ingest ------------------------------------------------------------------
import datetime as _dt  # noqa: E402

from boxoffice.params import AS_OF as _AS_OF_DT  # noqa: E402


def _ts_sql(x: _dt.datetime) -> str:
    return f"TIMESTAMP '{x:%Y-%m-%d %H:%M:%S}'"


_FEES_SQL = """
  CASE WHEN k % 19 = 0 THEN NULL WHEN k % 12 = 0 THEN '1.00' END AS ticketing_fee,
  CASE WHEN k % 19 = 0 THEN NULL ELSE fee_surcharge END AS surcharge,
  CASE WHEN k % 19 = 0 THEN NULL
       ELSE COALESCE(fee_let_tax, CASE WHEN k % 10 = 0 THEN '9.99' END) END AS let_tax,
  CASE WHEN k % 19 = 0 THEN NULL ELSE fee_sales_tax END AS sales_tax,
  CASE WHEN k % 19 = 0 THEN NULL ELSE fee_venue_fee END AS venue_fee,
  CASE WHEN k % 19 = 0 THEN NULL WHEN k % 8 = 0 THEN '2.00' END AS admin_fee_not_a_gratuity_,
  CASE WHEN k % 19 = 0 THEN NULL WHEN k % 9 = 0 THEN '5.00' END AS gratuity"""

ORACLE["fees_normalized"] = with_fx(f"""
SELECT id AS order_id, {_FEES_SQL}
FROM (SELECT *, CAST(id AS BIGINT) AS k FROM fx_orders)""")

ORACLE["orders_enriched"] = with_fx(f"""
SELECT id, event_id, total_paid, first_name, last_name, email, phone, opted_in, opted_in_sms,
       paid_date_utc, {_FEES_SQL}
FROM (SELECT *, CAST(id AS BIGINT) AS k FROM fx_orders)""")

_FACE_VALUE = f"""
SELECT order_id, CAST(CAST(SUM({coalesced('price')}) AS {W}) AS VARCHAR) AS order_total_face_value
FROM fx_tickets GROUP BY order_id"""
ORACLE["order_face_value"] = with_fx(_FACE_VALUE)

ORACLE["tickets_flat"] = with_fx(f"""
SELECT t.id, t.order_id, o.event_id, t.price, t.ticket_type_name AS name, t.ticket_type_id,
       t.ticket_type_name, t.price AS ticket_type_price, t.ticket_type_price_id, t.redeemed,
       t.promo_code, o.total_paid AS order_total_paid, fv.order_total_face_value,
       CAST(NULL AS VARCHAR) AS ticketing_fee, t.surcharge, t.let_tax, t.sales_tax, t.venue_fee,
       CAST(NULL AS VARCHAR) AS admin_fee_not_a_gratuity_, CAST(NULL AS VARCHAR) AS gratuity
FROM fx_tickets t JOIN fx_orders o ON t.order_id = o.id
JOIN ({_FACE_VALUE}) fv ON fv.order_id = t.order_id""")

ORACLE["tickets_unnested"] = ORACLE["tickets_flat"]
# the order's fees as its raw fee object has them
ORACLE["bi_ticket_unnested"] = ORACLE["bi_ticket_dataset"].replace("JOIN fx_orders o ON", f"""JOIN (
  SELECT * EXCLUDE (fee_surcharge, fee_let_tax, fee_sales_tax, fee_venue_fee, ticketing_fee, surcharge, let_tax, sales_tax, venue_fee,
                    admin_fee_not_a_gratuity_, gratuity, k),
         surcharge AS fee_surcharge, let_tax AS fee_let_tax, sales_tax AS fee_sales_tax, venue_fee AS fee_venue_fee
  FROM (SELECT *, {_FEES_SQL} FROM (SELECT *, CAST(id AS BIGINT) AS k FROM fx_orders))) o ON""")

ORACLE["ticket_types_dim"] = with_fx("""
SELECT ticket_type_id, ticket_type_price_id, event_id,
       arg_min(ticket_type_name, id) AS ticket_type_name, arg_min(price, id) AS ticket_type_price
FROM fx_tickets GROUP BY event_id, ticket_type_id, ticket_type_price_id""")

ORACLE["checkins"] = with_fx("SELECT id AS ticket_id, event_id FROM fx_tickets WHERE redeemed")

ORACLE["events_without_orders"] = with_fx("""
SELECT * FROM fx_events e WHERE NOT EXISTS (SELECT 1 FROM fx_orders o WHERE o.event_id = e.id)""")


def events_in_range_sql(lo, hi) -> str:
    conds = []
    d = "CAST(CAST(start AS TIMESTAMP) AS DATE)"
    if lo is not None:
        conds.append(f"{d} >= DATE '{lo}'")
    if hi is not None:
        conds.append(f"{d} <= DATE '{hi}'")
    where = " AND ".join(conds) if conds else "TRUE"
    return with_fx(f"SELECT * FROM fx_events WHERE {where}")


def charges_in_range_sql(since: _dt.datetime) -> str:
    return with_fx(f"SELECT * FROM fx_charges WHERE created >= {_ts_sql(since)}")


_SLUG = "lower(regexp_replace({}, '[^0-9A-Za-z]+', '-', 'g'))"

def numbered_sql(rows: str, order: str, size: int) -> str:
    """Rows (id, event_id) with the page of ``size`` rows that they are listed on."""
    return f"SELECT *, (row_number() OVER (PARTITION BY event_id ORDER BY {order}) - 1) // {size} + 1 AS page_no FROM ({rows})"


_LISTED_ORDERS = numbered_sql("SELECT id, event_id FROM fx_orders", "CAST(id AS BIGINT)", 100)
_LISTED_CHECKINS = numbered_sql("SELECT id, order_id, event_id FROM fx_tickets WHERE redeemed", "CAST(order_id AS BIGINT), id", 5000)
ORACLE["pages_flatten"] = with_fx(f"SELECT id, event_id, page_no FROM ({_LISTED_ORDERS})")
ORACLE["checkin_pages_flatten"] = with_fx(f"SELECT id AS ticket_id, event_id, page_no FROM ({_LISTED_CHECKINS})")


def page_audit_sql(listed: str, size: int) -> str:
    # a stray page follows the end of the events 3 modulo 17; a list that ends with a full page has an empty one
    return with_fx(f"""
SELECT event_id, count(*) // {size} + 1 AS end_page, count(*) AS n_rows, count(*) // {size} + 1 AS n_pages,
       CAST(0 AS BIGINT) AS missing, CAST(CASE WHEN CAST(event_id AS BIGINT) % 17 = 3 THEN 1 ELSE 0 END AS BIGINT) AS after_end
FROM ({listed}) GROUP BY event_id""")


ORACLE["order_page_audit"] = page_audit_sql(_LISTED_ORDERS, 100)
ORACLE["checkin_page_audit"] = page_audit_sql(_LISTED_CHECKINS, 5000)

_VENUE = f"coalesce({_SLUG.format('organization_name')}, 'unknown')"  # where an event without a name lies

_EVENT_PARTS = f"""
SELECT 'events' AS table_name, {_SLUG.format('id')} AS key,
       {_VENUE} AS venue,
       strftime(CAST(start AS TIMESTAMP), '%Y') AS year,
       strftime(CAST(start AS TIMESTAMP), '%B') AS month,
       strftime(CAST(start AS TIMESTAMP), '%d') AS day, CAST(start AS TIMESTAMP) AS st
FROM fx_events"""

ORACLE["partition_columns"] = with_fx(f"""
SELECT table_name, key, venue, year, month, day FROM ({_EVENT_PARTS})
UNION ALL
SELECT 'stripe_charges', {_SLUG.format('id')}, 'unknown', strftime(created, '%Y'),
       strftime(created, '%B'), strftime(created, '%-d')
FROM fx_charges""")

ORACLE["new_partitions"] = with_fx(f"""
SELECT DISTINCT venue, year, month, day FROM ({_EVENT_PARTS}) WHERE st > {AS_OF}
EXCEPT
SELECT venue, year, month, day FROM ({_EVENT_PARTS}) WHERE st <= {AS_OF}""")

# --- daily report ------------------------------------------------------------
_RECENT = f"CAST(o.paid_date_utc AS TIMESTAMP) >= {AS_OF} - INTERVAL 24 HOUR"

ORACLE["party_pass_weekly"] = with_fx(f"""
SELECT strftime(date_trunc('week', CAST(e.start AS TIMESTAMP)), '%Y-%m-%d') AS week_start,
       t.ticket_type_name,
       CAST(MIN(CAST(t.price AS {M})) AS {R}) AS price,
       COUNT(*) AS tickets_sold,
       COUNT(CASE WHEN {_RECENT} THEN 1 END) AS sales_last_24_hours
FROM fx_tickets t JOIN fx_events e ON t.event_id = e.id JOIN fx_orders o ON t.order_id = o.id
WHERE lower(t.ticket_type_name) LIKE '%party pass%'
  AND CAST(e.start AS TIMESTAMP) > {AS_OF}
  AND CAST(e.start AS TIMESTAMP) <= {AS_OF} + INTERVAL 60 DAY
  AND e.organization_id IN {VENUES_SQL}
GROUP BY 1, 2""")

_UPCOMING = f"""
SELECT e.name AS event_name, e.organization_name AS venue_name,
       CAST(CAST(e.start AS TIMESTAMP) AS DATE) AS event_date, t.ticket_type_name,
       CAST(CAST(t.price AS {M}) AS {R}) AS price,
       COUNT(*) AS quantity_sold,
       COUNT(CASE WHEN {_RECENT} THEN 1 END) AS sales_last_24_hours
FROM fx_events e JOIN fx_orders o ON e.id = o.event_id JOIN fx_tickets t ON o.id = t.order_id
WHERE CAST(e.start AS TIMESTAMP) BETWEEN {AS_OF} AND {AS_OF} + INTERVAL 60 DAY
  AND e.organization_id IN {VENUES_SQL}
GROUP BY 1, 2, 3, 4, 5"""
ORACLE["upcoming_sales"] = with_fx(_UPCOMING)

ORACLE["sales_rollup"] = with_fx(f"""
SELECT CASE WHEN GROUPING(event_name) = 1 THEN 'venue'
            WHEN GROUPING(ticket_type_name) = 1 THEN 'event' ELSE 'line' END AS level,
       week_start, week_start + 6 AS week_end, venue_name, event_name,
       CASE WHEN GROUPING(ticket_type_name) = 1 THEN MAX(event_date) ELSE event_date END AS event_date,
       ticket_type_name, price,
       CAST(SUM(quantity_sold) AS BIGINT) AS quantity_sold,
       CAST(SUM(sales_last_24_hours) AS BIGINT) AS sales_last_24_hours
FROM (SELECT *, event_date - CAST(dayofweek(event_date) AS INTEGER) AS week_start
      FROM ({_UPCOMING}))
GROUP BY GROUPING SETS ((week_start, venue_name, event_name, event_date, ticket_type_name, price),
                        (week_start, venue_name, event_name), (week_start, venue_name))""")

_SHORT_VENUE = "replace(replace(replace(lower(location), ' ', '_'), 'nightclub', 'nc'), 'dayclub', 'day')"

ORACLE["scalar_probe"] = with_fx(f"""
SELECT id, {_SLUG.format('organization_name')} AS venue_slug,
       lower(regexp_replace(name, '[^0-9A-Za-z]+', '_', 'g')) AS name_underscore,
       CAST(date_trunc('week', s) AS DATE) AS week_start_mon,
       CAST(s AS DATE) - CAST(dayofweek(s) AS INTEGER) AS week_start_sun,
       CAST(CAST(s AS DATE) - CAST(dayofweek(s) AS INTEGER) + 1 AS VARCHAR) || ' to '
         || CAST(CAST(s AS DATE) - CAST(dayofweek(s) AS INTEGER) + 7 AS VARCHAR) AS week_label,
       s + INTERVAL 8 HOUR AS start_as_utc,
       su - INTERVAL 8 HOUR AS start_utc_as_pacific,
       strftime(s, '%y/%m/%d') AS yy_mm_dd, strftime(s, '%m-%d-%Y') AS display_date,
       strftime(s, '%m%d%Y') AS filename_date, upper(strftime(s, '%a %d-%b')) AS subject_date,
       strftime(s, '%I:%M%p') AS open_time_12h, strftime(s, '%b%d_%H:%M') AS short_local_start,
       CASE WHEN length(strftime(s, '%b%d_%H:%M') || '_' || {_SHORT_VENUE}) >= 25
            THEN strftime(s, '%b%d_%H:%M') || '_' || {_SHORT_VENUE}
            ELSE rpad(strftime(s, '%b%d_%H:%M') || '_' || {_SHORT_VENUE}, 25, '_') END AS padded_label,
       {_SHORT_VENUE} AS short_venue, replace(location, ' ', '') AS venue_no_spaces,
       strftime(su, '%Y-%m-%dT%H:%M:%S.%gZ') AS iso_instant,
       strftime(su, '%Y-%m-%d %H:%M') AS utc_minutes
FROM (SELECT *, CAST(start AS TIMESTAMP) AS s, CAST(start_utc AS TIMESTAMP) AS su FROM fx_events)""")

# --- delivery ----------------------------------------------------------------


def candidates_sql(as_of: _dt.datetime) -> str:
    lo = (as_of - _dt.timedelta(days=2)).date()
    hi = (as_of + _dt.timedelta(days=2)).date()
    return f"""
SELECT location AS venue, name AS event_title, id AS event_id,
       CAST(CAST(start AS TIMESTAMP) AS DATE) AS event_date,
       CAST(start_utc AS TIMESTAMP) AS event_start_utc_timestamp,
       CAST(start AS TIMESTAMP) AS local_event_start_timestamp
FROM fx_events WHERE organization_id IN {VENUES_SQL}
  AND CAST(CAST(start AS TIMESTAMP) AS DATE) BETWEEN DATE '{lo}' AND DATE '{hi}'"""


_ABSTRACT = """CASE WHEN report_status IS NULL OR report_status = 'initialized' THEN 'eligible_for_preliminary'
     WHEN report_status = 'report_canceled' THEN 'report_canceled'
     WHEN report_status = 'final_sent' THEN 'final_already_sent'
     WHEN report_status = 'prelim_sent' THEN 'eligible_for_final' ELSE 'unknown' END"""


def categories_sql(as_of: _dt.datetime, control: str = "fx_control") -> str:
    final_cut = _ts_sql(as_of)
    prelim_cut = _ts_sql(as_of + _dt.timedelta(days=1))
    due = "c.event_start_utc_timestamp + INTERVAL 6 MINUTE"
    return f"""
SELECT * FROM (
SELECT c.event_id, c.venue, c.event_title, c.event_date, c.event_start_utc_timestamp,
       c.local_event_start_timestamp, k.report_status,
       CASE WHEN k.report_status = 'report_canceled' THEN 'report_canceled'
            WHEN k.report_status = 'final_sent' THEN 'final_already_sent'
            WHEN k.report_status = 'prelim_sent' THEN
              CASE WHEN {due} <= {final_cut} THEN 'send_final' ELSE 'no_action_waiting_to_send_final' END
            WHEN k.report_status IS NULL OR k.report_status = 'initialized' THEN
              CASE WHEN {due} <= {prelim_cut} THEN 'send_preliminary' ELSE 'preliminary_is_not_yet_due' END
       END AS category
FROM ({candidates_sql(as_of)}) c LEFT JOIN {control} k ON k.event_key = c.event_id)
WHERE category IS NOT NULL"""


_A = _AS_OF_DT
ORACLE["candidate_events"] = with_fx(candidates_sql(_A))
ORACLE["control_rows_for_events"] = with_fx(f"""
SELECT * FROM fx_control WHERE event_key IN (SELECT event_id FROM ({candidates_sql(_A)}))""")
ORACLE["control_rows_missing"] = with_fx(f"""
SELECT event_id FROM ({candidates_sql(_A)}) c
WHERE NOT EXISTS (SELECT 1 FROM fx_control k WHERE k.event_key = c.event_id)""")
ORACLE["delivery_categories"] = with_fx(categories_sql(_A))
ORACLE["delivery_status_labels"] = with_fx(f"""
SELECT c.event_id, c.event_title, c.event_date, {_ABSTRACT} AS control_row_status_abstract,
       COALESCE(report_status, 'control_row_does_not_exist') AS report_status_raw
FROM ({candidates_sql(_A)}) c LEFT JOIN fx_control k ON k.event_key = c.event_id""")


def preview_sql(as_of: _dt.datetime, label: str) -> str:
    prelim_cut = as_of + _dt.timedelta(days=1)
    pac = _dt.timedelta(hours=8)  # January-February: Pacific = UTC-8
    label_expr = (f"strftime(local_event_start_timestamp, '%b%d_%H:%M') || '_' || "
                  f"replace(replace(replace(lower(venue), ' ', '_'), 'nightclub', 'nc'), 'dayclub', 'day')")
    return f"""
SELECT '{label}' AS preview, '{as_of:%Y-%m-%d %H:%M:%S}' AS reference_time_in,
       '{prelim_cut:%Y-%m-%d %H:%M:%S}' AS preliminary_cutoff_utc,
       '{as_of:%Y-%m-%d %H:%M:%S}' AS final_cutoff_utc,
       '{prelim_cut - pac:%Y-%m-%d %H:%M}' AS preliminary_cutoff_local,
       '{as_of - pac:%Y-%m-%d %H:%M}' AS final_cutoff_local,
       category, event_id, event_title, strftime(event_date, '%Y-%m-%d') AS event_date,
       strftime(event_start_utc_timestamp, '%Y-%m-%d %H:%M:%S') AS event_start_utc_string,
       strftime(local_event_start_timestamp, '%Y-%m-%d %H:%M:%S') AS local_event_start_string,
       {_ABSTRACT} AS control_row_status_abstract,
       COALESCE(report_status, 'control_row_does_not_exist') AS report_status_raw,
       CASE WHEN length({label_expr}) >= 25 THEN {label_expr} ELSE rpad({label_expr}, 25, '_') END
         || '_' || {_ABSTRACT} AS abbreviated_summary
FROM ({categories_sql(as_of)})"""


_PREVIEW = _dt.datetime(2024, 1, 16, 6, 31)  # 22:31 Pacific on the day of AS_OF

ORACLE["schedule_preview"] = with_fx(
    f"{preview_sql(_A, 'current_state')}\nUNION ALL\n{preview_sql(_PREVIEW, 'upcoming_schedule')}")

ORACLE["control_initialize"] = with_fx(f"""
SELECT * FROM fx_control
UNION ALL
SELECT event_id, 'initialized', CAST(NULL AS TIMESTAMP), CAST(NULL AS TIMESTAMP)
FROM ({candidates_sql(_A)}) c
WHERE NOT EXISTS (SELECT 1 FROM fx_control k WHERE k.event_key = c.event_id)""")

_PRICED = "(SELECT event_id FROM fx_tickets WHERE COALESCE(CAST(price AS DECIMAL(10,2)), 0.00) > 0.00)"


def outcomes_sql(as_of: _dt.datetime, control: str = "fx_control") -> str:
    k = "CAST(event_id AS BIGINT)"
    return f"""
SELECT event_id, venue, category,
       CASE WHEN category = 'send_preliminary' THEN {k} % 9 <> 0 END AS preliminary_sent,
       CASE WHEN category = 'send_final' THEN {k} % 13 <> 0 END AS accounting_sent,
       CASE WHEN category = 'send_final' AND {k} % 13 <> 0 THEN {k} % 11 <> 0 END AS final_sent,
       event_id NOT IN {_PRICED} AS manifest_empty,
       CASE WHEN category = 'send_preliminary' THEN
              CASE WHEN {k} % 9 <> 0 THEN 'preliminary_succeeded' ELSE 'preliminary_failed' END
            WHEN {k} % 13 <> 0 AND {k} % 11 <> 0 THEN 'final_succeeded' ELSE 'final_failed' END AS outcome
FROM ({categories_sql(as_of, control)}) WHERE category IN ('send_preliminary', 'send_final')"""


def after_tick_sql(as_of: _dt.datetime, control: str) -> str:
    """Control table after one tick at ``as_of`` starting from table ``control``."""
    changed = f"(SELECT * FROM ({outcomes_sql(as_of, control)}) WHERE manifest_empty OR outcome LIKE '%succeeded')"
    prelim = "(o.manifest_empty OR o.outcome = 'preliminary_succeeded')"
    return f"""
SELECT * FROM {control} WHERE event_key NOT IN (SELECT event_id FROM {changed})
UNION ALL
SELECT o.event_id AS event_key,
       CASE WHEN {prelim} THEN 'prelim_sent' ELSE 'final_sent' END AS report_status,
       CASE WHEN {prelim} THEN {_ts_sql(as_of)} ELSE k.preliminary_sent_at END AS preliminary_sent_at,
       CASE WHEN {prelim} THEN k.final_sent_at ELSE {_ts_sql(as_of)} END AS final_sent_at
FROM {changed} o LEFT JOIN {control} k ON k.event_key = o.event_id"""


ORACLE["delivery_outcomes"] = with_fx(outcomes_sql(_A))
ORACLE["control_after_batch"] = with_fx(after_tick_sql(_A, "fx_control"))

_CMD_OPS = ["cancel", "mark_preliminary_sent", "mark_final_sent",
            "force_reset_to_preliminary_sent", "force_forward_to_final_sent", "delete"]
_CMD_LIST = "[" + ", ".join(f"'{o}'" for o in _CMD_OPS) + "]"
_FINAL_TOUCH = "('mark_final_sent', 'force_reset_to_preliminary_sent', 'force_forward_to_final_sent')"
_FINAL_SET = "('mark_final_sent', 'force_forward_to_final_sent')"

_CMD_CTES = f"""
cmds AS (
  SELECT CAST(c_custkey AS VARCHAR) AS event_key, 1 AS seq, {_CMD_LIST}[c_custkey % 11 + 1] AS op
  FROM customer WHERE c_custkey % 11 < 6
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 2, 'mark_preliminary_sent' FROM customer
  WHERE c_custkey % 22 = 0
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), 3, 'mark_final_sent' FROM customer
  WHERE c_custkey % 33 = 0),
c2 AS (
  SELECT *, {AS_OF} + seq * INTERVAL 1 MINUTE AS at,
         CASE op WHEN 'cancel' THEN 'report_canceled' WHEN 'mark_preliminary_sent' THEN 'prelim_sent'
                 WHEN 'mark_final_sent' THEN 'final_sent'
                 WHEN 'force_reset_to_preliminary_sent' THEN 'prelim_sent'
                 WHEN 'force_forward_to_final_sent' THEN 'final_sent' END AS status_new
  FROM cmds),
g AS (
  SELECT event_key, max(seq) FILTER (WHERE op = 'delete') AS last_delete,
         max(seq) AS last_seq,
         max(seq) FILTER (WHERE op <> 'delete') AS st_s,
         max(seq) FILTER (WHERE op = 'mark_preliminary_sent') AS pr_s,
         max(seq) FILTER (WHERE op IN {_FINAL_TOUCH}) AS fi_s
  FROM c2 GROUP BY event_key),
j AS (
  SELECT g.*, lo.op AS last_op, st.status_new AS st_v, pr.at AS pr_v,
         CASE WHEN fi.op IN {_FINAL_SET} THEN fi.at END AS fi_v,
         k.report_status AS o_st, k.preliminary_sent_at AS o_pr, k.final_sent_at AS o_fi
  FROM g
  JOIN c2 lo ON lo.event_key = g.event_key AND lo.seq = g.last_seq
  LEFT JOIN c2 st ON st.event_key = g.event_key AND st.seq = g.st_s
  LEFT JOIN c2 pr ON pr.event_key = g.event_key AND pr.seq = g.pr_s
  LEFT JOIN c2 fi ON fi.event_key = g.event_key AND fi.seq = g.fi_s
  LEFT JOIN fx_control k ON k.event_key = g.event_key)"""
ORACLE["control_commands"] = _with_extra(_CMD_CTES, """
SELECT * FROM fx_control WHERE event_key NOT IN (SELECT event_key FROM g)
UNION ALL
SELECT event_key,
       CASE WHEN st_s IS NOT NULL AND (last_delete IS NULL OR st_s > last_delete) THEN st_v
            WHEN last_delete IS NULL THEN o_st END,
       CASE WHEN pr_s IS NOT NULL AND (last_delete IS NULL OR pr_s > last_delete) THEN pr_v
            WHEN last_delete IS NULL THEN o_pr END,
       CASE WHEN fi_s IS NOT NULL AND (last_delete IS NULL OR fi_s > last_delete) THEN fi_v
            WHEN last_delete IS NULL THEN o_fi END
FROM j WHERE last_op <> 'delete'""")


ORACLE["events_in_range"] = events_in_range_sql(_dt.date(2024, 1, 14), _dt.date(2024, 1, 17))
ORACLE["charges_in_range"] = charges_in_range_sql(_A - _dt.timedelta(days=1))

ORACLE["delivery_routing"] = with_fx(f"""
SELECT c.event_id, c.venue, c.category, v.report_variant,
       CASE v.report_variant WHEN 'preliminary' THEN 'preliminary-list@example.com'
            WHEN 'accounting' THEN 'accounting-list@example.com' ELSE r.final_address END AS to_address,
       (CASE v.report_variant WHEN 'preliminary' THEN 'preliminary-list@example.com'
             WHEN 'accounting' THEN 'accounting-list@example.com' ELSE r.final_address END)
         IS NOT NULL AS routable
FROM ({categories_sql(_A)}) c
JOIN (VALUES ('send_preliminary', 'preliminary'), ('send_final', 'accounting'),
             ('send_final', 'final')) v(category, report_variant) ON v.category = c.category
LEFT JOIN (SELECT n_name || ' Hall' AS venue,
                  'team-' || CAST(n_nationkey AS VARCHAR) || '@example.com' AS final_address
           FROM nation WHERE n_nationkey <> 24) r ON r.venue = c.venue""")

ORACLE["empty_manifests"] = _with_extra(MANIFEST_LINES, f"""
SELECT event_id, venue, event_title, category, 'prelim_sent' AS report_status_after,
       {AS_OF} AS preliminary_sent_at_after
FROM ({categories_sql(_A)}) c
WHERE category IN ('send_preliminary', 'send_final')
  AND NOT EXISTS (SELECT 1 FROM manifest_lines m WHERE m.event_id = c.event_id)""")

ORACLE["charges_extract"] = with_fx("SELECT * FROM fx_charges")

# --- landing and streams -----------------------------------------------------


_TICK2 = _A + _dt.timedelta(minutes=5)
ORACLE["stream_delivery_tick"] = _with_extra(
    f"ctl1 AS ({after_tick_sql(_A, 'fx_control')}),\nctl2 AS ({after_tick_sql(_TICK2, 'ctl1')})",
    "SELECT * FROM ctl2")

_LO, _HI = (_A - _dt.timedelta(days=1)).date(), (_A + _dt.timedelta(days=2)).date()
_LANDED = f"""
SELECT id, name, organization_id, organization_name, location,
       CASE WHEN m THEN strftime(CAST(start AS TIMESTAMP) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
            ELSE start END AS start,
       CASE WHEN m THEN strftime(CAST(start_utc AS TIMESTAMP) + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S')
            ELSE start_utc END AS start_utc,
       CASE WHEN m THEN {AS_OF} ELSE {AS_OF} - INTERVAL 1 HOUR END AS ingested_at
FROM (SELECT *, CAST(CAST(start AS TIMESTAMP) AS DATE) BETWEEN DATE '{_LO}' AND DATE '{_HI}' AS m
      FROM fx_events)"""
ORACLE["landing_read"] = with_fx(f"""
SELECT *, {_VENUE} AS venue,
       strftime(CAST(start AS TIMESTAMP), '%Y') AS year,
       strftime(CAST(start AS TIMESTAMP), '%B') AS month,
       strftime(CAST(start AS TIMESTAMP), '%d') AS day
FROM ({_LANDED})""")
ORACLE["stream_snapshot_upsert"] = ORACLE["landing_read"]
ORACLE["landing_snapshot"] = ORACLE["landing_read"]  # replaced snapshots do not stay on disk

ORACLE["stream_sales_24h"] = with_fx("""
SELECT e.organization_name AS venue_name,
       CAST(o.paid_date_utc AS TIMESTAMP) - k.h * INTERVAL 1 HOUR AS window_start,
       CAST(o.paid_date_utc AS TIMESTAMP) - k.h * INTERVAL 1 HOUR + INTERVAL 24 HOUR AS window_end,
       COUNT(*) AS tickets_sold
FROM fx_tickets t JOIN fx_orders o ON t.order_id = o.id JOIN fx_events e ON t.event_id = e.id
CROSS JOIN range(24) AS k(h)
GROUP BY 1, 2, 3""")

# --- nested results in their text form (plans/registry.py) --------------------

_LINE_COLS = ["ticket_name", "price", "surcharge", "per_ticket_let", "quantity", "sum_subtotal",
              "sum_surcharge", "sum_let_tax", "let_tax_rate_observed", "sum_sales_tax",
              "sum_venue_fee", "sum_bar_card", "subtotal_minus_bar_card"]
_AS_TEXT = "concat_ws('|', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in _LINE_COLS) + ")"
ORACLE["manifest_document"] = _with_extra(MANIFEST_LINES, f"""
SELECT d.*, t.* EXCLUDE (event_id), r.ticket_rows
FROM manifest_desc d JOIN manifest_totals t ON t.event_id = d.event_id
JOIN (SELECT event_id, string_agg({_AS_TEXT}, ';' ORDER BY ticket_name, price, surcharge, per_ticket_let) AS ticket_rows
      FROM manifest_split GROUP BY event_id) r ON r.event_id = d.event_id""")

_V = "CAST({0} AS VARCHAR)".format
ORACLE["sales_rollup_nested"] = _with_extra(f"""
u AS (SELECT *, event_date - CAST(dayofweek(event_date) AS INTEGER) AS week_start FROM ({_UPCOMING})),
ev AS (
  SELECT week_start, venue_name, event_name, MIN(event_date) AS first_date, MAX(event_date) AS last_date,
         SUM(quantity_sold) AS q, SUM(sales_last_24_hours) AS s,
         string_agg(concat_ws('|', {_V('event_date')}, ticket_type_name, {_V('price')}, {_V('quantity_sold')},
                              {_V('sales_last_24_hours')}), ';' ORDER BY event_date, ticket_type_name, price) AS tickets
  FROM u GROUP BY ALL)""", f"""
SELECT week_start, week_start + 6 AS week_end, venue_name, CAST(SUM(q) AS BIGINT) AS quantity_sold,
       CAST(SUM(s) AS BIGINT) AS sales_last_24_hours,
       string_agg(concat_ws('|', event_name, {_V('last_date')}, {_V('q')}, {_V('s')}, tickets), '#'
                  ORDER BY first_date, event_name) AS events
FROM ev GROUP BY week_start, venue_name""")

_UP_COLS = ["event_name", "venue_name", "event_date", "ticket_type_name", "price", "quantity_sold",
            "sales_last_24_hours"]
ORACLE["result_text_rows"] = with_fx(f"""
SELECT concat_ws(';', {", ".join(f"'{c}=' || {_V(c)}" for c in _UP_COLS)}) AS "row",
       concat_ws('|', {", ".join(_V(c) for c in _UP_COLS)}) AS cells FROM ({_UPCOMING})""")

# --- the six landed tables -----------------------------------------------------

_PLACES = f"""
SELECT id AS place_id, {_VENUE} AS venue,
       strftime(CAST(start AS TIMESTAMP), '%Y') AS year, strftime(CAST(start AS TIMESTAMP), '%B') AS month,
       strftime(CAST(start AS TIMESTAMP), '%d') AS day,
       CASE WHEN CAST(CAST(start AS TIMESTAMP) AS DATE) BETWEEN DATE '{_LO}' AND DATE '{_HI}'
            THEN {AS_OF} ELSE {AS_OF} - INTERVAL 1 HOUR END AS ingested_at
FROM fx_events"""


def landed_sql(rows: str, key: str = "event_id", drop: str = "place_id") -> str:
    return with_fx(f"SELECT * EXCLUDE ({drop}) FROM ({rows}) r JOIN ({_PLACES}) p ON p.place_id = r.{key}")


ORACLE["landing_events"] = landed_sql("SELECT * FROM fx_events", "id")
ORACLE["landing_orders"] = landed_sql(ORACLE["orders_enriched"])
ORACLE["landing_tickets"] = landed_sql(ORACLE["tickets_flat"])
ORACLE["landing_ticket_types"] = landed_sql(ORACLE["ticket_types_dim"])
ORACLE["landing_checkin_ids"] = landed_sql(ORACLE["checkins"], drop="place_id, event_id")
ORACLE["landing_charges"] = with_fx(f"""
SELECT *, 'unknown' AS venue, strftime(created, '%Y') AS year, strftime(created, '%B') AS month,
       strftime(created, '%-d') AS day,
       CASE WHEN created >= {AS_OF} - INTERVAL 1 DAY THEN {AS_OF} ELSE {AS_OF} - INTERVAL 1 HOUR END AS ingested_at
FROM fx_charges""")

# --- an event's new snapshot replaces the old one ---------------------------------
# Of the polled events' rows, by a number in their key modulo 7: 3 is gone, 4 has changed.


def replaced_sql(rows: str, number: str, key: str = "event_id", drop: str = "place_id", change: str = "r.*") -> str:
    n = f"CAST(regexp_extract({number}, '[0-9]+') AS BIGINT) % 7"
    polled = f"p.ingested_at = {AS_OF}"
    return with_fx(f"SELECT * EXCLUDE ({drop}) FROM (SELECT {change}, p.* FROM ({rows}) r JOIN ({_PLACES}) p ON p.place_id = r.{key} "
                   f"WHERE NOT ({polled} AND {n} = 3))")


_EMAIL = (f"r.* REPLACE (CASE WHEN p.ingested_at = {AS_OF} AND CAST(r.id AS BIGINT) % 7 = 4 THEN 'new-' || r.email ELSE r.email END AS email)")
ORACLE["landing_replaced_orders"] = replaced_sql(ORACLE["orders_enriched"], "r.id", change=_EMAIL)
ORACLE["landing_replaced_tickets"] = replaced_sql(ORACLE["tickets_flat"], "r.order_id")
ORACLE["landing_replaced_ticket_types"] = replaced_sql(ORACLE["ticket_types_dim"], "r.ticket_type_price_id")
ORACLE["landing_replaced_checkin_ids"] = replaced_sql(ORACLE["checkins"], "r.ticket_id", drop="place_id, event_id")
ORACLE["landing_changes"] = with_fx(f"""
SELECT o.id, CASE CAST(o.id AS BIGINT) % 7 WHEN 3 THEN 'vanish' WHEN 4 THEN 'update' ELSE 'insert' END AS change,
       CASE WHEN CAST(o.id AS BIGINT) % 7 <> 3 THEN {AS_OF} END AS ingested_at
FROM fx_orders o JOIN ({_PLACES}) p ON p.place_id = o.event_id
WHERE p.ingested_at = {AS_OF} AND CAST(o.id AS BIGINT) % 7 BETWEEN 3 AND 5""")

# --- reads of the landing --------------------------------------------------------
ORACLE["landing_manifest"] = ORACLE["event_manifest"]
ORACLE["landing_events_in_range"] = ORACLE["events_in_range"]

ORACLE["landing_new_partitions"] = ORACLE["new_partitions"]

# the second poll's events: 3 modulo 7 has a start that is no time, 2 modulo 11 is cut off
_POLLED = f"CAST(CAST(start AS TIMESTAMP) AS DATE) BETWEEN DATE '{_LO}' AND DATE '{_HI}'"
_NO_TIME, _CUT = "CAST(id AS BIGINT) % 7 = 3", "CAST(id AS BIGINT) % 11 = 2"
ORACLE["landing_drift"] = with_fx(f"""
SELECT * EXCLUDE (again), CASE WHEN again THEN CAST(id AS BIGINT) * 10 END AS capacity,
       CASE WHEN again THEN {AS_OF} ELSE {AS_OF} - INTERVAL 1 HOUR END AS ingested_at,
       {_VENUE} AS venue, strftime(CAST(start AS TIMESTAMP), '%Y') AS year,
       strftime(CAST(start AS TIMESTAMP), '%B') AS month, strftime(CAST(start AS TIMESTAMP), '%d') AS day
FROM (SELECT *, {_POLLED} AND NOT ({_NO_TIME}) AND NOT ({_CUT}) AS again FROM fx_events)""")
ORACLE["landing_quarantine"] = with_fx(f"""
SELECT id, CASE WHEN {_CUT} THEN 'no object' ELSE 'bad start' END AS reasons, {AS_OF} AS ingested_at
FROM fx_events WHERE {_POLLED} AND ({_NO_TIME} OR {_CUT})""")

# --- results with their header, in order -------------------------------------------
_CELLS = "concat_ws('|', " + ", ".join(_V(c) for c in _UP_COLS) + ")"
_NUMBERED = f"""
SELECT row_number() OVER (ORDER BY event_date, event_name, ticket_type_name, venue_name, price) AS row_no, * FROM ({_UPCOMING})"""
ORACLE["result_rows_in_order"] = with_fx(f"""
SELECT 0::BIGINT AS row_no, '{"|".join(_UP_COLS)}' AS cells
UNION ALL SELECT row_no, {_CELLS} FROM ({_NUMBERED})""")
ORACLE["result_flat_cells"] = with_fx("\nUNION ALL\n".join(
    f"SELECT {i}::BIGINT AS position, '{c}' AS cell\nUNION ALL SELECT row_no * {len(_UP_COLS)} + {i}, {_V(c)} FROM numbered"
    for i, c in enumerate(_UP_COLS)), {"numbered": _NUMBERED})
