"""Query registry: name -> function of the table bundle.

``queries()`` in ``__spark_entry__`` wraps each entry as ``(spark, sf_dir)``.
Every entry reads the driver tables (through the fixture derivation), so its
work grows with them; parameters (reference time, venues) are the fixed run
parameters of ``boxoffice.params``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.operators import delivery as dv
from boxoffice.operators import facts as fc
from boxoffice.operators import ingest as ig
from boxoffice.operators import manifest as mf
from boxoffice.operators import reports as rp
from boxoffice.session import apply_conf, first_partitions
from boxoffice.streaming import jobs as st
from boxoffice.sources.landing import LANDED_KEYS
from boxoffice.sources.tables import Tables, input_size, load_tables



def _joined(fields: list[str], item) -> Column:
    return F.concat_ws("|", *[item[f].cast("string") for f in fields])


def manifest_document_text(t: Tables) -> DataFrame:
    """A-19 with the nested lines as text: fields joined by ``|``, lines by ``;``."""
    doc = mf.manifest_document(t).drop("document")
    fields = doc.schema["ticket_rows"].dataType.elementType.names
    return doc.withColumn("ticket_rows", F.array_join(F.transform("ticket_rows", lambda r: _joined(fields, r)), ";"))


def sales_rollup_nested_text(t: Tables) -> DataFrame:
    """A-15 nested, events as text: an event's fields and lines joined by ``|`` and ``;``, events by ``#``."""
    line = ["event_date", "ticket_type_name", "price", "quantity_sold", "sales_last_24_hours"]
    event = ["event_name", "event_date", "event_quantity_sold", "event_sales_last_24_hours"]
    lines = lambda e: F.array_join(F.transform(e["tickets"], lambda r: _joined(line, r)), ";")
    return rp.sales_rollup_nested(t).withColumn("events", F.array_join(
        F.transform("events", lambda e: F.concat_ws("|", _joined(event, e), lines(e))), "#"))


def result_text_rows_text(t: Tables) -> DataFrame:
    """S-11 in text: the hash form as ``name=value`` joined by ``;``, the array form joined by ``|``."""
    return rp.result_text_rows(t).select(
        F.array_join(F.transform(F.map_entries("row"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("row"),
        F.array_join("cells", "|").alias("cells"))


def result_rows_in_order_text(t: Tables) -> DataFrame:
    """S-11 in result order, cells joined by ``|``."""
    return rp.result_rows_in_order(t).select("row_no", F.array_join("cells", "|").alias("cells"))


REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {
    # manifest family (A-11 .. A-19, S-9, S-10, D-13)
    "event_manifest": mf.event_manifest,
    "manifest_revenue_split": mf.manifest_revenue_split,
    "manifest_totals": mf.manifest_totals,
    "manifest_description": mf.manifest_description,
    "manifest_header": mf.manifest_header,
    "manifest_document": manifest_document_text,
    "manifest_csv_surcharge": mf.manifest_csv_surcharge,
    "manifest_csv_final": mf.manifest_csv_final,
    "empty_manifests": dv.empty_manifests,
    # facts (A-1 .. A-7, A-16, P-6)
    "ticket_fact": fc.ticket_fact,
    "order_subtotals": fc.order_subtotals,
    "order_fact": fc.order_fact,
    "bi_ticket_dataset": fc.bi_ticket_dataset,
    "bi_ticket_unnested": fc.bi_ticket_unnested,
    "remit_original": fc.remit_original,
    "remit_new": fc.remit_new,
    "marketing_original": fc.marketing_original,
    "marketing_new": fc.marketing_new,
    # daily report (A-8 .. A-10, A-15, S-11, section 2.8)
    "party_pass_weekly": rp.party_pass_weekly,
    "upcoming_sales": rp.upcoming_sales,
    "sales_rollup": rp.sales_rollup,
    "sales_rollup_nested": sales_rollup_nested_text,
    "scalar_probe": rp.scalar_probe,
    "result_text_rows": result_text_rows_text,
    "result_rows_in_order": result_rows_in_order_text,
    "result_flat_cells": rp.result_flat_cells,
    # ingest (N-1 .. N-10, S-2, S-5, S-7, S-8, P-14 .. P-16)
    "fees_normalized": ig.fees_normalized,
    "orders_enriched": ig.orders_enriched,
    "tickets_flat": ig.tickets_flat,
    "tickets_unnested": ig.tickets_unnested,
    "order_face_value": ig.order_face_value,
    "ticket_types_dim": ig.ticket_types_dim,
    "checkins": ig.checkins,
    "charges_extract": lambda t: t.charges,
    "events_in_range": ig.events_in_range,
    "charges_in_range": ig.charges_in_range,
    "events_without_orders": ig.events_without_orders,
    "pages_flatten": ig.pages_flatten,
    "checkin_pages_flatten": ig.checkin_pages_flatten,
    "order_page_audit": ig.order_page_audit,
    "checkin_page_audit": ig.checkin_page_audit,
    "partition_columns": ig.partition_columns,
    "new_partitions": ig.new_partitions,
    # delivery (D-1 .. D-17, J-7 .. J-11, S-13, T-1, T-4)
    "candidate_events": dv.candidate_events,
    "control_rows_for_events": lambda t: dv.control_rows_for_events(t.control, dv.candidate_events(t)),
    "control_rows_missing": lambda t: dv.control_rows_missing(t.control, dv.candidate_events(t)),
    "delivery_categories": dv.delivery_categories,
    "delivery_status_labels": dv.delivery_status_labels,
    "schedule_preview": dv.schedule_preview,
    "control_initialize": lambda t: dv.control_initialize(t.control, dv.candidate_events(t)),
    "delivery_outcomes": dv.delivery_outcomes,
    "control_after_batch": dv.control_after_batch,
    "control_commands": dv.control_commands,
    "delivery_routing": dv.delivery_routing,
    # landing (S-1, S-3, H-1, H-2)
    "landing_snapshot": st.landing_snapshot,
    "landing_read": st.landing_read,
    **{f"landing_{n}": (lambda t, _n=n: st.landing_table(t, _n)) for n in LANDED_KEYS},
    **{f"landing_replaced_{n}": (lambda t, _n=n: st.landing_replaced(t, _n)) for n in st.PER_EVENT},
    "landing_changes": st.landing_changes,
    "landing_events_in_range": st.landing_events_in_range,
    "landing_new_partitions": st.landing_new_partitions,
    "landing_drift": st.landing_drift,
    "landing_quarantine": st.landing_quarantine,
    "landing_manifest": st.landing_manifest,
    # streams (ST-1 .. ST-3)
    "stream_snapshot_upsert": st.stream_snapshot_upsert,
    "stream_sales_24h": st.stream_sales_24h,
    "stream_delivery_tick": st.stream_delivery_tick,
}


# O-1 .. O-5: the reference's result orders. Results are order-free sets for
# every consumer (comparison, writes); ``present`` applies the order when a
# sorted listing is wanted (a global sort: range-partitioned, not one task).
ORDER_BY: dict[str, list[str]] = {
    "remit_original": ["event_details"],
    "remit_new": ["event_details"],
    "marketing_original": ["event_date", "email"],
    "marketing_new": ["event_date", "email"],
    "party_pass_weekly": ["week_start"],
    "upcoming_sales": ["event_date", "event_name", "ticket_type_name"],
    "event_manifest": ["venue", "event_date", "event_id", "event", "ticket_name"],
    "candidate_events": ["event_date"],
    "sales_rollup": ["week_start", "venue_name", "event_date", "event_name", "level",
                     "ticket_type_name"],
}


def present(name: str, df: DataFrame) -> DataFrame:
    """Apply the reference's ORDER BY of ``name`` (if it has one)."""
    keys = ORDER_BY.get(name)
    return df.orderBy(*keys) if keys else df


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_conf(spark)
    first = first_partitions(spark, input_size(spark, sf_dir.rstrip("/"), ["customer", "orders", "lineitem"]))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(first))
    return REGISTRY[name](load_tables(spark, sf_dir))


def as_callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, _n=name: run(_n, spark, sf_dir)) for name in REGISTRY}
