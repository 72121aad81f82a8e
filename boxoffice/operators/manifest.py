"""Per-event sales manifests for every event in one job.

The reference runs one SQL query per event; here every event's manifest lines
come from a single grouped aggregate (partial aggregation map-side, one
shuffle on the nine group keys), and the per-event totals, description,
header and CSV rows are further aggregates of those lines, which are already
small (one row per ticket type x price x fee combination of an event).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxoffice.functions.money import money_or_zero, money18, money38, money_text, sum_money
from boxoffice.functions.text import strip_spaces
from boxoffice.functions.time import ts
from boxoffice.params import (BAR_CARD_AMOUNT, BAR_CARD_PATTERN, FINAL_CSV_COLUMNS,
                              REPORT_VARIANTS, SURCHARGE_CSV_COLUMNS)
from boxoffice.sources.files import name_files
from boxoffice.sources.tables import Tables



def _priced_tickets(t: Tables, event_id: str | None = None) -> DataFrame:
    """Priced tickets with money cast-then-defaulted and the bar-card share."""
    k = t.tickets.select("event_id", F.col("ticket_type_name").alias("ticket_name"),
                         money_or_zero("price").alias("price"),
                         money_or_zero("surcharge").alias("surcharge"),
                         money_or_zero("let_tax").alias("let_tax"),
                         money_or_zero("sales_tax").alias("sales_tax"),
                         money_or_zero("venue_fee").alias("venue_fee"))
    k = k.filter(F.col("price") > F.lit(0).cast("decimal(10,2)"))
    if event_id is not None:
        k = k.filter(F.col("event_id") == event_id)
    return k


def _event_fields(t: Tables) -> DataFrame:
    return t.events.select(F.col("id").alias("e_id"), "location", "name", "start")


def event_manifest(t: Tables, event_id: str | None = None) -> DataFrame:
    """A-11: manifest lines of every event (or of one ``event_id``).

    Tickets are aggregated to lines *before* the join with the events: the
    partial aggregate combines map-side and the shuffle is on all line keys, so
    an event holding a large share of the tickets is spread over tasks instead
    of landing in one join partition. The event fields (venue, title, start)
    depend only on the event id, so joining them to the lines afterwards gives
    the reference's grouping. ``count(ticket_id)`` is ``count(*)``: the ticket
    id is the table key and never null.
    """
    k = _priced_tickets(t, event_id)
    lines = k.groupBy("event_id", "ticket_name", "price", "surcharge",
                      F.col("let_tax").alias("per_ticket_let")).agg(
        F.count("*").alias("quantity"),
        sum_money("price").alias("sum_subtotal"),
        sum_money("surcharge").alias("sum_surcharge"),
        sum_money("let_tax").alias("sum_let_tax"),
        sum_money("sales_tax").alias("sum_sales_tax"),
        sum_money("venue_fee").alias("sum_venue_fee"))
    e = _event_fields(t)
    j = lines.join(e, lines.event_id == e.e_id)
    open_time = ts("start")
    # 100 * sum(let) / sum(price), half-up to two decimals, computed on integer
    # cents so Spark and the oracle round identically: floor((20000*L + P) / (2*P)).
    # P > 0 because only priced tickets are kept.
    rate = F.expr("(cast(sum_let_tax * 100 AS BIGINT) * 20000 + cast(sum_subtotal * 100 AS BIGINT))"
                  " div (cast(sum_subtotal * 100 AS BIGINT) * 2)")
    return j.select(
        F.col("location").alias("venue"), "event_id", F.col("name").alias("event"),
        F.to_date(open_time).alias("event_date"), open_time.alias("event_open_time"),
        "ticket_name",
        money18("price").alias("price"),
        money18("surcharge").alias("surcharge"),
        money18("per_ticket_let").alias("per_ticket_let"),
        "quantity",
        money38("sum_subtotal").alias("sum_subtotal"),
        money38("sum_surcharge").alias("sum_surcharge"),
        money38("sum_let_tax").alias("sum_let_tax"),
        (rate.cast("decimal(38,0)") / 100).cast("decimal(38,2)").alias("let_tax_rate_observed"),
        money38("sum_sales_tax").alias("sum_sales_tax"),
        money38("sum_venue_fee").alias("sum_venue_fee"),
    )


def manifest_revenue_split(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """A-12: bar-card share (100.00 per VIP bar-card ticket) and the rest of the subtotal."""
    lines = lines if lines is not None else event_manifest(t)
    bar = F.when(F.col("ticket_name").rlike(BAR_CARD_PATTERN),
                 F.lit(BAR_CARD_AMOUNT).cast("decimal(38,2)") * F.col("quantity")) \
           .otherwise(F.lit(0)).cast("decimal(38,2)")
    return (lines.withColumn("sum_bar_card", bar)
                 .withColumn("subtotal_minus_bar_card",
                             (F.col("sum_subtotal") - F.col("sum_bar_card")).cast("decimal(38,2)")))


TOTALS = ["total_sold", "total_face_value", "total_let", "total_bar_card", "total_sales_tax",
          "total_venue_fee", "total_surcharge"]

def _total_aggs() -> list:
    return [F.sum("quantity").alias("total_sold"),
            money38(F.sum("subtotal_minus_bar_card")).alias("total_face_value"),
            money38(F.sum("sum_let_tax")).alias("total_let"),
            money38(F.sum("sum_bar_card")).alias("total_bar_card"),
            money38(F.sum("sum_sales_tax")).alias("total_sales_tax"),
            money38(F.sum("sum_venue_fee")).alias("total_venue_fee"),
            money38(F.sum("sum_surcharge")).alias("total_surcharge")]


def _first_aggs() -> list:
    """Venue, title, date and open time of the event's first line. They are
    constant within an event, so ``min`` is an exact, map-side combinable pick."""
    return [F.min("venue").alias("venue"), F.min("event").alias("event_title"),
            F.min("event_date").alias("d"), F.min("event_open_time").alias("open_time")]


def _description_cols() -> list:
    return ["venue", "event_title", "event_id",
            F.date_format("d", "yyyy-MM-dd").alias("event_date"),
            F.date_format("d", "MM-dd-yyyy").alias("display_date"),
            F.date_format("d", "MMddyyyy").alias("filename_date_part"),
            strip_spaces("venue").alias("filename_venue_part"),
            F.upper(F.date_format("d", "EEE dd-MMM")).alias("subject_date_part"),
            F.date_format("open_time", "hh:mma").alias("subject_open_time_part")]


def _event_rollup(split: DataFrame, *extra) -> DataFrame:
    """One aggregate per event: description parts, totals and ``extra`` aggregates."""
    g = split.groupBy("event_id").agg(*_first_aggs(), *_total_aggs(), *extra)
    return g.select(*_description_cols(), *TOTALS,
                    *[c for c in g.columns if c not in TOTALS and c not in
                      ("event_id", "venue", "event_title", "d", "open_time")])


def manifest_totals(t: Tables, split: DataFrame | None = None) -> DataFrame:
    """A-13: per-event totals of the split manifest lines."""
    split = split if split is not None else manifest_revenue_split(t)
    return split.groupBy("event_id").agg(*_total_aggs())


def manifest_description(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """A-17: title, dates and file-name parts of each event with a manifest."""
    lines = lines if lines is not None else event_manifest(t)
    return lines.groupBy("event_id").agg(*_first_aggs()).select(*_description_cols())


def _variants():
    """The three report variants as a row-local generator (no join)."""
    return F.explode(F.array(*[
        F.struct(F.lit(n).alias("report_variant"), F.lit(lf).alias("label_as_final"),
                 F.lit(pdf).alias("has_pdf"), F.lit(sc).alias("has_surcharge_csv"),
                 F.lit(fc).alias("has_final_csv"))
        for n, lf, pdf, sc, fc in REPORT_VARIANTS]))


def manifest_header(t: Tables, lines: DataFrame | None = None) -> DataFrame:
    """A-18 / D-16: description + totals + variant flags, one row per event x variant.

    Description and totals come from one aggregate of the lines per event, so
    the lines are computed once and nothing is joined.
    """
    lines = lines if lines is not None else event_manifest(t)
    h = _event_rollup(manifest_revenue_split(t, lines))
    h = h.withColumn("v", _variants()).select("*", "v.*").drop("v")
    title = F.when(F.col("label_as_final"), F.lit("FINAL")).otherwise(F.lit("PRELIMINARY"))
    base = F.concat(F.lit("TICKET SALES MANIFEST_"), F.col("filename_date_part"), F.lit("_"),
                    F.col("filename_venue_part"))
    full = F.concat(title, F.lit(" "), base)
    subject = F.concat(F.col("venue"), F.lit(" "), F.col("subject_date_part"), F.lit(" "),
                       F.col("event_title"), F.lit(" | "), title, F.lit(" TICKET SALES MANIFEST "),
                       F.col("subject_open_time_part"))
    return h.select(
        "event_id", "report_variant", "venue", "event_title", "event_date", "display_date",
        *TOTALS, "label_as_final", "has_pdf", "has_surcharge_csv", "has_final_csv",
        title.alias("variant_title"), full.alias("filename_full"),
        F.concat(full, F.lit(".pdf")).alias("filename_pdf"),
        F.concat(full, F.lit(".csv")).alias("filename_csv"),
        subject.alias("email_subject_with_open_time"),
    )


def manifest_document(t: Tables) -> DataFrame:
    """A-19: one nested document per event: header fields + sorted lines + JSON text.

    One aggregate per event; the collected list holds the event's manifest
    lines (one per ticket type x price x fee combination), not its tickets.
    """
    line = F.struct("ticket_name", "price", "surcharge", "per_ticket_let", "quantity",
                    "sum_subtotal", "sum_surcharge", "sum_let_tax", "let_tax_rate_observed",
                    "sum_sales_tax", "sum_venue_fee", "sum_bar_card", "subtotal_minus_bar_card")
    doc = _event_rollup(manifest_revenue_split(t),
                        F.sort_array(F.collect_list(line)).alias("ticket_rows"))
    return doc.withColumn("document", F.to_json(F.struct(*doc.columns)))


def _csv_rows(t: Tables, columns: list[str], event_id: str | None) -> DataFrame:
    """S-9/A-14: detail lines and the per-event totals row in one aggregate.

    Grouping sets over the priced tickets: (event, line keys) gives the lines,
    (event) gives the totals; the bar-card share is summed per ticket, which
    equals 100.00 x quantity per matching line.
    """
    k = _priced_tickets(t, event_id).withColumn(
        "bar", F.when(F.col("ticket_name").rlike(BAR_CARD_PATTERN),
                      F.lit(BAR_CARD_AMOUNT).cast("decimal(10,2)")).otherwise(F.lit(0).cast("decimal(10,2)")))
    keys = ["event_id", "ticket_name", "price", "surcharge", "let_tax"]
    g = k.groupingSets([keys, ["event_id"]], *keys).agg(
        F.count("*").alias("sold"), sum_money("price").alias("subtotal"), sum_money("bar").alias("bar"),
        sum_money("let_tax").alias("let_sum"), sum_money("surcharge").alias("surcharge_sum"),
        sum_money("sales_tax").alias("sales_tax_sum"), sum_money("venue_fee").alias("venue_fee_sum"),
        F.grouping("ticket_name").alias("row_kind"))
    e = _event_fields(t)
    j = g.join(e, g.event_id == e.e_id)
    detail = F.col("row_kind") == 0
    blank = lambda c: F.when(detail, c).otherwise(F.lit(""))
    start = ts("start")
    out = j.select(
        "event_id", F.col("row_kind").cast("int").alias("row_kind"),
        blank(F.col("location")).alias("venue"), blank(F.col("name")).alias("event"),
        blank(F.date_format(start, "yyyy-MM-dd")).alias("event_date"),
        blank(F.col("ticket_name")).alias("ticket"),
        blank(money_text("price")).alias("price"),
        blank(money_text("let_tax")).alias("per_ticket_let"),
        F.col("sold").cast("string").alias("sold"),
        money_text("bar").alias("total_bar_card"),
        money_text(F.col("subtotal") - F.col("bar")).alias("total_face_value"),
        money_text("let_sum").alias("total_let"),
        money_text("surcharge_sum").alias("total_surcharge"),
        money_text("sales_tax_sum").alias("total_sales_tax"),
        money_text("venue_fee_sum").alias("total_service_charge"))
    return out.select("event_id", "row_kind", *columns)


def manifest_csv_surcharge(t: Tables, event_id: str | None = None) -> DataFrame:
    """S-9 / A-14: the 13-column surcharge CSV rows, detail lines then one totals row."""
    return _csv_rows(t, SURCHARGE_CSV_COLUMNS, event_id)


def manifest_csv_final(t: Tables, event_id: str | None = None) -> DataFrame:
    """S-10: the 12-column final CSV rows (no surcharge column)."""
    return _csv_rows(t, FINAL_CSV_COLUMNS, event_id)


def write_manifest_csv(rows: DataFrame, path: str, names: DataFrame | None = None) -> None:
    """Sink: one CSV folder per event, header first, totals row last.

    Rows of one event go to one task (``repartition`` on the event), sorted
    inside the partition; no global sort. ``names`` (event_id, file_name; A-17)
    gives the events' files their names; events of one venue and day share
    theirs, so each keeps its folder. The names go to the driver, which renames
    several files at once.
    """
    cols = [c for c in rows.columns if c not in ("event_id", "row_kind")]
    (rows.repartition("event_id")
         .sortWithinPartitions("event_id", "row_kind", "ticket", "price", "per_ticket_let")
         .select("event_id", *cols)
         .write.mode("overwrite").partitionBy("event_id").option("header", True).csv(path))
    if names is not None:
        name_files(rows.sparkSession, {f"{path}/event_id={r.event_id}": r.file_name for r in names.select("event_id", "file_name").collect()})


def priced_events(t: Tables, ids: DataFrame) -> DataFrame:
    """The events of ``ids`` (event_id) that have a manifest line, i.e. a priced ticket (counted at landing)."""
    return t.event_sizes.filter(F.col("priced_tickets") > 0).select("event_id").join(ids, "event_id", "left_semi")
