"""Structured Streaming jobs over the batch functions.

The reference polls: it re-lands whole-event snapshots every few minutes and
runs the delivery decision every five. Here the same work is a stream:

* ST-1 ``snapshot_upsert``: new snapshot files in an inbox -> keyed replace
  into the landing table (``foreachBatch``; idempotent, so a retried batch
  gives the same table);
* ST-2 ``sales_24h``: tickets sold per event and hour of payment, from which
  sliding 24-hour windows (1-hour slide) per venue are read. Tickets, orders and
  events may come in any order and at any time; none is dropped;
* ST-3 ``delivery_tick``: a stream of ticks (reference times); each tick runs
  the delivery categorisation and appends the changes that its outcomes make to
  the control table, which is kept as a change log.

Every job takes a folder ``at`` for its checkpoint and tables. A job started
again with the same folder goes on where it stopped. Without one, a new folder
in the session's shared checkpoint folder is used.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.functions.time import ts, ts_lit
from boxoffice.operators import delivery as dv
from boxoffice.operators import ingest as ig
from boxoffice.operators import manifest as mf
from boxoffice.params import AS_OF
from boxoffice.operators.joins import salted_join
from boxoffice.session import checkpoint_dir
from boxoffice.sources import changelog, fixtures
from boxoffice.sources.changelog import VERSION
from boxoffice.sources.landing import (EVENT_SCHEMA, LANDED_KEYS, LANDED_SCHEMAS, UNIT, event_parts, land_lines,
                                       land_rows, land_snapshots, landed_changes, landed_partitions,
                                       latest_landed, latest_snapshot, read_days,
                                       read_evolved, read_landed)
from boxoffice.sources.files import remove
from boxoffice.sources.schemas import QUARANTINE
from boxoffice.sources.tables import LandedTables, Tables

RESCHEDULE_DAYS = 1
TICK_MINUTES = 5


def _run_dir(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def _drain(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


# --- snapshot batches shared by the batch and stream forms -------------------

def snapshot_batches(t: Tables, as_of: dt.datetime = AS_OF) -> list[DataFrame]:
    """Two polls: all events an hour before ``as_of``; then, at ``as_of``, the
    events of the ``current`` range (start date within -1..+2 days) re-landed
    with their start moved one day later (a reschedule)."""
    e = t.events
    first = e.withColumn("ingested_at", ts_lit(as_of - dt.timedelta(hours=1)))
    d = F.col("event_date")
    day = as_of.date()
    cur = e.filter(d.between(F.lit(day - dt.timedelta(days=1)), F.lit(day + dt.timedelta(days=2))))
    shift = F.expr(f"INTERVAL {RESCHEDULE_DAYS} DAYS")
    second = cur.select(
        "id", "name", "organization_id", "organization_name", "location",
        F.date_format(ts("start") + shift, "yyyy-MM-dd HH:mm:ss").alias("start"),
        F.date_format(ts("start_utc") + shift, "yyyy-MM-dd HH:mm:ss").alias("start_utc"),
        ts_lit(as_of).alias("ingested_at"))
    return [first, second]


def landing_snapshot(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """S-1 batch form: land both polls with keyed replace; every row on disk."""
    path = os.path.join(_run_dir(t.spark, "landing"), "events")
    for b in snapshot_batches(t, as_of):
        land_snapshots(t.spark, b, path)
    return read_landed(t.spark, path)


def landing_read(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """S-3: typed read of the landing table, latest snapshot per event."""
    return latest_snapshot(landing_snapshot(t, as_of))


def _event_unit(table: str) -> str | None:
    """The column that tells a row's event; charges belong to none."""
    return None if table == "charges" else "_event_id"


def _staged(rows: DataFrame, at: str) -> DataFrame:
    """``rows`` from files below ``at``: computed once, however many polls take them."""
    rows.write.parquet(at, compression="zstd")
    return rows.sparkSession.read.schema(rows.schema).parquet(at)


def landing_table(t: Tables, table: str, as_of: dt.datetime = AS_OF, at: str | None = None) -> DataFrame:
    """S-1/S-3: land a whole table an hour before ``as_of``; at ``as_of`` land again what belongs
    to the ``current`` range (events by start, charges by the time they were made); read the latest."""
    root = at or _run_dir(t.spark, "landing")
    path, staged, unit = os.path.join(root, table), os.path.join(root, "_polls", table), _event_unit(table)
    if table == "charges":
        rows = _staged(ig.landing_rows(t, table).drop("_event_id"), staged)
        again = ig.charges_in_range(t, "current", as_of).select("id")
        current = rows.join(again, "id", "left_semi")
    else:
        again = ig.events_in_range(t, "current", as_of).select(F.col("id").alias("_again")).distinct()
        rows = _staged(ig.landing_rows(t, table, again), staged)
        current = rows.filter(F.col("_again").isNotNull()).drop("_again")
        rows = rows.drop("_again")
    for batch, when, files in ((rows, as_of - dt.timedelta(hours=1), staged), (current, as_of, None)):
        land_rows(t.spark, batch.withColumn("ingested_at", ts_lit(when)), path, *LANDED_KEYS[table], unit=unit, staged=files)
    remove(t.spark, staged)
    return latest_landed(t.spark, path, LANDED_SCHEMAS[table], *LANDED_KEYS[table])


def landed_tables(t: Tables, names: list[str], as_of: dt.datetime = AS_OF, at: str | None = None) -> LandedTables:
    """Land the whole tables ``names``; the bundle that reads them back."""
    root = at or _run_dir(t.spark, "zone")
    for name in names:
        rows = ig.landing_rows(t, name).withColumn("ingested_at", ts_lit(as_of))
        unit = _event_unit(name)
        land_rows(t.spark, rows if unit else rows.drop("_event_id"), os.path.join(root, name), *LANDED_KEYS[name], unit=unit)
    return LandedTables(t, root)


def landing_manifest(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """A-11 over the landed lines: load, land, typed read, report."""
    return mf.event_manifest(landed_tables(t, ["events", "tickets"], as_of))


def landing_events_in_range(t: Tables, preset: str = "current", as_of: dt.datetime = AS_OF) -> DataFrame:
    """P-14 over the landing: the events of a range of days, from the partitions of those days."""
    path = os.path.join(_run_dir(t.spark, "days"), "events")
    land_snapshots(t.spark, t.events, path, as_of)
    return latest_snapshot(read_days(t.spark, path, EVENT_SCHEMA, *ig.event_range_bounds(preset, as_of))).select(*fixtures.EVENT_COLUMNS)


def landing_new_partitions(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """S-5 over the landing: partitions of the events after ``as_of`` that the landed ones (up to then) do not have."""
    path = os.path.join(_run_dir(t.spark, "parts"), "events")
    start = ts("start")
    land_snapshots(t.spark, t.events.filter(start <= ts_lit(as_of)), path, as_of)
    return ig.missing_partitions(t.events.filter(start > ts_lit(as_of)).select(*event_parts()), landed_partitions(t.spark, path))


# Of the events that the second poll below brings, by id: a start that is no time, a line cut off.
BAD_START, CUT_LINE = (7, 3), (11, 2)


def drifting_polls(t: Tables, as_of: dt.datetime = AS_OF) -> list[DataFrame]:
    """Two polls as JSON lines: all events; then those in the ``current`` range with a new column
    ``capacity``, some of them with a start that is no time, some cut off."""
    n = F.col("id").cast("long")
    first = t.events.select(F.to_json(F.struct(*fixtures.EVENT_COLUMNS)).alias("value"))
    again = ig.events_in_range(t, "current", as_of).withColumn("capacity", n * 10).withColumn(
        "start", F.when(n % BAD_START[0] == BAD_START[1], F.lit("soon")).otherwise(F.col("start")))
    line = F.to_json(F.struct(*fixtures.EVENT_COLUMNS, "capacity"))
    second = again.select(F.when(n % CUT_LINE[0] == CUT_LINE[1], F.substring_index(line, ",", 3)).otherwise(line).alias("value"))
    return [first, second]


def _land_drifting(t: Tables, as_of: dt.datetime) -> str:
    base = _run_dir(t.spark, "drift")
    for batch, when in zip(drifting_polls(t, as_of), (as_of - dt.timedelta(hours=1), as_of)):
        land_lines(t.spark, batch, f"{base}/events", f"{base}/quarantine", when)
    return base


def landing_drift(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """S-3 with a schema that is inferred per poll: the new column is there, rejected lines change nothing."""
    return read_evolved(t.spark, f"{_land_drifting(t, as_of)}/events")


def landing_quarantine(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """The lines that the polls' checks rejected, with their reasons."""
    bad = t.spark.read.schema(QUARANTINE).parquet(f"{_land_drifting(t, as_of)}/quarantine")
    return bad.select(F.regexp_extract("line", '"id":"([^"]*)"', 1).alias("id"), F.array_join("reasons", ",").alias("reasons"), "ingested_at")


# What tells the rows of a table that change between the polls below: a number in one of its columns.
_NUMBER_IN = {"orders": "id", "tickets": "order_id", "ticket_types": "ticket_type_price_id", "checkin_ids": "ticket_id"}
PER_EVENT = list(_NUMBER_IN)
GONE, CHANGED, LATE, OF = 3, 4, 5, 7


def replaced_polls(t: Tables, table: str, as_of: dt.datetime = AS_OF, staged: str | None = None) -> list[DataFrame]:
    """Two polls of a per-event table. Of every seven rows of the events in the ``current`` range, by a
    number in their key, one comes with the second poll only, one is gone in it, and one has changed
    (orders: the buyer's mail address). The rows are written once to the folder ``staged``, if one is given."""
    again = ig.events_in_range(t, "current", as_of).select(F.col("id").alias("_again"))
    rows = ig.landing_rows(t, table, again)
    rows = _staged(rows, staged) if staged else rows
    number = F.regexp_extract(_NUMBER_IN[table], "([0-9]+)", 1).cast("long") % OF
    polled = F.col("_again").isNotNull()
    first = rows.filter(~polled | (number != LATE)).drop("_again").withColumn("ingested_at", ts_lit(as_of - dt.timedelta(hours=1)))
    second = rows.filter(polled & (number != GONE)).drop("_again").withColumn("ingested_at", ts_lit(as_of))
    if table == "orders":
        second = second.withColumn("email", F.when(number == CHANGED, F.concat(F.lit("new-"), "email")).otherwise(F.col("email")))
    return [first, second]


def land_replaced(t: Tables, table: str, as_of: dt.datetime = AS_OF, at: str | None = None) -> str:
    """Land both polls of ``replaced_polls``, with their change sets; returns the table's folder."""
    root = at or _run_dir(t.spark, "replaced")
    path, staged = os.path.join(root, table), os.path.join(root, "_polls", table)
    polled = ig.events_in_range(t, "current", as_of).select(
        F.col("id").alias(UNIT), *event_parts(), ts_lit(as_of).alias("ingested_at"))
    for n, batch in enumerate(replaced_polls(t, table, as_of, staged)):
        land_rows(t.spark, batch, path, *LANDED_KEYS[table], unit="_event_id", polled=polled if n else None, log_changes=n > 0,
                  staged=None if n else staged)
    remove(t.spark, staged)
    return path


def landing_replaced(t: Tables, table: str, as_of: dt.datetime = AS_OF) -> DataFrame:
    """S-1 at event grain: every row on disk after an event's new snapshot has replaced the old one."""
    return read_landed(t.spark, land_replaced(t, table, as_of), LANDED_SCHEMAS[table])


def landing_changes(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """The change set of the second poll of the orders: insert, update, vanish."""
    return landed_changes(t.spark, land_replaced(t, "orders", as_of), LANDED_SCHEMAS["orders"], "id").drop(VERSION)


# --- ST-1 ------------------------------------------------------------------

def snapshot_upsert_stream(spark: SparkSession, inbox: str, table: str, checkpoint: str):
    """Start the upsert stream from ``inbox`` (NDJSON snapshots) into ``table``."""
    def upsert_batch(batch: DataFrame, _epoch: int) -> None:
        # several snapshots of one key in a batch: the latest wins
        land_snapshots(spark, latest_snapshot(batch), table)

    src = spark.readStream.schema(EVENT_SCHEMA).json(inbox)
    return (src.writeStream.foreachBatch(upsert_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_snapshot_upsert(t: Tables, as_of: dt.datetime = AS_OF, at: str | None = None) -> DataFrame:
    """ST-1: each poll's snapshots arrive as files; the stream lands them."""
    base = at or _run_dir(t.spark, "st1")
    inbox, table, ckpt = (os.path.join(base, x) for x in ("inbox", "table", "checkpoint"))
    for b in snapshot_batches(t, as_of):
        b.write.mode("append").json(inbox)
        _drain(snapshot_upsert_stream(t.spark, inbox, table, ckpt))
    return latest_snapshot(read_landed(t.spark, table))


# --- ST-2 ------------------------------------------------------------------

def _ticket_sales(lineitem: DataFrame, t: Tables) -> DataFrame:
    """Tickets (lineitem rows, static or streaming) with venue and paid time.

    Orders meet the events first (salted: an event may hold a third of all
    orders), so the tickets join on the order id only.
    """
    o = t.orders.select(F.col("id").alias("order_id"), F.col("event_id").alias("o_event_id"),
                        ts("paid_date_utc").alias("paid_ts"))
    e = t.events.select(F.col("id").alias("e_id"), F.col("organization_name").alias("venue_name"))
    sold = salted_join(o, e, "o_event_id", "e_id", ["order_id"], t.hot_events("orders")).select("order_id", "paid_ts", "venue_name")
    return lineitem.select(F.col("l_orderkey").cast("string").alias("order_id")).join(sold, "order_id")


def sales_24h(t: Tables) -> DataFrame:
    """Batch twin of ST-2: one aggregation with sliding windows over the static tables."""
    w = _ticket_sales(t.raw("lineitem"), t).groupBy(
        F.window("paid_ts", "24 hours", "1 hour").alias("w"), "venue_name").agg(F.count("*").alias("tickets_sold"))
    return w.select("venue_name", F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "tickets_sold")


def sliding_from_hours(hours: DataFrame) -> DataFrame:
    """Counts per (venue_name, hour) -> counts per sliding 24-hour window."""
    start = F.explode(F.sequence(F.col("hour") - F.expr("INTERVAL 23 HOURS"), F.col("hour"), F.expr("INTERVAL 1 HOUR")))
    w = hours.select("venue_name", start.alias("window_start"), "tickets_sold")
    return w.groupBy("venue_name", "window_start").agg(F.sum("tickets_sold").alias("tickets_sold")).select(
        "venue_name", "window_start", (F.col("window_start") + F.expr("INTERVAL 24 HOURS")).alias("window_end"), "tickets_sold")


HOURS_SCHEMA = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("hour", T.TimestampType()),
                             T.StructField("tickets_sold", T.LongType())])


def sales_24h_stream(t: Tables, at: str, files_per_trigger: int | None = None):
    """Start ST-2 over the files of tickets (lineitem) and of orders; each is one file or a folder of part files.

    A stream-stream join on the order id: a ticket waits in state for its order
    and an order for its tickets, whichever comes first, without a limit of
    time. What a micro-batch matches is counted per event and hour and appended
    to a log; a batch that is run again replaces its version.
    """
    def source(name: str) -> DataFrame:
        src = t.spark.readStream.schema(t.raw(name).schema)
        if files_per_trigger:
            src = src.option("maxFilesPerTrigger", files_per_trigger)
        return src.parquet(f"{t.root}/{name}.parque[t]")  # as a pattern, a file serves as well as a folder

    tickets = source("lineitem").select(F.col("l_orderkey").cast("string").alias("ticket_order"))
    orders = fixtures.orders(source("orders")).select(
        F.col("id").alias("order_id"), "event_id", F.date_trunc("hour", ts("paid_date_utc")).alias("hour"))
    sold = tickets.join(orders, F.col("ticket_order") == F.col("order_id")).select("event_id", "hour")
    log = os.path.join(at, "hours")

    def add(batch: DataFrame, epoch: int) -> None:
        changelog.append(batch.groupBy("event_id", "hour").agg(F.count("*").alias("tickets_sold")), log, epoch)
        changelog.fold(t.spark, log, HOURS_SCHEMA, lambda rows: rows.groupBy("event_id", "hour").agg(
            F.sum("tickets_sold").alias("tickets_sold"), F.max(VERSION).alias(VERSION)), upto=epoch - 1)

    return (sold.writeStream.outputMode("append").foreachBatch(add)
            .option("checkpointLocation", os.path.join(at, "checkpoint")).trigger(availableNow=True).start())


def stream_sales_24h(t: Tables, at: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """ST-2: sliding 24 h counts per venue, after all files that have come so far.

    The counts meet the events when they are read, so an event may come after
    its sales as well.
    """
    at = at or _run_dir(t.spark, "st2")
    _drain(sales_24h_stream(t, at, files_per_trigger))
    sold = changelog.entries(t.spark, os.path.join(at, "hours"), HOURS_SCHEMA).groupBy("event_id", "hour").agg(
        F.sum("tickets_sold").alias("tickets_sold"))
    e = t.events.select(F.col("id").alias("event_id"), F.col("organization_name").alias("venue_name"))
    hours = sold.join(e, "event_id").groupBy("venue_name", "hour").agg(F.sum("tickets_sold").alias("tickets_sold"))
    return sliding_from_hours(hours)


# --- ST-3 ------------------------------------------------------------------
TICK_SCHEMA = T.StructType([T.StructField("as_of", T.StringType())])


def tick_times(as_of: dt.datetime = AS_OF, n: int = 2) -> list[dt.datetime]:
    return [as_of + dt.timedelta(minutes=TICK_MINUTES * i) for i in range(n)]


TICKS_IN_A_BATCH = 1_000_000  # versions that a micro-batch may take


def stream_delivery_tick(t: Tables, as_of: dt.datetime = AS_OF, at: str | None = None,
                         ticks: list[dt.datetime] | None = None) -> DataFrame:
    """ST-3: ticks arrive in files; each tick, in order of time, advances the control table.

    The table is a log: a tick appends the changes it makes, as a version of its
    own, and reads the versions before it. A batch that is run again writes the
    same versions from the same state, and a restarted stream goes on from the
    last one. Older versions are folded from time to time.
    """
    spark = t.spark
    base = at or _run_dir(spark, "st3")
    inbox, log, ckpt = (os.path.join(base, x) for x in ("ticks", "control", "checkpoint"))
    state = lambda before=None: dv.control_from_log(changelog.entries(spark, log, dv.CONTROL_LOG, before))
    if changelog.last_version(spark, log) < 0:  # else a job that goes on
        changelog.append(dv.control_as_log(t.control), log, 0)

    def run_ticks(batch: DataFrame, epoch: int) -> None:
        first = epoch * TICKS_IN_A_BATCH + 1
        changelog.fold(spark, log, dv.CONTROL_LOG, dv.folded_log, upto=first - 1)
        times = batch.select(ts("as_of").alias("at")).filter(F.col("at").isNotNull()).distinct().orderBy("at")
        for i, row in enumerate(times.toLocalIterator()):
            outcomes = dv.delivery_outcomes(t, row["at"], state(first + i))
            changelog.append(dv.outcome_changes(outcomes, row["at"]), log, first + i)

    for x in ticks if ticks is not None else tick_times(as_of):  # one tick file per firing
        spark.range(1).select(F.lit(x.strftime("%Y-%m-%d %H:%M:%S")).alias("as_of")) \
             .coalesce(1).write.mode("append").json(inbox)
    q = (spark.readStream.schema(TICK_SCHEMA).option("maxFilesPerTrigger", 1).json(inbox)
         .writeStream.foreachBatch(run_ticks).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    _drain(q)
    return state()
