"""Command-line verbs of the original tool, mapped to Spark jobs.

    python -m boxoffice.cli load     --tables DIR --landing DIR [--time-range R] [--organization ID]
                                     land the six tables' rows of the events in range
    python -m boxoffice.cli crawl    --landing DIR [--prefix P]    register the landed tables and their
                                                                   partitions in the session's catalog
    python -m boxoffice.cli reset    --tables DIR --landing DIR    load, drop the tables of the prefix, crawl
    python -m boxoffice.cli daily    --tables DIR --out DIR        write the daily report datasets
    python -m boxoffice.cli manifest --tables DIR --out DIR [--event-id ID] [--report-variant V]
    python -m boxoffice.cli send     --tables DIR --out DIR [--attempts DIR]
                                     categories and routing for one tick; with the mail service's
                                     answers also the next control table

Every verb takes ``--as-of 'YYYY-MM-DD HH:MM:SS'`` (UTC; default: the run parameter).
The catalog is the session's: tables outlive the process where it does (a shared
metastore). Outputs are written as Parquet/CSV folders; nothing is collected to the
driver. (The ``purge`` verb deletes a bucket and is not provided.)
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from boxoffice.functions.time import ts_lit
from boxoffice.operators import delivery as dv
from boxoffice.operators import ingest as ig
from boxoffice.operators import manifest as mf
from boxoffice.operators import reports as rp
from boxoffice.params import AS_OF
from boxoffice.session import get_spark
from boxoffice.sources.landing import LANDED_KEYS, UNIT, drop_tables, event_parts, land_rows, register_tables
from boxoffice.sources.tables import Tables, load_tables


def _parse_time(s: str | None) -> dt.datetime:
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S") if s else AS_OF


def load(t: Tables, landing: str, preset: str, as_of: dt.datetime, organization_id: str | None = None) -> None:
    """Land the six tables' rows of the events (charges: by the time they were made) in range."""
    events = ig.events_in_range(t, preset, as_of, organization_id)
    ids = events.select(F.col("id").alias("_event_id"))
    # an event without orders brings nothing but its own row; of the others every list counts, an empty one too
    ordered = events.join(t.orders.select(F.col("event_id").alias("id")).distinct(), "id", "left_semi")
    polled = ordered.select(F.col("id").alias(UNIT), *event_parts(), ts_lit(as_of).alias("ingested_at"))
    charges = ig.charges_in_range(t, preset, as_of).select("id")
    for name, key in LANDED_KEYS.items():
        rows = ig.landing_rows(t, name)
        rows = rows.drop("_event_id").join(charges, "id", "left_semi") if name == "charges" else rows.join(ids, "_event_id", "left_semi")
        land_rows(t.spark, rows.withColumn("ingested_at", ts_lit(as_of)), os.path.join(landing, name), *key,
                  unit=None if name == "charges" else "_event_id", polled=None if name in ("events", "charges") else polled)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    ap = argparse.ArgumentParser(prog="boxoffice")
    ap.add_argument("verb", choices=["load", "crawl", "reset", "daily", "manifest", "send"])
    ap.add_argument("--tables", help="folder of the driver parquet tables")
    ap.add_argument("--landing", help="landing folder")
    ap.add_argument("--prefix", default="tw_")
    ap.add_argument("--out", help="output folder")
    ap.add_argument("--as-of")
    ap.add_argument("--time-range", default="current")
    ap.add_argument("--organization")
    ap.add_argument("--event-id")
    ap.add_argument("--attempts", help="parquet folder of the mail service's answers")
    ap.add_argument("--report-variant", default="preliminary",
                    choices=["preliminary", "final", "accounting"])
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = spark or get_spark(a.master)
    as_of = _parse_time(a.as_of)

    if a.verb in ("load", "reset"):
        load(load_tables(spark, a.tables), a.landing, a.time_range, as_of, a.organization)
    if a.verb == "reset":
        print(drop_tables(spark, a.prefix))
    if a.verb in ("crawl", "reset"):
        print(register_tables(spark, a.landing, list(LANDED_KEYS), a.prefix))
    if a.verb in ("load", "crawl", "reset"):
        return

    t = load_tables(spark, a.tables)
    out = lambda name: os.path.join(a.out, name)
    if a.verb == "daily":
        rp.party_pass_weekly(t, as_of).write.mode("overwrite").parquet(out("party_pass_weekly"))
        rp.sales_rollup(t, as_of).write.mode("overwrite").parquet(out("sales_rollup"))
        ig.events_in_range(t, a.time_range, as_of).write.mode("overwrite").parquet(out("events"))
    elif a.verb == "manifest":
        lines = mf.event_manifest(t, a.event_id)
        hdr = mf.manifest_header(t, lines).filter(F.col("report_variant") == a.report_variant)
        hdr.write.mode("overwrite").parquet(out("header"))
        rows = mf.manifest_csv_final if a.report_variant == "final" else mf.manifest_csv_surcharge
        mf.write_manifest_csv(rows(t, a.event_id), out("csv"), hdr.select("event_id", F.col("filename_csv").alias("file_name")))
    elif a.verb == "send":
        dv.delivery_categories(t, as_of).write.mode("overwrite").parquet(out("categories"))
        dv.delivery_routing(t, as_of).write.mode("overwrite").parquet(out("routing"))
        if a.attempts:
            t.attempts = spark.read.parquet(a.attempts)
            dv.control_after_batch(t, as_of).write.mode("overwrite").parquet(out("control"))


if __name__ == "__main__":
    main()
