"""Driver tables and the ticket-sales tables derived from them.

``load_tables(spark, dir)`` returns a ``Tables`` bundle of lazy DataFrames, so
Catalyst prunes columns and pushes filters from each query down to the files.

The ticket-sales tables (events, orders, tickets, raw charges, control) are
derived from the driver tables once and *landed* as Parquet under the shared
checkpoint folder (``spark.checkpoint.dir``), as the ingest job of the
original system lands typed tables that every report then reads. Later
queries read the landed copy; ``landed=False`` derives them inline instead.

A landed copy belongs to a version: a digest of the input's file listing
(names, sizes, times; through Spark's file systems, so for any store) and of
the deriving code. A table is landed when a query first reads it, so a report
over the orders does not wait for the page files. Each landing of a table
writes a folder of its own and a marker last, so nothing that is being read is
overwritten.
"""

from __future__ import annotations

import hashlib
import inspect
import os
import sys
import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from boxoffice.functions.money import money_or_zero
from boxoffice.operators.joins import hot_keys
from boxoffice.session import checkpoint_dir, first_partitions
from boxoffice.sources import fixtures, raw
from boxoffice.sources.files import exists, files_below, folders_in, touch

MARKER = "_LANDED"
# Landed tables and the driver tables that they come from.
LANDED = {"events": ["customer", "nation"], "orders": ["orders"], "tickets": ["lineitem", "orders"],
          "raw_charges": ["orders"], "control": ["customer"], "event_sizes": ["lineitem", "orders"],
          "order_details": ["orders"], "order_places": ["orders"], "checkin_places": ["orders", "lineitem"], "order_pages": ["orders", "lineitem"], "checkin_pages": ["orders", "lineitem"]}
# Made from what has been landed before; the pages are JSON lines, as the answers of the paged lists are.
FROM_LANDED = ["event_sizes", "order_details", "order_places", "checkin_places", *raw.PAGE_FILES]
# Bytes that a landing's reduce task gets, as shuffled. Text and arrays take many times that in memory, where a task sorts them.
LANDING_SHARE = 16 << 20
LINES_IN_A_FILE = 2000  # pages; a compressed file is read by one task

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]


@dataclass
class Tables:
    spark: SparkSession
    root: str
    landed_at: str | None = None  # folder of the landed copies of the input's version; None derives inline
    _cache: dict = field(default_factory=dict, repr=False)

    def raw(self, name: str) -> DataFrame:
        """A driver table, read from ``{root}/{name}.parquet`` (a file or a folder of part files)."""
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._cache[name]

    # ticket-sales tables (flat names; see FIXTURES.md part 2)
    def derive(self, name: str) -> DataFrame:
        """Derive one ticket-sales table from the driver tables."""
        if name == "events":
            return fixtures.events(self.raw("customer"), self.raw("nation"))
        if name == "orders":
            return fixtures.orders(self.raw("orders"))
        if name == "tickets":
            return fixtures.tickets(self.raw("lineitem"), self.raw("orders"))
        if name == "raw_charges":
            return fixtures.raw_charges(self.raw("orders"))
        if name == "control":
            return fixtures.control(self.raw("customer"))
        if name == "event_sizes":
            return self._sizes()
        if name in ("order_details", "order_places", "checkin_places", *raw.PAGE_FILES):
            return getattr(raw, name)(self)
        raise KeyError(name)

    def _sizes(self) -> DataFrame:
        """Orders, tickets and priced tickets of each event that has any, and of all; combines map-side."""
        orders = self.orders.groupBy("event_id").agg(F.count("*").alias("orders"))
        tickets = self.tickets.groupBy("event_id").agg(F.count("*").alias("tickets"), F.count(F.when(money_or_zero("price") > 0, 1)).alias("priced_tickets"))
        sizes = orders.join(tickets, "event_id", "full").fillna(0, ["orders", "tickets", "priced_tickets"])
        return sizes.select("*", F.lit(self.orders.count()).cast("long").alias("all_orders"),
                            F.lit(self.tickets.count()).cast("long").alias("all_tickets"))

    def hot_events(self, table: str) -> DataFrame:
        """Events that hold more of ``table`` (orders or tickets) than a shuffle partition's fair share."""
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return hot_keys(self.event_sizes, "event_id", table, f"all_{table}", partitions)

    def _table(self, name: str) -> DataFrame:
        if not self.landed_at:
            return self.derive(name)
        at = land_table(self.spark, self.root, self.landed_at, name)
        if name in raw.PAGE_FILES:
            return self.spark.read.schema(raw.PAGE_FILES[name]).json(at)
        return self.spark.read.parquet(at)

    @cached_property
    def events(self) -> DataFrame:
        return self._table("events")

    @cached_property
    def orders(self) -> DataFrame:
        return self._table("orders")

    @cached_property
    def tickets(self) -> DataFrame:
        return self._table("tickets")

    @cached_property
    def raw_charges(self) -> DataFrame:
        return self._table("raw_charges")

    @cached_property
    def charges(self) -> DataFrame:
        """Landed card charges (succeeded, not the excluded descriptor)."""
        from boxoffice.operators.ingest import charges_extract
        return charges_extract(self.raw_charges)

    @cached_property
    def control(self) -> DataFrame:
        return self._table("control")

    @cached_property
    def event_sizes(self) -> DataFrame:
        return self._table("event_sizes")

    @cached_property
    def order_details(self) -> DataFrame:
        """Answers of the order details, one per order."""
        return self._table("order_details")

    @cached_property
    def order_places(self) -> DataFrame:
        """Orders with their page of the order list, of which the page files are made."""
        return self._table("order_places")

    @cached_property
    def checkin_places(self) -> DataFrame:
        """Redeemed tickets with their page of the check-in list."""
        return self._table("checkin_places")

    @cached_property
    def order_pages(self) -> DataFrame:
        """Landed page files of the order list."""
        return self._table("order_pages")

    @cached_property
    def checkin_pages(self) -> DataFrame:
        """Landed page files of the check-in list."""
        return self._table("checkin_pages")

    @cached_property
    def attempts(self) -> DataFrame:
        """The mail service's answers (input of the delivery operators)."""
        return fixtures.attempts(self.raw("customer"))

    @cached_property
    def commands(self) -> DataFrame:
        """Operators' commands on the control table (input)."""
        return fixtures.commands(self.raw("customer"))


class LandedTables(Tables):
    """The table bundle over a landing zone: typed reads of the landed lines, the latest snapshot of each key.

    ``src`` gives what is not landed (the control table, the mail service's answers).
    """

    def __init__(self, src: Tables, landing: str):
        super().__init__(src.spark, src.root, src.landed_at)
        self.landing = landing

    def _typed(self, name: str) -> DataFrame:
        from boxoffice.sources.landing import LANDED_KEYS, LANDED_SCHEMAS, latest_landed
        return latest_landed(self.spark, f"{self.landing}/{name}", LANDED_SCHEMAS[name], *LANDED_KEYS[name])

    @cached_property
    def events(self) -> DataFrame:
        return self._typed("events").select(*fixtures.EVENT_COLUMNS, F.to_date(F.col("start").cast("timestamp")).alias("event_date"))

    @cached_property
    def orders(self) -> DataFrame:
        o = self._typed("orders")
        return o.select("id", "event_id", "total_paid", "first_name", "last_name", "email", "phone", "opted_in", "opted_in_sms", "paid_date_utc",
                        *[F.col(f).alias(f"fee_{f}") for f in ("surcharge", "let_tax", "sales_tax", "venue_fee")], _landed_day())

    @cached_property
    def tickets(self) -> DataFrame:
        k = self._typed("tickets")
        return k.select("id", "order_id", "event_id", "ticket_type_id", "ticket_type_price_id", "ticket_type_name", "price", "surcharge", "let_tax",
                        "sales_tax", "venue_fee", "redeemed", "promo_code", _landed_day())

    @cached_property
    def charges(self) -> DataFrame:
        return self._typed("charges").select("id", "created", "event_date", "payment_intent", "ticketsauce_order_id")

    @cached_property
    def event_sizes(self) -> DataFrame:
        return self._sizes()


def _landed_day() -> Column:
    return F.try_to_timestamp(F.concat_ws("-", "year", "month", "day"), F.lit("yyyy-MMMM-dd")).cast("date").alias("event_date")


def landed_root(spark: SparkSession, root: str) -> str:
    """Folder of all landings of one version of an input folder."""
    place = root if "://" in root or root.startswith("file:") else os.path.abspath(root)
    names = sorted({n for needed in LANDED.values() for n in needed})
    listing = [(n, files_below(spark, f"{root}/{n}.parquet")) for n in names]
    code = inspect.getsource(fixtures) + inspect.getsource(raw) + inspect.getsource(sys.modules[__name__])
    key = f"{place}|{listing}|{code}"
    return os.path.join(checkpoint_dir(spark), "landed", hashlib.sha1(key.encode()).hexdigest()[:16])


def input_size(spark: SparkSession, root: str, names: list[str]) -> int:
    """Bytes of some driver tables of ``root``."""
    return sum(n for name in names for _, n, _ in files_below(spark, f"{root}/{name}.parquet"))


def _latest(spark: SparkSession, base: str, name: str) -> str | None:
    """The last whole landing of a table below ``base`` (one with its marker)."""
    whole = [(at, f) for f, at in folders_in(spark, base) if f.startswith(f"{name}-") and exists(spark, f"{base}/{f}/{MARKER}")]
    return f"{base}/{max(whole)[1]}/{name}" if whole else None


@contextmanager
def landing_conf(spark: SparkSession, input_bytes: int):
    """Within it, a shuffle has partitions by the size of the input, and lists are collected group by
    group from sorted rows (the hashed aggregate gives up after a few keys and sorts what it has). What a
    landing shuffled goes with its end (Spark keeps it until the driver collects its garbage), so that the
    disk holds that of one landing at a time."""
    conf = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": first_partitions(spark, input_bytes), "spark.sql.adaptive.advisoryPartitionSizeInBytes": LANDING_SHARE,
            "spark.sql.execution.useObjectHashAggregateExec": "false", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    old = {n: spark.conf.get(n, None) for n in conf}
    for n, v in conf.items():
        spark.conf.set(n, str(v))
    try:
        yield
    finally:
        for n, v in old.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def land_table(spark: SparkSession, root: str, base: str, name: str, refresh: bool = False) -> str:
    """Derive and write one ticket-sales table of ``root``, unless it is there; returns its folder.

    The marker is written last, so a half-written landing is never read; of two
    jobs that land at once both write whole copies, and the later one counts.
    ``base`` is the version that the bundle was loaded with: input that has
    changed since is an error, as its rows would not fit those landed before.
    """
    at = None if refresh else _latest(spark, base, name)
    if at:
        return at
    if landed_root(spark, root) != base:
        raise RuntimeError(f"{root} has changed since its tables were loaded")
    folder = f"{base}/{name}-{uuid.uuid4().hex}"
    df = Tables(spark, root, landed_at=base if name in FROM_LANDED else None).derive(name)
    if name == "events":
        # row groups narrow in event date, so date-bounded scans skip the rest;
        # a sort inside each task, so a hot date does not gather in one
        df = df.repartition("id").sortWithinPartitions("event_date")
    with landing_conf(spark, input_size(spark, root, LANDED[name])):
        if name in raw.PAGE_FILES:
            df.write.option("maxRecordsPerFile", LINES_IN_A_FILE).json(f"{folder}/{name}", compression="gzip")
        else:
            df.write.parquet(f"{folder}/{name}", compression="zstd")
    touch(spark, f"{folder}/{MARKER}")
    return f"{folder}/{name}"


def land_tables(spark: SparkSession, root: str, refresh: bool = False) -> str:
    """Land all ticket-sales tables of ``root``; returns the folder of its version."""
    root = root.rstrip("/")
    base = landed_root(spark, root)
    for name in LANDED:
        land_table(spark, root, base, name, refresh)
    return base


def load_tables(spark: SparkSession, root: str, landed: bool = True) -> Tables:
    """The table bundle of ``root``; with ``landed`` the derived tables are
    landed on first use and read from Parquet afterwards. A missing input is an error here."""
    t = Tables(spark, root.rstrip("/"))
    if landed:
        for name in sorted({n for needed in LANDED.values() for n in needed}):
            t.raw(name)
        t.landed_at = landed_root(spark, t.root)
    return t
