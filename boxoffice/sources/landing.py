"""Landing zone: hive-partitioned NDJSON snapshots, replacement by event, typed reads.

Write path (S-1, SURVEY 7.4 H-1/H-2). A poll brings whole snapshots of events:
an event's row, its orders, tickets, ticket types and check-ins. What a poll
brings for an event replaces all that the table holds for it, so a row that is
gone from the event's new snapshot is gone from the table; a snapshot older
than the one that is held changes nothing.

* Every row carries the event it was landed for (``_unit``; not a column of the
  typed tables) and ``ingested_at``.
* Next to the table lies a small index (``_index``, a change log): where and
  when each event was landed last. A poll looks its events up there and reads
  only the partitions that hold them, by their folders.
* The new rows are computed once, to a staging folder. The affected partitions
  (the events' new ones and all that the index names) get the other events'
  rows and the new ones by dynamic partition overwrite, and partitions that
  held only what has moved are removed.
* The index is written before the table. A job that stops in between leaves an
  index that names both the old and the new place, and its next run, or the
  event's next snapshot, rewrites both.
* On request the change set of the poll (insert, update, vanish) goes to a log
  (``_changes``).

Rows without an event (charges) are replaced by key. Their partition follows
from the time they were made, which never changes, so they need no index.

Read path (S-3): explicit schema, partition columns kept as text
(``day=05`` stays ``"05"``), latest snapshot per key via ``max_by`` (combines
map-side; no window over a possibly hot key).
"""

from __future__ import annotations

import calendar
import datetime as dt
import os
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.functions.text import url_slug
from boxoffice.functions.time import ts, ts_lit
from boxoffice.params import UNKNOWN_VENUE
from boxoffice.sources import changelog
from boxoffice.sources.files import existing, files_below, matching, remove, remove_all
from boxoffice.sources.schemas import evolve, inferred, merged, not_a_time, table_schema, typed

PARTS = ["venue", "year", "month", "day"]

EVENT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("organization_id", T.StringType()),
    T.StructField("organization_name", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("start", T.StringType()),
    T.StructField("start_utc", T.StringType()),
    T.StructField("ingested_at", T.TimestampType()),
])


# Bytes that a writing task gets at least, as staged.
SMALLEST_SHARE = 16 << 10

UNIT = "_unit"  # the event that a row was landed for
INDEX_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in [UNIT, *PARTS]] + [T.StructField("ingested_at", T.TimestampType())])


def placed(part: Column) -> Column:
    """A partition value; what is null or empty lies under ``unknown``."""
    return F.when(part.isNull() | (part == ""), F.lit(UNKNOWN_VENUE)).otherwise(part)


def event_parts(organization_name: str = "organization_name", start: str = "start") -> list[Column]:
    """S-2: landing partition of an event: venue slug, year, English month name, zero-padded day."""
    at = ts(start)
    parts = [url_slug(organization_name), F.date_format(at, "yyyy"), F.date_format(at, "MMMM"), F.date_format(at, "dd")]
    return [placed(c).alias(n) for c, n in zip(parts, PARTS)]


# What Spark writes as %XX in the name of a partition folder, besides control characters.
ESCAPED = "\"#%'*/:=?\\{[]^\x7f"


def _folder(path: str, part) -> str:
    name = lambda v: "".join(f"%{ord(c):02X}" if c in ESCAPED or c < " " else c for c in v)
    return os.path.join(path, *[f"{p}={name(part[p])}" for p in PARTS])


def read_landed(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """All landed rows (every snapshot still on disk), partition columns as text."""
    full = T.StructType(schema.fields + [T.StructField(p, T.StringType()) for p in PARTS])
    return spark.read.schema(full).json(path)


def latest_snapshot(landed: DataFrame, *key: str) -> DataFrame:
    """Latest snapshot per key (S-3 + H-2)."""
    key = key or ("id",)
    cols = [c for c in landed.columns if c not in key]
    g = landed.groupBy(*key).agg(F.max_by(F.struct(*cols), "ingested_at").alias("s"))
    return g.select(*key, *[F.col("s." + c).alias(c) for c in cols])


def latest_landed(spark: SparkSession, path: str, schema: T.StructType, *key: str) -> DataFrame:
    """``latest_snapshot`` of the table at ``path``, which seldom holds a key twice.

    Digests of the keys tell which ones may be there more than once; they are
    counted first and lie next to the table. Only the rows of those keys are
    gathered by key; all others are as they are read.
    """
    rows = read_landed(spark, path, schema).withColumn("_key", F.xxhash64(*key))
    at = os.path.join(path, "_again", uuid.uuid4().hex)
    rows.groupBy("_key").agg(F.count("*").alias("n")).filter("n > 1").select("_key").write.parquet(at)
    again = spark.read.schema("_key long").parquet(at)
    once = rows.join(again, "_key", "left_anti").drop("_key")
    more = latest_snapshot(rows.join(again, "_key", "left_semi").drop("_key"), *key)
    return more.unionByName(once)


def _read_folders(spark: SparkSession, path: str, folders: list[str], schema: T.StructType) -> DataFrame:
    """The rows below some partition folders of the table at ``path``; nothing else is listed."""
    full = T.StructType(schema.fields + [T.StructField(p, T.StringType()) for p in PARTS])
    return spark.read.schema(full).option("basePath", path).json(folders) if folders else spark.createDataFrame([], full)


@contextmanager
def dealt_evenly(spark: SparkSession, size: int):
    """Within it, rebalanced writes of about ``size`` bytes use all cores: many small files take longer than their bytes."""
    bytes_of = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    share = max(size // spark.sparkContext.defaultParallelism, SMALLEST_SHARE)
    names = ["spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.minPartitionSize"]
    old = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, str(min(share, bytes_of(old[n]))))
    try:
        yield
    finally:
        for n in names:
            spark.conf.set(n, old[n])


def change_set(old: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """The rows that differ between two snapshots: key, ``change`` and ``ingested_at`` (null for what vanished).

    ``insert`` (the key is new), ``update`` (another column than ``ingested_at``
    differs) or ``vanish``. Both have one row per key and the same columns; a
    null in a key is a value like others.
    """
    rest = [c for c in new.columns if c not in key and c != "ingested_at"]
    side = lambda df, s: df.select(*[F.col(k).alias(f"_{s}{k}") for k in key], F.struct(*rest).alias(s), F.col("ingested_at").alias(f"{s}_at"))
    o, n = side(old, "o"), side(new, "n")
    same = [o[f"_o{k}"].eqNullSafe(n[f"_n{k}"]) for k in key]
    change = F.when(F.col("o_at").isNull(), "insert").when(F.col("n_at").isNull(), "vanish").when(~F.col("o").eqNullSafe(F.col("n")), "update")
    both = o.join(n, same, "full").withColumn("change", change).filter(F.col("change").isNotNull())
    return both.select(*[F.when(F.col("n_at").isNull(), F.col(f"_o{k}")).otherwise(F.col(f"_n{k}")).alias(k) for k in key],
                       "change", F.col("n_at").alias("ingested_at"))


def index_entries(spark: SparkSession, path: str) -> DataFrame:
    """Where and when each event was landed: all entries that the index of the table at ``path`` holds."""
    return changelog.entries(spark, os.path.join(path, "_index"), INDEX_SCHEMA)


def landed_partitions(spark: SparkSession, path: str) -> DataFrame:
    """The partitions that hold events now, from the index: no file of the table is listed or read."""
    return changelog.latest(index_entries(spark, path), UNIT).select(*PARTS).distinct()


def affected_folders(path: str, accepted: DataFrame, entries: DataFrame) -> list[str]:
    """Partition folders of the accepted events' new rows and of every place that the index names for them.

    What reaches the driver is a name per partition that the poll touches.
    """
    places = accepted.select(*PARTS).union(entries.join(accepted.select(UNIT), UNIT, "left_semi").select(*PARTS)).distinct()
    return sorted(_folder(path, r) for r in places.collect())


def land_rows(spark: SparkSession, incoming: DataFrame, path: str, *key: str, unit: str | None = None,
              polled: DataFrame | None = None, log_changes: bool = False, evolving: bool = False, staged: str | None = None) -> None:
    """Land a poll's rows in the table at ``path`` (S-1, any table).

    ``incoming`` has one row per key and snapshot, its partition columns and
    ``ingested_at``. With ``unit`` (the column that tells the event; it is not a
    column of the table) the snapshots of whole events are replaced; ``polled``
    names events (``_unit``, partition columns, ``ingested_at``) that were asked
    for, so that one without rows is emptied; rows that tell no event are not
    landed. Without ``unit`` rows are replaced by key. A null or empty partition value lies under ``unknown``. Landing the
    same batch again gives the same table. An ``evolving`` table keeps a schema
    of its own, which grows with what polls bring (``sources/schemas.py``).
    Rows that are read from files already (of the folder ``staged``) are not staged again.
    """
    fields = [f for f in incoming.schema.fields if f.name not in PARTS and f.name != unit]
    parts = [placed(F.col(p)).alias(p) for p in PARTS]
    own = [F.col(unit).cast("string").alias(UNIT)] if unit else []
    if evolving:
        fields = evolve(spark, path, T.StructType(fields)).fields
        here = {f.name for f in incoming.schema.fields}
        incoming = incoming.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields if f.name not in here])
        incoming = incoming.withColumns({f.name: F.col(f.name).cast(f.dataType) for f in fields})
    schema = T.StructType([*fields, T.StructField(UNIT, T.StringType())] if unit else fields)
    staging = os.path.join(path, "_staging", uuid.uuid4().hex)

    def stage(df: DataFrame, name: str) -> DataFrame:
        at = os.path.join(staging, name)
        df.write.parquet(at, compression="zstd")
        return spark.read.schema(df.schema).parquet(at)

    new = incoming.select(*[f.name for f in fields], *own, *parts)
    new = new if staged else stage(new, "incoming")
    if unit:
        units = new.select(UNIT, *PARTS, "ingested_at")
        if polled is not None:
            units = units.unionByName(polled.select(F.col(UNIT).cast("string"), *parts, "ingested_at"))
        units = units.groupBy(UNIT).agg(F.max_by(F.struct(*PARTS), "ingested_at").alias("p"), F.max("ingested_at").alias("ingested_at")).select(
            UNIT, "p.*", "ingested_at")
        entries = index_entries(spark, path)
        held = entries.groupBy(UNIT).agg(F.max("ingested_at").alias("_held"))
        # a snapshot older than the one that is held changes nothing
        accepted = stage(units.join(held, UNIT, "left").filter(F.col("_held").isNull() | (F.col("ingested_at") >= F.col("_held"))).drop("_held"), "accepted")
        # most polls bring no older snapshot: what is left out is few, what comes in is not shuffled for it
        snapshots = new.filter(F.col(UNIT).isNotNull() & F.col("ingested_at").isNotNull())
        pairs = snapshots.select(UNIT, "ingested_at").distinct()
        older = stage(pairs.join(accepted.select(UNIT, "ingested_at"), [UNIT, "ingested_at"], "left_anti"), "older")
        new = snapshots.join(older, [UNIT, "ingested_at"], "left_anti").select(*new.columns)
        there = existing(spark, affected_folders(path, accepted, entries))
        old = _read_folders(spark, path, there, schema)
        kept = old.join(accepted.select(UNIT), UNIT, "left_anti").select(*new.columns)
    else:
        there = existing(spark, sorted(_folder(path, r) for r in new.select(*PARTS).distinct().collect()))
        old = _read_folders(spark, path, there, schema)
        kept = latest_snapshot(old.unionByName(new), *key).select(*new.columns)
    if there or not unit:
        kept = stage(kept, "kept")
    if log_changes:
        before = old.join(accepted.select(UNIT), UNIT, "left_semi") if unit else old
        content = [f.name for f in fields]
        changelog.append(change_set(latest_snapshot(before.select(*content), *key), new.select(*content), *key),
                         os.path.join(path, "_changes"))
    if unit:
        changelog.append(accepted, os.path.join(path, "_index"))
    rows = kept.unionByName(new) if there and unit else new if unit else kept
    # without an affected folder there is nothing to replace (what a lost job left is one when it is run again)
    writer = rows.hint("rebalance", *PARTS).write.partitionBy(*PARTS)
    writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic") if there else writer.mode("append")
    with dealt_evenly(spark, sum(size for at in [staging, staged] if at for _, size, _ in files_below(spark, at))):
        writer.json(path, compression="gzip")
    if there:
        filled = {_folder(path, r) for r in rows.select(*PARTS).distinct().collect()}
        remove_all(spark, [p for p in there if p not in filled])
    if unit:
        last = lambda log: changelog.latest(log, UNIT).select(*INDEX_SCHEMA.names, changelog.VERSION)
        changelog.fold(spark, os.path.join(path, "_index"), INDEX_SCHEMA, last)
    remove(spark, staging)


def land_lines(spark: SparkSession, lines: DataFrame, path: str, quarantine: str, ingested_at: dt.datetime, key: str = "id") -> None:
    """Land a poll of event snapshots that comes as JSON lines (``value``), whatever columns they have.

    The lines' schema is merged into the table's. Lines that are no object,
    lack the key, or have a start that is no time go to the ``quarantine`` table.
    """
    own = {"ingested_at", UNIT, *PARTS}  # the landing's, whatever a line has under these names
    fields = lambda schema: T.StructType([f for f in schema.fields if f.name.lower() not in own])
    schema = fields(evolve(spark, path, merged(fields(EVENT_SCHEMA), fields(inferred(lines)))))
    good, bad = typed(lines, schema, [key], {"bad start": not_a_time("start"), "bad start_utc": not_a_time("start_utc")})
    bad.select("line", "reasons", ts_lit(ingested_at).alias("ingested_at")).write.mode("append").parquet(quarantine)
    rows = good.withColumn("ingested_at", ts_lit(ingested_at)).select("*", *event_parts(), F.col(key).alias("_event_id"))
    land_rows(spark, rows, path, key, unit="_event_id", evolving=True)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table that keeps its own schema."""
    return read_landed(spark, path, table_schema(spark, path))


MONTHS = list(calendar.month_name)[1:]


def days_from(day: dt.date) -> Column:
    """Partitions on or after ``day``: years and days compare as numbers, months by their names' order."""
    year, month, of = (F.col(c) for c in ("year", "month", "day"))
    later = (month == MONTHS[day.month - 1]) & (of.try_cast("int") >= day.day)
    if MONTHS[day.month:]:
        later = later | month.isin(MONTHS[day.month:])
    return (year.try_cast("int") > day.year) | ((year == f"{day.year:04d}") & later)


def days_to(day: dt.date) -> Column:
    """Partitions on or before ``day``."""
    year, month, of = (F.col(c) for c in ("year", "month", "day"))
    earlier = (month == MONTHS[day.month - 1]) & (of.try_cast("int") <= day.day)
    if MONTHS[:day.month - 1]:
        earlier = earlier | month.isin(MONTHS[:day.month - 1])
    return (year.try_cast("int") < day.year) | ((year == f"{day.year:04d}") & earlier)


def day_patterns(path: str, first: dt.date, last: dt.date) -> list[str]:
    """Glob patterns of the partition folders of a range of days: whole years, whole months, days."""
    out, at = [], first
    while at <= last:
        month = f"{path}/venue=*/year={at.year:04d}/month={MONTHS[at.month - 1]}"
        ends = dt.date(at.year, at.month, calendar.monthrange(at.year, at.month)[1])
        if at.timetuple().tm_yday == 1 and dt.date(at.year, 12, 31) <= last:
            out.append(f"{path}/venue=*/year={at.year:04d}")
            at = dt.date(at.year, 12, 31)
        elif at.day == 1 and ends <= last:
            out.append(month)
            at = ends
        else:
            out += [f"{month}/day={at.day:02d}"] + [f"{month}/day={at.day}"] * (at.day < 10)  # charges' days are not padded
        if at == dt.date.max:
            break
        at += dt.timedelta(days=1)
    return out


def read_days(spark: SparkSession, path: str, schema: T.StructType, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """P-14: the rows of a range of days (None: open) of a landed table.

    A closed range lists the folders of its own days only; an open one is a
    filter on the partition columns.
    """
    if first and last:
        return _read_folders(spark, path, matching(spark, day_patterns(path, first, last)), schema)
    rows = read_landed(spark, path, schema)
    if first:
        rows = rows.filter(days_from(first))
    return rows.filter(days_to(last)) if last else rows


def land_snapshots(spark: SparkSession, incoming: DataFrame, path: str,
                   ingested_at: dt.datetime | None = None, key: str = "id", **options) -> None:
    """``land_rows`` for event snapshots; without ``ingested_at`` they carry that column."""
    if ingested_at is not None:
        incoming = incoming.withColumn("ingested_at", ts_lit(ingested_at))
    columns = [f.name for f in EVENT_SCHEMA.fields]
    rows = incoming.select(*columns, *event_parts(), F.col(key).alias("_event_id"))
    land_rows(spark, rows, path, key, unit="_event_id", **options)


def landed_changes(spark: SparkSession, path: str, schema: T.StructType, *key: str) -> DataFrame:
    """The change sets of all polls of the table at ``path`` that logged them."""
    fields = [schema[k] for k in key] + [T.StructField("change", T.StringType()), T.StructField("ingested_at", T.TimestampType())]
    return changelog.entries(spark, os.path.join(path, "_changes"), T.StructType(fields))


def register_tables(spark: SparkSession, root: str, names: list[str], prefix: str,
                    schemas: dict[str, T.StructType] | None = None) -> list[str]:
    """S-4/S-5: register each landed table folder ``root/name`` as an external catalog table
    ``prefix + name`` with its own schema, and its partitions.

    A table that is registered already only gets its new partitions.
    """
    out = []
    for n in names:
        schema = (schemas or LANDED_SCHEMAS)[n]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = ", ".join(f"{p} string" for p in PARTS)
        spark.sql(f"CREATE TABLE IF NOT EXISTS `{prefix}{n}` ({columns}, {parts}) USING json "
                  f"PARTITIONED BY ({', '.join(PARTS)}) LOCATION '{os.path.join(root, n)}'")
        spark.catalog.recoverPartitions(f"`{prefix}{n}`")
        out.append(prefix + n)
    return out


def drop_tables(spark: SparkSession, prefix: str) -> list[str]:
    """S-6: drop the tables whose name starts with ``prefix`` (external: their files stay)."""
    dropped = sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(prefix))
    for name in dropped:
        spark.sql(f"DROP TABLE `{name}`")
    return dropped


def _schema(columns: str) -> T.StructType:
    """``name type, ...`` with string as the default type, and ``ingested_at``."""
    out = T.StructType()
    for c in [*columns.split(), "ingested_at:timestamp"]:
        name, _, kind = c.partition(":")
        out = out.add(name, {"": T.StringType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}[kind])
    return out


# The columns of the landed tables.
FEES = "ticketing_fee surcharge let_tax sales_tax venue_fee admin_fee_not_a_gratuity_ gratuity"
LANDED_SCHEMAS = {
    "events": EVENT_SCHEMA,
    "orders": _schema("id event_id total_paid first_name last_name email phone opted_in:boolean "
                      f"opted_in_sms:boolean paid_date_utc {FEES}"),
    "tickets": _schema("id order_id event_id price name ticket_type_id ticket_type_name ticket_type_price "
                       "ticket_type_price_id redeemed:boolean promo_code order_total_paid "
                       f"order_total_face_value {FEES}"),
    "ticket_types": _schema("ticket_type_id ticket_type_price_id event_id ticket_type_name ticket_type_price"),
    "checkin_ids": _schema("ticket_id"),
    "charges": _schema("id created:timestamp event_date payment_intent ticketsauce_order_id"),
}
LANDED_KEYS = {"events": ["id"], "orders": ["id"], "tickets": ["id"],
               "ticket_types": ["event_id", "ticket_type_id", "ticket_type_price_id"],
               "checkin_ids": ["ticket_id"], "charges": ["id"]}
