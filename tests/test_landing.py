"""Landing zone (S-1..S-6, H-1, H-2) and the CSV sink (S-9)."""

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.operators import manifest as mf
from boxoffice.session import checkpoint_dir
from boxoffice.sources import changelog, landing
from boxoffice.sources.files import folders_in
from boxoffice.sources.landing import (drop_tables, land_rows, land_snapshots, landed_changes, latest_snapshot,
                                       read_landed, register_tables)

EV = "id string, name string, organization_id string, organization_name string, location string, " \
     "start string, start_utc string"


def _path(spark, name):
    return os.path.join(checkpoint_dir(spark), f"test-{name}-{uuid.uuid4().hex[:8]}")


def _events(spark, rows):
    return spark.createDataFrame(rows, EV)


def test_keyed_replace_keeps_siblings_and_moves(spark):
    path = os.path.join(_path(spark, "land"), "events")
    a = ("1", "A", "org-1", "Test Location", "Hall", "2023-10-15T20:00:00", "2023-10-16T03:00:00")
    b = ("2", "B", "org-1", "Test Location", "Hall", "2023-10-15 21:00:00", "2023-10-16 04:00:00")
    land_snapshots(spark, _events(spark, [a, b]), path, dt.datetime(2024, 1, 1))
    # the partition path of the reference's path test
    assert os.path.isdir(os.path.join(path, "venue=test-location", "year=2023", "month=October",
                                      "day=15"))
    # event 1 is rescheduled to the 16th; event 2 (same old partition) must survive
    a2 = a[:5] + ("2023-10-16 20:00:00", "2023-10-17 03:00:00")
    land_snapshots(spark, _events(spark, [a2]), path, dt.datetime(2024, 1, 2))
    raw = read_landed(spark, path)
    assert raw.filter(F.col("id") == "2").count() == 1
    snap = {r["id"]: r for r in latest_snapshot(raw).collect()}
    assert snap["1"]["day"] == "16" and snap["1"]["start"].startswith("2023-10-16")
    assert snap["2"]["day"] == "15"  # text, zero-padded, not the integer 15
    # nothing is left behind
    assert not os.listdir(os.path.join(path, "_staging"))
    # landing the same batch again changes nothing
    before = sorted(map(tuple, latest_snapshot(read_landed(spark, path)).collect()))
    land_snapshots(spark, _events(spark, [a2]), path, dt.datetime(2024, 1, 2))
    after = sorted(map(tuple, latest_snapshot(read_landed(spark, path)).collect()))
    assert before == after


def test_moved_event_alone_in_its_partition(spark):
    path = os.path.join(_path(spark, "alone"), "events")
    a = ("7", "A", "org-1", "Solo Venue", "Hall", "2024-01-03 22:30:00", "2024-01-04 06:30:00")
    land_snapshots(spark, _events(spark, [a]), path, dt.datetime(2024, 1, 1))
    a2 = a[:5] + ("2024-01-05 22:30:00", "2024-01-06 06:30:00")
    land_snapshots(spark, _events(spark, [a2]), path, dt.datetime(2024, 1, 2))
    snap = latest_snapshot(read_landed(spark, path)).collect()
    assert len(snap) == 1 and snap[0]["day"] == "05"
    # the partition that became empty is gone
    assert read_landed(spark, path).count() == 1


def test_siblings_of_an_unnamed_venue_survive(spark):
    """Three events of a null organization name on one day; one of them is landed again, then moves."""
    path = os.path.join(_path(spark, "nullvenue"), "events")
    rows = [(str(i), f"E{i}", "org", None, "Hall", "2024-01-03 22:30:00", "2024-01-04 06:30:00") for i in (1, 2, 3)]
    land_snapshots(spark, _events(spark, rows), path, dt.datetime(2024, 1, 1))
    land_snapshots(spark, _events(spark, [rows[1]]), path, dt.datetime(2024, 1, 2))
    assert sorted(r.id for r in read_landed(spark, path).collect()) == ["1", "2", "3"]
    moved = rows[1][:5] + ("2024-01-09 22:30:00", "2024-01-10 06:30:00")
    land_snapshots(spark, _events(spark, [moved]), path, dt.datetime(2024, 1, 3))
    assert sorted((r.id, r.venue, r.day) for r in read_landed(spark, path).collect()) == [
        ("1", "unknown", "03"), ("2", "unknown", "09"), ("3", "unknown", "03")]


def test_an_older_snapshot_changes_nothing(spark):
    path = os.path.join(_path(spark, "older"), "events")
    day = lambda d: [("1", "A", "o", "V", "H", f"2024-01-{d} 10:00:00", f"2024-01-{d} 18:00:00")]
    land_snapshots(spark, _events(spark, day("05")), path, dt.datetime(2024, 1, 2))
    land_snapshots(spark, _events(spark, day("03")), path, dt.datetime(2024, 1, 1))
    assert [(r.day, r.ingested_at) for r in read_landed(spark, path).collect()] == [("05", dt.datetime(2024, 1, 2))]
    # two snapshots in one batch, the newer one first
    both = _events(spark, day("08")).withColumn("ingested_at", F.lit(dt.datetime(2024, 1, 4))).union(
        _events(spark, day("07")).withColumn("ingested_at", F.lit(dt.datetime(2024, 1, 3))))
    land_snapshots(spark, both, path)
    assert [(r.day, r.ingested_at) for r in read_landed(spark, path).collect()] == [("08", dt.datetime(2024, 1, 4))]


ROWS = "id string, event string, note string, venue string, year string, month string, day string"


def _orders(spark, ids, at, event="e1", day="05", note="x"):
    rows = [(i, event, note, "v", "2024", "January", day) for i in ids]
    return spark.createDataFrame(rows, ROWS).withColumn("ingested_at", F.lit(at))


def _ids(spark, path):
    schema = T.StructType().add("id", "string").add("note", "string").add("ingested_at", "timestamp")
    return sorted((r.id, r.note, r.day) for r in read_landed(spark, path, schema).collect())


def test_rows_gone_from_an_events_snapshot_are_gone(spark):
    path = os.path.join(_path(spark, "gone"), "orders")
    land = lambda df, **o: land_rows(spark, df, path, "id", unit="event", **o)
    land(_orders(spark, "abc", dt.datetime(2024, 1, 1)).union(_orders(spark, "z", dt.datetime(2024, 1, 1), "e2")))
    land(_orders(spark, "ac", dt.datetime(2024, 1, 2)).union(_orders(spark, "d", dt.datetime(2024, 1, 2), note="new")), log_changes=True)
    assert _ids(spark, path) == [("a", "x", "05"), ("c", "x", "05"), ("d", "new", "05"), ("z", "x", "05")]
    log = landed_changes(spark, path, T.StructType().add("id", "string"), "id")
    assert sorted((r.id, r.change) for r in log.collect()) == [("b", "vanish"), ("d", "insert")]
    # the event moves and loses an order; its sibling stays
    land(_orders(spark, "a", dt.datetime(2024, 1, 3), day="09"))
    assert _ids(spark, path) == [("a", "x", "09"), ("z", "x", "05")]
    # asked for and without rows: empty now
    polled = spark.createDataFrame([("e1", "v", "2024", "January", "09")], "_unit string, venue string, year string, month string, day string")
    land(_orders(spark, [], dt.datetime(2024, 1, 4)), polled=polled.withColumn("ingested_at", F.lit(dt.datetime(2024, 1, 4))))
    assert _ids(spark, path) == [("z", "x", "05")]


def test_a_job_lost_before_the_swap_is_mended_by_the_next_snapshot(spark, monkeypatch):
    """The index names the new place, the table still has the old one."""
    path = os.path.join(_path(spark, "lost"), "orders")
    land_rows(spark, _orders(spark, "ab", dt.datetime(2024, 1, 1)), path, "id", unit="event")
    accepted = _orders(spark, "a", dt.datetime(2024, 1, 2), day="07").select(
        F.col("event").alias("_unit"), "venue", "year", "month", "day", "ingested_at")
    changelog.append(accepted, os.path.join(path, "_index"))
    land_rows(spark, _orders(spark, "a", dt.datetime(2024, 1, 3), day="09"), path, "id", unit="event")
    assert _ids(spark, path) == [("a", "x", "09")]


def test_a_poll_reads_only_the_partitions_of_its_events(spark):
    """No listing or scan of the table: the old rows come from the folders that the index names."""
    path = os.path.join(_path(spark, "index"), "orders")
    for i in range(6):
        land_rows(spark, _orders(spark, [f"{i}a", f"{i}b"], dt.datetime(2024, 1, 1), f"e{i}", f"0{i + 1}"), path, "id", unit="event")
    accepted = _orders(spark, ["2a"], dt.datetime(2024, 1, 2), "e2", "09").select(
        F.col("event").alias("_unit"), "venue", "year", "month", "day", "ingested_at")
    folders = landing.existing(spark, landing.affected_folders(path, accepted, landing.index_entries(spark, path)))
    assert [f.rsplit("/", 1)[1] for f in folders] == ["day=03"]
    old = landing._read_folders(spark, path, folders, T.StructType().add("id", "string"))
    assert len(old.inputFiles()) == 1 and sorted(r.id for r in old.collect()) == ["2a", "2b"]


def test_odd_partition_names(spark):
    """Folder names are escaped as Spark writes them; null and empty ones lie under unknown."""
    path = os.path.join(_path(spark, "odd"), "orders")
    venues = ["a b", "x=y:z", "50%", "", None, "[q]#1", "é"]
    def rows(at):
        df = spark.createDataFrame([(f"o{i}", f"e{i}", "x", v, "2024", "January", "05") for i, v in enumerate(venues)], ROWS)
        return df.withColumn("ingested_at", F.lit(at))
    land_rows(spark, rows(dt.datetime(2024, 1, 1)), path, "id", unit="event")
    land_rows(spark, rows(dt.datetime(2024, 1, 2)).filter("event != 'e1'"), path, "id", unit="event")
    schema = T.StructType().add("id", "string").add("ingested_at", "timestamp")
    got = {r.id: (r.venue, r.ingested_at.day) for r in read_landed(spark, path, schema).collect()}
    assert got == {f"o{i}": (v or "unknown", 1 if i == 1 else 2) for i, v in enumerate(venues)}
    assert read_landed(spark, path, schema).count() == len(venues)


def test_the_index_does_not_grow_with_the_polls(spark, monkeypatch):
    monkeypatch.setattr(changelog, "MOST_FOLDERS", 3)
    path = os.path.join(_path(spark, "folded"), "orders")
    for d in range(1, 8):
        land_rows(spark, _orders(spark, "ab", dt.datetime(2024, 1, d), day=f"0{d}"), path, "id", unit="event")
    assert len(folders_in(spark, os.path.join(path, "_index"))) <= 4
    assert _ids(spark, path) == [("a", "x", "07"), ("b", "x", "07")]


def test_a_changed_input_is_landed_again(spark, tmp_path):
    """Source orders doubled under a file:// root are seen; the first landing stays whole."""
    import shutil

    from boxoffice.sources.tables import load_tables
    from tests.conftest import SF_SMALL

    for name in ("orders", "lineitem", "customer", "nation"):
        shutil.copy(f"{SF_SMALL}/{name}.parquet", tmp_path / f"{name}.parquet")
    root = f"file://{tmp_path}"
    first = load_tables(spark, root)
    n = first.orders.count()
    assert load_tables(spark, root).landed_at == first.landed_at
    both = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    both.union(both).write.parquet(str(tmp_path / "twice"))
    (tmp_path / "orders.parquet").unlink()
    (tmp_path / "twice").rename(tmp_path / "orders.parquet")
    second = load_tables(spark, root)
    assert second.orders.count() == 2 * n and first.orders.count() == n
    assert load_tables(spark, root).landed_at == second.landed_at


def test_a_failed_landing_is_an_error(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException

    from boxoffice.sources.tables import load_tables

    with pytest.raises(AnalysisException):
        load_tables(spark, str(tmp_path))


def test_register_and_drop_views(spark):
    root = _path(spark, "catalog")
    land_snapshots(spark, _events(spark, [("1", "A", "o", "V", "H", "2024-01-01 10:00:00",
                                           "2024-01-01 18:00:00")]),
                   os.path.join(root, "events"), dt.datetime(2024, 1, 1))
    names = register_tables(spark, root, ["events"], "tw_")
    assert names == ["tw_events"]
    assert spark.sql("SELECT count(*) AS n FROM tw_events").first()["n"] == 1
    # S-5: a partition that came later is found when registering again
    land_snapshots(spark, _events(spark, [("2", "B", "o", "V", "H", "2024-01-09 10:00:00", "2024-01-09 18:00:00")]),
                   os.path.join(root, "events"), dt.datetime(2024, 1, 2))
    register_tables(spark, root, ["events"], "tw_")
    assert [r.day for r in spark.sql("SELECT day FROM tw_events ORDER BY day").collect()] == ["01", "09"]
    assert drop_tables(spark, "tw_") == ["tw_events"]
    assert read_landed(spark, os.path.join(root, "events")).count() == 2


def test_every_landed_table_is_registered_with_its_own_columns(spark, tables):
    from boxoffice.sources.landing import LANDED_KEYS, LANDED_SCHEMAS
    from boxoffice.streaming import jobs

    root = _path(spark, "six")
    for name in LANDED_KEYS:
        jobs.landing_table(tables, name, at=root)
    register_tables(spark, root, list(LANDED_KEYS), "six_")
    for name, schema in LANDED_SCHEMAS.items():
        got = spark.table(f"six_{name}")
        assert got.columns == [*schema.names, "venue", "year", "month", "day"]
        assert got.count() == read_landed(spark, os.path.join(root, name), schema).count() > 0
        assert got.filter(F.col(schema.names[0]).isNull()).count() == 0
    assert len(drop_tables(spark, "six_")) == 6


def test_manifest_csv_sink(spark, tables):
    path = _path(spark, "csv")
    rows = mf.manifest_csv_surcharge(tables)
    mf.write_manifest_csv(rows, path)
    back = spark.read.option("header", True).csv(path)
    assert back.count() == rows.count()
    assert set(back.columns) >= {"venue", "total_surcharge", "event_id"}
    # the totals row has six blank leading cells (read back as nulls)
    tot = back.filter(F.col("venue").isNull())
    assert tot.count() == rows.filter(F.col("row_kind") == 1).count()


def test_a_query_lands_only_what_it_reads(spark, tmp_path):
    import pytest

    from boxoffice.operators import ingest as ig
    from boxoffice.sources.tables import load_tables
    from tests.conftest import SF_SMALL

    for name in ("orders", "lineitem", "customer", "nation"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    t = load_tables(spark, str(tmp_path))
    assert ig.charges_in_range(t).count() > 0
    assert {f.rsplit("-", 1)[0] for f, _ in folders_in(spark, t.landed_at)} == {"raw_charges"}
    # what a loaded bundle has not landed yet is not taken from other input
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").write.mode("append").parquet(str(tmp_path / "orders.parquet"))
    with pytest.raises(RuntimeError):
        t.orders


def test_partitions_follow_the_input(spark):
    from boxoffice.session import first_partitions

    few = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert first_partitions(spark, 1 << 20) == few and first_partitions(spark, 1 << 30) == 512


def test_reduce_tasks_stay_small(spark):
    """What a task sorts is bounded, however large the input: many first partitions, joined up to 16 MB."""
    from boxoffice.session import BASE_CONF

    assert BASE_CONF["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == "16MB"


def test_only_repeated_keys_are_gathered(spark):
    """The read of a landing equals the latest snapshot of each key, null keys and equal rows included."""
    path = _path(spark, "again")
    rows = [("a", "e1", "x", 1), ("a", "e2", "y", 2), ("b", "e1", "x", 1), (None, "e1", "n", 1), (None, "e1", "m", 2), ("c", "e1", "z", 1)]
    df = spark.createDataFrame(rows, "id string, event string, note string, n int").select(
        "id", "event", "note", F.make_timestamp(F.lit(2024), F.lit(1), "n", F.lit(0), F.lit(0), F.lit(0)).alias("ingested_at"),
        *[F.lit(v).alias(p) for p, v in zip(landing.PARTS, ("v", "2024", "January", "05"))])
    df.write.partitionBy(*landing.PARTS).json(path)
    schema = T.StructType().add("id", "string").add("note", "string").add("ingested_at", "timestamp")
    got = landing.latest_landed(spark, path, schema, "id")
    want = latest_snapshot(read_landed(spark, path, schema), "id")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert sorted((str(r.id), r.note) for r in got.collect()) == [("None", "m"), ("a", "y"), ("b", "x"), ("c", "z")]
    assert list(landing.LANDED_KEYS) and len([f for f, _ in folders_in(spark, os.path.join(path, "_again"))]) == 1


def test_landed_lines_are_compressed(spark):
    path = os.path.join(_path(spark, "gz"), "orders")
    land_rows(spark, _orders(spark, "ab", dt.datetime(2024, 1, 1)), path, "id", unit="event")
    assert all(f.endswith(".json.gz") for f in spark.read.json(path).inputFiles()) and len(_ids(spark, path)) == 2
