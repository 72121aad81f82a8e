"""Streaming = batch on the same inputs (SURVEY 5 (d))."""

from pyspark.sql import functions as F

from boxoffice.operators import delivery as dv
from boxoffice.params import AS_OF
from boxoffice.sources.tables import Tables
from boxoffice.streaming import jobs
from tests.conftest import SF_SMALL


def _same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_sales_24h_stream_equals_batch(tables):
    _same(jobs.stream_sales_24h(tables), jobs.sales_24h(tables))


def _copy_of(spark, tables, tmp_path, parts):
    """The driver tables, with lineitem as a folder to which files can be added; its files in random order."""
    import os

    root = tmp_path / "tables"
    os.makedirs(root / "lineitem.parquet")
    for name in ("orders", "customer", "nation"):
        os.symlink(f"{SF_SMALL}/{name}.parquet", root / f"{name}.parquet")
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").orderBy(F.xxhash64("l_orderkey", "l_linenumber")) \
         .repartition(parts).write.parquet(str(tmp_path / "split"))
    return str(root), sorted(str(f) for f in (tmp_path / "split").glob("*.parquet"))


def test_sales_24h_over_many_files_and_a_restart(spark, tables, tmp_path):
    """Files out of order, one to a micro-batch; the job stops, more files come, it goes on."""
    import shutil

    root, files = _copy_of(spark, tables, tmp_path, 6)
    assert len(files) == 6
    t = Tables(spark, root)
    at = str(tmp_path / "job")
    for f in files[:3]:
        shutil.copy(f, f"{root}/lineitem.parquet/")
    part = jobs.stream_sales_24h(t, at, files_per_trigger=1)
    sold = part.agg(F.sum("tickets_sold")).first()[0]
    for f in files[3:]:
        shutil.copy(f, f"{root}/lineitem.parquet/")
    whole = jobs.stream_sales_24h(Tables(spark, root), at, files_per_trigger=1)
    assert sold < whole.agg(F.sum("tickets_sold")).first()[0]
    _same(whole, jobs.sales_24h(tables))


def test_orders_that_come_after_their_tickets(spark, tables, tmp_path):
    """Half of the orders, all tickets, a stop, then the other orders: as if all had been there."""
    import os
    import shutil

    root, files = _copy_of(spark, tables, tmp_path, 2)
    for f in files:
        shutil.copy(f, f"{root}/lineitem.parquet/")
    os.unlink(f"{root}/orders.parquet")
    os.makedirs(f"{root}/orders.parquet")
    for rest in (0, 1):
        spark.read.parquet(f"{SF_SMALL}/orders.parquet").filter(F.col("o_orderkey") % 2 == rest).coalesce(1).write.parquet(str(tmp_path / f"half{rest}"))
    def come(rest):
        for f in (tmp_path / f"half{rest}").glob("*.parquet"):
            shutil.copy(f, f"{root}/orders.parquet/{rest}.parquet")

    at = str(tmp_path / "late")
    come(0)
    part = jobs.stream_sales_24h(Tables(spark, root), at, files_per_trigger=1)
    sold = part.agg(F.sum("tickets_sold")).first()[0]
    come(1)
    whole = jobs.stream_sales_24h(Tables(spark, root), at, files_per_trigger=1)
    assert 0 < sold < whole.agg(F.sum("tickets_sold")).first()[0]
    _same(whole, jobs.sales_24h(tables))


def test_ticks_in_one_file_equal_ticks_in_two(spark, tables, tmp_path):
    two = jobs.tick_times(AS_OF)
    at = str(tmp_path / "one-file")
    text = [(x.strftime("%Y-%m-%d %H:%M:%S"),) for x in reversed(two)] + [(None,)]
    spark.createDataFrame(text, "as_of string").coalesce(1).write.json(f"{at}/ticks")
    _same(jobs.stream_delivery_tick(tables, at=at, ticks=[]), jobs.stream_delivery_tick(tables))


def test_a_tick_writes_its_changes_only_and_again_the_same(spark, tables, tmp_path, monkeypatch):
    from boxoffice.sources import changelog

    monkeypatch.setattr(changelog, "MOST_FOLDERS", 1)
    at = str(tmp_path / "log")
    times = jobs.tick_times(AS_OF, 3)
    for x in times:
        jobs.stream_delivery_tick(tables, at=at, ticks=[x])
    log = f"{at}/control"
    state = tables.control
    for i, x in enumerate(times):
        changes = dv.outcome_changes(dv.delivery_outcomes(tables, x, state), x)
        state = dv.control_after_batch(tables, x, control=state)
        version = i * jobs.TICKS_IN_A_BATCH + 1
        if f"changes-{version}" in [n for n, _ in changelog.folders_in(spark, log)]:
            assert spark.read.parquet(f"{log}/changes-{version}").count() == changes.count() < tables.control.count()
    assert any(n.startswith("fold-") for n, _ in changelog.folders_in(spark, log))
    _same(dv.control_from_log(changelog.entries(spark, log, dv.CONTROL_LOG)), state)


def test_log_with_deletes(spark):
    rows = [("a", "initialized", None, None, ["report_status"], False, 0, 0), ("a", None, None, None, [], True, 0, 1),
            ("a", "final_sent", None, None, ["report_status"], False, 1, 1), ("b", "paused", None, None, ["report_status"], False, 0, 0),
            ("b", None, None, None, [], True, 0, 2)]
    log = spark.createDataFrame(rows, dv.CONTROL_LOG.simpleString()[7:-1].replace(":", " ") + ", version long")
    assert [(r.event_key, r.report_status) for r in dv.control_from_log(log).collect()] == [("a", "final_sent")]
    assert dv.control_from_log(dv.folded_log(log)).count() == 1


def test_delivery_ticks_go_on_after_a_stop(tables, tmp_path):
    at = str(tmp_path / "ticks")
    one, two = jobs.tick_times(AS_OF)
    jobs.stream_delivery_tick(tables, at=at, ticks=[one])
    _same(jobs.stream_delivery_tick(tables, at=at, ticks=[two]), jobs.stream_delivery_tick(tables))


def test_snapshot_upsert_stream_equals_batch_landing(tables):
    _same(jobs.stream_snapshot_upsert(tables), jobs.landing_read(tables))


def test_delivery_ticks_equal_two_batch_ticks(tables):
    first = dv.control_after_batch(tables, jobs.tick_times(AS_OF)[0])
    second = dv.control_after_batch(tables, jobs.tick_times(AS_OF)[1], control=first)
    _same(jobs.stream_delivery_tick(tables), second)
