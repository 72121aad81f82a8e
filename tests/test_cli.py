"""The verbs have their effects."""

import os

from boxoffice import cli
from boxoffice.operators import ingest as ig
from boxoffice.operators import manifest as mf
from boxoffice.sources.landing import LANDED_KEYS, LANDED_SCHEMAS, drop_tables, read_landed
from tests.conftest import SF_SMALL


def test_load_crawl_reset(spark, tables, tmp_path):
    landing = str(tmp_path / "landing")
    cli.main(["load", "--tables", SF_SMALL, "--landing", landing], spark)
    events = read_landed(spark, os.path.join(landing, "events"), LANDED_SCHEMAS["events"])
    current = {r.id for r in ig.events_in_range(tables).collect()}
    assert {r.id for r in events.collect()} == current
    orders = read_landed(spark, os.path.join(landing, "orders"), LANDED_SCHEMAS["orders"])
    assert {r.event_id for r in orders.collect()} <= current
    cli.main(["crawl", "--landing", landing, "--prefix", "cli_"], spark)
    assert spark.table("cli_events").count() == len(current)
    # another range lands more, and the reset finds its partitions
    cli.main(["reset", "--tables", SF_SMALL, "--landing", landing, "--prefix", "cli_", "--time-range", "test"], spark)
    both = current | {r.id for r in ig.events_in_range(tables, "test").collect()}
    assert {r.id for r in spark.table("cli_events").collect()} == both
    assert len(drop_tables(spark, "cli_")) == len(LANDED_KEYS)


def test_one_organization(spark, tables, tmp_path):
    landing, org = str(tmp_path / "landing"), ig.events_in_range(tables).first().organization_id
    cli.main(["load", "--tables", SF_SMALL, "--landing", landing, "--organization", org], spark)
    events = read_landed(spark, os.path.join(landing, "events"), LANDED_SCHEMAS["events"])
    assert {r.organization_id for r in events.collect()} == {org}


def test_manifest_of_one_event(spark, tables, tmp_path):
    event = mf.event_manifest(tables).first().event_id
    cli.main(["manifest", "--tables", SF_SMALL, "--out", str(tmp_path), "--event-id", event], spark)
    n = spark.read.option("header", True).csv(str(tmp_path / "csv")).count()
    assert n == mf.event_manifest(tables, event).count() + 1
    # the file has the report's name (A-17)
    name = spark.read.parquet(str(tmp_path / "header")).first().filename_csv
    assert name.startswith("PRELIMINARY TICKET SALES MANIFEST_") and os.listdir(tmp_path / "csv" / f"event_id={event}").count(name) == 1
    plan = mf.manifest_csv_final(tables, event)._jdf.queryExecution().executedPlan().toString()
    assert f"EqualTo(event_id,{event})" in plan


def test_send_writes_control_only_with_answers(spark, tables, tmp_path):
    cli.main(["send", "--tables", SF_SMALL, "--out", str(tmp_path / "a")], spark)
    assert not (tmp_path / "a" / "control").exists()
    tables.attempts.write.parquet(str(tmp_path / "answers"))
    cli.main(["send", "--tables", SF_SMALL, "--out", str(tmp_path / "b"), "--attempts", str(tmp_path / "answers")], spark)
    assert spark.read.parquet(str(tmp_path / "b" / "control")).count() >= tables.control.count()
