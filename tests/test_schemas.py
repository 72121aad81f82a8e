"""S-3 with drifting schemas, the quarantine, day ranges as partition predicates, numbered results."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.operators.ordinals import numbered
from boxoffice.session import checkpoint_dir
from boxoffice.sources import landing as ld
from boxoffice.sources import schemas as sc
from boxoffice.sources.tables import LandedTables
from boxoffice.streaming import jobs


def _path(spark, name):
    return os.path.join(checkpoint_dir(spark), f"test-{name}-{uuid.uuid4().hex[:8]}")


def _lines(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_inferred_and_merged_schemas(spark):
    a = sc.inferred(_lines(spark, ['{"id": "1", "n": 3, "s": {"x": 1}, "l": [1, 2.5]}', '{"id": 2, "flag": true}', "[1]", "broken {", None, "7"]))
    assert {f.name: f.dataType.simpleString() for f in a.fields} == {
        "id": "string", "n": "bigint", "s": "struct<x:bigint>", "l": "array<double>", "flag": "boolean"}
    b = sc.inferred(_lines(spark, ['{"n": 2.5, "s": {"y": "z"}, "flag": "no", "new": null}']))
    both = sc.merged(a, b)
    assert {f.name: f.dataType.simpleString() for f in both.fields} == {
        "id": "string", "n": "double", "s": "struct<x:bigint,y:string>", "l": "array<double>", "flag": "string", "new": "string"}
    assert sc.inferred(_lines(spark, ["x", ""])) == T.StructType() == sc.inferred(_lines(spark, []))


def test_odd_names(spark):
    """Names with spaces and marks; names that differ in case only are one column."""
    lines = _lines(spark, ['{"a b": 1, "x-y": "z", "Id": 1, "q`r": 2}', '{"id": "k", "a b": 2}'])
    schema = sc.inferred(lines)
    assert sorted(n.lower() for n in schema.names) == ["a b", "id", "q`r", "x-y"]
    both = sc.merged(T.StructType().add("id", "string"), schema)
    assert both.names[0] == "id" and len(both.names) == 4
    good, bad = sc.typed(lines, both, ["id"], {})
    assert [(r.id, r["a b"]) for r in good.collect()] == [("k", 2)] and [r.reasons for r in bad.collect()] == [["no key"]]


def _event(i, start="2024-01-05 10:00:00", **more):
    import json
    return json.dumps({"id": i, "name": "E", "organization_name": "V", "start": start, "start_utc": "2024-01-05 18:00:00", **more})


def test_a_new_column_appears_and_bad_lines_wait(spark):
    path, bad = os.path.join(_path(spark, "drift"), "events"), _path(spark, "quarantine")
    ld.land_lines(spark, _lines(spark, [_event("1"), _event("2", seats=40), _event("3")]), path, bad, dt.datetime(2024, 1, 1))
    second = [_event("1", seats="many", price=1.5), _event("2", start="soon", seats=7), '{"id": "3", ', "[]", _event(None)]
    ld.land_lines(spark, _lines(spark, second), path, bad, dt.datetime(2024, 1, 2))
    rows = {r.id: r for r in ld.read_evolved(spark, path).collect()}
    assert sorted(rows) == ["1", "2", "3"]
    assert (rows["1"].seats, rows["1"].price) == ("many", 1.5) and (rows["2"].seats, rows["2"].price) == ("40", None)
    assert rows["2"].ingested_at == dt.datetime(2024, 1, 1)  # the rejected line changes nothing
    told = spark.read.schema(sc.QUARANTINE).parquet(bad).collect()
    assert sorted(r.reasons for r in told) == [["bad start"], ["no key"], ["no object"], ["no object"]]
    assert {r.line for r in told} == set(second[1:])
    # a poll without the new columns keeps the sibling's
    ld.land_lines(spark, _lines(spark, [_event("3")]), path, bad, dt.datetime(2024, 1, 3))
    assert {r.id: r.seats for r in ld.read_evolved(spark, path).collect()} == {"1": "many", "2": "40", "3": None}


def test_structs_grow_and_the_landings_own_names_are_kept(spark):
    path, bad = os.path.join(_path(spark, "grow"), "events"), _path(spark, "quarantine")
    ld.land_lines(spark, _lines(spark, [_event("1", place={"x": 1}), _event("2", place={"x": 2})]), path, bad, dt.datetime(2024, 1, 1))
    ld.land_lines(spark, _lines(spark, [_event("2", place={"y": "b"}, venue="other", ingested_at="now", Name="E2")]), path, bad, dt.datetime(2024, 1, 2))
    rows = {r.id: r for r in ld.read_evolved(spark, path).collect()}
    assert tuple(rows["1"].place) == (1, None) and tuple(rows["2"].place) == (None, "b")
    assert {r.venue for r in rows.values()} == {"v"} and rows["2"].ingested_at == dt.datetime(2024, 1, 2) and rows["2"].name == "E"


DAYS = [dt.date(2023, 12, 31) + dt.timedelta(days=9 * i) for i in range(90)]


@pytest.mark.parametrize("first,last", [(dt.date(2024, 1, 9), dt.date(2024, 1, 9)), (dt.date(2023, 12, 31), dt.date(2025, 3, 1)),
                                        (dt.date(2024, 2, 10), dt.date(2024, 11, 30)), (None, dt.date(2024, 6, 5)), (dt.date(2024, 12, 1), None),
                                        (None, None), (dt.date(2025, 2, 1), dt.date(2024, 2, 1))])
def test_day_ranges(spark, first, last):
    parts = [(d.isoformat(), f"{d.year}", ld.MONTHS[d.month - 1], pad) for d in DAYS for pad in {f"{d.day:02d}", f"{d.day}"}]
    df = spark.createDataFrame(parts + [("none", "unknown", "unknown", "unknown")], "d string, year string, month string, day string")
    for bound, at in ((ld.days_from, first), (ld.days_to, last)):
        df = df.filter(bound(at)) if at else df
    want = {d.isoformat() for d in DAYS if (not first or d >= first) and (not last or d <= last)}
    assert {r.d for r in df.collect()} - {"none"} == want
    if first and last:
        import fnmatch
        patterns = ld.day_patterns("t", first, last)
        got = {d for d, y, m, day in parts if any(fnmatch.fnmatch(f"t/venue=v/year={y}/month={m}/day={day}", p) or
                                                  fnmatch.fnmatch(f"t/venue=v/year={y}/month={m}", p) or fnmatch.fnmatch(f"t/venue=v/year={y}", p) for p in patterns)}
        assert got == want


def test_a_range_reads_its_partitions_only(spark):
    path = os.path.join(_path(spark, "range"), "events")
    rows = [(str(i), "E", "o", f"V{i % 2}", "H", f"{d} 10:00:00", f"{d} 18:00:00") for i, d in enumerate(DAYS[:30])]
    df = spark.createDataFrame(rows, "id string, name string, organization_id string, organization_name string, location string, start string, start_utc string")
    ld.land_snapshots(spark, df, path, dt.datetime(2024, 1, 1))
    closed = ld.read_days(spark, path, ld.EVENT_SCHEMA, dt.date(2024, 1, 1), dt.date(2024, 2, 10))
    assert sorted(r.start[:10] for r in closed.collect()) == [d.isoformat() for d in DAYS[1:5]] and len(closed.inputFiles()) == 4
    plan = ld.read_days(spark, path, ld.EVENT_SCHEMA, dt.date(2024, 2, 10), None)._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in plan and "PartitionFilters: [((" in plan
    assert ld.read_days(spark, path, ld.EVENT_SCHEMA, dt.date(2031, 1, 1), dt.date(2031, 1, 2)).count() == 0


def test_numbers_follow_the_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.lit("y").alias("y"))
    rows = numbered(df, ["x"]).collect()
    assert sorted((r.x, r.row_no) for r in rows) == [(i, i + 1) for i in range(5000)]
    assert numbered(df.limit(0), ["x"]).count() == 0


def test_reports_over_the_landing_equal_those_over_the_tables(tables):
    """Load, land, typed read, report: facts and lists that read events, orders, tickets and charges."""
    from boxoffice.operators import facts as fc
    from boxoffice.operators import reports as rp

    zone = jobs.landed_tables(tables, ["events", "orders", "tickets", "charges"])
    assert isinstance(zone, LandedTables)
    for report in (fc.marketing_new, rp.upcoming_sales):
        a, b = report(zone), report(tables)
        assert a.count() == b.count() > 0 and a.exceptAll(b).count() == 0
