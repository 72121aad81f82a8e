"""Column helpers and the fee normaliser (N-1) on literal rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from boxoffice.functions.money import money, money_or_zero, money_text, zero_then_money
from boxoffice.functions.text import ljust, short_venue, underscore_slug, url_slug
from boxoffice.functions.time import from_pacific, iso_millis_z, ts, week_start_mon, week_start_sun
from boxoffice.operators.delivery import preview_instant
from boxoffice.operators.ingest import event_range_bounds, normalize_fees
from boxoffice.params import FEE_TYPES


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("y")).first()["y"]


def test_slugs(spark):
    assert one(spark, url_slug("x"), "Test Location") == "test-location"
    assert one(spark, url_slug("x"), "A  &  B!!") == "a-b-"
    assert one(spark, underscore_slug("x"), "Admin Fee (Not a Gratuity)") == "admin_fee_not_a_gratuity_"
    assert one(spark, underscore_slug("x"), "LET Tax") == "let_tax"


def test_ljust_never_truncates(spark):
    assert one(spark, ljust("x", 25, "_"), "Jan04_22:30_venue") == "Jan04_22:30_venue________"
    long = "Jan04_22:30_a_very_long_venue_name"
    assert one(spark, ljust("x", 25, "_"), long) == long


def test_short_venue(spark):
    assert one(spark, short_venue("x"), "Harbor Nightclub") == "harbor_nc"
    assert one(spark, short_venue("x"), "Sand Beach Dayclub") == "sand_beach_day"


def test_money_casts(spark):
    assert one(spark, money("x"), "12.345") == Decimal("12.35")  # half-up
    assert one(spark, money_or_zero("x"), None) == Decimal("0.00")
    assert one(spark, zero_then_money("x"), None) == Decimal("0.00")
    assert one(spark, money_text(money("x")), "7") == "7.00"


def test_week_starts(spark):
    # 2024-01-07 is a Sunday
    assert one(spark, week_start_mon(ts("x")), "2024-01-07 22:30:00") == dt.date(2024, 1, 1)
    assert one(spark, week_start_sun(ts("x")), "2024-01-07 22:30:00") == dt.date(2024, 1, 7)
    assert one(spark, week_start_sun(ts("x")), "2024-01-10 01:00:00") == dt.date(2024, 1, 7)


def test_pacific_and_iso(spark):
    utc = one(spark, F.date_format(from_pacific(ts("x")), "yyyy-MM-dd HH:mm"), "2024-01-04 22:30:00")
    assert utc == "2024-01-05 06:30"
    assert one(spark, iso_millis_z(ts("x")), "2024-01-04 22:30:00") == "2024-01-04T22:30:00.000Z"


def test_date_patterns(spark):
    s = ts("x")
    assert one(spark, F.upper(F.date_format(s, "EEE dd-MMM")), "2024-01-04 22:30:00") == "THU 04-JAN"
    assert one(spark, F.date_format(s, "hh:mma"), "2024-01-04 22:30:00") == "10:30PM"
    assert one(spark, F.date_format(s, "MMMdd_HH:mm"), "2024-01-04 22:30:00") == "Jan04_22:30"
    assert one(spark, F.date_format(s, "yy/MM/dd"), "2024-01-04 22:30:00") == "24/01/04"


def test_fee_normaliser(spark):
    rows = [
        ('{"Let Tax": "9.99", "Surcharge": "4.00", "LET Tax": "1.25", "Processing Charge": "1"}',),
        ('{"Admin Fee (Not a Gratuity)": "2.00", "Gratuity": "5.00"}',),
        (None,),
        ("{}",),
    ]
    df = spark.createDataFrame(rows, "j string").select(*normalize_fees(F.col("j")))
    out = [r.asDict() for r in df.collect()]
    assert list(df.columns) == FEE_TYPES
    assert out[0]["let_tax"] == "1.25"  # the later of two colliding keys wins
    assert out[0]["surcharge"] == "4.00"
    assert "processing_charge" not in out[0]
    assert out[1]["admin_fee_not_a_gratuity_"] == "2.00" and out[1]["gratuity"] == "5.00"
    assert all(v is None for v in out[2].values())
    assert all(v is None for v in out[3].values())


def test_range_presets():
    as_of = dt.datetime(2024, 1, 15, 12)
    assert event_range_bounds("current", as_of) == (dt.date(2024, 1, 14), dt.date(2024, 1, 17))
    assert event_range_bounds("upcoming", as_of) == (dt.date(2024, 1, 14), None)
    assert event_range_bounds("recent", as_of) == (dt.date(2023, 12, 1), dt.date(2024, 1, 14))
    assert event_range_bounds("test", as_of) == (dt.date(2023, 12, 31), dt.date(2024, 1, 3))
    assert event_range_bounds(None, as_of) == (None, None)


def test_preview_instant_no_rollover():
    # 2024-01-04 22:35 Pacific = 2024-01-05 06:35 UTC: same Pacific day, so 22:31 is in the past
    assert preview_instant(dt.datetime(2024, 1, 5, 6, 35)) == dt.datetime(2024, 1, 5, 6, 31)
    assert preview_instant(dt.datetime(2024, 1, 15, 12, 0)) == dt.datetime(2024, 1, 16, 6, 31)


def test_sum_money_exact_and_null(spark):
    from boxoffice.functions.money import sum_money
    df = spark.createDataFrame([("a", "0.10"), ("a", "0.20"), ("a", "999999.99"), ("b", None)],
                               "k string, x string")
    got = {r["k"]: r["s"] for r in df.groupBy("k").agg(sum_money(money("x")).alias("s")).collect()}
    assert got["a"] == Decimal("1000000.29")
    assert got["b"] is None
