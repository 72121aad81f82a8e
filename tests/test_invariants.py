"""Invariants of the derived datasets and the control-table state machine."""

import datetime as dt

from pyspark.sql import functions as F

from boxoffice.operators import delivery as dv
from boxoffice.operators import manifest as mf
from boxoffice.operators import reports as rp
from boxoffice.params import AS_OF


def test_manifest_totals_equal_line_sums(tables_mid):
    split = mf.manifest_revenue_split(tables_mid)
    tot = mf.manifest_totals(tables_mid, split)
    a = split.agg(F.sum("quantity").alias("q"), F.sum("subtotal_minus_bar_card").alias("fv"),
                  F.sum("sum_bar_card").alias("bc")).first()
    b = tot.agg(F.sum("total_sold").alias("q"), F.sum("total_face_value").alias("fv"),
                F.sum("total_bar_card").alias("bc")).first()
    assert a == b
    # face value + bar card = subtotal, line by line
    bad = split.filter(F.col("subtotal_minus_bar_card") + F.col("sum_bar_card") != F.col("sum_subtotal"))
    assert bad.count() == 0


def test_csv_has_one_totals_row_per_event(tables):
    rows = mf.manifest_csv_surcharge(tables)
    per = rows.groupBy("event_id").agg(F.sum("row_kind").alias("n_tot"), F.count("*").alias("n"))
    assert per.filter(F.col("n_tot") != 1).count() == 0
    assert per.filter(F.col("n") < 2).count() == 0


def test_rollup_levels_add_up(tables_mid):
    r = rp.sales_rollup(tables_mid)
    ev = r.filter(F.col("level") == "event").groupBy("week_start", "venue_name").agg(
        F.sum("quantity_sold").alias("q"), F.sum("sales_last_24_hours").alias("l"))
    ven = r.filter(F.col("level") == "venue").select("week_start", "venue_name",
                                                     F.col("quantity_sold").alias("q"),
                                                     F.col("sales_last_24_hours").alias("l"))
    assert ev.exceptAll(ven).count() == 0 and ven.exceptAll(ev).count() == 0
    lines = r.filter(F.col("level") == "line").agg(F.sum("quantity_sold")).first()[0]
    total = rp.upcoming_sales(tables_mid).agg(F.sum("quantity_sold")).first()[0]
    assert lines == total


def test_categories_partition_known_statuses(tables_mid):
    lab = dv.delivery_status_labels(tables_mid)
    cat = dv.delivery_categories(tables_mid)
    known = lab.filter(F.col("control_row_status_abstract") != "unknown").count()
    assert cat.count() == known
    assert cat.select("event_id").distinct().count() == cat.count()
    assert cat.join(lab.filter(F.col("control_row_status_abstract") == "unknown"),
                    "event_id", "left_semi").count() == 0


def test_prelim_only_drops_send_final(tables_mid):
    full = dv.delivery_categories(tables_mid)
    pre = dv.delivery_categories(tables_mid, prelim_only=True)
    assert pre.filter(F.col("category") == "send_final").count() == 0
    assert full.filter(F.col("category") != "send_final").count() == pre.count()


def test_same_batch_twice_is_idempotent(tables_mid):
    out = dv.delivery_outcomes(tables_mid)
    once = dv.apply_outcomes(tables_mid.control, out, AS_OF)
    twice = dv.apply_outcomes(once, out, AS_OF)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def _fold(old, cmds, commands):
    """Brute-force reference: apply commands one by one, like item updates."""
    state = {k: dict(v) for k, v in old.items()}
    for key, _seq, op, at in sorted(cmds, key=lambda c: (c[0], c[1])):
        status, sets_prelim, final = commands[op]
        if status is None:
            state.pop(key, None)
            continue
        row = state.setdefault(key, {"report_status": None, "preliminary_sent_at": None,
                                     "final_sent_at": None})
        row["report_status"] = status
        if sets_prelim:
            row["preliminary_sent_at"] = at
        if final == "set":
            row["final_sent_at"] = at
        elif final == "null":
            row["final_sent_at"] = None
    return state


def test_commands_match_sequential_fold(tables):
    ctl = tables.control
    cmds = dv.commands_at(tables.commands)
    got = {r["event_key"]: {k: r[k] for k in ("report_status", "preliminary_sent_at", "final_sent_at")}
           for r in dv.apply_commands(ctl, cmds).collect()}
    old = {r["event_key"]: {k: r[k] for k in ("report_status", "preliminary_sent_at", "final_sent_at")}
           for r in ctl.collect()}
    cl = [(r["event_key"], r["seq"], r["op"], r["at"]) for r in cmds.collect()]
    assert got == _fold(old, cl, dv.COMMANDS)


def test_commands_delete_then_update(spark):
    ts = dt.datetime(2024, 1, 15, 12, 1)
    ctl = spark.createDataFrame(
        [("a", "prelim_sent", ts, None), ("b", "final_sent", ts, ts)],
        "event_key string, report_status string, preliminary_sent_at timestamp, final_sent_at timestamp")
    cmds = spark.createDataFrame(
        [("a", 1, "delete", ts), ("a", 2, "cancel", ts), ("b", 1, "force_reset_to_preliminary_sent", ts),
         ("c", 1, "mark_final_sent", ts), ("b", 2, "delete", ts), ("b", 3, "mark_preliminary_sent", ts)],
        "event_key string, seq int, op string, at timestamp")
    got = {r["event_key"]: r for r in dv.apply_commands(ctl, cmds).collect()}
    assert got["a"]["report_status"] == "report_canceled" and got["a"]["preliminary_sent_at"] is None
    assert got["b"]["report_status"] == "prelim_sent" and got["b"]["final_sent_at"] is None
    assert got["c"]["report_status"] == "final_sent" and got["c"]["final_sent_at"] == ts


def test_initialize_adds_only_missing(tables_mid):
    cand = dv.candidate_events(tables_mid)
    new = dv.control_initialize(tables_mid.control, cand)
    assert new.select("event_key").distinct().count() == new.count()
    missing = dv.control_rows_missing(tables_mid.control, cand).count()
    assert new.count() == tables_mid.control.count() + missing


def test_salted_join_equals_plain_join_with_a_hot_key(spark):
    from boxoffice.operators.joins import salted_join
    # key "hot" holds half of the big side's rows; "none" has no dimension row
    big = spark.createDataFrame([(f"o{i}", "hot" if i % 2 == 0 else f"k{i % 7}") for i in range(400)]
                                + [("ox", "none")], "o_id string, ev string")
    dim = spark.createDataFrame([("hot", "Hot Hall")] + [(f"k{i}", f"Hall {i}") for i in range(7)],
                                "e_id string, venue string")
    hot = spark.createDataFrame([("hot", 5), ("none", 3)], "hot_key string, hot_buckets int")
    for how in ("inner", "left"):
        plain = big.join(dim, big.ev == dim.e_id, how).select("o_id", "ev", "venue")
        salted = salted_join(big, dim, "ev", "e_id", ["o_id"], hot, how).select("o_id", "ev", "venue")
        assert sorted(plain.collect()) == sorted(salted.collect())
