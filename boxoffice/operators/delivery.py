"""Manifest delivery scheduling and the control table, as DataFrame functions.

The reference loops over events, looks control rows up 25 at a time and
updates them one by one. Here one job categorises all candidates (a left
join of the small candidate set against the control rows it needs, which are
first semi-joined to the candidates), and each state change is a functional
upsert: ``(old control, batch) -> new control``.
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxoffice.functions.text import ljust, short_venue
from boxoffice.functions.time import ts, ts_lit
from boxoffice.operators import manifest as mf
from boxoffice.params import (AS_OF, CANDIDATE_WINDOW_DAYS, CONTROL_INITIALIZED,
                              CONTROL_ROW_DOES_NOT_EXIST, DUE_DELAY_MINUTES, FINAL_SENT, PACIFIC,
                              PREVIEW_HOUR, PREVIEW_MINUTE, PRELIM_LEAD_DAYS, PRELIM_SENT,
                              REPORT_CANCELED, VENUE_IDS)
from boxoffice.sources.tables import Tables

CONTROL_COLUMNS = ["event_key", "report_status", "preliminary_sent_at", "final_sent_at"]


def cutoffs(as_of: dt.datetime = AS_OF) -> dict:
    """D-1: candidate date range and the two cutoffs for a reference time."""
    return {
        "start_date": (as_of - dt.timedelta(days=CANDIDATE_WINDOW_DAYS)).date(),
        "end_date": (as_of + dt.timedelta(days=CANDIDATE_WINDOW_DAYS)).date(),
        "final_cutoff_utc": as_of,
        "prelim_cutoff_utc": as_of + dt.timedelta(days=PRELIM_LEAD_DAYS),
    }


def candidate_events(t: Tables, as_of: dt.datetime = AS_OF,
                     venues: list[str] = VENUE_IDS) -> DataFrame:
    """D-1/D-2: listed venues' events whose start date is within +-2 days."""
    c = cutoffs(as_of)
    d = F.col("event_date")  # = CAST(CAST(start AS TIMESTAMP) AS DATE), typed and pushable
    return (t.events.filter(F.col("organization_id").isin(venues))
            .filter(d.between(F.lit(c["start_date"]), F.lit(c["end_date"])))
            .select(F.col("location").alias("venue"), F.col("name").alias("event_title"),
                    F.col("id").alias("event_id"), d.alias("event_date"),
                    ts("start_utc").alias("event_start_utc_timestamp"),
                    ts("start").alias("local_event_start_timestamp")))


def control_rows_for_events(control: DataFrame, candidates: DataFrame) -> DataFrame:
    """S-13/J-9: control rows of the candidate ids (semi-join; no batching)."""
    ids = candidates.select(F.col("event_id").alias("event_key"))
    return control.join(ids, "event_key", "left_semi")


def control_rows_missing(control: DataFrame, candidates: DataFrame) -> DataFrame:
    """T-1/J-8: candidate ids without a control row."""
    return (candidates.select("event_id")
            .join(control.select(F.col("event_key").alias("event_id")), "event_id", "left_anti"))


def _status_flags(status: Column) -> dict[str, Column]:
    present = status.isNotNull()
    return {
        "canceled": present & (status == REPORT_CANCELED),
        "final_sent": present & (status == FINAL_SENT),
        "prelim_sent": present & (status == PRELIM_SENT),
        "needs_prelim": ~present | (status == CONTROL_INITIALIZED),
    }


def one_per_event(candidates: DataFrame) -> DataFrame:
    """J-7: one candidate per event id. Of repeated rows the last counts; rows have no
    order of their own, so it is the one with the latest start, then the largest fields."""
    cols = ["event_start_utc_timestamp", "local_event_start_timestamp", "event_date", "event_title", "venue"]
    g = candidates.groupBy("event_id").agg(F.max(F.struct(*cols)).alias("r"))
    return g.select("event_id", *[F.col("r." + c).alias(c) for c in cols])


def joined_candidates(t: Tables, as_of: dt.datetime = AS_OF,
                      control: DataFrame | None = None) -> DataFrame:
    """J-7: candidates left-joined to their control rows (rows of other events ignored)."""
    cand = one_per_event(candidate_events(t, as_of))
    control = control if control is not None else t.control
    ctl = control_rows_for_events(control, cand).select(
        F.col("event_key").alias("event_id"), "report_status")
    return cand.join(ctl, "event_id", "left")


def categorize(joined: DataFrame, as_of: dt.datetime = AS_OF, prelim_only: bool = False) -> DataFrame:
    """D-3/J-11/D-14: six-way categorisation, first match wins; statuses outside
    the known four fall out. ``prelim_only`` drops ``send_final``."""
    c = cutoffs(as_of)
    f = _status_flags(F.col("report_status"))
    due = F.col("event_start_utc_timestamp") + F.expr(f"INTERVAL {DUE_DELAY_MINUTES} MINUTES")
    cat = (F.when(f["canceled"], F.lit("report_canceled"))
           .when(f["final_sent"], F.lit("final_already_sent"))
           .when(f["prelim_sent"], F.when(due <= ts_lit(c["final_cutoff_utc"]), F.lit("send_final"))
                 .otherwise(F.lit("no_action_waiting_to_send_final")))
           .when(f["needs_prelim"], F.when(due <= ts_lit(c["prelim_cutoff_utc"]),
                                           F.lit("send_preliminary"))
                 .otherwise(F.lit("preliminary_is_not_yet_due"))))
    out = joined.withColumn("category", cat).filter(F.col("category").isNotNull())
    if prelim_only:
        out = out.filter(F.col("category") != "send_final")
    return out


def delivery_categories(t: Tables, as_of: dt.datetime = AS_OF, prelim_only: bool = False,
                        control: DataFrame | None = None) -> DataFrame:
    return categorize(joined_candidates(t, as_of, control), as_of, prelim_only).select(
        "event_id", "venue", "event_title", "event_date", "event_start_utc_timestamp",
        "local_event_start_timestamp", "report_status", "category")


def _abstract_status() -> Column:
    f = _status_flags(F.col("report_status"))
    return (F.when(f["needs_prelim"], F.lit("eligible_for_preliminary"))
            .when(f["canceled"], F.lit("report_canceled"))
            .when(f["final_sent"], F.lit("final_already_sent"))
            .when(f["prelim_sent"], F.lit("eligible_for_final"))
            .otherwise(F.lit("unknown")))


def delivery_status_labels(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """D-4: abstract status (5 labels incl. ``unknown``) and raw status of every candidate."""
    j = joined_candidates(t, as_of)
    return j.select("event_id", "event_title", "event_date",
                    _abstract_status().alias("control_row_status_abstract"),
                    F.coalesce("report_status", F.lit(CONTROL_ROW_DOES_NOT_EXIST))
                    .alias("report_status_raw"))


def abbreviated_summary() -> Column:
    """``Jan04_22:30_venue________status``: local start, short venue, padded to 25."""
    first = F.concat(F.date_format("local_event_start_timestamp", "MMMdd_HH:mm"), F.lit("_"),
                     short_venue("venue"))
    return F.concat(ljust(first, 25, "_"), F.lit("_"), _abstract_status())


def preview_instant(as_of: dt.datetime = AS_OF) -> dt.datetime:
    """D-17: 22:31 Pacific on the Pacific day of ``as_of`` (no roll-over), in UTC."""
    pac = ZoneInfo(PACIFIC)
    local = as_of.replace(tzinfo=dt.timezone.utc).astimezone(pac)
    at = local.replace(hour=PREVIEW_HOUR, minute=PREVIEW_MINUTE, second=0, microsecond=0)
    return at.astimezone(dt.timezone.utc).replace(tzinfo=None)


def _preview_one(t: Tables, as_of: dt.datetime, label: str) -> DataFrame:
    c = cutoffs(as_of)
    cat = categorize(joined_candidates(t, as_of), as_of)
    fmt_s, fmt_m = "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm"
    pac = lambda x: F.from_utc_timestamp(ts_lit(x), PACIFIC)
    return cat.select(
        F.lit(label).alias("preview"),
        F.date_format(ts_lit(as_of), fmt_s).alias("reference_time_in"),
        F.date_format(ts_lit(c["prelim_cutoff_utc"]), fmt_s).alias("preliminary_cutoff_utc"),
        F.date_format(ts_lit(c["final_cutoff_utc"]), fmt_s).alias("final_cutoff_utc"),
        F.date_format(pac(c["prelim_cutoff_utc"]), fmt_m).alias("preliminary_cutoff_local"),
        F.date_format(pac(c["final_cutoff_utc"]), fmt_m).alias("final_cutoff_local"),
        "category", "event_id", "event_title",
        F.date_format("event_date", "yyyy-MM-dd").alias("event_date"),
        F.date_format("event_start_utc_timestamp", fmt_s).alias("event_start_utc_string"),
        F.date_format("local_event_start_timestamp", fmt_s).alias("local_event_start_string"),
        _abstract_status().alias("control_row_status_abstract"),
        F.coalesce("report_status", F.lit(CONTROL_ROW_DOES_NOT_EXIST)).alias("report_status_raw"),
        abbreviated_summary().alias("abbreviated_summary"))


def schedule_preview(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """D-5/D-17: the schedule at ``as_of`` and at the next 22:31 Pacific preview,
    one row per categorised candidate (long form; no per-category collection)."""
    return (_preview_one(t, as_of, "current_state")
            .unionByName(_preview_one(t, preview_instant(as_of), "upcoming_schedule")))


# --- control table state changes --------------------------------------------

def _initial_rows(ids: DataFrame) -> DataFrame:
    return ids.select(F.col("event_id").alias("event_key"),
                      F.lit(CONTROL_INITIALIZED).alias("report_status"),
                      F.lit(None).cast("timestamp").alias("preliminary_sent_at"),
                      F.lit(None).cast("timestamp").alias("final_sent_at"))


def control_initialize(control: DataFrame, ids: DataFrame) -> DataFrame:
    """D-6: add ``initialized`` rows for ids without a control row."""
    missing = ids.select("event_id").distinct().join(
        control.select(F.col("event_key").alias("event_id")), "event_id", "left_anti")
    return control.select(*CONTROL_COLUMNS).unionByName(_initial_rows(missing))


def _attempted(t: Tables, categories: DataFrame) -> DataFrame:
    """This tick's attempts with the mail service's answers (``t.attempts``; no answer
    counts as a failure). Final is attempted only after the accounting mail succeeded
    (D-12). ``manifest_empty``: the event has no priced ticket (D-13)."""
    due = categories.filter(F.col("category").isin("send_preliminary", "send_final"))
    answer = lambda c: F.coalesce(c, F.lit(False))
    is_final = F.col("category") == "send_final"
    acct_ok = F.when(is_final, answer("accounting_ok"))
    priced = mf.priced_events(t, due.select("event_id")).withColumn("priced", F.lit(True))
    return due.join(t.attempts, "event_id", "left").join(priced, "event_id", "left").select(
        "event_id", "venue", "category",
        F.when(~is_final, answer("preliminary_ok")).alias("preliminary_sent"),
        acct_ok.alias("accounting_sent"),
        F.when(is_final & acct_ok, answer("final_ok")).alias("final_sent"),
        F.col("priced").isNull().alias("manifest_empty"))


def delivery_outcomes(t: Tables, as_of: dt.datetime = AS_OF,
                      control: DataFrame | None = None) -> DataFrame:
    """D-11/D-12/T-4: attempts split into succeeded / failed x preliminary / final."""
    a = _attempted(t, delivery_categories(t, as_of, control=control))
    outcome = (F.when(F.col("category") == "send_preliminary",
                      F.when(F.col("preliminary_sent"), F.lit("preliminary_succeeded"))
                      .otherwise(F.lit("preliminary_failed")))
               .otherwise(F.when(F.coalesce(F.col("final_sent"), F.lit(False)),
                                 F.lit("final_succeeded")).otherwise(F.lit("final_failed"))))
    return a.withColumn("outcome", outcome)


# The control table as a log: a change sets some attributes of a key, or deletes it. ``seq`` orders
# the changes of one version.
ATTRIBUTES = CONTROL_COLUMNS[1:]
CONTROL_LOG = T.StructType([
    T.StructField("event_key", T.StringType()), T.StructField("report_status", T.StringType()),
    T.StructField("preliminary_sent_at", T.TimestampType()), T.StructField("final_sent_at", T.TimestampType()),
    T.StructField("sets", T.ArrayType(T.StringType())), T.StructField("deleted", T.BooleanType()), T.StructField("seq", T.IntegerType())])


def control_as_log(control: DataFrame, seq: int = 0) -> DataFrame:
    """Changes that make the rows of ``control``."""
    return control.select(*CONTROL_COLUMNS, F.array(*[F.lit(a) for a in ATTRIBUTES]).alias("sets"), F.lit(False).alias("deleted"),
                          F.lit(seq).alias("seq"))


def outcome_changes(outcomes: DataFrame, as_of: dt.datetime = AS_OF, seq: int = 0) -> DataFrame:
    """D-6/D-7/D-8/D-13 as changes: a row for each event whose state an outcome changes, with what it sets."""
    ok = outcomes.filter(F.col("manifest_empty") | F.col("outcome").isin("preliminary_succeeded", "final_succeeded"))
    prelim = F.col("manifest_empty") | (F.col("outcome") == "preliminary_succeeded")
    stamp, names = ts_lit(as_of), lambda *n: F.array(*[F.lit(x) for x in n])
    return ok.select(F.col("event_id").alias("event_key"),
                     F.when(prelim, F.lit(PRELIM_SENT)).otherwise(F.lit(FINAL_SENT)).alias("report_status"),
                     F.when(prelim, stamp).alias("preliminary_sent_at"), F.when(~prelim, stamp).alias("final_sent_at"),
                     F.when(prelim, names("report_status", "preliminary_sent_at")).otherwise(names("report_status", "final_sent_at")).alias("sets"),
                     F.lit(False).alias("deleted"), F.lit(seq).alias("seq"))


def folded_log(log: DataFrame) -> DataFrame:
    """One change per living key that stands for all of the log, with the key's last ``version``.

    Each attribute takes the last change after the key's last delete that sets
    it. All picks are ``max_by`` aggregates, which combine map-side.
    """
    at = F.struct("version", "seq")
    pick = lambda a: F.max_by(F.struct(at.alias("at"), F.col(a).alias("v")),
                              F.when(~F.col("deleted") & F.array_contains("sets", a), at)).alias(a)
    g = log.groupBy("event_key").agg(F.max(F.when(F.col("deleted"), at)).alias("gone"), F.max(at).alias("last"), *[pick(a) for a in ATTRIBUTES])
    holds = {a: F.col(f"{a}.at").isNotNull() & (F.col("gone").isNull() | (F.col(f"{a}.at") > F.col("gone"))) for a in ATTRIBUTES}
    alive = F.col("gone").isNull() | (F.col("last") > F.col("gone"))
    return g.filter(alive).select(
        "event_key", *[F.when(holds[a], F.col(f"{a}.v")).alias(a) for a in ATTRIBUTES],
        F.filter(F.array(*[F.when(holds[a], F.lit(a)) for a in ATTRIBUTES]), lambda x: x.isNotNull()).alias("sets"),
        F.lit(False).alias("deleted"), F.col("last.seq").alias("seq"), F.col("last.version").alias("version"))


def control_from_log(log: DataFrame) -> DataFrame:
    """The control table that a log of changes gives."""
    return folded_log(log).select(*CONTROL_COLUMNS)


def apply_outcomes(control: DataFrame, outcomes: DataFrame, as_of: dt.datetime = AS_OF) -> DataFrame:
    """D-6/D-7/D-8/D-13: successes change state, failures change nothing.

    Preliminary success: a missing row is created (initialised), then set to
    ``prelim_sent`` with its time; final success: ``final_sent`` with its time.
    An event whose manifest is empty becomes ``prelim_sent`` with its time
    whatever the attempt's outcome, and never final. The row's other attributes
    are kept (an update, not a put). One full outer join of the control table
    with the changes.
    """
    ok = outcomes.filter(F.col("manifest_empty") | F.col("outcome").isin("preliminary_succeeded", "final_succeeded")) \
                 .select(F.col("event_id").alias("u_key"),
                         (F.col("manifest_empty") | (F.col("outcome") == "preliminary_succeeded")).alias("u_prelim"))
    stamp = ts_lit(as_of)
    prelim = F.col("u_prelim")
    hit = F.col("u_key").isNotNull()
    return control.join(ok, control.event_key == ok.u_key, "full").select(
        F.coalesce("event_key", "u_key").alias("event_key"),
        F.when(hit, F.when(prelim, F.lit(PRELIM_SENT)).otherwise(F.lit(FINAL_SENT)))
         .otherwise(F.col("report_status")).alias("report_status"),
        F.when(hit & prelim, stamp).otherwise(F.col("preliminary_sent_at")).alias("preliminary_sent_at"),
        F.when(hit & ~prelim, stamp).otherwise(F.col("final_sent_at")).alias("final_sent_at"))


def control_after_batch(t: Tables, as_of: dt.datetime = AS_OF,
                        control: DataFrame | None = None) -> DataFrame:
    """The control table after one scheduling tick's deliveries (D-1 .. D-13)."""
    control = control if control is not None else t.control
    return apply_outcomes(control, delivery_outcomes(t, as_of, control), as_of)


def empty_manifests(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """D-13: due events without a priced ticket, with the state and time they get."""
    due = delivery_categories(t, as_of).filter(F.col("category").isin("send_preliminary", "send_final"))
    return due.join(mf.priced_events(t, due.select("event_id")), "event_id", "left_anti").select(
        "event_id", "venue", "event_title", "category", F.lit(PRELIM_SENT).alias("report_status_after"),
        ts_lit(as_of).alias("preliminary_sent_at_after"))


# Commands: op -> (new status or None for delete, sets preliminary_sent_at,
# final_sent_at action: 'set' | 'null' | None for untouched)
COMMANDS = {
    "cancel": (REPORT_CANCELED, False, None),
    "mark_preliminary_sent": (PRELIM_SENT, True, None),
    "mark_final_sent": (FINAL_SENT, False, "set"),
    "force_reset_to_preliminary_sent": (PRELIM_SENT, False, "null"),
    "force_forward_to_final_sent": (FINAL_SENT, False, "set"),
    "delete": (None, False, None),
}


def commands_at(commands: DataFrame, as_of: dt.datetime = AS_OF) -> DataFrame:
    """Commands (event_key, seq, op) with their times: ``seq`` minutes after ``as_of``."""
    return commands.withColumn("at", ts_lit(as_of) + F.make_interval(mins=F.col("seq")))


def apply_commands(control: DataFrame, commands: DataFrame) -> DataFrame:
    """D-9/D-10: apply commands per key in ``seq`` order, exactly.

    Each attribute takes the value of the last command after the last delete
    that touches it; a key whose last command is a delete disappears; an
    update after a delete (or on a missing key) creates a row holding only the
    attributes it sets. All picks are ``max_by`` aggregates, which combine
    map-side, so one key with many commands does not need one task.
    """
    op = F.col("op")
    status_of = F.lit(None).cast("string")
    for name, (st, _p, _f) in COMMANDS.items():
        if st is not None:
            status_of = F.when(op == name, F.lit(st)).otherwise(status_of)
    sets_prelim = op.isin(*[n for n, v in COMMANDS.items() if v[1]])
    final_touch = op.isin(*[n for n, v in COMMANDS.items() if v[2] is not None])
    final_val = F.when(op.isin(*[n for n, v in COMMANDS.items() if v[2] == "set"]), F.col("at"))
    c = commands.withColumn("status_new", status_of)
    last_del = F.max(F.when(op == "delete", F.col("seq")))
    g = c.groupBy("event_key").agg(
        last_del.alias("last_delete"),
        F.max("seq").alias("last_seq"),
        F.max_by("op", "seq").alias("last_op"),
        F.max_by(F.struct(F.col("seq").alias("s"), F.col("status_new").alias("v")),
                 F.when(op != "delete", F.col("seq"))).alias("st"),
        F.max_by(F.struct(F.col("seq").alias("s"), F.col("at").alias("v")),
                 F.when(sets_prelim, F.col("seq"))).alias("pr"),
        F.max_by(F.struct(F.col("seq").alias("s"), final_val.alias("v")),
                 F.when(final_touch, F.col("seq"))).alias("fi"))
    old = control.join(g.select("event_key"), "event_key", "left_semi")
    j = g.join(old, "event_key", "left")
    after_del = lambda s: F.col(s + ".s").isNotNull() & (
        F.col("last_delete").isNull() | (F.col(s + ".s") > F.col("last_delete")))
    base = lambda col: F.when(F.col("last_delete").isNull(), F.col(col))
    new = j.select(
        "event_key", "last_op",
        F.when(after_del("st"), F.col("st.v")).otherwise(base("report_status")).alias("report_status"),
        F.when(after_del("pr"), F.col("pr.v")).otherwise(base("preliminary_sent_at"))
         .alias("preliminary_sent_at"),
        F.when(after_del("fi"), F.col("fi.v")).otherwise(base("final_sent_at")).alias("final_sent_at"))
    keep = control.join(g.select("event_key"), "event_key", "left_anti").select(*CONTROL_COLUMNS)
    return keep.unionByName(new.filter(F.col("last_op") != "delete").select(*CONTROL_COLUMNS))


def control_commands(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    return apply_commands(t.control, commands_at(t.commands, as_of))


# --- routing -----------------------------------------------------------------
PRELIMINARY_LIST = "preliminary-list@example.com"
ACCOUNTING_LIST = "accounting-list@example.com"
MISSING_ROUTE_NATION = 24


def routing_table(t: Tables) -> DataFrame:
    """Venue (location) -> final-report address; one venue has no entry.

    Derived from the nation table (one venue per nation), so its size is the
    number of venues, not the number of events."""
    n = t.raw("nation")
    return (n.filter(F.col("n_nationkey") != MISSING_ROUTE_NATION)
            .select(F.concat(F.col("n_name"), F.lit(" Hall")).alias("venue"),
                    F.concat(F.lit("team-"), F.col("n_nationkey").cast("string"),
                             F.lit("@example.com")).alias("final_address")))


def delivery_routing(t: Tables, as_of: dt.datetime = AS_OF) -> DataFrame:
    """D-15/J-10: one row per mail to send this tick with its destination.

    Preliminary and accounting mails go to fixed lists; the final mail goes to
    the venue's list. A venue without an entry is flagged ``routable = false``
    (the reference raises)."""
    cat = delivery_categories(t, as_of).filter(F.col("category").isin("send_preliminary",
                                                                      "send_final"))
    variants = F.when(F.col("category") == "send_final",
                      F.array(F.lit("accounting"), F.lit("final"))) \
                .otherwise(F.array(F.lit("preliminary")))
    mails = cat.select("event_id", "venue", "category", F.explode(variants).alias("report_variant"))
    j = mails.join(routing_table(t), "venue", "left")
    addr = (F.when(F.col("report_variant") == "preliminary", F.lit(PRELIMINARY_LIST))
            .when(F.col("report_variant") == "accounting", F.lit(ACCOUNTING_LIST))
            .otherwise(F.col("final_address")))
    return j.select("event_id", "venue", "category", "report_variant", addr.alias("to_address"),
                    addr.isNotNull().alias("routable"))
