"""Registered queries over the driver tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Every query reads whole tables (no id subsets, prefixes or row caps); the
entity key is ``user_id`` and reports cover every weekly and monthly period.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import display as D
from ..functions.dates import LONG_DATE, SHORT_DATE, WEEKDAY_DATE, previous_month, previous_week
from ..functions.exact import DEC
from ..operators import marts, quality, report, series, states
from ..operators.stage import flatten_array, project_variant, stage
from ..session import fresh_path, path_exists, stored
from ..sources import feeds, land
from ..sources.feeds import FEEDS, FeedSpec
from ..sources.feeds import Column as Spec
from ..streaming import compaction
from ..streaming.landing import read_streamed, start_landing, write_batch
from . import events as ev

BY = ev.BY
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
# Fixed values of the driver plans: feeds that are registered besides those in the data (one
# without a table, to show missing cells), the audit windows in days, the trailing window
# anchor, the problem group, the requested report period, and the step target on the
# per-day purchase count.
REGISTERED_FEEDS = ("refund",)
PROBLEM_FEEDS = ("click", "error", "refund")
GRID_DAYS, SINGLE_DAYS = 32, 4
TRAILING_ANCHOR = dt.date(2024, 1, 31)
REPORT_WEEK = (dt.date(2024, 1, 8), dt.date(2024, 1, 14))
STEP_TARGET = 2
# The legs sum values of 2 decimals, and events carry such values.
FIXED = (*report.WELLNESS_METRICS, "avg_hrv", "avg_hr")
_NOT_IN_EVENTS = ("bedtime_start", "bedtime_end", "latency", "avg_breath", "restless_periods")
SLEEP_DETAIL_COLUMNS = tuple(c for c in marts.SLEEP_PERIOD_COLUMNS if c not in _NOT_IN_EVENTS)
EVENTS_FEED = {"events": FeedSpec("events", "events", "granular", ev.EVENT_COLUMNS,
                                  ("event_id", "user_id", "day", "partition_date"))}


# ---- building blocks ---------------------------------------------------------

def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return ev.staged_events(spark, sf)


def _mart2(spark: SparkSession, sf: str) -> DataFrame:
    return marts.full_outer_on_key(ev.event_legs(_staged(spark, sf)), ev.KEYS)


def _mart1(spark: SparkSession, sf: str, method: str = "join") -> DataFrame:
    return marts.full_outer_chain(ev.event_legs(_staged(spark, sf)), ev.KEYS, method=method)


def _per2(spark: SparkSession, sf: str) -> DataFrame:
    return ev.with_periods(_mart2(spark, sf))


def _sleep_per(spark: SparkSession, sf: str) -> DataFrame:
    return ev.with_periods(ev.sleep_periods(_staged(spark, sf)))


def _stats(spark: SparkSession, sf: str, mart: str = "j2") -> DataFrame:
    # The legs are unique per (user_id, day), so J1 runs in its one-shuffle grouped form.
    m = _mart2(spark, sf) if mart == "j2" else _mart1(spark, sf, "grouped")
    return report.metric_stats(ev.with_periods(m), BY, fixed=FIXED)


def _staged_cols(df: DataFrame) -> DataFrame:
    return df.select("event_id", "user_id", "day", "event_type", "value", "k")


# ---- staging -----------------------------------------------------------------

def stage_variant(spark, sf):
    """Every column of the record lands as VARIANT and is staged from it."""
    return _staged_cols(ev.staged_events(spark, sf, whole=True))


def flagship(spark, sf):
    """Events landed as VARIANT, staged whole, six legs, faithful mart, metric summaries."""
    legs = ev.event_legs(ev.staged_events(spark, sf, whole=True))
    return report.metric_summary(ev.with_periods(marts.full_outer_chain(legs, ev.KEYS, method="grouped")),
                                 BY, fixed=FIXED)


def _stage_feed(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf):
        return stage(ev.feed_records(ev.table(spark, sf, "events"), FEEDS[name]), name)
    query.__name__ = f"stage_{name}"
    query.__doc__ = f"B1-B13: all events as {name} records with planted NULLs, staged by the registry spec."
    return query


FEED_QUERIES = [_stage_feed(n) for n in FEEDS]


def not_null_pairs(spark, sf):
    """Q1: every registered (model, column) pair, one pass per model."""
    e = ev.table(spark, sf, "events")
    parts = [quality.not_null_audit(stage(ev.feed_records(e, f), f), f.staged_name, f.not_null)
             for f in FEEDS.values()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def not_null_observed(spark, sf):
    """Q1, A10: the same counts, observed while the 13 models are written in two loads (by event id) each."""
    base = fresh_path(spark, "audited")
    # all 27 loads read the events with their props parsed
    e = stored(ev.prepared(ev.table(spark, sf, "events")).select("event_id", "ts", "event_type", "value", "_k", "_day"), "prepared")
    for i, f in enumerate(FEEDS.values()):
        for load in (0, 1) if i else (0, 1, 1):  # one load is written again
            part = e.where(F.pmod("event_id", F.lit(2)) == load) if load else e.where("event_id is null or pmod(event_id, 2) = 0")
            quality.write_audited(stage(ev.feed_records(part, f), f), f"{base}/{f.name}/load={load}", f.staged_name,
                                  f"{base}/metrics", str(load))
    return quality.not_null_from_metrics(quality.read_metrics(spark, f"{base}/metrics"),
                                         {f.staged_name: f.not_null for f in FEEDS.values()})


def stage_missing_path(spark, sf):
    raw = ev.land_events(ev.table(spark, sf, "events"))
    cols = (Spec("id", "bigint", "event_id"), Spec("props.k", "int", "k"),
            Spec("note", "int", "missing"), Spec("props.missing.deep", "int", "missing_nested"),
            Spec("type", "int", "type_as_int"))
    return project_variant(raw, cols, passthrough=())


def explode_variant(spark, sf):
    """Envelope pages ``{"data": [...]}`` -> records; pages of error events carry no ``data``."""
    e = ev.table(spark, sf, "events")
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "int")
    page = F.when(F.col("event_type") == "error",
                  F.to_variant_object(F.struct(F.lit("none").alias("status"))))
    page = page.otherwise(F.to_variant_object(F.struct(F.array(
        F.struct(k.alias("k")), F.struct((k + 1).alias("k"))).alias("data"))))
    pages = e.select("event_id", page.alias("page"))
    rec = land.envelope_records(pages, "page", keep=["event_id"])
    return rec.select("event_id", F.col("pos").cast("int").alias("pos"),
                      F.try_variant_get("raw_data", "$.k", "int").alias("k"))


# ---- marts ---------------------------------------------------------------------

def mart_full_outer_chain(spark, sf):
    return _mart1(spark, sf, "join")


def mart_full_outer_chain_grouped(spark, sf):
    return _mart1(spark, sf, "grouped")


def mart_full_outer_key(spark, sf):
    return _mart2(spark, sf)


def mart_left_detail(spark, sf):
    st = _staged(spark, sf)
    return marts.sleep_detail(ev.sleep_periods(st), ev.sleep_time(st), ev.KEYS,
                              period_cols=SLEEP_DETAIL_COLUMNS)


def _duplicate_legs(spark, sf):
    """Legs with several rows per key: plain click and view events."""
    st = _staged(spark, sf)
    legs = ev.event_legs(st)
    of = lambda t, *cols: st.where(F.col("event_type") == t).select("user_id", "day", *cols)
    return legs | {"ready": of("click", F.col("value").alias("readiness_score")),
                   "sleep": of("view", F.col("value").alias("sleep_score"), F.col("k").alias("sleep_efficiency"))}


def mart_duplicates_join(spark, sf):
    """J1 on legs with several rows per key (plain events): the join form, where they multiply."""
    return marts.full_outer_chain(_duplicate_legs(spark, sf), ev.KEYS)


def mart_duplicates_product(spark, sf):
    """J1 on the same legs with one shuffle."""
    return marts.full_outer_chain(_duplicate_legs(spark, sf), ev.KEYS, method="product")


def mart_key_duplicates(spark, sf):
    """J2 on legs with several rows per key, with one shuffle."""
    got = marts.full_outer_on_key(_duplicate_legs(spark, sf), ev.KEYS, method="product")
    return got.select("user_id", "day", *[c for n in marts._OUT_ORDER for _, c in marts.WELLNESS_COLUMNS[n]])


# ---- report ----------------------------------------------------------------------

def metric_summary(spark, sf):
    return report.metric_summary(_per2(spark, sf), BY, fixed=FIXED)


def metric_summary_chain(spark, sf):
    return report.metric_summary(ev.with_periods(_mart1(spark, sf, "grouped")), BY, fixed=FIXED)


def trend_split_half(spark, sf):
    return metric_summary(spark, sf).select(*BY, "metric", "trend_direction", "trend_pct")


def threshold_alerts(spark, sf):
    return report.threshold_alerts(_stats(spark, sf), BY)


def decline_alerts(spark, sf):
    return report.decline_alerts(_stats(spark, sf), BY)


def alerts_merged(spark, sf):
    return report.alerts_from_stats(_stats(spark, sf), BY)


def personal_bests(spark, sf):
    return report.personal_bests(_per2(spark, sf), _sleep_per(spark, sf), BY,
                                 long_sleep=ev.LONG_SLEEP)


def ratio_summary(spark, sf):
    return report.sleep_summary(_sleep_per(spark, sf), BY, long_sleep=ev.LONG_SLEEP, fixed=FIXED)


def activity_summary(spark, sf):
    return report.workout_summary(ev.with_periods(ev.workouts(_staged(spark, sf))), BY)


def sufficiency_gate(spark, sf):
    return report.sufficiency_gate(_per2(spark, sf), BY)


def report_gated_summary(spark, sf):
    """The metric summaries of groups that pass the gate; one pass over the mart for both."""
    stats = stored(report.metric_stats(_per2(spark, sf), BY, data_split=False, fixed=FIXED), "gated-stats")
    return report.keep_ok(report.summarize(stats, BY), report.gate_from_stats(stats, BY), BY)


def report_full(spark, sf):
    """All six parts behind the gate, in one long table."""
    parts = report.build_report(_per2(spark, sf), _sleep_per(spark, sf),
                                ev.with_periods(ev.workouts(_staged(spark, sf))), BY,
                                long_sleep=ev.LONG_SLEEP, fixed=FIXED)
    return report.report_long(parts, BY)


STATE_SPEC = states.Spec(keys=tuple(ev.KEYS), long_sleep=ev.LONG_SLEEP, fixed=FIXED)


def report_from_states(spark, sf):
    """G14 from daily states: every day is loaded without its late events, then the days of late ones again.

    Late are events of every third day whose id divides by 4; some days have nothing but late events of a user.
    """
    root = fresh_path(spark, "states")
    whole = stored(_staged(spark, sf), "staged")
    late = (F.day("day") % 3 == 0) & (F.col("event_id") % 4 == 0)

    def sources(rows):
        return {"wellness": marts.full_outer_on_key(ev.event_legs(rows), ev.KEYS), "sleep": ev.sleep_periods(rows),
                "workouts": ev.workouts(rows)}

    def days_of(rows):  # bounded by the calendar
        return [r.day for r in rows.select("day").distinct().collect()]

    early = whole.where(~late)
    states.update_days(spark, root, sources(early), days_of(early), STATE_SPEC)
    again = days_of(whole.where(late))
    states.update_days(spark, root, sources(whole.where(F.col("day").isin(again))), again, STATE_SPEC)
    return report.report_long(states.report_from_states(spark, root, STATE_SPEC), BY)


def report_one_period(spark, sf):
    """The summaries of one requested week (an inclusive slice of the mart)."""
    week = report.with_period(_mart2(spark, sf), "weekly", *REPORT_WEEK)
    return report.metric_summary(week, BY, fixed=FIXED)


def report_requested_periods(spark, sf):
    """The summaries of four overlapping periods a user, of different lengths and ends, at once."""
    mart = _mart2(spark, sf)
    span = mart.groupBy("user_id").agg(F.min("day").alias("a"), F.max("day").alias("z"))
    one = lambda name, start, end: F.struct(F.lit(name).alias("period_type"), start.alias("start_date"), end.alias("end_date"))
    a, z, add = F.col("a"), F.col("z"), F.date_add
    periods = span.select("user_id", F.inline(F.array(
        one("first", a, add(a, 9)), one("early", add(a, 5), add(a, 40)), one("all", add(a, -3), z), one("late", add(z, -2), add(z, 30)))))
    return report.metric_summary(report.requested_periods(mart, periods, ev.KEYS), BY, fixed=FIXED)


def sleep_display(spark, sf):
    s = ratio_summary(spark, sf)
    stages = [D.pct0(f"{x}_pct") for x in ("deep", "light", "rem", "awake")]
    return s.select(*BY, F.concat(D.fmt1("avg_duration_hrs"), F.lit("h")).alias("duration"),
                    D.pct0("avg_efficiency").alias("efficiency"),
                    F.concat(D.fmt1("avg_hrv"), F.lit(" ms")).alias("hrv"),
                    F.concat(D.fmt1("avg_hr"), F.lit(" bpm")).alias("heart_rate"),
                    F.concat_ws(" / ", *stages).alias("stages"))


def workout_display(spark, sf):
    w = activity_summary(spark, sf)
    line = F.concat(D.title_label("activity"), F.lit(": "), D.sessions_text("sessions"))
    return w.select(*BY, "activity", line.alias("line"), D.sessions_text("total_count").alias("total"),
                    D.fmt0("total_calories").alias("calories"))


def areas_display(spark, sf):
    a = alerts_merged(spark, sf)
    return a.select(*BY, "metric", D.title_label("metric").alias("label"), D.avg_text("current_avg").alias("avg_text"),
                    "reason", "suggestion")


def activity_map(spark, sf):
    """F21 with sessions that have no activity (errors) and an empty one (signups)."""
    t = F.col("workout_activity")
    w = ev.workouts(_staged(spark, sf)).withColumn(
        "workout_activity", F.when(t == "error", F.lit(None)).when(t == "signup", F.lit("")).otherwise(t))
    packed = report.packed_by_activity(report.workout_summary(ev.with_periods(w), BY), BY)
    return packed.select(*BY, "total_count", F.array_join(F.transform(
        F.array_sort(F.map_entries("by_activity")),
        lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string"))), ",").alias("sessions"))


def _orders_days(spark, sf):
    return ev.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day"),
                                                "o_totalprice")


def _period_orders(spark, sf, period_type):
    o = report.assign_periods(_orders_days(spark, sf), (period_type,))
    return o.groupBy(*report.PERIOD).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast(DEC)).cast("double").alias("total_price"),
        F.min("day").alias("first_day"), F.max("day").alias("last_day"))


def period_weekly(spark, sf):
    g = _period_orders(spark, sf, "weekly")
    ps, pe = previous_week("start_date")
    return g.withColumn("prev_start", ps).withColumn("prev_end", pe)


def period_monthly(spark, sf):
    g = _period_orders(spark, sf, "monthly")
    ps, pe = previous_month("start_date")
    return g.withColumn("prev_start", ps).withColumn("prev_end", pe)


# ---- series ------------------------------------------------------------------------

def rolling_mean3(spark, sf):
    s = series.series_rolling(_sleep_per(spark, sf), BY, long_sleep=ev.LONG_SLEEP)
    return s.withColumn("rolling_mean", F.round("rolling_mean", 6))


def rolling_mean3_range(spark, sf):
    """W1 on event rows with the positions that split a hot (user, day)."""
    s = series.series_rolling(_sleep_per(spark, sf), BY, long_sleep=ev.LONG_SLEEP, method="range")
    return s.withColumn("rolling_mean", F.round("rolling_mean", 6))


def series_stacked_range(spark, sf):
    return series.series_stacked(_sleep_per(spark, sf), BY, long_sleep=ev.LONG_SLEEP, method="range")


def charts_long(spark, sf):
    """The four series in one table."""
    parts = series.chart_series(_per2(spark, sf), _sleep_per(spark, sf), BY, ev.LONG_SLEEP, STEP_TARGET)
    return series.charts_long(parts, BY)


def downsample_nth(spark, sf):
    return series.downsample_nth(_per2(spark, sf), BY, method="window").select(*BY, "day", "idx", "n")


def series_scores(spark, sf):
    return series.series_scores(_per2(spark, sf), BY, method="window")


def series_target(spark, sf):
    return series.series_target(_per2(spark, sf), BY, value="steps", target=STEP_TARGET, method="window")


def series_stacked(spark, sf):
    return series.series_stacked(_sleep_per(spark, sf), BY, long_sleep=ev.LONG_SLEEP)


def chart_counts(spark, sf):
    return series.chart_presence(_per2(spark, sf), _sleep_per(spark, sf), BY,
                                 long_sleep=ev.LONG_SLEEP).select(*BY, "charts")


def report_display(spark, sf):
    s = metric_summary(spark, sf)
    return s.select(
        *BY, "metric", D.title_label("metric").alias("label"), D.fmt1("mean").alias("mean_text"),
        D.fmt1("max_val").alias("max_text"), D.fmt1("min_val").alias("min_text"),
        D.trend_arrow("trend_direction").alias("arrow"), D.pct_text("trend_pct").alias("pct_text"),
        D.ratio_text("days_with_data", "total_days").alias("days_text"),
        D.report_subject("period_type", "start_date", "end_date").alias("subject"),
        D.period_header("start_date", "end_date").alias("header"),
        F.date_format("start_date", WEEKDAY_DATE).alias("start_label"),
        F.date_format("end_date", SHORT_DATE).alias("end_short"),
        F.date_format("end_date", LONG_DATE).alias("end_long"))


def bests_display(spark, sf):
    b = personal_bests(spark, sf)
    return b.select(*BY, "metric", D.best_line("metric", "value", "day").alias("line"))


# ---- landing ---------------------------------------------------------------------

def latest_by(spark, sf):
    e = ev.table(spark, sf, "events").select(
        "user_id", "event_id", "event_type", "value",
        F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                         F.col("ts")).alias("ts_us"))
    return land.latest_by(e, ["user_id"], ["ts_us", "event_id"])


def _read_back(spark, root):
    return _staged_cols(ev.stage_events(land.read_raw(spark, root, "events", EVENTS_FEED)))


def upsert_idempotent(spark, sf):
    """Backfill every day, then re-load one day twice: the table equals one load."""
    root = fresh_path(spark, "upsert")
    raw = ev.land_events(ev.table(spark, sf, "events"))
    span = raw.agg(F.min("partition_date"), F.max("partition_date")).first()
    days = [span[0] + dt.timedelta(days=i) for i in range((span[1] - span[0]).days + 1)]
    land.backfill(spark, root, "events", raw, days, EVENTS_FEED)
    d0 = days[len(days) // 2]
    day_batch = raw.where(F.col("partition_date") == F.lit(d0)).select("raw_data")
    for _ in range(2):
        land.upsert_day(spark, root, "events", day_batch, d0, EVENTS_FEED)
    return _read_back(spark, root)


def backfill_range(spark, sf):
    """Two overlapping backfills plus a requested day without data (it is cleared)."""
    root = fresh_path(spark, "backfill")
    raw = ev.land_events(ev.table(spark, sf, "events"))
    span = raw.agg(F.min("partition_date"), F.max("partition_date")).first()
    n = (span[1] - span[0]).days + 1
    days = [span[0] + dt.timedelta(days=i) for i in range(n)]
    land.backfill(spark, root, "events", raw, days[: n // 2 + 2], EVENTS_FEED)
    land.backfill(spark, root, "events", raw,
                  days[n // 2:] + [span[1] + dt.timedelta(days=1)], EVENTS_FEED)
    return _read_back(spark, root)


def _half_days(spark, sf, landing):
    """Two file drops per day (morning, afternoon), one at a time."""
    raw = ev.land_events(ev.table(spark, sf, "events").withColumn("_pm", F.hour("ts") >= 12))
    for pm in (False, True):
        (raw.where(F.col("_pm") == F.lit(pm)).select(F.to_json("raw_data").alias("value"),
                                                     "partition_date")
         .write.mode("append").partitionBy("partition_date").text(landing))
        yield pm


def stream_land(spark, sf):
    """Both drops landed by a streaming run of several batches each."""
    base = fresh_path(spark, "stream")
    landing, root, ck = f"{base}/landing", f"{base}/raw", f"{base}/checkpoint"
    for _ in _half_days(spark, sf, landing):
        q = start_landing(spark, landing, root, "events", ck, EVENTS_FEED, max_files=40)
        q.awaitTermination()
    return _staged_cols(ev.stage_events(read_streamed(spark, root, "events", EVENTS_FEED)))


def stream_compact(spark, sf):
    """The stream's loads compacted after each drop, the old ones deleted, and the first batch replayed."""
    base = fresh_path(spark, "compact")
    landing, root, ck = f"{base}/landing", f"{base}/raw", f"{base}/checkpoint"
    first = None
    for _ in _half_days(spark, sf, landing):
        q = start_landing(spark, landing, root, "events", ck, EVENTS_FEED, max_files=40)
        q.awaitTermination()
        if first is None:
            at = f"{root}/events"
            first = stored(spark.read.option("basePath", at).parquet(at).where("load_id = 0")
                           .select("raw_data", F.col("partition_date").cast("date").alias("partition_date")), "first-load")
        compaction.compact(spark, root, "events", min_loads=1)
    compaction.vacuum(spark, root, "events")
    write_batch(first, root, "events", 0)
    return _staged_cols(ev.stage_events(read_streamed(spark, root, "events", EVENTS_FEED)))


LOAD_DAY = dt.date(2024, 2, 1)


def land_all_feeds(spark, sf):
    """Every feed landed from its files, with a quarantine, and staged: rows, rejects and NULLs of each.

    Events are dealt to the 13 feeds by id. Every other feed comes as pages, the others as lines. Planted:
    cut-off units (id divides by 17) and records that are a text (by 19).
    """
    base = fresh_path(spark, "feeds")
    e, texts = ev.prepared(ev.table(spark, sf, "events")), []
    for i, spec in enumerate(FEEDS.values()):
        mine = e.where(F.col("event_id") % len(FEEDS) == i)
        good = F.to_json(ev.feed_record(spec))
        unit = F.when(F.col("event_id") % 19 == 0, F.lit('"lost"')).otherwise(good)
        if i % 2 == 0:
            unit = F.concat(F.lit('{"data":['), unit, F.lit("]}"))
        texts.append(mine.select(unit.alias("u"), "event_id", F.lit(spec.name).alias("feed")))
    cut = F.when(F.col("event_id") % 17 == 0, F.expr("left(u, length(u) - 1)")).otherwise(F.col("u"))
    every = reduce(lambda a, b: a.unionByName(b), texts)
    every.select(cut.alias("value"), "feed").write.partitionBy("feed").option(
        "maxRecordsPerFile", PAGE_RECORDS).text(f"{base}/files")
    parts = []
    for i, (name, spec) in enumerate(FEEDS.items()):
        files = f"{base}/files/feed={name}"
        if path_exists(spark, files):
            land.load_feed_day(spark, f"{base}/raw", name, files, LOAD_DAY, envelope=i % 2 == 0, max_rejects=0.25)
        else:
            land.upsert_day(spark, f"{base}/raw", name, None, LOAD_DAY)
        st = stage(land.read_raw(spark, f"{base}/raw", name), name)
        nulls = F.array(*[F.struct(F.lit(f"null {c}").alias("item"), F.count_if(F.col(c).isNull()).alias("n"))
                          for c in spec.not_null], F.struct(F.lit("rows").alias("item"), F.count(F.lit(1)).alias("n")))
        parts.append(st.agg(nulls.alias("x")).select(F.lit(name).alias("feed"), F.inline("x")))
        parts.append(land.read_rejected(spark, f"{base}/raw", name).groupBy(F.col("reason").alias("item")).agg(
            F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("feed"), "item", "n"))
    return reduce(lambda a, b: a.unionByName(b), parts)


#: Records of an envelope page at most.
PAGE_RECORDS = 10_000


def _paged(raw, most):
    """``raw_data`` as JSON with a page number: at most ``most`` records a day's page, and two pages a day at least.

    A day's records are dealt to buckets, whose number grows with the day, by their place in the
    input, so that equal records spread too; within its bucket each page ends after ``most`` records.
    """
    sizes = raw.groupBy("partition_date").agg(F.count(F.lit(1)).alias("n")).collect()  # bounded by the calendar
    if not sizes:
        return raw.select("partition_date", F.to_json("raw_data").alias("r"), F.lit(0).cast("long").alias("page"))
    buckets = raw.sparkSession.createDataFrame(
        [(r.partition_date, max(2, -(-2 * r.n // most))) for r in sizes], "d date, buckets long")
    placed = raw.withColumn("_place", F.monotonically_increasing_id())
    dealt = placed.join(F.broadcast(buckets), placed.partition_date.eqNullSafe(F.col("d"))).select(
        "partition_date", F.to_json("raw_data").alias("r"), "_place", "buckets",
        F.pmod(F.xxhash64("_place"), "buckets").alias("_bucket"))
    nth = F.row_number().over(Window.partitionBy("partition_date", "_bucket").orderBy("_place")) - 1
    return dealt.select("partition_date", "r", (F.col("_bucket") + F.col("buckets") * F.floor(nth / most)).alias("page"))


def land_envelope_files(spark, sf):
    """A1: envelope pages written as files (every other one over several lines), landed and staged."""
    base = fresh_path(spark, "envelope")
    raw = ev.land_events(ev.table(spark, sf, "events"))
    pages = _paged(raw, PAGE_RECORDS).groupBy("partition_date", "page").agg(F.collect_list("r").alias("r"))
    text = F.concat(F.lit('{"data":['), F.array_join("r", ","), F.lit("]}"))
    text = F.when(F.col("page") % 2 == 1, F.replace(text, F.lit('},{"'), F.lit('},\n  {"'))).otherwise(text)
    pages.select(text.alias("value"), "partition_date", "page").write.partitionBy("partition_date", "page").text(f"{base}/pages")
    found = land.envelope_records(land.read_pages(spark, f"{base}/pages"), keep=["partition_date"])
    days = [r[0] for r in raw.select("partition_date").distinct().collect()]  # bounded by the calendar
    land.backfill(spark, f"{base}/raw", "events", found.select("raw_data", "partition_date"), days, EVENTS_FEED)
    return _read_back(spark, f"{base}/raw")


# ---- quality ------------------------------------------------------------------------

def not_null_audit(spark, sf):
    raw = ev.land_events(ev.table(spark, sf, "events"))
    staged = project_variant(raw, (*ev.EVENT_COLUMNS, Spec("note", "string", "note")))
    return quality.not_null_audit(staged, "stg_events",
                                  ["event_id", "user_id", "day", "event_type", "k", "note",
                                   "partition_date"])


def completeness(spark, sf):
    return quality.completeness(_mart2(spark, sf), list(report.WELLNESS_METRICS))


def coverage(spark, sf):
    st = _staged(spark, sf)
    return quality.coverage(st, "partition_date", ["event_type"])


def union_counts(spark, sf):
    return quality.row_counts({t: ev.table(spark, sf, t) for t in TABLES})


def _audit_grid(spark, sf, days):
    """All types in the data and all registered feeds over the window up to the last day."""
    counts = _staged(spark, sf).groupBy(F.col("event_type").alias("feed"), "day").agg(F.count(F.lit(1)).alias("rows"))
    counts = stored(counts, "feed-days")
    there = counts.select("feed").distinct()
    registered = spark.createDataFrame([(f,) for f in REGISTERED_FEEDS], "feed string")
    named = there.unionByName(registered).distinct().withColumn(
        "grp", F.when(F.col("feed").isin(*PROBLEM_FEEDS), F.lit("problem")).otherwise(F.lit("control")))
    first, last = quality.trailing_window(ev.last_day(spark, sf) + dt.timedelta(days=1), days)
    return quality.feed_day_grid(counts, named, first, last, existing=there)


def feed_day_grid(spark, sf):
    return _audit_grid(spark, sf, GRID_DAYS).drop("grp")


def single_day_audit(spark, sf):
    """Q4: the last four days of the problem and the control group."""
    return _audit_grid(spark, sf, SINGLE_DAYS)


def _reconcile_sides(spark, sf):
    """Landed and staged ids with planted differences: dropped, added, doubled and NULL ids."""
    e = ev.table(spark, sf, "events")
    raw = ev.land_events(e).select("partition_date", F.try_variant_get("raw_data", "$.id", "bigint").alias("id"))
    raw = raw.unionByName(raw.where("id % 5 = 0"))
    staged = _staged(spark, sf).select("partition_date", F.col("event_id").alias("id"))
    staged = staged.where("id % 7 <> 0").unionByName(staged.where("id % 11 = 0").withColumn("id", F.col("id") + 1000000000))
    null = lambda df: df.withColumn("id", F.when(F.col("id") % 13 != 0, F.col("id")))
    return null(raw), null(staged)


def reconcile(spark, sf):
    return quality.reconcile(*_reconcile_sides(spark, sf), ["id"])


def reconcile_tree(spark, sf):
    """The same report; ids are shuffled from unequal hash ranges only."""
    return quality.reconcile(*_reconcile_sides(spark, sf), ["id"], method="tree")


def reconcile_tree_equal_days(spark, sf):
    """Differences on even days only: odd days are settled by their checksums and not read again."""
    raw = ev.land_events(ev.table(spark, sf, "events")).select(
        "partition_date", F.try_variant_get("raw_data", "$.id", "bigint").alias("id"))
    staged = _staged(spark, sf).select("partition_date", F.col("event_id").alias("id")).where(
        (F.day("partition_date") % 2 == 1) | (F.col("id") % 7 != 0))
    return quality.reconcile(raw, staged, ["id"], method="tree")


def reconcile_checksum(spark, sf):
    """Differences planted on even days only."""
    raw = ev.land_events(ev.table(spark, sf, "events")).select(
        "partition_date", F.try_variant_get("raw_data", "$.id", "bigint").alias("id"))
    staged = _staged(spark, sf).select("partition_date", F.col("event_id").alias("id")).where(
        (F.day("partition_date") % 2 == 1) | (F.col("id") % 7 != 0))
    return quality.reconcile(raw, staged, ["id"], method="checksum")


def row_count_checks(spark, sf):
    """Q2 over every driver table (all exist and have rows: pass without severity)."""
    sfp = sf.rstrip("/")
    parts = [quality.row_count_check(spark, t, f"{sfp}/{t}.parquet") for t in TABLES]
    return reduce(lambda a, b: a.unionByName(b), parts)


def key_null_counts(spark, sf):
    """Q6 on the daily mart keys."""
    return quality.key_null_counts(_mart2(spark, sf), ["user_id", "day"])


def detail_null_counts(spark, sf):
    """Q6 on the id of the sleep detail, with planted NULLs."""
    st = _staged(spark, sf).withColumn("event_id", F.when(F.col("event_id") % 13 != 0, F.col("event_id")))
    detail = marts.sleep_detail(ev.sleep_periods(st), ev.sleep_time(st), ev.KEYS, period_cols=SLEEP_DETAIL_COLUMNS)
    return quality.key_null_counts(detail, ["id", "day"])


def row_count_outcomes(spark, sf):
    """Q2: a table with rows, one without, and one that does not exist."""
    e = ev.table(spark, sf, "events")
    empty = fresh_path(spark, "no-rows")
    e.where("event_id is null").write.parquet(empty)
    parts = [quality.row_count_check(spark, "events", f"{sf.rstrip('/')}/events.parquet"),
             quality.row_count_check(spark, "no_rows", empty),
             quality.row_count_check(spark, "no_table", fresh_path(spark, "no-table"))]
    return reduce(lambda a, b: a.unionByName(b), parts)


def request_days(spark, sf):
    """A3: rows per day of a requested range, as an end-exclusive and an inclusive source serve it."""
    e = ev.table(spark, sf, "events")
    parts = [feeds.day_range(e, "ts", x, *REPORT_WEEK).groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("rows")).select(F.lit(x).alias("endpoint"), "day", "rows")
        for x in ("daily_activity", "daily_sleep")]
    return reduce(lambda a, b: a.unionByName(b), parts)


def feed_coverage(spark, sf):
    """Q3: rows per feed over the audit grid, with the note for feeds without rows."""
    return quality.feed_coverage(feed_day_grid(spark, sf))


def flatten_tags(spark, sf):
    """A per-event tag array landed in VARIANT, flattened to one row per element."""
    e = ev.table(spark, sf, "events")
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "int")
    tags = F.array(F.col("event_type"), F.concat(F.lit("k"), k.cast("string")))
    raw = e.select("event_id", F.to_variant_object(F.struct(tags.alias("tags"))).alias("raw_data"))
    flat = flatten_array(raw, "tags", keep=["event_id"])
    return flat.select("event_id", F.col("pos").cast("int").alias("pos"),
                       F.try_variant_get("value", "$", "string").alias("tag"))


def trailing_daily_sum(spark, sf):
    e = ev.table(spark, sf, "events")
    return quality.trailing_daily_sum(e, "ts", "value", TRAILING_ANCHOR, 7, ["event_type"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        stage_variant, stage_missing_path, explode_variant, *FEED_QUERIES, not_null_pairs, not_null_observed, mart_duplicates_join,
        mart_duplicates_product, mart_key_duplicates,
        report_full, report_from_states, report_one_period,
        report_requested_periods, sleep_display, workout_display, areas_display, activity_map,
        rolling_mean3_range, series_stacked_range, charts_long, land_envelope_files, single_day_audit,
        detail_null_counts, row_count_outcomes, request_days,
        mart_full_outer_chain, mart_full_outer_chain_grouped, mart_full_outer_key, mart_left_detail,
        metric_summary, metric_summary_chain, trend_split_half, threshold_alerts, decline_alerts,
        alerts_merged, personal_bests, ratio_summary, activity_summary, sufficiency_gate,
        report_gated_summary, period_weekly, period_monthly,
        rolling_mean3, downsample_nth, series_scores, series_target, series_stacked, chart_counts,
        report_display, bests_display, latest_by, upsert_idempotent, backfill_range, stream_land,
        stream_compact, land_all_feeds,
        not_null_audit, completeness, coverage, union_counts, feed_day_grid, reconcile,
        reconcile_tree, reconcile_tree_equal_days,
        trailing_daily_sum, reconcile_checksum, row_count_checks, key_null_counts, feed_coverage, flatten_tags,
    )
}
