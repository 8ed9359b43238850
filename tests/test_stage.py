import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from daypulse.operators.stage import flatten_array, project_variant, stage
from daypulse.sources import feeds
from daypulse.sources.feeds import Column as Spec
from daypulse.sources.land import envelope_records, to_raw


def raw_of(spark, records, day=dt.date(2026, 1, 15)):
    rows = [(json.dumps(r), day) for r in records]
    df = spark.createDataFrame(rows, "js string, partition_date date")
    return to_raw(df, "js", keep=["partition_date"])


def test_registry_has_13_feeds_and_40_not_null_pairs():
    assert len(feeds.FEEDS) == 13
    assert len(feeds.not_null_pairs()) == 40


def test_whitelist_rejects_unknown_and_injection():
    with pytest.raises(ValueError):
        feeds.feed("nope")
    with pytest.raises(ValueError):
        feeds.feed("sleep; DROP TABLE x")


def test_endpoint_lookup_falls_through():
    assert feeds.endpoint_for("sleep") == "daily_sleep"
    assert feeds.endpoint_for("heartrate") == "heartrate"


def test_end_date_rule():
    d = dt.date(2026, 3, 14)
    nxt = dt.date(2026, 3, 15)
    for ep in ("daily_activity", "sleep", "workout", "session", "tag", "rest_mode_period"):
        assert feeds.request_end(ep, d) == nxt
    for ep in ("daily_sleep", "heartrate", "sleep_time"):
        assert feeds.request_end(ep, d) == d


def test_sleep_staging_nested_and_missing(spark):
    raw = raw_of(spark, [
        {"id": "s1", "day": "2026-01-15", "score": 84, "timestamp": "2026-01-15T00:00:00+00:00",
         "contributors": {"deep_sleep": 90, "efficiency": 88, "latency": 70, "rem_sleep": 80,
                          "restfulness": 75, "timing": 60, "total_sleep": 85}},
        {"id": "s2", "day": "2026-01-16", "score": None},
        {"id": "s3", "day": "2026-01-17", "score": "not a number", "contributors": {}},
    ])
    out = {r["id"]: r for r in stage(raw, "sleep").collect()}
    assert out["s1"]["sleep_score"] == 84 and out["s1"]["deep_sleep_score"] == 90
    assert out["s1"]["day"] == dt.date(2026, 1, 15)
    assert out["s2"]["sleep_score"] is None  # JSON null
    assert out["s2"]["efficiency_score"] is None  # nested object missing
    assert out["s3"]["sleep_score"] is None  # wrong type, lenient
    assert out["s3"]["timing_score"] is None
    assert out["s1"]["partition_date"] == dt.date(2026, 1, 15)


def test_strict_mode_fails_on_wrong_type(spark):
    raw = raw_of(spark, [{"day": "x", "score": "bad"}])
    with pytest.raises(Exception):
        stage(raw, "readiness", strict=True).collect()


def test_spo2_nested_average_and_heartrate_written_date(spark):
    raw = raw_of(spark, [{"day": "2026-01-15", "spo2_percentage": {"average": 97.4},
                          "breathing_disturbance_index": 1.2}])
    r = stage(raw, "spo2").first()
    assert abs(r["avg_spo2_pct"] - 97.4) < 1e-6 and abs(r["breathing_disturbance_index"] - 1.2) < 1e-6
    hr = stage(raw_of(spark, [{"timestamp": "2026-01-15T23:30:00-07:00", "bpm": 58}]), "heartrate").first()
    assert hr["day"] == dt.date(2026, 1, 15)
    assert hr["ts"] == "2026-01-15T23:30:00-07:00" and hr["bpm"] == 58


def test_tags_array_as_json_text(spark):
    raw = raw_of(spark, [{"id": "t1", "day": "2026-01-15", "timestamp": "2026-01-15T08:00:00",
                          "text": "note", "tags": ["a", "b"]}])
    r = stage(raw, "tags").first()
    assert r["tags"] == '["a","b"]' and r["note_text"] == "note"


def test_sleep_time_and_rest_mode_columns(spark):
    raw = raw_of(spark, [{"day": "2026-01-15", "optimal_bedtime": {"start_offset": -1800,
                          "end_offset": 1800, "day_tz": 0}, "recommendation": "earlier_bedtime",
                          "status": "ok"}])
    r = stage(raw, "sleep_time").first()
    assert (r["optimal_bedtime_start_offset"], r["optimal_bedtime_end_offset"],
            r["optimal_bedtime_tz_offset"]) == (-1800, 1800, 0)
    rm = stage(raw_of(spark, [{"id": "r", "start_day": "2026-01-01", "end_day": "2026-01-03"}]),
               "rest_mode_periods")
    assert "day" not in rm.columns and rm.first()["end_day"] == dt.date(2026, 1, 3)


def test_every_feed_stages_with_its_spec(spark):
    raw = raw_of(spark, [{"id": "x", "day": "2026-01-15"}])
    for name, spec in feeds.FEEDS.items():
        df = stage(raw, name)
        assert df.columns == [c.alias for c in spec.columns] + ["partition_date"]
        assert df.count() == 1


def test_envelope_without_data_gives_zero_rows(spark):
    pages = raw_of(spark, [{"data": [{"a": 1}, {"a": 2}]}, {"other": 1}, {"data": "oops"}])
    recs = envelope_records(pages)
    vals = sorted(r["a"] for r in project_variant(recs, [Spec("a", "int", "a")], passthrough=()).collect())
    assert vals == [1, 2]


def test_flatten_array(spark):
    raw = raw_of(spark, [{"tags": ["a", "b", "c"]}, {"tags": []}, {}])
    out = flatten_array(raw, "tags").select("pos", F.try_variant_get("value", "$", "string").alias("v"))
    assert sorted((r["pos"], r["v"]) for r in out.collect()) == [(0, "a"), (1, "b"), (2, "c")]


def test_registry_frame(spark):
    df = feeds.registry_frame(spark)
    rows = {r["feed"]: r for r in df.collect()}
    assert len(rows) == 13
    assert rows["activity"]["endpoint"] == "daily_activity" and rows["activity"]["end_exclusive"]
    assert rows["heartrate"]["kind"] == "granular" and not rows["heartrate"]["end_exclusive"]
    assert rows["sleep_periods"]["n_columns"] == 18


def test_records_of_events_parse_props_once(spark):
    from daypulse.plans import events as ev
    from daypulse.sources.feeds import FEEDS

    events = spark.createDataFrame([(1, 2, "view", 1.5, '{"k": 3}')], "event_id long, user_id long, event_type string, value double, props string")
    events = events.withColumn("ts", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    for spec in FEEDS.values():
        plan = stage(ev.feed_records(events, spec), spec)._jdf.queryExecution().analyzed().toString()
        assert plan.lower().count("try_parse_json") + plan.lower().count("parsejson") <= 1, spec.name
