"""End to end on stored tables: land six daily feeds for two users, stage them,
build the daily mart and the full report, and check it against plain Python."""

import datetime as dt
import json

from pyspark.sql import functions as F

from daypulse.operators import marts, report, stage
from daypulse.sources import land

DAYS = [dt.date(2026, 1, 5) + dt.timedelta(days=i) for i in range(7)]  # Mon..Sun
USERS = ("u1", "u2")


def records(feed, user, i, day):
    base = {"user_id": user, "day": day.isoformat()}
    score = 60 + 3 * i + (10 if user == "u2" else 0)
    if feed == "readiness":
        return {**base, "score": score}
    if feed == "sleep":
        return {**base, "id": f"{user}-{i}", "score": score + 5, "contributors": {"efficiency": 80 + i}}
    if feed == "activity":
        return {**base, "steps": 5000 + 1000 * i, "total_calories": 2000 + 10 * i}
    if feed == "spo2":
        return {**base, "spo2_percentage": {"average": 96.5}, "breathing_disturbance_index": 1.0}
    if feed == "stress":
        return {**base, "stress_high": 100 - i, "recovery_high": 200 + i, "day_summary": "normal"}
    return {**base, "level": "solid", "contributors": {"sleep_recovery": 50.0, "daytime_recovery": 40.0,
                                                       "stress": 30.0}}


def test_land_stage_mart_report(spark, tmp_root):
    feeds = ("readiness", "sleep", "activity", "spo2", "stress", "resilience")
    for f in feeds:
        for i, day in enumerate(DAYS):
            if f == "readiness" and i == 3:
                continue  # a day without readiness for both users
            rows = [(json.dumps(records(f, u, i, day)),) for u in USERS]
            batch = land.to_raw(spark.createDataFrame(rows, "js string"), "js")
            assert land.upsert_day(spark, tmp_root, f, batch, day) == 2
    staged = {f: stage.stage(land.read_raw(spark, tmp_root, f), f, keys=["user_id"]) for f in feeds}
    legs = marts.wellness_legs(staged, ["user_id"])
    daily = marts.full_outer_on_key(legs, ["user_id"])
    assert daily.count() == 14
    chain = marts.full_outer_chain(legs, ["user_id"])
    assert chain.count() == 16  # the day without readiness splits into sleep and activity rows

    periods = report.assign_periods(daily, ("weekly",))
    by = ["user_id", "period_type", "start_date", "end_date"]
    empty_sleep = spark.createDataFrame([], "user_id string, id string, day date, sleep_type string, "
                                            "total_sleep_duration int, deep_sleep_duration int, "
                                            "light_sleep_duration int, rem_sleep_duration int, "
                                            "awake_time int, time_in_bed int, efficiency int, "
                                            "avg_hrv double, avg_hr double, lowest_hr int")
    empty_sleep = report.assign_periods(empty_sleep, ("weekly",))
    workouts = report.assign_periods(spark.createDataFrame(
        [("u1", DAYS[0], "running", 300.0)], "user_id string, day date, workout_activity string, "
                                              "workout_calories double"), ("weekly",))
    parts = report.build_report(periods, empty_sleep, workouts, by)
    gate = {r["user_id"]: r["status"] for r in parts["gate"].collect()}
    assert gate == {"u1": "ok", "u2": "ok"}
    ms = {(r["user_id"], r["metric"]): r for r in parts["metric_summaries"].collect()}
    r1 = [60 + 3 * i for i in range(7) if i != 3]
    assert ms[("u1", "readiness_score")]["mean"] == round(sum(r1) / len(r1), 2)
    assert ms[("u1", "readiness_score")]["days_with_data"] == 6
    assert ms[("u1", "readiness_score")]["total_days"] == 7
    assert ms[("u2", "steps")]["trend_direction"] == "improving"
    assert ms[("u1", "sleep_efficiency")]["max_val"] == 86.0
    alerts = {(r["user_id"], r["metric"]): r["reason"] for r in parts["areas_to_improve"].collect()}
    assert alerts[("u1", "readiness_score")] == "Below target of 70.0"
    assert ("u2", "readiness_score") not in alerts  # u2 averages above 70
    bests = {(r["user_id"], r["metric"]): (r["value"], r["day"]) for r in parts["personal_bests"].collect()}
    assert bests[("u2", "steps")] == (11000.0, DAYS[6])
    assert parts["sleep_summary"].count() == 0
    assert parts["workout_summary"].where(F.col("user_id") == "u1").first()["total_calories"] == 300.0


def granular(feed, user, i, day):
    if feed == "sleep_periods":
        total = 25200 + 600 * i
        return {"user_id": user, "id": f"{user}-p{i}", "day": day.isoformat(), "type": "long_sleep",
                "total_sleep_duration": total, "deep_sleep_duration": total // 5,
                "light_sleep_duration": total // 2, "rem_sleep_duration": total - total // 5 - total // 2,
                "awake_time": 1800, "time_in_bed": total + 1800, "efficiency": 85 + i % 3,
                "average_heart_rate": 55.0, "average_hrv": 40.0 + i, "lowest_heart_rate": 48 - i % 2}
    if feed == "sleep_time":
        return {"user_id": user, "day": day.isoformat(), "recommendation": "earlier_bedtime",
                "optimal_bedtime": {"start_offset": -1800, "end_offset": 1800, "day_tz": 0}, "status": "ok"}
    return {"user_id": user, "id": f"{user}-w{i}", "day": day.isoformat(),
            "activity": "running" if i % 2 else "walking", "calories": 100.0 + i}


def test_readme_flow_on_a_landed_lake(spark, tmp_root):
    from daypulse.operators import series
    feeds = ("readiness", "sleep", "activity", "spo2", "stress", "resilience")
    for i, day in enumerate(DAYS):
        for f in feeds:
            rows = [(json.dumps(records(f, u, i, day)),) for u in USERS]
            land.upsert_day(spark, tmp_root, f, land.to_raw(spark.createDataFrame(rows, "js string"), "js"), day)
        for f in ("sleep_periods", "sleep_time", "workouts"):
            rows = [(json.dumps(granular(f, u, i, day)),) for u in USERS]
            land.upsert_day(spark, tmp_root, f, land.to_raw(spark.createDataFrame(rows, "js string"), "js"), day)

    # the README example, verbatim apart from the lake path
    keys = ["user_id"]
    raw = lambda f: land.read_raw(spark, tmp_root, f)
    staged = {f: stage.stage(raw(f), f, keys=keys)
              for f in ("sleep", "activity", "readiness", "spo2", "stress", "resilience")}
    daily = marts.full_outer_on_key(marts.wellness_legs(staged, keys), keys)
    sleep = marts.sleep_detail(stage.stage(raw("sleep_periods"), "sleep_periods", keys=keys),
                               stage.stage(raw("sleep_time"), "sleep_time", keys=keys), keys)
    workouts = stage.stage(raw("workouts"), "workouts", keys=keys)
    by = [*keys, "period_type", "start_date", "end_date"]
    parts = report.build_report(report.assign_periods(daily), report.assign_periods(sleep),
                                report.assign_periods(workouts), by)
    charts = series.chart_series(report.assign_periods(daily), report.assign_periods(sleep), by)

    ss = {(r["user_id"], r["period_type"]): r for r in parts["sleep_summary"].collect()}
    totals = [25200 + 600 * i for i in range(7)]
    assert ss[("u1", "weekly")]["nights"] == 7
    assert ss[("u1", "weekly")]["avg_duration_hrs"] == round(sum(totals) / 7 / 3600, 2)
    assert ss[("u1", "weekly")]["avg_hrv"] == 43.0
    wk = {(r["user_id"], r["period_type"], r["activity"]): r for r in parts["workout_summary"].collect()}
    assert wk[("u2", "weekly", "running")]["sessions"] == 3 and wk[("u2", "weekly", "walking")]["sessions"] == 4
    assert wk[("u2", "weekly", "running")]["total_calories"] == sum(100.0 + i for i in range(7))
    bests = {(r["user_id"], r["period_type"], r["metric"]): r["value"] for r in parts["personal_bests"].collect()}
    assert bests[("u1", "weekly", "avg_hrv")] == 46.0 and bests[("u1", "weekly", "lowest_hr")] == 47.0
    hrv = charts["hrv_trend"].where("user_id = 'u1' and period_type = 'weekly'").orderBy("idx").collect()
    assert [round(r["rolling_mean"], 4) for r in hrv[:3]] == [40.0, 40.5, 41.0]
    assert charts["sleep_stages"].count() == 2 * 7 * 2  # two users, seven nights, two period types
