"""Golden test on frames shaped like the reference's three CSV fixtures (our own
values): read through the CSV scan, run the whole report for one period with no
entity keys, and compare every part with plain Python."""

import csv
import datetime as dt
import random

from daypulse.operators import report, series
from daypulse.sources.land import read_csv

START, END = dt.date(2025, 1, 1), dt.date(2025, 1, 30)
DAYS = [START + dt.timedelta(days=i) for i in range(30)]
WELLNESS_SCHEMA = ("day date, readiness_score long, steps long, calories long, sleep_score long, "
                   "sleep_efficiency long, avg_spo2_pct double, breathing_disturbance_index double, "
                   "stress_high long, recovery_high long, stress_summary string, resilience_level string, "
                   "sleep_recovery_score double, daytime_recovery_score double, resilience_stress_score double")
SLEEP_SCHEMA = ("id string, day date, sleep_type string, total_sleep_duration long, deep_sleep_duration long, "
                "light_sleep_duration long, rem_sleep_duration long, awake_time long, time_in_bed long, "
                "efficiency long, avg_hr double, avg_hrv double, lowest_hr long")
WORKOUT_SCHEMA = "id string, day date, workout_activity string, workout_calories double"


def write_csv(path, header, rows):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def make(tmp):
    rnd = random.Random(2025)
    wellness = []
    for i, d in enumerate(DAYS):
        wellness.append((d, None if i in (3, 10, 23) else 60 + rnd.randrange(26), 5000 + 350 * rnd.randrange(29),
                         1950 + 10 * rnd.randrange(86), 64 + rnd.randrange(32),
                         None if i in (5, 25) else (60 if i == 13 else 80 + rnd.randrange(15)),
                         round(95.8 + rnd.randrange(25) / 10, 1), round(rnd.random() * 3, 1),
                         80 + 5 * rnd.randrange(28), 210 + 5 * rnd.randrange(37), str(rnd.randrange(3)),
                         rnd.choice(["limited", "adequate", "solid", "strong", "exceptional"]),
                         50.0, 40.0, 30.0))
    sleep = []
    for i, d in enumerate(DAYS):
        total = 24000 + 60 * rnd.randrange(100)
        deep, light = total // 5, total // 2
        sleep.append((f"s{i}", d, "long_sleep", total, deep, light, total - deep - light, 1200 + 60 * rnd.randrange(20),
                      total + 1800, 80 + rnd.randrange(15), 50.0 + rnd.randrange(12), 30.0 + rnd.randrange(36),
                      44 + rnd.randrange(10)))
    for j, (kind, d) in enumerate([("nap", DAYS[2]), ("nap", DAYS[9]), ("nap", DAYS[17]), ("rest", DAYS[4]),
                                   ("rest", DAYS[20])]):
        sleep.append((f"x{j}", d, kind, 1800, 0, 1800, 0, 0, 1800, 99, 70.0, 99.0, 30))
    acts = ["cycling"] * 4 + ["running"] * 5 + ["strength_training"] * 3 + ["walking"] * 3
    workouts = [(f"w{i}", DAYS[2 * i], a, float(200 + 25 * i)) for i, a in enumerate(acts)]
    names = [c.split()[0] for c in WELLNESS_SCHEMA.split(", ")]
    write_csv(f"{tmp}/wellness.csv", names, wellness)
    write_csv(f"{tmp}/sleep.csv", [c.split()[0] for c in SLEEP_SCHEMA.split(", ")], sleep)
    write_csv(f"{tmp}/workouts.csv", [c.split()[0] for c in WORKOUT_SCHEMA.split(", ")], workouts)
    return wellness, sleep, workouts, names


def mean(xs):
    xs = [x for x in xs if x is not None]
    return sum(xs) / len(xs) if xs else None


def test_fixture_shaped_report(spark, tmp_root):
    wellness, sleep, workouts, names = make(tmp_root)
    w = read_csv(spark, f"{tmp_root}/wellness.csv", WELLNESS_SCHEMA)
    s = read_csv(spark, f"{tmp_root}/sleep.csv", SLEEP_SCHEMA)
    k = read_csv(spark, f"{tmp_root}/workouts.csv", WORKOUT_SCHEMA)
    assert (w.count(), s.count(), k.count()) == (30, 35, 15)
    w, s, k = (report.with_period(x, "monthly", START, END) for x in (w, s, k))
    parts = report.build_report(w, s, k, report.PERIOD)
    col = {n: [r[i] for r in wellness] for i, n in enumerate(names)}

    # metric summaries
    ms = {r["metric"]: r for r in parts["metric_summaries"].collect()}
    assert set(ms) == set(report.WELLNESS_METRICS)
    mid = dt.date.fromordinal((START.toordinal() + END.toordinal()) // 2)
    for m in report.WELLNESS_METRICS:
        vals = col[m]
        a = [v for d, v in zip(DAYS, vals) if v is not None and d <= mid]
        b = [v for d, v in zip(DAYS, vals) if v is not None and d > mid]
        pct = (mean(b) - mean(a)) / mean(a) * 100
        assert abs(ms[m]["mean"] - mean(vals)) <= 0.005 + 1e-9, m
        assert ms[m]["total_days"] == 30 and ms[m]["days_with_data"] == sum(v is not None for v in vals)
        assert abs(ms[m]["trend_pct"] - pct) <= 0.005 + 1e-9, m
        assert ms[m]["trend_direction"] == ("improving" if pct > 5 else "declining" if pct < -5 else "stable")
    assert ms["readiness_score"]["days_with_data"] == 27 and ms["sleep_efficiency"]["min_val"] == 60.0

    # personal bests (earliest day on ties; long_sleep only for HRV / lowest HR)
    bests = {r["metric"]: (r["value"], r["day"]) for r in parts["personal_bests"].collect()}
    for m in ("readiness_score", "sleep_score", "steps"):
        best = max(v for v in col[m] if v is not None)
        assert bests[m] == (float(best), DAYS[col[m].index(best)])
    ls = [r for r in sleep if r[2] == "long_sleep"]
    hrv = max(r[11] for r in ls)
    low = min(r[12] for r in ls)
    assert bests["avg_hrv"] == (hrv, next(r[1] for r in ls if r[11] == hrv))
    assert bests["lowest_hr"] == (float(low), next(r[1] for r in ls if r[12] == low))

    # sleep summary over long_sleep nights
    sm = parts["sleep_summary"].first()
    assert sm["nights"] == 30
    assert abs(sm["avg_duration_hrs"] - mean([r[3] for r in ls]) / 3600) <= 0.005 + 1e-9
    assert abs(sm["deep_pct"] - mean([r[4] / r[3] * 100 for r in ls])) <= 0.005 + 1e-9
    assert abs(sm["awake_pct"] - mean([r[7] / r[8] * 100 for r in ls])) <= 0.005 + 1e-9

    # workouts: 15 sessions; cycling 4, running 5, strength_training 3, walking 3
    ws = {r["activity"]: r for r in parts["workout_summary"].collect()}
    assert {a: r["sessions"] for a, r in ws.items()} == {"cycling": 4, "running": 5, "strength_training": 3,
                                                         "walking": 3}
    assert all(r["total_count"] == 15 and r["total_calories"] == sum(x[3] for x in workouts) for r in ws.values())

    # alerts: thresholds first (table order), then declines (metric order)
    got = [(r["metric"], r["kind"]) for r in parts["areas_to_improve"].orderBy("alert_rank").collect()]
    targets = report.METRIC_THRESHOLDS
    exp = [(m, "threshold") for m in targets if mean(col[m]) < targets[m]]
    dmid = dt.date.fromordinal((DAYS[0].toordinal() + DAYS[-1].toordinal()) // 2)
    for m in report.WELLNESS_METRICS:
        if (m, "threshold") in exp:
            continue
        a = [v for d, v in zip(DAYS, col[m]) if v is not None and d <= dmid]
        b = [v for d, v in zip(DAYS, col[m]) if v is not None and d > dmid]
        if (mean(b) - mean(a)) / mean(a) * 100 < -10:
            exp.append((m, "decline"))
    assert got == exp

    # chart series: 30 points; down-sampled ticks every 4th plus the last
    ticks = [r["idx"] for r in series.downsample_nth(w, report.PERIOD).orderBy("idx").collect()]
    assert ticks == [0, 4, 8, 12, 16, 20, 24, 28, 29]
    target = series.series_target(w, report.PERIOD).where("met").count()
    assert target == sum(v >= 8000 for v in col["steps"])
