"""Reports from daily states equal reports from rows, and an update touches only its days and periods."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daypulse.operators import report, states
from daypulse.session import delete_path, list_folder

SPEC = states.Spec(keys=("u",), fixed=("avg_hrv", "avg_hr"))
BY = list(SPEC.by)
FIRST = dt.date(2024, 2, 26)  # a Monday; the days cover two months and five weeks


def rows_of(spark, seed, n_days=33, empty=()):
    rng = random.Random(seed)
    well, sleep, work = [], [], []
    num = lambda lo, hi: rng.choice([None, float(rng.randrange(lo, hi))])
    for u in "abc":
        for i in range(n_days):
            day = FIRST + dt.timedelta(days=i)
            if day in empty or rng.random() < 0.2:
                continue
            for _ in range(rng.choice([1, 1, 2])):
                well.append((u, day, *[num(10, 99) for _ in report.WELLNESS_METRICS]))
            for _ in range(rng.choice([0, 1, 2])):
                sleep.append((u, day, rng.choice(["long_sleep", "late_nap"]), *[rng.randrange(0, 9000) for _ in range(6)],
                              rng.randrange(60, 100), num(30, 90), num(40, 70), rng.randrange(35, 60)))
            for _ in range(rng.choice([0, 1, 3])):
                work.append((u, day, rng.choice(["run", "walk", None]), num(50, 400)))
    return {
        "wellness": spark.createDataFrame(well, "u string, day date, " + ", ".join(f"{m} double" for m in report.WELLNESS_METRICS)),
        "sleep": spark.createDataFrame(sleep, "u string, day date, sleep_type string, total_sleep_duration long, "
                                       "deep_sleep_duration long, light_sleep_duration long, rem_sleep_duration long, awake_time long, "
                                       "time_in_bed long, efficiency int, avg_hrv double, avg_hr double, lowest_hr int"),
        "workouts": spark.createDataFrame(work, "u string, day date, workout_activity string, workout_calories double")}


def whole_report(sources):
    per = {k: report.assign_periods(v) for k, v in sources.items()}
    return bag(report.report_long(report.build_report(per["wellness"], per["sleep"], per["workouts"], BY, fixed=SPEC.fixed), BY))


def state_report(spark, root):
    return bag(report.report_long(states.report_from_states(spark, root, SPEC), BY))


def bag(df):
    return sorted(map(str, df.collect()))


def days_in(*sources):
    return sorted({r.day for s in sources for df in s.values() for r in df.select("day").distinct().collect()})


def test_late_days_and_days_that_go(spark, tmp_root):
    before, after = rows_of(spark, 1), rows_of(spark, 1)
    late = [FIRST + dt.timedelta(days=i) for i in (3, 4, 20)]
    gone = FIRST + dt.timedelta(days=11)
    cut = {k: v.where(~F.col("day").isin(late)) for k, v in before.items()}
    states.update_days(spark, tmp_root, cut, days_in(before), SPEC)
    assert state_report(spark, tmp_root) == whole_report(cut)
    after = {k: v.where(F.col("day") != F.lit(gone)) for k, v in after.items()}
    only = {k: v.where(F.col("day").isin(late)) for k, v in after.items()}
    done = states.update_days(spark, tmp_root, only, [*late, gone], SPEC)
    assert done["days"] == 4 and state_report(spark, tmp_root) == whole_report(after)
    states.update_days(spark, tmp_root, only, [*late, gone], SPEC)  # again: no change
    assert state_report(spark, tmp_root) == whole_report(after)


def test_untouched_days_and_periods_are_not_read_or_written(spark, tmp_root):
    rows = rows_of(spark, 2)
    states.update_days(spark, tmp_root, rows, days_in(rows), SPEC)
    day = dt.date(2024, 3, 27)  # its week is 03-25 .. 03-31, its month March: February's days are not needed
    for name in states.STATES:
        for x in list_folder(spark, states.state_path(tmp_root, name)):
            if x.startswith("day=2024-02"):
                delete_path(spark, f"{states.state_path(tmp_root, name)}/{x}")
    marks = {k: list_folder(spark, states.rollup_path(tmp_root, k) + "/period_type=weekly/start_date=2024-03-04")
             for k in states.ROLLUPS}
    want = state_report(spark, tmp_root)
    done = states.update_days(spark, tmp_root, {k: v.where(F.col("day") == F.lit(day)) for k, v in rows.items()}, [day], SPEC)
    assert done == {"days": 1, "periods": 2, "days_read": 31}
    assert state_report(spark, tmp_root) == want
    assert marks == {k: list_folder(spark, states.rollup_path(tmp_root, k) + "/period_type=weekly/start_date=2024-03-04")
                     for k in states.ROLLUPS}


def test_tables_without_rows(spark, tmp_root):
    rows = rows_of(spark, 3)
    rows["workouts"] = rows["workouts"].limit(0)
    states.update_days(spark, tmp_root, rows, days_in(rows), SPEC)
    assert state_report(spark, tmp_root) == whole_report(rows)
    assert states.update_days(spark, tmp_root, rows, [], SPEC)["periods"] == 0


def test_failed_update_keeps_the_report(spark, tmp_root):
    rows = rows_of(spark, 4, n_days=9)
    states.update_days(spark, tmp_root, rows, days_in(rows), SPEC)
    want = state_report(spark, tmp_root)
    bad = rows | {"wellness": rows["wellness"].withColumn("steps", F.raise_error(F.lit("broken")).cast("double"))}
    with pytest.raises(Exception, match="broken"):
        states.update_days(spark, tmp_root, bad, days_in(rows), SPEC)
    assert state_report(spark, tmp_root) == want
