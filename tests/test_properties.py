"""Property tests (hypothesis): join forms agree, J2 has one row per key and day,
landing twice equals landing once."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daypulse.operators import marts

DAYS = [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(4)]
LEG_COLS = {"ready": "readiness_score", "sleep": "sleep_score", "act": "steps", "spo2": "avg_spo2_pct",
            "stress": "stress_high", "res": "sleep_recovery_score"}

presence = st.fixed_dictionaries({
    leg: st.lists(st.tuples(st.sampled_from(["u1", "u2", None]), st.sampled_from(DAYS)),
                  max_size=6, unique=True)
    for leg in marts.LEGS})

settings.register_profile("spark", max_examples=12, deadline=None,
                          suppress_health_check=[HealthCheck.function_scoped_fixture])
settings.load_profile("spark")


def build(spark, spec):
    out = {}
    for leg, rows in spec.items():
        data = [(u, d, float(i)) for i, (u, d) in enumerate(rows)]
        out[leg] = spark.createDataFrame(data, f"user_id string, day date, {LEG_COLS[leg]} double")
    return out


def rows(df):
    return sorted(map(str, df.collect()))


@given(presence)
def test_chain_forms_agree(spark, spec):
    legs = build(spark, spec)
    a = marts.full_outer_chain(legs, ["user_id"])
    b = marts.full_outer_chain(legs, ["user_id"], method="grouped")
    assert rows(a) == rows(b)


@given(presence)
def test_shared_key_forms_agree_and_one_row_per_key(spark, spec):
    legs = build(spark, spec)
    a = marts.full_outer_on_key(legs, ["user_id"])
    b = marts.full_outer_on_key(legs, ["user_id"], method="join").select(*a.columns)
    assert rows(a) == rows(b)
    keyed = {(u, d) for r in spec.values() for (u, d) in r if u is not None}
    assert a.where("user_id is not null").count() == len(keyed)


START = dt.date(2025, 3, 3)
value = st.one_of(st.none(), st.integers(min_value=0, max_value=12000).map(lambda c: c / 100))
frame = st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 13), value, value),
                 min_size=1, max_size=25)


def py_report(rows, start, end):
    """Plain-Python report formulas for one group: summary and alerts per metric."""
    from datetime import date as D
    days = [d for d, _, _ in rows]
    out = {}
    pmid = D.fromordinal((start.toordinal() + end.toordinal()) // 2)
    dmid = D.fromordinal((min(days).toordinal() + max(days).toordinal()) // 2)
    for m, col in (("readiness_score", 1), ("steps", 2)):
        vals = [(d, r[col]) for r in rows for d in [r[0]] if r[col] is not None]
        if not vals:
            continue

        def split(mid):
            a = [v for d, v in vals if d <= mid]
            b = [v for d, v in vals if d > mid]
            if not a or not b:
                return None
            m1, m2 = sum(a) / len(a), sum(b) / len(b)
            return None if m1 == 0 else (m2 - m1) / m1 * 100
        mean = sum(v for _, v in vals) / len(vals)
        p = split(pmid)
        pct = 0.0 if p is None else p
        trend = "improving" if pct > 5 else "declining" if pct < -5 else "stable"
        dp = split(dmid)
        alert = None
        if m == "readiness_score" and mean < 70.0:
            alert = "Below target of 70.0"
        elif dp is not None and dp < -10:
            alert = f"Declined {abs(round(dp, 1))}% over period"
        out[m] = (mean, trend, pct, len(vals), len(rows), alert, dp)
    return out


@settings(max_examples=8)
@given(frame)
def test_report_matches_plain_python(spark, data):
    from pyspark.sql import functions as F
    from daypulse.operators import report
    rows = [(g, START + dt.timedelta(days=o), r, s) for g, o, r, s in data]
    df = spark.createDataFrame(rows, "g string, day date, readiness_score double, steps double")
    end = START + dt.timedelta(days=13)
    df = df.withColumn("start_date", F.lit(START)).withColumn("end_date", F.lit(end))
    by = ["g", "start_date", "end_date"]
    stats = report.metric_stats(df, by, metrics=("readiness_score", "steps"))
    summ = {(r["g"], r["metric"]): r for r in report.summarize(stats, by).collect()}
    alerts = {(r["g"], r["metric"]): r["reason"] for r in report.alerts_from_stats(
        stats, by, metrics=("readiness_score", "steps")).collect()}
    for g in ("a", "b"):
        grp = [(d, r, s) for gg, d, r, s in rows if gg == g]
        if not grp:
            continue
        exp = py_report(grp, START, end)
        assert {m for (gg, m) in summ if gg == g} == set(exp)
        for m, (mean, trend, pct, n, total, alert, dp) in exp.items():
            got = summ[(g, m)]
            assert abs(got["mean"] - mean) <= 0.005 + 1e-9
            assert got["days_with_data"] == n and got["total_days"] == total
            assert abs(got["trend_pct"] - pct) <= 0.005 + 1e-6
            if abs(abs(pct) - 5) > 1e-6:
                assert got["trend_direction"] == trend
            if dp is None or abs(dp + 10) > 1e-6:
                if alert is None or alert.startswith("Below"):
                    assert alerts.get((g, m)) == alert
                else:
                    assert alerts.get((g, m), "").startswith("Declined ")


@settings(max_examples=10)
@given(st.lists(st.integers(min_value=1, max_value=40), min_size=1, max_size=4))
def test_downsample_rule(spark, sizes):
    """Ticks: all points up to 10; beyond, every max(n // 7, 2)-th index plus the last."""
    from daypulse.operators import series
    rows = [(g, dt.date(2025, 1, 1) + dt.timedelta(days=i)) for g, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, day date")
    got = {}
    for r in series.downsample_nth(df, ["g"]).collect():
        got.setdefault(r["g"], []).append(r["idx"])
    for g, n in enumerate(sizes):
        if n > 10:
            step = max(n // 7, 2)
            exp = list(range(0, n, step))
            if n - 1 not in exp:
                exp.append(n - 1)
        else:
            exp = list(range(n))
        assert sorted(got[g]) == exp


@settings(max_examples=10)
@given(st.lists(st.dates(min_value=dt.date(1999, 1, 1), max_value=dt.date(2031, 12, 31)), min_size=1, max_size=20))
def test_periods_match_calendar(spark, days):
    from daypulse.operators import report
    df = spark.createDataFrame([(d,) for d in days], "day date")
    for r in report.assign_periods(df).collect():
        d = r["day"]
        if r["period_type"] == "weekly":
            monday = d - dt.timedelta(days=d.weekday())
            assert (r["start_date"], r["end_date"]) == (monday, monday + dt.timedelta(days=6))
        else:
            nxt = (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1)
            assert (r["start_date"], r["end_date"]) == (d.replace(day=1), nxt - dt.timedelta(days=1))
