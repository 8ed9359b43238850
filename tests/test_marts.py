import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daypulse.operators import marts

d1, d2, d3, d4 = (dt.date(2026, 1, i) for i in (1, 2, 3, 4))


def legs(spark, keyed=False):
    """FIXTURES §3: ready d1,d4; sleep d1,d2; act d1,d2; spo2 d1-d3; stress d1,d3; res d3."""
    def mk(col, days, val):
        rows = [(("u",) if keyed else ()) + (d, float(val + i)) for i, d in enumerate(days)]
        schema = ("user_id string, " if keyed else "") + f"day date, {col} double"
        return spark.createDataFrame(rows, schema)
    return {
        "ready": mk("readiness_score", [d1, d4], 70),
        "sleep": mk("sleep_score", [d1, d2], 80),
        "act": mk("steps", [d1, d2], 5000),
        "spo2": mk("avg_spo2_pct", [d1, d2, d3], 97),
        "stress": mk("stress_high", [d1, d3], 100),
        "res": mk("sleep_recovery_score", [d3], 50),
    }


def per_day(df):
    out = {}
    for r in df.collect():
        out[r["day"]] = out.get(r["day"], 0) + 1
    return out


def test_chain_faithful_rows(spark):
    j1 = marts.full_outer_chain(legs(spark))
    assert per_day(j1) == {d1: 1, d2: 2, d3: 3, d4: 1}
    d2_rows = [r.asDict() for r in j1.where(F.col("day") == d2).collect()]
    # sleep+spo2 and act+spo2: the spo2 row repeats
    assert sorted((r["sleep_score"] is not None, r["steps"] is not None) for r in d2_rows) == \
        [(False, True), (True, False)]
    assert all(r["avg_spo2_pct"] == 98.0 for r in d2_rows)


def test_shared_key_one_row_per_day(spark):
    j2 = marts.full_outer_on_key(legs(spark))
    assert per_day(j2) == {d1: 1, d2: 1, d3: 1, d4: 1}
    j2j = marts.full_outer_on_key(legs(spark), method="join")
    assert sorted(map(tuple, j2.collect())) == sorted(map(tuple, j2j.select(*j2.columns).collect()))


def test_grouped_chain_equals_join_chain(spark):
    for keyed in (False, True):
        keys = ["user_id"] if keyed else []
        a = marts.full_outer_chain(legs(spark, keyed), keys)
        b = marts.full_outer_chain(legs(spark, keyed), keys, method="grouped")
        assert a.columns == b.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_null_key_rows_stay_alone(spark):
    lg = legs(spark, keyed=True)
    extra = spark.createDataFrame([(None, d1, 1.0)], "user_id string, day date, readiness_score double")
    lg["ready"] = lg["ready"].unionByName(extra)
    extra_s = spark.createDataFrame([(None, d1, 2.0)], "user_id string, day date, sleep_score double")
    lg["sleep"] = lg["sleep"].unionByName(extra_s)
    a = marts.full_outer_chain(lg, ["user_id"])
    b = marts.full_outer_chain(lg, ["user_id"], method="grouped")
    assert a.count() == b.count() == 9
    c = marts.full_outer_on_key(lg, ["user_id"])
    d = marts.full_outer_on_key(lg, ["user_id"], method="join")
    assert c.count() == d.count() == 6


def test_left_detail_keeps_every_period(spark):
    sp = spark.createDataFrame([("a", d1, "long_sleep"), ("b", d2, "nap")],
                               "id string, day date, sleep_type string")
    st = spark.createDataFrame([(d1, "earlier", -60, 60), (d1, "later", -30, 30)],
                               "day date, sleep_recommendation string, "
                               "optimal_bedtime_start_offset int, optimal_bedtime_end_offset int")
    out = marts.sleep_detail(sp, st, period_cols=("id", "day", "sleep_type"))
    assert out.count() == 3
    assert out.where("id = 'b'").first()["sleep_recommendation"] is None


def test_wellness_legs_renames(spark):
    staged = {name: spark.createDataFrame([(d1,) + tuple(range(len(cols)))],
                                          "day date, " + ", ".join(f"{s} int" for s, _ in cols))
              for leg, cols in marts.WELLNESS_COLUMNS.items()
              for name in [marts.STAGED_FOR_LEG[leg]]}
    out = marts.full_outer_on_key(marts.wellness_legs(staged))
    assert "sleep_efficiency" in out.columns and "resilience_stress_score" in out.columns
    assert out.count() == 1


# ---- legs with several rows per key, one shuffle ---------------------------------

def _many_legs(spark, seed, hot=0):
    """Six legs with 0 to 3 rows a key, repeated rows, NULL keys and days; ``hot`` more rows in one leg."""
    rng = random.Random(seed)
    out = {}
    for n, leg in enumerate(marts.LEGS):
        cols = [c for _, c in marts.WELLNESS_COLUMNS[leg]]
        rows = []
        for u in (1, 2, 3, None):
            for d in (dt.date(2024, 1, 1), dt.date(2024, 1, 2), None):
                for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                    rows.append((u, d, *[str(rng.randrange(5)) if rng.random() < 0.9 else None for _ in cols]))
        if leg == marts.LEGS[seed % 6]:
            rows += [(2, dt.date(2024, 1, 1), *[str(i % 7) for _ in cols]) for i in range(hot)]
        out[leg] = spark.createDataFrame(rows, "user_id long, day date, " + ", ".join(f"{c} string" for c in cols))
    return out


def _bag(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("seed,split,hot", [(0, 4096, 0), (1, 1, 0), (2, 2, 9), (3, 3, 20), (4, 2, 9), (5, 1, 5), (6, 2, 12)])
def test_product_form_equals_joins(spark, monkeypatch, seed, split, hot):
    monkeypatch.setattr(marts, "SPLIT", split)
    monkeypatch.setattr(marts, "FEW_SPLIT", 1 if seed % 2 else 10_000)
    legs = _many_legs(spark, seed, hot)
    assert _bag(marts.full_outer_chain(legs, ["user_id"], method="product")) == _bag(marts.full_outer_chain(legs, ["user_id"]))
    assert _bag(marts.full_outer_on_key(legs, ["user_id"], method="product")) == _bag(
        marts.full_outer_on_key(legs, ["user_id"], method="join"))


def test_product_form_shuffles_once_and_splits_a_hot_key(spark, monkeypatch):
    monkeypatch.setattr(marts, "SPLIT", 50)
    legs = _many_legs(spark, 1, 400)
    got = marts.full_outer_chain(legs, ["user_id"], method="product")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan
    parts = marts._gathered(legs, ["user_id"], "day").where("user_id = 2 and day = date'2024-01-01'")
    sizes = [r.n for r in parts.selectExpr("size(_sleep) as n").collect()]
    assert len(sizes) == 9 and sum(sizes) >= 400 and max(sizes) < 150
