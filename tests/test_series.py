import datetime as dt

from pyspark.sql import functions as F

from daypulse.operators import series

START = dt.date(2025, 1, 1)


def days(n):
    return [START + dt.timedelta(days=i) for i in range(n)]


def test_rolling_mean_three_rows(spark):
    raw = [42.0, 38.0, 45.0, 35.0, 65.0]
    rows = [(1, f"s{i}", d, "long_sleep", v) for i, (d, v) in enumerate(zip(days(5), raw))]
    rows.append((1, "n", START, "nap", 99.0))
    df = spark.createDataFrame(rows, "g int, id string, day date, sleep_type string, avg_hrv double")
    out = series.series_rolling(df, ["g"]).orderBy("idx").collect()
    assert [round(r["rolling_mean"], 4) for r in out] == [42.0, 40.0, 41.6667, 39.3333, 48.3333]
    assert [r["idx"] for r in out] == [0, 1, 2, 3, 4]


def test_rolling_needs_two_points(spark):
    df = spark.createDataFrame([(1, "a", START, "long_sleep", 50.0), (1, "b", START, "long_sleep", None)],
                               "g int, id string, day date, sleep_type string, avg_hrv double")
    assert series.series_rolling(df, ["g"]).count() == 0


def test_downsample_thirty_points(spark):
    df = spark.createDataFrame([(1, d) for d in days(30)], "g int, day date")
    got = [r["idx"] for r in series.downsample_nth(df, ["g"]).orderBy("idx").collect()]
    assert got == [0, 4, 8, 12, 16, 20, 24, 28, 29]
    small = spark.createDataFrame([(1, d) for d in days(10)], "g int, day date")
    assert series.downsample_nth(small, ["g"]).count() == 10


def scores(spark, rs, ss):
    rows = [(1, d, r, s) for d, r, s in zip(days(len(rs)), rs, ss)]
    return spark.createDataFrame(rows, "g int, day date, readiness_score double, sleep_score double")


def test_scores_gates_and_gaps(spark):
    assert series.series_scores(scores(spark, [70.0], [80.0]), ["g"]).count() == 0
    assert series.series_scores(scores(spark, [None, None], [None, None]), ["g"]).count() == 0
    out = series.series_scores(scores(spark, [70.0, None, 72.0], [None, 81.0, 82.0]), ["g"])
    got = sorted((r["idx"], r["line"], r["value"]) for r in out.collect())
    assert got == [(0, "Readiness", 70.0), (1, "Sleep", 81.0), (2, "Readiness", 72.0), (2, "Sleep", 82.0)]
    assert out.where("idx = 0").first()["label"] == "Wed 1/1"


def test_target_series(spark):
    df = spark.createDataFrame([(1, d, s) for d, s in zip(days(3), [9000, None, 7000])],
                               "g int, day date, steps int")
    got = [(r["value"], r["met"], r["alpha"]) for r in series.series_target(df, ["g"]).orderBy("idx").collect()]
    assert got == [(9000.0, True, 1.0), (0.0, False, 0.6), (7000.0, False, 0.6)]
    none = spark.createDataFrame([(1, d, None) for d in days(3)], "g int, day date, steps int")
    assert series.series_target(none, ["g"]).count() == 0


def test_stacked_bottoms(spark):
    df = spark.createDataFrame([(1, "a", START, "long_sleep", 3600, 7200, None, 1800),
                                (1, "b", START, "nap", 1, 1, 1, 1)],
                               "g int, id string, day date, sleep_type string, deep_sleep_duration int, "
                               "light_sleep_duration int, rem_sleep_duration int, awake_time int")
    r = series.series_stacked(df, ["g"]).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["deep_h"], r["light_h"], r["rem_h"], r["awake_h"]) == (1.0, 2.0, 0.0, 0.5)
    assert (r["light_bottom"], r["rem_bottom"], r["awake_bottom"]) == (1.0, 3.0, 3.0)


def test_chart_counts(spark):
    w = scores(spark, [70.0, 71.0], [80.0, 81.0]).withColumn("steps", F.lit(None).cast("int"))
    sleep = spark.createDataFrame([(1, "a", START, "long_sleep", 40.0, 1, 1, 1, 1)],
                                  "g int, id string, day date, sleep_type string, avg_hrv double, "
                                  "deep_sleep_duration int, light_sleep_duration int, "
                                  "rem_sleep_duration int, awake_time int")
    c = series.chart_counts(series.chart_series(w, sleep, ["g"]), ["g"]).first()
    assert c["charts"] == 2  # scores + stages; steps all null, one HRV point


def test_daily_positions_equal_window_positions(spark):
    import random
    rnd = random.Random(3)
    rows = [(g, f"id{i:03d}", START + dt.timedelta(days=rnd.randrange(6)), "long_sleep",
             None if rnd.random() < 0.1 else float(rnd.randrange(20, 90)))
            for g in (1, 2) for i in range(40)]
    rows.append((None, "idz", START, "long_sleep", 50.0))
    df = spark.createDataFrame(rows, "g int, id string, day date, sleep_type string, avg_hrv double")
    a = series.series_rolling(df, ["g"], method="daily")
    b = series.series_rolling(df, ["g"], method="window")
    key = lambda r: (r["g"] is not None, r["g"] or 0, r["idx"])
    ra, rb = sorted(a.collect(), key=key), sorted(b.collect(), key=key)
    assert len(ra) == len(rb) > 60
    for x, y in zip(ra, rb):
        assert (x["g"], x["idx"], x["id"], x["day"], x["value"]) == (y["g"], y["idx"], y["id"], y["day"], y["value"])
        assert abs(x["rolling_mean"] - y["rolling_mean"]) < 1e-9
    pa = series.positions(df, ["g"], tiebreak=["id"]).select("g", "id", "idx", "n")
    pb = series.positions(df, ["g"], tiebreak=["id"], method="window").select("g", "id", "idx", "n")
    assert sorted(map(str, pa.collect())) == sorted(map(str, pb.collect()))


def test_chart_presence_equals_series_counts(spark):
    import random
    rnd = random.Random(5)
    w_rows = [(g, START + dt.timedelta(days=i), rnd.choice([None, 70.0]), rnd.choice([None, 80.0]),
               rnd.choice([None, 9000]))
              for g in range(6) for i in range(rnd.randrange(1, 4))]
    w = spark.createDataFrame(w_rows, "g int, day date, readiness_score double, sleep_score double, steps int")
    s_rows = [(g, f"i{g}{i}", START + dt.timedelta(days=i), rnd.choice(["long_sleep", "nap"]),
               rnd.choice([None, 40.0]), 1, 1, 1, 1)
              for g in range(3, 9) for i in range(rnd.randrange(0, 4))]
    s = spark.createDataFrame(s_rows, "g int, id string, day date, sleep_type string, avg_hrv double, "
                                      "deep_sleep_duration int, light_sleep_duration int, "
                                      "rem_sleep_duration int, awake_time int")
    a = {r["g"]: r["charts"] for r in series.chart_counts(series.chart_series(w, s, ["g"]), ["g"]).collect()}
    b = {r["g"]: r["charts"] for r in series.chart_presence(w, s, ["g"]).collect()}
    assert a == b


def test_range_positions_split_a_hot_day(spark):
    """One entity-day holding most rows: range positions equal the window ones."""
    import random
    rnd = random.Random(9)
    rows = [(1, f"h{i:04d}", START, float(rnd.randrange(100))) for i in range(600)]      # the hot day
    rows += [(1, f"o{i:03d}", START + dt.timedelta(days=1 + i % 3), 1.0) for i in range(30)]
    rows += [(2, f"p{i:03d}", START + dt.timedelta(days=i % 4), None) for i in range(20)]
    rows += [(None, "z", START, 5.0)]
    df = spark.createDataFrame(rows, "g int, id string, day date, v double")
    a = series.positions(df, ["g"], tiebreak=["id"], method="range", group_counts=["v"])
    b = series.positions(df, ["g"], tiebreak=["id"], method="window", group_counts=["v"])
    cols = ["g", "id", "idx", "n", "_nn_v"]
    assert sorted(map(str, a.select(*cols).collect())) == sorted(map(str, b.select(*cols).collect()))


def test_rolling_with_range_positions(spark):
    rows = [(1, f"id{i:03d}", START + dt.timedelta(days=i // 50), "long_sleep", float(i % 17)) for i in range(200)]
    df = spark.createDataFrame(rows, "g int, id string, day date, sleep_type string, avg_hrv double")
    a = {r["idx"]: r["rolling_mean"] for r in series.series_rolling(df, ["g"], method="range").collect()}
    b = {r["idx"]: r["rolling_mean"] for r in series.series_rolling(df, ["g"], method="window").collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in a)
