import datetime as dt


from daypulse.operators import quality

D1 = dt.date(2024, 1, 1)


def test_not_null_audit(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "id int, note string")
    got = {r["column"]: (r["rows"], r["failures"], r["passed"])
           for r in quality.not_null_audit(df, "m", ["id", "note"]).collect()}
    assert got == {"id": (3, 1, False), "note": (3, 2, False)}


def test_completeness_and_coverage(spark):
    df = spark.createDataFrame([(D1, 1), (D1, None), (dt.date(2024, 1, 3), 5)], "partition_date date, v int")
    c = quality.completeness(df, ["v"]).first()
    assert (c["total_rows"], c["non_null"], c["nulls"]) == (3, 2, 1)
    cov = quality.coverage(df).first()
    assert (cov["first_day"], cov["last_day"], cov["days"], cov["rows"]) == (D1, dt.date(2024, 1, 3), 2, 3)


def test_row_counts_union(spark):
    a = spark.range(3)
    b = spark.range(0)
    got = {r["table_name"]: r["row_count"] for r in quality.row_counts({"a": a, "b": b}).collect()}
    assert got == {"a": 3, "b": 0}


def test_feed_day_grid_and_coverage_note(spark):
    counts = spark.createDataFrame([("sleep", D1, 2)], "feed string, day date, rows long")
    feeds = spark.createDataFrame([("sleep",), ("activity",)], "feed string")
    existing = spark.createDataFrame([("sleep",)], "feed string")
    grid = quality.feed_day_grid(counts, feeds, D1, dt.date(2024, 1, 2), existing=existing)
    got = {(r["feed"], r["day"]): (r["rows"], r["status"]) for r in grid.collect()}
    assert got[("sleep", D1)] == (2, "ok")
    assert got[("sleep", dt.date(2024, 1, 2))] == (0, "empty")
    assert got[("activity", D1)] == (0, "missing")
    notes = {r["feed"]: r["note"] for r in quality.feed_coverage(grid).collect()}
    assert notes == {"sleep": "", "activity": "OK but no data"}


def test_reconcile(spark):
    raw = spark.createDataFrame([(D1, 1), (D1, 2), (D1, 3)], "partition_date date, id int")
    stg = spark.createDataFrame([(D1, 1), (D1, 2), (D1, 9)], "partition_date date, id int")
    r = quality.reconcile(raw, stg, ["id"]).first()
    assert (r["raw_rows"], r["staged_rows"], r["matched"], r["missing_in_staged"],
            r["extra_in_staged"]) == (3, 3, 2, 1, 1)


def test_trailing_daily_sum_window(spark):
    rows = [(dt.datetime(2024, 1, 23, 23), 1.0), (dt.datetime(2024, 1, 24, 1), 2.0),
            (dt.datetime(2024, 1, 30, 23), 3.0), (dt.datetime(2024, 1, 31, 0), 4.0)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, value double")
    got = {r["day"]: r["total"] for r in quality.trailing_daily_sum(df, "ts", "value", dt.date(2024, 1, 31)).collect()}
    assert got == {dt.date(2024, 1, 24): 2.0, dt.date(2024, 1, 30): 3.0}


def test_key_null_counts(spark):
    df = spark.createDataFrame([(1, None), (None, "a")], "id int, day string")
    r = quality.key_null_counts(df, ["id", "day"]).first()
    assert (r["rows"], r["id_nulls"], r["day_non_null"]) == (2, 1, 1)


def test_gap_audit_keeps_group_labels(spark):
    counts = spark.createDataFrame([("activity", D1, 0)], "feed string, day date, rows long")
    feeds = spark.createDataFrame([("activity", "PROBLEM"), ("heartrate", "CONTROL")], "feed string, grp string")
    grid = quality.feed_day_grid(counts, feeds, D1, dt.date(2024, 1, 4))
    assert grid.count() == 8 and set(grid.columns) >= {"feed", "grp", "day", "rows", "status"}
    assert {r["status"] for r in grid.collect()} == {"empty"}


def test_reconcile_checksum(spark):
    d2 = dt.date(2024, 1, 2)
    raw = spark.createDataFrame([(D1, 1), (D1, 2), (d2, 5)], "partition_date date, id int")
    same = spark.createDataFrame([(D1, 2), (D1, 1), (d2, 5)], "partition_date date, id int")
    other = spark.createDataFrame([(D1, 1), (D1, 3), (d2, 5)], "partition_date date, id int")
    a = {r["partition_date"]: r["equal"] for r in quality.reconcile(raw, same, ["id"], method="checksum").collect()}
    b = {r["partition_date"]: r["equal"] for r in quality.reconcile(raw, other, ["id"], method="checksum").collect()}
    assert a == {D1: True, d2: True}
    assert b == {D1: False, d2: True}


def test_row_count_check_on_catalog_tables(spark):
    spark.createDataFrame([], "x int").createOrReplaceTempView("dp_empty_t")
    spark.range(4).createOrReplaceTempView("dp_full_t")
    e = quality.row_count_check(spark, "dp_empty_t").first()
    f = quality.row_count_check(spark, "dp_full_t").first()
    m = quality.row_count_check(spark, "dp_missing_t").first()
    assert (e["exists"], e["severity"], e["row_count"]) == (True, "WARN", 0)
    assert (f["exists"], f["severity"], f["row_count"]) == (True, None, 4)
    assert (m["exists"], m["severity"], m["passed"]) == (False, "WARN", True)


def test_reconcile_tree_equals_counts(spark, monkeypatch):
    import datetime as dt
    import random

    rng = random.Random(2)
    days = [dt.date(2026, 1, i) for i in range(1, 9)] + [None]
    rows = [(d, rng.choice([None, rng.randrange(40), rng.randrange(4000)]), "x") for d in days for _ in range(120)]
    raw = spark.createDataFrame(rows, "partition_date date, id long, kind string")
    other = [r for r in rows if r[0] != days[2] and (r[0] in days[:2] or rng.random() < 0.95)]
    other += [(days[3], 9, "x"), (days[3], None, "x"), (dt.date(2026, 2, 1), 5, "x")]
    for staged in (spark.createDataFrame(other, raw.schema), raw.repartition(3), raw.limit(0)):
        for left, right in ((raw, staged), (staged, raw)):
            for ranges in (quality.RANGES, 1, 7):
                monkeypatch.setattr(quality, "RANGES", ranges)
                got = quality.reconcile(left, right, ["id", "kind"], method="tree")
                want = quality.reconcile(left, right, ["id", "kind"])
                assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # ids are read from unequal ranges only
    sides = []
    plain = quality._sides
    monkeypatch.setattr(quality, "_sides", lambda *a: sides.append(a) or plain(*a))
    quality.reconcile(raw, raw.repartition(3), ["id"], method="tree").count()
    assert len(sides) == 1


def test_counts_observed_on_the_write(spark, tmp_root):
    df = spark.createDataFrame([(1, None, "x"), (2, 5, None), (None, 6, "y")], "a long, `b c` long, d string")
    metrics = f"{tmp_root}/metrics"
    assert quality.write_audited(df, f"{tmp_root}/t", "m", metrics, "one", partition_by=["a"]) == 3
    assert quality.write_audited(df.limit(2), f"{tmp_root}/u", "m", metrics, "two") == 2
    assert quality.write_audited(df, f"{tmp_root}/u", "m", metrics, "two") == 3  # again: replaces
    assert quality.write_audited(df.limit(0), f"{tmp_root}/v", "empty", metrics, "one") == 0
    assert spark.read.parquet(f"{tmp_root}/t").count() == 3 and spark.read.parquet(f"{tmp_root}/v").columns == df.columns
    got = quality.read_metrics(spark, metrics)
    assert sorted(map(tuple, got.where("model = 'm'").collect())) == sorted(
        (x, "m", c, 3, 2) for x in ("one", "two") for c in ("a", "b c", "d"))
    audit = quality.not_null_from_metrics(got, {"m": ["a", "d"], "empty": ["a"]})
    assert sorted(map(tuple, audit.collect())) == [("empty", "a", 0, 0, True), ("m", "a", 6, 2, False), ("m", "d", 6, 2, False)]
