import datetime as dt

import pytest
from pyspark.sql import functions as F

from daypulse.operators.quality import row_count_check
from daypulse.plans import queries as plans
from daypulse.sources.land import backfill, latest_by, read_raw, to_raw, upsert_day

D1, D2 = dt.date(2026, 1, 15), dt.date(2026, 1, 16)


def batch(spark, n, tag="a"):
    df = spark.createDataFrame([(f'{{"id": "{tag}{i}", "v": {i}}}',) for i in range(n)], "js string")
    return to_raw(df, "js")


def count_day(spark, root, day):
    return read_raw(spark, root, "sleep").where(F.col("partition_date") == F.lit(day)).count()


def test_insert_counts(spark, tmp_root):
    assert upsert_day(spark, tmp_root, "sleep", batch(spark, 1), D1) == 1
    assert upsert_day(spark, tmp_root, "activity", batch(spark, 5), D1) == 5
    assert read_raw(spark, tmp_root, "activity").count() == 5


def test_empty_and_none_create_table(spark, tmp_root):
    assert upsert_day(spark, tmp_root, "sleep", None, D1) == 0
    assert upsert_day(spark, tmp_root, "readiness", batch(spark, 0), D1) == 0
    assert read_raw(spark, tmp_root, "sleep").count() == 0
    assert read_raw(spark, tmp_root, "readiness").count() == 0


def test_same_day_replaces_and_days_coexist(spark, tmp_root):
    upsert_day(spark, tmp_root, "sleep", batch(spark, 3), D1)
    upsert_day(spark, tmp_root, "sleep", batch(spark, 2, "b"), D2)
    upsert_day(spark, tmp_root, "sleep", batch(spark, 1, "c"), D1)
    assert count_day(spark, tmp_root, D1) == 1
    assert count_day(spark, tmp_root, D2) == 2
    ids = {r["i"] for r in read_raw(spark, tmp_root, "sleep")
           .select(F.try_variant_get("raw_data", "$.id", "string").alias("i")).collect()}
    assert ids == {"c0", "b0", "b1"}


def test_three_reruns_one_row(spark, tmp_root):
    for _ in range(3):
        upsert_day(spark, tmp_root, "sleep", batch(spark, 1), D1)
    assert read_raw(spark, tmp_root, "sleep").count() == 1
    assert read_raw(spark, tmp_root, "sleep").first()["partition_date"] == D1


def test_empty_batch_clears_the_day(spark, tmp_root):
    upsert_day(spark, tmp_root, "sleep", batch(spark, 4), D1)
    upsert_day(spark, tmp_root, "sleep", batch(spark, 2), D2)
    assert upsert_day(spark, tmp_root, "sleep", None, D1) == 0
    assert count_day(spark, tmp_root, D1) == 0 and count_day(spark, tmp_root, D2) == 2


def test_unknown_table_and_bad_day_rejected(spark, tmp_root):
    with pytest.raises(ValueError):
        upsert_day(spark, tmp_root, "users", batch(spark, 1), D1)
    with pytest.raises(ValueError):
        upsert_day(spark, tmp_root, "sleep; DROP TABLE x", batch(spark, 1), D1)
    with pytest.raises(ValueError):
        upsert_day(spark, tmp_root, "sleep", batch(spark, 1), "2026-01-15")


def test_backfill_writes_and_clears(spark, tmp_root):
    upsert_day(spark, tmp_root, "sleep", batch(spark, 3, "old"), D2)
    df = batch(spark, 4).withColumn("partition_date", F.lit(D1))
    m = backfill(spark, tmp_root, "sleep", df, [D1, D2])
    assert m == {"rows": 4, "days_written": 1, "days_cleared": 1}
    assert count_day(spark, tmp_root, D1) == 4 and count_day(spark, tmp_root, D2) == 0
    # idempotent: twice = once
    backfill(spark, tmp_root, "sleep", df, [D1, D2])
    assert read_raw(spark, tmp_root, "sleep").count() == 4


def test_latest_by(spark):
    df = spark.createDataFrame([("u", 1, "a"), ("u", 3, "b"), ("u", 2, "c"), ("v", 1, "d")],
                               "k string, updated_at int, payload string")
    out = {r["k"]: r["payload"] for r in latest_by(df, ["k"], ["updated_at"]).collect()}
    assert out == {"u": "b", "v": "d"}


def test_row_count_check_outcomes(spark, tmp_root):
    missing = row_count_check(spark, "sleep", f"{tmp_root}/nothing").first()
    assert (missing["exists"], missing["severity"], missing["passed"], missing["row_count"]) == \
        (False, "WARN", True, 0)
    upsert_day(spark, tmp_root, "sleep", None, D1)
    empty = row_count_check(spark, "sleep", f"{tmp_root}/sleep").first()
    assert (empty["exists"], empty["severity"], empty["passed"]) == (True, "WARN", True)
    upsert_day(spark, tmp_root, "activity", batch(spark, 1), D1)
    ok = row_count_check(spark, "activity", f"{tmp_root}/activity").first()
    assert (ok["severity"], ok["passed"], ok["row_count"]) == (None, True, 1)


def test_stream_rebuilds_touched_days_from_all_files(spark, tmp_root):
    from daypulse.streaming.landing import start_landing
    landing, root, ck = f"{tmp_root}/landing", f"{tmp_root}/raw", f"{tmp_root}/ck"

    def drop(tag, day, n):
        rows = [(f'{{"id": "{tag}{i}"}}', day) for i in range(n)]
        (spark.createDataFrame(rows, "value string, partition_date date").write.mode("append")
         .partitionBy("partition_date").text(landing))

    drop("a", D1, 2)
    start_landing(spark, landing, root, "sleep", ck).awaitTermination()
    drop("b", D1, 3)
    drop("c", D2, 1)
    start_landing(spark, landing, root, "sleep", ck).awaitTermination()
    assert count_streamed(spark, root, D1) == 5 and count_streamed(spark, root, D2) == 1
    # a replay with no new files changes nothing
    start_landing(spark, landing, root, "sleep", ck).awaitTermination()
    assert read_raw(spark, root, "sleep").count() == 6


def test_load_feed_day_from_envelope_files(spark, tmp_root):
    from daypulse.sources.land import load_feed_day
    import os
    src = f"{tmp_root}/pages"
    os.makedirs(src)
    with open(f"{src}/p1.json", "w") as fh:
        fh.write('{"data": [{"day": "2026-01-15", "score": 80}, {"day": "2026-01-15", "score": 81}]}\n')
        fh.write('{"next_token": null}\n')
    assert load_feed_day(spark, tmp_root, "readiness", src, D1) == 2
    from daypulse.operators.stage import stage
    got = sorted(r["readiness_score"] for r in stage(read_raw(spark, tmp_root, "readiness"), "readiness").collect())
    assert got == [80, 81]


def test_csv_lower_and_materialize(spark, tmp_root):
    from daypulse.sources.land import lower_columns, materialize, read_csv
    with open(f"{tmp_root}/w.csv", "w") as fh:
        fh.write("DAY,Steps\n2025-01-01,5000\n2025-01-02,\n")
    df = lower_columns(read_csv(spark, f"{tmp_root}/w.csv", "DAY date, Steps long"))
    assert df.columns == ["day", "steps"]
    back = materialize(df, f"{tmp_root}/mart")
    assert sorted((r["day"], r["steps"]) for r in back.collect()) == \
        [(dt.date(2025, 1, 1), 5000), (dt.date(2025, 1, 2), None)]


def test_stream_many_micro_batches_one_day(spark, tmp_root):
    from daypulse.streaming.landing import start_landing
    landing, root, ck = f"{tmp_root}/landing", f"{tmp_root}/raw", f"{tmp_root}/ck"
    for tag in "abc":
        rows = [(f'{{"id": "{tag}{i}"}}', D1) for i in range(2)]
        (spark.createDataFrame(rows, "value string, partition_date date").coalesce(1).write.mode("append")
         .partitionBy("partition_date").text(landing))
    q = start_landing(spark, landing, root, "sleep", ck, max_files=1)
    q.awaitTermination()
    assert len(q.recentProgress) >= 3  # one file per micro-batch
    assert count_streamed(spark, root, D1) == 6


def count_streamed(spark, root, day):
    from daypulse.streaming.landing import read_streamed
    return read_streamed(spark, root, "sleep").where(F.col("partition_date") == F.lit(day)).count()


def test_replayed_batch_overwrites_only_its_own_files(spark, tmp_root):
    from daypulse.streaming.landing import write_batch
    rows = lambda tag, n: batch(spark, n, tag).withColumn("partition_date", F.lit(D1))
    write_batch(rows("a", 3), tmp_root, "sleep", 0)
    for _ in range(3):
        write_batch(rows("b", 2), tmp_root, "sleep", 1)
    assert count_streamed(spark, tmp_root, D1) == 5


def test_streamed_null_day_goes_to_the_reject_table(spark, tmp_root):
    from daypulse.streaming.landing import read_rejects, start_landing
    landing, root, ck = f"{tmp_root}/landing", f"{tmp_root}/raw", f"{tmp_root}/ck"
    rows = [('{"id": "a"}', D1), ('{"id": "b"}', None)]
    (spark.createDataFrame(rows, "value string, partition_date date").write.partitionBy("partition_date").text(landing))
    for _ in range(2):  # and a restart
        start_landing(spark, landing, root, "sleep", ck).awaitTermination()
    assert count_streamed(spark, root, D1) == 1
    assert read_rejects(spark, root, "sleep").count() == 1


def test_failed_load_keeps_the_old_day(spark, tmp_root):
    upsert_day(spark, tmp_root, "sleep", batch(spark, 3), D1)
    bad = spark.range(10).select(F.when(F.col("id") < 9, F.lit('{"id": 1}')).otherwise(F.raise_error(F.lit("boom"))).alias("raw_data"))
    with pytest.raises(Exception, match="boom"):
        upsert_day(spark, tmp_root, "sleep", bad, D1)
    assert count_day(spark, tmp_root, D1) == 3


def test_backfill_of_no_days_writes_nothing(spark, tmp_root):
    upsert_day(spark, tmp_root, "sleep", batch(spark, 3), D1)
    m = backfill(spark, tmp_root, "sleep", batch(spark, 4).withColumn("partition_date", F.lit(D1)), [])
    assert m == {"rows": 0, "days_written": 0, "days_cleared": 0} and count_day(spark, tmp_root, D1) == 3


def test_pages_over_several_lines_land_and_bad_pages_stop_the_load(spark, tmp_root):
    import os

    from daypulse.sources.land import load_feed_day
    os.makedirs(f"{tmp_root}/p")
    put = lambda name, text: open(f"{tmp_root}/p/{name}", "w").write(text)
    put("a.json", '{\n  "data": [\n    {"id": "x"},\n    {"id": "y"}\n  ]\n}\n')
    put("b.json", '{"data": [{"id": "z"}]}\n{"status": "none"}\n\n{"data": [{"id": "w"}]}\n')
    assert load_feed_day(spark, f"{tmp_root}/raw", "sleep", f"{tmp_root}/p", D1) == 4
    put("c.json", '{"data": [{"id": ')
    with pytest.raises(Exception, match="not valid JSON"):
        load_feed_day(spark, f"{tmp_root}/raw", "sleep", f"{tmp_root}/p", D1)
    assert count_day(spark, f"{tmp_root}/raw", D1) == 4
    with pytest.raises(Exception, match="not valid JSON"):  # a malformed line of a JSON-lines feed
        load_feed_day(spark, f"{tmp_root}/raw", "sleep", f"{tmp_root}/p/c.json", D1, envelope=False)
    assert count_day(spark, f"{tmp_root}/raw", D1) == 4


def test_files_per_day_follow_the_data_not_the_tasks(spark, tmp_root):
    import glob
    many = spark.range(0, 4000, 1, 40).select(
        F.to_variant_object(F.struct("id")).alias("raw_data"),
        F.expr("date_add(date'2026-01-01', cast(id % 20 as int))").alias("partition_date"))
    backfill(spark, tmp_root, "sleep", many, [dt.date(2026, 1, 1) + dt.timedelta(days=i) for i in range(20)])
    assert len(glob.glob(f"{tmp_root}/sleep/*/*.parquet")) <= 40  # not 40 tasks x 20 days


def test_slice_period_is_inclusive(spark):
    from daypulse.sources.land import slice_period
    df = spark.createDataFrame([(D1 + dt.timedelta(days=i),) for i in range(10)], "day date")
    got = sorted(r["day"] for r in slice_period(df, D1 + dt.timedelta(days=2), D1 + dt.timedelta(days=4)).collect())
    assert got == [D1 + dt.timedelta(days=i) for i in (2, 3, 4)]


def test_stream_without_landing_folder_is_a_no_op(spark, tmp_root):
    from daypulse.streaming.landing import start_landing
    assert start_landing(spark, f"{tmp_root}/none", f"{tmp_root}/raw", "sleep", f"{tmp_root}/ck") is None


def test_json_text_batches_are_parsed_on_landing(spark, tmp_root):
    from daypulse.operators.stage import stage
    text = spark.createDataFrame([('{"day": "2026-01-15", "score": 77}',), ("not json",)], "raw_data string")
    assert upsert_day(spark, tmp_root, "readiness", text, D1) == 2
    got = [(r["readiness_score"], r["day"]) for r in stage(read_raw(spark, tmp_root, "readiness"), "readiness").collect()]
    assert sorted(got, key=str) == sorted([(77, dt.date(2026, 1, 15)), (None, None)], key=str)


def test_append_log_then_latest(spark, tmp_root):
    from daypulse.sources.land import append
    log = f"{tmp_root}/tokens"
    append(spark.createDataFrame([("k", 1, "old")], "key string, updated_at int, token string"), log)
    append(spark.createDataFrame([("k", 2, "new")], "key string, updated_at int, token string"), log)
    rows = latest_by(spark.read.parquet(log), ["key"], ["updated_at"]).collect()
    assert [(r["key"], r["token"]) for r in rows] == [("k", "new")]


def test_envelope_pages_are_bounded_and_grow_with_the_day(spark):
    rows = [(f'{{"v": {i}}}', D1) for i in range(500)] + [('{"same": 1}', D1)] * 300 + [('{"v": 0}', D2)] * 3
    raw = to_raw(spark.createDataFrame(rows, "js string, partition_date date"), "js", keep=["partition_date"])
    paged = plans._paged(raw, 20).collect()
    assert sorted((r.partition_date, r.r.replace(":", ": ")) for r in paged) == sorted((d, js) for js, d in rows)
    sizes = {}
    for r in paged:
        sizes[r.partition_date, r.page] = sizes.get((r.partition_date, r.page), 0) + 1
    assert max(sizes.values()) <= 20
    assert sum(d == D1 for d, _ in sizes) >= 40 and all(p in (0, 1) for d, p in sizes if d == D2)
    assert plans._paged(raw.where("false"), 20).count() == 0
