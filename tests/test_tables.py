"""Rebuilds by swap, compaction of streamed loads, and feeds landed with a quarantine."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from daypulse.session import rename_path
from daypulse.sources import land, tables
from daypulse.streaming import compaction, landing

D1, D2, D3 = (dt.date(2026, 1, i) for i in (15, 16, 17))


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def values(df):
    return sorted(r[0] for r in df.collect())


# ---- swap -------------------------------------------------------------------------

def test_failed_rebuild_keeps_the_model(spark, tmp_root):
    path = f"{tmp_root}/model"
    assert values(land.materialize(numbers(spark, 1, 2), path)) == [1, 2]
    with pytest.raises(Exception, match="broken"):
        land.materialize(numbers(spark, 3).withColumn("v", F.raise_error(F.lit("broken")).cast("long")), path)
    assert values(spark.read.parquet(path)) == [1, 2] and os.listdir(tmp_root) == ["model"]


def test_rebuild_from_itself_and_by_partitions(spark, tmp_root):
    path = f"{tmp_root}/model"
    land.materialize(numbers(spark, 1, 2), path)
    got = land.materialize(spark.read.parquet(path).select((F.col("v") + 10).alias("v"), F.lit("x").alias("p")), path, ["p"])
    assert values(got.select("v")) == [11, 12] and os.listdir(tmp_root) == ["model"]


def test_process_that_dies_between_the_renames(spark, tmp_root):
    path = f"{tmp_root}/model"
    land.materialize(numbers(spark, 1), path)
    numbers(spark, 2).write.parquet(f"{path}.next-abc")
    rename_path(spark, path, f"{path}.old-abc")
    assert tables.recover(spark, path) and values(spark.read.parquet(path)) == [1]
    assert os.listdir(tmp_root) == ["model"] and not tables.recover(spark, path)


def test_swap_that_cannot_finish_puts_the_old_table_back(spark, tmp_root, monkeypatch):
    path = f"{tmp_root}/model"
    land.materialize(numbers(spark, 1), path)

    def refuse(s, a, b):
        if ".next-" in a:
            raise OSError("refused")
        rename_path(s, a, b)

    monkeypatch.setattr(tables, "rename_path", refuse)
    with pytest.raises(OSError):
        land.materialize(numbers(spark, 2), path)
    assert values(spark.read.parquet(path)) == [1]


# ---- compaction -------------------------------------------------------------------

def load(spark, root, load_id, rows):
    df = spark.createDataFrame(rows, "js string, partition_date date")
    landing.write_batch(df.select(F.parse_json("js").alias("raw_data"), "partition_date"), root, "sleep", load_id)


def seen(spark, root):
    got = landing.read_streamed(spark, root, "sleep").select(F.variant_get("raw_data", "$.i", "int"), "partition_date")
    return sorted(map(tuple, got.collect()))


def test_every_record_once_through_compaction_replay_and_vacuum(spark, tmp_root):
    want = []
    for k in range(4):
        rows = [(f'{{"i": {10 * k + j}}}', d) for j, d in enumerate((D1, D1, D2)[:3 if k < 3 else 2])]
        load(spark, tmp_root, k, rows)
        want += [(10 * k + j, d) for j, (_, d) in enumerate(rows)]
    assert seen(spark, tmp_root) == sorted(want)
    assert compaction.compact(spark, tmp_root, "sleep") == {"days": 2, "loads": 6}  # load 3 is the newest: not settled
    assert seen(spark, tmp_root) == sorted(want)
    assert compaction.compact(spark, tmp_root, "sleep") == {"days": 0, "loads": 0}
    load(spark, tmp_root, 0, [(f'{{"i": {j}}}', d) for j, d in enumerate((D1, D1, D2))])  # a replay
    assert seen(spark, tmp_root) == sorted(want)
    load(spark, tmp_root, 4, [('{"i": 99}', D1), ('{"i": 98}', D3)])
    want += [(99, D1), (98, D3)]
    assert compaction.compact(spark, tmp_root, "sleep", min_loads=1, settled_only=False)["days"] == 2
    assert seen(spark, tmp_root) == sorted(want)
    assert compaction.vacuum(spark, tmp_root, "sleep") > 0
    assert seen(spark, tmp_root) == sorted(want) and compaction.vacuum(spark, tmp_root, "sleep") == 0
    load(spark, tmp_root, 2, [('{"i": 20}', D1)])  # a replay after the folders are gone
    assert seen(spark, tmp_root) == sorted(want)
    files = [f for _, _, names in os.walk(f"{tmp_root}/sleep_compacted") for f in names if f.endswith(".parquet")]
    assert len(files) <= 4


def test_broken_compaction_is_not_seen(spark, tmp_root, monkeypatch):
    load(spark, tmp_root, 0, [('{"i": 1}', D1)])
    load(spark, tmp_root, 1, [('{"i": 2}', D1)])
    monkeypatch.setattr(compaction, "_publish", lambda *a: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        compaction.compact(spark, tmp_root, "sleep", settled_only=False)
    assert [i for i, _ in seen(spark, tmp_root)] == [1, 2]
    monkeypatch.undo()
    compaction.compact(spark, tmp_root, "sleep", settled_only=False)
    compaction.vacuum(spark, tmp_root, "sleep")
    assert [i for i, _ in seen(spark, tmp_root)] == [1, 2] and os.listdir(f"{tmp_root}/sleep_compacted") == ["gen=2"]


# ---- quarantine -------------------------------------------------------------------

def put(root, name, text):
    os.makedirs(f"{root}/files", exist_ok=True)
    with open(f"{root}/files/{name}", "w") as f:
        f.write(text)


def test_rejects_are_kept_and_counted(spark, tmp_root):
    put(tmp_root, "a.json", '{"data":[{"id":"1"},"x",null]}\n{"data":[{"id":"2"}\n\n{"other":1}\n{"data":5}\n[1]\n')
    put(tmp_root, "b.json", '{"data":\n [{"id":"3"}]}\n')
    raw = f"{tmp_root}/raw"
    assert land.load_feed_day(spark, raw, "sleep", f"{tmp_root}/files", D1, max_rejects=4) == 2
    got = land.read_rejected(spark, raw, "sleep").collect()
    assert sorted((r.reason, r.text) for r in got) == [
        (land.NOT_OBJECT, '"x"'), (land.NOT_OBJECT, "[1]"), (land.NOT_OBJECT, "null"), (land.NOT_JSON, '{"data":[{"id":"2"}')]
    assert all(r.file.endswith("a.json") and r.partition_date == D1 for r in got)


def test_too_many_rejects_keep_the_day(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    put(tmp_root, "a.json", '{"id":"1"}\n{"id":"2"}\n')
    assert land.load_feed_day(spark, raw, "sleep", f"{tmp_root}/files", D1, envelope=False, max_rejects=0) == 2
    assert land.read_rejected(spark, raw, "sleep").count() == 0
    put(tmp_root, "a.json", '{"id":"3"}\n{"id":\n"lost"\n')
    for limit in (1, 0.5):
        with pytest.raises(ValueError, match="2 of 3"):
            land.load_feed_day(spark, raw, "sleep", f"{tmp_root}/files", D1, envelope=False, max_rejects=limit)
    assert land.read_raw(spark, raw, "sleep").count() == 2 and land.read_rejected(spark, raw, "sleep").count() == 2
    assert land.load_feed_day(spark, raw, "sleep", f"{tmp_root}/files", D1, envelope=False, max_rejects=0.7) == 1
    put(tmp_root, "a.json", '{"id":"4"}\n')
    assert land.load_feed_day(spark, raw, "sleep", f"{tmp_root}/files", D1, envelope=False, max_rejects=0) == 1
    assert land.read_rejected(spark, raw, "sleep").count() == 0


def test_column_case(spark):
    df = spark.createDataFrame([(1, 2)], "Ab long, cD long")
    assert land.lower_columns(df).columns == ["ab", "cd"] and land.upper_columns(df).columns == ["AB", "CD"]
