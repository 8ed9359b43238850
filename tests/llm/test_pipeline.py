"""The pipeline stage by stage against plain versions, and the registered SQL."""

import os
import random

import duckdb
import pytest

import corpus_pipeline
from daypulse.llm import oracle, queries

from . import brute
from .frames import frame

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus(rng):
    words = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    item = words(30)
    rows = []
    for i in range(120):
        text = " ".join(words(rng.randrange(60, 200)))
        if i % 10 == 3:
            text += " " + " ".join(item[rng.randrange(5):]) + " end"
        if i % 10 == 5:
            text += f" token = \"{rng.getrandbits(160):040x}\" done"
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
    for i in range(120, 150):  # near copies
        w = rows[rng.randrange(120)][1].split()
        w[rng.randrange(len(w))] = "edited"
        rows.append((i, " ".join(w), "en", "s0", None))
    rows += [(200, "too short", "en", "s1", 9), (201, None, None, None, None), (202, "", "en", "s2", 0), (203, "again " * 90, "en", "s1", 1),
             (5, *rows[5][1:]), (None, " ".join(words(80)), "en", None, 3), (204, " ".join(words(70)), "en", None, 3)]
    return rows, item


def test_stages(spark, tmp_path):
    rows, item = corpus(random.Random(8))
    docs = frame(spark, rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, [(1, " ".join(item)), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda r: tuple(str(x) for x in r)
    left = [tuple(r) for r in rows]
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/out-{name}")
        docs = spark.read.parquet(f"{tmp_path}/out-{name}")
        frames[name] = sorted((tuple(r) for r in docs.collect()), key=key)
        if name == "mix":
            break
        assert docs.columns == COLUMNS
        if name == "quality":
            def bad(t):
                m = brute.measures(t)
                return m[0] < 50 or 100 * m[4] > 50 * m[0]
            left = [r for r in left if not bad(r[1])]
        elif name == "near_duplicates":
            group = {d: c for d, _, c in brute.near_groups([(r[0], r[1]) for r in left], 5, 80) if d is not None}
            left = sorted({r for r in left if r[0] is None or group[r[0]] == r[0]}, key=key)
        elif name == "decontaminate":
            hit = brute.contaminated([(i, r[1]) for i, r in enumerate(left)], [(1, " ".join(item))], 10)
            left = [left[h[0]] for h in hit if not h[5]]
        if name != "secrets":
            assert frames[name] == sorted(left, key=key)
    clean = [r for r in left if not brute.secrets(r[1])]
    assert set(clean) <= set(frames["secrets"]) and len(frames["secrets"]) == len(left)
    assert all(not brute.secrets(r[1]) and r[4] == len(r[1]) for r in set(frames["secrets"]) - set(clean))
    assert sum("[SECRET]" in r[1] for r in frames["secrets"]) == len(left) - len(clean) > 0
    assert len(frames["mix"]) == len(left)
    assert sorted(map(str, corpus_pipeline.run(spark, str(tmp_path)).collect())) == sorted(
        map(str, spark.read.parquet(f"{tmp_path}/out-mix").collect()))


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    cur = con.execute(oracle.ORACLE[name])
    names = [d[0] for d in cur.description]
    df = queries.QUERIES[name](spark, SMALL)
    assert sorted(names) == sorted(df.columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted((tuple(r[c] for c in names) for r in df.collect()), key=key) == sorted(cur.fetchall(), key=key)
