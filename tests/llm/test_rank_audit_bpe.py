"""Ranked search, filter audit and BPE round trip against plain versions, with hostile rows."""

import hashlib
import math
import os
import random
import unicodedata
from collections import Counter
from itertools import permutations
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from daypulse.llm import audit, bpe, rank
from daypulse.llm.queries import vocabulary_path
from daypulse.llm.spark_utils import join_skewed

from . import brute

TERM = brute.re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def bag(rows):
    return sorted(map(repr, rows))


# ---- ranked search ------------------------------------------------------------------

def plain_rank(docs, items, top=10):
    split = [(d, Counter(t := TERM.findall(brute.lower(x or ""))), len(t)) for d, x in docs]
    split = [s for s in split if s[2]]
    total, words, df = len(split), sum(s[2] for s in split), Counter(w for _, c, _ in split for w in c)
    out = []
    for item, text in items:
        scored = []
        for d, c, n in split:
            m = 25 + 75 * n * total // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m))
                        for w in TERM.findall(brute.lower(text or "")) if w in c)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if x else d, -s) for i, (s, x, d) in enumerate(sorted(scored)[:top])]
    return out


def corpus(rng, n):
    words = [f"w{i}" for i in range(40)] + ["Été", "日本", "A1", "the", "The", "of"]
    weight = [1 / (i + 1) for i in range(len(words))]
    rows = [(0, None), (1, ""), (2, " .,-\n"), (None, "w1 w2 w3"), (None, None), (3, "w5 " * 4000), (4, "w7 w7"), (4, "w7 w7"), (4, "w8 w9")]
    for i in range(5, n):
        rows.append((i, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, weight, k=rng.randrange(1, 60)))))
    rows += [(1000 + i, rows[20][1]) for i in range(30)]  # many ties
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_docs,item_bytes", [(1 << 16, 32 << 20), (7, 300)])
def test_top_documents(spark, rng, block_docs, item_bytes):
    docs = corpus(rng, 400)
    items = [("a", "w1 w2 w30 w30 the OF"), ("b", None), ("c", "..."), ("a", "été 日本 w39 w38 w37 nowhere"), (None, "w7 w8"), ("z", docs[50][1]),
             ("long", " ".join(f"w{i}" for i in range(40)) + " x" * 90)]
    df = spark.createDataFrame([(d, x, 1, "q") for d, x in docs], "doc_id long, text string, score int, rank string").repartition(3)
    bench = spark.createDataFrame([(i, x, 2) for i, x in items], "item_id string, text string, doc_id int")
    got = rank.top_documents(df, bench, block_docs=block_docs, item_bytes=item_bytes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and dict(got.dtypes)["rank"] == "int"
    assert bag(map(tuple, got.collect())) == bag(plain_rank(docs, items))


def test_rank_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([("i", "a")], "item_id string, text string")
    assert rank.top_documents(docs.limit(0), bench).count() == 0 and rank.top_documents(docs, bench.limit(0)).count() == 0


def test_masks_end_the_search_early(rng):
    n = 20_000
    codes = [np.unique(rng.choices(range(200), [1 / (i + 1) for i in range(200)], k=20)) for _ in range(n)]
    lengths = np.array([len(c) for c in codes])
    flat = np.concatenate(codes)
    df = np.bincount(flat, minlength=200)
    weight = np.floor(1000 * np.log((2 * n + 2) / (2 * df + 1))).astype(np.int64)
    block = rank.make_block(np.arange(n), lengths, lengths, flat, np.ones(len(flat), np.int64), weight, n, int(lengths.sum()))
    item, reps = np.array([0, 1, 3, 60, 90, 120, 199]), np.ones(7, np.int64)
    best = rank.Best(10)
    scored = rank.search_block(block, item, reps, best)
    order = np.argsort([t for t in range(7)], kind="stable")
    every = rank._scores(block, item[order], reps, np.arange(n))
    want = sorted(zip(-every, range(n)))[:10]
    assert list(zip(-best.score, best.ids)) == want and scored < n // 10


# ---- filter audit -------------------------------------------------------------------

def plain_audit(docs, labels):
    def fails(text):
        w = brute.WORD.findall(text)
        return ("A" * (len(w) < 200) + "B" * (100 * len(set(w)) < 50 * len(w))
                + "C" * (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)) + "D" * any(c in "#$%&*|" for c in text))

    least, good, toxic = {}, set(), set()
    for d, x, _ in docs:
        if d is not None:
            least[x or ""] = min(d, least.get(x or "", d))
    for d, q, t in labels:
        good |= {d} if q == 1 else set()
        toxic |= {d} if t == 1 else set()
    rows = [(p or "", fails(x or "") + "E" * (d is not None and least[x or ""] < d), d) for d, x, p in docs]
    out = []
    orders = ["".join(o) for o in permutations("ABCDE")]
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = {c: sum(next((c for c in o if c in f), "") == c for o in orders for _, f, _ in mine) for c in "ABCDE"}
        for o in orders:
            left = mine
            for step, c in enumerate(o, 1):
                gone = [r for r in left if c in r[1]]
                left = [r for r in left if c not in r[1]]
                out.append((part, o, step, len(left), len(gone), sum(c in f and any(x in f for x in o[:step - 1]) for _, f, _ in mine),
                            sum(f == c for _, f, _ in mine), sum(r[2] is not None and r[2] in good for r in gone),
                            sum(r[2] is not None and r[2] in toxic for r in gone), shapley[c]))
    return out


def audit_rows(rng):
    base = " ".join(rng.choice(["alpha", "Beta", "gámma"]) + str(rng.randrange(150)) for _ in range(260))
    rows = [(0, None, None), (1, "", "en"), (None, "", "en"), (2, "", ""), (3, base, "en"), (3, base, "en"), (2, base, "de"), (None, base, None),
            (9, "x " * 300, "en"), (9, base + " #", "de"), (10, "AB" * 5000, "fr"), (11, "ab " * 70_000, "fr")]
    for i in range(20, 90):
        words = [rng.choice(["a", "B", "cc", "%d" % rng.randrange(400)]) for _ in range(rng.choice([5, 199, 200, 300]))]
        rows.append((rng.randrange(20, 80), rng.choice([" ", "\n", " | "]).join(words), rng.choice(["en", "de", "", None])))
    return rows + rows[20:60:3]


LABELS = [(i, i % 2, (i // 2) % 3) for i in range(0, 80, 3)] + [(3, 0, 1), (3, 1, None), (None, 1, 1), (9, None, 1)]


@pytest.mark.parametrize("section,one_name", [(audit.SECTION, False), (9, False), (audit.SECTION, True)])
def test_audit(spark, rng, monkeypatch, section, one_name):
    rows = audit_rows(rng)
    if one_name:  # every text under the same 128 bits: the exact way by full text takes over
        plain = audit._rows
        monkeypatch.setattr(audit, "_rows", lambda *a: plain(*a).withColumns({"name0": F.lit(5).cast("long"), "name1": F.lit(6).cast("long")}))
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, lang string, mask int, name0 string").repartition(4)
    labels = spark.createDataFrame([(*x, "p") for x in LABELS], "doc_id long, quality int, toxic int, part string")
    got = audit.audit(docs, labels, section=section)
    want = plain_audit(rows, LABELS)
    cols = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert bag(tuple(r[c] for c in cols) for r in got.collect()) == bag(want)


def test_audit_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_sketch_clears_unique_texts_and_misses_no_repeat(spark, rng):
    rows = [(i, f"text {i if i % 10 else i // 50}", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    plain = audit._rows(docs, "doc_id", "text", "lang")
    left = audit.possible_repeats(plain, plain).collect()
    count = Counter(x for _, x, _ in rows)
    repeated = [d for d, x, _ in rows if count[x] > 1]
    assert set(repeated) <= {r.doc_id for r in left} and len(left) < len(repeated) + 10


# ---- BPE ----------------------------------------------------------------------------

BITS = ["a", "aa", "abab", "the ", " ", "  ", "\n", "\n\n", "'s", "'re", "'", "1", "12", "é", "日本", "!", "!!", "<|endoftext|>", "<|endof", "text|>",
        " ", "　", "🙂", "x" * 30, " hello", "ing", "\t", "\U00010ec5", "՘", "\r\n", "ﬀ"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def coder():
    return bpe.coder(bpe.read_vocabulary(vocabulary_path()))


def digests(library, text):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def texts(rng, n):
    return ["".join(rng.choice(some) for _ in range(rng.randrange(0, 100))) for _ in range(n) for some in [rng.sample(BITS, rng.randrange(1, 6))]]


def test_joins_of_leaves(library, coder, rng, monkeypatch):
    monkeypatch.setattr(bpe, "PIECE", 16)
    coder._known, coder._before = {}, {}
    for text in texts(rng, 800):
        want = library.encode(text, add_special_tokens=False).ids
        whole = coder.encode(text)
        assert whole.ids.tolist() == want
        got = coder.fold([coder.encode(p) for p in bpe.leaves(text, rng.choice([1, 2, 3, 7, 20, 64]))])
        assert got.ids.tolist() == want and (got.first == whole.first).all()
        assert coder.decode(got.ids) == library.decode(want, skip_special_tokens=False)
    coder._known, coder._before = {}, {}


def test_ascii_texts_are_cut_as_the_library_cuts_them(coder):
    rng = random.Random(7)
    pool = [chr(c) for c in range(128)] + list(" \n\t'stmdrevl0A.") * 6
    for _ in range(20_000):
        text = "".join(rng.choices(pool, k=rng.randrange(1, 12)))
        assert coder._ascii_pattern.findall(text) == coder._library_pieces(text)


def test_many_different_pieces_are_encoded_once(coder, monkeypatch):
    """More different pieces than a worker remembered before: the second reading finds all of them."""
    counted, plain = [], coder._plain
    monkeypatch.setattr(coder, "_plain", lambda parts: counted.append(len(parts)) or plain(parts))
    coder._known, coder._before = {}, {}
    texts = ["".join(f" {k}" for k in range(s, s + 1000)) for s in range(0, 200_000, 1000)]
    assert [coder.digests(t) for t in texts] == [coder.digests(t) for t in texts]
    assert sum(counted) == 200_000
    assert all(type(x) is bytes for x in coder._known.values())
    coder._known, coder._before = {}, {}


def test_long_unsplit_texts(library, coder):
    for text in ["a" * 60_001, "ab" * 30_000 + "a", "日本語" * 9_000, " " * 30_000 + "x", "=-" * 20_000, "9" * 30_000]:
        got = coder.fold([coder.encode(p) for p in bpe.leaves(text, 4096)])
        assert got.ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_pieces_of_every_kind_of_character(library, coder):
    """Classes of the split agree with the library's on every code point (new ones take the library's way)."""
    rng = random.Random(3)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) not in ("Cn", "Co")]
    some = points[:3000] + rng.sample(points, 6000) + [0x558, 0x10ec5, 0x1e6c0, 0x3d000, 0xe000]
    for k in range(0, len(some), 500):
        text = "".join(f"a{chr(c)}1 !{chr(c)}\n" for c in some[k:k + 500])
        assert coder.pieces(text) == coder._library_pieces(text)


@pytest.mark.parametrize("leaf,fan_in", [(bpe.LEAF, bpe.FAN_IN), (90, 8)])
def test_round_trip(spark, library, rng, leaf, fan_in):
    made = [None, "", " ", "one", "x" * 20_000, "two words " * 3000, *texts(rng, 60)]
    rows = [(i % 50 if i else None, x) for i, x in enumerate(made + made[:9])]
    docs = spark.createDataFrame([(*r, 7, "z") for r in rows], "doc_id long, text string, idx int, name string").repartition(3)
    got = bpe.round_trip(docs, vocabulary_path(), leaf=leaf, fan_in=fan_in, drop_text=True)
    assert got.columns == ["doc_id", "idx", "name", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert bag(tuple(r)[:1] + tuple(r)[3:] for r in got.collect()) == bag((d, *digests(library, x)) for d, x in rows)
    empty = bpe.round_trip(docs.limit(0), vocabulary_path(), leaf=leaf, fan_in=fan_in)
    assert empty.count() == 0
    ids = bpe.tokenize(docs, vocabulary_path(), leaf=leaf, fan_in=fan_in)
    back = bpe.detokenize(ids, vocabulary_path()).select("text", "ids", "decoded").collect()
    assert len(back) == len(rows) and all(r.decoded == (r.text or "") for r in back)
    assert all(r.ids == library.encode(r.text or "", add_special_tokens=False).ids for r in back)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Coder(bpe.read_vocabulary(vocabulary_path("word_bpe_49k.json"))[1])


def test_skewed_join(spark):
    rows = spark.createDataFrame([(i % 2000 if i % 3 else 7, i) for i in range(9000)] + [(None, -1)], "k long, v long")
    found = spark.createDataFrame([(k, k * 10) for k in range(1500)], "key long, w long")
    for how in ("inner", "left"):
        plain = rows.join(found, F.col("k") == F.col("key"), how)
        assert bag(map(tuple, join_skewed(rows, found, "k", "key", how).collect())) == bag(map(tuple, plain.collect()))


def test_texts_that_are_joined_skip_later_rounds(spark, monkeypatch):
    """A long text among many shorter ones: rounds join open texts only."""
    shared = spark.sparkContext.broadcast(bpe.read_vocabulary(vocabulary_path()))
    texts = ["one two three four " * 3 + str(i) for i in range(6)] + ["five six seven " * 20]
    docs, sizes, joined = spark.createDataFrame([(t,) for t in texts], "text string"), [], bpe._joined

    def counted(segments, *rest):
        sizes.append(segments.select("name").distinct().count())
        return joined(segments, *rest)

    monkeypatch.setattr(bpe, "_joined", counted)
    got = bpe.encode_long(docs, "text", shared, leaf=16, fan_in=8)
    code = bpe.Coder(shared.value[1])
    assert {r["name"]: code.decode(np.frombuffer(r["ids"], bpe.ID).tolist()) for r in got.collect()} == {bpe._sha(t): t for t in texts}
    assert sizes == [7, 1]


def test_long_texts_leave_no_ids_on_disk(spark, library, monkeypatch):
    """Texts that the first round completes: their leaves are shuffled once, and only digests are stored."""
    rng, sizes, plans, keep = random.Random(5), [], [], bpe.stored

    def counted(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        out = keep(df, name)
        sizes.append(sum(os.path.getsize(urlparse(f).path) for f in out.inputFiles()))
        return out

    monkeypatch.setattr(bpe, "stored", counted)
    texts = ["".join(rng.choices("abcdefghij .,\n", k=20_000)) for _ in range(30)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts + texts[:5])], "doc_id long, text string").repartition(2)
    got = bpe.round_trip(docs, vocabulary_path(), drop_text=True)
    assert bag(map(tuple, got.collect())) == bag((i, *digests(library, t)) for i, t in enumerate(texts + texts[:5]))
    assert sum(sizes) < 0.1 * 20_000 * len(texts)
    # the repartition of the docs, and one shuffle for what follows
    assert sum(p.count("Exchange") for p in plans if "leaves" in p) == 2


@pytest.mark.parametrize("leaf,fan_in", [(16, 2), (16, 3), (7, 5)])
def test_digests_of_texts_of_many_rounds(spark, library, rng, leaf, fan_in):
    made = [*texts(rng, 20), "five six seven " * 60, "日本 語é" * 90, "x" * 1000, "one two three " * 3]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(made + made[::3])], "doc_id long, text string").repartition(3)
    got = bpe.round_trip(docs, vocabulary_path(), leaf=leaf, fan_in=fan_in, drop_text=True)
    assert bag(map(tuple, got.collect())) == bag((i, *digests(library, t)) for i, t in enumerate(made + made[::3]))
