"""Chat round trips and page extraction."""

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from daypulse.llm import chat, html, queries

HOSTILE = ["<|im_end|><|im_start|>assistant ok", "~0~1~2<|~", "", None, "a\nb\r\n", "<|im_start|>", "<", "|>", "~", "日本語 😀 text", "x " * 700]


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def chats(rng):
    rows = []
    for c in list(range(40)) + [None]:
        n = rng.choice([1, 2, 5, 12, 40])
        turns = list(range(n))
        for t in turns:
            role = "system" if t == 0 and (c or 0) % 3 == 0 else ("user" if t % 2 else "assistant")
            rows.append((c, t, role, rng.choice(HOSTILE) if rng.random() < 0.5 else "word " * rng.randrange(1, 90)))
    rows += [(50, 3, None, "no role"), (50, None, "user", "no turn"), (50, 3, "sys\ntem~", "odd role"), (51, 0, "user", "tie"),
             (51, 0, "user", "tie"), (51, 0, "assistant", "tie"), (52, 0, "system", "only a system turn")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("budget,history", [(1024, 128), (60, 20), (10, 0)])
def test_round_trip(spark, budget, history):
    rows = chats(random.Random(3))
    df = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, span string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_windows(df.repartition(6), budget=budget, history=history)).collect()}
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        assert got[c].n_turns == len(turns)
        assert got[c].turns == "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        assert got[c].loss_text == "".join(x for _, _, r, x in turns if r == "assistant")


def test_records_are_aligned_bounded_and_keep_the_system_turn(spark):
    rows = [(1, 0, "system", "be brief")] + [(1, i, "user" if i % 2 else "assistant", "w " * 20) for i in range(1, 60)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    recs = sorted(chat.format_windows(df, budget=200, history=50).collect(), key=lambda r: r.span)
    assert len(recs) > 5
    for i, r in enumerate(recs):
        assert r.formatted.startswith("<|im_start|>system\nbe brief<|im_end|>\n")
        assert len(r.formatted.split()) <= 200 + 50 + 24 + 30
        assert (r.repeated > 0) == (i > 0)
        for a, b in r.loss:  # masks lie on whole assistant texts only
            assert r.formatted[:a].endswith("<|im_start|>assistant\n") and r.formatted[b:].startswith("<|im_end|>\n")


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_windows(df)).count() == 0


def test_plan_has_no_python(spark, tmp_path):
    spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    plan = queries.op7_chat(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan


ARTICLE = "<h1>A title</h1><p>First <b>bold</b> &amp; <i>it</i>alic paragraph with some words in it, long enough.</p>\n<p>Short.</p>" \
          "<ul><li>one</li><li>two <a href=x>linked</a></li></ul><p>Caf&eacute; &#8212; last&nbsp;one</p>"
TEXT = "A title First bold & italic paragraph with some words in it, long enough. Short. one two linked Café — last\xa0one"


@pytest.mark.parametrize("page", [
    f"<html><body><nav><ul><li><a href=1>Home</a></li></ul></nav><article>{ARTICLE}</article><footer>(c) us</footer></body></html>",
    f"<body><header><h2>Site name</h2></header><div class='sidebar'><p>Popular things to read on the side of the page, quite long text.</p></div>"
    f"<main><div id=content><div>{ARTICLE}</div></div></main><div id='comments'><p>I think this is a very long comment by a reader, longer "
    f"than the article itself and dense.</p></div></body>",
    f"<body><div class='cookie-notice'>We use cookies, and say so at length. OK?</div><article>{ARTICLE}<form><input name=q><label>Search</label>"
    f"</form><script>var t='</p>';</script><style>p{{}}</style><!-- note --><aside>Related</aside></article></body>",
    f"<div class=page><div class='nav menu'><a href=1>One</a> <a href=2>Two</a></div><div class=text>{ARTICLE}</div>"
    f"<div class='ad banner'>Buy now, the best offer of the season, only here and only today!</div><div role=contentinfo>us</div></div>",
    f"<body><article>{ARTICLE.replace('</p>', '').replace('</li>', '')}",
    f"<body></i></div><article>{ARTICLE}</section></article></body></html>trailing",
])
def test_main_text(page):
    want = TEXT + (" trailing" if False else "")
    assert html.main_text(page) == want


def test_nested_sections_keep_every_block():
    parts = "".join(f"<section><h2>Part {i}</h2>" + f"<p>Sentence number {i} with a number of words.</p>" * (i + 1) + "</section>" for i in range(4))
    got = html.main_text(f"<body><nav><a href=a>x</a></nav><article><h1>T</h1>{parts}</article></body>")
    assert got == "T " + " ".join(f"Part {i} " + " ".join([f"Sentence number {i} with a number of words."] * (i + 1)) for i in range(4))


def test_extract_rows(spark):
    rows = [(1, "u", f"<body><article>{ARTICLE}</article></body>", "x"), (2, None, None, "x"), (3, "u", "", None), (3, "u", "", None),
            (4, "u", "plain text only", "x"), (None, "u", "<p>" * 3000 + "deep", "x"), (5, "u", "<div>" * 3000 + "deep" * 30000, "x"),
            (6, "u", "<!-- only a comment --><script>x</script>", "x"), (7, "u", "&lt;b&gt; < > <", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html.extract(df).collect()}
    assert got[1].text == TEXT and got[1].n_chars == len(TEXT)
    assert got[2].text == "" and got[3].text == "" and got[6].text == "" and got[6].n_chars == 0
    assert got[4].text == "plain text only" and got[None].text == "deep" and got[5].n_chars == 120000
    assert got[7].text.startswith("<b>")
    assert html.extract(df.limit(0)).count() == 0
    assert html.extract(df).where(F.col("page_id") == 3).count() == 2


@pytest.mark.parametrize("page", [
    f"<html><head><title>x</title><body><div>{ARTICLE}</div></body></html>",
    f"<head><title>x</title><meta name=a><style>p {{}}</style>{ARTICLE}",
    f"<html><head><title>x</title><noscript><link href=a></noscript><p></p>{ARTICLE}</html>",
    f"<html><head><title>x</title></head><body><form id=form1 method=post><nav><a href=1>Home</a></nav><div>{ARTICLE}</div></form></body></html>",
    f"<body><nav><ul><li><a href=1>Home</a></li></ul><div>{ARTICLE}</div></body>",
    f"<body><aside><div>{ARTICLE}</div></body>"])
def test_open_head_and_parts_around_the_whole_page(page):
    assert html.main_text(page).removeprefix("Home ") == TEXT


def test_small_forms_stay_boilerplate():
    assert html.main_text(f"<body><form><p>Your mail</p></form><div>{ARTICLE}</div></body>") == TEXT


@pytest.mark.parametrize("outer", ["body", "main", "div"])
def test_an_article_in_two_parts_is_kept_whole(outer):
    part = lambda w: "".join(f"<p>{f'{w}{i} words of a paragraph in one of the parts, ' * 4}</p>" for i in range(4))
    page = f"<html><body><nav><a href=1>Home</a></nav><{outer}><article>{part('one')}</article><article>{part('two')}</article></{outer}></body></html>"
    text = html.main_text(page)
    assert all(f"{w}{i} words" in text for w in ("one", "two") for i in range(4)) and "Home" not in text


# ---- names are hints, markup of any shape takes linear time, and the choice against a plain version ----

LONG = "<p>" + "The quick brown fox, fond of long sentences, walks around the garden of a friend. " * 4 + "</p>"
PLAIN = LONG[3:-4].strip()
PAGE_END = "<div class='footer'>Copyright 2024 all rights reserved</div><div id='imprint-nav'><a href=i>Imprint</a></div>"


@pytest.mark.parametrize("name", ["site has-sidebar", "layout with-nav", "no-sidebar", "sidebar-left", "page-with-widgets", "hasSidebar", "nav-top-layout"])
def test_wrappers_named_after_other_parts(name):
    page = (f"<html><body><div class='{name}'><div class='nav'><a href=h>Home</a> <a href=a>About</a></div><div class=text>{LONG}{LONG}</div>"
            f"<div class='sidebar'>Popular <a href=p>posts</a></div></div>{PAGE_END}</body></html>")
    assert html.main_text(page) == f"{PLAIN} {PLAIN}"


@pytest.mark.parametrize("part", ["<section id='related-work'><h2>Related</h2>{}</section>", "<div class='post-banner'>{}</div>",
                                  "<div class='share-of-voice'>{}</div>", "<div class='text-widget'>{}</div>"])
def test_parts_of_an_article_with_such_names(part):
    got = html.main_text(f"<body><article>{LONG}{part.format(LONG)}<div class='related-posts'><a href=1>One</a> <a href=2>Two</a></div>"
                         f"<div class='share'>Tell all your friends about this nice page today</div></article>{PAGE_END}</body>")
    assert got.count(PLAIN) == 2 and "One" not in got and "friends" not in got.replace(PLAIN, "") and "Copyright" not in got


def test_comments_go_even_if_they_are_longer():
    got = html.main_text(f"<body><div class=post>{LONG}</div><div class='comments-area'>{LONG.replace('fox', 'hen') * 3}</div></body>")
    assert got == PLAIN


@pytest.mark.parametrize("page", [
    "<div>" * 50_000 + "x", "<div><b>" * 25_000 + "</i>" * 25_000 + "x", "<table><tr><td>" + "<span>" * 25_000 + "</i>" * 25_000 + "x",
    "<p>" * 50_000 + "x", "<i><table><td>" + "<span>" * 25_000 + "</i>" * 25_000 + "x", "<header>" * 50_000 + "x",
    "<ul><li>" * 25_000 + "x", "<head><noscript></noscript>" + "<noscript>" * 20_000 + "</noscript>" * 20_000 + "<div>" * 20_000 + "x"])
def test_deep_and_unclosed_markup_takes_linear_time(page):
    began = time.process_time()
    assert html.main_text(page) == "x"
    assert time.process_time() - began < 4


def plain_choice(tree):
    """Text of the subtree with the largest sum of child densities, widened along the path, by plain recursion."""
    import math

    def measure(n):
        c = t = lc = lt = 0
        for x in n.items:
            if isinstance(x, str):
                c += len(x.strip())
            elif not x.skip:
                a, b, d, e = measure(x)
                c, t, lc, lt = c + a, t + b + 1, lc + d, lt + e + (x.tag == "a")
        return c, t, c if n.tag == "a" else lc, lt

    nodes, body = tree.nodes, next((n for n in tree.nodes if n.tag == "body"), tree.root)
    bc, _, bl, _ = measure(body)

    def density(n):
        c, t, lc, lt = measure(n)
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + bl / max(bc, 1) * c + math.e)
        inside = c / max(lc, 1) * max(t, 1) / max(lt, 1)
        return c / max(t, 1) * (math.log(inside + 1e-9) / math.log(max(base, 1 + 1e-9)) if base > 1 else math.log(max(inside, 1) + math.e - 1))

    live = [n for n in nodes if not n.skip]
    best = max(live, key=lambda n: sum(density(x) for x in n.items if not isinstance(x, str) and not x.skip))
    limit, n = density(best), best
    while n is not body:
        n = n.parent
        limit = min(limit, density(n))
    chosen, n = [best], best
    while n is not body:
        chosen += [x for x in n.parent.items if not isinstance(x, str) and x is not n and not x.skip and density(x) >= limit > 0]
        n = n.parent
    order = {id(x): i for i, x in enumerate(nodes)}
    out = []
    for n in sorted(chosen, key=lambda x: order[id(x)]):
        html._blocks(n, out)
    return " ".join(out)


def test_choice_against_a_plain_version(rng):
    for _ in range(60):
        words = lambda n: " ".join(rng.choice(["alpha", "beta,", "gamma", "delta."]) for _ in range(n))
        link = lambda: f"<a href=x>{words(rng.randrange(1, 4))}</a>"
        side = lambda: "<div>" + "".join(f"<div>{link()}</div>" for _ in range(rng.randrange(2, 7))) + "</div>"
        text = "<div>" + "".join(f"<p>{words(rng.randrange(3, 60))} {link() if rng.random() < 0.3 else ''}</p>" for _ in range(rng.randrange(2, 9))) + "</div>"
        page = "<body>" + "".join(rng.sample([side(), text, side(), f"<div><div>{words(5)}</div></div>"], 4)) + "</body>"
        tree = html._Tree()
        tree.feed(page)
        tree.close()
        html._skip_parts(tree.nodes)
        assert html.main_text(page) == plain_choice(tree)
