"""Page text, chat formatting, source mixing, and the queries with SQL."""

from __future__ import annotations

import html
import random
import re

import pytest
from compare import agree
from conftest import DATA
from pyspark.sql import functions as F

from tallgrass.llm import chat_format as cf
from tallgrass.llm import html_blocks as hb
from tallgrass.llm import html_extract as hx
from tallgrass.llm import queries as q
from tallgrass.llm import source_mixing as sm


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_agrees_with_sql(spark, oracle, name):
    agree(q.QUERIES[name](spark, DATA), oracle.sql(q.ORACLES[name]))


def test_every_operator_has_a_query():
    assert [n.partition("_")[0] for n in q.QUERIES] == [f"op{i}" for i in range(1, 11)]


# Pages


def test_text_behind_a_deep_nest_keeps_its_ancestors():
    got = hb.blocks("<article><div class=body>" + "<div>" * 900 + "in" + "</div>" * 900 + "<p>after</p></div></article><p>out")
    assert [x.text for x in got] == ["in", "after", "out"]
    assert got[1].path == (("article",), ("div", "body"), ("p",)) and [x[0] for x in got[2].path] == ["p"]


def test_text_behind_many_unclosed_inline_tags_keeps_its_ancestors():
    got = hb.blocks("<article><div class=body>" + "<b>" * 900 + "one<div>two</div>three</div></article><p>four")
    assert [x.text for x in got] == ["one", "two", "three", "four"]
    assert got[2].path == (("article",), ("div", "body")) and [x[0] for x in got[3].path] == ["p"]


def test_blocks():
    page = """<!doctype html><title>no</title><script>var x = "<p>no</p>";</script><style>p{}</style><!-- <p>no</p> -->
    <p>one <b>bold</b><br>same&nbsp;block &lt;x&gt; &copy &#233;<p>two<div>three<p>four</div>five<ul><li>a<li>b <a href=x title="1>0">link</a></ul><textarea>no</textarea>six <3 seven</body></html> eight"""
    got = hb.blocks(page)
    assert [b.text for b in got] == ["one bold same block <x> © é", "two", "three", "four", "five", "a", "b link", "six <3 seven", "eight"]
    assert [b.linked for b in got] == [0, 0, 0, 0, 0, 0, 4, 0, 0]
    assert [x[0] for x in got[3].path] == ["div", "p"] and [x[0] for x in got[6].path] == ["ul", "li"]


@pytest.mark.parametrize("page", ["", "<", "<<<>>>", "<p", "<p class='", "</p></div>", "<!--", "<script>", "a&b", "<a href=\"", "<p>" * 2000, "<div>" * 3000 + "x", "İ<SCRIPT>x</SCRIPT>y"])
def test_broken_pages(page):
    hx.main_text(page, hx.trained(), {})


def test_field_on_unseen_layouts():
    r = random.Random(1234)
    field = hx.trained()
    right = total = 0
    for _ in range(200):
        found, labels = hx.labelled_page(r)
        if found:
            got = hx.viterbi(hx.scores(found, field, {}), field)
            right, total = right + sum(a == b for a, b in zip(got, labels, strict=True)), total + len(labels)
    assert right >= 0.99 * total


def test_viterbi_by_brute_force():
    from itertools import product

    import numpy as np

    r = random.Random(8)
    for _ in range(200):
        n = r.randint(1, 6)
        emit = [r.gauss(0, 2) for _ in range(n)]
        field = hx.Field(np.zeros(1), np.array([[r.gauss(0, 1) for _ in range(2)] for _ in range(2)]), np.array([r.gauss(0, 1), r.gauss(0, 1)]), np.array([r.gauss(0, 1), r.gauss(0, 1)]))

        def score(y, e=emit, f=field):
            return f.first[y[0]] + f.last[y[-1]] + sum(v for v, k in zip(e, y, strict=True) if k) + sum(f.step[a, b] for a, b in zip(y, y[1:], strict=False))

        assert tuple(map(int, hx.viterbi(emit, field))) == max(product((0, 1), repeat=n), key=score)


def test_articles(spark):
    """The article of a page, read by hand from its markup."""
    rows = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in q.op3_html_extract(spark, DATA).collect()}
    for r in rows.collect():
        article = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split("<p>|</p>|</?h1>", article))
        assert got[r["page_id"]] == "\n".join(p for p in parts if p)


CLUTTER = """<html><body><header><h1>Site name</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice"><p>We use cookies on this site. Please accept them all.</p></div>
<div id="main-content"><h1>A title</h1><p>First paragraph of the article, with some words in it.</p><div class="ad-box">Buy this now.</div><p>Second paragraph.</p><ul><li>An item</li></ul></div>
<aside class="sidebar"><h3>Related</h3><p>Another story that is not this one.</p></aside><form><label>Name</label><input></form>
<section id="comments"><h2>Comments</h2><div class="comment"><p>I liked the article a lot, thank you for it.</p></div></section><footer>&copy; 2020 Site. All rights reserved.</footer></body></html>"""


def test_clutter_goes(spark):
    df = spark.createDataFrame([(1, CLUTTER, "old"), (2, None, "x"), (3, "", "y"), (1, CLUTTER, "old")], "page_id long, html string, text string")
    got = sorted((r["page_id"], r["text"]) for r in hx.extract(df).collect())
    want = "A title\nFirst paragraph of the article, with some words in it.\nSecond paragraph.\nAn item"
    assert got == [(1, want), (1, want), (2, ""), (3, "")]
    assert hx.extract(df.limit(0)).count() == 0


# Chats


def chats(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("turns", F.lit(0)).withColumn("mask", F.lit("x"))


def test_chats_read_back(spark):
    r = random.Random(4)
    pieces = ["<|im_end|>", "<|im_start|>", "<|", "|>", "\\", "\\|", "<\\|", "\n", "a", "é", "🙂", "<|im_sep|>", " ", "\\n"]
    rows = [(c, t, r.choice(["user", "assistant", "sys\ntem", "a<|b", "\\n"]), "".join(r.choices(pieces, k=r.randrange(9)))) for c in range(60) for t in range(r.randint(1, 9))]
    got = {x["conv_id"]: x for x in cf.read_back(cf.format_chats(chats(spark, rows))).collect()}
    for c in range(60):
        own = [x for x in rows if x[0] == c]
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == [(x[2], x[3]) for x in own]
        assert got[c]["loss"] == [x[3] for x in own if x[2] == "assistant"]


def test_chats_odd_rows(spark):
    rows = [(1, 2, "user", None), (1, None, "user", "first"), (1, 2, None, "x"), (None, 1, "assistant", "n"), (1, 2, "user", None), (2, 0, "assistant", "y" * 100_000)]
    got = {x["conv_id"]: [(t["role"], t["text"]) for t in x["turns"]] for x in cf.read_back(cf.format_chats(chats(spark, rows))).collect()}
    assert got == {1: [("user", "first"), ("", "x"), ("user", ""), ("user", "")], None: [("assistant", "n")], 2: [("assistant", "y" * 100_000)]}
    merged = {x["conv_id"]: x["formatted"] for x in cf.format_chats(chats(spark, rows)).collect()}[1]
    assert merged == "<|im_start|>user\nfirst<|im_end|>\n<|im_start|>\nx<|im_end|>\n<|im_start|>user\n<|im_sep|><|im_end|>\n"
    assert cf.read_back(cf.format_chats(chats(spark, rows).limit(0))).count() == 0


def test_chats_run_no_python(spark):
    plan = q.op8_chat_format(spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# Mixing


def test_water_level():
    assert sm.water_level([100, 100], [1, 1], (3, 2), 2) == [150.0, 150.0]
    got = sm.water_level([10, 1000, 1000], [5, 2, 1], (3, 2), 2)
    assert got[0] == 20 and abs(sum(got) - 3015) < 1e-6 and got[1] == 2 * got[2] - 0 or got[1] <= 2000
    assert sm.water_level([0, 0], [1, 2], (3, 2), 2) == [0.0, 0.0]
    assert sm.water_level([4, 4], [1, 1], (5, 1), 2) == [8.0, 8.0]


def cost(sent):
    return sum(k * k * w for layers in sent for k, w in enumerate(layers))


def test_flow_is_cheapest():
    """Against all ways to send whole words, on tiny networks."""
    from itertools import product

    r = random.Random(2)
    for _ in range(60):
        capacity = [r.randint(0, 3) for _ in range(2)]
        members = [tuple(sorted(r.sample(range(2), r.randint(1, 2)))) for _ in range(2)]
        quota = [r.randint(0, 5) for _ in range(2)]
        got = sm.flow(capacity, members, quota, 2)
        best = None
        ways = [[x for x in product(range(2 * c + 1), repeat=len(m)) if sum(x) <= 2 * c] for c, m in zip(capacity, members, strict=True)]
        for pick in product(*ways):
            into = [0, 0]
            for m, x in zip(members, pick, strict=True):
                for s, w in zip(m, x, strict=True):
                    into[s] += w
            if all(a <= b for a, b in zip(into, quota, strict=True)):
                price = sum(max(0, sum(x) - c) for x, c in zip(pick, capacity, strict=True))
                best = max(best or (-1, 0), (sum(into), -price))
        assert (sum(map(sum, got)), -cost(got)) == best


def test_mix_targets_are_met(spark):
    r = random.Random(3)
    rows = [(i, " ".join(["w"] * r.randint(1, 40)), r.choice(["a", "a", "a", "b", None])) for i in range(900)] + [(None, "x", "b"), (5000, None, "b"), (5000, None, "b"), (7000, "w " * 5000, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x")).withColumn("pattern", F.lit(1)).withColumn("hash", F.lit(2))
    out = sm.draw(df)
    assert out.columns == df.columns
    _, _, targets = sm.mix(df)
    got = {x["source"]: x["n"] for x in out.groupBy("source").agg(F.sum(sm.words(F.col("text"))).alias("n")).collect()}
    sizes = {x["source"]: x["source_size"] for x in targets.collect()}
    for t in targets.collect():
        assert abs(got.get(t["source"], 0) - t["target"]) <= 40 and t["target"] <= 2 * sizes[t["source"]]
    assert out.groupBy("doc_id", "text").count().where("count > 4").count() == 0
    assert sorted(map(str, sm.draw(df.repartition(7)).collect())) == sorted(map(str, out.collect()))
    assert sm.draw(df.limit(0)).count() == 0


def test_mix_of_overlapping_sources(spark):
    rows = [(i, "w " * 10, ["a", "b"] if i < 50 else ["a"] if i < 80 else ["b", "b"]) for i in range(130)] + [(999, "w", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, own array<string>").withColumn("source", F.lit("no"))
    kept, patterns, targets = sm.mix(df, sources=F.col("own"))
    want = {x["source"]: x["target"] for x in targets.collect()}
    assert set(want) == {"a", "b", None}
    sent = {tuple(x["pattern"]): x for x in patterns.collect()}
    assert set(sent) == {("a", "b"), ("a",), ("b",), (None,)}
    total = sm.draw(df, sources=F.col("own")).agg(F.sum(sm.words(F.col("text")))).first()[0]
    assert abs(total - min(sum(want.values()), 2 * 1301)) <= 40


def test_long_broken_pages_take_linear_time():
    import time

    for piece in ("<a b='", "<p class=\"", "<", "<x y=\"'", "<b>", "<div", "<!-- "):
        began = time.thread_time()
        hb.blocks(piece * (1_000_000 // len(piece)))
        hb.blocks("<p>a</p>" + piece * (1_000_000 // len(piece)) + ">")
        assert time.thread_time() - began < 60


def test_content_that_is_no_raw_text_stays():
    texts = [b.text for b in hb.blocks("<article><p>one <math><mi>x</mi></math> two</p><object><p>three</p></object><video><p>four</p><svg><text>five</text></svg><p>six <svg> seven</p></article>")]
    assert texts == ["one x two", "three", "four", "six seven"]


def test_chats_of_many_turns(spark):
    """Places in the result are counted once: a conversation of twice the turns takes some twice the time."""
    rows = spark.range(60_000).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 3 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("é<|x|> turn "), F.col("id").cast("string")).alias("text"))
    out = cf.read_back(cf.format_chats(rows)).select(F.size("turns").alias("n"), F.array_join("loss", "|").alias("loss")).first()
    assert out["n"] == 60_000 and out["loss"] == "|".join(f"é<|x|> turn {i}" for i in range(60_000) if i % 3)
