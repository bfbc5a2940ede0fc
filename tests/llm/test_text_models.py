"""Quality rules, class-based scores, BPE and language identification."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import DATA
from pyspark.sql import functions as F

from tallgrass.llm import byte_bpe as bb
from tallgrass.llm import class_lm as cl
from tallgrass.llm import language_id as li
from tallgrass.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "a b " * 40), (6, "x\x85y\xa0z\x1cw"), (7, "é" * 50_000), (8, "line\nline\n\n line"), (8, "line\nline\n\n line"), (None, "# * $ % & | < >")]


def frame(spark, rows=ODD):
    """With columns that clash with those that the operators add."""
    return spark.createDataFrame([(i, x, None, "s", 1, 2.0, "u") for i, x in rows], "doc_id long, text string, lang string, source string, n_words int, score double, bpe string").withColumn("language", F.lit(1)).withColumn("level", F.lit(2))


def basics(x):
    w = WORD.findall(x or "")
    seen, dup = set(), 0
    for y in (x or "").split("\n"):
        if WORD.search(y):
            dup += y in seen
            seen.add(y)
    grams = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    on = set()
    for i in range(len(w) - 7):
        if grams[tuple(w[i : i + 8])] > 1:
            on.update(range(i, i + 8))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x or "")), dup, len(on)


def test_quality_base(spark):
    r = random.Random(1)
    rows = [*ODD, *((100 + i, " ".join(r.choices("ab", k=r.randint(0, 60)))) for i in range(60)), *((300 + i, "\n".join(" ".join(r.choices("abc", k=3)) for _ in range(9))) for i in range(20))]
    got = sorted(map(tuple, qr.quality_rules(frame(spark, rows)).collect()), key=str)
    want = []
    for i, x in rows:
        n, *rest = basics(x)
        bad = n < 20 or 100 * rest[-1] > 30 * n
        want.append((i, n, *rest, bad))
    assert sorted((g[:7] for g in got), key=str) == sorted(want, key=str)
    assert not any(g[7] and g[6] for g in got)
    assert qr.quality_rules(frame(spark).limit(0)).count() == 0 and qr.drop_bad(frame(spark).limit(0)).count() == 0


def test_quality_verdicts(spark):
    from pyspark.sql import DataFrame

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out: DataFrame = qr.quality_rules(docs).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    good, bad = out.where("quality = 1 and not base_failed"), out.where("quality = 0")
    assert good.where("not kept").count() == 0
    assert bad.where("kept").count() <= 0.03 * bad.count()
    kept = qr.drop_bad(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(r["doc_id"] for r in qr.quality_rules(docs).where("kept").collect())


def brute_verdicts(rows):
    """{row number: kept} by exact quantiles, for rows (counts by name, lang, source)."""
    value = lambda n, x: (lambda a, b, _: n[a] / n[b] if n[b] else 0.0)(*qr.RATES[x])
    good = [i for i, (n, _, _) in enumerate(rows) if not (n["n_words"] < 20 or 100 * n["n_repeat_words"] > 30 * n["n_words"])]
    out = {i: i in set(good) for i in range(len(rows))}

    def at(own, p):
        return sorted(own)[max(0, math.ceil(p * len(own)) - 1)]

    def facts(own, x, parent):
        got = [value(rows[i][0], x) for i in own]
        mid, spread = at(got, 0.5), at(got, qr.UPPER) - at(got, 0.5)
        if parent is None:
            return mid, spread
        w = len(own) / (len(own) + qr.PARENT)
        return w * mid + (1 - w) * parent[0], min(w * spread + (1 - w) * parent[1], qr.SLACK * max(parent[1], qr.RATES[x][2]))

    for x, (_, _, least) in qr.RATES.items():
        top = facts(good, x, None)
        for lang in {rows[i][1] for i in good}:
            middle = facts([i for i in good if rows[i][1] == lang], x, top)
            for source in {rows[i][2] for i in good if rows[i][1] == lang}:
                own = [i for i in good if rows[i][1:] == (lang, source)]
                mid, spread = facts(own, x, middle)
                for i in own:
                    out[i] &= value(rows[i][0], x) <= mid + qr.TIMES * max(spread, least)
    return out


def test_verdicts_by_exact_quantiles(spark):
    """Every rate fires, cutoffs differ between groups, and each verdict is that of exact quantiles."""
    r = random.Random(8)
    names = ["".join(r.choices("abcdefgh", k=k)) for k in (2, 3, 4, 5, 6, 7, 8) for _ in range(80)]
    rows = []
    for i in range(700):
        lang, source = r.choice(("en", "en", "de", None)), r.choice(("a", "a", "a", "b", None))
        w = r.choices(names, k=r.randint(60, 200))
        w = [x * 2 if lang == "de" and r.random() < 0.3 else x for x in w]
        w = [x.upper() if r.random() < (0.05 if source == "b" else 0.02) else x for x in w]
        kind = i % 20
        if kind == 0:
            w = [x + "#" if r.random() < 0.5 else x for x in w]
        elif kind == 1:
            w = [x * 5 for x in w]
        elif kind == 2:
            w = [y for x in w for y in ([x, x] if r.random() < 0.4 else [x])]
        elif kind == 3:
            w = [x.upper() for x in w]
        elif kind == 4:
            w = [x.lower() for x in w[:14] + r.choices(names, k=67) + w[:14]]
        text = " ".join(w)
        if kind == 5:
            text = "\n".join([" ".join(w[:9]), "same", "same", "same", "same", " ".join(w[9:])])
        rows.append((i, text, lang, source, 0.5))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n double")
    counts = [dict(zip(qr.COUNTS, qr.counts(x[1]), strict=True)) for x in rows]
    got = {x["doc_id"]: x["kept"] for x in qr.quality_rules(df).collect()}
    assert got == brute_verdicts([(n, x[2], x[3]) for n, x in zip(counts, rows, strict=True)])
    measured = qr.measured(df).select("__tg_q", "lang", "source").where(~qr.base_failed())
    low, _, _ = qr.learn(measured)
    cuts = {(x["lang"], x["source"]): x["cuts"] for x in low.collect()}
    assert len(cuts) == 9
    for x in ("upper_rate", "word_length", "echo_rate"):
        assert len({round(v[x], 9) for v in cuts.values()}) > 5
    fired = {x for n, (_, _, lang, source, _) in zip(counts, rows, strict=True) for x, (a, b, _) in qr.RATES.items() if n["n_words"] >= 20 and n[a] / max(1, n[b]) > cuts[lang, source][x]}
    assert fired == set(qr.RATES)


def test_a_group_is_judged_alike_whatever_else_there_is(spark):
    """Ten times as many documents like all the others change no verdict."""
    r = random.Random(4)
    rows = [(" ".join("".join(r.choices("abcdef", k=r.randint(2, 9))) for _ in range(60)) + (" ###" * 30 if i % 9 == 0 else ""), r.choice(("x", "y")), r.choice(("a", "b"))) for i in range(300)]
    one = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "doc_id long, text string, lang string, source string")
    ten = one.crossJoin(spark.range(10).withColumnRenamed("id", "n"))
    few = {x["doc_id"]: x["kept"] for x in qr.quality_rules(one).collect()}
    assert {x["doc_id"]: x["kept"] for x in qr.quality_rules(ten).collect()} == few and False in few.values()


def test_class_scores(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").limit(80)
    rows = [(r[0], r[1]) for r in docs.collect()] + [(10_000 + n, x) for n, (_, x) in enumerate(ODD[:6])]
    held = F.col("doc_id") % 7 == 2
    got = {r["doc_id"]: r for r in cl.class_lm(frame(spark, rows), held).collect()}
    low = lambda x: [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(x or "")]
    count = Counter(w for i, x in rows if i % 7 != 2 for w in [*low(x), None])
    total, types = sum(count.values()), len(count)
    for i, x in rows:
        w = [*low(x), None]
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(w), sum(count[k] > 0 for k in w), total, i % 7 == 2)
        assert math.isclose(r["base_score"], sum(math.log10((count[k] + 1) / (total + types + 1)) for k in w), rel_tol=1e-9)
    out = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_class_scores_without_training(spark):
    rows = cl.class_lm(frame(spark), F.lit(True)).collect()
    assert len(rows) == len(ODD) and all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in rows)
    assert cl.class_lm(frame(spark).limit(0), F.lit(False)).count() == 0


def test_class_probabilities_sum_to_one():
    r = np.random.default_rng(2)
    model = cl.Model(np.zeros(5, np.uint8), r.integers(0, 5, (cl.CLASSES, cl.CLASSES)), np.ones(cl.CLASSES))
    assert np.allclose((10**model.step).sum(1), 1)


def test_score_by_brute_force(spark, monkeypatch):
    """The score of every text from classes that a plain version of both steps gives, on a small corpus."""
    monkeypatch.setattr(cl, "SEEN", 3)
    r = random.Random(6)
    names = ["".join(r.choices("abcdefgh", k=3)) for _ in range(40)]
    rows = [(i, " ".join(r.choices(names, weights=range(1, 41), k=30))) for i in range(60)] + [(90, None), (91, "never seen")]
    texts = {i: [w.encode() for w in (x or "").split()] for i, x in rows}
    train = [w for i, w in texts.items() if i % 5]
    count = Counter(w for x in train for w in x)
    order = sorted(count, key=lambda w: (-count[w], cl.signed(w)))[: cl.FREQUENT]
    unit = {w: 1 + i for i, w in enumerate(order[: cl.TOP])}
    of = lambda w: unit.get(w) or 1 + cl.TOP + cl.bucket(w)
    pairs = np.zeros((cl.UNITS, cl.UNITS), np.int64)
    for x in train:
        for a, b in zip([0, *map(of, x)], [*map(of, x), 0], strict=True):
            pairs[a, b] += 1
    cls = cl.exchange(pairs)
    first = {w: int(cls[of(w)]) for w in count}

    def fitted(c):
        grid = np.zeros((cl.CLASSES, cl.CLASSES))
        for x in train:
            for a, b in zip([0, *(c[w] for w in x)], [*(c[w] for w in x), 0], strict=True):
                grid[a, b] += 1
        return grid, cl.Model(np.zeros(1), grid, np.bincount([0, *c.values()], minlength=cl.CLASSES))

    grid, model = fitted(first)
    second = dict(first)
    for w in count:
        if count[w] >= 3:
            gain = np.zeros(cl.CLASSES)
            for x in train:
                for k in (k for k, y in enumerate(x) if y == w):
                    gain += model.step[first[x[k - 1]] if k else 0] - model.below
                    gain += model.step[:, first[x[k + 1]] if k + 1 < len(x) else 0]
            # the emission is divided by once for each time that the word occurs
            gain[0] = -np.inf
            second[w] = int(gain.argmax())
    better, other = fitted(second)
    c, model = (second, other) if cl.likelihood(better) > cl.likelihood(grid) else (first, model)
    got = {x["doc_id"]: x["score"] for x in cl.class_lm(frame(spark, rows), F.col("doc_id") % 5 == 0).collect()}
    for i, x in texts.items():
        k = [0, *(c.get(w, int(cls[of(w)])) for w in x), 0]
        want = sum(model.step[a, b] - model.below[b] for a, b in zip(k, k[1:], strict=False)) + sum(math.log10(count[w] + 1) for w in x) + math.log10(len(train) + 1)
        assert math.isclose(got[i], want, rel_tol=1e-9), i


def test_exchange_finds_alternation():
    """Words of two kinds that always alternate end in two classes."""
    n = 21
    pairs = np.zeros((n, n), np.int64)
    for a in range(1, n):
        for b in range(1, n):
            if (a + b) % 2:
                pairs[a, b] = 10
    of = cl.exchange(pairs, classes=3)
    assert of[0] == 0 and len(set(of[1::2])) == 1 and len(set(of[2::2])) == 1 and of[1] != of[2]


def test_words_beyond_the_top_have_classes_of_their_own(spark):
    """Words of two kinds that alternate, all rarer than TOP others and with endings that tell nothing."""
    r = random.Random(3)
    names = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(1600)]
    often, one, two = names[:cl.TOP], names[600:1100], names[1100:]
    texts = [" ".join(r.sample(often, len(often))) for _ in range(60)]
    texts += [" ".join(x for _ in range(100) for x in (r.choice(one), r.choice(two))) for _ in range(150)]
    pairs = [(r.choice(one), r.choice(two)) for _ in range(300)]
    swapped = " ".join(x for a, b in zip(pairs[::2], pairs[1::2], strict=True) for x in (a[0], b[0], a[1], b[1]))
    rows = [*enumerate(texts), (9001, " ".join(x for p in pairs for x in p)), (9002, swapped)]
    got = {x["doc_id"]: x["score"] for x in cl.class_lm(frame(spark, rows), F.col("doc_id") > 9000).collect()}
    assert got[9001] - got[9002] > 400


def test_frequent_words_stay_under_the_bound(spark):
    vocabulary = spark.range(1, 5001).select(F.col("id").alias("h"), F.lit(0).alias("ending"), (F.lit(100_000) / F.col("id")).cast("long").alias("n"))
    got = cl.frequent(vocabulary, 300).column("n").to_pylist()
    assert 250 < len(got) <= 300 and got == sorted(got, reverse=True)
    assert cl.frequent(vocabulary, 300).column("h")[0].as_py() == 1 and cl.frequent(vocabulary.limit(0), 10).num_rows == 0
    equal = vocabulary.withColumn("n", F.lit(7).cast("long"))
    assert 4900 < cl.frequent(equal, 4990).num_rows <= 4990 and cl.frequent(equal, 5000).num_rows == 5000


@pytest.fixture(scope="module")
def coder():
    return bb.Encoder(bb.read_ranks(RANKS), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def judge():
    ranks = {t: i for i, t in enumerate(bb.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash(coder):
    keys = coder.tokens
    assert sorted(coder.hash.values) == list(range(len(keys)))
    assert all(coder.hash.get(k) == i for i, k in enumerate(keys))
    assert all(coder.hash.get(k + b"\xff\xfe\x00q") == -1 for k in keys[::50])
    assert bb.PerfectHash([]).get(b"x") == -1 and bb.PerfectHash([b"a"]).get(b"a") == 0


def test_bpe_as_the_library(coder, judge):
    r = random.Random(1)
    signs = " \n\t'sdléß\x1c\x85　 12٣a字́..!🙂|A\r<>endoftext"
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(30))) for _ in range(4000)]
    texts += ["<|endoftext|>", "a" * 5000, " " * 3000, "ab" * 4000 + "!", "don't  stop \n now", "\n" * 500 + "x", " lead", "trail ", "tab\tx  y"]
    for x in texts:
        ids = coder.encode(x)
        assert np.frombuffer(ids, "<u4").tolist() == judge.encode_ordinary(x)
        assert coder.decode(ids) == x.encode()


def test_short_words_are_merged_without_a_heap(coder, judge, monkeypatch):
    r = random.Random(9)
    words = ["".join(r.choices("etaoinsrhläß語", k=r.randint(1, 90))) for _ in range(400)]
    made, real = [], bb.heapq.heapify
    monkeypatch.setattr(bb.heapq, "heapify", lambda x: made.append(len(x)) or real(x))
    for x in words:
        if coder.hash.get(x.encode()) < 0:
            assert coder.merge(x.encode()).tolist() == judge.encode_ordinary(x)
    assert 0 < len(made) <= sum(len(x.encode()) > bb.SHORT for x in words) < len(words) - 100


def test_bpe_memo_turns_over(coder, judge, monkeypatch):
    monkeypatch.setattr(bb, "MEMO", 900)
    x = " ".join(f"word{i % 13} and {i}" for i in range(200))
    assert np.frombuffer(coder.encode(x), "<u4").tolist() == judge.encode_ordinary(x)


def test_bpe_frames(spark, judge):
    docs = frame(spark)
    rows = bb.with_ids(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        ids = judge.encode_ordinary(r["text"] or "")
        assert (r["bpe"]["n_tokens"], r["bpe"]["ids"]) == (len(ids), ids)
        assert r["bpe"]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["bpe"]["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert bb.with_ids(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
    back = bb.decode(bb.with_ids(docs, RANKS, public_tokenizers.PATTERN).select("text", "bpe.ids"), RANKS)
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back.collect())


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").withColumn("held", li.held_out(F.col("doc_id")))
    assert {r["doc_id"] for r in docs.where("held").collect()} == {r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    model = li.train(docs.where("not held"))
    out = li.predict(docs.where("held"), model)
    assert out.where("language.lang_pred = lang").count() >= 0.98 * out.count()
    odd = {r["doc_id"]: r["language"] for r in li.predict(frame(spark), model).collect()}
    assert [odd[i]["lang_pred"] for i in (1, 2, 3, None)] == ["und"] * 4 and odd[7]["lang_pred"] != "und"
    assert all(0 <= r["score"] <= 1 for r in odd.values())
    assert li.predict(frame(spark).limit(0), model).count() == 0


def test_language_counts_are_those_of_a_plain_model(spark):
    rows = [(1, "Aa b", "x"), (2, "b, B!", "y"), (3, None, "y"), (4, "zz", None), (5, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    classes, prior, table = li.train(df)
    assert classes == ["x", "y"] and np.allclose(prior, np.log([0.5, 0.5]))
    count = np.full((2, 1 << li.BITS), li.ALPHA)
    for _, x, y in rows:
        if y:
            np.add.at(count[classes.index(y)], li.features(li.codes(x or "")), 1)
    assert np.allclose(table, (np.log(count) - np.log(count.sum(1, keepdims=True))).T, atol=1e-4)
    none = li.train(df.limit(0))
    assert li.predict(df, none).first()["language"]["lang_pred"] == "und"


def test_too_many_classes(spark, monkeypatch):
    monkeypatch.setattr(li, "MOST_CLASSES", 3)
    df = spark.range(5).select(F.col("id").cast("string").alias("lang"), F.lit("a").alias("text"))
    with pytest.raises(ValueError, match="more than 3"):
        li.train(df)
