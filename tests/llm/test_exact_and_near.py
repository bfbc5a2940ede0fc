"""Exact dedup, the n-gram join and line dedup against brute force."""

from __future__ import annotations

import random
import re
import sys
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallgrass.llm import common as c
from tallgrass.llm import exact_dedup as ed
from tallgrass.llm import line_dedup as ld
from tallgrass.llm import ngram_join as nj

R = random.Random(7)
WORDS = ["".join(R.choice("abcdefghij") for _ in range(R.randint(1, 7))) for _ in range(500)]


def text(r, n):
    return " ".join(r.choices(WORDS, k=n))


def changed(r, x, k):
    w = x.split()
    for _ in range(k):
        w[r.randrange(len(w))] = r.choice(WORDS)
    return " ".join(w)


def frame(spark, rows, more="kept boolean, id long, row long, key string, best string"):
    """Rows (doc_id, text) with further columns that clash with internal names."""
    names = [x.split()[0] for x in more.split(",")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for n, x in zip(names, more.split(","), strict=True):
        df = df.withColumn(n, F.lit(None).cast(x.split()[1]))
    return df


def key(x):
    return re.sub(r"[\x20\x09-\x0D]", "", x or "")


def exact_brute(rows):
    groups = defaultdict(list)
    for i, x in rows:
        groups[key(x)].append((-len(x or ""), i is None, i or 0))
    return {k: (None if min(v)[1] else min(v)[2], len(v)) for k, v in groups.items()}


ROWS = [(1, "a b"), (2, "ab"), (3, "a\n b"), (4, None), (5, ""), (6, " \t"), (7, "x" * 300_000), (8, "x" * 299_999 + " x"), (9, "ab"), (9, "ab"), (10, "ba"), (11, "a b"), (12, "é"), (13, "é"), (14, "a\xa0b")]


@pytest.mark.parametrize("hash_all", [False, True])
def test_exact(spark, hash_all):
    got = ed.exact_dedup(frame(spark, ROWS), hash_all=hash_all).collect()
    want = exact_brute(ROWS)
    assert len(got) == len(ROWS)
    by_id = {i: x for i, x in ROWS}
    for r in got:
        keep, size = want[key(by_id[r["doc_id"]])]
        assert (r["keep_id"], r["group_size"]) == (keep, size)
        if hash_all or size > 1:
            import hashlib

            assert r["text_sha256"] == hashlib.sha256(key(by_id[r["doc_id"]]).encode()).hexdigest()
    assert sorted(r["doc_id"] for r in got if r["kept"]) == sorted(k for k, _ in want.values())


def test_exact_null_ids_and_empty(spark):
    rows = [(None, "a"), (None, "a"), (3, "a"), (None, "b")]
    got = ed.exact_dedup(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), str(r["keep_id"]), r["kept"]) for r in got) == [("3", "3", True), ("None", "3", False), ("None", "3", False), ("None", "None", True)]
    assert ed.exact_dedup(frame(spark, rows).limit(0)).count() == 0
    assert ed.drop_exact_copies(frame(spark, rows).limit(0)).count() == 0


def test_drop_exact_copies_keeps_columns(spark):
    df = frame(spark, ROWS)
    out = ed.drop_exact_copies(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(k for k, _ in exact_brute(ROWS).values())


def test_hot_keys_join(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    facts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    for hot in (1, 2, 10_000):
        out = c.attach(rows, facts, ["k"], "n", 5000, hot)
        assert out.count() == 5000 and out.where("n is null").count() == 0
        assert out.where("k = 7").agg(F.min("n"), F.max("n")).first() == (1668, 1668) or out.where("k = 7").select("n").distinct().count() == 1


def test_components_by_brute_force(spark):
    r = random.Random(5)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(230)] + [(400 + i, 401 + i) for i in range(60)] + [(9, 9)]
    up = {x: x for e in edges for x in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    got = {x["node"]: x["root"] for x in c.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}
    assert c.components(spark.createDataFrame([], "a long, b long")).count() == 0


def shingles(x, n=5):
    w = x.split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def near_brute(rows):
    """{row number: (class id, links, cluster id)}"""
    classes = defaultdict(list)
    for i, x in rows:
        classes[tuple(re.findall(r"[^\x20\x09-\x0D]+", x or ""))].append(i)
    name = {k: min((i for i in v if i is not None), default=None) for k, v in classes.items()}
    keys = list(classes)
    links, up = defaultdict(int), {k: k for k in keys}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    sets = {k: shingles(" ".join(k)) for k in keys}
    for a, b in combinations([k for k in keys if k], 2):
        both = len(sets[a] & sets[b])
        if 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            up[root(a)] = root(b)
    members = defaultdict(list)
    for k in keys:
        members[root(k)].append(name[k])
    cluster = {k: min((x for x in members[root(k)] if x is not None), default=None) for k in keys}
    return [(i, name[k], len(classes[k]), links[k], cluster[k]) for k, v in classes.items() for i in v]


def near_rows():
    r = random.Random(3)
    rows = []
    for _ in range(6):
        base = text(r, 160)
        rows += [base, base, base + " ", *(changed(r, base, k) for k in (1, 1, 2, 3, 4, 6, 9))]
    rows += [text(r, 120) for _ in range(20)] + ["", None, " \n", "one", "one two", "one two", "one two three four five", "one two three four five six"]
    r.shuffle(rows)
    return [(i, x) for i, x in enumerate(rows)]


@pytest.mark.parametrize("tile", [512, 8])
def test_near(spark, monkeypatch, tile):
    """With tiny tiles large groups are cut and meet pairwise, with the same result."""
    monkeypatch.setattr(nj, "TILE", tile)
    rows = near_rows()
    got = sorted((tuple(x) for x in nj.ngram_join(frame(spark, rows)).collect()), key=str)
    assert got == sorted(near_brute(rows), key=str)
    kept = nj.drop_near_copies(frame(spark, rows))
    assert sorted(x["doc_id"] for x in kept.collect()) == sorted({x[4] for x in near_brute(rows)})


def test_near_odd_rows(spark):
    r = random.Random(9)
    base = text(r, 100)
    rows = [(None, base), (None, base), (4, changed(r, base, 1)), (4, changed(r, base, 1)), (None, text(r, 50)), (5, text(r, 9000)), (6, "x" * 200_000)]
    got = nj.ngram_join(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    own = [x for x in got if x["class_size"] == 2 and x["doc_id"] is None]
    assert len(own) == 2 and {x["class_id"] for x in own} == {None} and {x["cluster_id"] for x in own} == {4}
    assert nj.ngram_join(frame(spark, rows).limit(0)).count() == 0
    assert nj.drop_near_copies(frame(spark, rows).limit(0)).count() == 0


def test_near_copies_of_one_id_or_none(spark):
    """Rows are dropped by id and text: an id with two texts loses only the near copy, and rows without an id are told apart."""
    r = random.Random(19)
    a, b, d = text(r, 100), text(r, 100), text(r, 100)
    rows = [(1, changed(r, a, 1)), (2, a), (2, b), (None, d), (None, d), (None, changed(r, d, 1)), (None, text(r, 60)), (7, None), (7, None), (8, "")]
    kept = sorted(((x["doc_id"], x["text"]) for x in nj.drop_near_copies(frame(spark, rows)).collect()), key=str)
    lone = sorted({x for x in rows if x[0] is None and x[1] not in (d,)}, key=str)
    assert [x for x in kept if x[0] == 1] == [rows[0]] and [x for x in kept if x[0] == 2] == [(2, b)] and [x for x in kept if x[0] in (7, 8)] == [(7, None)]
    assert sum(x[0] is None for x in kept) == 2 and rows[6] in kept and len(lone) == 2


def test_null_ids_do_not_multiply(spark, monkeypatch):
    r = random.Random(20)
    base = text(r, 40)
    rows = [(None, base if i % 2 else changed(r, base, 1)) for i in range(400)]
    met = []
    real = nj.c.by_size
    monkeypatch.setattr(nj.c, "by_size", lambda df, *a: met.append(df.count()) or real(df, *a))
    out = nj.ngram_join(frame(spark, rows))
    assert out.count() == len(rows) and out.agg(F.sum("class_size")).first()[0] >= 200 * 200
    assert met[0] <= 201


def test_pruning_spares_links():
    """The first number of equal hashes that goes on is one that a pair at the threshold almost never falls short of."""
    r = np.random.default_rng(1)
    agree = r.random((20_000, nj.HASHES)) < 0.8
    for m, need in nj.floors():
        assert (agree[:, :m].sum(1) < need).sum() == 0
    assert nj.floors()[-1][1] > 50


def test_line_dedup(spark):
    r = random.Random(11)
    long = text(r, 90)
    lines = [long, long.upper(), changed(r, long, 1), changed(r, long, 1), long + "!", "Short line.", "short  line", "--", "--", "", "unique " + text(r, 5), "ünï", "ÜNÏ"]
    rows = [(i, "\n".join(r.choices(lines, k=r.randint(1, 8)))) for i in range(1, 25)] + [(30, None), (31, ""), (32, "\n\n"), (33, long), (33, long), (None, long), (40, text(r, 5000))]
    got = ld.line_dedup(frame(spark, rows)).collect()
    seen = defaultdict(list)
    for i, x in sorted(set(rows), key=lambda p: (p[0] is None, p[0] or 0)):
        for k, y in enumerate(ld.normalised(x or "")):
            if y:
                seen[y].append((i is None, i or 0, k, i, x))
    names = list(seen)
    up = list(range(len(names)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in combinations(range(len(names)), 2):
        most = max(len(names[a]), len(names[b])) // 5
        if ld.edit_distance(names[a], names[b], most) <= most:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    groups = defaultdict(list)
    for n, name in enumerate(names):
        groups[root(n)] += seen[name]
    lost = defaultdict(set)
    for v in groups.values():
        first = min(v, key=lambda p: p[:3])
        for p in v:
            if p != first:
                lost[p[3], p[4]].add(p[2])
    assert len(got) == len(rows)
    for x in got:
        want = sorted(lost[x["doc_id"], x["text"]])
        assert x["dropped"] == want
        if x["text"] is None:
            assert x["clean"] is None and x["n_lines"] == 0
        else:
            assert x["clean"] == "\n".join(y for k, y in enumerate(x["text"].split("\n")) if k not in want)
    assert ld.line_dedup(frame(spark, rows).limit(0)).count() == 0


def test_links_of_lines_that_are_no_leaders(spark, monkeypatch):
    """Lines a, x, y, b of a block: x is left to a and y to b, and only x and y link the two."""
    sims = {1: 0, 2: (1 << 24) - 1, 3: (1 << 6) - 1, 4: (1 << 18) - 1}
    lines = spark.createDataFrame([(k, v, 100, [9]) for k, v in sims.items()], "h1 long, sim long, size int, keys array<long>")
    c.prepare(spark)
    pairs, later = ld.compared(lines)
    assert sorted(map(tuple, pairs.collect())) == [(1, 3), (1, 4), (2, 3), (2, 4)]
    assert sorted(x["node"] for x in later.collect()) == [3, 4]

    r = random.Random(5)
    word = lambda: "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    w = [word() for _ in range(30)]
    four = [" ".join(w)]
    for k in (0, 5, 10):
        w[k : k + 5] = [word() for _ in range(5)]
        four.append(" ".join(w))
    assert all(ld.alike(p, q) == (j == i + 1) for (i, p), (j, q) in combinations(enumerate(four), 2))
    place = {x: int(np.frombuffer(ld.xxhash.xxh3_128_digest(x), "<i8")[0]) for x in four}
    a, x, y, b = (place[k] for k in four)
    found = (spark.createDataFrame([(a, x), (b, y), (a, y), (b, x)], "a long, b long"), spark.createDataFrame([(9, 0, k, 0, 209) for k in sorted((x, y))], "bucket long, tile int, node long, sim long, size int"))
    monkeypatch.setattr(ld, "compared", lambda lines: found)
    got = ld.line_dedup(frame(spark, list(enumerate(four)))).orderBy("doc_id").collect()
    assert [k["n_dropped"] for k in got] == [0, 1, 1, 1]


def test_lines_put_off_make_no_more_links_than_lines(spark):
    """Alike lines that meet in three blocks, each a group of its own: links grow with the lines, not with their pairs."""
    r = random.Random(6)
    long = text(r, 100)
    names = sorted({ld.normalised(changed(r, long, 1))[0] for _ in range(60)})
    other = ld.normalised(text(r, 100))[0]
    c.prepare(spark)
    rows = [(i, x, 0) for i, x in enumerate([*names, other])]
    docs = spark.createDataFrame([(i, i, x) for i, x, _ in rows], "id long, doc long, text string")
    classes = spark.createDataFrame([(i, 0, 1, (False, i, i, 0), len(x)) for i, x, _ in rows], "h1 long, h2 long, n long, first struct<z:boolean,id:long,doc:long,line:int>, size int")
    later = spark.createDataFrame([(k, 0, i, 0, 100) for k in (7, 8, 9) for i, _, _ in rows], "bucket long, tile int, node long, sim long, size int")
    none = spark.createDataFrame([], "node long, root long")
    links = [tuple(x) for x in ld.between(docs, classes, none, later).collect()]
    assert len(names) > 40 and len(links) == len(names) - 1
    assert c.forest(len(rows), *map(np.array, zip(*links, strict=True)))[0].tolist() == [0] * len(names) + [len(names)]
    # lines of one group are not compared again
    one = spark.createDataFrame([(i, 0) for i in range(len(names))], "node long, root long")
    assert ld.between(docs, classes, one, later).count() == 0


def test_line_tiles_change_nothing(spark, monkeypatch):
    """With crowds of a few lines blocks are dealt into tiles, whose leaders meet again."""
    r = random.Random(2)
    long = text(r, 120)
    rows = [(i, changed(r, long, 1)) for i in range(300)] + [(1000 + i, text(r, 20)) for i in range(20)]
    a = sorted(map(str, ld.line_dedup(frame(spark, rows)).select("doc_id", "dropped").collect()))
    monkeypatch.setattr(ld, "CROWD", 40)
    monkeypatch.setattr(ld, "SAMPLE", 2)
    monkeypatch.setattr(ld, "TILE", 7)
    assert sorted(map(str, ld.line_dedup(frame(spark, rows)).select("doc_id", "dropped").collect())) == a


def test_lines_of_different_tiles_are_compared(spark, monkeypatch):
    """Alike lines of a crowded block, of different tiles or of SimHashes that differ in each of their parts."""
    r = random.Random(21)
    rows = []
    while len(rows) < 60:
        one = text(r, 16)
        two = [ld.normalised(x)[0] for x in (one, changed(r, one, 2))]
        batch = ld.pa.RecordBatch.from_pydict({"id": [0, 1], "doc": [0, 1], "text": two})
        a, b = next(ld.described(iter([batch]))).to_pylist()
        parts = [(a["sim"] ^ b["sim"]) >> k & 0xFFFF for k in range(0, 64, 16)]
        if ld.alike(*two) and all(parts) and sum(x.bit_count() for x in parts) <= ld.LOOSE and set(a["keys"]) & set(b["keys"]):
            rows += [(len(rows) + i, x) for i, x in enumerate(two)]
    for name, x in {"CROWD": 1, "SAMPLE": 1, "MEET": 1}.items():
        monkeypatch.setattr(ld, name, x)
    got = ld.line_dedup(frame(spark, rows)).where("n_dropped > 0").collect()
    assert sorted(x["doc_id"] for x in got) == list(range(1, 60, 2))


def test_lines_that_might_be_alike_are_found_by_meeting():
    """Of a meeting's lines those stay that have one of another group, on the other side, within LOOSE and of like length."""
    r = np.random.default_rng(4)
    base = r.integers(0, 1 << 62, 6)
    rows = sorted((int(p), i, int(base[i % 6] ^ (1 << int(r.integers(60))) ^ int(r.integers(1 << 62)) * (i % 5 == 0)), int(r.integers(60, 100)), int(r.integers(8)), int(p > 1) * (i % 2)) for i, p in enumerate(r.integers(0, 4, 400)))
    names = ["place", "node", "sim", "size", "root", "side"]
    cut = [ld.pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in rows[k : k + 70]]) for k in range(0, 400, 70)]
    got = {x["node"] for y in ld.unsettled(iter(cut)) for x in y.to_pylist()}
    sided = {x[0] for x in rows if x[5]}
    ok = lambda x, y: x[0] == y[0] and x[4] != y[4] and (x[0] not in sided or x[5] != y[5]) and (x[2] ^ y[2]).bit_count() <= ld.LOOSE and 5 * min(x[3], y[3]) >= 4 * max(x[3], y[3])
    assert got == {x[1] for p in combinations(rows, 2) if ok(*p) for x in p} and 0 < len(got) < 400


def test_packed_blocks_meet_as_rows_do(monkeypatch):
    """Blocks sent as bytes, in some parts and slices, give the rows that sorted rows of blocks give; hot blocks are left out."""
    r = np.random.default_rng(8)
    base = r.integers(-(1 << 62), 1 << 62, 9)
    lines = [(i, int(base[i % 9]) ^ int(r.integers(1 << 62) & r.integers(1 << 62) & r.integers(1 << 62)), int(r.integers(60, 80)), r.choice(base, 3).tolist()) for i in range(200)]
    lines += [lines[3], lines[4]]
    names, hot = ["node", "sim", "size", "keys"], base[:2]
    schema = ld.pa.schema([("node", ld.pa.int64()), ("sim", ld.pa.int64()), ("size", ld.pa.int32()), ("keys", ld.pa.list_(ld.pa.int64()))])
    cut = [ld.pa.RecordBatch.from_pylist([dict(zip(names, x, strict=True)) for x in lines[k : k + 30]], schema) for k in range(0, len(lines), 30)]
    rows = sorted({(b, 0, node, sim, size, 0) for node, sim, size, keys in lines for b in keys if b not in hot})
    cols = [np.array(x, np.int32 if i in (1, 4, 5) else np.int64) for i, x in enumerate(zip(*rows, strict=True))]
    want = ld.paired(cols).to_pylist()
    for pack, parts in ((100, 4), (10_000, 1), (10_000, 70_000)):
        monkeypatch.setattr(ld, "PACK", pack)
        sent = sorted((x for y in ld.packed(iter(cut), parts, hot) for x in y.to_pylist()), key=lambda x: x["part"])
        got = [x for y in ld.near_packed(iter([ld.pa.RecordBatch.from_pylist(sent)])) for x in y.to_pylist()]
        assert sorted(map(str, got)) == sorted(map(str, want)) and any(x["b"] is None for x in want)


def test_lines_are_fetched_as_they_were_normalised():
    r = random.Random(3)
    texts = [None, "", *("".join(r.choices("Ab1 .-\n\r\u03a3\u0130\u2028\x0b", k=r.randint(1, 60))) for _ in range(80))]
    wanted = [[{"node": 100 * i + k, "line": k} for k in range((x or "").count("\n") + 1) if r.random() < 0.5] for i, x in enumerate(texts)]
    batch = ld.pa.RecordBatch.from_arrays([ld.pa.array(texts), ld.pa.array(wanted, ld.pa.list_(ld.pa.struct([("node", ld.pa.int64()), ("line", ld.pa.int32())])))], ["text", "wanted"])
    got = [(x["node"], x["text"]) for y in ld.fetched(iter([batch.slice(0, 40), batch.slice(40)])) for x in y.to_pylist()]
    assert got == [(k["node"], ld.normalised(x or "")[k["line"]]) for x, own in zip(texts, wanted, strict=True) for k in own]
    one = ld.pa.RecordBatch.from_pydict({"id": list(range(82)), "doc": [0] * 82, "text": texts})
    assert [x.num_rows for x in ld.sliced(iter([one]))] == [82]


def test_long_lines_and_many_lines(spark):
    """Time grows with the lines of a text, not with their square."""
    rows = [(1, "\n".join(["same words in every line"] * 60_000)), (2, " ".join(f"w{i}" for i in range(60_000))), (3, "x" * 200_000), (4, "y\n" * 5000)]
    got = {x["doc_id"]: x for x in ld.line_dedup(frame(spark, rows)).collect()}
    assert [got[i]["n_dropped"] for i in (1, 2, 3, 4)] == [59_999, 0, 0, 4999]
    assert got[1]["clean"] == "same words in every line" and got[4]["clean"] == "y\n"


def test_edit_distance():
    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    r = random.Random(1)
    for _ in range(3000):
        a, b, most = ("".join(r.choices("abc", k=r.randrange(12))), "".join(r.choices("abc", k=r.randrange(12))), r.randrange(12))
        assert min(ld.edit_distance(a, b, most), most + 1) == min(slow(a, b), most + 1)


def test_many_edit_distances_at_once():
    """As one by one, of texts of several lengths and alphabets; and unlike ones end early."""
    r = random.Random(9)
    for letters in ("ab", "abcdefgh ", [chr(0x4E00 + i) for i in range(600)]):
        pairs = []
        for _ in range(400):
            a = "".join(r.choices(letters, k=r.randint(1, 220)))
            b = "".join(y for x in a if r.random() > 0.08 for y in ((r.choice(letters),) if r.random() < r.choice((0.02, 0.3)) else (x,))) or "q"
            pairs.append((a, b[9:] + b[:9] if r.random() < 0.2 else b, r.randrange(70)))
        want = [ld.edit_distance(a, b, 999) <= most for a, b, most in pairs]
        assert min(want.count(True), want.count(False)) > 40
        assert ld.within(*zip(*pairs, strict=True)).tolist() == want == [ld.edit_distance(*x) <= x[2] for x in pairs]

    a, b = ("".join(r.choices("abcdefgh", k=4_000)) for _ in range(2))
    steps = [0]

    def count(frame, event, arg):
        steps[0] += event == "line" and frame.f_code is ld.edit_distance.__code__
        return count

    old = sys.gettrace()
    sys.settrace(count)
    try:
        assert ld.edit_distance(a, b, 800) == 801
    finally:
        sys.settrace(old)
    assert steps[0] < 8 * 4_000


def test_components_end_once_all_are_stars(spark, monkeypatch):
    """No round is spent on edges that are stars already; chains, rings and no edges at all come out right."""
    written = []
    stored = c.stored
    monkeypatch.setattr(c, "stored", lambda df: written.append(1) or stored(df))
    stars = [(10 * k, 10 * k + i) for k in range(4) for i in range(1, 6)]
    assert {tuple(x) for x in c.components(spark.createDataFrame(stars, "a long, b long")).collect()} == {(b, a) for a, b in stars} | {(a, a) for a, _ in stars}
    assert len(written) == 3
    chain = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101), (101, 100), (205, 201), (205, 203), (204, 203)]
    want = {(i, 0) for i in range(41)} | {(i, 100) for i in (100, 101, 102)} | {(i, 201) for i in (201, 203, 204, 205)}
    assert {tuple(x) for x in c.components(spark.createDataFrame(chain, "a long, b long")).collect()} == want
    assert not c.components(spark.createDataFrame([], "a long, b long")).collect()


def test_few_lines_are_told_apart_by_tables_of_their_own(monkeypatch):
    """Lines of other letters meet no table, and those of several leaders, or of several places, are measured together."""
    r = random.Random(21)
    one = lambda letters, k=300: "".join(r.choices(letters, k=k))
    base = [one("abcdefgh") for _ in range(40)]
    near = ["".join(y for x in b for y in ((x, r.choice("abcdefgh")) if r.random() < 0.1 else (x,)))[: len(b)] for b in base]
    want = [ld.edit_distance(a, b, 999) <= ld.allowed(a, b) for a, b in zip(base, near, strict=True)]
    assert 0 < sum(want) < 40
    words, single = [], []
    plainly, edit_distance = ld.plainly, ld.edit_distance
    monkeypatch.setattr(ld, "plainly", lambda a, b, most: words.append(1) or plainly(a, b, most))
    monkeypatch.setattr(ld, "edit_distance", lambda a, b, most: single.append(1) or edit_distance(a, b, most))
    rows = []
    for i, (a, b) in enumerate(zip(base, near, strict=True)):
        rows += [(i, 0, i, a), (i, 0, 100 + i, b), (i, 0, 200 + i, one("stuvwxyz"))]
    batches = [ld.pa.RecordBatch.from_pylist([dict(zip(("leader", "part", "node", "text"), x, strict=True)) for x in rows[k : k + 7]]) for k in range(0, len(rows), 7)]
    got = sorted(tuple(x.values()) for y in ld.verified(iter(batches)) for x in y.to_pylist())
    assert got == [(i, 100 + i) for i in range(40) if want[i]] and len(words) == 40 and not single
    words.clear()
    schema = ["place", "node", "sim", "size", "root", "places", "text"]
    rows = [(i, 3 * i + k, 0, len(x), 3 * i + k, [i], x) for i in range(40) for k, x in enumerate((base[i], near[i], one("stuvwxyz")))]
    got = sorted(tuple(x.values()) for y in ld.settled(iter([ld.pa.RecordBatch.from_pylist([dict(zip(schema, x, strict=True)) for x in rows])])) for x in y.to_pylist())
    assert got == [(3 * i, 3 * i + 1) for i in range(40) if want[i]] and len(words) == 40 and not single
    assert not ld.within(["ab", "x" * 900], ["abc" * 300, "xyz"], [5, 5]).any()


def test_groups_that_meet_often_are_measured_once(spark, monkeypatch):
    """Lines of two groups of unlike lines are told apart by the distance of the groups' first lines; links are of roots."""
    r = random.Random(14)
    w = r.choices(WORDS, k=120)
    far = [*w[:60], *r.choices(WORDS, k=60)]
    names = [(k, ld.normalised(" ".join(x[:i] + ["q" * 3] + x[i + 1 :]))[0]) for k, x in ((0, w), (100, far)) for i in range(20)]
    rows = [(9, i, 0, 500, root, [9], x) for i, (root, x) in enumerate(names)]
    schema = ["place", "node", "sim", "size", "root", "places", "text"]
    batch = lambda rows: ld.pa.RecordBatch.from_pylist([dict(zip(schema, x, strict=True)) for x in rows])
    met = []
    real = ld.plainly
    monkeypatch.setattr(ld, "plainly", lambda a, b, most: met.append(1) or real(a, b, most))
    assert not list(ld.settled(iter([batch(rows)]))) and len(met) <= ld.OFTEN
    # one line between them links the two by their roots
    between = ld.normalised(" ".join([*far[:90], *w[90:]]))[0]
    got = [tuple(x.values()) for y in ld.settled(iter([batch([*rows, (9, 40, 0, 500, 200, [9], between)])])) for x in y.to_pylist()]
    want = {root for root, x in names if ld.alike(x, between)}
    assert {root for pair in got for root in pair} == (want | {200} if want else set())


def test_the_last_join_does_not_depend_on_size(spark):
    rows = [(1, "same line here"), (2, "same line here")]
    out = ld.line_dedup(frame(spark, rows))
    assert "broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [x["n_dropped"] for x in out.orderBy("doc_id").collect()] == [0, 1]


def test_bound_of_edit_distance():
    r = random.Random(3)
    exact = 0
    for _ in range(2000):
        x = r.choices(["a", "bb", "ccc", "dddd", "bc", "ca", "eeeee", "f"], k=r.randint(1, 20))
        y = list(x)
        for _ in range(r.randrange(4)):
            k = r.randrange(len(y) + 1)
            y[k : k + r.randrange(3)] = r.choices(["a", "zz", "ccc"], k=r.randrange(3))
        if y:
            most = r.randrange(60)
            own = ld.edit_distance(" ".join(x), " ".join(y), 999)
            assert (got := ld.bound(x, y, most)) >= own or got > most
            exact += got == own
    assert exact > 500
    assert ld.bound(["a"] * 5, ["a"] * 3, 9) == 4 and ld.bound(["b", "a", "c"], ["a", "c"], 9) == 2


def test_alike_is_the_edit_distance():
    r = random.Random(4)
    found = [0, 0]
    for _ in range(1500):
        a = text(r, r.randint(1, 30))
        b = "".join(y for x in a if r.random() > 0.08 for y in ((r.choice("abc d"),) if r.random() < r.choice((0.02, 0.15)) else (x,)))
        b = " ".join(b.split()) if r.random() < 0.8 else text(r, r.randint(1, 30))
        if b:
            most = int(max(len(a), len(b)) * (1 - ld.LEAST))
            want = ld.edit_distance(a, b, most) <= most
            assert ld.alike(a, b) == want
            found[want] += 1
    assert min(found) > 200


def test_alike_lines_are_found_by_edit_similarity_alone(spark):
    r = random.Random(13)
    words = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=r.randint(2, 10))) for _ in range(3000)]
    pairs = []
    while len(pairs) < 300:
        w = r.choices(words, k=r.randint(8, 100))
        x = " ".join(w)
        for k in r.sample(range(len(w)), r.randint(1, max(1, len(w) // 7))):
            w[k] = r.choice(words)
        if x != " ".join(w) and ld.alike(x, " ".join(w)):
            pairs.append((x, " ".join(w)))
    rows = [(2 * i + k, x) for i, pair in enumerate(pairs) for k, x in enumerate(pair)]
    lost = {x["doc_id"] for x in ld.line_dedup(frame(spark, rows)).collect() if x["n_dropped"]}
    assert all(i % 2 for i in lost)
    assert len(lost) >= 0.98 * len(pairs)


def test_recall_on_documents():
    """Of the pairs of lines that are alike by edit similarity, found without any hash, blocks bring nine in ten together."""
    import pyarrow.parquet as pq

    names = sorted({y for x in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist() for y in ld.normalised(x or "") if y}, key=len)
    r = random.Random(21)
    for x in r.sample(names, 300):
        w = x.split(" ")
        for k in r.sample(range(len(w)), max(1, len(w) // r.choice((8, 12, 20, 40))) if len(w) > 4 else 1):
            w[k] = r.choice((w[k][::-1], r.choice(WORDS), w[k] + "s", ""))
        names.append(" ".join(y for y in w if y) or "x")
    names = sorted(set(names), key=len)
    letters = "abcdefghijklmnopqrstuvwxyzäöüßéèñ 0123456789"
    count = np.array([[x.count(y) for y in letters] for x in names])
    size = np.array([len(x) for x in names])
    alike = set()
    for i in range(len(names)):
        js = i + 1 + np.flatnonzero((size[i + 1 :] * 4 <= size[i] * 5) & (np.abs(count[i + 1 :] - count[i]).sum(1) <= 0.4 * size[i + 1 :]))
        for j in js.tolist():
            most = len(names[j]) // 5
            if ld.edit_distance(names[i], names[j], most) <= most:
                alike.add((i, j))
    line, h, long = ld.hashed(ld.folded("\n".join(names)))
    sim = ld.simhash(line, h, long)
    keys = defaultdict(set)
    for a, b in zip(*(x.tolist() for x in ld.block_keys(names, line, h)), strict=True):
        keys[a].add(b)
    met = {(i, j) for i, j in alike if keys[i] & keys[j] and (int(sim[i]) ^ int(sim[j])).__and__((1 << 64) - 1).bit_count() <= ld.LOOSE}
    assert len(alike) > 250 and len(met) >= 0.95 * len(alike)


def word_hash(x):
    h, low = sum(ord(y) * pow(ld.ODD, i, 1 << 64) for i, y in enumerate(x)), (1 << 64) - 1
    for more in (0, 1):
        h = h + more & low
        h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 & low
        h ^= h >> 32
    return h


def test_hashes_take_lines_of_any_length(monkeypatch):
    r = random.Random(5)
    lines = [text(r, k).split(" ") for k in (1, 3, 700, 40, 40, 40)] + [["é" * 30_000], ["a"]]

    def hashes(some):
        line, h, long = ld.hashed(ld.folded("\n".join(map(" ".join, some))))
        return line, h, ld.simhash(line, h, long)

    one = [hashes([x]) for x in lines]
    for x, (_, h, sim) in zip(lines, one, strict=True):
        assert h.tolist() == list(map(word_hash, x))
        own = [y for y in x if len(y) > ld.SMALL] or x
        bits = np.array([[y >> k & 1 for k in range(63, -1, -1)] for y in map(word_hash, own)]).sum(0) * 2 > len(own)
        assert int("".join(map(str, bits.astype(int))), 2) == int(sim[0]) & ((1 << 64) - 1)
    monkeypatch.setattr(ld, "SLICE", 800)
    ld._powers.cache_clear()
    line, h, sim = hashes(lines)
    ld._powers.cache_clear()
    assert (sim == np.concatenate([x[2] for x in one])).all() and (h == np.concatenate([x[1] for x in one])).all()
    names = list(map(" ".join, lines))
    at, keys = ld.block_keys(names, line, h)
    assert all(set(keys[at == i].tolist()) == set(ld.block_keys([x], o[0], o[1])[1].tolist()) for i, (x, o) in enumerate(zip(names, one, strict=True)))


def test_lines_are_normalised_as_a_plain_loop_would(spark):
    def plain(x):
        return [" ".join("".join(y if y.isalnum() else " " for y in z).split()) for z in x.lower().split("\n")]

    r = random.Random(8)
    texts = ["", "\n", " \n ", "a \n b  c", "ΑΣ", "ΣΑ Σ", "x y_z\r\nİ", "\n\na\tb", "é" * 300_000 + " q"] + ["".join(r.choices("aB9 \n.Σ-ü", k=r.randrange(60))) for _ in range(500)]
    assert all(ld.normalised(x) == plain(x) for x in texts)
    rows = ld.pa.RecordBatch.from_pydict({"id": [*range(len(texts))], "doc": [*range(len(texts))], "text": texts})
    got = [(x["id"], x["line"], x["size"]) for y in ld.described(iter([rows])) for x in y.to_pylist()]
    assert got == [(i, k, len(y)) for i, x in enumerate(texts) for k, y in enumerate(plain(x)) if y]
