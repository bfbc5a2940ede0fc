"""Line operators against plain state machines, and the cases that separate them."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tallgrass.operators import extract, lines

ALIASES = [("RedThing", ["red thing", "RedThing"]), ("Blue", ["blue", "navy"]), ("Green", ["green", "navy"])]


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_split_lines_like_python(spark):
    texts = ["a\nb", "a\n", "", "\n", "a\r\nb\rc\x0bd\x0ce\x1cf\x1dg\x1eh\x85i j k", "x\n\n\ny\n\n", "  a  b \n\tc ", None, "\n\n"]
    got = [r["l"] for r in docs(spark, *texts).select("doc_id", lines.split_lines(F.col("text")).alias("l")).orderBy("doc_id").collect()]
    assert got == [[" ".join(x.split()) for x in (s or "").splitlines()] for s in texts]


def test_heading_like_python(spark):
    r = random.Random(4)
    texts = ["".join(r.choice("aB cDé9-.Ü ß") for _ in range(r.randrange(1, 14))) for _ in range(400)] + ["Foo-Bar", "It'S", "A", "İ x", "STRASSE", "straße"]
    texts = [" ".join(x.split()) for x in texts if x.strip()]

    def heading(x):
        return (x.upper() == x and len(x.split()) <= 10) or (x.istitle() and len(x.split()) <= 5)

    from tallgrass.functions.text import is_heading

    got = [r["h"] for r in docs(spark, *texts).select("doc_id", is_heading(F.col("text")).alias("h")).orderBy("doc_id").collect()]
    assert got == [heading(x) for x in texts]


def state_machine(rows):
    """Places in a section, from (marker, stop) flags read one by one."""
    out, inside = set(), False
    i = 0
    while i < len(rows):
        if rows[i][0]:
            i += 1
            while i < len(rows) and not rows[i][1]:
                out.add(i)
                i += 1
            continue
        i += 1
    return out


def test_sections_by_brute_force(spark):
    cases = [c for n in range(1, 6) for c in itertools.product(((0, 0), (0, 1), (1, 0), (1, 1)), repeat=n)]
    rows = [(k, i, bool(m), bool(s)) for k, c in enumerate(cases) for i, (m, s) in enumerate(c)]
    df = spark.createDataFrame(rows, "doc_id long, line_no int, m boolean, s boolean")
    got = {(r["doc_id"], r["line_no"]) for r in df.withColumn("x", lines.in_section(F.col("m"), F.col("s"))).where("x").collect()}
    assert got == {(k, i) for k, c in enumerate(cases) for i in state_machine(c)}


def test_pairs_by_brute_force(spark):
    cases = [c for n in range(1, 9) for c in itertools.product((False, True), repeat=n)]
    rows = [(k, i, f"s{i}", o) for k, c in enumerate(cases) for i, o in enumerate(c)]
    df = spark.createDataFrame(rows, "g long, i int, s string, o boolean")
    want = set()
    for k, c in enumerate(cases):
        pending = None
        for i, o in enumerate(c):
            if pending is not None:
                want.add((k, f"s{i}", f"s{pending}"))
                pending = None
            elif o:
                pending = i
    assert {tuple(r) for r in lines.pairs_of_runs(df, "g", ["i"], F.col("o"), "s").collect()} == want


def test_fill_forward(spark):
    text = "before\nnavy first\nmore\n\nred thing here\nand so\nblue again\nend"
    got = {r["name"]: (r["first_line"], r["evidence"], r["block"]) for r in lines.blocks(lines.with_matches(lines.explode_lines(docs(spark, text)), ALIASES)).collect()}
    assert got == {"Blue": (1, "navy first", "navy first more blue again end"), "RedThing": (4, "red thing here", "red thing here and so")}


@pytest.mark.parametrize(("text", "want"), [
    ("Includes cover for\nred thing\nblue", {("Covered", "RedThing", "red thing"), ("Covered", "Blue", "blue")}),
    ("Restricted cover\nred thing\n\nblue", {("Restricted", "RedThing", "red thing")}),
    ("Restricted cover\nnot included\nblue", {("Restricted", "Blue", "blue"), ("Excluded", "Blue", "blue")}),
    ("Restricted cover\nincludes cover for: x\nblue", {("Covered", "Blue", "blue")}),
    ("Restricted cover\nBlue Green\nred thing", set()),
    ("Restricted cover\n12\nred thing", set()),
    ("Restricted cover\none two three four five six seven eight nine\nblue", set()),
    ("Restricted cover\none two three four five six seven eight blue\nred thing", {("Restricted", "Blue", "one two three four five six seven eight blue"), ("Restricted", "RedThing", "red thing")}),
    ("Restricted cover\nblue one\nblue two", {("Restricted", "Blue", "blue two")}),
])
def test_sections(spark, text, want):
    rows = lines.with_matches(lines.explode_lines(docs(spark, text)), ALIASES[:2])
    got = {(r["status"], r["name"], r["evidence"]) for r in lines.section_items(rows).collect()}
    assert got == want


def test_excluded_goes_before_covered(spark):
    text = "it includes cover for blue\nServices not included\nblue\n"
    rows = {r["category"]: (r["coverage"], r["evidence"]) for r in extract.hospital_cover(docs(spark, text), ALIASES).collect()}
    assert rows == {"RedThing": (None, []), "Blue": ("Excluded", ["it includes cover for blue", "blue", "blue"]), "Green": (None, [])}


@pytest.mark.parametrize(("text", "want"), [
    ("silver\nplus", "SilverPlus"), ("silver\n\nplus", "Silver"), ("silver  +", "SilverPlus"), ("\n" * 39 + "gold", "Gold"), ("\n" * 40 + "gold", None), ("golden", None),
])
def test_tier(spark, text, want):
    assert extract.heads(docs(spark, text)).first()["hospital_tier"] == want


@pytest.mark.parametrize(("text", "want"), [
    ("plain words here.\nTOP HOSPITAL COVER\nother words", "TOP HOSPITAL COVER"), ("Product Summary now\nx", None), ("b words\na words", "a words"),
    ("\n" * 17 + "late name", "late name"), ("\n" * 18 + "late name", None), ("", None), (None, None),
])
def test_product_name(spark, text, want):
    assert extract.heads(docs(spark, text)).first()["product_name"] == want


def test_extras(spark):
    text = "blue has a combined limit of $500\nred thing 12 months\nnavy more\nend"
    rows = [r.asDict() for r in extract.extras_cover(docs(spark, text, "blue alone", "extra blue", "nothing"), ALIASES).orderBy("doc_id", "ord").collect()]
    assert [(r["doc_id"], r["service"], r["covered"], r["shared_with"]) for r in rows] == [
        (0, "Blue", True, ["RedThing"]), (0, "RedThing", True, ["Blue"]), (0, "Green", False, []),
        (2, "Blue", True, []), (2, "RedThing", False, []), (2, "Green", False, []),
    ]
    assert (rows[0]["limit_per_person"], rows[1]["waiting_period"], rows[0]["evidence"]) == (500.0, "12 Month", ["blue has a combined limit of $500"])


def test_empty_table(spark):
    none = docs(spark, "x").limit(0)
    assert extract.extras_cover(none, ALIASES).count() == extract.hospital_cover(none, ALIASES).count() == extract.heads(none).count() == 0
