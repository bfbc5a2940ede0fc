"""Column functions against small cases, each of which a naive form gets wrong."""

from __future__ import annotations

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from tallgrass.functions import text as t


def value(spark, column, **given):
    return spark.createDataFrame([tuple(given.values())], ", ".join(f"{k} string" for k in given)).select(column.alias("v")).first()["v"]


def one(spark, f, x):
    return value(spark, f(F.col("x")), x=x)


@pytest.mark.parametrize(("f", "x", "want"), [
    (t.clean, "  a \t b  c\n", "a b c"), (t.clean, None, ""),
    (t.phrase_form, "Foo-Bar, baz!", " foo bar baz "), (t.name_form, "A&B (c) 9", "abc9"), (t.name_form, None, ""),
    (t.decamelised, "NonPBS", "Non P B S"), (t.canonical_form, "foo-BAR baz9", "FooBarBaz9"),
    (t.is_heading, "ALL CAPS HERE", True), (t.is_heading, "12", True), (t.is_heading, "Back Neck Spine", True), (t.is_heading, "Back, neck and spine", False),
    (t.is_heading, "One Two Three Four Five Six", False), (t.is_heading, "A B C D E F G H I J K", False),
    (t.waiting_period, "after 12 Months", "12 Month"), (t.waiting_period, "2daylight", "2 Day"), (t.waiting_period, "6 weeks", None), (t.waiting_period, "none", None), (t.waiting_period, None, None),
    (t.amount, "$1,000", 1000.0), (t.amount, "$ 500.50", 500.5), (t.amount, "$,", None),
    (t.excess, "Top 750 Plan", 750), (t.excess, "Plan 123", None), (t.excess, "1234 then 500", None), (t.excess, "Plan500", None),
    (t.truth, " TRUE ", True), (t.truth, "", False), (t.truth, None, False), (t.number, " 5.5 ", 5.5), (t.number, "x", None), (t.number, "", None),
    (t.fund_code, "a/PDFs/ABC/hospital/x.pdf", "ABC"), (t.fund_code, "a/b/x.pdf", None), (t.fund_code, "a/PDFs", None),
    (t.path_product_type, "PDFs/A/Extras/x.pdf", "GeneralHealth"), (t.path_product_type, "PDFs/A/hospital/x.pdf", "Hospital"), (t.path_product_type, "PDFs/A/combined/x.pdf", None),
    (t.stem, "a/b.c/d.e.pdf", "d.e"), (t.stem, "", ""), (t.stem, ".pdf", ".pdf"), (t.url_name, "http://h/a/f.pdf?x=1", "f.pdf?x=1"),
])
def test_scalar(spark, f, x, want):
    assert one(spark, f, x) == want


@pytest.mark.parametrize(("x", "want"), [("$10 and $2,000.50 and $3", (10.0, 2000.5)), ("only $7", (7.0, None)), ("no", (None, None))])
def test_limits(spark, x, want):
    assert (one(spark, lambda c: t.limits(c)[0], x), one(spark, lambda c: t.limits(c)[1], x)) == want


def test_waiting_parts_know_weeks(spark):
    assert (one(spark, lambda c: t.waiting_parts(c)[0], "6 weeks"), one(spark, lambda c: t.waiting_parts(c)[1], "6 weeks")) == (6, "Week")


@pytest.mark.parametrize(("a", "b", "kind", "want"), [("100.0", "100.0005", "number", True), ("100.0", "101", "number", False), ("5", "5.0", "number", True), ("5", "5.0", "str", False), ("x", "1", "number", False), ("a", "a", "str", True)])
def test_equal_values(spark, a, b, kind, want):
    assert value(spark, t.equal_values(F.col("a"), F.col("b"), F.lit(kind)), a=a, b=b) is want


BASES = ("http://h.com/a/b/c?q=1", "https://h.com", "http://h.com/a/", "http://h.com/a/b#top")


@pytest.mark.parametrize("href", ["x.pdf", "/x.pdf", "../x.pdf", "../../../x.pdf", "./x", "http://o.com/y", "//o.com/y", "?z=2", "#f", "x/../y.pdf?a=/b", "..", ".", "a//b"])
def test_absolute_url(spark, href):
    got = [value(spark, t.absolute_url(F.col("b"), F.col("h")), b=b, h=href) for b in BASES]
    assert got == [urljoin(b, href) for b in BASES]


def test_output_path_stays_inside(spark):
    assert one(spark, lambda c: t.output_path(c, "v"), "/x.pdf") == "outputs/v/extractions/x.json"
    assert one(spark, lambda c: t.output_path(c, "v"), "/r/a/PDFs/F/hospital/x.y.pdf") == "outputs/v/extractions/PDFs/F/hospital/x.y.json"
    assert one(spark, lambda c: t.output_path(c, "v"), "../../x.pdf") == "outputs/v/extractions/x.json"


def test_link_type_keeps_order_of_hints(spark):
    hints = {"third party": "third", "party": "party"}
    assert one(spark, lambda c: t.link_type(c, hints), "Third Party cover") == "third"
    assert one(spark, lambda c: t.link_type(c, hints), "Hospital extras") == "hospital"
    assert one(spark, lambda c: t.link_type(c), "Other") == "general"


def test_tables(spark):
    df = spark.createDataFrame([([[["a ", None], ["", " "]], [[""]]], "abcd"), (None, None), ([], "")], "tables array<array<array<string>>>, text string")
    from tallgrass.sources.readers import with_route

    rows = with_route(df.withColumnRenamed("text", "full_text")).collect()
    assert [r["table_coverage"] for r in rows] == [0.25, 0.0, 0.0]
    assert rows[0]["tables"] == [[["a", ""]]]
    assert [r["mode"] for r in rows] == ["text_only"] * 3
