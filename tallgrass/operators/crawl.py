"""Links of pages, and content that is new against a manifest."""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from functools import reduce
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallgrass.functions import text as t
from tallgrass.operators.skew import attach

#: An anchor with its address in double quotes, and what lies between its tags.
ANCHOR, HREF, INNER = r"(?is)<a\s[^>]*?href=\"[^\"]*\"[^>]*>.*?</a>", r"(?is)^<a\s[^>]*?href=\"([^\"]*)\"", r"(?is)^<a\s[^>]*>(.*)</a>$"


def anchors(html: Column) -> Column:
    """(href, text) of the anchors of a page with plainly written addresses, by regular expressions alone."""
    whole = F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(ANCHOR), 0)
    return F.transform(whole, lambda a: F.struct(F.regexp_extract(a, HREF, 1).alias("href"), t.clean(F.regexp_replace(F.regexp_extract(a, INNER, 1), "<[^>]*>", " ")).alias("text")))


class _Anchors(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, list[str]]] = []
        self.open = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "a":
            href = dict(attrs).get("href")
            self.open = bool(href)
            if href:
                self.found.append((href, []))

    def handle_endtag(self, tag: str) -> None:
        self.open = self.open and tag != "a"

    def handle_data(self, data: str) -> None:
        if self.open and data.strip():
            self.found[-1][1].append(data.strip())


@F.arrow_udf(T.ArrayType(T.StructType().add("href", "string").add("text", "string")))
def parsed_anchors(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """(href, text) of the anchors of any page, by an HTML parser."""
    kind = pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())]))
    for pages in batches:
        out = []
        for page in pages.to_pylist():
            p = _Anchors()
            p.feed(page or "")
            p.close()
            out.append([{"href": h, "text": " ".join(" ".join(x).split())} for h, x in p.found])
        yield pa.array(out, kind)


@F.arrow_udf(T.StringType())
def joined_url(base: pa.Array, href: pa.Array) -> pa.Array:
    """href against base by the general rules for addresses; null if either is or if it cannot be read."""
    out = []
    for b, h in zip(base.to_pylist(), href.to_pylist(), strict=True):
        try:
            out.append(None if b is None or h is None else urljoin(b, h))
        except ValueError:
            out.append(None)
    return pa.array(out, pa.string())


#: A selector of anchors, by their address or a part of it.
SELECTOR = re.compile(r"""a(?:\[href(?:([$^*]?)=(['"]?)([^'"\]]+)\2)?\])?""")


def selected(selector: str, href: Column) -> Column:
    """Whether an address meets one of the selectors between commas: a, a[href], or a[href] with =, $=, ^= or *=. Others raise."""
    tests = {"": operator.eq, "$": F.endswith, "^": F.startswith, "*": F.contains}

    def one(text: str) -> Column:
        if not (m := SELECTOR.fullmatch(text.strip())):
            raise ValueError(f"links cannot be chosen by {text.strip()!r}")
        return F.lit(True) if m[3] is None else tests[m[1]](href, F.lit(m[3]))

    return reduce(operator.or_, map(one, selector.split(",")))


def links(pages: DataFrame, url: str = "url", html: str = "html", vertical: str = "", fund: Column | None = None, hints: dict[str, str] | None = None, selector: str | None = None, plain: bool = True) -> DataFrame:
    """(url, vertical, fund_code, product_type, source_page, anchor_text, seq): links of pages, duplicates kept.

    selector keeps anchors that meet it (see `selected`). plain reads pages without Python; it is
    right for anchors whose addresses stand in double quotes.
    """
    found = anchors(F.col(html)) if plain else parsed_anchors(F.col(html))
    rows = pages.select(F.col(url).alias("source_page"), (F.lit(None).cast("string") if fund is None else fund).alias("fund_code"), F.posexplode(found).alias("seq", "a")).where("a.href <> ''")
    if selector:
        rows = rows.where(selected(selector, F.col("a.href")))
    whole = t.absolute_url(F.col("source_page"), F.col("a.href")) if plain else joined_url(F.col("source_page"), F.col("a.href"))
    return rows.select(whole.alias("url"), F.lit(vertical).alias("vertical"), "fund_code", t.link_type(F.col("a.text"), hints).alias("product_type"), "source_page", F.col("a.text").alias("anchor_text"), "seq")


def allowed(sources: DataFrame, robots: DataFrame, url: str = "entry_url") -> DataFrame:
    """The sources that robots (url, allowed) doesn't forbid; one that it doesn't tell of is allowed."""
    rules = robots.select(F.col("url").alias("_url"), F.col("allowed").alias("_ok"))
    return sources.join(rules, F.col(url) == F.col("_url"), "left").where(F.coalesce("_ok", F.lit(True))).drop("_url", "_ok")


def local_path(base: str, fund: Column, kind: Column, url: Column, content_hash: Column | None = None) -> Column:
    """base/fund/type/name; with a hash, part of it precedes the name, so that equal names don't meet."""
    name = t.url_name(url) if content_hash is None else F.concat(F.left(content_hash, F.lit(12)), F.lit("-"), t.url_name(url))
    return F.concat_ws("/", F.lit(base), F.coalesce(fund, F.lit("unknown")), kind, name)


def dedup_content(fetched: DataFrame, manifest: DataFrame | None = None, content: str = "content", order: str = "seq", base: str = "PDFs") -> DataFrame:
    """fetched with content_hash, status (success, duplicate, failed) and local_path.

    Content that the manifest (hash, local_path) has, or an earlier row, is a
    duplicate and points to the first path. Rows without content have failed.
    Content that many rows share is joined by a broadcast of its key (skew.attach).
    """
    named = fetched.withColumn("content_hash", F.sha2(F.col(content), 256))
    named = named.withColumn("_path", local_path(base, F.col("fund_code"), F.col("product_type"), F.col("url"), F.col("content_hash")))
    first = named.where("content_hash is not null").groupBy("content_hash").agg(F.min(F.struct(order, "url", "_path")).alias("_first"), F.count(F.lit(1)).alias("_copies"))
    # what the manifest knows is a fact of a hash, so contents themselves are joined once
    if manifest is None:
        first = first.withColumn("_known", F.lit(None).cast("string"))
    else:
        first = first.join(manifest.groupBy(F.col("hash").alias("content_hash")).agg(F.max_by("local_path", "seq").alias("_known")), "content_hash", "left")
    out = attach(named, first, ["content_hash"], "_copies").drop("_copies")
    known = F.col("_known")
    is_first = (F.col("_first")[order] == F.col(order)) & (F.col("_first.url") == F.col("url"))
    status = F.when(F.col("content_hash").isNull(), "failed").when(known.isNotNull() | ~is_first, "duplicate").otherwise("success")
    return out.withColumn("status", status).withColumn("local_path", F.when(F.col("content_hash").isNotNull(), F.coalesce(known, F.col("_first._path")))).drop("_path", "_first", "_known")


def status_counts(results: DataFrame) -> DataFrame:
    return results.agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("success", "duplicate", "failed")))
