"""The engine's queries over the synthetic tables, each with SQL that gives the same rows.

Every query runs over its whole tables. Arrays are returned as delimited strings,
and ratios rounded to six places, so that engines can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.functions import text as t
from tallgrass.operators import crawl as cr
from tallgrass.operators import discover as di
from tallgrass.operators import evaluate as ev
from tallgrass.operators import extract as ex
from tallgrass.operators import lines as ln
from tallgrass.operators import match as ma
from tallgrass.plans import fixtures as fx
from tallgrass.sources.readers import table, with_route

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Aliases and markers that occur in the lines of documents.
WORDS = (("Theme", ("the", "der", "le")), ("Ander", ("and", "und", "et")), ("Forest", ("for", "que")))
MARKS = {"Restricted": (" is ", " ist "), "Excluded": (" are ", " une "), "Covered": (" with ", " von ", " para ")}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


# SQL that several oracles share. lines: (doc_id, line_no, line); found: with the names matched on each line.
_CLEAN = r"trim(regexp_replace({}, '[\s\x0B\x1C-\x1F\x{{85}}\x{{A0}}]+', ' ', 'g'))"
_FORM = "' ' || trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g')) || ' '"
_TITLE = r"(regexp_matches(line, '\p{Lu}') AND NOT regexp_matches(line, '(^|[^\p{L}])\p{Ll}|\p{L}\p{Lu}'))"
_WORDS = "CASE WHEN line = '' THEN 0 ELSE len(string_split(line, ' ')) END"
_HEADING = f"((upper(line) = line AND {_WORDS} <= 10) OR ({_TITLE} AND {_WORDS} <= 5))"
_DOCS = "SELECT doc_id, text FROM documents"
_PARTS = f"SELECT p_partkey AS doc_id, {fx.FIXTURE} AS text FROM part"


def _lines(source: str) -> str:
    return rf"""
        pieces AS (SELECT doc_id, string_split_regex(coalesce(text, ''), '\r\n|[\n\x0B\x0C\r\x1C-\x1E\x{{85}}]') AS p FROM ({source})),
        cut AS (SELECT doc_id, CASE WHEN p[-1] = '' THEN p[:len(p) - 1] ELSE p END AS p FROM pieces),
        raw AS (SELECT doc_id, unnest(p) AS line, generate_subscripts(p, 1) - 1 AS line_no FROM cut),
        lines AS (SELECT doc_id, line_no::INTEGER AS line_no, {_CLEAN.format('line')} AS line FROM raw)"""


def _found(names: tuple[tuple[str, tuple[str, ...]], ...]) -> str:
    return f"""
        alias(ord, name, alias) AS (VALUES {fx.values(names)}),
        hit AS (SELECT DISTINCT doc_id, line_no, line, ord, name FROM lines JOIN alias ON contains({_FORM.format('line')}, alias))"""


def _sections(marks: dict[str, tuple[str, ...]]) -> str:
    flag = {s: " OR ".join(f"contains(lower(line), '{m}')" for m in ms) for s, ms in marks.items()}
    opened = ", ".join(f"max(CASE WHEN {f} THEN line_no END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS open_{s}" for s, f in flag.items())
    inside = " UNION ALL ".join(f"SELECT doc_id, line_no, line, '{s}' AS status FROM marked WHERE open_{s} >= coalesce(closed, -1)" for s in flag)
    return f"""
        stopped AS (
            SELECT l.*, line = '' OR contains(line, ':') OR {_HEADING} OR ({_WORDS} > 8 AND h.line_no IS NULL) AS stop
            FROM lines l LEFT JOIN (SELECT DISTINCT doc_id AS d, line_no FROM hit) h ON l.doc_id = h.d AND l.line_no = h.line_no),
        marked AS (
            SELECT doc_id, line_no, line, {opened},
                   max(CASE WHEN stop THEN line_no END) OVER (PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS closed
            FROM stopped),
        inside AS ({inside}),
        sectioned AS (
            SELECT i.doc_id, i.status, h.name, max(i.line_no) AS line_no, arg_max(i.line, i.line_no) AS evidence
            FROM inside i JOIN hit h ON i.doc_id = h.doc_id AND i.line_no = h.line_no GROUP BY ALL)"""


_INLINE = """
        told AS (
            SELECT doc_id, name, line_no, line,
                   CASE WHEN contains(lower(line), 'restricted cover for') THEN 'Restricted'
                        WHEN contains(lower(line), 'does not include cover for') OR contains(lower(line), 'services not included') OR contains(' ' || lower(line) || ' ', ' excluded ') THEN 'Excluded'
                        WHEN contains(lower(line), 'covers services such as') OR contains(lower(line), 'includes cover for') THEN 'Covered' END AS status
            FROM hit)"""
_RANK = "CASE status WHEN 'Excluded' THEN 0 WHEN 'Restricted' THEN 1 ELSE 2 END"
_BLOCKS = """
        first_hit AS (SELECT doc_id, line_no, arg_min(name, ord) AS name FROM hit GROUP BY ALL),
        filled AS (
            SELECT l.doc_id, l.line_no, l.line, last_value(f.name IGNORE NULLS) OVER (PARTITION BY l.doc_id ORDER BY l.line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS name
            FROM lines l LEFT JOIN first_hit f ON l.doc_id = f.doc_id AND l.line_no = f.line_no),
        blocks AS (
            SELECT doc_id, name, min(line_no) AS first_line, arg_min(line, line_no) AS evidence, string_agg(line, ' ' ORDER BY line_no) AS block
            FROM filled WHERE name IS NOT NULL AND line <> '' GROUP BY ALL)"""


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.with_matches(ln.explode_lines(_documents(spark, sf_dir)), fx.aliases(WORDS))


# Discovery


@query(r"""
    WITH m AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[A-Z][A-Za-z&/\-]{2,}(?:\s+[A-Z][A-Za-z&/\-]{2,}){0,3}') AS p FROM documents),
    e AS (SELECT doc_id, unnest(p) AS phrase, generate_subscripts(p, 1) AS pos FROM m),
    c AS (SELECT regexp_replace(phrase, '\s+', ' ', 'g') AS phrase, count(*) AS n, min({'d': doc_id, 'p': pos}) AS first FROM e GROUP BY 1),
    top AS (SELECT * FROM c ORDER BY n DESC, first LIMIT 20)
    SELECT phrase, n FROM top WHERE n >= 2""")
def discover_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return di.top_phrases(_documents(spark, sf_dir)).select("phrase", "n")


@query(r"""
    WITH m AS (SELECT unnest(regexp_extract_all(coalesce(text, ''), '[A-Z][A-Za-z&/\-]{2,}(?:\s+[A-Z][A-Za-z&/\-]{2,}){0,3}')) AS phrase FROM documents)
    SELECT regexp_replace(phrase, '\s+', ' ', 'g') AS phrase, count(*) AS n FROM m GROUP BY 1""")
def phrase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return di.phrases(_documents(spark, sf_dir)).select("phrase", "n")


# Lines


@query(f"WITH {_lines(_DOCS)} SELECT doc_id, line_no, line FROM lines")
def lines_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.explode_lines(_documents(spark, sf_dir))


@query(f"WITH {_lines(_DOCS)}, {_found(WORDS)} SELECT doc_id, line_no, ord::INTEGER AS ord, name FROM hit")
def alias_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.lit([n for n, _ in WORDS])
    out = _document_lines(spark, sf_dir).select("doc_id", "line_no", F.explode("found").alias("name"))
    return out.select("doc_id", "line_no", (F.array_position(names, F.col("name")) - 1).cast("int").alias("ord"), "name")


@query(f"WITH {_lines(_DOCS)} SELECT doc_id, line_no, {_HEADING} AS heading FROM lines")
def heading_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.explode_lines(_documents(spark, sf_dir)).select("doc_id", "line_no", t.is_heading(F.col("line")).alias("heading"))


@query(f"WITH {_lines(_DOCS)}, {_found(WORDS)}, {_BLOCKS} SELECT doc_id, name, first_line, evidence, md5(block) AS block_md5 FROM blocks")
def fill_forward_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.blocks(_document_lines(spark, sf_dir)).select("doc_id", "name", "first_line", "evidence", F.md5(F.col("block").cast("binary")).alias("block_md5"))


@query(f"WITH {_lines(_DOCS)}, {_found(WORDS)}, {_sections(MARKS)} SELECT doc_id, status, name, evidence FROM sectioned")
def section_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.section_items(_document_lines(spark, sf_dir), MARKS)


@query(f"""WITH {_lines(_PARTS)}, {_found(fx.CATEGORIES)}, {_sections(ln.SECTIONS)}, {_INLINE},
    every AS (SELECT doc_id, name, status FROM told WHERE status IS NOT NULL UNION ALL SELECT doc_id, name, status FROM sectioned)
    SELECT doc_id, name, ['Excluded', 'Restricted', 'Covered'][min({_RANK}) + 1] AS coverage FROM every GROUP BY ALL""")
def status_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ln.with_matches(ln.explode_lines(fx.documents(spark, sf_dir)), fx.aliases(fx.CATEGORIES))
    return ln.strongest(ln.inline_hits(rows).unionByName(ln.section_hits(rows)))


_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice")
_PAIRS = f"""
    n AS (SELECT l_orderkey, l_partkey, l_returnflag = 'R' AS o, row_number() OVER w AS n, lag(l_partkey) OVER w AS partner FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY {', '.join(_ORDER)})),
    p AS (SELECT *, CASE WHEN o THEN n - coalesce(max(CASE WHEN NOT o THEN n END) OVER (PARTITION BY l_orderkey ORDER BY n), 0) ELSE 0 END AS place FROM n),
    c AS (SELECT *, coalesce(lag(place) OVER (PARTITION BY l_orderkey ORDER BY n), 0) % 2 = 1 AS closes FROM p),
    pairs AS (SELECT l_orderkey, l_partkey, partner FROM c WHERE closes)"""


@query(f"WITH {_PAIRS} SELECT * FROM pairs")
def combined_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.pairs_of_runs(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", *_ORDER), "l_orderkey", _ORDER, F.col("l_returnflag") == "R", "l_partkey")


@query(f"WITH {_PAIRS} SELECT * FROM pairs UNION SELECT l_orderkey, partner, l_partkey FROM pairs")
def symmetric_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ln.both_ways(combined_pairs(spark, sf_dir), "l_orderkey", "l_partkey")


_NAME = rf"""
    named AS (
        SELECT *, CASE WHEN upper(line) = line AND {_WORDS} BETWEEN 2 AND 8 THEN 4 ELSE 0 END
                + CASE WHEN regexp_matches(lower(line), '\b(gold|silver|bronze|basic|extras|hospital)\b') THEN 3 ELSE 0 END
                + CASE WHEN length(line) <= 40 THEN 2 ELSE 0 END + CASE WHEN line LIKE '%.' THEN 0 ELSE 1 END AS score
        FROM lines WHERE line_no < 18 AND {_WORDS} >= 2 AND regexp_matches(line, '[A-Za-z]')
          AND NOT regexp_matches(lower(line), '^(product summary|important information|features|inclusions|hospital includes)')),
    title AS (SELECT doc_id, line AS product_name FROM named QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, encode(line)) = 1)"""
_TIER = r"""
    joined AS (SELECT doc_id, lower(coalesce(string_agg(line, ' ' ORDER BY line_no) FILTER (line_no < 40), '')) AS j FROM lines GROUP BY doc_id),
    tier AS (
        SELECT doc_id, CASE WHEN regexp_matches(j, 'silver\s*\+|silver plus') THEN 'SilverPlus' WHEN regexp_matches(j, 'bronze\s*\+|bronze plus') THEN 'BronzePlus'
                            WHEN regexp_matches(j, 'basic\s*\+|basic plus') THEN 'BasicPlus' WHEN regexp_matches(j, '\bgold\b') THEN 'Gold'
                            WHEN regexp_matches(j, '\bsilver\b') THEN 'Silver' WHEN regexp_matches(j, '\bbronze\b') THEN 'Bronze' WHEN regexp_matches(j, '\bbasic\b') THEN 'Basic' END AS hospital_tier
        FROM joined)"""


@query(f"WITH {_lines(_DOCS)}, {_NAME} SELECT d.doc_id, product_name FROM documents d LEFT JOIN title USING (doc_id)")
def title_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.heads(_documents(spark, sf_dir)).select("doc_id", "product_name")


@query(f"WITH {_lines(_PARTS)}, {_NAME}, {_TIER} SELECT doc_id, product_name, hospital_tier FROM tier LEFT JOIN title USING (doc_id)")
def tier_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.heads(fx.documents(spark, sf_dir)).select("doc_id", "product_name", "hospital_tier")


@query(rf"""WITH {_lines(_DOCS + " UNION ALL SELECT -1 - page_id, html FROM pages")},
    kept AS (SELECT doc_id, list(line ORDER BY line_no) AS l FROM lines WHERE line <> '' GROUP BY doc_id),
    d AS ({_DOCS} UNION ALL SELECT -1 - page_id, html FROM pages)
    SELECT d.doc_id, l[1] AS title, coalesce(len(l[:12]), 0)::INTEGER AS n_headlines, md5(array_to_string(coalesce(l[:12], []), chr(10))) AS headlines_md5,
           array_to_string(list_sort(list_distinct(regexp_extract_all(coalesce(text, ''), '\$\s*[0-9,]+(?:\.[0-9]{{2}})?')))[:20], '|') AS currencies
    FROM d LEFT JOIN kept USING (doc_id)""")
def generic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select((-1 - F.col("page_id")).alias("doc_id"), F.col("html").alias("text"))
    s = ex.summary(F.col("text"))
    out = _documents(spark, sf_dir).unionByName(pages).select("doc_id", s.alias("s"))
    return out.select("doc_id", F.col("s.title").alias("title"), F.size("s.headline_lines").alias("n_headlines"), F.md5(F.array_join("s.headline_lines", "\n").cast("binary")).alias("headlines_md5"), F.array_join("s.currency_values", "|").alias("currencies"))


# Values


@query(r"""
    WITH s AS (SELECT p_partkey, concat(p_name, ' after ', p_size, CASE p_size % 4 WHEN 0 THEN ' Months' WHEN 1 THEN 'day' WHEN 2 THEN ' YEARS' ELSE ' weeks' END, ' or 9 days') AS s FROM part),
    m AS (SELECT *, regexp_extract(s, '(?i)([0-9]+)\s*(day|month|year)', ['n', 'u']) AS a, regexp_extract(s, '(?i)([0-9]+)\s*(day|week|month|year)', ['n', 'u']) AS b FROM s)
    SELECT p_partkey, a.n || ' ' || upper(a.u[1]) || lower(a.u[2:]) AS waiting_period, b.n::INTEGER AS value, upper(b.u[1]) || lower(b.u[2:]) AS unit FROM m""")
def period_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.expr("concat(p_name, ' after ', p_size, CASE p_size % 4 WHEN 0 THEN ' Months' WHEN 1 THEN 'day' WHEN 2 THEN ' YEARS' ELSE ' weeks' END, ' or 9 days')")
    value, unit = t.waiting_parts(s)
    return table(spark, sf_dir, "part").select("p_partkey", t.waiting_period(s).alias("waiting_period"), value.alias("value"), unit.alias("unit"))


@query(r"""
    WITH s AS (SELECT c_custkey, concat('up to $', CAST(round(abs(c_acctbal)) AS BIGINT), ' per person', CASE WHEN c_nationkey % 2 = 0 THEN concat(' and $ 1,', 100 + c_nationkey, '.50 per policy') ELSE '' END) AS s FROM customer),
    m AS (SELECT c_custkey, list_transform(regexp_extract_all(s, '\$\s*[0-9,]+(?:\.[0-9]{2})?'), lambda x: try_cast(regexp_replace(x, '[$,\s]', '', 'g') AS DOUBLE)) AS a FROM s)
    SELECT c_custkey, a[1] AS limit_per_person, a[2] AS limit_per_policy, a[1]::BIGINT AS whole_limit FROM m""")
def amount_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.expr("concat('up to $', CAST(round(abs(c_acctbal)) AS BIGINT), ' per person', CASE WHEN c_nationkey % 2 = 0 THEN concat(' and $ 1,', 100 + c_nationkey, '.50 per policy') ELSE '' END)")
    person, policy = t.limits(s)
    return table(spark, sf_dir, "customer").select("c_custkey", person.alias("limit_per_person"), policy.alias("limit_per_policy"), t.whole(person).alias("whole_limit"))


@query(r"""
    WITH s AS (SELECT p_partkey, concat(p_name, CASE p_size % 3 WHEN 0 THEN ' 1234 then ' ELSE ' ' END, 250 * (p_size % 8), ' plan') AS s FROM part),
    m AS (SELECT p_partkey, try_cast(regexp_extract(s, '\b([0-9]{2,4})\b', 1) AS INTEGER) AS n FROM s)
    SELECT p_partkey, CASE WHEN n IN (250, 500, 600, 750, 1000, 1500) THEN n END AS excess_amount, CASE WHEN n IN (250, 500, 600, 750, 1000, 1500) THEN 'PerCalendarYear' END AS excess_applies_to FROM m""")
def excess_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = t.excess(F.expr("concat(p_name, CASE p_size % 3 WHEN 0 THEN ' 1234 then ' ELSE ' ' END, 250 * (p_size % 8), ' plan')"))
    return table(spark, sf_dir, "part").select("p_partkey", n.alias("excess_amount"), t.excess_applies(n).alias("excess_applies_to"))


@query(r"""
    WITH n AS (SELECT c_custkey, c_name AS x, c_mktsegment AS y FROM customer)
    SELECT c_custkey, ' ' || trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g')) || ' ' AS phrase_form, regexp_replace(lower(x || '-' || y), '[^a-z0-9]+', '', 'g') AS name_form,
           array_to_string(list_transform(regexp_extract_all(x || ' ' || lower(y), '[A-Za-z0-9]+'), lambda w: upper(w[1]) || lower(w[2:])), '') AS canonical_form FROM n""")
def name_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = F.col("c_name"), F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select("c_custkey", t.phrase_form(x).alias("phrase_form"), t.name_form(F.concat(x, F.lit("-"), y)).alias("name_form"), t.canonical_form(F.concat(x, F.lit(" "), F.lower(y))).alias("canonical_form"))


@query(r"""
    WITH r AS (SELECT doc_id, text, list_transform(string_split(text, chr(10)), lambda l: list_transform(string_split(l, '|'), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g')))) AS rows FROM documents),
    k AS (SELECT doc_id, text, list_filter(rows, lambda r: len(r) > 1 AND len(list_filter(r, lambda x: x <> '')) > 0) AS rows FROM r),
    c AS (SELECT doc_id, least(coalesce(list_sum(list_transform(flatten(rows), lambda x: length(x))), 0) / greatest(length(text), 1), 1.0) AS c, len(rows) > 0 AS has_tables FROM k)
    SELECT doc_id, round(c, 6) AS table_coverage, has_tables, CASE WHEN c > 0.3 THEN 'table_assisted' ELSE 'text_only' END AS mode FROM c""")
def table_coverage_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = F.filter(F.transform(F.split("text", "\n", -1), lambda x: F.split(x, r"\|", -1)), lambda r: F.size(r) > 1)
    docs = _documents(spark, sf_dir).select("doc_id", F.col("text").alias("full_text"), F.array(rows).alias("tables"))
    return with_route(docs).select("doc_id", F.round("table_coverage", 6).alias("table_coverage"), "has_tables", "mode")


# Links and contents

_LINKS = r"""
    a AS (SELECT url AS source_page, regexp_extract_all(html, '(?is)<a\s[^>]*?href="[^"]*"[^>]*>.*?</a>') AS a FROM pages),
    e AS (SELECT source_page, generate_subscripts(a, 1) - 1 AS seq, unnest(a) AS a FROM a),
    h AS (SELECT source_page, seq, regexp_extract(a, 'href="([^"]*)"', 1) AS href, trim(regexp_replace(regexp_replace(regexp_extract(a, '(?is)^<a\s[^>]*>(.*)</a>$', 1), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS anchor_text FROM e),
    links AS (SELECT source_page, seq::INTEGER AS seq, regexp_extract(source_page, '^([a-z]+://[^/?#]*)', 1) || href AS url, anchor_text FROM h)"""


@query(f"WITH {_LINKS} SELECT * FROM links")
def link_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cr.links(table(spark, sf_dir, "pages").select("url", "html")).select("source_page", "seq", "url", "anchor_text")


@query(f"""WITH {_LINKS}
    SELECT CASE WHEN contains(lower(anchor_text), 'the') THEN 'article' WHEN contains(lower(anchor_text), 'en') THEN 'entry'
                WHEN contains(lower(anchor_text), 'hospital') THEN 'hospital' WHEN contains(lower(anchor_text), 'extra') THEN 'extras' ELSE 'general' END AS product_type, count(*) AS n
    FROM links GROUP BY 1""")
def link_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cr.links(table(spark, sf_dir, "pages").select("url", "html"), hints={"the": "article", "En": "entry"})
    return rows.groupBy("product_type").agg(F.count(F.lit(1)).alias("n"))


@query()
def link_discovery_parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cr.links(table(spark, sf_dir, "pages").select("url", "html"), plain=False).select("source_page", "seq", "url", "anchor_text")


_FETCHED = """
    f AS (SELECT doc_id AS seq, text, sha256(text) AS h FROM documents),
    m AS (SELECT h AS hash, max(seq) AS seq FROM f WHERE seq % 10 = 3 GROUP BY h),
    r AS (
        SELECT f.seq, f.h, CASE WHEN text IS NULL THEN 'failed' WHEN m.hash IS NOT NULL OR f.seq > min(f.seq) OVER (PARTITION BY f.h) THEN 'duplicate' ELSE 'success' END AS status,
               CASE WHEN text IS NOT NULL THEN coalesce('old/' || m.seq, concat('PDFs/', 'src', min(f.seq) OVER (PARTITION BY f.h) % 5, '/general/', substr(f.h, 1, 12), '-', min(f.seq) OVER (PARTITION BY f.h), '.pdf')) END AS local_path
        FROM f LEFT JOIN m ON f.h = m.hash)"""


def _fetched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = _documents(spark, sf_dir)
    fetched = docs.select(F.col("doc_id").alias("seq"), F.concat(F.lit("http://h/x/"), "doc_id", F.lit(".pdf")).alias("url"), F.concat(F.lit("src"), F.col("doc_id") % 5).alias("fund_code"), F.lit("general").alias("product_type"), F.col("text").cast("binary").alias("content"))
    manifest = docs.where("doc_id % 10 = 3").select(F.sha2(F.col("text").cast("binary"), 256).alias("hash"), F.concat(F.lit("old/"), "doc_id").alias("local_path"), F.col("doc_id").alias("seq"))
    return fetched, manifest


@query("""WITH f AS (SELECT doc_id AS seq, sha256(text) AS content_hash FROM documents)
    SELECT seq, content_hash, CASE WHEN content_hash IS NULL THEN 'failed' WHEN seq = min(seq) OVER (PARTITION BY content_hash) THEN 'success' ELSE 'duplicate' END AS status FROM f""")
def content_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cr.dedup_content(_fetched(spark, sf_dir)[0]).select("seq", "content_hash", "status")


@query(f"WITH {_FETCHED} SELECT seq, status, local_path FROM r")
def manifest_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cr.dedup_content(*_fetched(spark, sf_dir)).select("seq", "status", "local_path")


@query(f"WITH {_FETCHED} SELECT count_if(status = 'success')::BIGINT AS success, count_if(status = 'duplicate')::BIGINT AS duplicate, count_if(status = 'failed')::BIGINT AS failed FROM r")
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cr.status_counts(cr.dedup_content(*_fetched(spark, sf_dir)))


@query(r"""SELECT page_id, string_split(regexp_replace(url, '[?#].*$', ''), '/')[4] AS fund_code, regexp_extract(url, '([^/]*)$', 1) AS file_name,
        regexp_replace(regexp_extract(regexp_replace(url, '[?#].*$', ''), '([^/]*)$', 1) || '.x.pdf', '\.[^.]*$', '') AS stem FROM pages""")
def path_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.regexp_extract("url", r"^[a-z]+://([^/]*)", 1)
    plain = F.regexp_replace("url", r"[?#].*$", "")
    path = F.regexp_replace(plain, r"^[a-z]+://[^/]*/", "root/PDFs/")
    return table(spark, sf_dir, "pages").where(host.isNotNull()).select("page_id", t.fund_code(path).alias("fund_code"), t.url_name(F.col("url")).alias("file_name"), t.stem(F.concat(plain, F.lit(".x.pdf"))).alias("stem"))


# Truth, matching and evaluation


@query("""
    WITH i AS (SELECT o_custkey, o_orderkey, count(*) AS n, sum(l_quantity) AS q FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL)
    SELECT c.c_custkey, c.c_name, count(o.o_orderkey) AS variants, coalesce(sum(i.n), 0)::BIGINT AS details, coalesce(sum(i.q), 0)::DOUBLE AS quantity, coalesce(array_to_string(list(o.o_orderkey ORDER BY o.o_orderkey) FILTER (o.o_orderkey IS NOT NULL), ','), '') AS items
    FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey LEFT JOIN i ON o.o_orderkey = i.o_orderkey GROUP BY ALL""")
def truth_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("q"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(details, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    own = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("variants"), F.sum("n").alias("details"), F.sum("q").alias("quantity"), F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")), ",").alias("items"))
    out = table(spark, sf_dir, "customer").select("c_custkey", "c_name").join(own, F.col("c_custkey") == F.col("o_custkey"), "left")
    return out.select("c_custkey", "c_name", *(F.coalesce(F.col(c), F.lit(0).cast(k)).alias(c) for c, k in (("variants", "long"), ("details", "long"), ("quantity", "double"))), F.coalesce("items", F.lit("")).alias("items"))


@query("""
    WITH g AS (SELECT DISTINCT o.o_custkey % 50 AS master, a.l_returnflag || a.l_linestatus AS service, b.l_returnflag || b.l_linestatus AS other
               FROM orders o JOIN lineitem a ON o.o_orderkey = a.l_orderkey JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber)
    SELECT master AS id_master, service, string_agg(other, ',' ORDER BY other) AS shared_with FROM g WHERE service <> other GROUP BY ALL""")
def shared_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50).alias("id_master"), F.col("o_orderkey").alias("product_item_id"))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("product_item_id"), "l_linenumber", F.concat("l_returnflag", "l_linestatus").alias("s")).distinct()
    after = rows.select("product_item_id", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("s").alias("service_combined_with"))
    groups = rows.withColumnRenamed("s", "service").join(after, ["product_item_id", "l_linenumber"]).select("product_item_id", "service", "service_combined_with").distinct()
    return ev.shared_groups(items, groups).select("id_master", "service", F.array_join("shared_with", ",").alias("shared_with"))


def _products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product for each name among the parts of each of seven funds."""
    rows = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % 7).alias("f"), "p_name").agg(F.min("p_partkey").alias("id"))
    return rows.select("id", F.col("id").alias("id_master"), F.concat(F.lit("F"), "f").alias("fund_code"), F.concat(F.lit("B"), "f").alias("brand_code"), F.initcap("p_name").alias("name_master"), F.lit("Hospital").alias("product_type"), F.lit("").alias("hospital_tier"), F.lit("").alias("pdf_filepath"))


@query(f"""
    WITH p AS (SELECT p_partkey % 7 AS f, p_name, min(p_partkey) AS id FROM part GROUP BY ALL),
    d AS (SELECT p_partkey AS doc_id, p_partkey % 7 AS f, replace(p_name, ' ', '') AS stem FROM part WHERE p_size % 2 = 0),
    s AS (SELECT doc_id, id, CASE WHEN contains(replace(p_name, ' ', ''), stem) OR contains(stem, replace(p_name, ' ', '')) THEN 0.97 END AS score FROM d JOIN p USING (f))
    SELECT doc_id, arg_min(id, id) AS id_master, max(score)::DOUBLE AS score FROM s WHERE score IS NOT NULL GROUP BY doc_id""")
def fuzzy_match_contain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.documents(spark, sf_dir).where(F.contains("path", F.lit("/Hospital/")))
    pairs = ma.product_candidates(docs.select("path"), _products(spark, sf_dir))
    scored = pairs.withColumn("score", ma.containment_floor(F.col("_stem"), F.col("_name"), F.col("_file"))).where("score > 0")
    best = scored.groupBy("path").agg(F.min(F.struct((-F.col("score")).alias("s"), "id")).alias("b"))
    return docs.join(best, "path").select("doc_id", F.col("b.id").alias("id_master"), (-F.col("b.s")).alias("score"))


@query()
def fuzzy_match_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fx.documents(spark, sf_dir).select(F.regexp_replace("path", r"(?<=-[a-z]{2})[a-z]+\.pdf$", "x.pdf").alias("path")).distinct()
    return ma.match_products(docs, _products(spark, sf_dir)).select("path", "id_master", F.round("score", 6).alias("score"))


@query()
def normalize_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "part").select(F.col("p_name").alias("raw")).distinct()
    return ma.normalise_names(raw, ["SmallRing", "RedWidget", "BlueBolt", "HotGear", "OldAnvil", "ColdRod", "NewPlate", "LargeGizmo"]).withColumn("confidence", F.round("confidence", 6))


@query("""
    SELECT doc_id, unnest(['doc.lang', 'doc.source', 'n_chars', 'tags']) AS key, unnest([lang, source, n_chars::VARCHAR, '["a", "b"]']) AS value, unnest(['str', 'str', 'int', 'list']) AS kind FROM documents
    UNION ALL SELECT doc_id, 'items.' || lang || '.size', (n_chars % 10)::VARCHAR, 'int' FROM documents""")
def flatten_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.struct("lang", "source")
    item = F.struct(F.col("lang").alias("name"), (F.col("n_chars") % 10).alias("size"), F.lit(None).cast("string").alias("gone"))
    data = F.to_json(F.struct(doc.alias("doc"), "n_chars", F.array(F.lit("a"), F.lit("b")).alias("tags"), F.array(item).alias("items"), F.lit(None).cast("string").alias("gone")))
    return ev.flatten(table(spark, sf_dir, "documents").select("doc_id", data.alias("data")), "doc_id")


_COMPARED = """
    a AS (SELECT doc_id, unnest(['quality', 'toxic', 'long']) AS key, unnest([(n_chars > 1000)::INT::DOUBLE, 0.0, 1.0]) AS v FROM documents),
    b AS (SELECT doc_id, unnest(['quality', 'toxic', 'size']) AS key, unnest([quality::DOUBLE, toxic + 0.000001, 2.0]) AS v FROM labels),
    c AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.key, b.key) AS key, a.v IS NOT NULL AS has, b.v IS NOT NULL AS wants,
                 coalesce(abs(a.v - b.v) <= greatest(1e-5 * greatest(abs(a.v), abs(b.v)), 1e-5), false) AS agrees
          FROM a FULL JOIN b ON a.doc_id = b.doc_id AND a.key = b.key),
    r AS (
        SELECT doc_id, count_if(agrees) / greatest(count_if(has), 1) AS field_precision, count_if(agrees) / greatest(count_if(wants), 1) AS field_recall,
               CASE WHEN count_if(wants) = 0 THEN 0 ELSE count_if(has) / count_if(wants) END AS coverage, count_if(has AND NOT wants) / greatest(count_if(has), 1) AS hallucination_rate,
               count_if(agrees)::BIGINT AS matched_fields, count_if(has)::BIGINT AS extracted_fields, count_if(wants)::BIGINT AS ground_truth_fields,
               coalesce(string_agg(key, ',' ORDER BY key) FILTER (wants AND NOT has), '') AS missing_fields, coalesce(string_agg(key, ',' ORDER BY key) FILTER (has AND NOT agrees), '') AS incorrect_fields
        FROM c GROUP BY doc_id)"""


def _reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    def long(df: DataFrame, **values) -> DataFrame:
        rows = F.array(*(F.struct(F.lit(k).alias("key"), F.lit(v).cast("double").cast("string").alias("value"), F.lit("number").alias("kind")) if not hasattr(v, "cast") else F.struct(F.lit(k).alias("key"), v.cast("double").cast("string").alias("value"), F.lit("number").alias("kind")) for k, v in values.items()))
        return df.select("doc_id", F.explode(rows).alias("f")).select("doc_id", "f.*")

    got = long(table(spark, sf_dir, "documents"), quality=(F.col("n_chars") > 1000).cast("int"), toxic=0.0, long=1.0)
    wanted = long(table(spark, sf_dir, "labels"), quality=F.col("quality"), toxic=F.col("toxic") + 0.000001, size=2.0)
    return ev.reports(ev.compare(got, wanted, "doc_id"), "doc_id")


@query(f"""WITH {_COMPARED} SELECT doc_id, round(field_precision, 6) AS field_precision, round(field_recall, 6) AS field_recall, round(coverage, 6) AS coverage, round(hallucination_rate, 6) AS hallucination_rate,
    matched_fields, extracted_fields, ground_truth_fields, missing_fields, incorrect_fields FROM r""")
def eval_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = ("field_precision", "field_recall", "coverage", "hallucination_rate")
    return _reports(spark, sf_dir).select("doc_id", *(F.round(m, 6).alias(m) for m in ratios), "matched_fields", "extracted_fields", "ground_truth_fields", F.array_join("missing_fields", ",").alias("missing_fields"), F.array_join("incorrect_fields", ",").alias("incorrect_fields"))


@query(f"WITH {_COMPARED} SELECT count(*) AS documents, round(avg(field_precision), 6) AS field_precision, round(avg(field_recall), 6) AS field_recall, 1.0::DOUBLE AS normalization_accuracy, round(avg(coverage), 6) AS coverage, round(avg(hallucination_rate), 6) AS hallucination_rate FROM r")
def eval_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.summarise(_reports(spark, sf_dir)).select("documents", *(F.round(m, 6).alias(m) for m in ev.METRICS))


# Whole extractions

_HOSPITAL = f"""{_lines(_PARTS)}, {_found(fx.CATEGORIES)}, {_sections(ln.SECTIONS)}, {_INLINE}, {_TIER},
    every AS (SELECT doc_id, name, status, 0 AS src, line_no, line FROM told WHERE status IS NOT NULL
              UNION ALL SELECT doc_id, name, status, CASE status WHEN 'Restricted' THEN 1 WHEN 'Excluded' THEN 2 ELSE 3 END, line_no, evidence FROM sectioned),
    best AS (SELECT doc_id, name, ['Excluded', 'Restricted', 'Covered'][min({_RANK}) + 1] AS coverage, arg_min(line, {{'s': src, 'l': line_no}}) AS evidence FROM every GROUP BY ALL),
    gate AS (SELECT doc_id FROM best UNION SELECT doc_id FROM tier WHERE hospital_tier IS NOT NULL),
    cover AS (SELECT g.doc_id, n.ord, n.name, b.coverage, b.evidence FROM gate g CROSS JOIN (SELECT DISTINCT ord, name FROM alias) n LEFT JOIN best b ON g.doc_id = b.doc_id AND n.name = b.name)"""


@query(f"""WITH {_HOSPITAL} SELECT doc_id, ord::INTEGER AS ord, name AS title, CASE WHEN coverage IS NULL OR coverage = 'Excluded' THEN 'NotCovered' ELSE coverage END AS cover,
    CASE WHEN evidence IS NULL THEN '' ELSE '1' END AS evidence_pages, evidence AS evidence_text FROM cover""")
def hospital_rows_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ex.hospital_rows(ex.hospital_cover(fx.documents(spark, sf_dir), fx.aliases(fx.CATEGORIES)))
    return rows.withColumn("evidence_pages", F.array_join(F.transform("evidence_pages", lambda x: x.cast("string")), ","))


_SERVICES = rf"""
    signal AS (SELECT doc_id FROM lines WHERE line_no < 60 AND contains(lower(line), 'extra')),
    gate AS (SELECT doc_id FROM blocks GROUP BY doc_id HAVING count(*) >= 2 UNION SELECT doc_id FROM signal),
    every AS (
        SELECT g.doc_id, n.name, b.block, b.evidence, row_number() OVER (PARTITION BY g.doc_id ORDER BY b.first_line NULLS LAST, n.ord) - 1 AS ord
        FROM gate g CROSS JOIN (SELECT DISTINCT ord, name FROM alias) n LEFT JOIN blocks b ON g.doc_id = b.doc_id AND n.name = b.name),
    vals AS (
        SELECT *, block IS NOT NULL AS covered, contains(lower(coalesce(block, '')), 'combined limit') AS o,
               regexp_extract(coalesce(block, ''), '(?i)([0-9]+)\s*(day|month|year)', ['n', 'u']) AS w,
               list_transform(regexp_extract_all(coalesce(block, ''), '\$\s*[0-9,]+(?:\.[0-9]{{2}})?'), lambda x: try_cast(regexp_replace(x, '[$,\s]', '', 'g') AS DOUBLE)) AS a
        FROM every),
    seq AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ord) AS n, lag(name) OVER (PARTITION BY doc_id ORDER BY ord) AS before FROM vals WHERE covered),
    placed AS (SELECT *, CASE WHEN o THEN n - coalesce(max(CASE WHEN NOT o THEN n END) OVER (PARTITION BY doc_id ORDER BY n), 0) ELSE 0 END AS place FROM seq),
    closed AS (SELECT *, coalesce(lag(place) OVER (PARTITION BY doc_id ORDER BY n), 0) % 2 = 1 AS c FROM placed),
    pairs AS (SELECT doc_id, name, before AS partner FROM closed WHERE c),
    shared AS (SELECT doc_id, name, string_agg(partner, ',' ORDER BY partner) AS shared_with FROM (SELECT * FROM pairs UNION SELECT doc_id, partner, name FROM pairs) GROUP BY ALL),
    rows AS (
        SELECT v.doc_id, v.ord::INTEGER AS ord, v.name AS service, covered, CASE WHEN w.n <> '' THEN w.n || ' ' || upper(w.u[1]) || lower(w.u[2:]) END AS waiting_period,
               a[1] AS limit_per_person, a[2] AS limit_per_policy, coalesce(s.shared_with, '') AS shared_with, evidence
        FROM vals v LEFT JOIN shared s ON v.doc_id = s.doc_id AND v.name = s.name)"""
_EXTRAS = f"{_lines(_PARTS)}, {_found(fx.SERVICES)}, {_BLOCKS}, {_SERVICES}"


@query(f"WITH {_EXTRAS} SELECT doc_id, ord, service, covered, waiting_period, limit_per_person, limit_per_policy, shared_with, evidence FROM rows")
def extras_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ex.extras_cover(fx.documents(spark, sf_dir), fx.aliases(fx.SERVICES))
    return rows.withColumn("shared_with", F.array_join("shared_with", ",")).withColumn("evidence", F.get("evidence", 0))


@query(rf"""WITH {_EXTRAS} SELECT doc_id, ord, service AS title, covered, split_part(waiting_period, ' ', 1)::BIGINT AS waiting_period_value, split_part(waiting_period, ' ', 2) AS waiting_period_unit,
    trunc(limit_per_policy)::BIGINT AS limit_per_policy, trunc(limit_per_person)::BIGINT AS limit_per_person, evidence AS evidence_text FROM rows WHERE covered""")
def extras_rows_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ex.extras_rows(ex.extras_cover(fx.documents(spark, sf_dir), fx.aliases(fx.SERVICES)))
    return rows.drop("has_special_features", "free_text_limit", "evidence_pages")


@query(f"WITH {_EXTRAS} SELECT doc_id, service, unnest(string_split(shared_with, ',')) AS service_combined_with, false AS sub_limits_apply FROM rows WHERE shared_with <> ''")
def limit_group_rows_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ex.limit_group_rows(ex.extras_cover(fx.documents(spark, sf_dir), fx.aliases(fx.SERVICES)))
    return rows.select("doc_id", "service", "service_combined_with", "sub_limits_apply")


def _schema():
    from tallgrass.sources.schemas import Schema, Section

    names = lambda x: [n for n, _ in x]
    return Schema("private_health", hospital=Section(canonical_categories=names(fx.CATEGORIES), aliases={n: list(a) for n, a in fx.CATEGORIES}), extras=Section(canonical_services=names(fx.SERVICES), aliases={n: list(a) for n, a in fx.SERVICES}))


@query()
def extract_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.extracted(fx.documents(spark, sf_dir), _schema())


@query()
def payload_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.flatten_payloads(ex.payloads(fx.documents(spark, sf_dir), _schema()), "doc_id")


@query(f"""WITH {_HOSPITAL},
    hospital_lines AS (SELECT doc_id, 'hospital.clinical_categories.' || name AS field, row_number() OVER (PARTITION BY doc_id, name ORDER BY src, line_no) - 1 AS pos, line AS text FROM every),
    more AS (
        SELECT * FROM (WITH {_EXTRAS} SELECT doc_id, 'extras.services.' || service AS field, 0 AS pos, evidence AS text FROM rows WHERE evidence IS NOT NULL
                       UNION ALL SELECT doc_id, 'extras.product_name', 0, product_name FROM (WITH {_lines(_PARTS)}, {_NAME} SELECT * FROM title) WHERE doc_id IN (SELECT doc_id FROM rows))),
    names AS (SELECT * FROM (WITH {_lines(_PARTS)}, {_NAME} SELECT * FROM title))
    SELECT doc_id, field, pos::INTEGER AS pos, text, 1::INTEGER AS page FROM hospital_lines
    UNION ALL SELECT doc_id, field, pos::INTEGER, text, 1::INTEGER FROM more
    UNION ALL SELECT doc_id, 'hospital.hospital_tier', 0, hospital_tier, 1 FROM tier WHERE hospital_tier IS NOT NULL
    UNION ALL SELECT doc_id, 'hospital.product_name', 0, product_name, 1 FROM names WHERE doc_id IN (SELECT doc_id FROM gate)""")
def evidence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ex.evidence_rows(fx.documents(spark, sf_dir), _schema())


@query()
def normalized_services(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ex.extras_cover(fx.documents(spark, sf_dir), fx.aliases(fx.SERVICES))
    out = ma.normalised_services(rows, [n for n, _ in fx.SERVICES])
    return out.select("doc_id", F.to_json("normalized_names").alias("normalized_names"))
