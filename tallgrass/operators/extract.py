"""Rules that turn documents' lines into hospital and extras tables, and the payloads assembled from them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallgrass.functions import text as t
from tallgrass.operators import lines as ln
from tallgrass.sources.schemas import Schema, is_single, row_type, spark_type

#: Starts of lines that name no product.
NOT_NAMES = ("product summary", "important information", "features", "inclusions", "hospital includes")
#: Tiers with what shows them, in order.
TIERS = (
    ("SilverPlus", r"silver\s*\+|silver plus"), ("BronzePlus", r"bronze\s*\+|bronze plus"), ("BasicPlus", r"basic\s*\+|basic plus"),
    ("Gold", r"\bgold\b"), ("Silver", r"\bsilver\b"), ("Bronze", r"\bbronze\b"), ("Basic", r"\bbasic\b"),
)
NAME_LINES, TIER_LINES, SIGNAL_LINES, HEADLINES, CURRENCIES = 18, 40, 60, 12, 20
NOTHING = "the document shows neither hospital nor extras cover"
VERTICALS = ("private_health", "private_health_insurance")


def product_name(lines: Column) -> Column:
    """The most title-like of the first lines of an array; ties go to the smaller text."""

    def score(x: Column) -> Column:
        low, n = F.lower(x), t.words(x)
        return (
            F.when((F.upper(x) == x) & n.between(2, 8), 4).otherwise(0)
            + F.when(low.rlike(r"\b(gold|silver|bronze|basic|extras|hospital)\b"), 3).otherwise(0)
            + F.when(F.length(x) <= 40, 2).otherwise(0)
            + F.when(x.endswith("."), 0).otherwise(1)
        )

    def named(x: Column) -> Column:
        out = (t.words(x) >= 2) & x.rlike("[A-Za-z]")
        for start in NOT_NAMES:
            out = out & ~F.lower(x).startswith(start)
        return out

    ranked = F.transform(F.filter(F.slice(lines, F.lit(1), F.lit(NAME_LINES)), named), lambda x: F.struct((-score(x)).alias("s"), x.alias("line")))
    return F.array_min(ranked)["line"]


def tier(lines: Column) -> Column:
    """The first tier in order that the first lines, joined by spaces, show."""
    text = F.lower(F.array_join(F.slice(lines, F.lit(1), F.lit(TIER_LINES)), " "))
    out = F.when(F.lit(False), "")
    for name, pattern in TIERS:
        out = out.when(text.rlike(pattern), name)
    return out


def summary(text: Column) -> Column:
    """What is told of a document under a schema without rules: title, first lines, amounts."""
    rows = F.filter(ln.split_lines(text), lambda x: x != "")
    return F.struct(
        F.get(rows, 0).alias("title"),
        F.slice(rows, F.lit(1), F.lit(HEADLINES)).alias("headline_lines"),
        F.slice(F.array_sort(F.array_distinct(t.amounts(F.coalesce(text, F.lit(""))))), F.lit(1), F.lit(CURRENCIES)).alias("currency_values"),
    )


def heads(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, product_name, hospital_tier, extras_signal) from each document's first lines."""
    rows = docs.select(doc, ln.split_lines(F.col(text)).alias("_lines"))
    signal = F.exists(F.slice("_lines", 1, SIGNAL_LINES), lambda x: F.contains(F.lower(x), F.lit("extra")))
    return rows.select(doc, product_name(F.col("_lines")).alias("product_name"), tier(F.col("_lines")).alias("hospital_tier"), signal.alias("extras_signal"))


def by_key(rows: DataFrame) -> DataFrame:
    """rows as a side of a join that is sorted and merged: a broadcast goes by estimates, and these don't count a text's lines."""
    return rows.hint("merge")


def hospital_cover(docs: DataFrame, aliases: ln.Aliases, doc: str = "doc_id", text: str = "text", tiers: DataFrame | None = None) -> DataFrame:
    """(doc, ord, category, coverage, evidence): every category of each document that tells any status or a tier.

    evidence is an array of lines, those that tell a status themselves first.
    """
    rows = ln.with_matches(ln.explode_lines(docs, doc, text), aliases)
    inline = ln.inline_hits(rows, doc).withColumn("_from", F.lit(0))
    order = {s: i for i, s in enumerate(ln.SECTIONS)}
    sections = ln.section_hits(rows, doc=doc).groupBy(doc, "status", "name").agg(F.max("line_no").alias("line_no"), F.max_by("line", "line_no").alias("line"))
    rank = F.lit(len(order))
    for s, i in order.items():
        rank = F.when(F.col("status") == s, F.lit(1 + i)).otherwise(rank)
    hits = inline.unionByName(sections.withColumn("_from", rank))
    evidence = F.transform(F.array_sort(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("_from", "line_no", "line")))), lambda e: e["line"])
    told = hits.groupBy(doc, "name").agg(ln.strongest_status().alias("coverage"), evidence.alias("evidence"))
    told = told.groupBy(F.col(doc).alias("_doc")).agg(F.collect_list(F.struct("name", "coverage", "evidence")).alias("_told"))
    names = F.array(*(F.lit(n) for n, _ in aliases)).cast("array<string>")
    tiers = heads(docs, doc, text).select(doc, "hospital_tier") if tiers is None else tiers
    tiers = tiers.where(F.col("hospital_tier").isNotNull()).select(F.col(doc).alias("_tiered"), F.lit(True).alias("_tier")).distinct()
    gate = tiers.join(by_key(told), F.col("_tiered").eqNullSafe(F.col("_doc")), "full_outer")
    out = gate.select(F.when(F.col("_tier"), F.col("_tiered")).otherwise(F.col("_doc")).alias(doc), "_told", F.posexplode(names).alias("ord", "category"))
    own = F.get(F.filter("_told", lambda x: x["name"] == F.col("category")), 0)
    return out.select(doc, "ord", "category", own["coverage"].alias("coverage"), F.coalesce(own["evidence"], F.array().cast("array<string>")).alias("evidence"))


def extras_cover(docs: DataFrame, aliases: ln.Aliases, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, ord, service, covered, waiting_period, limit_per_person, limit_per_policy, shared_with, evidence).

    Services come in the order of their first lines, then the rest in the schema's
    order. A document counts with two services that have text, or with the word
    `extra` in its first lines. Pairs under a combined limit share both ways. Lines
    are exchanged once by document, and nothing is joined.
    """
    rows = ln.with_matches(ln.explode_lines(docs, doc, text), aliases).withColumn("name", ln.current_name(doc))
    signal = (F.col("line_no") < SIGNAL_LINES) & F.contains(F.lower("line"), F.lit("extra"))
    named = F.when(F.col("name").isNotNull() & (F.col("line") != ""), F.struct("line_no", "line"))
    own = rows.groupBy(doc, "name").agg(F.array_sort(F.collect_list(named)).alias("_rows"), F.max(signal).alias("_signal"))
    own = own.select(doc, "name", "_signal", *ln.block_of("_rows"))
    texts = F.collect_list(F.when(F.col("first_line").isNotNull(), F.struct("name", "first_line", "evidence", "block")))
    gate = own.groupBy(doc).agg(texts.alias("_own"), F.max("_signal").alias("_signal")).where((F.size("_own") >= 2) | F.col("_signal"))
    names = F.array(*(F.lit(n) for n, _ in aliases)).cast("array<string>")
    every = gate.select(doc, "_own", F.posexplode(names).alias("_declared", "service"))
    every = every.select(doc, "_declared", "service", F.get(F.filter("_own", lambda x: x["name"] == F.col("service")), 0).alias("_o")).select(doc, "_declared", "service", "_o.first_line", "_o.evidence", "_o.block")
    place = Window.partitionBy(doc).orderBy(F.col("first_line").asc_nulls_last(), "_declared")
    person, policy = t.limits(F.coalesce("block", F.lit("")))
    every = every.select(doc, "first_line", "_declared", (F.row_number().over(place) - 1).alias("ord"), "service", F.col("block").isNotNull().alias("covered"), t.waiting_period(F.coalesce("block", F.lit(""))).alias("waiting_period"), person.alias("limit_per_person"), policy.alias("limit_per_policy"), F.when(F.col("evidence").isNotNull(), F.array("evidence")).otherwise(F.array().cast("array<string>")).alias("evidence"), F.contains(F.lower(F.coalesce("block", F.lit(""))), F.lit("combined limit")).alias("_combined"))
    # services without text come last and close nothing
    every = ln.with_partner(every, place, F.col("_combined"), "service").withColumn("partner", F.when(F.col("covered"), F.col("partner")))
    ahead = F.when(F.lead("partner").over(place).isNotNull(), F.lead("service").over(place))
    shared = F.array_sort(F.array_compact(F.array("partner", ahead)))
    return every.select(doc, "ord", "service", "covered", "waiting_period", "limit_per_person", "limit_per_policy", shared.alias("shared_with"), "evidence")


# Payloads


def payloads(docs: DataFrame, schema: Schema, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, hospital, extras, warnings): nested structs as declared in schemas of style 1."""
    head = heads(docs, doc, text)
    out = head
    if schema.hospital is not None:
        rows = hospital_cover(docs, schema.hospital.alias_table(), doc, text, head.select(doc, "hospital_tier"))
        rows = rows.groupBy(doc).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "category", "coverage"))), lambda x: F.struct(x["category"].alias("category"), x["coverage"].alias("coverage"))).alias("clinical_categories"))
        out = out.join(by_key(rows), doc, "left").withColumn("hospital", F.when(F.col("clinical_categories").isNotNull(), F.struct("product_name", "hospital_tier", "clinical_categories"))).drop("clinical_categories")
    else:
        out = out.withColumn("hospital", F.lit(None).cast("struct<product_name:string,hospital_tier:string,clinical_categories:array<struct<category:string,coverage:string>>>"))
    if schema.extras is not None:
        rows = extras_cover(docs, schema.extras.alias_table(), doc, text)
        cols = ("service", "covered", "waiting_period", "limit_per_person", "limit_per_policy", "shared_with")
        rows = rows.groupBy(doc).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", *cols))), lambda x: F.struct(*(x[k].alias(k) for k in cols))).alias("services"))
        out = out.join(by_key(rows), doc, "left").withColumn("extras", F.when(F.col("services").isNotNull(), F.struct("product_name", "services"))).drop("services")
    else:
        out = out.withColumn("extras", F.lit(None).cast(T.StructType().add("product_name", "string").add("services", "array<struct<service:string,covered:boolean,waiting_period:string,limit_per_person:double,limit_per_policy:double,shared_with:array<string>>>")))
    warn = F.when(F.col("hospital").isNull() & F.col("extras").isNull(), F.array(F.lit(NOTHING))).otherwise(F.array().cast("array<string>"))
    return out.select(doc, "hospital", "extras", warn.alias("warnings"))


def evidence_rows(docs: DataFrame, schema: Schema, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, field, pos, text, page): the lines behind each field of a payload, in order; a document is one page here."""
    head = heads(docs, doc, text)
    row = lambda df, field, pos, line: df.select(doc, field.alias("field"), pos.cast("int").alias("pos"), line.alias("text"), F.lit(1).alias("page"))
    out = []
    for section, item, name in (("hospital", "clinical_categories", "category"), ("extras", "services", "service")):
        declared = getattr(schema, section)
        if declared is None:
            continue
        cover = hospital_cover(docs, declared.alias_table(), doc, text, head) if section == "hospital" else extras_cover(docs, declared.alias_table(), doc, text)
        lines = cover.select(doc, name, F.posexplode("evidence").alias("pos", "line"))
        out.append(row(lines, F.concat(F.lit(f"{section}.{item}."), name), F.col("pos"), F.col("line")))
        told = head.join(by_key(cover.select(doc).distinct()), doc, "left_semi")
        for field in ("product_name", "hospital_tier") if section == "hospital" else ("product_name",):
            out.append(row(told.where(F.col(field).isNotNull()), F.lit(f"{section}.{field}"), F.lit(0), F.col(field)))
    return reduce(DataFrame.unionByName, out)


def evidence_map(rows: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, evidences): evidence as a map from field paths to arrays of (text, page, field_path)."""
    entry = F.struct("pos", F.struct("text", "page", F.lit(None).cast("string").alias("field_path")).alias("e"))
    fields = rows.groupBy(doc, "field").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["e"]).alias("e"))
    return fields.groupBy(doc).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("field", "e")))).alias("evidences"))


def uses_rules(schema: Schema) -> bool:
    """Whether a schema's documents go through the hospital and extras rules, and not the summary."""
    return schema.vertical in VERTICALS or schema.by_entities


def extracted(docs: DataFrame, schema: Schema, doc: str = "doc_id", text: str = "text", provider: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(doc, data, warnings): each document's payload as JSON, by the rules or, where it answers, by a provider.

    provider maps the documents to (doc, data, error); its failures, a row each,
    fall back on the rules with a warning and never fail the job.
    """
    if uses_rules(schema):
        rows = payloads(docs, schema, doc, text)
        rows = rows.select(doc, F.to_json(F.struct("hospital", "extras")).alias("data"), "warnings")
    else:
        rows = docs.select(doc, F.to_json(F.struct(summary(F.col(text)).alias("document_summary"))).alias("data"), F.array().cast("array<string>").alias("warnings"))
    if provider is None:
        return rows
    asked = provider(docs).select(doc, F.col("data").alias("_data"), F.col("error").alias("_error"))
    note = F.when(F.col("_data").isNull(), F.concat(F.col("warnings"), F.array(F.concat(F.lit("Provider failed: "), F.coalesce("_error", F.lit("no answer")))))).otherwise(F.array().cast("array<string>"))
    return rows.join(asked, doc, "left").select(doc, F.coalesce("_data", "data").alias("data"), note.alias("warnings"))


# Entities (style 2)


def hospital_rows(cover: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, title, cover, evidence_pages, evidence_text); what is excluded or untold is NotCovered."""
    told = F.when(F.col("coverage").isNull() | (F.col("coverage") == "Excluded"), "NotCovered").otherwise(F.col("coverage"))
    return cover.select(doc, "ord", F.col("category").alias("title"), told.alias("cover"), *evidence_columns())


def evidence_columns(column: str = "evidence") -> tuple[Column, Column]:
    """Pages and first text of evidence; the text of a page is all that is read, so its page is 1."""
    some = F.filter(column, lambda e: F.coalesce(e, F.lit("")) != "")
    pages = F.when(F.size(column) > 0, F.array(F.lit(1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    return pages.alias("evidence_pages"), F.get(some, 0).alias("evidence_text")


def extras_rows(cover: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Rows of extras_cover for services that a document mentions."""
    value, unit = t.waiting_parts(F.col("waiting_period"))
    seen = (F.size("evidence") > 0) | F.col("covered") | F.col("waiting_period").isNotNull() | F.col("limit_per_person").isNotNull() | F.col("limit_per_policy").isNotNull()
    return cover.where(seen).select(
        doc, "ord", F.col("service").alias("title"), "covered", F.lit(None).cast("boolean").alias("has_special_features"),
        value.cast("long").alias("waiting_period_value"), unit.alias("waiting_period_unit"), t.whole(F.col("limit_per_policy")).alias("limit_per_policy"),
        t.whole(F.col("limit_per_person")).alias("limit_per_person"), F.lit(None).cast("string").alias("free_text_limit"), *evidence_columns())


def limit_group_rows(cover: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Rows of extras_limit_groups: every shared pair both ways, each once."""
    return cover.select(doc, "ord", "service", F.explode(F.array_distinct("shared_with")).alias("service_combined_with"), "evidence").select(
        doc, "ord", F.lit(None).cast("string").alias("product_item_id"), "service", "service_combined_with", F.lit(False).alias("sub_limits_apply"), *evidence_columns())


def template(spec: dict, given: dict[str, Column]) -> Column:
    """A row of an entity: the given columns, and for its other fields what an empty row holds."""
    out = []
    for name, f in (spec.get("fields") or {}).items():
        kind = spark_type(str(f.get("type", "string")))
        blank = F.array() if isinstance(kind, T.ArrayType) else F.lit(False) if isinstance(kind, T.BooleanType) and not f.get("nullable") else F.lit(None)
        out.append(given.get(name, blank).cast(kind).alias(name))
    return F.struct(*out)


def entities(docs: DataFrame, schema: Schema, path: str = "path", text: str = "text") -> DataFrame:
    """(path, one column per entity): payloads of style 2; variants and benefits are empty lists."""
    head = heads(docs, path, text)
    specs = schema.metadata["entities"]
    hospital = hospital_cover(docs, schema.hospital.alias_table(), path, text, head.select(path, "hospital_tier"))
    extras = extras_cover(docs, schema.extras.alias_table(), path, text)
    tables = {"hospital_cover": hospital_rows(hospital, path), "extras_cover": extras_rows(extras, path), "extras_limit_groups": limit_group_rows(extras, path)}
    out = head
    for name, rows in tables.items():
        spec = specs.get(name, {"fields": {}})
        made = template(spec, {k: F.col(k) for k in rows.columns})
        own = rows.groupBy(path).agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", made.alias("row")))), lambda x: x["row"]).alias(name)) if spec.get("fields") else None
        out = out.join(by_key(own), path, "left") if own is not None else out.withColumn(name, F.array())
    has = lambda n: F.coalesce(F.size(n) > 0, F.lit(False))
    named = F.when(has("hospital_cover") | has("extras_cover"), F.col("product_name"))
    named = F.coalesce(F.nullif(named, F.lit("")), t.stem(F.col(path)))
    amount = t.excess(named)
    given = {
        "product_name": named, "product_type": t.product_type(has("hospital_cover"), has("extras_cover")),
        "hospital_tier": F.when(has("hospital_cover"), F.col("hospital_tier")), "excess_amount": amount, "excess_applies_to": t.excess_applies(amount),
        "fund_name": t.fund_code(F.col(path)), "fund_code": t.fund_code(F.col(path)), "pdf_filepath": F.col(path), "evidence_pages": F.array(F.lit(1).cast("long")),
    }
    columns = []
    for name, spec in specs.items():
        if name == "product":
            columns.append(template(spec, given).alias(name))
        elif name in tables and spec.get("fields"):
            kind = T.ArrayType(row_type(spec))
            columns.append(F.coalesce(F.col(name), F.array().cast(kind)).alias(name))
        elif not is_single(name, spec):
            columns.append(F.array().cast(T.ArrayType(row_type(spec))).alias(name))
    return out.select(path, *columns)
