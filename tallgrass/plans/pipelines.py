"""The four commands as functions from DataFrames to DataFrames: crawl, discover, extract, batch."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.functions import text as t
from tallgrass.operators import crawl as cr
from tallgrass.operators import discover as di
from tallgrass.operators import evaluate as ev
from tallgrass.operators import extract as ex
from tallgrass.operators import match as ma
from tallgrass.sources.schemas import Schema, check_schema, domain_text, field_text, json_schema

#: Characters of text and tables that a prompt holds.
PROMPT_CHARS, PROMPT_TABLES = 14_000, 8


@dataclass
class Source:
    entry_url: str
    fund_code: str = ""
    pdf_selector: str = "a[href$='.pdf']"
    product_type_hints: dict[str, str] = field(default_factory=dict)
    strategy: str | None = None
    wait_selector: str | None = None


@dataclass
class CrawlConfig:
    """What a crawl reads. Rates, retries and backoff are for whoever fetches; the engine gets fetched bytes."""

    vertical: str
    sources: list[Source]
    crawl_strategy: str = "static"
    respect_robots_txt: bool = True
    requests_per_second: float = 0.5
    retry_attempts: int = 3
    backoff_seconds: tuple[float, ...] = (2, 5, 10)

    def strategy(self, source: Source) -> str:
        """A source's own strategy goes before the common one."""
        return source.strategy or self.crawl_strategy

    @property
    def interval(self) -> float:
        return 1 / max(self.requests_per_second, 0.01)


def read_config(path: str | Path) -> CrawlConfig:
    given: dict[str, Any] = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    rate = given.pop("rate_limit", None) or {}
    known = Source.__dataclass_fields__
    sources = [Source(**{k: v for k, v in ({**s, "strategy": s.get("strategy") or s.get("crawl_strategy")}).items() if k in known}) for s in given.pop("sources", [])]
    rest = {k: v for k, v in (given | rate).items() if k in CrawlConfig.__dataclass_fields__}
    return CrawlConfig(sources=sources, **{k: tuple(v) if k == "backoff_seconds" else v for k, v in rest.items()})


def crawl(config: CrawlConfig, pages: DataFrame, contents: DataFrame, manifest: DataFrame | None = None, robots: DataFrame | None = None) -> DataFrame:
    """Links of the sources' pages (url, html), joined with fetched contents (url, content), as download results.

    All links are found before any is looked up. A link whose content is missing
    has failed with an error of its own. If pages tell the strategy by which they
    were fetched (a column `strategy`), a source reads those of its own strategy.
    """
    found = None
    for n, s in enumerate(config.sources):
        own = pages.where(F.col("url") == s.entry_url)
        if "strategy" in pages.columns:
            own = own.where(F.col("strategy") == config.strategy(s))
        if config.respect_robots_txt and robots is not None:
            own = cr.allowed(own, robots, "url")
        rows = cr.links(own, vertical=config.vertical, fund=F.lit(s.fund_code), hints=s.product_type_hints, selector=s.pdf_selector, plain=False)
        rows = rows.withColumn("seq", F.lit(n).cast("long") * (1 << 32) + F.col("seq"))
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        raise ValueError("the configuration has no sources")
    fetched = found.join(contents.select("url", "content"), "url", "left")
    out = cr.dedup_content(fetched, manifest)
    return out.withColumn("error", F.when(F.col("status") == "failed", "no content"))


def manifest_records(results: DataFrame) -> DataFrame:
    """What a manifest keeps of new contents."""
    return results.where("status = 'success'").select("url", "local_path", F.col("content_hash").alias("hash"), t.now_utc().alias("downloaded_at"), "fund_code", "vertical", "product_type", "source_page", F.create_map(F.lit("anchor_text"), "anchor_text").alias("metadata"))


def discover(docs: DataFrame, vertical: str, doc: str = "path", text: str = "full_text") -> Schema:
    return di.draft_schema(docs, vertical, doc, text)


def checked(schema: Schema) -> Schema:
    if issues := check_schema(schema):
        raise ValueError("\n".join(issues))
    return schema


def extract(docs: DataFrame, schema: Schema, path: str = "path", text: str = "full_text", provider: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(path, data, warnings) for every document, data as JSON in the schema's style."""
    checked(schema)
    if schema.by_entities and provider is None:
        rows = ex.entities(docs.withColumnRenamed(path, "path"), schema, "path", text)
        return rows.select(F.col("path").alias(path), F.to_json(F.struct(*rows.columns[1:]), {"ignoreNullFields": "false"}).alias("data"), F.array().cast("array<string>").alias("warnings"))
    return ex.extracted(docs, schema, path, text, provider)


def shown(docs: DataFrame, schema: Schema, path: str = "path", text: str = "full_text") -> dict[str, DataFrame]:
    """What a result shows beside its data, as options of sinks.results: evidences and, of extras, normalized names."""
    if not ex.uses_rules(schema) or not (schema.hospital or schema.extras):
        return {}
    out = {"evidences": ex.evidence_map(ex.evidence_rows(docs, schema, path, text), path)}
    if schema.extras is not None:
        covers = ex.extras_cover(docs, schema.extras.alias_table(), path, text)
        out["names"] = ma.normalised_services(covers, schema.extras.canonical_names, path)
    return out


@dataclass
class Batch:
    extracted: DataFrame
    matches: DataFrame | None = None
    reports: DataFrame | None = None
    summary: DataFrame | None = None


def batch(docs: DataFrame, schema: Schema, truth: dict[str, DataFrame] | None = None, path: str = "path", text: str = "full_text") -> Batch:
    """All documents extracted and, with labelled tables, matched and scored.

    Both styles of schema are scored on the same fields: those of the hospital and
    extras payloads.
    """
    out = Batch(extract(docs, schema, path, text))
    if truth is None or not ex.uses_rules(schema):
        return out
    out.matches = ma.match_products(docs, truth["products"], truth.get("variants"), path)
    wanted = ev.truth_payloads(out.matches, truth["hospital"], truth["extras"], truth.get("variants"), truth["groups"], path)
    got = ex.payloads(docs.join(out.matches.select(path), path, "left_semi"), schema, path, text)
    compared = ev.compare(ev.flatten_payloads(got, path), ev.flatten_payloads(wanted, path), path)
    rows = ev.reports(compared, path, ev.name_accuracy(got, wanted, path))
    out.reports = rows.join(out.matches.select(path, F.col("id_master").alias("product_key")), path, "left")
    out.summary = ev.summarise(out.reports)
    return out


# An external model


def system_prompt(schema: Schema) -> str:
    return "\n".join([
        f"You extract structured data from {schema.vertical} documents.",
        "Use only what the document says; leave out what it does not say.",
        "Fields:", field_text(schema), "Allowed values:", domain_text(schema),
    ])


def requests(docs: DataFrame, schema: Schema, path: str = "path", text: str = "full_text") -> DataFrame:
    """(path, prompt, json_schema): what a provider is asked, the text cut and tables only where they matter."""
    import json

    body = F.left(F.coalesce(F.col(text), F.lit("")), F.lit(PROMPT_CHARS))
    tables = F.when(F.col("mode") == "table_assisted", F.concat(F.lit("\n\nTables:\n"), F.to_json(F.slice("tables", 1, PROMPT_TABLES)))).otherwise("")
    return docs.select(path, F.concat(F.lit("Document:\n"), body, tables).alias("prompt"), F.lit(json.dumps(json_schema(schema))).alias("json_schema"))


def checked_answers(answers: DataFrame, schema: Schema, path: str = "path") -> DataFrame:
    """(path, data, error): answers (path, answer) that have the schema's shape; an error says why one has not."""
    from tallgrass.sources.schemas import payload_type

    kind = payload_type(schema).add("_corrupt_record", "string")
    read = F.from_json("answer", kind, {"mode": "PERMISSIVE"})
    bad = read.isNull() | read["_corrupt_record"].isNotNull()
    return answers.select(path, F.when(~bad, F.col("answer")).alias("data"), F.when(bad, "answer has not the declared shape").alias("error"))


def main(argv: list[str] | None = None) -> int:
    """`discover`, `extract` and `batch` over a folder of documents; `crawl` over tables of pages and contents."""
    import argparse

    from tallgrass.sources import readers, sinks
    from tallgrass.sources.schemas import read_schema, write_schema

    p = argparse.ArgumentParser(description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("crawl", "discover", "extract", "batch"):
        q = sub.add_parser(name)
        q.add_argument("--input", required=True)
        q.add_argument("--output", required=True)
        q.add_argument("--vertical", default="generic")
        q.add_argument("--schema")
        q.add_argument("--config")
        q.add_argument("--contents")
        q.add_argument("--manifest")
        q.add_argument("--truth")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName(f"tallgrass {a.command}").getOrCreate()
    if a.command == "crawl":
        manifest = readers.read_manifest(spark, a.manifest) if a.manifest else None
        out = crawl(read_config(a.config), spark.read.parquet(a.input), spark.read.parquet(a.contents), manifest)
        out.write.mode("overwrite").parquet(a.output)
        done = spark.read.parquet(a.output)
        if a.manifest:
            sinks.append_manifest(manifest_records(done), a.manifest)
        return int(cr.status_counts(done).first()["failed"] > 0)
    docs = readers.read_documents(spark, a.input)
    if not docs.limit(1).count():
        return 1
    if a.command == "discover":
        write_schema(discover(docs, a.vertical), a.output)
        return 0
    schema = read_schema(a.schema)
    if check_schema(schema):
        return 1
    made = batch(docs, schema, readers.read_truth(spark, a.truth) if a.truth else None)
    sinks.write_results(sinks.results(made.extracted, schema.vertical, schema.version, **shown(docs, schema)), f"{a.output}/extractions")
    if a.command == "batch" and made.reports is not None:
        sinks.write_report(made.reports, f"{a.output}/evaluation")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
