"""Schemas, sources, sinks, the four commands, and streams."""

from __future__ import annotations

import json

import pytest
import yaml
from pyspark.sql import functions as F

from tallgrass.operators import crawl as cr
from tallgrass.operators import evaluate as ev
from tallgrass.operators import extract as ex
from tallgrass.operators import match as ma
from tallgrass.plans import pipelines as pl
from tallgrass.sources import readers, schemas, sinks
from tallgrass.streaming import ingest

SECTIONS = yaml.safe_load("""
vertical: private_health
version: "2.0"
hospital:
  fields:
    - {name: product_name, type: string, description: Name}
    - {name: hospital_tier, type: enum, values: [Gold, Silver]}
  canonical_categories: [RedThing, Blue]
  aliases: {RedThing: [red thing], Blue: []}
extras:
  fields: [{name: limit, type: currency}, {name: tags, type: "list[string]"}, {name: flag, type: bool}]
  canonical_services: [Gear, Bolt]
  aliases: {Gear: [gears]}
""")
ENTITIES = yaml.safe_load("""
schema_version: "0.2"
canonical_values: {hospital_categories: [RedThing, Blue], extras_services: [Gear, Bolt], tiers: [Gold]}
maturity_plan: {mvp: {required_entities: [hospital_cover]}}
entities:
  product:
    cardinality: "1"
    fields: {product_name: {type: string, required: true}, product_type: {type: string}, hospital_tier: {type: enum, enum_ref: canonical_values.tiers, nullable: true}, fund_code: {type: string}, excess_amount: {type: integer, nullable: true}, flag: {type: boolean}, evidence_pages: {type: "array[integer]"}}
  hospital_cover: {fields: {title: {type: string}, cover: {type: string}, evidence_pages: {type: "array[integer]"}, evidence_text: {type: string}}}
  extras_cover: {fields: {title: {type: string}, covered: {type: boolean}, waiting_period_value: {type: integer}, waiting_period_unit: {type: string}, limit_per_person: {type: integer}}}
  extras_limit_groups: {fields: {service: {type: string}, service_combined_with: {type: string}, sub_limits_apply: {type: boolean}}}
  product_variants: {fields: {state: {type: string}}}
""")
TEXT = "Gold Hospital 750\nincludes cover for red thing\ngear combined limit $500 after 2 months\nbolt $20"


def docs(spark, **texts):
    return spark.createDataFrame([(f"in/PDFs/F1/hospital/{k}.pdf", v) for k, v in texts.items()], "path string, full_text string")


def test_sections_schema():
    s = schemas.parse_schema(SECTIONS)
    assert schemas.check_schema(s) == ["extras has canonical names without aliases: Bolt"]
    assert s.hospital.alias_table()[0] == ("RedThing", ["red thing", "Red Thing", "RedThing"]) or sorted(s.hospital.alias_table()[0][1]) == ["Red Thing", "RedThing", "red thing"]
    made = schemas.json_schema(s)
    assert made["properties"]["hospital"]["properties"]["hospital_tier"] == {"type": ["string", "null"], "enum": ["Gold", "Silver", None]}
    assert made["properties"]["extras"]["properties"]["limit"] == {"type": ["number", "null"]}
    assert made["properties"]["extras"]["properties"]["tags"] == {"type": "array", "items": {"type": "string"}}
    assert made["required"] == ["hospital", "extras"]
    assert "- product_name: string - Name" in schemas.field_text(s) and "hospital.hospital_tier: Gold, Silver" in schemas.domain_text(s)
    assert "hospital" in schemas.payload_type(s).fieldNames()
    again = schemas.parse_schema(yaml.safe_load(schemas.dump_schema(s)))
    assert again.hospital == s.hospital


def test_entities_schema():
    s = schemas.parse_schema(ENTITIES)
    assert (s.version, s.vertical, schemas.check_schema(s)) == ("0.2", "private_health", [])
    assert s.hospital.aliases == {"RedThing": ["RedThing", "Red Thing"], "Blue": ["Blue"]}
    made = schemas.json_schema(s)
    assert made["required"] == ["hospital_cover", "product"]
    assert made["properties"]["product"]["required"] == ["product_name"]
    assert made["properties"]["product"]["properties"]["hospital_tier"] == {"type": ["string", "null"], "enum": ["Gold", None]}
    assert made["properties"]["hospital_cover"]["type"] == "array"
    assert schemas.domain_text(s) == "product.hospital_tier: Gold"
    assert schemas.check_schema(schemas.Schema("x")) == ["no section is declared"]


def test_dimensions(spark):
    names, aliases = schemas.dimensions(spark, schemas.parse_schema(ENTITIES))
    assert names.count() == 4 and aliases.where("name = 'RedThing'").count() == 2


def test_extract_sections(spark):
    s = schemas.parse_schema(SECTIONS)
    s.extras.aliases["Bolt"] = []
    rows = {r["path"][-5]: (json.loads(r["data"]), r["warnings"]) for r in pl.extract(docs(spark, a=TEXT, b="nothing here", c=None), s).collect()}
    a = rows["a"][0]
    assert a["hospital"]["hospital_tier"] == "Gold" and a["hospital"]["clinical_categories"] == [{"category": "RedThing", "coverage": "Covered"}, {"category": "Blue"}]
    assert [x["service"] for x in a["extras"]["services"]] == ["Gear", "Bolt"]
    assert a["extras"]["services"][0]["shared_with"] == ["Bolt"] and a["extras"]["services"][0]["waiting_period"] == "2 Month"
    assert rows["b"] == ({}, [ex.NOTHING]) and rows["c"] == ({}, [ex.NOTHING])
    with pytest.raises(ValueError, match="without aliases"):
        pl.extract(docs(spark, a=TEXT), schemas.parse_schema(SECTIONS))


def test_extract_entities(spark):
    rows = {r["path"][-5]: json.loads(r["data"]) for r in pl.extract(docs(spark, a=TEXT, b="nothing"), schemas.parse_schema(ENTITIES)).collect()}
    a = rows["a"]
    assert a["product"] == {"product_name": "Gold Hospital 750", "product_type": "Combined", "hospital_tier": "Gold", "fund_code": "F1", "excess_amount": 750, "flag": False, "evidence_pages": [1]}
    assert a["hospital_cover"][1] == {"title": "Blue", "cover": "NotCovered", "evidence_pages": [], "evidence_text": None}
    assert a["extras_cover"][0] == {"title": "Gear", "covered": True, "waiting_period_value": 2, "waiting_period_unit": "Month", "limit_per_person": 500}
    assert {(x["service"], x["service_combined_with"]) for x in a["extras_limit_groups"]} == {("Gear", "Bolt"), ("Bolt", "Gear")}
    assert a["product_variants"] == [] and rows["b"]["product"]["product_name"] == "b" and rows["b"]["product"]["product_type"] == "Hospital"


def test_generic_and_provider(spark):
    car = schemas.parse_schema({"vertical": "car", "coverage": {"fields": [{"name": "x"}]}})
    row = pl.extract(docs(spark, a="Title\n\nline $20 and $5\n"), car).first()
    assert json.loads(row["data"])["document_summary"] == {"title": "Title", "headline_lines": ["Title", "line $20 and $5"], "currency_values": ["$20", "$5"]}

    def provider(d):
        ok = F.col("path").endswith("a.pdf")
        return d.select("path", F.when(ok, F.lit('{"x":1}')).alias("data"), F.when(~ok, "down").alias("error"))

    rows = {r["path"][-5]: (r["data"], r["warnings"]) for r in pl.extract(docs(spark, a="t", b="t"), car, provider=provider).collect()}
    assert rows["a"] == ('{"x":1}', []) and rows["b"][1] == ["Provider failed: down"]


def test_requests_and_answers(spark):
    s = schemas.parse_schema(ENTITIES)
    d = docs(spark, a="x" * 20_000).withColumn("mode", F.lit("table_assisted")).withColumn("tables", F.array(F.array(F.array(F.lit("c")))))
    row = pl.requests(d, s).first()
    assert row["prompt"].startswith("Document:\n" + "x" * 14_000 + "\n\nTables:") and json.loads(row["json_schema"])["type"] == "object"
    answers = spark.createDataFrame([("p", '{"product": {"product_name": "n"}}'), ("q", "{broken"), ("r", None)], "path string, answer string")
    got = {r["path"]: r["error"] for r in pl.checked_answers(answers, s).collect()}
    assert got["p"] is None and got["q"] and got["r"]
    assert "Allowed values" in pl.system_prompt(s)


def test_crawl(spark, tmp_path):
    (tmp_path / "c.yaml").write_text(yaml.safe_dump({"vertical": "car", "sources": [{"fund_code": "F", "entry_url": "http://h/a/", "pdf_selector": "a[href$='.pdf']", "product_type_hints": {"comp": "comprehensive"}, "strategy": "dynamic"}], "rate_limit": {"requests_per_second": 2}}))
    config = pl.read_config(tmp_path / "c.yaml")
    assert (config.strategy(config.sources[0]), config.interval, config.retry_attempts) == ("dynamic", 0.5, 3)
    html = """<a href="x.pdf">Comp <b>cover</b></a><a>none</a><a href='/y.pdf'>Extras</a><a href="z.html">no</a><a href="http://o/x.pdf">same</a><a href="gone.pdf">gone</a>"""
    pages = spark.createDataFrame([("http://h/a/", html), ("http://other/", html)], "url string, html string")
    contents = spark.createDataFrame([("http://h/a/x.pdf", b"1"), ("http://h/y.pdf", b"2"), ("http://o/x.pdf", b"1")], "url string, content binary")
    rows = {r["url"]: r for r in pl.crawl(config, pages, contents).collect()}
    assert {k: (v["status"], v["product_type"]) for k, v in rows.items()} == {"http://h/a/x.pdf": ("success", "comprehensive"), "http://h/y.pdf": ("success", "extras"), "http://o/x.pdf": ("duplicate", "general"), "http://h/a/gone.pdf": ("failed", "general")}
    assert rows["http://o/x.pdf"]["local_path"] == rows["http://h/a/x.pdf"]["local_path"] != rows["http://h/y.pdf"]["local_path"]
    done = pl.crawl(config, pages, contents)
    assert cr.status_counts(done).first().asDict() == {"success": 2, "duplicate": 1, "failed": 1}
    where = str(tmp_path / "manifest")
    assert readers.read_manifest(spark, where).count() == 0
    sinks.append_manifest(pl.manifest_records(done), where)
    again = pl.crawl(config, pages, contents, readers.read_manifest(spark, where))
    assert cr.status_counts(again).first().asDict() == {"success": 0, "duplicate": 3, "failed": 1}
    robots = spark.createDataFrame([("http://h/a/", False)], "url string, allowed boolean")
    assert pl.crawl(config, pages, contents, None, robots).count() == 0
    rendered = pages.withColumn("strategy", F.lit("static"))
    assert pl.crawl(config, rendered, contents).count() == 0
    rendered = rendered.withColumn("strategy", F.lit("dynamic"))
    assert pl.crawl(config, rendered, contents).count() == 4
    config.sources[0].pdf_selector = "div.files > a"
    with pytest.raises(ValueError, match="div.files"):
        pl.crawl(config, pages, contents)


def test_selected(spark):
    rows = spark.createDataFrame([("/f/a.pdf",), ("/g/a.html",), ("x",)], "h string")
    chosen = lambda s: [r["h"] for r in rows.where(cr.selected(s, F.col("h"))).collect()]
    assert chosen("a") == chosen("a[href]") == ["/f/a.pdf", "/g/a.html", "x"]
    assert chosen("a[href$='.pdf']") == ["/f/a.pdf"] and chosen('a[href^="/g"], a[href=x]') == ["/g/a.html", "x"]
    assert chosen("a[href*='/a.']") == ["/f/a.pdf", "/g/a.html"]


def test_last_manifest_record_wins(spark, tmp_path):
    for name, when, path in (("1.json", "2024-02-01", "new"), ("2.json", "2024-01-01", "old")):
        (tmp_path / name).write_text(json.dumps({"hash": "h", "downloaded_at": when, "local_path": path}) + "\n\n")
    rows = readers.read_manifest(spark, str(tmp_path))
    assert rows.groupBy("hash").agg(F.max_by("local_path", "seq").alias("p")).first()["p"] == "new"


def test_leaves_of_mixed_lists():
    data = {"n": [{"name": "a", "v": [2, 1], "o": {"k": 1}}, 3, {"v": 5}], "l": [" x  y ", None, ["b", "a"]], "d": {"e": {"f": None, "g": True}}}
    assert dict(ev.leaves(data)) == {"n.a.v": ["1", "2"], "n.a.o": {"k": 1}, "l": ["x y", ["a", "b"]], "d.e.g": True}


def test_batch(spark, tmp_path):
    def write(name, header, *rows):
        (tmp_path / f"own-{name}").write_text("﻿" + "\n".join([header, *rows]), encoding="utf-8")

    with pytest.raises(FileNotFoundError):
        readers.read_truth(spark, str(tmp_path))
    write("products-master-formatted.csv", "ID,FundCode,HospitalTier,ProductType,ID Master,Name Master,ProductStatus,Pdf Filepath,IsAPL,BrandCode", "1,F1,Gold,Hospital,7792534363,A plan,open,x/a.pdf,,B")
    write("hospital-services-master-unformatted.csv", "ID,ID Master,Title,Cover", "1,7792534363,RedThing,Covered", "2,7792534363,Blue,Excluded")
    write("extras-master-unformatted.csv", "ID,ID Master,Title,Covered,WaitingPeriod,WaitingPeriodUnit,LimitPerPolicy,LimitPerPerson", "1,7792534363,Gear,True,2,Month,,500")
    write("extras-limit-groups-unformatted.csv", "ProductItemID,Service,Service Combined With", "v,Gear,Bolt")
    truth = readers.read_truth(spark, str(tmp_path))
    s = schemas.parse_schema(SECTIONS)
    s.extras.aliases["Bolt"] = []
    made = pl.batch(docs(spark, a=TEXT, zzzzzzzz="x"), s, truth)
    r = made.reports.collect()
    assert [(x["path"], x["product_key"], x["ground_truth_fields"]) for x in r] == [("in/PDFs/F1/hospital/a.pdf", "7792534363", 9)]
    assert made.summary.first()["documents"] == 1 and 0 < r[0]["field_recall"] < 1 and r[0]["normalization_accuracy"] == 1.0
    where = sinks.write_report(made.reports, str(tmp_path / "out"))
    assert json.loads(where[0].read_text())["reports"][0]["product_key"] == "7792534363"
    assert "## in/PDFs/F1/hospital/a.pdf" in where[1].read_text() and "- field_precision: 0." in where[1].read_text()
    sinks.write_results(sinks.results(made.extracted, s.vertical, s.version, **pl.shown(docs(spark, a=TEXT), s)), str(tmp_path / "results"))
    written = {r["output_path"]: json.loads(r["json"]) for r in spark.read.json(str(tmp_path / "results")).collect()}
    a = written["outputs/private_health/extractions/PDFs/F1/hospital/a.json"]
    assert len(written) == 2 and a["schema_version"] == "2.0" and a["data"]["hospital"]["hospital_tier"] == "Gold"
    assert [e["text"] for e in a["evidences"]["hospital.clinical_categories.RedThing"]] == ["includes cover for red thing"]
    assert [n["canonical"] for n in a["normalized_names"]] == ["Gear", "Bolt"]


def test_documents(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.pdf").write_bytes(b"good")
    (tmp_path / "d" / "b.pdf").write_bytes(b"bad")
    (tmp_path / "d" / "c.PDF").write_bytes(b"x")

    def parse(content):
        if content == b"bad":
            raise OSError("broken")
        return ["page one", "two"], [[["a", ""], ["", ""]]]

    rows = {r["path"][-5:]: r for r in readers.read_documents(spark, str(tmp_path), parse).collect()}
    assert set(rows) == {"a.pdf", "b.pdf"} and rows["b.pdf"]["error"] == "OSError: broken" and rows["b.pdf"]["full_text"] == ""
    assert rows["a.pdf"]["full_text"] == "page one\ntwo" and rows["a.pdf"]["tables"] == [[["a", ""]]] and rows["a.pdf"]["pages"] == 2
    assert [r["path"][-5:] for r in readers.list_files(spark, str(tmp_path)).collect()] == ["a.pdf", "b.pdf"]


def test_discover(spark):
    d = docs(spark, a="Blue Thing and Blue Thing. Red Part", b="Red Part, Blue Thing. Once Only")
    s = pl.discover(d, "car")
    assert s.coverage.aliases == {"BlueThing": ["Blue Thing"], "RedPart": ["Red Part"]} and s.version == "0.1-draft"


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = spark.createDataFrame([("2024-01-01 00:00:00", "a"), ("2024-01-01 00:01:00", "a"), ("2024-01-01 00:02:00", "b")], "t string, c string")
    rows.select(F.to_timestamp("t").alias("fetched_at"), F.col("c").cast("binary").alias("content")).coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("fetched_at timestamp, content binary").parquet(str(tmp_path / "in"))
    q = ingest.new_contents(stream).writeStream.format("memory").queryName("contents").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("contents").count() == 2


def test_pages_with_two_parsers_agree(spark):
    from conftest import DATA

    pages = readers.table(spark, DATA, "pages").select("url", "html")
    plain, parsed = cr.links(pages), cr.links(pages, plain=False)
    assert sorted(map(str, plain.collect())) == sorted(map(str, parsed.collect()))
