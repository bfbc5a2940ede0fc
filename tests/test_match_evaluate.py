"""Matching, truth, flattening and metrics."""

from __future__ import annotations

import json
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from tallgrass.operators import evaluate as ev
from tallgrass.operators import match as ma

PRODUCT = "id long, id_master string, fund_code string, brand_code string, name_master string, product_type string, hospital_tier string, pdf_filepath string"


def products(spark, *rows):
    return spark.createDataFrame([(i, f"m{i}", *r) for i, r in enumerate(rows)], PRODUCT)


def paths(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "path string")


def test_similarity_is_pythons(spark):
    pairs = [("tide", "diet"), ("diet", "tide"), ("", ""), ("a" * 250, "a" * 200 + "b"), ("abc", None)]
    got = [r["s"] for r in spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string").select("i", ma.similarity("a", "b").alias("s")).orderBy("i").collect()]
    assert got == [None if b is None else SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_match(spark):
    p = products(spark, ("F1", "B1", "Top Cover", "Hospital", "Gold", ""), ("F1", "B2", "Top Cover Plus", "Hospital", "", ""), ("F2", "F1", "Nothing", "GeneralHealth", "", "x/top-cover.pdf"), ("F9", "B9", "Other", "Hospital", "", ""))
    got = {r["path"]: (r["id_master"], round(r["score"], 4)) for r in ma.match_products(paths(spark, "PDFs/F1/hospital/top-cover.pdf", "PDFs/B2/hospital/top-cover.pdf", "PDFs/F1/extras/top cover.pdf", "PDFs/F7/hospital/top.pdf", "zzzz.pdf", "other.pdf"), p).collect()}
    assert got == {"PDFs/F1/hospital/top-cover.pdf": ("m0", 1.0), "PDFs/B2/hospital/top-cover.pdf": ("m1", 0.97), "PDFs/F1/extras/top cover.pdf": ("m2", 1.0), "other.pdf": ("m3", 1.0)}


def test_match_edges(spark):
    # an empty name is contained in every stem; with both names empty there is no candidate
    got = ma.match_products(paths(spark, "PDFs/F1/a.pdf", "PDFs/F2/a.pdf"), products(spark, ("F1", "", "", "Hospital", None, "q.pdf"), ("F2", "", "", "Hospital", None, ""))).collect()
    assert [(r["path"], r["score"]) for r in got] == [("PDFs/F1/a.pdf", 0.97)]
    ties = ma.match_products(paths(spark, "PDFs/F1/ab.pdf"), products(spark, ("F1", "", "ab", "", None, ""), ("F1", "", "AB", "", None, "")))
    assert ties.first()["id_master"] == "m0"
    assert ma.match_products(paths(spark, "a").limit(0), products(spark, ("F1", "", "a", "", None, ""))).count() == 0


def test_normalise_names(spark):
    df = spark.createDataFrame([("back neck spine",), ("Bakc, neck & spine",), ("zzz",), (None,)], "raw string")
    got = [(r["canonical"], r["requires_review"]) for r in ma.normalise_names(df, ["BackNeckSpine", "Blood"]).collect()]
    assert got == [("BackNeckSpine", False), ("BackNeckSpine", False), (None, True), (None, True)]
    assert ma.normalise_names(df.limit(1), []).first()["confidence"] == 0.0


def test_flatten(spark):
    data = {"a": None, "b": {"c": " x  y "}, "l": [], "m": [2, 1, None], "n": [{"name": "", "q": 1}, {"service": "s", "v": 0, "w": None, "z": ["b", "a"]}, {"service": "s", "v": False}], "k": "", "f": 1.5}
    rows = spark.createDataFrame([("p", json.dumps(data)), ("q", "no json"), ("r", None)], "path string, data string")
    got = {(r["key"], r["value"], r["kind"]) for r in ev.flatten(rows).collect()}
    assert got == {("b.c", "x y", "str"), ("l", "[]", "list"), ("m", "[2, 1]", "list"), ("n.s.v", "false", "bool"), ("n.s.z", '["a", "b"]', "list"), ("k", "", "str"), ("f", "1.5", "number")}


def facts(spark, *rows):
    return spark.createDataFrame(list(rows), "path string, key string, value string, kind string")


def test_metrics(spark):
    got = facts(spark, ("p", "a", "1.0", "number"), ("p", "b", "x", "str"), ("p", "h", "y", "str"), ("q", "z", "1", "str"))
    want = facts(spark, ("p", "a", "1.000001", "number"), ("p", "b", "w", "str"), ("p", "m", "v", "str"), ("r", "m", "v", "str"))
    rows = {r["path"]: r for r in ev.reports(ev.compare(got, want)).collect()}
    p = rows["p"]
    assert (round(p["field_precision"], 4), round(p["field_recall"], 4), p["coverage"], round(p["hallucination_rate"], 4)) == (0.3333, 0.3333, 1.0, 0.3333)
    assert (p["missing_fields"], p["incorrect_fields"]) == (["m"], ["b", "h"])
    assert (rows["q"]["field_recall"], rows["q"]["coverage"], rows["r"]["field_precision"], rows["r"]["hallucination_rate"]) == (0.0, 0.0, 0.0, 0.0)
    assert ev.summarise(ev.reports(ev.compare(got, want)).limit(0)).first().asDict() == {"documents": 0, **dict.fromkeys(ev.METRICS, 0.0)}


def test_truth(spark):
    matches = spark.createDataFrame([("p", "1", "N", None), ("q", "2", "M", "Gold")], "path string, id_master string, name_master string, hospital_tier string")
    hospital = spark.createDataFrame([(2, "1", "Eye", "Covered"), (1, "1", "Blood", "Restricted")], "id long, id_master string, title string, cover string")
    extras = spark.createDataFrame([(1, "1", "Optical", "True", "2", "Month", "100", "")], "id long, id_master string, title string, covered string, waiting_period string, waiting_period_unit string, limit_per_person string, limit_per_policy string")
    variants = spark.createDataFrame([(1, "v1", "1"), (2, "v2", "1")], "id long, product_item_id string, id_master string")
    groups = spark.createDataFrame([("v1", "Optical", "Dental"), ("v2", "Optical", "Dental"), ("v2", "Optical", "Optical"), ("v2", "Optical", "Chiro")], "product_item_id string, service string, service_combined_with string")
    rows = {r["path"]: r.asDict(recursive=True) for r in ev.truth_payloads(matches, hospital, extras, variants, groups).collect()}
    assert rows["p"]["hospital"]["clinical_categories"] == [{"category": "Blood", "coverage": "Restricted"}, {"category": "Eye", "coverage": "Covered"}]
    assert rows["p"]["extras"]["services"] == [{"service": "Optical", "covered": True, "waiting_period": "2 Month", "limit_per_person": 100.0, "limit_per_policy": None, "shared_with": ["Chiro", "Dental"]}]
    assert rows["q"]["hospital"] is None and rows["q"]["extras"] is None
    flat = {r["key"]: r["value"] for r in ev.flatten_payloads(spark.createDataFrame([("x",)], "path string").join(ev.truth_payloads(matches, hospital, extras, variants, groups).where("path = 'p'").drop("path"))).collect()}
    assert flat["hospital.clinical_categories.Eye.coverage"] == "Covered" and flat["extras.services.Optical.shared_with"] == '["Chiro","Dental"]'
    assert "extras.services.Optical.limit_per_policy" not in flat and "hospital.hospital_tier" not in flat


def test_no_variants_table(spark):
    matches = ma.match_products(paths(spark, "PDFs/F1/a.pdf"), products(spark, ("F1", "", "a", "", None, "")))
    assert matches.first()["product_item_ids"] == []
    assert F.__name__
