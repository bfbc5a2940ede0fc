"""Draft schemas from the most frequent capitalised phrases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.functions import text as t
from tallgrass.sources.schemas import Field, Schema, Section

#: One to four capitalised words of three characters or more.
PHRASE = r"[A-Z][A-Za-z&/\-]{2,}(?:\s+[A-Z][A-Za-z&/\-]{2,}){0,3}"
TOP, TWICE, NAMES = 20, 2, 10


def phrases(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(phrase, n, first): counts over all documents, and where each phrase comes first.

    Counts are added up before the shuffle. first is (document, place), which
    breaks ties as reading the documents in order would.
    """
    found = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(PHRASE), 0)
    rows = docs.select(doc, F.posexplode(found).alias("pos", "raw")).select(doc, "pos", t.clean(F.col("raw")).alias("phrase"))
    return rows.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(doc, "pos")).alias("first"))


def top_phrases(docs: DataFrame, doc: str = "doc_id", text: str = "text", top: int = TOP, least: int = TWICE) -> DataFrame:
    """(phrase, n, first): of the most frequent phrases those that occur often enough, in order."""
    return phrases(docs, doc, text).orderBy(F.desc("n"), "first").limit(top).where(F.col("n") >= least)


def draft_schema(docs: DataFrame, vertical: str, doc: str = "doc_id", text: str = "text") -> Schema:
    """A schema to start from, with the first NAMES phrases as services. At most TOP rows reach the driver."""
    rows = top_phrases(docs, doc, text).orderBy(F.desc("n"), "first").limit(NAMES).select("phrase", t.canonical_form(F.col("phrase")).alias("name")).collect()
    fields = [Field("product_name", "string", "Name under which the product is sold"), Field("product_tier", "string", "Level of the product within its range")]
    section = Section(fields=fields, canonical_services=[r["name"] for r in rows], aliases={r["name"]: [r["phrase"]] for r in rows})
    return Schema(vertical=vertical, version="0.1-draft", coverage=section)
