"""Fuzzy matching: documents to known products, raw names to canonical ones."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallgrass.functions import text as t

#: Least score of a product match; scores that containment of the name, and of the file name, guarantee.
LEAST, IN_NAME, IN_FILE = 0.55, 0.97, 0.99
#: Least score, of 100, of a canonical name.
ACCEPTED = 80.0


@F.arrow_udf(T.DoubleType())
def similarity(a: pa.Array, b: pa.Array) -> pa.Array:
    """Ratcliff-Obershelp ratio of two strings, in this order; null if either is."""
    out, matcher, last = [], SequenceMatcher(None), None
    for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True):
        if x is None or y is None:
            out.append(None)
            continue
        if y != last:
            matcher.set_seq2(y)  # the second string is the one that is analysed
            last = y
        matcher.set_seq1(x)
        out.append(matcher.ratio())
    return pa.array(out, pa.float64())


def containment_floor(stem: Column, name: Column, file: Column) -> Column:
    """The score that containment alone gives; an empty name counts as contained, an empty file name doesn't."""
    in_file = (file != "") & (F.contains(file, stem) | F.contains(stem, file))
    return F.when(in_file, IN_FILE).when(F.contains(name, stem) | F.contains(stem, name), IN_NAME).otherwise(0.0)


def product_candidates(docs: DataFrame, products: DataFrame, path: str = "path") -> DataFrame:
    """(path, ..., product columns): the products in a document's block.

    A block is the products whose fund or brand code is the path's code and whose
    type is the path's, where the path tells either. The two codes are two
    equi-joins rather than one join on a disjunction; only documents without a
    code meet the products by type alone or, telling neither, all of them (the
    product table is a dimension).
    """
    own = docs.select(path, t.name_form(t.stem(F.col(path))).alias("_stem"), t.fund_code(F.col(path)).alias("_code"), F.lower(t.path_product_type(F.col(path))).alias("_type")).distinct()
    some = products.select("*", t.name_form(F.col("name_master")).alias("_name"), t.name_form(t.stem(F.coalesce("pdf_filepath", F.lit("")))).alias("_file"), F.lower("product_type").alias("_kind"))
    typed = F.col("_type").isNull() | F.col("_type").eqNullSafe(F.col("_kind"))
    coded, free = own.where("_code is not null"), own.where("_code is null")
    by_fund = coded.join(some, (F.col("_code") == F.col("fund_code")) & typed)
    by_brand = coded.join(some, (F.col("_code") == F.col("brand_code")) & ~F.coalesce(F.col("fund_code") == F.col("brand_code"), F.lit(False)) & typed)
    by_type = free.where("_type is not null").join(some, F.col("_type") == F.col("_kind"))
    rest = free.where("_type is null").crossJoin(some)
    return by_fund.unionByName(by_brand).unionByName(by_type).unionByName(rest)


def match_products(docs: DataFrame, products: DataFrame, variants: DataFrame | None = None, path: str = "path") -> DataFrame:
    """(path, id_master, fund_code, brand_code, name_master, product_type, hospital_tier, product_item_ids, score).

    products needs `id`, which orders them: of equal scores the first wins. A
    document whose best score is under LEAST has no row. Candidates whose name and
    file name are both empty are left out.
    """
    pairs = product_candidates(docs, products, path).where("_name <> '' or _file <> ''")
    ratio = F.greatest(F.when(F.col("_name") != "", similarity("_stem", "_name")), F.when(F.col("_file") != "", similarity("_stem", "_file")))
    pairs = pairs.withColumn("score", F.greatest(ratio, containment_floor(F.col("_stem"), F.col("_name"), F.col("_file"))))
    best = pairs.where(F.col("score") >= LEAST).withColumn("_n", F.row_number().over(Window.partitionBy(path).orderBy(F.desc("score"), "id"))).where("_n = 1")
    out = best.select(path, "id_master", "fund_code", "brand_code", F.trim("name_master").alias("name_master"), "product_type", F.nullif("hospital_tier", F.lit("")).alias("hospital_tier"), "score")
    none = F.array().cast("array<string>")
    if variants is None:
        return out.withColumn("product_item_ids", none)
    items = variants.groupBy("id_master").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "product_item_id"))), lambda v: v["product_item_id"]).alias("product_item_ids"))
    return out.join(items, "id_master", "left").withColumn("product_item_ids", F.coalesce("product_item_ids", none))


def normalise_names(df: DataFrame, canonical: Sequence[str], raw: str = "raw", least: float = ACCEPTED) -> DataFrame:
    """df with canonical, confidence and requires_review for each raw name.

    The best of the canonical names by ratio of their letters and digits, the first
    of equals; below `least` the name is null and wants review. The list belongs to
    a schema and travels with the function.
    """
    import re

    names = [(n, re.sub("[^a-z0-9]+", "", n.lower())) for n in canonical]

    @F.arrow_udf("struct<canonical:string,confidence:double>")
    def best(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = SequenceMatcher(None)
        for values in batches:
            seen: dict[str, tuple[str | None, float]] = {}
            for x in set(values.to_pylist()) - {None}:
                top: tuple[str | None, float] = (None, 0.0)
                for name, form in names:
                    matcher.set_seqs(x, form)
                    if (score := 100.0 * matcher.ratio()) > top[1] or top[0] is None:
                        top = (name, score)
                seen[x] = top
            rows = [seen.get(x, (None, 0.0)) for x in values.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64())], ["canonical", "confidence"])

    out = df.withColumn("_best", best(t.name_form(F.col(raw))))
    sure = F.col("_best.confidence") >= least
    return out.withColumn("canonical", F.when(sure, F.col("_best.canonical"))).withColumn("confidence", F.col("_best.confidence")).withColumn("requires_review", ~sure).drop("_best")


def normalised_services(extras: DataFrame, canonical: Sequence[str], doc: str = "doc_id") -> DataFrame:
    """(doc, normalized_names): the canonical match of each service in a document's extras, in order."""
    rows = normalise_names(extras.select(doc, "ord", F.col("service").alias("raw")), canonical)
    entry = F.struct("ord", F.struct("raw", "canonical", "confidence", "requires_review").alias("n"))
    return rows.groupBy(doc).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda x: x["n"]).alias("normalized_names"))
