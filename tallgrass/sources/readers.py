"""Sources: documents, pages, labelled tables, manifests."""

from __future__ import annotations

import io
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallgrass.functions import text as t

#: Labelled tables: end of the file's name, whether evaluation needs it, and columns as (header, name).
TRUTH = {
    "products": ("products-master-formatted.csv", True, (("ID", "id"), ("FundCode", "fund_code"), ("HospitalTier", "hospital_tier"), ("ProductType", "product_type"), ("ID Master", "id_master"), ("Name Master", "name_master"), ("ProductStatus", "product_status"), ("Pdf Filepath", "pdf_filepath"), ("IsAPL", "is_apl"), ("BrandCode", "brand_code"))),
    "hospital": ("hospital-services-master-unformatted.csv", True, (("ID", "id"), ("ID Master", "id_master"), ("Title", "title"), ("Cover", "cover"))),
    "extras": ("extras-master-unformatted.csv", True, (("ID", "id"), ("ID Master", "id_master"), ("Title", "title"), ("Covered", "covered"), ("HasSpecialFeatures", "has_special_features"), ("WaitingPeriod", "waiting_period"), ("WaitingPeriodUnit", "waiting_period_unit"), ("AnnualLimit", "annual_limit"), ("LimitPerPolicy", "limit_per_policy"), ("LimitPerPerson", "limit_per_person"), ("FreeTextLimit", "free_text_limit"))),
    "variants": ("products-master-variant-formatted.csv", False, (("ID", "id"), ("ProductItemID", "product_item_id"), ("ID Master", "id_master"))),
    "groups": ("extras-limit-groups-unformatted.csv", True, (("ProductItemID", "product_item_id"), ("Service", "service"), ("Service Combined With", "service_combined_with"), ("SubLimitsApply", "sub_limits_apply"))),
    "brands": ("fund-brands-unformatted.csv", False, (("ID", "id"), ("FundCode", "fund_code"), ("BrandCode", "brand_code"), ("BrandName", "brand_name"), ("BrandPhone", "brand_phone"), ("BrandEmail", "brand_email"), ("BrandWebsite", "brand_website"))),
}

MANIFEST = "url string, local_path string, hash string, downloaded_at string, fund_code string, vertical string, product_type string, source_page string, metadata map<string,string>"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with a header, all columns as text, a byte order mark left out of the first name, quoted line feeds kept."""
    df = spark.read.option("header", True).option("inferSchema", False).option("multiLine", True).option("escape", '"').option("nullValue", "").csv(path)
    return df.toDF(*(c.lstrip("﻿") for c in df.columns))


def read_truth(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The labelled tables of a folder by name, columns in snake case.

    Files are found by the ends of their names. A missing one that evaluation needs
    raises FileNotFoundError; another is left out. Columns that a file lacks are null;
    `id` orders rows and falls back on the order of reading.
    """
    out = {}
    for name, (end, needed, columns) in TRUTH.items():
        found = sorted(p for p in Path(folder).iterdir() if p.name == end or p.name.endswith(f"-{end}"))
        if not found:
            if needed:
                raise FileNotFoundError(f"{folder}: no file *{end}")
            continue
        df = read_csv(spark, str(found[0]))
        have = {c: c for c in df.columns}
        made = [(F.col(f"`{h}`") if h in have else F.lit(None).cast("string")).alias(n) for h, n in columns]
        df = df.select(*made, F.monotonically_increasing_id().alias("_row"))
        if "id" in df.columns:
            df = df.withColumn("id", F.coalesce(F.col("id").try_cast("bigint"), F.col("_row")))
        out[name] = df.drop("_row")
    return out


def list_files(spark: SparkSession, folder: str, suffix: str = "pdf") -> DataFrame:
    """(path, length) of the files under a folder, in order of path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{suffix}").load(folder).select("path", "length").orderBy("path")


DOCUMENT = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("pages", T.IntegerType()), T.StructField("tables", T.ArrayType(T.ArrayType(T.ArrayType(T.StringType())))),
    T.StructField("full_text", T.StringType()), T.StructField("text_by_page", T.ArrayType(T.StringType())), T.StructField("error", T.StringType()),
])


def parse_pdf(content: bytes) -> tuple[list[str], list[list[list[str]]]]:
    """(text by page, tables) of a PDF, with the libraries that are installed; tables need pdfplumber."""
    try:
        import pdfplumber
    except ImportError:
        from pypdf import PdfReader

        return [p.extract_text() or "" for p in PdfReader(io.BytesIO(content)).pages], []
    with pdfplumber.open(io.BytesIO(content)) as pdf:
        pages = [p.extract_text() or "" for p in pdf.pages]
        return pages, [[[x or "" for x in row] for row in table] for p in pdf.pages for table in p.extract_tables()]


def read_documents(spark: SparkSession, folder: str, parse=parse_pdf, suffix: str = "pdf") -> DataFrame:
    """One row per file: path, pages, tables, full_text, text_by_page, table_coverage, has_tables, mode, error.

    A file that cannot be parsed is a row with an error and an empty text; it fails
    neither its task nor the others. `parse` maps bytes to (text by page, tables).
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    pages, tables = parse(content)
                    row = {"path": path, "pages": len(pages), "tables": tables, "full_text": "\n".join(pages), "text_by_page": pages, "error": None}
                except Exception as e:  # noqa: BLE001  any parser may raise anything on a broken file
                    row = {"path": path, "pages": 0, "tables": [], "full_text": "", "text_by_page": [], "error": f"{type(e).__name__}: {e}"}
                yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("path", pa.string()), ("pages", pa.int32()), ("tables", pa.list_(pa.list_(pa.list_(pa.string())))), ("full_text", pa.string()), ("text_by_page", pa.list_(pa.string())), ("error", pa.string())]))

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", f"*.{suffix}").load(folder)
    return with_route(raw.select("path", "content").mapInArrow(rows, DOCUMENT))


def with_route(docs: DataFrame) -> DataFrame:
    """Documents with their tables cleaned, table_coverage, has_tables and the mode that these choose."""
    out = docs.withColumn("tables", t.kept_tables(F.col("tables")))
    out = out.withColumn("table_coverage", t.table_coverage(F.col("tables"), F.col("full_text")))
    return out.withColumn("has_tables", F.coalesce(F.size("tables") > 0, F.lit(False))).withColumn("mode", t.route(F.col("table_coverage")))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest's records with seq, their order by time of writing, file and line; a missing file is an empty manifest, blank lines are skipped."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], f"{MANIFEST}, seq struct<downloaded_at:string,file:string,line:long>")
    order = F.struct("downloaded_at", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    return spark.read.schema(MANIFEST).json(path).withColumn("seq", order).where("hash is not null")
