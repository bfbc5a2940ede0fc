"""Sinks: results and reports as JSON or Markdown, manifests, downloaded bytes."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.functions import text as t
from tallgrass.operators.evaluate import METRICS, summarise


def results(extracted: DataFrame, vertical: str, version: str, provider: str = "rules", model: str = "rules", path: str = "path", evidences: DataFrame | None = None, names: DataFrame | None = None) -> DataFrame:
    """(output_path, json): each document's result with its header, and where it goes.

    evidences (path, evidences) and names (path, normalized_names) are added where given.
    """
    out, more = extracted, []
    for df, column in ((evidences, "evidences"), (names, "normalized_names")):
        if df is not None:
            out = out.join(df, path, "left")
            more.append(column)
    head = F.struct(F.lit(vertical).alias("vertical"), F.lit(version).alias("schema_version"), F.col(path).alias("source_path"), t.now_utc().alias("extracted_at"), F.lit(provider).alias("provider"), F.lit(model).alias("model"), F.parse_json("data").alias("data"), *more, "warnings")
    return out.select(t.output_path(F.col(path), vertical).alias("output_path"), F.to_json(head).alias("json"))


def write_results(rows: DataFrame, folder: str) -> None:
    """Results as JSON lines; the address of each is in the rows."""
    rows.write.mode("overwrite").json(folder)


def append_manifest(records: DataFrame, path: str) -> None:
    records.write.mode("append").json(path)


def write_contents(downloads: DataFrame, folder: str) -> None:
    """New contents under fund and product type; the hash in each row keeps equal file names apart."""
    downloads.where("status = 'success'").select("fund_code", "product_type", "local_path", "content_hash", "content").write.mode("append").partitionBy("fund_code", "product_type").parquet(folder)


def report_markdown(reports: DataFrame, path: str = "path", key: str = "product_key") -> DataFrame:
    """reports with `section`, each document's part of the report in Markdown."""
    shown = ("field_precision", "field_recall", "coverage", "hallucination_rate")
    lines = [F.concat(F.lit(f"- {m}: "), F.format_string("%.3f", F.col(m))) for m in shown]
    named = F.coalesce(F.col(key), F.lit("unmatched")) if key in reports.columns else F.lit("unmatched")
    return reports.withColumn("section", F.concat_ws("\n", F.concat(F.lit("## "), F.col(path)), F.concat(F.lit("- product: "), named), *lines))


def write_report(reports: DataFrame, folder: str, path: str = "path") -> tuple[Path, Path]:
    """evaluation.json and evaluation.md of a run's reports, which are a row per labelled document.

    The reports are computed once, kept on the executors' disks for their summary
    and their order, and stream to the driver, which writes both files in one pass.
    """
    where = Path(folder)
    where.mkdir(parents=True, exist_ok=True)
    reports = reports.persist(StorageLevel.DISK_ONLY)
    try:
        means = summarise(reports).first().asDict()
        rows = report_markdown(reports, path).orderBy(path)
        with (where / "evaluation.json").open("w", encoding="utf-8") as f, (where / "evaluation.md").open("w", encoding="utf-8") as md:
            f.write('{"summary": ' + json.dumps(means) + ', "reports": [')
            md.write("# Evaluation\n\n" + "".join(f"- {m}: {means[m]:.3f}\n" for m in METRICS))
            for n, row in enumerate(rows.toLocalIterator()):
                fields = row.asDict(recursive=True)
                md.write(f"\n{fields.pop('section')}\n")
                f.write(("," if n else "") + "\n" + json.dumps(fields))
            f.write("\n]}\n")
    finally:
        reports.unpersist()
    return where / "evaluation.json", where / "evaluation.md"
