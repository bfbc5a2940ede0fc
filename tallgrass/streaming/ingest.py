"""Contents as a stream: each hash once within a watermark, and links of arriving pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.operators import crawl as cr


def new_contents(stream: DataFrame, content: str = "content", time: str = "fetched_at", late: str = "1 day") -> DataFrame:
    """The first arrival of each content hash; hashes older than the watermark are forgotten, which bounds the state."""
    return stream.withColumn("content_hash", F.sha2(F.col(content), 256)).withWatermark(time, late).dropDuplicatesWithinWatermark(["content_hash"])


def arriving_links(pages: DataFrame, vertical: str = "", hints: dict[str, str] | None = None) -> DataFrame:
    """Links of a stream of pages; a projection without state."""
    return cr.links(pages, vertical=vertical, hints=hints)


def status_by_window(stream: DataFrame, time: str = "ts", width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts of each status in windows of event time."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), "status").count()
