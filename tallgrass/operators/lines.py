"""Operators on the ordered lines of documents.

All windows are over one document's lines in order, so a plan has one exchange
and one sort for all of them. Nothing here runs Python on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallgrass.functions import text as t

#: Phrases that tell a status within one line, and those that open a section of it.
RESTRICTED, EXCLUDED, COVERED = ("restricted cover for",), ("does not include cover for", "services not included"), ("covers services such as", "includes cover for")
SECTIONS = {
    "Restricted": ("restricted cover for", "restricted cover"),
    "Excluded": ("does not include cover for", "services not included", "not included"),
    "Covered": ("includes cover for", "policy includes cover for", "hospital includes"),
}
#: Statuses from strongest to weakest.
PRECEDENCE = ("Excluded", "Restricted", "Covered")

Aliases = Sequence[tuple[str, Sequence[str]]]


def split_lines(text: Column) -> Column:
    """Cleaned lines of a text as an array, blank ones among them; a break at the end opens no line."""
    whole = F.coalesce(text, F.lit(""))
    pieces = F.split(whole, t.BREAK, -1)
    pieces = F.when(F.element_at(pieces, -1) == "", F.slice(pieces, F.lit(1), F.size(pieces) - 1)).otherwise(pieces)
    return F.transform(pieces, t.clean)


def explode_lines(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, line_no, line) for every line, numbered from 0 with blank lines counted."""
    return df.select(doc, F.posexplode(split_lines(F.col(text))).alias("line_no", "line"))


def holds_phrase(line: Column, phrases: Sequence[str]) -> Column:
    """Whether a line holds one of the phrases as whole words. Both must be in phrase form; blank phrases never match."""
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(line, F.lit(p))
    return out


def phrase(alias: str) -> str:
    kept = "".join(x if x in "abcdefghijklmnopqrstuvwxyz0123456789" else " " for x in alias.lower()).split()
    return f" {' '.join(kept)} " if kept else ""


def matches(line: Column, aliases: Aliases) -> Column:
    """Canonical names that a line tells, as an array in the order of the schema."""
    form = t.phrase_form(line)
    hits = [F.when(holds_phrase(form, [p for a in given if (p := phrase(a))]), F.lit(name)) for name, given in aliases]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def inline_status(line: Column) -> Column:
    low = F.lower(line)
    some = lambda phrases: holds_phrase(low, phrases)
    excluded = some(EXCLUDED) | F.contains(F.concat(F.lit(" "), low, F.lit(" ")), F.lit(" excluded "))
    return F.when(some(RESTRICTED), "Restricted").when(excluded, "Excluded").when(some(COVERED), "Covered")


def in_order(doc: str = "doc_id") -> Window:
    return Window.partitionBy(doc).orderBy("line_no")


def with_matches(lines: DataFrame, aliases: Aliases, name: str = "found") -> DataFrame:
    return lines.withColumn(name, matches(F.col("line"), aliases))


def in_section(marker: Column, stop: Column, doc: str = "doc_id") -> Column:
    """Whether a line lies in a section: after a marker, with no stop since, itself included.

    A stop that is a marker too opens a section again for the lines after it; a
    marker within a section is content.
    """
    w = in_order(doc)
    opened = F.max(F.when(marker, F.col("line_no"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    closed = F.max(F.when(stop, F.col("line_no"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return F.coalesce(opened >= F.coalesce(closed, F.lit(-1)), F.lit(False))


def stops(line: Column, found: Column) -> Column:
    """Whether a line ends a section: blank, with a colon, like a heading, or long without a match."""
    return (line == "") | F.contains(line, F.lit(":")) | t.is_heading(line) | ((t.words(line) > 8) & (F.size(found) == 0))


def section_hits(lines: DataFrame, sections: dict[str, Sequence[str]] | None = None, doc: str = "doc_id") -> DataFrame:
    """(doc, status, name, line_no, line): names matched inside each status's sections. lines must have `found`."""
    sections = SECTIONS if sections is None else sections
    low = F.lower("line")
    flagged = lines.withColumn("_stop", stops(F.col("line"), F.col("found")))
    inside = [F.when(in_section(holds_phrase(low, marks), F.col("_stop"), doc), F.lit(s)) for s, marks in sections.items()]
    out = flagged.withColumn("status", F.array_compact(F.array(*inside)) if inside else F.array().cast("array<string>"))
    out = out.where(F.size("found") > 0).select(doc, "line_no", "line", F.explode("status").alias("status"), "found")
    return out.select(doc, "status", F.explode("found").alias("name"), "line_no", "line")


def section_items(lines: DataFrame, sections: dict[str, Sequence[str]] | None = None, doc: str = "doc_id") -> DataFrame:
    """(doc, status, name, evidence): the last line of each name in each status's sections."""
    return section_hits(lines, sections, doc).groupBy(doc, "status", "name").agg(F.max_by("line", "line_no").alias("evidence"))


def inline_hits(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, status, name, line_no, line) for matches on lines that tell a status themselves."""
    out = lines.withColumn("status", inline_status(F.col("line"))).where(F.col("status").isNotNull() & (F.size("found") > 0))
    return out.select(doc, "status", F.explode("found").alias("name"), "line_no", "line")


def strongest_status() -> Column:
    """An aggregate: the strongest status of a group's hits."""
    rank = F.lit(len(PRECEDENCE))
    for i, s in reversed(list(enumerate(PRECEDENCE))):
        rank = F.when(F.col("status") == s, F.lit(i)).otherwise(rank)
    return F.get(F.array(*map(F.lit, PRECEDENCE)), F.min(rank).cast("int"))


def strongest(hits: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, name, coverage): the strongest status of each name that has any."""
    return hits.groupBy(doc, "name").agg(strongest_status().alias("coverage"))


def blocks(lines: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, name, first_line, evidence, block): each name's lines joined by spaces.

    A line that matches takes its first match in the schema's order as the current
    name; the lines after it belong to it until the next match; lines before the
    first match, and blank ones, belong to none. lines must have `found`.
    """
    held = lines.withColumn("name", current_name(doc)).where(F.col("name").isNotNull() & (F.col("line") != ""))
    out = held.groupBy(doc, "name").agg(F.array_sort(F.collect_list(F.struct("line_no", "line"))).alias("_rows"))
    return out.select(doc, "name", *block_of("_rows"))


def current_name(doc: str = "doc_id") -> Column:
    """The name that a line belongs to: the first match of the nearest line, itself or before it, that has any."""
    return F.last(F.get("found", 0), ignorenulls=True).over(in_order(doc).rowsBetween(Window.unboundedPreceding, 0))


def block_of(rows: str) -> tuple[Column, Column, Column]:
    """first_line, evidence and block of a column with a name's lines, an array of (line_no, line) in order."""
    return F.get(rows, 0)["line_no"].alias("first_line"), F.get(rows, 0)["line"].alias("evidence"), F.array_join(F.transform(rows, lambda r: r["line"]), " ").alias("block")


def pairs_of_runs(rows: DataFrame, group: str, order: Sequence[str | Column], opens: Column, name: str) -> DataFrame:
    """(group, name, partner) of disjoint pairs: an element that opens is closed by the next element, which cannot open one itself.

    In a run of consecutive elements that open, those at odd places open and the
    ones at even places close; the element after a run closes if the run is odd.
    """
    out = with_partner(rows, Window.partitionBy(group).orderBy(*order), opens, name)
    return out.where(F.col("partner").isNotNull()).select(group, name, "partner")


def with_partner(rows: DataFrame, w: Window, opens: Column, name: str) -> DataFrame:
    """rows with the partner that each closes, null if it closes none; w is the window in the group's order."""
    flagged = rows.withColumn("_n", F.row_number().over(w)).withColumn("_o", F.coalesce(opens, F.lit(False)))
    quiet = F.max(F.when(~F.col("_o"), F.col("_n"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    flagged = flagged.withColumn("_place", F.when(F.col("_o"), F.col("_n") - F.coalesce(quiet, F.lit(0))).otherwise(0))
    closed = F.lag("_place", 1, 0).over(w) % 2 == 1
    return flagged.withColumn("partner", F.when(closed, F.lag(name).over(w))).drop("_n", "_o", "_place")


def both_ways(pairs: DataFrame, group: str, name: str) -> DataFrame:
    """Pairs with their reverses, each once."""
    back = pairs.select(group, F.col("partner").alias(name), F.col(name).alias("partner"))
    return pairs.unionByName(back).distinct()
