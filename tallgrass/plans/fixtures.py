"""Documents composed from the part table, in the form that the extraction rules read.

The synthetic tables hold no such text. FIXTURE is one expression that Spark and
other SQL engines read alike, so a query and its oracle start from the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: A part's document: heading, tier, a section with a name, an inline status, and lines of services.
FIXTURE = """concat(
    'Product Summary', chr(10), upper(p_type), ' ', upper(p_name), chr(10),
    CASE p_size % 5 WHEN 0 THEN 'Gold cover for all' WHEN 1 THEN 'silver plus and more' WHEN 2 THEN 'a basic + plan' ELSE 'no tier is told' END, chr(10),
    CASE p_size % 3 WHEN 0 THEN 'This policy includes cover for' WHEN 1 THEN 'Restricted cover' ELSE 'Services not included' END, chr(10),
    'one ', p_name, chr(10),
    CASE WHEN p_size % 4 = 0 THEN 'note: the end' WHEN p_size % 4 = 1 THEN '' ELSE 'then an old anvil' END, chr(10),
    'and a ring or a plate', chr(10),
    CASE WHEN p_size % 2 = 0 THEN 'does not include cover for red bolt' ELSE 'it includes cover for cold rod' END, chr(10),
    'A ', split_part(p_name, ' ', 2), ' has a combined limit of $', CAST(100 * p_size AS VARCHAR(9)), ' and $1,', CAST(100 + p_size AS VARCHAR(9)), '.50 per policy', chr(10),
    'Served after ', CAST(p_size AS VARCHAR(9)), CASE WHEN p_size % 2 = 0 THEN ' months' ELSE ' Days' END, chr(10),
    'gizmo combined limit', chr(10), 'widget $ ', CAST(p_size AS VARCHAR(9)), chr(10), 'extras end')"""

#: Canonical names with aliases, as a schema declares them.
CATEGORIES = (("RedThing", ("red bolt", "red gear", "red rod")), ("OldAnvil", ("anvil",)), ("Ring", ()), ("ColdRod", ("cold rod", "cold ring")), ("SmallPart", ("small",)))
SERVICES = (("Gear", ()), ("Bolt", ("bolts",)), ("Gizmo", ()), ("Widget", ()), ("Rod", ("rods", "stick")), ("Plate", ("plates",)), ("Anvil", ()))


def phrases(names: tuple[tuple[str, tuple[str, ...]], ...]) -> list[tuple[int, str, str]]:
    """(place, name, phrase form) of every alias, the name's own two forms among them."""
    from tallgrass.operators.lines import phrase
    from tallgrass.sources.schemas import decamelised

    return [(i, n, p) for i, (n, given) in enumerate(names) for p in dict.fromkeys(phrase(a) for a in (*given, n, decamelised(n)))]


def values(names: tuple[tuple[str, tuple[str, ...]], ...]) -> str:
    """A VALUES list (ord, name, alias) of phrases."""
    return ", ".join(f"({i}, '{n}', '{p}')" for i, n, p in phrases(names))


def aliases(names: tuple[tuple[str, tuple[str, ...]], ...]) -> list[tuple[str, list[str]]]:
    from tallgrass.sources.schemas import Section

    return Section(aliases={n: list(a) for n, a in names}).alias_table()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, path) of every part."""
    return spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr("p_partkey AS doc_id", f"{FIXTURE} AS text", "concat('data/PDFs/F', CAST(p_partkey % 7 AS VARCHAR(9)), '/', CASE WHEN p_size % 2 = 0 THEN 'Hospital' ELSE 'extras' END, '/', replace(p_name, ' ', '-'), '.pdf') AS path")
