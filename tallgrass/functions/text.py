"""Column functions on strings: cleaning, name forms, and values read out of text.

Character classes are spelt out, so that results don't depend on what a regex
engine takes for white space. A null input gives null unless a docstring says
otherwise; text that doesn't parse gives null, never an error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, and what ends a line.
SPACE = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BREAK = r"\r\n|[\n-\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
#: A dollar amount.
AMOUNT = r"\$" + SPACE + r"*[0-9,]+(?:\.[0-9]{2})?"
#: Amounts of excess that a product name can tell.
EXCESSES = (250, 500, 600, 750, 1000, 1500)


def found(x: Column, pattern: str, group: int = 1) -> Column:
    """What a group of the first match holds; null without a match or if it is empty."""
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit(""))


def clean(x: Column) -> Column:
    """Runs of white space as one space, none at either end; a null cell becomes an empty string."""
    return F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), SPACE + "+", " "))


def words(x: Column) -> Column:
    """Number of words of a cleaned text."""
    return F.when(x == "", 0).otherwise(F.size(F.split(x, " ", -1)))


def phrase_form(x: Column) -> Column:
    """Lower-case alphanumeric words, one space between and around them: whole-word phrases are then substrings."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(x), "[^a-z0-9]+", " ")), F.lit(" "))


def name_form(x: Column) -> Column:
    """Lower-case letters and digits only; null counts as empty."""
    return F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", "")


def decamelised(x: Column) -> Column:
    """A space before every capital but the first character."""
    return F.trim(F.replace(F.regexp_replace(x, "(?<!^)(?=[A-Z])", " "), F.lit("  "), F.lit(" ")))


def canonical_form(x: Column) -> Column:
    """Alphanumeric runs, each capitalised, without anything between them."""
    runs = F.regexp_extract_all(x, F.lit("[A-Za-z0-9]+"), 0)
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2))))), "")


def is_heading(x: Column) -> Column:
    """All capitals (or no letter) and up to 10 words, or every word capitalised and up to 5 words."""
    title = x.rlike(r"\p{Lu}") & ~x.rlike(r"(?<!\p{L})\p{Ll}|\p{L}\p{Lu}")
    return ((F.upper(x) == x) & (words(x) <= 10)) | (title & (words(x) <= 5))


def waiting_period(x: Column) -> Column:
    """First number of days, months or years, as `12 Month`."""
    pattern = rf"(?i)([0-9]+){SPACE}*(day|month|year)"
    return F.when(x.rlike(pattern), F.concat(F.regexp_extract(x, pattern, 1), F.lit(" "), F.initcap(F.lower(F.regexp_extract(x, pattern, 2)))))


def waiting_parts(x: Column) -> tuple[Column, Column]:
    """(value, unit) of a waiting period, weeks among them."""
    pattern = rf"(?i)([0-9]+){SPACE}*(day|week|month|year)"
    return found(x, pattern, 1).try_cast("int"), F.initcap(F.lower(found(x, pattern, 2)))


def amount(x: Column) -> Column:
    """A dollar amount as a number; null if no digit is left."""
    return F.regexp_replace(x, r"[$,]|" + SPACE, "").try_cast("double")


def amounts(x: Column) -> Column:
    return F.regexp_extract_all(x, F.lit(AMOUNT), 0)


def limits(x: Column) -> tuple[Column, Column]:
    """(per person, per policy): the first two dollar amounts of a text."""
    all_of = F.transform(amounts(x), amount)
    return F.get(all_of, 0), F.get(all_of, 1)


def whole(x: Column) -> Column:
    """A number without its fraction."""
    return x.try_cast("bigint")


def excess(name: Column) -> Column:
    """The first number of two to four digits in a name, if it is one of EXCESSES."""
    value = found(name, r"(?<![0-9A-Za-z_])([0-9]{2,4})(?![0-9A-Za-z_])").try_cast("int")
    return F.when(value.isin(*EXCESSES), value)


def excess_applies(value: Column) -> Column:
    return F.when(value.isNotNull(), "PerCalendarYear")


def truth(x: Column) -> Column:
    """Whether a cell says true; anything else, null too, is false."""
    return F.coalesce(F.lower(clean(x)) == "true", F.lit(False))


def number(x: Column) -> Column:
    return F.nullif(clean(x), F.lit("")).try_cast("double")


def period(value: Column, unit: Column) -> Column:
    """`value unit` of two cells; null unless both hold something."""
    v, u = clean(value), clean(unit)
    return F.when((v != "") & (u != ""), F.concat(v, F.lit(" "), u))


def near(a: Column, b: Column) -> Column:
    """Whether two numbers agree within 1e-5, relative or absolute."""
    return F.abs(a - b) <= F.greatest(1e-5 * F.greatest(F.abs(a), F.abs(b)), F.lit(1e-5))


def equal_values(a: Column, b: Column, kind: Column) -> Column:
    """Two values in text form: numbers (kind 'number' on either side) within tolerance, all else alike; an unparsable number never agrees."""
    x, y = a.try_cast("double"), b.try_cast("double")
    return F.when(kind == "number", F.coalesce(near(x, y), F.lit(False))).otherwise(a.eqNullSafe(b))


def normal_value(x: Column) -> Column:
    return clean(x)


def normal_list(x: Column) -> Column:
    return F.array_sort(F.transform(x, lambda v: v.cast("string")))


def parts_of(path: Column) -> Column:
    return F.filter(F.split(path, "/", -1), lambda p: p != "")


def fund_code(path: Column, folder: str = "PDFs") -> Column:
    """The path's part after the first folder of that name."""
    parts = parts_of(path)
    at = F.array_position(parts, folder)
    return F.when(at > 0, F.get(parts, at.cast("int")))


def path_product_type(path: Column) -> Column:
    """What the first folder of a known name says: Hospital or GeneralHealth."""
    known = F.filter(F.transform(parts_of(path), F.lower), lambda p: p.isin("hospital", "extras", "generalhealth"))
    return F.when(F.get(known, 0) == "hospital", "Hospital").when(F.get(known, 0).isNotNull(), "GeneralHealth")


def stem(path: Column) -> Column:
    """A path's last part without its last suffix; a leading dot is no suffix."""
    name = F.coalesce(F.element_at(F.concat(F.array(F.lit("")), parts_of(path)), -1), F.lit(""))
    return F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")).otherwise(name)


def output_path(path: Column, vertical: str) -> Column:
    """Where a document's result goes: its last four parts, `.json`, never outside the folder of results."""
    parts = F.filter(parts_of(path), lambda p: ~p.isin(".", ".."))
    last = F.slice(parts, F.greatest(F.size(parts) - 3, F.lit(1)), F.lit(4))
    return F.concat(F.lit(f"outputs/{vertical}/extractions/"), F.regexp_replace(F.array_join(last, "/"), r"(?<=[^/])\.[^./]*$", ""), F.lit(".json"))


def table_coverage(tables: Column, text: Column) -> Column:
    """Characters in table cells over characters of text, 1 at most."""
    cells = F.flatten(F.flatten(tables))
    total = F.aggregate(F.coalesce(cells, F.array().cast("array<string>")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(F.length(x), F.lit(0)))
    return F.least(total / F.greatest(F.length(F.coalesce(text, F.lit(""))), F.lit(1)), F.lit(1.0))


def route(coverage: Column) -> Column:
    return F.when(coverage > 0.3, "table_assisted").otherwise("text_only")


def kept_tables(tables: Column) -> Column:
    """Cleaned tables without rows whose cells are all blank, and without empty tables."""
    cleaned = F.transform(tables, lambda t: F.filter(F.transform(t, lambda r: F.transform(r, clean)), lambda r: F.exists(r, lambda x: x != "")))
    return F.filter(cleaned, lambda t: F.size(t) > 0)


def product_type(has_hospital: Column, has_extras: Column) -> Column:
    return F.when(has_hospital & has_extras, "Combined").when(has_hospital, "Hospital").when(has_extras, "GeneralHealth").otherwise("Hospital")


def link_type(text: Column, hints: dict[str, str] | None = None) -> Column:
    """A link's product type: the first hint, in the order given, whose keyword its text holds; then the usual words."""
    low = F.lower(text)
    out = F.when(F.lit(False), "")
    for keyword, kind in (hints or {}).items():
        out = out.when(F.contains(low, F.lit(keyword.lower())), kind)
    return out.when(F.contains(low, F.lit("hospital")), "hospital").when(F.contains(low, F.lit("extra")), "extras").otherwise("general")


def absolute_url(base: Column, href: Column) -> Column:
    """href resolved against base as browsers do for http addresses: absolute, scheme-relative, rooted, query, fragment, relative with dots."""
    root = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    plain = F.regexp_replace(base, r"[?#].*$", "")
    path = F.substr(plain, F.length(root) + 1)
    folder = F.when(path == "", "/").otherwise(F.regexp_replace(path, r"[^/]*$", ""))
    tail = F.regexp_extract(href, r"^([^?#]*)([?#].*)?$", 2)
    joined = F.concat(F.when(href.startswith("/"), F.lit("")).otherwise(folder), F.regexp_replace(href, r"[?#].*$", ""))
    steps = F.split(joined, "/", -1)
    # empty parts inside a joined path go, as those of a rooted one don't
    inner = F.filter(F.slice(steps, F.lit(2), F.greatest(F.size(steps) - 2, F.lit(0))), lambda x: x != "")
    steps = F.when(href.startswith("/"), steps).otherwise(F.concat(F.slice(steps, 1, 1), inner, F.slice(steps, -1, 1)))
    last = F.element_at(steps, -1)
    empty = F.array().cast("array<string>")
    up = F.aggregate(steps, empty, lambda a, x: F.when(x == "..", F.when(F.size(a) > 1, F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(a)).when(x == ".", a).otherwise(F.concat(a, F.array(x))))
    up = F.when(last.isin(".", ".."), F.concat(up, F.array(F.lit("")))).otherwise(up)
    return (
        F.when(href == "", base)
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1), href))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), href))
        .when(href.startswith("?"), F.concat(plain, href))
        .otherwise(F.concat(root, F.array_join(up, "/"), tail))
    )


def url_name(url: Column) -> Column:
    """The last part of an address, its query included."""
    return F.element_at(F.split(url, "/", -1), -1)


def now_utc() -> Column:
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def clean_or_null(x: Column) -> Column:
    """Cleaned text; null stays null."""
    return F.when(x.isNotNull(), clean(x))
