"""Quality rules whose cutoffs are learnt per language and source from mergeable quantile sketches."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm import common as c

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Quantile sketches keep so many values at each level; smaller groups are kept exactly.
SKETCH = 800
#: The cutoff of a rate lies TIMES spreads above the group's median; its spread is the distance from there to UPPER.
UPPER, TIMES = 0.9, 8.0
#: A group's median and spread count as so many documents of its parent's: (language, source), language, all.
PARENT = 200
#: A spread is at most so many times the parent's: a source of junk does not excuse itself.
SLACK = 2.0
#: rate: (numerator, denominator, resolution). A spread below the resolution, as in groups nearly all of
#: whose documents have none of a thing, counts as the resolution.
RATES = {
    "symbol_rate": ("n_symbols", "n_words", 0.02),
    "dup_line_rate": ("n_dup_lines", "n_lines", 0.05),
    "repeat_rate": ("n_repeat_words", "n_words", 0.036),
    "echo_rate": ("n_echoes", "n_words", 0.002),
    "upper_rate": ("n_upper", "n_letters", 0.002),
    "word_length": ("word_chars", "n_words", 0.05),
}

_rng = np.random.default_rng(20)
_WEIGHTS = _rng.integers(1, 1 << 63, WINDOW, dtype=np.uint64) | np.uint64(1)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_echoes")


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of `window` words that occur twice or more, first occurrences included.

    Windows are compared by a random linear hash of 64 bits over mixed word
    numbers; those that agree in it are compared word by word.
    """
    n = len(words) - window + 1
    if n < 2:
        return 0
    number = dict(zip(dict.fromkeys(words), range(len(words))))
    if len(number) == len(words):
        return 0
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    mixed = (ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    total = np.zeros(n, np.uint64)
    for k in range(window):
        total += mixed[k : k + n] * _WEIGHTS[k % WINDOW]
    order = np.argsort(total, kind="stable")
    ranked = total[order]
    equal = ranked[1:] == ranked[:-1]
    if not equal.any():
        return 0
    a, b = order[:-1][equal], order[1:][equal]
    same = np.ones(len(a), bool)
    for k in range(window):
        same &= ids[a + k] == ids[b + k]
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.unique(np.concatenate((a[same], b[same])))
    edges[starts] += 1
    np.add.at(edges, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)[: len(words)]))


@functools.cache
def kinds() -> np.ndarray:
    """Kind of every code point: 1 a letter, 2 an upper-case letter, 3 a symbol, 4 white space, 0 anything else."""
    table = np.fromiter((x.isalpha() + x.isupper() if x.isalpha() else 0 for x in map(chr, range(0x110000))), np.uint8, 0x110000)
    table[[ord(x) for x in SYMBOLS]], table[[ord(x) for x in c.SPACES]] = 3, 4
    return table


def counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of a whole text; a null text has none of anything."""
    if not text:
        return (0,) * len(COUNTS)
    words = text.encode().split()
    of = np.bincount(kinds()[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=5).tolist()
    lines = [x for x in text.split("\n") if x.strip(c.SPACES)]
    echoes = sum(map(bytes.__eq__, words[1:], words))
    return len(words), len(text) - of[4], of[3], len(lines) - len(set(lines)), repeated_words(words), len(lines), of[1] + of[2], of[2], echoes


def measured(df: DataFrame, text_col: str = "text", name: str = "__tg_q") -> DataFrame:
    """df with a struct column of COUNTS, computed in Arrow batches over whole texts."""
    c.prepare(df.sparkSession)
    schema = "struct<" + ",".join(f"{x}:bigint" for x in COUNTS) + ">"

    @F.arrow_udf(schema)
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def each() -> Iterator[pa.Array]:
            for texts in batches:
                rows = np.array([counts(x.as_py()) for x in texts], np.int64).reshape(-1, len(COUNTS))
                yield pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(COUNTS))], list(COUNTS))

        return c.released(each())

    return df.withColumn(name, measure(F.col(text_col).cast("string")))


def base_failed(q: str = "__tg_q") -> Column:
    """Fewer than 20 words, or over 30 % of them in repeated windows."""
    return (F.col(f"{q}.n_words") < 20) | (100 * F.col(f"{q}.n_repeat_words") > 30 * F.col(f"{q}.n_words"))


def rate(name: str, q: str = "__tg_q") -> Column:
    top, below, _ = RATES[name]
    return F.coalesce(F.col(f"{q}.{top}") / F.nullif(F.col(f"{q}.{below}").cast("double"), F.lit(0.0)), F.lit(0.0))


def learn(rows: DataFrame, lang: str = "lang", source: str = "source", q: str = "__tg_q") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cutoffs of every (language, source), of every language, and of all: (keys..., n, cuts), where cuts is a struct by rate.

    rows are stored measurements of documents that pass the base rules. One
    sketch per rate and (language, source) is aggregated, partially before the
    shuffle; sketches merge upward to languages and to all. Null is a value of
    either column. A group's median and spread are weighed with its parent's by
    numbers of documents (PARENT), so that a group of any size has cutoffs of its own,
    whatever else the table holds.
    """
    k = F.lit(SKETCH)
    parts = rows.groupBy(F.col(lang).alias("lang"), F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("n"), *(F.kll_sketch_agg_double(rate(x, q), k).alias(x) for x in RATES))
    parts = c.stored(parts)
    merged = [F.sum("n").alias("n"), *(F.kll_merge_agg_double(x, k).alias(x) for x in RATES)]
    langs = c.stored(parts.groupBy("lang").agg(*merged))
    whole = langs.agg(*merged).where("n > 0")

    def facts(df: DataFrame, *keys: str) -> DataFrame:
        at = lambda x, p: F.kll_sketch_get_quantile_double(x, F.lit(p))
        return df.select(*keys, "n", *(F.struct(at(x, 0.5).alias("mid"), (at(x, UPPER) - at(x, 0.5)).alias("spread")).alias(x) for x in RATES))

    def drawn(own: DataFrame, *keys: str) -> DataFrame:
        """own, with the parent's facts in p_<rate>, drawn towards them."""
        share = F.col("n") / (F.col("n") + PARENT)
        out = []
        for x, (_, _, least) in RATES.items():
            mid = share * F.col(x)["mid"] + (1 - share) * F.col(f"p_{x}")["mid"]
            spread = share * F.col(x)["spread"] + (1 - share) * F.col(f"p_{x}")["spread"]
            out.append(F.struct(mid.alias("mid"), F.least(spread, SLACK * F.greatest(F.col(f"p_{x}")["spread"], F.lit(least))).alias("spread")).alias(x))
        return own.select(*keys, "n", *out)

    def cut(df: DataFrame, *keys: str) -> DataFrame:
        return c.stored(df.select(*keys, "n", F.struct(*((F.col(x)["mid"] + TIMES * F.greatest(F.col(x)["spread"], F.lit(least))).alias(x) for x, (_, _, least) in RATES.items())).alias("cuts")))

    top = c.stored(facts(whole))
    above = top.select(F.struct(*RATES)).scalar()
    middle = facts(langs, "lang").withColumn("_p", above).select("*", *(F.col("_p")[x].alias(f"p_{x}") for x in RATES))
    middle = c.stored(drawn(middle, "lang"))
    over = middle.select("lang", "n", *(F.col(x).alias(f"p_{x}") for x in RATES)).withColumnRenamed("n", "_docs")
    low = c.attach(facts(parts, "lang", "source"), over, ["lang"], "_docs")
    return cut(drawn(low, "lang", "source"), "lang", "source"), cut(middle, "lang"), cut(top)


def judged(df: DataFrame, cuts: DataFrame, total: int, q: str = "__tg_q") -> DataFrame:
    """df, which has measurements, lang and source, with booleans base_failed and kept: no rate lies above its (language, source)'s cutoff."""
    out = c.attach(df, cuts, ["lang", "source"], "n", total)
    over = F.lit(False)
    for x in RATES:
        over = over | F.coalesce(rate(x, q) > F.col("cuts")[x], F.lit(False))
    return out.withColumn("base_failed", base_failed(q)).withColumn("kept", ~F.col("base_failed") & ~over)


def quality_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per row of df: (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept).

    Whole texts are measured once into a narrow stored table. Null texts have no
    words and fail the base rules; a null language or source is a value like any
    other; repeated rows are judged alike; an empty table gives no rows; further
    columns are ignored.
    """
    rows = c.stored(measured(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"), F.col(lang).alias("lang"), F.col(source).alias("source")), "_text").drop("_text"))
    cuts, _, _ = learn(rows.where(~base_failed()))
    out = judged(rows, cuts, rows.count())
    return out.select(F.col("id").alias(id_col), *(F.col(f"__tg_q.{x}").alias(x) for x in COUNTS[:5]), "base_failed", "kept")


def drop_bad(df: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of df that the rules keep, with df's own columns.

    Texts are measured once: the rows that pass the base rules are stored with
    their measurements, and filtered from there. No join is by id. The cutoffs are
    broadcast while they are few, else joined.
    """
    own = [F.col(x).alias(f"c{i}") for i, x in enumerate(df.columns)]
    rows = df.select(*own, F.col(text_col).cast("string").alias("_text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    rows = c.stored(measured(rows, "_text").drop("_text").where(~base_failed()))
    cuts, _, _ = learn(rows)
    return judged(rows, c.by_size(cuts), rows.count()).where("kept").select(*(F.col(f"c{i}").alias(x) for i, x in enumerate(df.columns)))
