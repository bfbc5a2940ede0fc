"""Mixing sources to target weights by min-cost flow over membership patterns."""

from __future__ import annotations

import heapq
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallgrass.llm import common as c

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (5, 2, 1)
#: Share of all words that the mix takes, as a fraction; most copies of a document; seed of its choice.
SHARE, COPIES, SEED = (3, 2), 2, "mix-17"
#: Before single documents are ranked, so many times a pattern's hashes are summed by so many more hexadecimal digits.
LEVELS, DIGITS = 3, 2
#: Membership patterns that the driver solves for at most. Beyond it the call raises; no row is dropped.
MOST_PATTERNS = 200_000


def words(text: Column) -> Column:
    """Number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(c.WORD)), F.lit(0)).cast("long")


def water_level(sizes: list[int], weights: list[int], share: tuple[int, int], copies: int) -> list[float]:
    """Targets min(copies * size, level * weight) that sum to share of all sizes, or to all the copies there are."""
    total = share[0] * sum(sizes) / share[1]
    order = sorted(range(len(sizes)), key=lambda i: Fraction(copies * sizes[i], weights[i]))
    full, left = 0, sum(weights)
    level = float("inf")
    for i in order:
        if total - full <= Fraction(copies * sizes[i], weights[i]) * left:
            level = (total - full) / left
            break
        full, left = full + copies * sizes[i], left - weights[i]
    return [float(min(copies * s, level * w)) for s, w in zip(sizes, weights, strict=True)]


def flow(capacity: list[int], members: list[tuple[int, ...]], quota: list[int], copies: int) -> list[list[int]]:
    """Words per pattern and copy that a cheapest largest flow from patterns to source quotas sends.

    Pattern p offers `copies` layers of capacity[p] words; a word of layer k costs
    k * k, a convex price of repetition. members[p] are the sources that p may
    serve. Shortest augmenting paths with potentials.
    """
    n_p, n_s = len(capacity), len(quota)
    source, sink = 0, 1 + n_p + n_s
    graph: list[list[list[int]]] = [[] for _ in range(sink + 1)]

    def arc(a: int, b: int, cap: int, cost: int) -> None:
        graph[a].append([b, cap, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for p, cap in enumerate(capacity):
        for k in range(copies):
            arc(source, 1 + p, cap, k * k)
        for s in members[p]:
            arc(1 + p, 1 + n_p + s, copies * cap, 0)
    for s, q in enumerate(quota):
        arc(1 + n_p + s, sink, q, 0)
    height = [0] * (sink + 1)
    while True:
        cost: list[float] = [float("inf")] * (sink + 1)
        via: list[tuple[int, int] | None] = [None] * (sink + 1)
        cost[source], queue = 0, [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > cost[a]:
                continue
            for i, (b, cap, price, _) in enumerate(graph[a]):
                if cap > 0 and (e := d + price + height[a] - height[b]) < cost[b]:
                    cost[b], via[b] = e, (a, i)
                    heapq.heappush(queue, (e, b))
        if via[sink] is None:
            break
        height = [int(h + min(d, cost[sink])) for h, d in zip(height, cost, strict=True)]
        path, at = [], sink
        while at != source:
            path.append(via[at])
            at = via[at][0]
        push = min(graph[a][i][1] for a, i in path)
        for a, i in path:
            graph[a][i][1] -= push
            graph[graph[a][i][0]][graph[a][i][3]][1] += push
    return [[cap - graph[0][copies * p + k][1] for k in range(copies)] for p, cap in enumerate(capacity)]


def plan(totals: list[tuple[tuple[str | None, ...], int]], weights: tuple[int, ...], share: tuple[int, int], copies: int) -> tuple[dict, dict]:
    """(source: (size, target)), (pattern: words per copy). Patterns that no other pattern's sources meet are solved apart."""
    rank = sorted({s for p, _ in totals for s in p}, key=lambda s: (s is None, s))
    at = {s: i for i, s in enumerate(rank)}
    size = [0] * len(rank)
    for p, n in totals:
        for s in p:
            size[at[s]] += n
    weight = [weights[i % len(weights)] for i in range(len(rank))]
    target = water_level(size, weight, share, copies) if rank else []
    group = list(range(len(rank)))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for p, _ in totals:
        for s in p[1:]:
            group[root(at[s])] = root(at[p[0]])
    apart: dict[int, list[int]] = {}
    for i, (p, _) in enumerate(totals):
        if p:
            apart.setdefault(root(at[p[0]]), []).append(i)
    sent: dict = {p: [0] * copies for p, _ in totals}
    for own in apart.values():
        here = sorted({at[s] for i in own for s in totals[i][0]})
        local = {s: k for k, s in enumerate(here)}
        got = flow([totals[i][1] for i in own], [tuple(local[at[s]] for s in totals[i][0]) for i in own], [int(target[s] + 0.5) for s in here], copies)
        sent |= {totals[i][0]: g for i, g in zip(own, got, strict=True)}
    return {s: (size[i], target[i]) for s, i in at.items()}, sent


def hash_of(ident: Column, seed: str = SEED) -> Column:
    """What orders documents: md5 of seed and id, in hexadecimal."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))).cast("binary"))


def mix(df: DataFrame, id_col: str = "doc_id", sources: Column | None = None, size: Column | None = None, weights: tuple[int, ...] = WEIGHTS, share: tuple[int, int] = SHARE, copies: int = COPIES, seed: str = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, patterns, targets) of a mix that draws `share` of all words.

    rows: (id, pattern, size, hash) per row of df, stored. patterns: (pattern,
    words, base, cut, extra): each document of the pattern is taken `base` times,
    and once more if hash <= cut or hash = extra. targets: (source, source_size, target).

    sources is an array column of the sources that hold a document (default: the
    one in `source`); its order and repeats don't matter and null counts as a
    source, so a null array is the pattern [null]. size defaults to the words of
    `text`. A null id hashes as an empty string; equal ids are taken alike. An
    empty table gives empty results. Further columns are ignored.

    Only pattern totals reach the driver. Documents of a pattern are ordered by
    hash: sums of hash ranges, narrowed LEVELS times, find the range where the quota
    ends, and only that range's documents are ranked; a hot source is never sorted.
    """
    spark = df.sparkSession
    sources = F.array("source") if sources is None else F.coalesce(sources, F.array(F.lit(None).cast("string")))
    size = words(F.col("text")) if size is None else size
    rows = c.stored(df.select(F.col(id_col).alias("id"), F.array_sort(F.array_distinct(sources.cast("array<string>"))).alias("pattern"), size.cast("long").alias("size"), hash_of(F.col(id_col), seed).alias("hash")))
    totals = [(tuple(r["pattern"]), r["n"]) for r in rows.groupBy("pattern").agg(F.sum("size").alias("n")).limit(MOST_PATTERNS + 1).collect()]
    if len(totals) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} membership patterns")
    totals.sort(key=lambda x: [(s is None, s or "") for s in x[0]])
    facts, sent = plan(totals, weights, share, copies)
    planned = []
    for p, n in totals:
        taken = sum(sent[p])
        base = min(copies, taken // n) if n else 0
        planned.append((list(p), n, base, taken - base * n))
    chosen = spark.createDataFrame(planned, "pattern array<string>, words long, base int, quota long")
    targets = spark.createDataFrame([(s, *v) for s, v in facts.items()], "source string, source_size long, target double")

    # the hash range where each quota ends, narrowed digit by digit
    edge, ends = rows.withColumn("bucket", F.lit("")), chosen.where("quota > 0").select("pattern", F.lit("").alias("bucket"), F.lit(0).cast("long").alias("before"), "quota")
    for level in range(1, LEVELS + 1):
        edge = edge.join(F.broadcast(ends), ["pattern", "bucket"]).withColumn("bucket", F.substring("hash", 1, DIGITS * level))
        sums = edge.groupBy("pattern", "before", "quota", "bucket").agg(F.sum("size").alias("n"))
        below = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("before", F.col("before") + F.coalesce(F.sum("n").over(below), F.lit(0)))
        ends = c.stored(sums.where("before < quota and before + n >= quota").select("pattern", "bucket", "before", "quota"))
        edge = rows.withColumn("bucket", F.substring("hash", 1, DIGITS * level))
    edge = edge.join(F.broadcast(ends), ["pattern", "bucket"])
    edge = edge.groupBy("pattern", "bucket", "before", "quota", "hash").agg(F.sum("size").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("pattern", "bucket").orderBy("hash"))
    edge = edge.withColumn("upto", F.col("before") + upto)
    fits = F.when(F.col("upto") <= F.col("quota"), F.struct("hash", "upto"))
    edge = edge.groupBy("pattern", "before", "quota").agg(F.max(fits).alias("last"), F.min("hash").alias("first"))
    # up to the last hash whose words still fit; below the range's first hash if none fits
    cuts = edge.select("pattern", F.coalesce("last.hash", F.substring("first", 1, 31)).alias("cut"), (F.col("quota") - F.coalesce("last.upto", "before")).alias("gap"))
    cuts = c.stored(chosen.join(F.broadcast(cuts), "pattern", "left"))
    # one more document, the largest that fits, closes the gap that the next one in order would overshoot
    near = rows.join(F.broadcast(cuts.select("pattern", "cut", "gap")), "pattern").where("hash > cut and size <= gap and size > 0")
    extra = near.groupBy("pattern").agg(F.max(F.struct("size", "hash"))["hash"].alias("extra"))
    patterns = cuts.join(F.broadcast(extra), "pattern", "left").select("pattern", "words", "base", "cut", "extra")
    return rows, c.stored(patterns), targets


def taken(base: Column, cut: Column, extra: Column, hashed: Column) -> Column:
    """How many times a document is taken."""
    return F.coalesce(base, F.lit(0)) + F.when((hashed <= cut) | F.coalesce(hashed == extra, F.lit(False)), 1).otherwise(0)


def draw(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """df with each row as many times as the mix takes it, and its own columns.

    The decision is one comparison per row with its pattern's cut, which is
    broadcast (at most MOST_PATTERNS rows); texts are not shuffled.
    """
    options = {"sources": F.array("source")} | options
    _, patterns, _ = mix(df, id_col, **options)
    pattern = F.array_sort(F.array_distinct(F.coalesce(options["sources"], F.array(F.lit(None).cast("string"))).cast("array<string>")))
    cuts = patterns.select(*(F.col(x).alias(f"__tg_{x}") for x in ("pattern", "base", "cut", "extra")))
    times = taken(F.col("__tg_base"), F.col("__tg_cut"), F.col("__tg_extra"), hash_of(F.col(id_col), options.get("seed", SEED)))
    out = df.join(F.broadcast(cuts), pattern == F.col("__tg_pattern"))
    return out.withColumn("__tg_copy", F.explode(F.array_repeat(F.lit(0), times))).select(*df.columns)
