"""N-gram Jaccard join: banded MinHash candidates, Bayesian pruning, exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm import common as c

#: Words in a shingle, and the least similarity of a link.
WORDS, LEAST = 5, Fraction(4, 5)
#: Candidates agree in all ROWS hashes of one of BANDS bands. At similarity 0.8 a pair is missed with a chance of 3e-6.
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
#: A pair is dropped once the posterior probability of a link, from so many more hashes each time, falls below it.
TOLERANCE, STRIDE = 1e-7, 16
#: Documents, and shingles, in a tile; a group with more of either is cut into tiles that meet pairwise.
TILE, TILE_SHINGLES = 512, 400_000
#: Words in a worker's memo of word hashes; columns of a block of the incidence matrix.
MEMO, COLUMNS = 400_000, 4096

_rng = np.random.default_rng(5)
_XOR = _rng.integers(0, 1 << 64, HASHES, dtype=np.uint64, endpoint=False)
_ODD = _rng.integers(0, 1 << 64, HASHES, dtype=np.uint64, endpoint=False) | np.uint64(1)
_PLACE = _rng.integers(0, 1 << 64, 64, dtype=np.uint64, endpoint=False) | np.uint64(1)


class Hashes(dict):
    """Memo from words to hashes of 64 bits, cleared when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(27))


def shingles(words: list[bytes], memo: Hashes, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; a shorter text is one shingle, an empty one none."""
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - size + 1)
    total = np.full(n, min(len(h), size), np.uint64)
    for k in range(min(size, len(h))):
        total += mixed(h[k : k + n] + _PLACE[k]) * _PLACE[k]
    return np.unique(mixed(total))


def signature(s: np.ndarray) -> np.ndarray:
    """HASHES minima of a set of shingles, as 32-bit numbers."""
    low = np.full(HASHES, np.uint64(0xFFFFFFFF))
    for at in range(0, len(s), 4096):
        low = np.minimum(low, (((s[at : at + 4096, None] ^ _XOR) * _ODD) >> np.uint64(32)).min(0))
    return low.astype(np.uint32)


def floors(least: Fraction = LEAST, tolerance: float = TOLERANCE, hashes: int = HASHES, stride: int = STRIDE) -> list[tuple[int, int]]:
    """(m, fewest equal hashes among the first m that a pair needs to go on).

    With a uniform prior on the similarity, the posterior probability that it
    reaches t after k of m hashes agreed is P(Binomial(m + 1, t) <= k).
    """
    t = float(least)
    out = []
    for m in range(stride, hashes + 1, stride):
        below, k = 0.0, 0
        while True:
            below += comb(m + 1, k) * t**k * (1 - t) ** (m + 1 - k)
            if below >= tolerance:
                break
            k += 1
        out.append((m, k))
    return out


def prune(sig: np.ndarray, a: np.ndarray, b: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that no step drops, hashes compared a stride at a time."""
    equal = np.zeros(len(a), np.int64)
    done = 0
    for m, need in steps:
        if not len(a):
            break
        for at in range(0, len(a), 1 << 18):
            x, y = a[at : at + (1 << 18)], b[at : at + (1 << 18)]
            equal[at : at + (1 << 18)] += (sig[x, done:m] == sig[y, done:m]).sum(1)
        done = m
        keep = equal >= need
        a, b, equal = a[keep], b[keep], equal[keep]
    return a, b


def pairs(side: np.ndarray, alone: bool) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a tile with itself, or of the two sides of a meeting."""
    if alone:
        return np.triu_indices(len(side), 1)
    x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    return np.repeat(x, len(y)), np.tile(y, len(x))


def linked(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, least: Fraction = LEAST) -> np.ndarray:
    """Whether each pair of sets has at least that Jaccard similarity, exactly."""
    size = np.array([len(s) for s in sets], np.int64)
    if len(a) <= 8 * len(sets) and len(a) <= 256:
        both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a.tolist(), b.tolist(), strict=True)], np.int64)
    else:
        values, of = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), size)
        often = np.bincount(of, minlength=len(values)) > 1
        of, row = (np.cumsum(often) - 1)[of[often[of]]], row[often[of]]
        order = np.argsort(of, kind="stable")
        of, row = of[order], row[order]
        total = np.zeros((len(sets), len(sets)), np.float32)
        for at in range(0, int(often.sum()), COLUMNS):
            lo, hi = np.searchsorted(of, (at, at + COLUMNS))
            block = np.zeros((len(sets), COLUMNS), np.float32)
            block[row[lo:hi], of[lo:hi] - at] = 1
            total += block @ block.T
        both = total[a, b].astype(np.int64)
    return both * least.denominator >= (size[a] + size[b] - both) * least.numerator


# Stages on the executors


def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, id, key, size, sig) of each text."""
    memo = Hashes()
    for batch in batches:
        key, size, sig = [], [], []
        for text in batch.column(2):
            w = (text.as_py() or "").encode().split()
            s = shingles(w, memo)
            key.append(xxhash.xxh3_128_digest(b" ".join(w)))
            size.append(len(s))
            sig.append(signature(s).astype("<u4").tobytes() if len(s) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(key, pa.binary()), pa.array(size, pa.int64()), pa.array(sig, pa.binary())], ["row", "id", "key", "size", "sig"])


def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, band, row) for every band of each signature."""
    for batch in batches:
        raw = batch.column(1)
        if not len(raw):
            continue
        sig = np.frombuffer(b"".join(raw.to_pylist()), "<u4").reshape(len(raw), BANDS, ROWS).astype(np.uint64)
        h = np.zeros((len(raw), BANDS), np.uint64) + _PLACE[:BANDS]
        for k in range(ROWS):
            h = mixed(h ^ (sig[:, :, k] * _PLACE[40 + k]))
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64).reshape(-1)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(raw))), pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], ["bucket", "band", "row"])


def bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): enough of the likely pairs of each bucket's meeting to connect them.

    A pair is looked at in the first band in which it agrees, and nowhere else.
    """
    steps = floors()
    for group in c.runs(batches, 3):
        row = group.column("row").to_numpy()
        i, j, band = group.column("i")[0].as_py(), group.column("j")[0].as_py(), group.column("band")[0].as_py()
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), "<u4").reshape(len(row), HASHES)
        a, b = pairs(group.column("side").to_numpy(), i == j)
        for k in range(band):
            x = sig[:, k * ROWS : (k + 1) * ROWS]
            before = np.ones(len(a), bool)
            for col in x.T:
                before &= col[a] == col[b]
            a, b = a[~before], b[~before]
        a, b = prune(sig, a, b, steps)
        if len(a):
            _, used = c.forest(len(row), a, b)
            yield pa.RecordBatch.from_arrays([pa.array(row[a[used]]), pa.array(row[b[used]])], ["a", "b"])


def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(root, parts, node, sig, set) of the texts that have the wanted key, each node once a partition."""
    memo = Hashes()
    seen: set[int] = set()
    for batch in batches:
        keep, sig, sets = [], [], []
        for n, (text, key, node) in enumerate(zip(batch.column(0), batch.column(1), batch.column(4).to_pylist(), strict=True)):
            if node in seen:
                continue
            seen.add(node)
            w = (text.as_py() or "").encode().split()
            if xxhash.xxh3_128_digest(b" ".join(w)) == key.as_py():
                s = shingles(w, memo)
                keep.append(n), sig.append(signature(s).astype("<u4").tobytes()), sets.append(s.astype("<u8").tobytes())
        own = batch.take(pa.array(keep, pa.int64()))
        yield pa.RecordBatch.from_arrays([*own.columns[2:], pa.array(sig, pa.binary()), pa.array(sets, pa.binary())], ["root", "parts", "node", "sig", "set"])


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, links, root, other) from each meeting: a node's links; its cluster if the group is one tile; else edges that connect the linked."""
    steps = floors()
    for group in c.runs(batches, 3):
        node = group.column("node").to_numpy()
        _, first = np.unique(node, return_index=True)
        if len(first) < len(node):
            group = group.take(pa.array(first))
            node = node[first]
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), "<u4").reshape(len(node), HASHES)
        sets = [np.frombuffer(x, "<u8") for x in group.column("set").to_pylist()]
        a, b = prune(sig, *pairs(group.column("side").to_numpy(), group.column("i")[0].as_py() == group.column("j")[0].as_py()), steps)
        if not len(a):
            continue
        yes = linked(sets, a, b)
        a, b = a[yes], b[yes]
        if not len(a):
            continue
        count = np.bincount(np.concatenate((a, b)), minlength=len(node))
        up, used = c.forest(len(node), a, b)
        has = np.flatnonzero(count)
        whole = group.column("parts")[0].as_py() == 1
        blank = np.zeros(0, np.int64)
        ends = (node[a[used]], node[b[used]]) if not whole else (blank, blank)
        n, m = len(has), len(ends[0])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate((node[has], ends[0]))),
            pa.array(np.concatenate((count[has], np.zeros(m, np.int64)))),
            pa.array(np.concatenate((node[up[has]], np.zeros(m, np.int64))), mask=np.array([not whole] * n + [True] * m)),
            pa.array(np.concatenate((np.zeros(n, np.int64), ends[1])), mask=np.array([True] * n + [False] * m)),
        ], ["node", "links", "root", "other"])


def ngram_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: (id, class_id, class_size, n_links, cluster_id).

    Texts of the same words form a class, named by its smallest id. Two classes are
    linked if the Jaccard similarity of their sets of WORDS-word shingles is at
    least LEAST; n_links counts a class's links and cluster_id is the smallest id
    that links lead to. Texts of fewer words are one shingle. Null and empty texts
    form one class without links. A null id is behind all others, so a class or
    cluster has a null name only if all of its ids are null. Repeated rows are
    members of their class. An empty table gives no rows; further columns are ignored.

    Only signatures, ids and, of classes that have a likely partner, shingles are
    shuffled; no pairs are, except for as many as connect a group. A bucket or group
    that is too large for one task is cut into tiles that meet pairwise.
    """
    out = joined(df, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("rep").alias("class_id"), F.col("members").alias("class_size"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), "cluster_id")


def joined(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, print, row, rep, members, links, cluster_id, kept) per row of df; print is a hash of the text, and one row of each cluster is kept."""
    c.prepare(df.sparkSession)
    ident = df.schema[id_col].dataType.simpleString()
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("print", F.xxhash64("text"))
    numbered = docs.select(F.struct(F.monotonically_increasing_id().alias("row"), "print").alias("row"), "id", "text")
    rows = c.stored(c.in_arrow(numbered, described, f"row struct<row:bigint,print:bigint>, id {ident}, key binary, size long, sig binary").select("row.*", "id", "key", "size", "sig"))
    total = rows.count()
    best = F.min(F.struct(F.col("id").isNull().alias("z"), "id", "row", "print"))
    classes = c.stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), best.alias("best")).select("key", "members", F.col("best.id").alias("rep"), F.col("best.row").alias("node"), F.col("best.print").alias("rep_print")))
    reps = c.stored(c.attach(rows.where("size > 0"), classes, ["key"], "members", total).where("row = node").select("node", "rep", "rep_print", "key", "size", "sig"))

    bands = c.stored(c.in_arrow(reps.select("node", "sig"), banded, "bucket long, band int, row long"))
    crowds = c.stored(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1"))
    met = c.attach(bands, crowds, ["bucket"], "crowd", bands.count()).where("crowd is not null")
    met = c.tiles(met, "bucket", F.ceil(F.col("crowd") / TILE), "row").drop("crowd")
    met = met.join(reps.select(F.col("node").alias("row"), "sig"), "row").select("bucket", "i", "j", "band", "side", "row", "sig")
    likely = c.in_arrow(met.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"), bucketed, "a long, b long")
    groups = c.components(likely)

    groups = groups.join(reps.select("node", "rep", "rep_print", "key", "size"), "node")
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("crowd"), F.greatest(F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum("size") / TILE_SHINGLES)).cast("int").alias("parts"))
    groups = c.stored(c.attach(groups, c.stored(sizes), ["root"], "crowd", total).select("root", "parts", "node", "rep", "rep_print", "key"))
    # a class is read again by the id and the text of its first row, so that rows of one id, or of none, don't multiply
    found = c.same([docs["id"], docs["print"]], [F.col("rep"), F.col("rep_print")])
    wanted = docs.join(c.by_size(groups), found).select("text", "key", "root", "parts", "node")
    sets = c.in_arrow(wanted, shingled, "root long, parts int, node long, sig binary, set binary")
    sets = c.tiles(sets, "root", F.col("parts"), "node").select("root", "i", "j", "side", "parts", "node", "sig", "set")
    found = c.stored(c.in_arrow(sets.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j"), verified, "node long, links long, root long, other long"))
    links = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"), F.max("root").alias("root"))
    across = found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
    if across.limit(1).count():
        links = links.join(c.components(across).withColumnRenamed("root", "far"), "node", "left").withColumn("root", F.coalesce("root", "far")).drop("far")
    links = c.stored(links.join(reps.select("node", "rep"), "node"))
    first = F.min(F.struct(F.col("rep").isNull().alias("z"), "rep", "node"))
    names = c.stored(links.groupBy("root").agg(F.count(F.lit(1)).alias("crowd"), first.alias("first")))
    links = c.attach(links, names, ["root"], "crowd", links.count()).select("node", "links", "first")
    facts = classes.join(links, "node", "left")
    out = c.attach(rows.select("row", "id", "print", "key"), facts.select("key", "members", "rep", "node", "links", "first"), ["key"], "members", total)
    return out.select(
        "id", "print", "row", "rep", "members", "links",
        F.when(F.col("links") > 0, F.col("first.rep")).otherwise(F.col("rep")).alias("cluster_id"),
        (F.col("row") == F.coalesce("first.node", "node")).alias("kept"),
    )


def drop_near_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one row of each cluster, the one whose id names it; texts without words are one cluster.

    Rows are found again by id and a hash of the text, so that one id may have
    several texts, and rows without an id are told apart; of rows that agree in
    both, one stays where their cluster keeps one. The keys to drop are broadcast
    while they are few, else joined.
    """
    out = joined(df, id_col, text_col)
    keys = out.groupBy(F.col("id").alias("__tg_id"), F.col("print").alias("__tg_print")).agg(F.max("kept").alias("__tg_kept"), F.count(F.lit(1)).alias("__tg_rows"))
    keys = c.stored(keys.where("not __tg_kept or __tg_rows > 1"))
    mine = ["__tg_id", "__tg_print"]
    on = c.same([F.col(id_col), F.xxhash64(F.col(text_col).cast("string"))], [F.col(x) for x in mine])
    left = df.join(c.by_size(keys.where("not __tg_kept").select(*mine)), on, "left_anti")
    again = c.stored(keys.where("__tg_kept").select(*mine))
    if not again.limit(1).count():
        return left
    one = left.join(c.by_size(again), on, "inner").dropDuplicates(mine).select(*(left[x] for x in df.columns))
    return left.join(c.by_size(again), on, "left_anti").unionByName(one)
