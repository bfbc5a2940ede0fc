"""What the corpus operators share: scratch tables, bounded broadcasts, joins on hot keys, components.

No function here keeps state on an executor's own disk, collects a table whose
size follows the corpus, or uses localCheckpoint.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.operators.skew import attach, same

__all__ = ["attach", "by_size", "components", "forest", "in_arrow", "prepare", "released", "runs", "same", "scratch", "small", "stored", "tiles"]

#: Characters that separate words, and that exact dedup deletes.
SPACES = " \t\n\x0b\x0c\r"
#: A word, as a regular expression for Spark.
WORD = r"[^\x20\x09-\x0D]+"
#: Most rows and bytes of a table that is broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 24 << 20
#: Rows and bytes of an Arrow batch, so that a batch of long texts stays small; settings of the user's own go first.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def prepare(spark: SparkSession) -> SparkSession:
    """Bounds Arrow batches for texts of any length and gives executors this package, once per context."""
    context = spark.sparkContext
    if not getattr(context, "_tallgrass_sent", False):
        root = Path(__file__).resolve().parents[1]
        with tempfile.NamedTemporaryFile(prefix="tallgrass-", suffix=".zip", delete=False) as f, zipfile.ZipFile(f, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        context.addPyFile(f.name)
        context._tallgrass_sent = True
    for name, most in BATCH.items():
        if spark.conf.get(name, "7") == "7":
            spark.conf.set(name, str(most))
    return spark


def released(out: Iterator) -> Iterator:
    """out, and at its end the worker gives back what its allocators hold: workers live on from stage to stage."""
    try:
        yield from out
    finally:
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)


def in_arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """df.mapInArrow by a function whose worker gives memory back after each task."""
    return df.mapInArrow(lambda batches: released(f(batches)), schema)


def scratch(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; one of our own only in local mode where it is unset."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = getattr(spark, "_tallgrass_scratch", None) or tempfile.mkdtemp(prefix="tallgrass-")
        spark._tallgrass_scratch = where
    return where.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch(spark)}/tallgrass/{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> bool:
    """Whether df, a stored table, has at most so many rows and bytes."""
    wide = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    many = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map")]
    size = F.lit(16 * len(df.columns))
    for x in wide:
        size = size + F.coalesce(F.octet_length(x), F.lit(0))
    for x in many:
        size = size + 32 * F.greatest(F.size(x), F.lit(0))
    n, total = df.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    return n <= rows and (total or 0) <= most


def by_size(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if its rows and bytes were counted and are few; else as it is, for a shuffled join."""
    return F.broadcast(df) if small(df, rows) else df


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node of the edges; root is its component's smallest node.

    Alternates large-star and small-star, each an aggregation and a join on
    narrow rows; the edges are written after every round, until all are stars. A hub's row lists are never gathered: its smallest neighbour is an
    aggregate that is joined back.
    """
    e = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    while True:
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        large = stored(star(both.where("v > u"), low.withColumn("m", F.least("u", "m")), 2 * e.count()))
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        e = stored(star(large, low, large.count()).union(low.select("u", "m")).distinct())
        # all are stars once no node has two smaller neighbours, or a smaller and a larger one
        ends = e.select("u", F.lit(1).alias("below"), F.lit(0).alias("above")).union(e.select("v", F.lit(0), F.lit(1)))
        if ends.groupBy("u").agg(F.sum("below").alias("below"), F.max("above").alias("above")).where("below + above > 1").isEmpty():
            break
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(e.select("v", "v").distinct())


def star(pairs: DataFrame, low: DataFrame, total: int) -> DataFrame:
    """(v, m) for each of the pairs (u, v), where m is low's smallest neighbour of u."""
    out = attach(pairs.select("u", "v"), low, ["u"], "n", total)
    return out.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Groups of a partition that is sorted by its first `keys` integer columns, one table at a time, across batches."""
    wait: list[pa.RecordBatch] = []
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)], 1)
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1).tolist(), len(k)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(k[a].tolist())
            if wait and key != held:
                yield pa.Table.from_batches(wait)
                wait = []
            held = key
            wait.append(batch.slice(a, b - a))
    if wait:
        yield pa.Table.from_batches(wait)


def tiles(rows: DataFrame, key: str, parts: Column, node: str) -> DataFrame:
    """rows with columns i, j, side: what a group that is cut into `parts` tiles must meet to meet itself.

    A row of tile s joins the meetings (min(s, x), max(s, x)) of its group for every
    tile x; side is 0 in the first tile of a meeting and 1 in the second. Within a
    meeting of a tile with itself all pairs count, else those of different sides.
    """
    s = F.pmod(F.xxhash64(node, F.lit(7)), parts).cast("int")
    out = rows.withColumn("_s", s).withColumn("_x", F.explode(F.sequence(F.lit(0), (parts - 1).cast("int"))))
    return out.select("*", F.least("_s", "_x").alias("i"), F.greatest("_s", "_x").alias("j"), (F.col("_s") > F.col("_x")).cast("int").alias("side")).drop("_s", "_x")


def forest(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """(root of each of n places, numbers of the pairs that join two components) for pairs of places."""
    up = list(range(n))
    used = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        while up[y] != y:
            up[y] = up[up[y]]
            y = up[y]
        if x != y:
            up[max(x, y)] = min(x, y)
            used.append(k)
    for x in range(n):
        while up[x] != up[up[x]]:
            up[x] = up[up[x]]
    return np.array(up, np.int64), used
