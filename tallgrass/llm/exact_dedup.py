"""Exact dedup by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm import common as c

#: Code points of the normalised text that the second level hashes.
PREFIX = 256
#: Surviving lengths and prefixes are known by 2**BITS bits, broadcast as 8 MB however many there are; more of them
#: only mean that more rows, which the last level then tells apart, are hashed in full.
BITS = 26


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), c.SPACES, "")


def facts(id_col: str, text_col: str) -> list[Column]:
    """A row's id, its text's length and normalised length, and a hash of the normalised text's first PREFIX code points."""
    norm = normalised(F.col(text_col))
    return [F.col(id_col), F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("long"), F.length(norm).cast("long"), F.xxhash64(F.substring(norm, 1, PREFIX))]


def place() -> Column:
    """Where a row's length and prefix hash stand among BITS bits, from 1."""
    return F.pmod(F.xxhash64("n_norm", "head"), F.lit(1 << BITS)) + 1


def marks(heads: DataFrame) -> DataFrame:
    """(bucket, bits): a set bit for each of heads, in bitmaps of fixed size, 2**BITS bits together."""
    return heads.select(F.bitmap_bucket_number(place()).alias("bucket"), F.bitmap_bit_position(place()).alias("at")).groupBy("bucket").agg(F.bitmap_construct_agg("at").alias("bits"))


def marked(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """rows with _set: whether their bit is set, as it is for all rows of heads and, by chance, a few others."""
    out = rows.withColumn("_bucket", F.bitmap_bucket_number(place())).withColumn("_at", F.bitmap_bit_position(place()))
    out = out.join(F.broadcast(sets.select(F.col("bucket").alias("_b"), "bits")), F.col("_bucket") == F.col("_b"), "left")
    byte = F.conv(F.hex(F.substring("bits", (F.floor(F.col("_at") / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return out.withColumn("_set", F.coalesce(F.getbit(byte, F.pmod("_at", F.lit(8)).cast("int")) == 1, F.lit(False)))


def refined(df: DataFrame, id_col: str, text_col: str, hash_all: bool = False) -> DataFrame:
    """(id, n_chars, n_norm, head, row, sha, group_size, best, kept) per row; sha is null for rows that a level before the last proved unique, unless hash_all."""
    norm = normalised(F.col(text_col))
    digest = F.unhex(F.sha2(norm, 256))
    own = [x.alias(n) for x, n in zip(facts(id_col, text_col), ("id", "n_chars", "n_norm", "head"), strict=True)]
    rec = c.stored(df.select(*own, *([digest.alias("sha")] if hash_all else []), F.monotonically_increasing_id().alias("row")))
    total = rec.count()

    def shared(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("members")).where("members > 1")

    lengths = c.stored(shared(rec, ["n_norm"]))
    longer = c.attach(rec, lengths, ["n_norm"], "members", total).where("members is not null").drop("members")
    heads = c.stored(shared(longer, ["n_norm", "head"]))
    if hash_all:
        rows = c.attach(rec, heads, ["n_norm", "head"], "members", total)
        lone, survivors = rows.where("members is null").drop("members"), rows.where("members is not null").drop("members")
    else:
        sets = c.stored(marks(heads))
        scan = df.select(*own, norm.alias("norm"), F.monotonically_increasing_id().alias("row"))
        survivors = c.stored(marked(scan, sets).where("_set").select(*rec.columns, F.unhex(F.sha2("norm", 256)).alias("sha")))
        lone = marked(rec, sets).where("not _set").select(*rec.columns, F.lit(None).cast("binary").alias("sha"))
    rows = lone.unionByName(survivors)
    best = F.min(F.struct((-F.col("n_chars")).alias("l"), F.col("id").isNull().alias("z"), "id", "row"))
    groups = c.stored(survivors.groupBy("n_norm", "head", "sha").agg(F.count(F.lit(1)).alias("group_size"), best.alias("best")).where("group_size > 1"))
    out = c.attach(rows, groups, ["n_norm", "head", "sha"], "group_size", total)
    return out.withColumn("kept", F.col("best").isNull() | (F.col("best.row") == F.col("row")))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", hash_all: bool = False) -> DataFrame:
    """One row per row of df: (id, keep_id, group_size, kept, text_sha256).

    Texts are equal when identical after deleting white space [\\x20\\x09-\\x0D].
    Rows first survive a length that others share, then a hash of the first
    PREFIX code points that others share; only their full content is hashed and
    grouped. Of equal texts the longest original stays, then the smallest id.

    A null text counts as empty. A null id stands behind all other ids. Of rows
    that repeat both id and length within a group, exactly one is kept. An empty
    table gives no rows. Other columns of df are ignored, whatever their names.
    text_sha256 is null for rows that a level before the last proved unique,
    unless hash_all asks for every row's digest (the grouping stays as it is).

    Rows that survive the prefix are found where they are read, by a bitmap of fixed
    size. Only lengths, hashes and ids are shuffled, never texts. Groups are aggregated
    before the shuffle and joined back with hot groups broadcast (common.attach).
    """
    out = refined(df, id_col, text_col, hash_all)
    return out.select(
        F.col("id").alias(id_col),
        F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
        "n_chars",
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df without the rows that exact_dedup drops; all columns stay as they are.

    Rows are found again by id, lengths, prefix hash and, where all of these meet a
    dropped row's, the digest of the text: full content is read only for the groups
    that survive the refinement. Keys are computed where the row is read, so that
    texts are not shuffled while the dropped keys are few (common.by_size). Rows
    that agree in all of them are cut down to one.
    """
    names = ["id", "n_chars", "n_norm", "head"]
    out = refined(df, id_col, text_col).where("sha is not null").select(*(F.col(x).alias(f"__tg_{x}") for x in [*names, "sha"]), "kept")
    mine = [f"__tg_{x}" for x in [*names, "sha"]]
    keys = out.groupBy(*mine).agg(F.max("kept").alias("__tg_kept"), F.count(F.lit(1)).alias("__tg_rows"))
    keys = c.stored(keys.where("not __tg_kept or __tg_rows > 1"))
    norm = normalised(F.col(text_col))
    # the digest stands in a condition on both sides, so it is no join key and is computed only where the keys agree
    digest = F.when(F.col("__tg_sha").isNotNull(), F.unhex(F.sha2(norm, 256))) == F.col("__tg_sha")
    on = c.same(facts(id_col, text_col), [F.col(x) for x in mine[:-1]]) & digest
    found = df.join(c.by_size(keys.where("not __tg_kept").select(*mine)), on, "left_anti")
    again = c.stored(keys.where("__tg_kept").select(*mine))
    if not again.limit(1).count():
        return found
    one = found.join(c.by_size(again), on, "inner").dropDuplicates(mine).select(*(found[x] for x in df.columns))
    return found.join(c.by_size(again), on, "left_anti").unionByName(one)
