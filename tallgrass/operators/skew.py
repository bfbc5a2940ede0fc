"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than 1/HOT of the rows is joined by a broadcast, which so has fewer than HOT rows.
HOT = 2_000


def same(left: list[Column], right: list[Column]) -> Column:
    """Whether all pairs of columns agree, nulls among them."""
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & a.eqNullSafe(b)
    return out


def attach(rows: DataFrame, facts: DataFrame, keys: list[str], weight: str, total: int | None = None, hot: int = HOT) -> DataFrame:
    """Left join of rows with facts, of which there is one per key, however skewed the keys are.

    facts[weight] is the number of rows with that key and total the number of all
    rows (by default the sum of the weights). Keys with more than total / hot rows
    (fewer than `hot` of them) are broadcast. What they match leaves the shuffled
    join's key: it is dealt evenly, equal rows by the partitions they come from.
    Keys compare null-safely. Columns of facts other than keys are added.
    """
    values = [c for c in facts.columns if c not in keys]
    is_hot = F.col(weight) * hot > (facts.agg(F.sum(weight)).scalar() if total is None else F.lit(total))
    heavy, light = facts.where(is_hot), facts.where(~is_hot)
    h = heavy.select(*(F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)), F.struct(*values).alias("_heavy"))
    out = rows.join(F.broadcast(h), same([F.col(k) for k in keys], [F.col(f"_h{i}") for i in range(len(keys))]), "left").drop(*(f"_h{i}" for i in range(len(keys))))
    spread = F.when(F.col("_heavy").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(*rows.columns, F.spark_partition_id()), F.lit(1_000_003)) + 1)
    out = out.withColumn("_deal", spread.cast("int"))
    k = light.select(*(F.col(x).alias(f"_l{i}") for i, x in enumerate(keys)), F.lit(0).alias("_l_deal"), F.struct(*values).alias("_light"))
    out = out.join(k, same([F.col(x) for x in keys], [F.col(f"_l{i}") for i in range(len(keys))]) & (F.col("_deal") == F.col("_l_deal")), "left")
    found = F.coalesce("_heavy", "_light")
    return out.select(*rows.columns, *(found[v].alias(v) for v in values))
