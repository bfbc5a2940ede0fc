"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm import common as c

#: Features, longest n-gram, additive smoothing.
BITS, ORDER, ALPHA = 16, 3, 0.5
#: Classes that a model can have at most; with more the training raises. It bounds the broadcast matrix to 128 MB.
MOST_CLASSES = 512
#: Classes whose counts a training task holds before it sends them on, and n-grams counted or scored at once.
HELD, STEP = 32, 1 << 20

_ODD = np.array([2654435761, 2246822519, 3266489917], np.uint32)


@functools.cache
def letters() -> np.ndarray:
    return np.fromiter((x.isalpha() for x in map(chr, range(0x110000))), bool, 0x110000)


def codes(text: str) -> np.ndarray:
    """Lower-case letters of a text with one space for each run of other characters and at either end; empty if it has no letter."""
    x = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
    x = np.where(letters()[x], x, np.uint32(32))
    blank = x == 32
    keep = np.ones(len(x), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    x = x[keep]
    return x if len(x) > 1 else x[:0]


def features(x: np.ndarray) -> np.ndarray:
    """Hashed features of all n-grams of 1 to ORDER characters."""
    out = []
    for n in range(1, ORDER + 1):
        if len(x) >= n:
            h = np.full(len(x) - n + 1, n * 40503, np.uint32)
            for k in range(n):
                h = (h ^ x[k : len(x) - n + 1 + k]) * _ODD[k]
                h ^= h >> np.uint32(15)
            out.append((h * np.uint32(2654435761)) >> np.uint32(32 - BITS))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, docs, counts) of a partition's texts, each label's n-grams counted into one array."""
    held: dict[str, np.ndarray] = {}
    docs: dict[str, int] = {}
    wait: dict[str, list[np.ndarray]] = {}

    def settle(label: str) -> None:
        if own := wait.pop(label, None):
            held[label] += np.bincount(np.concatenate(own), minlength=1 << BITS)

    def out() -> pa.RecordBatch:
        for label in list(wait):
            settle(label)
        rows = list(held)
        batch = pa.RecordBatch.from_arrays([pa.array(rows, pa.string()), pa.array([docs[r] for r in rows], pa.int64()), pa.array([held[r].astype("<i8").tobytes() for r in rows], pa.binary())], ["label", "docs", "counts"])
        held.clear(), docs.clear()
        return batch

    size = 0
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if label not in held:
                if len(held) >= HELD:
                    yield out()
                held[label], docs[label] = np.zeros(1 << BITS, np.int64), 0
            docs[label] += 1
            got = features(codes(text or ""))
            wait.setdefault(label, []).append(got)
            size += len(got)
            if size > STEP:
                for x in list(wait):
                    settle(x)
                size = 0
    if held:
        yield out()


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the rows of each label, one at a time; a partition holds a few labels."""
    held: dict[str, list] = {}
    for batch in batches:
        for label, docs, raw in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            got = held.setdefault(label, [0, np.zeros(1 << BITS, np.int64)])
            got[0] += docs
            got[1] += np.frombuffer(raw, "<i8")
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array([x[0] for x in held.values()], pa.int64()), pa.array([x[1].tobytes() for x in held.values()], pa.binary())], ["label", "docs", "counts"])


def train(df: DataFrame, label: str = "lang", text: str = "text") -> tuple[list[str], np.ndarray, np.ndarray]:
    """(classes, log priors, log probabilities of features by class), from all rows with a label.

    Every task counts its rows into dense arrays of 2**BITS numbers per class;
    tasks' arrays are added up in two steps, so that a class with a third of all
    rows means no larger task. At most MOST_CLASSES arrays reach the driver.
    """
    c.prepare(df.sparkSession)
    schema = "label string, docs long, counts binary"
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("string").alias("label"), F.col(text).cast("string").alias("text"))
    part = rows.mapInArrow(counted, schema)
    part = part.repartition(F.col("label"), F.pmod(F.xxhash64("counts"), F.lit(64))).mapInArrow(summed, schema)
    got = part.repartition("label").mapInArrow(summed, schema).limit(MOST_CLASSES + 1).collect()
    if len(got) > MOST_CLASSES:
        raise ValueError(f"more than {MOST_CLASSES} classes")
    got = sorted((r["label"], r["docs"], np.frombuffer(r["counts"], "<i8")) for r in got) if got else []
    if not got:
        return [], np.zeros(0), np.zeros((1 << BITS, 0), np.float32)
    prior = np.log([g[1] for g in got]) - np.log(sum(g[1] for g in got))
    count = np.stack([g[2] for g in got], 1) + ALPHA
    return [g[0] for g in got], prior, (np.log(count) - np.log(count.sum(0))).astype(np.float32)


def predict(df: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray], text: str = "text", name: str = "language") -> DataFrame:
    """df with a struct column (lang_pred, score): the class of highest posterior and its probability.

    A null text, one without letters, or a model without classes gives `und` and
    a score of 0. Texts are scored whole, in steps of bounded memory; the matrix
    (features by classes, MOST_CLASSES of them at most) is broadcast.
    """
    spark = c.prepare(df.sparkSession)
    sent = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        classes, prior, table = sent.value
        step = max(1, 4 * STEP // max(1, len(classes)))
        for texts in batches:
            best, sure = [], []
            for value in texts:
                x = codes(value.as_py() or "")
                if not len(x) or not classes:
                    best.append("und"), sure.append(0.0)
                    continue
                f = features(x)
                total = prior + sum(table[f[i : i + step]].sum(0, dtype=np.float64) for i in range(0, len(f), step))
                k = int(total.argmax())
                best.append(classes[k]), sure.append(float(1 / np.exp(total - total[k]).sum()))
            yield pa.StructArray.from_arrays([pa.array(best, pa.string()), pa.array(sure, pa.float64())], ["lang_pred", "score"])

    return df.withColumn(name, score(F.col(text).cast("string")))


def held_out(ident: Column, fold: int = 2, folds: int = 4) -> Column:
    """Whether crc32 of the id as text leaves that remainder; a null id counts as an empty text."""
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % folds == fold
