"""Class-based n-gram scores: exchange clustering of words, class transitions and word emissions."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.llm import common as c

#: The units that are clustered first: the end of a text, the TOP most frequent words, and ENDINGS buckets of all
#: other words by their last SUFFIX bytes. Every word, seen or not, belongs to one unit, and to its class unless it is a word of SEEN.
TOP, ENDINGS, SUFFIX = 511, 512, 3
UNITS = 1 + TOP + ENDINGS
CLASSES, ROUNDS = 64, 12
#: Of the words whose counts are broadcast, those seen so often in training move to classes by their own neighbours.
SEEN = 10
#: Words whose counts are broadcast (16 bytes each), the most frequent ones; the counts of all others are joined.
FREQUENT = 1 << 19
#: Distinct words that a task holds before it sends its counts on; words in a worker's memo; tokens counted at once.
HELD, MEMO, STEP = 400_000, 400_000, 1 << 20
#: Pseudo-count of the class unigram in transitions.
PRIOR = 64.0


def words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case."""
    return text.encode().lower().split() if text else []


def bucket(word: bytes) -> int:
    return zlib.crc32(word[-SUFFIX:]) % ENDINGS


def signed(word: bytes) -> int:
    h = xxhash.xxh3_64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


# Counts


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, ending, n) of a partition's words, added up as far as memory allows; row (0, -1) counts texts."""
    held: Counter[bytes] = Counter()
    texts = 0

    def out() -> pa.RecordBatch:
        keys = list(held)
        batch = pa.RecordBatch.from_arrays([pa.array(list(map(signed, keys)), pa.int64()), pa.array(list(map(bucket, keys)), pa.int32()), pa.array(list(held.values()), pa.int64())], ["h", "ending", "n"])
        held.clear()
        return batch

    for batch in batches:
        for text in batch.column(0):
            held.update(words(text.as_py()))
            texts += 1
            if len(held) > HELD:
                yield out()
    if held:
        yield out()
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([-1], pa.int32()), pa.array([texts], pa.int64())], ["h", "ending", "n"])


def tallied(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code, how often) of the distinct codes."""
    codes = np.sort(codes)
    starts = np.flatnonzero(np.diff(codes, prepend=codes[:1] - 1))
    return codes[starts], np.diff(starts, append=len(codes))


# Texts as numbers: 0 ends a text, the words whose counts are broadcast follow by falling count, and all others are
# one number for each ending. What follows a text is cut once; all that is learnt comes from the numbers.


def numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<i4").astype(np.int64)


def chained(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[np.ndarray]:
    """The texts of a partition one after the other, `step` numbers or so at a time: an end before and behind each text, and -1 between two."""
    wait: list[np.ndarray] = []
    size = 0
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            own = numbers(raw)
            wait += (np.zeros(1, np.int64), own, np.full(1, -1))
            size += len(own)
            if size > step:
                yield np.concatenate(wait)
                wait, size = [], 0
    if wait:
        yield np.concatenate(wait)


def paired(batches: Iterator[pa.RecordBatch], of: np.ndarray, kinds: int) -> Iterator[pa.RecordBatch]:
    """(code, n) over a partition: how often each pair of neighbours occurs, code = kind * kinds + kind of the next; of gives each number's kind."""
    total = np.zeros(kinds * kinds, np.int64)
    for u in chained(batches, STEP):
        joined = (u[1:] >= 0) & (u[:-1] >= 0)
        k = of[u].astype(np.int64)
        total += np.bincount((k[:-1] * kinds + k[1:])[joined], minlength=len(total))
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["code", "n"])


def grid_of(encoded: DataFrame, of: np.ndarray, kinds: int) -> np.ndarray:
    """Counts of all pairs of neighbours by kind. Tasks send the pairs that they have; these are added up before the driver gets them."""
    sent = encoded.sparkSession.sparkContext.broadcast(of)
    got = c.in_arrow(encoded.select("ids"), lambda x: paired(x, sent.value, kinds), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(kinds * kinds, np.int64)
    out[got.column(0).to_numpy()] = got.column(1).to_numpy()
    return out.reshape(kinds, kinds)


def neighbours(batches: Iterator[pa.RecordBatch], of: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """(place, key, n) over a partition: the classes before (key = class) and after (key = CLASSES + class) each of the numbers 1 to most, added up as far as memory allows."""
    held, n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held // (2 * CLASSES)), pa.array((held % (2 * CLASSES)).astype(np.int32)), pa.array(n)], ["place", "key", "n"])

    for u in chained(batches, STEP):
        k = of[u].astype(np.int64)
        at = np.flatnonzero((u > 0) & (u <= most))
        new, times = tallied(np.concatenate((u[at] * (2 * CLASSES) + k[at - 1], u[at] * (2 * CLASSES) + CLASSES + k[at + 1])))
        both = np.concatenate((held, new))
        order = np.argsort(both, kind="stable")
        both, sums = both[order], np.concatenate((n, times))[order]
        starts = np.flatnonzero(np.diff(both, prepend=both[:1] - 1))
        held, n = both[starts], np.add.reduceat(sums, starts) if len(starts) else sums
        if len(held) > 4 * STEP:
            yield out()
            held, n = held[:0], n[:0]
    if len(held):
        yield out()


def moved(batches: Iterator[pa.RecordBatch], step: np.ndarray, below: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(place, class): the likeliest class of each word, from rows (place, key, n) sorted by place; the end's class 0 is no word's."""
    ahead = np.concatenate((step, step.T))

    def best(at: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.diff(at, prepend=-1))
        gain = np.add.reduceat(n[:, None] * ahead[key] - (n * (key >= CLASSES))[:, None] * below, starts, axis=0)
        gain[:, 0] = -np.inf
        return pa.RecordBatch.from_arrays([pa.array(at[starts]), pa.array(gain.argmax(1).astype(np.int32))], ["place", "class"])

    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        cut = int(np.searchsorted(cols[0], cols[0][-1]))
        if cut:
            yield best(*(x[:cut] for x in cols))
        held = [x[cut:] for x in cols]
    if held is not None:
        yield best(*held)


# Classes


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """Class of every unit: each in turn moves to the class that raises the likelihood of the class bigrams most.

    Unit 0, the end, keeps class 0 for itself. Starts from frequency ranks dealt in
    turn; ends when a round moves nothing.
    """
    n = pairs.shape[0]
    pairs = pairs.astype(np.float64)
    often = pairs.sum(0) + pairs.sum(1)
    order = 1 + np.argsort(-often[1:], kind="stable")
    of = np.zeros(n, np.int64)
    of[order] = 1 + np.arange(n - 1) % (classes - 1)
    member = np.zeros((n, classes))
    member[np.arange(n), of] = 1
    grid = member.T @ pairs @ member
    rest = np.arange(classes)
    for _ in range(rounds):
        moved = 0
        for w in order:
            if not often[w]:
                break
            right = np.bincount(of, pairs[w], classes)
            left = np.bincount(of, pairs[:, w], classes)
            own, was = pairs[w, w], of[w]
            right[was] -= own
            left[was] -= own
            grid[was] -= right
            grid[:, was] -= left
            grid[was, was] -= own
            both = grid.diagonal()
            gain = (_f(grid + right) - _f(grid)).sum(1) + (_f(grid + left[:, None]) - _f(grid)).sum(0)
            gain -= _f(both + right) - _f(both) + _f(both + left) - _f(both)
            gain += _f(both + right + left + own) - _f(both)
            out, into = grid.sum(1), grid.sum(0)
            gain -= _f(out + right.sum() + own) - _f(out) + _f(into + left.sum() + own) - _f(into)
            gain[0] = -np.inf
            to = int(rest[gain.argmax()])
            if gain[was] >= gain[to] - 1e-9 * abs(gain[to]):
                to = was
            grid[to] += right
            grid[:, to] += left
            grid[to, to] += own
            moved += to != was
            of[w] = to
        if not moved:
            break
    return of


def likelihood(grid: np.ndarray) -> float:
    """The part of the training texts' log likelihood that depends on the classes of words."""
    grid = grid.astype(np.float64)
    return float(_f(grid).sum() - _f(grid.sum(0)).sum() - _f(grid.sum(1)).sum())


class Model:
    """Classes of numbers, class transitions and what emissions are divided by, each of fixed size or of a byte for a word."""

    def __init__(self, cls: np.ndarray, grid: np.ndarray, types: np.ndarray):
        """cls: class of every number; grid: class bigrams; types: distinct training words of each class."""
        self.cls = cls
        inner, total = grid.sum(0), grid.sum()
        prior = (inner + 1) / (total + CLASSES)
        self.step = np.log10((grid + PRIOR * prior) / (grid.sum(1, keepdims=True) + PRIOR))
        self.below = np.log10(inner + types + 1)


class Vocabulary:
    """The words whose counts are broadcast: sorted hashes, with the number and the count of each."""

    def __init__(self, h: np.ndarray, n: np.ndarray, ending: np.ndarray, ends: int):
        """Words by falling count, so that the word at place i has the number i + 1."""
        order = np.argsort(h, kind="stable")
        self.hashes, self.number, self.n, self.ends = h[order], (order + 1).astype(np.int32), n[order], ends
        #: unit of every number: 0, the TOP words, and the endings of all others
        self.unit = np.concatenate(([0], np.where(np.arange(len(h)) < TOP, 1 + np.arange(len(h)), 1 + TOP + ending), 1 + TOP + np.arange(ENDINGS))).astype(np.int32)

    def find(self, h: int) -> int:
        i = int(np.searchsorted(self.hashes, h))
        return i if i < len(self.hashes) and self.hashes[i] == h else -1


class Slots(dict):
    """Memo from words to places in arrays with their number, hash and the logarithm of their count; cleared when full."""

    def __init__(self, known: Vocabulary):
        self.known = known
        self.number, self.hash, self.log = np.zeros(MEMO, np.int32), np.zeros(MEMO, np.int64), np.zeros(MEMO)

    def __missing__(self, word: bytes) -> int:
        i = len(self)
        h = signed(word)
        at = self.known.find(h)
        self.hash[i] = h
        if at < 0:
            self.number[i], self.log[i] = 1 + len(self.known.hashes) + bucket(word), 0.0
        else:
            self.number[i], self.log[i] = self.known.number[at], np.log10(self.known.n[at] + 1)
        self[word] = i
        return i


_FACTS = "n_tokens long, logs double, known long, ids binary, h array<long>, ending array<int>, n array<long>"


def encoded(batches: Iterator[pa.RecordBatch], known: Vocabulary) -> Iterator[pa.RecordBatch]:
    """For each text: its words as numbers, what it has without the counts of its infrequent words, and those words."""
    slots = Slots(known)
    first, end = 1 + len(known.hashes), np.log10(known.ends + 1)
    for batch in batches:
        size, ids, logs, seen, ends, hashes, endings, times = [], [], [], [], [0], [], [], []
        for text in batch.column(2):
            w = words(text.as_py())
            if len(slots) + len(w) > MEMO:
                slots.clear()
            log, n, own, met = end, int(known.ends > 0), [], 0
            # a text is taken in stretches that the memo can hold
            for at in range(0, len(w), MEMO // 2):
                if at:
                    slots.clear()
                part = w[at : at + MEMO // 2]
                s = np.fromiter(map(slots.__getitem__, part), np.int64, len(part))
                u = slots.number[s]
                own.append(u)
                log += float(slots.log[s].sum())
                rare = s[u >= first]
                n += len(s) - len(rare)
                r, k = tallied(rare)
                hashes.append(slots.hash[r]), endings.append(slots.number[r] - first), times.append(k)
                met += len(r)
            ids.append(np.concatenate((*own, [0])).astype("<i4").tobytes())
            size.append(len(w) + 1), logs.append(log), seen.append(n), ends.append(ends[-1] + met)
        join = lambda x, t: pa.array(np.concatenate(x) if x else np.zeros(0, np.int64)).cast(t)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.array(logs, pa.float64()), pa.array(seen, pa.int64()), pa.array(ids, pa.binary()),
            *(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), join(x, t)) for x, t in ((hashes, pa.int64()), (endings, pa.int32()), (times, pa.int64()))),
        ], ["row", "held_out", "n_tokens", "logs", "known", "ids", "h", "ending", "n"])


def scored(texts: pa.Array, model: Model) -> pa.Array:
    """The model's share of each text's score: transitions, and what emissions are divided by."""
    out = []
    for raw in texts.to_pylist():
        k = np.concatenate(([0], model.cls[numbers(raw)])).astype(np.int64)
        out.append(float(model.step[k[:-1], k[1:]].sum() - model.below[k[1:]].sum()))
    return pa.array(out, pa.float64())


def frequent(vocabulary: DataFrame, most: int) -> pa.Table:
    """(h, n, ending) of the most frequent words, `most` of them at most, by falling count and then hash.

    The least count comes from a histogram over counts of ten leading bits, which
    has some 64 * 512 bins, and a second one over hashes takes as many of the words
    at the least count as there is room for; only the words taken reach the driver.
    """
    drop = F.greatest(F.floor(F.log2("n")) - 9, F.lit(0)).cast("int")
    bins = vocabulary.withColumn("bin", F.call_function("shiftright", "n", drop) * F.call_function("shiftleft", F.lit(1).cast("long"), drop)).withColumn("slice", F.pmod("h", F.lit(4096)))
    least, size, edge = 1 << 62, 0, None
    for r in sorted(bins.groupBy("bin").count().collect(), key=lambda r: -r["bin"]):
        if size + r["count"] > most:
            edge = r["bin"]
            break
        least, size = r["bin"], size + r["count"]
    taken = F.col("n") >= least
    if edge is not None:
        below = 0
        for r in sorted(bins.where(F.col("bin") == edge).groupBy("slice").count().collect(), key=lambda r: r["slice"]):
            if size + r["count"] > most:
                break
            below, size = r["slice"] + 1, size + r["count"]
        taken = taken | ((F.col("bin") == edge) & (F.col("slice") < below))
    got = bins.where(taken).select("h", "n", "ending").toArrow()
    return got.sort_by([("n", "descending"), ("h", "ascending"), ("ending", "ascending")])


def learn(train: DataFrame, known: Vocabulary, n: np.ndarray, kinds: np.ndarray) -> Model:
    """Classes of all numbers, from the texts as numbers.

    Units (TOP words, and the endings of all others) are clustered by exchange.
    Then every word of the vocabulary that was seen SEEN times moves, all at once, to
    its likeliest class by sparse counts of the classes around it, and the more
    likely of the two assignments stays. n: count of every word of the vocabulary
    by number; kinds: distinct training words of each unit.
    """
    pairs = grid_of(train, known.unit, UNITS)
    of = exchange(pairs)
    member = np.zeros((UNITS, CLASSES))
    member[np.arange(UNITS), of] = 1
    cls, grid, types = of[known.unit].astype(np.uint8), member.T @ pairs @ member, kinds @ member
    model = Model(cls, grid, types)
    most = int((n >= SEEN).sum())
    if not most:
        return model
    sent = train.sparkSession.sparkContext.broadcast(cls)
    step, below = model.step, model.below
    rows = c.in_arrow(train.select("ids"), lambda x: neighbours(x, sent.value, most), "place long, key int, n long")
    to = c.in_arrow(rows.repartition("place").sortWithinPartitions("place"), lambda x: moved(x, step, below), "place long, class int").toArrow()
    new = cls.copy()
    new[to.column(0).to_numpy()] = to.column(1).to_numpy()
    again = grid_of(train, new, CLASSES)
    if likelihood(again) <= likelihood(grid):
        return model
    types = types + np.bincount(new[1 : most + 1], minlength=CLASSES) - np.bincount(cls[1 : most + 1], minlength=CLASSES)
    return Model(new, again, types)


def class_lm(df: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from the rows where held_out is false and scores all whole texts.
    base_score is the add-one unigram, score the class bigram
    P(class | class before) * P(word | class), both as log10. Words that no
    training text has share one pseudo-count of their class.

    A null text counts as empty and scores its end alone; a null held_out counts as
    false; repeated rows are scored alike; an empty table gives no rows; without
    training rows every word is unknown. Further columns are ignored.

    Word counts are added up in tasks before they are shuffled as (hash of 64 bits,
    ending, count); the ending makes up for some of the hash's chance of meeting
    another word. Words are cut twice, for the counts and into a stored table of
    numbers, from which all else is learnt and scored. The driver gets FREQUENT words,
    a class of each, and pairs of units. Texts are not shuffled: each gives its own share of
    the score and the list of its infrequent words, whose counts are then joined.
    """
    spark = c.prepare(df.sparkSession)
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    train = docs.where(~F.col("held_out")).select("text")
    vocabulary = c.stored(c.in_arrow(train, counted, "h long, ending int, n long").groupBy("h", "ending").agg(F.sum("n").alias("n")).where("n > 0"))
    vocabulary, texts = vocabulary.where("ending >= 0"), vocabulary.where("ending < 0")
    total, types = vocabulary.agg(F.sum("n"), F.count(F.lit(1))).first()
    ends = (texts.agg(F.sum("n")).first()[0] or 0)
    total, types = (total or 0) + ends, types + (ends > 0)
    often = frequent(vocabulary, FREQUENT)
    h, n, ending = (often.column(x).to_numpy() for x in ("h", "n", "ending"))
    kinds = np.zeros(UNITS, np.int64)
    kinds[0] = ends > 0
    for e, k in vocabulary.groupBy("ending").count().collect():
        kinds[1 + TOP + e] = k
    kinds[1 : 1 + min(TOP, len(h))] = 1
    np.subtract.at(kinds, 1 + TOP + ending[:TOP], 1)

    known = Vocabulary(h, n, ending, ends)
    sent = spark.sparkContext.broadcast(known)
    ident = docs.schema["id"].dataType.simpleString()
    numbered = docs.select(F.struct(F.monotonically_increasing_id().alias("row"), "id").alias("row"), "held_out", "text")
    own = c.stored(c.in_arrow(numbered, lambda x: encoded(x, sent.value), f"row struct<row:bigint,id:{ident}>, held_out boolean, {_FACTS}").select("row.*", "held_out", *(x.split()[0] for x in _FACTS.split(", "))))
    model = spark.sparkContext.broadcast(learn(own.where(~F.col("held_out")), known, n, kinds))

    @F.arrow_udf("double")
    def local(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return c.released(scored(x, model.value) for x in batches)

    rare = own.select("row", F.explode(F.arrays_zip("h", "ending", "n")).alias("w")).select("row", "w.h", "w.ending", F.col("w.n").alias("times"))
    found = rare.join(vocabulary, ["h", "ending"], "inner").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more"), F.sum("times").alias("seen"))
    out = own.select("row", "id", "held_out", "n_tokens", "logs", "known", local("ids").alias("local")).join(found, "row", "left")
    logs = F.col("logs") + F.coalesce("more", F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(float(total + types + 1)))).alias("base_score"),
        (F.col("local") + logs).alias("score"),
    )
