"""Byte-level BPE: a minimal perfect hash resolves whole pre-tokens, a heap over linked bytes, or the least of a short list, the rest."""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallgrass.llm import common as c

#: Keys per bucket of the perfect hash.
LOAD = 2
#: Bytes of each of the two generations of a worker's memo, bytes that an entry takes besides its word and ids, the longest
#: word that it keeps, and the marks by which it knows words that it has met once: a word enters the memo when it is met again.
MEMO, ENTRY, MEMO_CHARS, MARKS = 24 << 20, 160, 48, 1 << 22
#: Bytes of a pre-token up to which the least rank is looked for in a list: a heap costs more until there are many.
SHORT = 48

_LOW = (1 << 64) - 1
#: A space between two characters that aren't white space: no match of the pattern spans the place before it.
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"^ | $| \s|\s ")


class PerfectHash:
    """Minimal perfect hash of distinct byte strings, by hash and displace.

    A key's bucket gives a displacement that sends all of the bucket's keys to
    slots of their own; buckets of one key name their slot outright. There are as
    many slots as keys, and a lookup ends with one comparison.
    """

    def __init__(self, keys: list[bytes]):
        self.n, self.buckets = max(1, len(keys)), max(1, len(keys) // LOAD)
        shift, slots, free = [0] * self.buckets, [-1] * self.n, self.n - 1
        apart: list[list[int]] = [[] for _ in range(self.buckets)]
        hashes = [xxhash.xxh3_128_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            apart[(h >> 64) % self.buckets].append(i)
        for own in sorted(apart, key=len, reverse=True):
            if not own:
                break
            b = (hashes[own[0]] >> 64) % self.buckets
            if len(own) == 1:
                while slots[free] >= 0:
                    free -= 1
                slots[free], shift[b] = own[0], -free - 1
                continue
            d = 0
            while True:
                to = {((hashes[i] & _LOW) + d * (hashes[i] >> 84 | 1)) % self.n for i in own}
                if len(to) == len(own) and all(slots[x] < 0 for x in to):
                    break
                d += 1
            shift[b] = d
            for i in own:
                slots[((hashes[i] & _LOW) + d * (hashes[i] >> 84 | 1)) % self.n] = i
        self.shift, self.keys, self.values = shift, [keys[i] if i >= 0 else None for i in slots], slots

    def get(self, key: bytes) -> int:
        """The key's place in the list that the hash was made from, or -1."""
        h = xxhash.xxh3_128_intdigest(key)
        hi = h >> 64
        d = self.shift[hi % self.buckets]
        slot = -d - 1 if d < 0 else ((h & _LOW) + d * (h >> 84 | 1)) % self.n
        return self.values[slot] if self.keys[slot] == key else -1


class Encoder:
    """Encodes and decodes by the ranks of a vocabulary, in which a token's id is its rank."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens, self.pattern = tokens, regex.compile(pattern)
        self.hash = PerfectHash(tokens)
        at = {t: i for i, t in enumerate(tokens)}
        self.byte = [at[bytes([b])] for b in range(256)]
        #: by left id: right id -> id of their union; ids that are no left part share one empty table
        none: dict[int, int] = {}
        self.pair: list[dict[int, int]] = [none] * len(tokens)
        for i, t in enumerate(tokens):
            for k in range(1, len(t)):
                left, right = at.get(t[:k]), at.get(t[k:])
                if left is not None and right is not None:
                    if self.pair[left] is none:
                        self.pair[left] = {}
                    self.pair[left][right] = i
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.size = 0
        self.met = bytearray(MARKS)

    def merge(self, piece: bytes) -> array:
        """Ids of a pre-token that is no token: joins the pair of lowest rank, leftmost first, until none is left."""
        ids = list(map(self.byte.__getitem__, piece))
        n, pair = len(ids), self.pair
        if n <= SHORT:
            return self.merge_short(ids)
        # an entry is (id of the union, place of the left part) as one number
        heap = [r << 32 | i for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (r := pair[a].get(b))]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        ids.append(-1)
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            top = pop(heap)
            i = top & 0xFFFFFFFF
            a = ids[i]
            if a < 0:
                continue  # it has been joined with the part before it
            j = after[i]
            r = top >> 32
            if pair[a].get(ids[j]) != r:
                continue  # one of the two has been joined with another
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if x := pair[r].get(ids[k]):
                    push(heap, x << 32 | i)
            k = before[i]
            if k >= 0 and (x := pair[ids[k]].get(r)):
                push(heap, x << 32 | k)
        return array("I", [x for x in ids if x >= 0])

    def merge_short(self, ids: list[int]) -> array:
        """What merge makes of few bytes."""
        pair, none = self.pair, len(self.pair)
        # ranks[i] is that of ids i and i + 1; `none` is above all
        ranks = [pair[a].get(b, none) for a, b in zip(ids, ids[1:], strict=False)]
        ranks.append(none)
        while (r := min(ranks)) < none:
            i = ranks.index(r)
            ids[i] = r
            del ids[i + 1], ranks[i]
            # the union's rank with what follows is in the place of the second part's; the last one stays `none`
            if i + 1 < len(ids):
                ranks[i] = pair[r].get(ids[i + 1], none)
            if i:
                ranks[i - 1] = pair[ids[i - 1]].get(r, none)
        return array("I", ids)

    def token(self, piece: bytes) -> bytes:
        """Packed ids of a pre-token."""
        i = self.hash.get(piece)
        return i.to_bytes(4, "little") if i >= 0 else packed(self.merge(piece))

    def stretch(self, text: str) -> bytes:
        """Packed ids of a stretch that no match of the pattern crosses."""
        out = []
        for token in self.pattern.findall(text):
            # a word that was met before, here with other characters around it
            got = self.new.get(token[1:]) if token[0] == " " and len(token) < len(text) else None
            out.append(got or self.token(token.encode()))
        return b"".join(out)

    def later(self, word: str) -> bytes:
        """Packed ids of a space and a word; both generations of the memo missed or only the older has it."""
        got = self.old.get(word)
        if got is None:
            # a space and letters of the Latin scripts are one match
            got = self.token(b" " + word.encode()) if word.isalpha() and max(word) < "\u0250" else self.stretch(" " + word)
            mark = hash(word) & (MARKS - 1)
            if not self.met[mark]:
                self.met[mark] = 1
                return got
        if len(word) <= MEMO_CHARS:
            self.size += ENTRY + 2 * len(word) + len(got)
            if self.size > MEMO:
                self.old, self.new, self.size, self.met = self.new, {}, 0, bytearray(MARKS)
            self.new[word] = got
        return got

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        first, *rest = _SAFE.split(text) if _ODD.search(text) else text.split(" ")
        out = list(map(self.new.get, rest))
        for i in [i for i, x in enumerate(out) if x is None]:
            out[i] = self.new.get(rest[i]) or self.later(rest[i])
        return self.stretch(first) + b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def packed(ids: array) -> bytes:
    if sys.byteorder == "big":
        ids.byteswap()
    return ids.tobytes()


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in order of rank; ranks must count from 0."""
    with open(path, "rb") as f:
        rows = sorted((int(n), base64.b64decode(t)) for t, n in (line.split() for line in f if line.strip()))
    if [n for n, _ in rows] != list(range(len(rows))):
        raise ValueError(f"{path}: ranks have gaps")
    return [t for _, t in rows]


_MADE: dict[tuple[str, str], Encoder] = {}
#: The driver's broadcasts of vocabularies, one of each in a session.
_SENT: dict[tuple[str, str], Broadcast] = {}


def encoder(tokens: list[bytes], pattern: str, name: str) -> Encoder:
    """The worker's encoder, made once."""
    if (name, pattern) not in _MADE:
        _MADE.clear()
        _MADE[name, pattern] = Encoder(tokens, pattern)
    return _MADE[name, pattern]


def sent(spark: SparkSession, ranks: str) -> tuple[str, Broadcast]:
    """(digest, broadcast) of the vocabulary in a file."""
    tokens = read_ranks(ranks)
    key = hashlib.sha256(b"\n".join(map(base64.b64encode, tokens))).hexdigest()
    at = spark.sparkContext.applicationId, key
    if at not in _SENT:
        _SENT[at] = spark.sparkContext.broadcast(tokens)
    return key, _SENT[at]


def with_ids(df: DataFrame, ranks: str, pattern: str, text_col: str = "text", name: str = "bpe") -> DataFrame:
    """df with a struct column (n_tokens, ids, ids_sha256, decoded_sha256) for each whole text.

    ids are the token ids; decoded_sha256 is the digest of the bytes that they
    decode to. A null text counts as empty. The vocabulary (of fixed size) is read
    on the driver from the file `ranks` and broadcast once. No row is shuffled.
    """
    key, tokens = sent(c.prepare(df.sparkSession), ranks)

    @F.arrow_udf("struct<n_tokens:bigint,ids:array<int>,ids_sha256:string,decoded_sha256:string>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        def each() -> Iterator[pa.Array]:
            coder = encoder(tokens.value, pattern, key)
            for texts in batches:
                flat, sizes, ids_sha, decoded_sha = bytearray(), [], [], []
                for x in texts:
                    ids = coder.encode(x.as_py() or "")
                    flat += ids
                    sizes.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    decoded_sha.append(hashlib.sha256(coder.decode(ids)).hexdigest())
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                yield pa.StructArray.from_arrays([
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(flat, "<i4"), pa.int32())),
                    pa.array(ids_sha, pa.string()),
                    pa.array(decoded_sha, pa.string()),
                ], ["n_tokens", "ids", "ids_sha256", "decoded_sha256"])

        return c.released(each())

    return df.withColumn(name, encode(F.col(text_col).cast("string")))


def decode(df: DataFrame, ranks: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """df with the bytes that an array of token ids stands for; a null array gives null, an unknown id an error."""
    _, tokens_of = sent(c.prepare(df.sparkSession), ranks)

    @F.arrow_udf("binary")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = tokens_of.value
        for rows in batches:
            yield pa.array([None if r is None else b"".join(tokens[i] for i in r) for r in rows.to_pylist()], pa.binary())

    return df.withColumn(name, text(F.col(ids_col)))
