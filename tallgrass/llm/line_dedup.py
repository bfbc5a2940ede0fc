"""Fuzzy line dedup: SimHashes of normalised lines and of their stretches meet in blocks, edit similarity links, one line of each group stays."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm import common as c

#: Least edit similarity of a link: 1 - distance / length of the longer line.
LEAST = Fraction(4, 5)
#: A line's blocks are SimHashes of its stretches of so many words, for lines of (least, most) words. An edited word
#: spoils only the stretches that hold it, so by the pigeonhole principle alike lines share some.
STRETCHES = {3: (3, 12), 4: (9, 1 << 62)}
#: Of a line's blocks of one kind the KEYS of least hash are kept: alike lines choose alike.
KEYS = 6
#: Lines of at most so many words also have a block for every way to leave out a word.
FEW = 8
#: Words of more than so many characters make a line's SimHash, if it has any: short ones are in most lines.
SMALL = 3
#: Bits in which the SimHashes of two lines of a block may differ for them to be compared, and within which a line
#: is left to the first such line of its block.
LOOSE, TIGHT = 18, 12
#: Lines of a block that meet at once. A block that a sample of 1/SAMPLE of the lines shows to be larger is dealt into
#: tiles, whose leaders then meet where one of CUTS parts of their SimHashes agrees. This finds most links cheaply; the
#: block's lines, whose groups still differ, then all meet in meetings of MEET lines with MEET others, ROWS at a time.
CROWD, SAMPLE, CUTS, MEET, ROWS = 4_096, 64, 4, 16_384, 128
#: Lines, and characters, that are compared with one leader in one task.
TILE, TILE_CHARS = 2_048, 2_000_000
#: Words after a difference among which the next two equal ones in a row are looked for.
AHEAD = 8
#: Columns of a table of edit distances after which it is seen whether it can still end within its bound.
STEP = 32
#: Pairs of lines whose edit distances are computed at once, at most and at least, and numbers of 64 rows; characters of a
#: line that waits for this, and of all that wait.
ABREAST, FEWEST, CELLS, WAIT_CHARS, WAIT_ALL = 1_024, 32, 4_096, 4_000, 4_000_000
#: Rows of blocks that a task packs at once, and lines for each part of the blocks.
PACK, PART_LINES = 400_000, 16_000
#: Lines of two groups that meet in a place before the groups are measured.
OFTEN = 3
#: Distinct lines whose first meeting a worker knows.
MET = 1_000_000
#: Words' hashes are sums of their code points times powers of an odd number; characters that are summed at once.
ODD, SLICE = 0x9E3779B97F4A7C15, 1 << 18

#: Words that the byte lanes of a sum can count.
LANE = 255


@functools.cache
def _plain() -> np.ndarray:
    """What each code point becomes: letters, digits and line feeds stay, all else is a space."""
    stays = np.fromiter(map(str.isalnum, map(chr, range(0x110000))), bool, 0x110000)
    stays[10] = True
    return np.where(stays, np.arange(0x110000, dtype=np.uint32), np.uint32(32))


def folded(text: str) -> np.ndarray:
    """Code points of a text in lower case, with spaces for what is no letter, digit or line feed."""
    return _plain()[np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)]


def squeezed(codes: np.ndarray) -> list[str]:
    """Lines of a folded text, with one space between words and none around them."""
    word = codes > 32
    keep = word | (codes == 10)
    # of the characters between two words of a line the last one stays
    at = np.flatnonzero(word)
    gap = np.flatnonzero(np.diff(at) > 1)
    left, right = at[gap], at[gap + 1]
    same = codes[right - 1] == 32
    wide = np.flatnonzero(right - left > 2)
    feeds = np.flatnonzero(codes == 10)
    same[wide] = np.searchsorted(feeds, left[wide]) == np.searchsorted(feeds, right[wide])
    keep[right[same] - 1] = True
    return codes[keep].tobytes().decode("utf-32-le").split("\n")


def normalised(text: str) -> list[str]:
    """Lines of a text in lower case, with one space for each run of characters that are no letters or digits."""
    return squeezed(folded(text))


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all texts folded at once, number of the first line of each text, and of all lines); null texts count as empty."""
    own = [x or "" for x in texts.to_pylist()]
    # a line feed parts words, and ends the surroundings of a letter's lower case, as a text's end does
    return folded("\n".join(own)), np.cumsum([0] + [x.count("\n") + 1 for x in own])


@functools.lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ODD and of its inverse, modulo 2^64."""
    out = []
    for x in (ODD, pow(ODD, -1, 1 << 64)):
        row = np.full(n, x, np.uint64)
        row[0] = 1
        out.append(np.cumprod(row))
    return out[0], out[1]


def hashed(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, hash, whether it has more than SMALL characters) of each word of a folded text, in its order."""
    word = codes > 32
    edge = np.flatnonzero(np.diff(word, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    h = np.empty(len(start), np.uint64)
    k = 0
    while k < len(start):
        to = max(k + 1, int(np.searchsorted(end, start[k] + SLICE, "right")))
        lo, hi = int(start[k]), int(end[to - 1])
        up, down = _powers(SLICE) if hi - lo <= SLICE else _powers.__wrapped__(hi - lo)
        one = codes[lo:hi].astype(np.uint64)
        one *= word[lo:hi]
        one *= up[: hi - lo]
        own = start[k:to] - lo
        h[k:to] = np.add.reduceat(one, own) * down[own]
        k = to
    return np.searchsorted(np.flatnonzero(codes == 10), start), _mixed(_mixed(h) + np.uint64(1)), end - start > SMALL


def edit_distance(a: str, b: str, most: int) -> int:
    """Levenshtein distance of a and b, or any number above `most` if it is larger; bit-parallel over a.

    Ends once no way through the table can stay within `most`. A way's least cost by a row changes by at most 2 from
    row to row, so every STEP columns some rows of the band, `half` apart on either side, stand for all.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    i = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        i += 1
    a, b = a[i:], b[i:]
    i = 0
    for x, y in zip(reversed(a), reversed(b), strict=False):
        if x != y:
            break
        i += 1
    a, b = a[: len(a) - i], b[: len(b) - i]
    if not a or not b:
        return len(a) + len(b)
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    # bits of `more` and `less`: rows of the table's last column that are one above, or one below, the row before
    every, more, less = (1 << len(a)) - 1, (1 << len(a)) - 1, 0
    half, longer = most // 12, len(a) - len(b)
    for k, y in enumerate(b):
        match = at.get(y, 0)
        diagonal = ((((match & more) + more) ^ more) | match | less) & every
        down = more & diagonal
        up = ((less | every ^ (diagonal | more)) << 1 | 1) & every
        more, less = (down << 1) & every | every ^ (diagonal | up), up & diagonal
        if k % STEP == STEP - 1 and k >= most:
            low, high = max(0, k + 1 - most), min(len(a), k + 1 + most)
            for row in range(low + half, high + half + 1, 2 * half + 1):
                row = min(row, high)
                above = (1 << row) - 1
                if k + 1 + (more & above).bit_count() - (less & above).bit_count() + abs(longer + k + 1 - row) <= most + 2 * half:
                    break
            else:
                return most + 1
    return len(b) + more.bit_count() - less.bit_count()


def within(left: list[str], right: list[str], most: list[int]) -> np.ndarray:
    """Whether edit distances are at most `most`, for many pairs of strings of some length, like in lengths, at once.

    The table's columns of differences as in edit_distance, 64 rows to a block, of all pairs. A block is a column behind the
    one above it, whose carry it takes, so all move on at once; only blocks that are up to the largest `most` off the
    diagonal do. A pair ends once none of its own rows can stay within its bound.
    """
    n, m, most = (np.array(x, np.int64) for x in (list(map(len, left)), list(map(len, right)), most))
    out, live, most = np.zeros(len(n), bool), np.arange(len(n)), np.where(np.abs(n - m) <= most, most, -1)
    blocks, wide = -(-int(n.max()) // 64), max(1, int(most.max()))
    a, b = (np.frombuffer("".join(x.ljust(k, "\0") for x in y).encode("utf-32-le"), np.uint32) for y, k in ((left, 64 * blocks), (right, int(m.max()))))
    names = np.unique(np.concatenate((a, b)))
    kind = np.uint8 if len(names) <= 256 else np.uint32
    a = np.ascontiguousarray(np.searchsorted(names, a).astype(kind).reshape(len(n), blocks, 64).transpose(1, 0, 2))
    b = np.ascontiguousarray(np.searchsorted(names, b).astype(kind).reshape(len(n), -1).T)
    more, less = np.full((blocks, len(n)), ~np.uint64(0)), np.zeros((blocks, len(n)), np.uint64)
    # what a block takes from the one above it, and the table's number in the row above it
    up, down = np.ones((blocks + 1, len(n)), np.uint64), np.zeros((blocks + 1, len(n)), np.uint64)
    base = np.repeat(64 * np.arange(blocks)[:, None], len(n), 1)
    final, one, top = (n - 1) // 64, np.uint64(1), np.uint64(63)
    end, own = m - 1 + final, ~np.uint64(0) >> (63 - (n - 1) % 64).astype(np.uint64)
    last, row, before, below = np.bincount(end) > 0, 8 * np.arange(9), 0, 0
    for t in range(len(last)):
        low, high = max(0, t - len(b) + 1, -((wide + 63 - t) // 65)), min(blocks - 1, t, (t + wide) // 65)
        if low == before:
            up[low], down[low] = 1, 0
        if high > below:
            base[high] = base[high - 1] + np.bitwise_count(more[high - 1]) - np.bitwise_count(less[high - 1]) - up[high].view(np.int64) + down[high].view(np.int64)
        before, below = low, high
        x, y = slice(low, high + 1), slice(low + 1, high + 2)
        p, q, plus, minus = more[x], less[x], up[x], down[x]
        base[x] += plus.view(np.int64)
        base[x] -= minus.view(np.int64)
        e = np.packbits(a[x] == b[t - high : t - low + 1][::-1, :, None], axis=2, bitorder="little").view(np.uint64)[:, :, 0]
        v = e | q
        e |= minus
        h = e & p
        h += p
        h ^= p
        h |= e
        u = h | p
        np.invert(u, u)
        u |= q
        h &= p
        carry, less_carry = u >> top, h >> top
        u <<= one
        u |= plus
        h <<= one
        h |= minus
        np.bitwise_and(u, v, q)
        np.bitwise_or(u, v, p)
        np.invert(p, p)
        p |= h
        up[y], down[y] = carry, less_carry
        if last[t]:
            x = np.flatnonzero(end == t)
            k = final[x]
            at = base[k, x] + np.bitwise_count(more[k, x] & own[x]) - np.bitwise_count(less[k, x] & own[x])
            out[live[x]] = at <= most[x]
        if t % 64 == 63:
            # a way's least cost by a row changes by at most 2 from row to row, so every eighth row stands for all; from block to block by 2 more
            rise = (np.bitwise_count(p.view(np.uint8)).view(np.int8) - np.bitwise_count(q.view(np.uint8)).view(np.int8)).reshape(*p.shape, 8)
            at = np.zeros((*p.shape, 9), np.int64)
            np.cumsum(rise, axis=2, out=at[:, :, 1:])
            k = np.arange(low, high + 1)[:, None, None]
            rest = n[:, None] - 64 * k - row
            at += base[low : high + 1, :, None] + np.abs(rest - m[:, None] + t - k + 1)
            at[rest <= -8] = 1 << 40
            x = np.flatnonzero((end > t) & (at.min((0, 2)) - 10 <= most))
            if len(x) < len(live):
                if not len(x):
                    break
                live, n, m, most, final, end, own = live[x], n[x], m[x], most[x], final[x], end[x], own[x]
                a, b, more, less, up, down, base = (np.ascontiguousarray(y[:, x]) for y in (a, b, more, less, up, down, base))
    return out


def measured(pairs: list[tuple]) -> Iterator[tuple]:
    """(a, b, whether the edit distance of their texts is at most `most`) of rows (a, b, text, text, most), sorted by length."""
    k = 0
    while k < len(pairs):
        # of long lines fewer, so that what is worked on stays in a core's caches
        to = k + max(FEWEST, min(ABREAST, CELLS // (len(pairs[k][2]) // 64 + 1)))
        a, b, *rest = zip(*pairs[k:to], strict=True)
        many = len(a) >= FEWEST
        yield from zip(a, b, within(*rest) if many else [edit_distance(x, y, most) <= most for x, y, most in zip(*rest, strict=True)], strict=True)
        k = to


def bound(x: list[str], y: list[str], most: int) -> int:
    """A number not below the edit distance of two lists of words, joined by spaces; above `most` where no cheap one is found.

    Equal words stay; at a difference both lists go on from the nearest two words in a row that agree again, and what
    they skip is replaced as a whole.
    """
    i = j = cost = 0
    while i < len(x) and j < len(y):
        if x[i] == y[j]:
            i, j = i + 1, j + 1
            continue
        for k, m in _AHEAD:
            if x[i + k : i + k + 2] == y[j + m : j + m + 2]:
                break
        else:
            return most + 1
        a, b = x[i : i + k], y[j : j + m]
        cost += max(len(" ".join(a)), len(" ".join(b))) + (not a or not b)
        if cost > most:
            return cost
        i, j = i + len(a), j + len(b)
    return cost + sum(len(w) + 1 for w in (*x[i:], *y[j:]))


_AHEAD = sorted(((k, m) for k in range(AHEAD + 1) for m in range(AHEAD + 1) if k or m), key=sum)


def letters(texts: list[str]) -> np.ndarray:
    """How many characters of each of 32 kinds each text has."""
    kind = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32) & np.uint32(31)
    return np.bincount(np.repeat(np.arange(len(texts)) * 32, list(map(len, texts))) + kind, minlength=32 * len(texts)).reshape(-1, 32).astype(np.int32)


def possible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether texts of these letters can be alike: an edit takes a character of one kind away at most, and adds one at most."""
    m, n = a.sum(1), b.sum(1)
    return np.abs(a - b).sum(1) + np.abs(m - n) <= 2 * (np.maximum(m, n) * (LEAST.denominator - LEAST.numerator) // LEAST.denominator)


def allowed(a: str, b: str, least: Fraction = LEAST) -> int:
    """The most that the edit distance of two alike lines can be."""
    return max(len(a), len(b)) * (least.denominator - least.numerator) // least.denominator


def plainly(a: str, b: str, most: int) -> bool | None:
    """Whether the edit distance of a and b is at most `most`, where lengths or words tell."""
    if abs(len(a) - len(b)) > most:
        return False
    x, y = a.split(" "), b.split(" ")
    if len(x) == len(y) and sum(max(len(v), len(w)) for v, w in zip(x, y, strict=True) if v != w) <= most:
        return True  # words that differ, replaced in their places
    return True if bound(x, y, most) <= most else None


def alike(a: str, b: str, least: Fraction = LEAST) -> bool:
    most = allowed(a, b, least)
    plain = plainly(a, b, most)
    return edit_distance(a, b, most) <= most if plain is None else plain


def simhash(line: np.ndarray, h: np.ndarray, long: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each line, the bits that most of its long words have, or of all words if none is long.

    Words come sorted by line, and every line has some. Bits are counted in byte lanes, eight to a 64-bit number,
    over LANE words at a time.
    """
    n = int(line[-1]) + 1
    starts = np.flatnonzero(np.diff(line, prepend=-1))
    long = long | ~np.logical_or.reduceat(long, starts)[line]
    ones = np.zeros((n, 64), np.int64)
    step = 1 << 15
    for k in range(0, len(h), step):
        on = k + np.flatnonzero(long[k : k + step])
        if not len(on):
            continue
        own, bits = line[on], np.unpackbits(h[on].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).view(np.uint64)
        # a sum ends with its line, or when its lanes are full
        new = np.flatnonzero(np.diff(own, prepend=-1))
        ends = (np.arange(len(own)) - np.repeat(new, np.diff(new, append=len(own)))) % LANE == 0
        ends[new] = True
        at = np.flatnonzero(ends)
        np.add.at(ones, own[at], np.add.reduceat(bits, at, axis=0).view(np.uint8).astype(np.int64))
    return np.packbits(2 * ones > np.bincount(line, long, n)[:, None], axis=1).view(">u8").astype(np.uint64).view(np.int64).reshape(-1)


def _turned(h: np.ndarray, by: int) -> np.ndarray:
    return h << np.uint64(by) | h >> np.uint64(64 - by)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def stretches(h: np.ndarray, size: int) -> np.ndarray:
    """SimHash of each run of `size` words, whose hashes are turned by their places: the bits that most of them have."""
    n = max(0, len(h) - size + 1)
    a, b, d = h[:n], _turned(h[1 : n + 1], 16), _turned(h[2 : n + 2], 32)
    if size == 3:
        return a & b | b & d | a & d
    e = _turned(h[3 : n + 3], 48)
    return a & b & (d | e) | d & e & (a | b)


def left_out(words: list[str]) -> list[str]:
    """A short line, and what is left of it without each of its words, or of its characters if it is one word; of a longer word its ends."""
    if len(words) > 1:
        return [" ".join(words), *(" ".join(words[:i] + words[i + 1 :]) for i in range(len(words)))]
    x = words[0]
    if len(x) < 10:
        return [x, *(x[:i] + x[i + 1 :] for i in range(len(x)))] if len(x) > 4 else []
    return [x, f"{x[:6]}*", f"*{x[-6:]}"]


def block_keys(lines: list[str], line: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, key), sorted by line: the blocks in which lines, whose words have the hashes h, meet others."""
    sizes = np.bincount(line, minlength=len(lines))
    at, keys = [], []
    for kind, (size, (low, high)) in enumerate(STRETCHES.items()):
        got = stretches(h, size)
        own = line[: len(got)]
        inside = (own == line[size - 1 :][: len(got)]) & (sizes[own] >= low) & (sizes[own] <= high)
        own, got = own[inside], _mixed(_mixed(got[inside]) + np.uint64(size))
        # KEYS of least hash of each line: numbers of a line over the upper bits of a hash, for lines of a stretch
        for k in range(0, len(lines), 1 << 17):
            lo, hi = np.searchsorted(own, (k, k + (1 << 17)))
            one = np.sort((own[lo:hi] - k).astype(np.uint64) << np.uint64(47) | got[lo:hi] >> np.uint64(17))
            one = one[np.flatnonzero(np.diff(one, prepend=np.uint64((1 << 64) - 1)))]
            whose = (one >> np.uint64(47)).astype(np.int64)
            starts = np.flatnonzero(np.diff(whose, prepend=-1))
            rank = np.arange(len(one)) - np.repeat(starts, np.diff(starts, append=len(one)))
            at.append(whose[rank < KEYS] + k)
            keys.append((one[rank < KEYS] & np.uint64((1 << 47) - 1)) << np.uint64(2) | np.uint64(kind))
    short, ends = [], []
    for i in np.flatnonzero(sizes <= FEW).tolist():
        for x in left_out(lines[i].split(" ")):
            short.append(i), ends.append(xxhash.xxh3_64_intdigest(x) >> 15 << 2 | 2)
    at.append(np.array(short, np.int64)), keys.append(np.array(ends, np.uint64))
    at, keys = np.concatenate(at), np.concatenate(keys)
    order = np.argsort(at, kind="stable")
    return at[order], keys[order].view(np.int64)


# Stages on the executors

def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of some SLICE bytes, whose arrays stay in a core's caches."""
    for batch in batches:
        step = max(1, batch.num_rows * SLICE // (batch.nbytes + 1))
        for k in range(0, batch.num_rows, step):
            yield batch.slice(k, step)


def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line that has a word: its place, two hashes of 64 bits, SimHash, length and, where a task first meets it, blocks."""
    met: set[int] = set()
    for batch in sliced(batches):
        codes, first = joined(batch.column(2))
        every = squeezed(codes)
        whole, h, long = hashed(codes)
        del codes
        numbers, line = np.unique(whole, return_inverse=True)
        doc = np.searchsorted(first, numbers, "right") - 1
        place = numbers - first[doc]
        for at in range(0, len(numbers), 50_000):
            to = min(at + 50_000, len(numbers))
            own = [every[i] for i in numbers[at:to].tolist()]
            lo, hi = np.searchsorted(line, (at, to))
            words = line[lo:hi] - at
            digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, own)), "<i8").reshape(-1, 2)
            sim = simhash(words, h[lo:hi], long[lo:hi])
            if len(met) > MET:
                met.clear()
            new = np.zeros(len(own), bool)
            for i, x in enumerate(digest[:, 0].tolist()):
                if x not in met:
                    met.add(x)
                    new[i] = True
            blocks, keys = block_keys(own, words, h[lo:hi])
            keep = new[blocks]
            ends = np.concatenate(([0], np.cumsum(np.bincount(blocks[keep], minlength=len(own))))).astype(np.int32)
            of = pa.array(doc[at:to], pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(of), batch.column(1).take(of), pa.array(place[at:to].astype(np.int32)), pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()),
                pa.array(sim), pa.array([len(x) for x in own], pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[keep])),
            ], ["id", "doc", "line", "h1", "h2", "sim", "size", "keys"])


def paired(cols: list[np.ndarray]) -> pa.RecordBatch | None:
    """(a, b, sim, size, bucket, tile): pairs of lines of a block to compare; and, with b null, leaders of tiled blocks (tile null) and lines of pairs that are put off.

    Columns (bucket, tile, node, sim, size, tiled) come sorted. A line within TIGHT of one before it is left to the
    first such line; the others are leaders, and every line within LOOSE of a leader is compared with it, if their
    lengths allow a link. A pair of others is put off until it is known which lines are linked. Rows d places apart are looked at all at once, for d = 1, 2, ... while any share a block.
    """
    new = np.ones(len(cols[0]), bool)
    new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
    bucket, tile, node, sim, size, tiled = (x[new] for x in cols)
    start = np.ones(len(bucket), bool)
    start[1:] = (bucket[1:] != bucket[:-1]) | (tile[1:] != tile[:-1])
    run = np.cumsum(start)
    first = np.full(len(node), -1)
    left, right = [], []
    x = np.arange(len(node))
    for d in range(1, len(node)):
        x = x[x + d < len(node)]
        x = x[run[x] == run[x + d]]
        if not len(x):
            break
        y = x + d
        ok = np.minimum(size[x], size[y]) * LEAST.denominator >= np.maximum(size[x], size[y]) * LEAST.numerator
        apart = np.bitwise_count((sim[x] ^ sim[y]).view(np.uint64))
        ok &= apart <= LOOSE
        left.append(x[ok]), right.append(y[ok])
        tight = ok & (apart <= TIGHT)
        first[y[tight]] = x[tight]  # a larger d is an earlier line
    a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (left, right))
    leads = first < 0
    keep = (first[b] == a) | leads[a] | leads[b]
    late = ~keep & (tiled[a] == 0)  # all lines of a tiled block meet later
    off = np.unique(np.concatenate((a[late], b[late])))
    a, b = a[keep], b[keep]
    ends = np.flatnonzero(leads & (tiled != 0))
    one = np.concatenate((a, ends, off))
    if not len(one):
        return None
    alone = np.arange(len(one)) >= len(a)
    return pa.RecordBatch.from_arrays([
        pa.array(node[one]), pa.array(node[np.concatenate((b, ends, off))], mask=alone), pa.array(sim[one]), pa.array(size[one]),
        pa.array(bucket[one]), pa.array(tile[one], mask=np.arange(len(one)) < len(a) + len(ends)),
    ], ["a", "b", "sim", "size", "bucket", "tile"])


def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What paired makes of rows (bucket, tile, node, sim, size, tiled), which come sorted."""
    return by_tile(batches, paired)


def packed(batches: Iterator[pa.RecordBatch], parts: int, hot: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(part, rows): rows (bucket, node, sim, size) of each part of the blocks, as bytes, from lines (node, sim, size, keys), but for hot blocks."""
    held: list[tuple[np.ndarray, ...]] = []

    def out() -> pa.RecordBatch:
        cols = [np.concatenate(x) for x in zip(*held, strict=True)]
        held.clear()
        part = (_mixed(cols[0].view(np.uint64)) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int32)
        order = np.argsort(part, kind="stable")
        part, cols = part[order], [x[order] for x in cols]
        starts = np.flatnonzero(np.diff(part.astype(np.int32), prepend=-1))
        rows = [b"".join(x[a:b].tobytes() for x in cols) for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(part)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(part[starts].astype(np.int32)), pa.array(rows, pa.binary())], ["part", "rows"])

    for batch in batches:
        keys = batch.column(3)
        bucket, own = keys.flatten().to_numpy(), pc.list_parent_indices(keys).to_numpy()
        if len(hot):
            stay = ~np.isin(bucket, hot)
            bucket, own = bucket[stay], own[stay]
        held.append((bucket, *(batch.column(i).to_numpy()[own] for i in range(3))))
        if sum(len(x[0]) for x in held) >= PACK:
            yield out()
    if any(len(x[0]) for x in held):
        yield out()


def near_packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What paired makes of the blocks of each part, from rows (part, rows), which come sorted."""
    for rows in c.runs(batches, 1):
        cols: list[list[np.ndarray]] = [[], [], [], []]
        for x in rows.column(1).to_pylist():
            n = len(x) // 28
            for k, col in enumerate(cols):
                col.append(np.frombuffer(x, np.int32 if k == 3 else np.int64, n, 8 * n * k))
        bucket, *rest = (np.concatenate(x) for x in cols)
        order = np.argsort(bucket)
        bucket = bucket[order]
        same = bucket[1:] == bucket[:-1]
        # lines that are alone in a block meet none
        stay = np.concatenate((same, [False])) | np.concatenate(([False], same))
        bucket, (node, sim, size) = bucket[stay], (x[order[stay]] for x in rest)
        order = np.lexsort((node, bucket))
        none = np.zeros(len(order), np.int32)
        if len(order) and (out := paired([bucket[order], none, node[order], sim[order], size[order], none])) is not None:
            yield out


def unsettled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, node, sim, size, root): lines of a place that might be alike one of another group there, by SimHashes and lengths.

    Rows (place, node, sim, size, root, side) come sorted; lines of side 0 meet those of side 1, or all others where there is none.
    """

    def close(cols: list[np.ndarray]) -> pa.RecordBatch | None:
        place, _, sim, size, root, side = cols
        sim, found = sim.view(np.uint64), np.zeros(len(place), bool)
        ends = np.flatnonzero(np.concatenate((place[1:] != place[:-1], [True]))) + 1
        for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            if (root[lo:hi] == root[lo]).all():
                continue
            left = right = np.arange(lo, hi)
            if side[lo:hi].any():
                left, right = left[side[lo:hi] == 0], left[side[lo:hi] != 0]
            for k in range(0, len(left), ROWS):
                x, y = np.nonzero(np.bitwise_count(sim[left[k : k + ROWS], None] ^ sim[right]) <= LOOSE)
                x, y = left[x + k], right[y]
                ok = (root[x] != root[y]) & (np.minimum(size[x], size[y]) * LEAST.denominator >= np.maximum(size[x], size[y]) * LEAST.numerator)
                found[x[ok]] = found[y[ok]] = True
        if found.any():
            return pa.RecordBatch.from_arrays([pa.array(x[found]) for x in cols[:5]], ["place", "node", "sim", "size", "root"])
        return None

    return by_tile(batches, close, 1)


def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): roots of groups of a place that alike lines link, as few pairs as connect them. Rows (place, node, sim, size, root, places, text) come sorted.

    All pairs within LOOSE are looked at whose groups differ, also by the links found so far, and whose lengths allow a
    link. A pair that shares several places is compared in the least of them. Two groups that meet more than OFTEN times
    are measured once, from first line to first line: a pair's distance is at least this less its lines' own distances
    from their first ones, and is not computed where that is too much.
    """
    wait: list[tuple] = []
    links: list[tuple[int, int]] = []
    chars = 0

    def close() -> None:
        nonlocal chars
        chars = 0
        left = sorted((x for x in wait if not x[0](x[1])), key=lambda x: len(x[2]))
        wait.clear()
        for join, pair, ok in measured(left):
            if ok:
                join(pair, True)

    def out() -> pa.RecordBatch:
        a, b = zip(*links, strict=True)
        links.clear()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    for rows in c.runs(batches, 1):
        place, node, sim, size, root = (rows.column(i).to_numpy() for i in range(5))
        new = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
        own, node, sim, size = int(place[0]), node[new], sim[new], size[new]
        group = np.unique(root[new], return_inverse=True)[1]
        rows = rows.take(pa.array(new))
        places, text = [frozenset(x) for x in rows.column(5).to_pylist()], rows.column(6).to_pylist()
        roots, heads = np.unique(root[new], return_index=True)
        count = letters(text)
        up, meets, wide, far = list(range(len(roots))), {}, {}, {}

        def off(x: int, heads: list[int] = heads.tolist(), group: np.ndarray = group, text: list[str] = text, far: dict = far) -> int:
            """A number not below the distance of a line from its group's first."""
            if x not in far:
                a, b = text[heads[group[x]]], text[x]
                longest = max(len(a), len(b))
                got = bound(a.split(" "), b.split(" "), longest // 5)
                far[x] = got if got <= longest // 5 else edit_distance(a, b, longest)
            return far[x]

        def top(x: int, up: list[int] = up) -> int:
            while up[x] != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        def united(pair: tuple[int, int], link: bool = False, roots: np.ndarray = roots, up: list[int] = up, top: Callable[[int], int] = top) -> bool:
            """Whether two groups are one by the links so far, of which the two become one if told so."""
            v, w = map(top, pair)
            if link and v != w:
                up[max(v, w)] = min(v, w)
                links.append((roots[pair[0]], roots[pair[1]]))
            return v == w

        for d in range(1, len(node)):
            ok = (group[:-d] != group[d:]) & (np.bitwise_count((sim[:-d] ^ sim[d:]).view(np.uint64)) <= LOOSE)
            ok &= np.minimum(size[:-d], size[d:]) * LEAST.denominator >= np.maximum(size[:-d], size[d:]) * LEAST.numerator
            ok = np.flatnonzero(ok)
            for x in ok[possible(count[ok], count[ok + d])].tolist():
                y = x + d
                pair = (int(min(group[x], group[y])), int(max(group[x], group[y])))
                if united(pair) or min(places[x] & places[y]) != own:
                    continue
                longest = max(len(text[x]), len(text[y]))
                meets[pair] = meets.get(pair, 0) + 1
                if meets[pair] > OFTEN:
                    if pair not in wide:
                        p, q = (text[heads[g]] for g in pair)
                        wide[pair] = edit_distance(p, q, max(len(p), len(q)))
                    if (wide[pair] - off(x) - off(y)) * LEAST.denominator > longest * (LEAST.denominator - LEAST.numerator):
                        continue
                most = allowed(text[x], text[y])
                plain = plainly(text[x], text[y], most)
                if plain is None and longest <= WAIT_CHARS:
                    wait.append((united, pair, text[x], text[y], most))
                    chars += len(text[x]) + len(text[y])
                    if len(wait) == ABREAST or chars > WAIT_ALL:
                        close()
                elif plain or plain is None and edit_distance(text[x], text[y], most) <= most:
                    united(pair, True)
        if links:
            yield out()
    close()
    if links:
        yield out()


def by_tile(batches: Iterator[pa.RecordBatch], close: Callable[[list[np.ndarray]], pa.RecordBatch | None], keys: int = 2) -> Iterator[pa.RecordBatch]:
    """What close makes of the columns of rows that come sorted by the first one or two, (bucket, tile), some whole tiles at a time."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols, strict=True)]
        more = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[keys - 1] != cols[keys - 1][-1]))
        cut = int(more[-1]) + 1 if len(more) else 0
        if cut and (out := close([x[:cut] for x in cols])) is not None:
            yield out
        held = [x[cut:] for x in cols]
    if held is not None and (out := close(held)) is not None:
        yield out


def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wanted lines, their text in place of their number, from whole texts and a list of structs for each; a struct ends with the line's number."""
    for batch in batches:
        own, wanted = batch.column(0).cast(pa.binary()).to_pylist(), batch.column(1)
        names, cols = [x.name for x in wanted.type.value_type], wanted.flatten().flatten()
        at, parts, lines = -1, [], []
        for i, k in zip(pc.list_parent_indices(wanted).to_pylist(), cols[-1].to_pylist(), strict=True):
            if i != at:
                at, parts = i, (own[i] or b"").split(b"\n")
            lines.append(parts[k])
        # a line is normalised alike alone and in its text
        yield pa.RecordBatch.from_arrays([*cols[:-1], pa.array(normalised(b"\n".join(lines).decode())[: len(lines)], pa.string())], [*names[:-1], "text"])


def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): leaders with the lines of their parts that are alike. Rows (leader, part, node, text) come sorted, a leader's own first in its part."""

    def out(a: list[int], b: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def close() -> pa.RecordBatch:
        nonlocal chars
        chars = 0
        wait.sort(key=lambda x: len(x[2]))
        yes = [(x, y) for x, y, ok in measured(wait) if ok]
        wait.clear()
        return out([x for x, _ in yes], [y for _, y in yes])

    held, own, chars = (0, 0), "", 0
    wait: list[tuple[int, int, str, str, int]] = []
    for batch in batches:
        leader, part, node = (np.concatenate(([x], batch.column(k).to_numpy())) for k, x in (("leader", held[0]), ("part", held[1]), ("node", held[0])))
        texts = [own, *batch.column("text").to_pylist()]
        head = np.maximum.accumulate(np.where(node == leader, np.arange(len(node)), 0))
        count = letters(texts)
        ok = (head != np.arange(len(node))) & (leader == leader[head]) & (part == part[head]) & possible(count, count[head])
        a, b = [], []
        for i, k in zip(np.flatnonzero(ok).tolist(), head[ok].tolist(), strict=True):
            x, y = texts[k], texts[i]
            most = allowed(x, y)
            plain = plainly(x, y, most)
            if plain is None and max(len(x), len(y)) <= WAIT_CHARS:
                wait.append((int(leader[i]), int(node[i]), x, y, most))
                chars += len(x) + len(y)
            elif plain or plain is None and edit_distance(x, y, most) <= most:
                a.append(int(leader[i])), b.append(int(node[i]))
        held, own = (int(leader[head[-1]]), int(part[head[-1]])), texts[head[-1]]
        if a:
            yield out(a, b)
        if len(wait) >= 4 * ABREAST or chars > WAIT_ALL:
            yield close()
    yield close()


_MET = "a long, b long, sim long, size int, bucket long, tile int"


def met(rows: DataFrame) -> DataFrame:
    """near over rows (bucket, tile, node, sim, size, tiled)."""
    rows = rows.select("bucket", "tile", "node", "sim", "size", "tiled")
    return c.in_arrow(rows.repartition("bucket", "tile").sortWithinPartitions("bucket", "tile", "node"), near, _MET)


def compared(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, later): distinct pairs (a, b) of lines, by their hash h1, that blocks bring together, a being the leader; and the lines (bucket, tile, node, sim, size) of pairs without a leader, put off, with all those of tiled blocks (tile -1)."""
    own = lines.where(F.size("keys") > 0)
    some = own.where(F.pmod("h1", F.lit(SAMPLE)) == 0).dropDuplicates(["h1"]).select(F.explode("keys").alias("bucket"))
    crowds = c.stored(some.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * SAMPLE > CROWD).select(F.col("bucket").alias("hot"), F.ceil(F.col("n") * SAMPLE / CROWD).alias("tiles")))
    crowded = crowds.limit(1).count() > 0
    blocks = own.select(F.explode("keys").alias("bucket"), F.col("h1").alias("node"), "sim", "size")
    if crowded:
        blocks = blocks.join(c.by_size(crowds), F.col("bucket") == F.col("hot"), "left")
        blocks = blocks.withColumn("tile", F.coalesce(F.pmod(F.xxhash64("node"), F.col("tiles")), F.lit(0)).cast("int")).withColumn("tiled", F.col("hot").isNotNull().cast("int"))
    if c.small(crowds):
        # blocks that are not crowded are sent packed, which spares sorting and shuffling their rows one by one
        hot = np.array([x["hot"] for x in crowds.select("hot").collect()], np.int64)
        parts = max(1, -(-own.count() // PART_LINES))
        rows = c.in_arrow(own.select("h1", "sim", "size", "keys"), functools.partial(packed, parts=parts, hot=hot), "part int, rows binary")
        first = c.in_arrow(rows.repartition("part").sortWithinPartitions("part"), near_packed, _MET)
        if crowded:
            first = first.union(met(blocks.where("tiled = 1")))
    else:
        first = met(blocks)
    first = c.stored(first.groupBy("a", "b", F.when(F.col("b").isNull(), F.col("bucket")).alias("bucket"), "tile").agg(F.max("sim").alias("sim"), F.max("size").alias("size")))
    pairs = first.where("b is not null").select("a", "b")
    later = first.where("tile is not null").select("bucket", "tile", F.col("a").alias("node"), "sim", "size")
    if crowded:
        leaders = first.where("b is null and tile is null")
        width = 64 // CUTS
        part = F.explode(F.array(*(F.xxhash64("bucket", F.lit(i), F.shiftrightunsigned("sim", i * width).bitwiseAND(F.lit((1 << width) - 1))) for i in range(CUTS))))
        again = leaders.select(part.alias("bucket"), F.lit(0).alias("tile"), F.col("a").alias("node"), "sim", "size", F.lit(0).alias("tiled"))
        pairs = pairs.union(met(again).where("b is not null").select("a", "b"))
        # tiles, and leaders that agree in no part, leave pairs out: of a tiled block all pairs of lines are looked at
        whole = blocks.where("tiled = 1").groupBy("bucket", "node").agg(F.max("sim").alias("sim"), F.max("size").alias("size"))
        later = later.union(c.stored(whole.select("bucket", F.lit(-1).alias("tile"), "node", "sim", "size")))
    return c.stored(pairs.distinct()), later


def linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b): those of the stored pairs that are alike. docs: (id, doc, text); classes as in line_groups."""
    nodes = c.stored(pairs.select(F.col("a").alias("h1")).union(pairs.select("b")).distinct())
    facts = c.stored(classes.join(c.by_size(nodes), "h1", "left_semi").groupBy("h1").agg(F.min("first").alias("first"), F.max("size").alias("size")))
    sizes = pairs.join(facts.select(F.col("h1").alias("b"), "size"), "b").groupBy("a").agg(F.count(F.lit(1)).alias("crowd"), F.greatest(F.ceil(F.count(F.lit(1)) / TILE), F.ceil(F.sum("size") / TILE_CHARS)).cast("int").alias("parts"))
    sizes = c.stored(sizes)
    dealt = c.attach(pairs, sizes, ["a"], "crowd").select(F.col("a").alias("leader"), F.col("b").alias("node"), F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    dealt = dealt.union(sizes.select(F.col("a").alias("leader"), F.col("a").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")))
    dealt = dealt.join(facts.select(F.col("h1").alias("node"), "first"), "node")
    texts = read(docs, dealt, "leader long, part int, node long")
    return c.stored(c.in_arrow(texts.repartition("leader", "part").sortWithinPartitions("leader", "part", F.col("node") != F.col("leader")), verified, "a long, b long"))


def read(docs: DataFrame, lines: DataFrame, schema: str) -> DataFrame:
    """lines' columns of the schema, and text, for lines whose place is `first`."""
    own = [f.name for f in lines.sparkSession.createDataFrame([], schema).schema]
    wanted = lines.groupBy("first.id", "first.doc").agg(F.collect_list(F.struct(*own, F.col("first.line").alias("line"))).alias("wanted"))
    wanted = c.stored(wanted.select(F.col("id").alias("w_id"), F.col("doc").alias("w_doc"), "wanted"))
    # rows that repeat id and text are read once a partition's batch; a line that comes twice changes nothing
    texts = docs.join(c.by_size(wanted), c.same([docs["id"], docs["doc"]], [F.col("w_id"), F.col("w_doc")]))
    return c.in_arrow(texts.select("text", "wanted"), fetched, f"{schema}, text string")


def between(docs: DataFrame, classes: DataFrame, groups: DataFrame, later: DataFrame) -> DataFrame:
    """(a, b): links between groups, by their roots, from the lines of pairs that were put off. groups: the stored (node, root) of lines that are linked.

    A place, a block or its tile, whose lines are all of one group needs no comparison; the others are dealt into meetings of at
    most 2 * MEET lines or so, and of lines that might be alike one of another group there the text is sent to their meetings.
    """
    rows = later.select("node", "sim", "size", F.xxhash64("bucket", "tile").alias("place")).join(groups, "node", "left")
    rows = c.stored(rows.withColumn("root", F.coalesce("root", "node")))
    mixed = rows.groupBy("place").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("crowd")).where("low < high")
    mixed = c.stored(mixed.select("place", "crowd", F.ceil(F.col("crowd") / MEET).cast("int").alias("parts")))
    own = rows.join(F.broadcast(mixed), "place") if c.small(mixed) else c.attach(rows, mixed, ["place"], "crowd").where("parts is not null")
    dealt = c.tiles(own, "place", F.col("parts"), "node")
    meeting = F.when(F.col("parts") == 1, F.col("place")).otherwise(F.xxhash64("place", "i", "j")).alias("place")
    dealt = dealt.select(meeting, "node", "sim", "size", "root", "side")
    rows = c.stored(c.in_arrow(dealt.repartition("place").sortWithinPartitions("place", "node"), unsettled, "place long, node long, sim long, size int, root long"))
    nodes = rows.groupBy("node").agg(*(F.max(x).alias(x) for x in ("sim", "size", "root")), F.collect_set("place").alias("places"))
    nodes = c.stored(nodes)
    firsts = classes.join(c.by_size(nodes.select(F.col("node").alias("h1"))), "h1", "left_semi").groupBy(F.col("h1").alias("node")).agg(F.min("first").alias("first"))
    texts = read(docs, nodes.join(firsts, "node"), "node long, sim long, size int, root long, places array<long>")
    texts = texts.select(F.explode("places").alias("place"), "*")
    return c.stored(c.in_arrow(texts.repartition("place").sortWithinPartitions("place", "node"), settled, "a long, b long"))


def merged(groups: DataFrame, links: DataFrame) -> DataFrame:
    """The stored groups (node, root) after links (a, b) between roots, and lines that were in no group."""
    now = c.stored(c.components(links))
    own = now.select(F.col("node").alias("root"), F.col("root").alias("to"))
    old = groups.join(c.by_size(own), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return old.union(now.join(groups, "node", "left_anti").select("node", "root"))


def line_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lines, classes): every line that has a word, and each distinct normalised line with the place of its group's first.

    lines: (id, doc, line, h1, h2, sim, size, keys), where doc is a hash of the text and
    line counts from 0. classes: (h1, h2, n, group_lines, first) for those that
    occur twice or belong to a group of several; first is a struct (z, id, doc, line).
    """
    c.prepare(df.sparkSession)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).select("id", F.xxhash64("text").alias("doc"), "text")
    ident = docs.schema["id"].dataType.simpleString()
    lines = c.stored(c.in_arrow(docs, described, f"id {ident}, doc long, line int, h1 long, h2 long, sim long, size int, keys array<long>"))
    place = F.struct(F.col("id").isNull().alias("z"), "id", "doc", "line")
    classes = c.stored(lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"), F.max("size").alias("size")))

    pairs, later = compared(lines)
    links = linked(docs, classes, pairs)
    groups = c.components(links)
    if later.limit(1).count():
        # a pair that was put off links two groups, or nothing new: only roots get new ones
        groups = c.stored(groups)
        links = between(docs, classes, groups, later)
        if links.limit(1).count():
            groups = merged(groups, links)

    # a line that occurs once and is in no group goes no further
    found = classes.select("h1", "h2", "n", "first").join(groups.select(F.col("node").alias("h1"), "root").hint("shuffle_hash"), "h1", "left")
    found = c.stored(found.where("n > 1 or root is not null"))
    members = found.where("root is not null")
    firsts = c.stored(members.groupBy("root").agg(F.count(F.lit(1)).alias("crowd"), F.min("first").alias("start"), F.sum("n").alias("group_lines")))
    out = c.attach(members, firsts, ["root"], "crowd").select("h1", "h2", "n", "group_lines", F.col("start").alias("first"))
    return lines, c.stored(out.union(found.where("root is null").select("h1", "h2", "n", F.col("n").alias("group_lines"), "first")))


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df's id and text, the text without its duplicate lines, and counts: (id, text, clean, n_lines, n_dropped, dropped).

    Lines are split at line feeds and normalised to lower-case letters and digits.
    Distinct normalised lines that share a block, a SimHash of one of their stretches
    of words, and whose own SimHashes differ in at most LOOSE bits, are compared: with
    their block's leaders, then with all lines of other groups, and linked if their edit
    similarity is at least LEAST. Of each
    connected group one occurrence stays, the one of smallest id and then line. Lines without
    letters or digits always stay. Line numbers in `dropped` count from 0.

    A null text has no line and stays null. A null id is behind all others. Rows
    that repeat id and text are one document and lose the same lines. An empty
    table gives no rows; further columns are ignored.

    Equal lines are aggregated before any are compared, and a line is first compared with
    leaders only, so that a group of n lines makes some n comparisons; a crowded block
    is dealt into tiles, whose leaders meet by parts of their SimHashes, before all its lines of different groups do. Texts are read
    again only for lines that are compared and, joined once by id, for the result.
    """
    lines, classes = line_groups(df, id_col, text_col)
    # the smaller side of these joins is hashed, so the larger one needs no sort
    found = c.attach(lines.select("id", "doc", "line", "h1", "h2"), classes.hint("shuffle_hash"), ["h1", "h2"], "n", lines.count())
    own = F.struct(F.col("id").isNull().alias("z"), "id", "doc", "line")
    lost = found.where(F.col("first").isNotNull() & ~own.eqNullSafe(F.col("first")))
    lost = c.stored(lost.groupBy("id", "doc").agg(F.array_sort(F.collect_set("line")).alias("dropped")))
    lost = lost.select(F.col("id").alias("l_id"), F.col("doc").alias("l_doc"), "dropped")
    docs = df.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias(text_col)).withColumn("_doc", F.xxhash64(text_col))
    # most documents lose some line, so this joins alike on tables of any size: a small table shows what a large one needs
    out = docs.join(lost.hint("shuffle_hash"), c.same([F.col(id_col), F.col("_doc")], [F.col("l_id"), F.col("l_doc")]), "left")
    out = out.withColumn("_parts", F.split(text_col, "\n", -1)).withColumn("_stay", F.array_except(F.sequence(F.lit(0), F.size("_parts") - 1), "dropped"))
    some = F.array_join(F.transform("_stay", lambda i: F.get("_parts", i)), "\n")
    return out.select(
        id_col, text_col,
        F.when(F.col("dropped").isNull(), F.col(text_col)).otherwise(some).alias("clean"),
        F.coalesce(F.size("_parts"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("dropped", F.expr("cast(array() as array<int>)")).alias("dropped"),
    )
