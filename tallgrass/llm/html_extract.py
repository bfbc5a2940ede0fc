"""Main text of pages: a linear-chain conditional random field over leaf blocks, decoded by Viterbi."""

from __future__ import annotations

import functools
import random
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallgrass.llm import common as c
from tallgrass.llm.html_blocks import Block, blocks

#: Labelled pages that the field is trained on, and the seed that writes them.
PAGES, SEED = 600, 11
#: Hashed features, gradient steps, step size and weight decay.
FEATURES, STEPS, RATE, DECAY = 1 << 15, 160, 0.08, 2e-4
#: Entries of a worker's memo of scores by path.
MEMO = 50_000

#: Words in a class, id or role that tell a part of a page.
KINDS = {
    "ad": "ad ads advert advertisement advertising sponsor sponsored promo promotion banner adsense",
    "notice": "cookie cookies consent gdpr notice notification alert popup modal overlay dialog paywall subscribe newsletter signup",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs toolbar tabs pagination pager topbar skip",
    "frame": "footer foot header masthead copyright legal bottom colophon contentinfo",
    "side": "sidebar side aside related recommended recommendations widget more popular trending tags share social follow complementary",
    "form": "form search login contact register field feedback",
    "talk": "comment comments reply replies discussion respond disqus thread commentlist reviews",
    "main": "article content post entry story body main text page news blog copy prose document",
}
_KIND = {w: k for k, words in KINDS.items() for w in words.split()}


class Field(NamedTuple):
    """Weights for `content` against `other` by feature, and of the steps between (from, to); the last column ends a page."""

    weights: np.ndarray
    step: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _feature(name: str) -> int:
    return zlib.crc32(name.encode()) % FEATURES


@functools.lru_cache(MEMO)
def path_features(path: tuple[tuple[str, ...], ...]) -> tuple[int, ...]:
    """Of the tags above a block: each tag, the nearest three, the kinds and words of their names, and the nearest kind."""
    names = {"any"}
    for x in path:
        names.add(f"in:{x[0]}")
        for w in x[1:]:
            names.add(f"word:{w}")
            if w in _KIND:
                names.add(f"kind:{_KIND[w]}")
    for depth, x in enumerate(reversed(path[-3:])):
        names.add(f"up{depth}:{x[0]}")
    names.add("near:" + next((_KIND[w] for x in reversed(path) for w in x[1:] if w in _KIND), "none"))
    tags = {x[0] for x in path}
    if not tags & {"nav", "footer", "aside", "form", "header"} and not any(n in names for n in ("kind:ad", "kind:notice", "kind:menu", "kind:frame", "kind:side", "kind:form", "kind:talk")):
        names.add("plain")
        names.add(f"plain:{path[-1][0] if path else 'none'}")
    if "article" in tags:
        names.add("article, no aside" if not tags & {"aside", "form", "nav", "footer"} else "article, aside")
    return tuple(sorted(map(_feature, names)))


_COPY = re.compile(r"^(?:©|\(c\) |copyright\b)|all rights reserved", re.I)


@functools.cache
def _named(name: str) -> int:
    return _feature(name)


def text_features(block: Block) -> tuple[int, ...]:
    text = block.text
    n = len(text)
    return (
        _named(f"size:{min(n.bit_length(), 9)}"),
        _named(f"linked:{4 * block.linked // n}"),
        _named("stops" if text[-1] in ".!?…。" else "open"),
        _named("copyright" if _COPY.search(text[:80]) else "no copyright"),
    )


def scores(found: list[Block], field: Field, memo: dict) -> list[float]:
    w = field.weights
    out = []
    for b in found:
        if (x := memo.get(b.path)) is None:
            if len(memo) >= MEMO:
                memo.clear()
            x = memo[b.path] = float(w[list(path_features(b.path))].sum())
        out.append(x + sum(w[i] for i in text_features(b)))
    return out


def viterbi(emit: list[float], field: Field) -> list[bool]:
    """Most probable labels of a page's blocks."""
    (oo, oc), (co, cc) = field.step.tolist()
    o, k = field.first.tolist()
    k += emit[0]
    back = []
    for e in emit[1:]:
        from_o, from_c = (o + oo >= k + co), (o + oc >= k + cc)
        back.append((from_o, from_c))
        o, k = (o + oo if from_o else k + co), (o + oc if from_c else k + cc) + e
    state = k + field.last[1] > o + field.last[0]
    out = [bool(state)]
    for from_o, from_c in reversed(back):
        state = not (from_c if state else from_o)
        out.append(state)
    return out[::-1]


def main_text(page: str | None, field: Field, memo: dict) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    return "\n".join(b.text for b, keep in zip(found, viterbi(scores(found, field, memo), field), strict=True) if keep)


# Labelled pages


def _words(r: random.Random, n: int) -> str:
    parts = "the of and an in re ti on th er es ed ly ha wh ou le que ment eau der ich ung sch los ción ado mi ra к про да 的 一 在".split()
    out = ["".join(r.choices(parts, k=r.choice((1, 1, 2, 2, 3)))) for _ in range(max(1, n))]
    style = r.random()
    if style < 0.06:
        out = [x + r.choice(("###", "%%%", "$$$", "&amp;&amp;", "***")) for x in out]
    elif style < 0.10:
        out = [x.upper() + "!!" for x in out]
    elif style < 0.14:
        out = list(" | ".join(out).split(" "))
    return " ".join(out)


def _sentence(r: random.Random, low: int = 1, high: int = 30) -> str:
    x = _words(r, r.randint(low, high))
    return x[:1].upper() + x[1:] + ("." if r.random() < 0.85 else "")


def _links(r: random.Random, n: int) -> str:
    item = r.choice(("<li><a href='/{0}'>{0}</a></li>", "<a href='/x'>{0}</a> ", "<div><a href='#'>{0}</a></div>"))
    rows = "".join(item.format(_words(r, r.choice((1, 1, 2, 5)))) for _ in range(n))
    return f"<ul>{rows}</ul>" if "<li" in item else rows


def _named_as(r: random.Random, kind: str) -> str:
    words = KINDS[kind].split()
    return r.choice((f' class="{r.choice(words)}"', f' id="{r.choice(words)}"', f' class="x {r.choice(words)}-{r.choice(("box", "wrap", "item", "block"))}"', f" class='{r.choice(words)}{r.choice(('', '-area', ' clearfix'))}'"))


def _text(r: random.Random) -> str:
    return "".join(f"<p>{_sentence(r, 2, 60)}</p>" for _ in range(r.randint(1, 4))) if r.random() < 0.5 else _sentence(r, 2, 40)


def _clutter(r: random.Random, place: str) -> list[tuple[str, bool]]:
    """Parts of a page that are no content."""
    kinds = {
        "top": ("menu", "menu", "frame", "notice", "ad", "form", "side"),
        "in": ("ad", "ad", "side", "notice", "form"),
        "end": ("frame", "frame", "side", "talk", "talk", "talk", "ad", "form", "menu", "notice"),
    }[place]
    out = []
    for kind in r.sample(kinds, r.randint(0 if place == "in" else 1, min(3, len(kinds)))):
        named = _named_as(r, kind) if r.random() < 0.75 else ""
        if kind == "menu":
            tag = "nav" if not named or r.random() < 0.7 else r.choice(("div", "ul"))
            out.append(f"<{tag}{named}>{_links(r, r.randint(2, 9))}</{tag}>")
        elif kind == "frame":
            tag = ("header" if place == "top" else "footer") if not named or r.random() < 0.7 else "div"
            inner = r.choice((f"<h1>{_words(r, 2)}</h1>", f"<p>{_sentence(r)}</p>", f"&copy; example &middot; {_sentence(r)}", f"<div>{_sentence(r, 1, 8)}</div>{_links(r, 3)}", f"Copyright 2020 {_words(r, 3)}. All rights reserved"))
            out.append(f"<{tag}{named}>{inner}</{tag}>")
        elif kind in ("ad", "notice"):
            tag = r.choice(("div", "aside", "section")) if named else "aside"
            inner = r.choice((_sentence(r), f"<p>{_sentence(r)}</p>", f"<a href='#'>{_sentence(r, 1, 9)}</a>", _text(r), f"<p>{_sentence(r)}</p><button>{_words(r, 1)}</button>"))
            out.append(f"<{tag}{named}>{inner}</{tag}>")
        elif kind == "side":
            tag = "aside" if not named or r.random() < 0.5 else r.choice(("div", "section"))
            out.append(f"<{tag}{named}><h3>{_words(r, 2)}</h3>{r.choice((_links(r, 4), _text(r)))}</{tag}>")
        elif kind == "form":
            out.append(f"<form{named}><p>{_sentence(r, 1, 12)}</p><label>{_words(r, 2)}</label><input name=q><select><option>{_words(r, 1)}<option>{_words(r, 1)}</select><textarea>{_words(r, 3)}</textarea><button>{_words(r, 1)}</button></form>")
        else:
            named = named or _named_as(r, "talk")
            tag = r.choice(("div", "section", "ol", "article") if r.random() < 0.8 else ("aside",))
            inner = r.choice(("<li{1}><b>{2}</b> {0}</li>", "<div{1}><p>{2}</p><p>{0}</p></div>", "<p>{0}</p>", "<article{1}><p>{0}</p></article>"))
            one = _named_as(r, "talk")
            out.append(f"<{tag}{named}><h2>{_words(r, 1)}</h2>" + "".join(inner.format(_sentence(r, 3, 60), one, _words(r, 1)) for _ in range(r.randint(1, 6))) + f"</{tag}>")
    return [(x, False) for x in out]


def _article(r: random.Random) -> list[tuple[str, bool]]:
    out = [(f"<h1>{_sentence(r, 1, 12)}</h1>", True)] if r.random() < 0.85 else []
    for _ in range(r.choice((1, 2, 3, 5, 8, 12))):
        k = r.random()
        s = _sentence(r, 1, r.choice((3, 20, 80)))
        if k < 0.64:
            out.append((r.choice((f"<p>{s}</p>", f"<p><b>{s}<br>", f"<p>{s}", f"<p><a href='/x'>{_words(r, 2)}</a> {s}</p>", f"<div>{s}</div>")), True))
        elif k < 0.71:
            out.append((f"<h2>{_sentence(r, 1, 6)}</h2>", True))
        elif k < 0.78:
            out.append(("<ul>" + "".join(f"<li>{_sentence(r, 1, 15)}</li>" for _ in range(r.randint(1, 5))) + "</ul>", True))
        elif k < 0.82:
            out.append((f"<blockquote><p>{s}</p></blockquote>", True))
        elif k < 0.86:
            out.append((f"<pre>{s}</pre>", True))
        elif k < 0.89:
            out.append(("<table>" + "".join(f"<tr><td>{_words(r, 1)}<td>{_words(r, 3)}</tr>" for _ in range(r.randint(1, 3))) + "</table>", True))
        else:
            out += _clutter(r, "in")
    return out


def labelled_page(r: random.Random) -> tuple[list[Block], list[bool]]:
    """A page of a random layout, as blocks with their labels.

    Content is marked by a prefix in its text while the page is parsed, so that
    labels go through the same parser as pages do.
    """
    parts = [*_clutter(r, "top")]
    body = _article(r)
    named = _named_as(r, "main")
    around = r.choice((("<article>", "</article>"),) * 5 + ((f"<article{named}>", "</article>"), (f"<main><article{named}>", "</article></main>"), ("<main>", "</main>"), (f"<div{named}>", "</div>"), (f"<section{named}>", "</section>"), ("<div><div>", "</div></div>"), ("", "")))
    if "main" not in around[0] and r.random() < 0.3:
        around = (f"<div id='page'>{around[0]}", f"{around[1]}</div>")
    if r.random() < 0.5:
        parts += _clutter(r, "in")
    parts += [(around[0], False), *body]
    inside = _clutter(r, "end") if r.random() < 0.15 and around[1] else []
    inside = [x for x in inside if not x[0].startswith("<header")]
    parts += [*inside, (around[1], False), *_clutter(r, "end")]
    mark = "\ue000"
    page = "<html><head><title>t</title></head><body>" + "".join(re.sub(r">([^<>]+)", lambda m: f">{mark}{m[1]}", x) if keep else x for x, keep in parts) + r.choice(("</body></html>", ""))
    found = blocks(page)
    labels = [mark in b.text for b in found]
    return [b._replace(text=b.text.replace(mark, "").strip() or ".") for b in found], labels


def train(pages: list[tuple[list[Block], list[bool]]], steps: int = STEPS) -> Field:
    """Maximum likelihood with weight decay, by forward-backward over all pages at once and Adam."""
    pages = [p for p in pages if p[0]]
    n, t = len(pages), max(len(p[0]) for p in pages)
    index, start, place = [], [0], []
    gold, real = np.zeros((n, t)), np.zeros((n, t), bool)
    for i, (found, labels) in enumerate(pages):
        for j, (b, y) in enumerate(zip(found, labels, strict=True)):
            f = path_features(b.path) + text_features(b)
            index += f
            start.append(len(index))
            place.append(i * t + j)
            gold[i, j], real[i, j] = y, True
    idx, at, place = np.array(index), np.array(start[:-1]), np.array(place)
    sizes = np.diff(start)
    length = real.sum(1)
    theta = np.zeros(FEATURES + 8)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    rows = np.arange(n)
    y = gold.astype(int)
    seen = np.zeros(8)
    for j in range(1, t):
        np.add.at(seen, 2 * y[real[:, j], j - 1] + y[real[:, j], j], 1)
    np.add.at(seen, 4 + y[:, 0], 1)
    np.add.at(seen, 6 + y[rows, length - 1], 1)
    for step in range(1, steps + 1):
        w, trans, first, last = theta[:FEATURES], theta[FEATURES : FEATURES + 4].reshape(2, 2), theta[FEATURES + 4 : FEATURES + 6], theta[FEATURES + 6 :]
        emit = np.zeros((n, t, 2))
        emit.reshape(-1, 2)[place, 1] = np.add.reduceat(w[idx], at)
        fwd, bwd = np.zeros((n, t, 2)), np.zeros((n, t, 2))
        fwd[:, 0] = first + emit[:, 0]
        for j in range(1, t):
            x = np.logaddexp(fwd[:, j - 1, :1] + trans[0], fwd[:, j - 1, 1:] + trans[1]) + emit[:, j]
            fwd[:, j] = np.where(real[:, j, None], x, fwd[:, j - 1])
        z = np.logaddexp(*(fwd[rows, length - 1] + last).T)
        bwd[:, t - 1] = last
        for j in range(t - 2, -1, -1):
            nxt = emit[:, j + 1] + bwd[:, j + 1]
            x = np.logaddexp(trans[:, 0] + nxt[:, :1], trans[:, 1] + nxt[:, 1:])
            bwd[:, j] = np.where(real[:, j + 1, None], x, last)
        p = np.exp(fwd + bwd - z[:, None, None])
        grad = np.zeros_like(theta)
        wrong = (p[..., 1] - gold).reshape(-1)[place]
        grad[:FEATURES] = np.bincount(idx, np.repeat(wrong, sizes), FEATURES)
        for j in range(1, t):
            on = real[:, j]
            pair = np.exp(fwd[on, j - 1, :, None] + trans + (emit[on, j] + bwd[on, j])[:, None, :] - z[on, None, None])
            grad[FEATURES : FEATURES + 4] += pair.sum(0).reshape(-1)
        grad[FEATURES + 4 : FEATURES + 6] = p[:, 0].sum(0)
        grad[FEATURES + 6 :] = p[rows, length - 1].sum(0)
        grad[FEATURES:] -= seen
        grad = grad / n + DECAY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Field(theta[:FEATURES].astype(np.float64), theta[FEATURES : FEATURES + 4].reshape(2, 2), theta[FEATURES + 4 : FEATURES + 6], theta[FEATURES + 6 :])


@functools.cache
def trained(pages: int = PAGES, seed: int = SEED) -> Field:
    """The field, from so many labelled pages that a seeded writer of layouts makes; the same on every call."""
    r = random.Random(seed)
    return train([labelled_page(r) for _ in range(pages)])


def extract(df: DataFrame, html_col: str = "html", name: str = "text") -> DataFrame:
    """df with the main text of each whole page.

    A null or empty page, or one without content, has an empty text. Pages are
    read and decoded one by one, so memory is that of a page; repeated rows give
    repeated results; a column that is called `name` already is replaced.
    The field is trained on the driver on a bounded number of pages (PAGES) and
    broadcast at its fixed size. No row is shuffled.
    """
    spark = c.prepare(df.sparkSession)
    sent = spark.sparkContext.broadcast(trained())

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        field, memo = sent.value, {}
        for pages in batches:
            yield pa.array([main_text(x.as_py(), field, memo) for x in pages], pa.string())

    return df.withColumn(name, text(F.col(html_col).cast("string")))
