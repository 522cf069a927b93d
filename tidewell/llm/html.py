"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of a page.

A leaf block is the text between two block-level tags. Its features are the tags and the class, id and role words
of its ancestors, and what its text looks like. The field scores each block's label (main text or not) and each
pair of neighbouring labels; it is trained by gradient ascent on the likelihood of labelled pages and decoded by
Viterbi. The labelled pages are layouts made here by rule (``labelled_pages``), since the tables have no labels;
other ones can be given to ``fit``.
"""

from __future__ import annotations

import html as references
import functools
import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewell.llm.base import tune

# --- blocks -----------------------------------------------------------------------------------------------------

# The elements of HTML by how they take part in the text.
_BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary "
    "table tbody td tfoot th thead tr ul button textarea label".split()
)
_VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN_TAGS = ("script", "style", "noscript", "template", "iframe", "object", "svg", "title", "audio", "video", "canvas")
_FOREIGN_TAGS = frozenset(("svg", "math"))
_RAW_TAGS = frozenset(("script", "style", "iframe", "title", "noscript"))
#: Opening one of these ends an open one of the others in its list, up to the element that holds them.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s=>/]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""")
_TOKENS = re.compile(r"[a-z]+")
_WHITE = re.compile(r"\s+")


@dataclass(frozen=True)
class Known:
    """Tags and name words that a model has weights for; others need not be remembered."""

    tags: frozenset[str]
    names: frozenset[str]


@dataclass
class Block:
    text: str
    tags: frozenset[str]  # of the ancestors
    names: frozenset[str]  # words of the class, id and role attributes of the ancestors
    own: str  # the nearest block element, and the one around it
    parent: str
    linked: int = 0  # characters inside links
    label: int | None = None


@dataclass
class _Open:
    """An open element with what it has in common with those around it. Elements that add nothing share their parent's
    sets, so a stack of any depth is as large as its elements."""

    tag: str
    tags: frozenset[str]
    names: frozenset[str]
    own: str
    parent: str
    label: int | None
    block: int  # place of the nearest block element, itself included
    wall: int  # the same without paragraphs


_NOTHING = _Open("", frozenset(), frozenset(), "-", "-", None, -1, -1)


@dataclass
class _Page:
    known: Known | None = None
    stack: list[_Open] = field(default_factory=list)
    places: dict[str, list[int]] = field(default_factory=dict)  # of each tag's open elements in the stack
    blocks: list[Block] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    breaks: int = 0

    def nearest(self, tags) -> int:
        """Place of the innermost open element with one of the tags; -1 if there is none."""
        return max((found[-1] for t in tags if (found := self.places.get(t))), default=-1)

    @property
    def top(self) -> _Open:
        return self.stack[-1] if self.stack else _NOTHING

    def cut(self, at: int) -> None:
        while len(self.stack) > at:
            self.places[self.stack.pop().tag].pop()

    def say(self, text: str) -> None:
        if not text:
            return
        if text.strip():
            self.breaks = 0
        if self.places.get("a"):
            self.linked += len(text.strip())
        self.pieces.append(text)

    def line_break(self) -> None:
        """One is white space, two in a row end the block."""
        self.breaks += 1
        if self.breaks > 1:
            self.end()
        else:
            self.pieces.append(" ")

    def end(self) -> None:
        text = _WHITE.sub(" ", "".join(self.pieces)).strip()
        if text:
            o = self.top
            self.blocks.append(Block(text, o.tags, o.names, o.own, o.parent, self.linked, o.label))
        self.pieces, self.linked, self.breaks = [], 0, 0

    def open(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in _BLOCK_TAGS:
            self.end()
            if tag in _ENDS:
                ended, within = _ENDS[tag]
                if (at := self.nearest(ended)) > self.nearest(within):
                    self.cut(at)
            if (at := self.nearest(("p",))) > self.top.wall:  # a block ends an open paragraph
                self.cut(at)
        if tag not in _VOID_TAGS:
            self.push(tag, attributes)

    def push(self, tag: str, attributes: dict[str, str]) -> None:
        text = " ".join(attributes.get(k, "") for k in ("class", "id", "role"))
        words, tags = frozenset(_TOKENS.findall(text.lower())), frozenset((tag,))
        if self.known is not None:
            words, tags = words & self.known.names, tags & self.known.tags
        o, at, block = self.top, len(self.stack), tag in _BLOCK_TAGS
        mark = attributes.get("data-label")
        self.stack.append(
            _Open(
                tag,
                o.tags if tags <= o.tags else o.tags | tags,
                o.names if words <= o.names else o.names | words,
                tag if block else o.own,
                o.own if block else o.parent,
                int(mark) if mark in ("0", "1") else o.label,
                at if block else o.block,
                at if block and tag != "p" else o.wall,
            )
        )
        self.places.setdefault(tag, []).append(at)

    def close(self, tag: str) -> None:
        if tag in _BLOCK_TAGS:
            self.end()
        at = self.nearest((tag,))
        if at >= 0 and (tag in _BLOCK_TAGS or at > self.top.block):  # an inline end tag does not end a block
            self.cut(at)


def _attributes(page: str, at: int) -> tuple[dict[str, str], int, bool]:
    """Attributes of the tag whose name ends at ``at``, the place after the tag, and whether it ends with '/>' (a slash
    that ends a value without quotes belongs to the value)."""
    found: dict[str, str] = {}
    n = len(page)
    slash = False
    while at < n and page[at] != ">":
        m = _ATTRIBUTE.match(page, at)
        if m.end() == at:
            at += 1
            continue
        slash = page[m.end() - 1] == "/" and not (m[2] or "").endswith("/")
        if m[1]:
            value = m[2] or ""
            if value[:1] in ("'", '"') and value[-1:] == value[:1] and len(value) > 1:
                value = value[1:-1]
            found.setdefault(m[1].lower(), value)
        at = m.end()
    return found, at + 1, slash and at < n


def blocks_of(page: str, known: Known | None = None) -> list[Block]:
    """The leaf blocks of a page in order; comments and what is never shown are left out, the text for browsers that
    cannot show an object, sound, film or drawing too. Time and memory grow with the page, however it is nested.

    The tags of a head, which may be left out, hide nothing: what a head holds is hidden or empty by itself. In svg and
    math '/>' ends an element.
    """
    out, at, n = _Page(known), 0, len(page)
    hidden: str | None = None  # the element whose content is left out
    depth = 0
    while at < n:
        lt = page.find("<", at)
        lt = n if lt < 0 else lt
        if lt > at and hidden is None:
            out.say(references.unescape(page[at:lt]))
        if lt == n:
            break
        following = page[lt + 1 : lt + 2]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
        elif following in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
        elif following == "/" and (m := _NAME.match(page, lt + 2)):
            end = page.find(">", m.end())
            at = n if end < 0 else end + 1
            tag = m[0].lower()
            if hidden == tag:
                depth -= 1
                hidden = hidden if depth else None
            elif hidden is None and tag != "head":
                out.close(tag)
        elif m := _NAME.match(page, lt + 1):
            tag = m[0].lower()
            attributes, at, slash = _attributes(page, m.end())
            foreign = tag in _FOREIGN_TAGS or hidden == "svg" or bool(out.places.get("math"))
            if slash and foreign:
                continue
            if hidden is not None:
                depth += tag == hidden
            elif tag in _HIDDEN_TAGS:
                hidden, depth = tag, 1
            elif tag == "br":
                out.line_break()
            elif tag != "head":
                out.open(tag, attributes)
            if tag in _RAW_TAGS:  # no tags inside; its end tag is next
                end = re.compile(rf"</{tag}", re.IGNORECASE).search(page, at)
                at = end.start() if end else n
        else:
            if hidden is None:
                out.say("<")
            at = lt + 1
    out.end()
    return out.blocks


# --- features ---------------------------------------------------------------------------------------------------

_SENTENCE_END = re.compile(r"[.!?…。][\"'»”)\]]*$")
_RIGHTS = re.compile(r"©|\(c\)|copyright|all rights", re.IGNORECASE)


def features(blocks: list[Block]) -> list[list[str]]:
    out = []
    for i, b in enumerate(blocks):
        n = len(b.text)
        words = b.text.count(" ") + 1
        found = ["bias", f"words={min(7, int(math.log2(words)))}", f"linked={min(4, 5 * b.linked // max(1, n))}"]
        found += [f"tag={t}" for t in sorted(b.tags)]
        found += [f"name={w}" for w in sorted(b.names)]
        found += [f"own={b.own}", f"parent={b.parent}"]
        found.append(f"commas={min(3, b.text.count(','))}")
        if _SENTENCE_END.search(b.text):
            found.append("sentence")
            if words >= 8:
                found.append("long sentence")
        if _RIGHTS.search(b.text):
            found.append("rights")
        if "|" in b.text or "»" in b.text or "·" in b.text:
            found.append("separator")
        if i == 0:
            found.append("first")
        if i == len(blocks) - 1:
            found.append("last")
        out.append(found)
    return out


# --- the field --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    index: dict[str, int]
    weights: np.ndarray  # features x 2
    moves: np.ndarray  # from label, to label

    @functools.cached_property
    def known(self) -> Known:
        starting = lambda kind: frozenset(f[len(kind) :] for f in self.index if f.startswith(kind))
        return Known(starting("tag="), starting("name="))


def _scores(model_index: dict[str, int], weights: np.ndarray, found: list[list[str]]) -> np.ndarray:
    out = np.zeros((len(found), 2))
    for i, names in enumerate(found):
        known = [model_index[f] for f in names if f in model_index]
        out[i] = weights[known].sum(axis=0)
    return out


def viterbi(scores: np.ndarray, moves: np.ndarray) -> list[int]:
    """The labels of greatest score."""
    if not len(scores):
        return []
    (m00, m01), (m10, m11) = moves.tolist()
    rows = scores.tolist()
    a, b = rows[0]
    back = []
    for s0, s1 in rows[1:]:
        from0 = (0, a + m00) if a + m00 >= b + m10 else (1, b + m10)
        from1 = (0, a + m01) if a + m01 >= b + m11 else (1, b + m11)
        back.append((from0[0], from1[0]))
        a, b = from0[1] + s0, from1[1] + s1
    label = 0 if a >= b else 1
    out = [label]
    for step in reversed(back):
        label = step[label]
        out.append(label)
    return out[::-1]


def _marginals(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label of each block, and the expected number of each move, by forward and backward sums."""
    n = len(scores)
    forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
    forward[0] = scores[0]
    for i in range(1, n):
        forward[i] = np.logaddexp.reduce(forward[i - 1][:, None] + moves, axis=0) + scores[i]
    for i in range(n - 2, -1, -1):
        backward[i] = np.logaddexp.reduce(moves + (scores[i + 1] + backward[i + 1])[None, :], axis=1)
    total = np.logaddexp.reduce(forward[-1])
    expected = np.zeros((2, 2))
    for i in range(1, n):
        expected += np.exp(forward[i - 1][:, None] + moves + (scores[i] + backward[i])[None, :] - total)
    return np.exp(forward + backward - total), expected


def fit(pages: list[list[Block]], epochs: int = 12, rate: float = 0.3, decay: float = 1e-4, seed: int = 5) -> Field:
    """Train on pages whose blocks have labels, by AdaGrad on the likelihood of a page at a time."""
    data = [(features(p), np.array([b.label for b in p])) for p in pages if p]
    index: dict[str, int] = {}
    for found, _ in data:
        for names in found:
            for f in names:
                index.setdefault(f, len(index))
    weights, moves = np.zeros((len(index), 2)), np.zeros((2, 2))
    seen_w, seen_m = np.full_like(weights, 1e-2), np.full_like(moves, 1e-2)
    coded = [([np.array([index[f] for f in names]) for names in found], labels) for found, labels in data]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(coded)):
            found, labels = coded[k]
            scores = np.array([weights[ids].sum(axis=0) for ids in found])
            p, expected = _marginals(scores, moves)
            error = -p
            error[np.arange(len(labels)), labels] += 1
            sizes = [len(ids) for ids in found]
            ids = np.concatenate(found)
            gradient = np.zeros_like(weights)
            np.add.at(gradient, ids, np.repeat(error, sizes, axis=0))
            gradient -= decay * weights
            counted = np.zeros((2, 2))
            np.add.at(counted, (labels[:-1], labels[1:]), 1)
            seen_w += gradient**2
            weights += rate * gradient / np.sqrt(seen_w)
            seen_m += (counted - expected) ** 2
            moves += rate * (counted - expected) / np.sqrt(seen_m)
    return Field(index, weights, moves)


def main_text(model: Field, page: str | None) -> str:
    blocks = blocks_of(page or "", model.known)
    labels = viterbi(_scores(model.index, model.weights, features(blocks)), model.moves)
    return "\n".join(b.text for b, y in zip(blocks, labels) if y)


# --- labelled pages -----------------------------------------------------------------------------------------------

# Words that sites use in class and id attributes.
_CONTENT_NAMES = (
    "content", "post", "entry", "story", "text", "post content", "entry content", "article body", "main content", "post body", "page content",
)
_SIDE_NAMES = {
    "menu": ("menu", "nav", "navbar", "navigation", "topnav", "main menu", "breadcrumb", "breadcrumbs", "toolbar", "tabs", "pagination", "pager", "toc"),
    "header": ("header", "masthead", "site header", "top", "logo", "brand", "site title", "page header"),
    "footer": ("footer", "site footer", "bottom", "copyright", "legal", "colophon", "page footer"),
    "aside": ("sidebar", "aside", "widget", "rail", "related", "recommended", "trending", "popular", "tags", "author box", "secondary", "column"),
    "notice": ("notice", "cookie", "cookie banner", "consent", "banner", "alert", "message", "gdpr", "popup", "modal", "overlay", "paywall", "warning"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "promotion", "adbox", "ad slot", "banner ad", "affiliate"),
    "form": ("form", "search", "newsletter", "subscribe", "signup", "login", "contact", "poll"),
    "comments": ("comments", "comment", "comment list", "respond", "reply", "replies", "discussion", "disqus", "reader comments", "responses", "feedback"),
    "share": ("share", "social", "sharing", "follow", "buttons"),
}
_SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe qui ro su ta ve wi xa yo zé ñu çä th st er an in on ou".split()


class _Writer:
    """Pages put together by a seeded draw of layouts; data-label marks what is main text."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def word(self) -> str:
        return "".join(self.rng.choice(_SYLLABLES) for _ in range(self.rng.choice((1, 1, 2, 2, 3, 4))))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high))).capitalize()

    def sentences(self, low: int, high: int) -> str:
        one = lambda: re.sub(r"(\w) (\w)", lambda m: m[0] if self.rng.random() > 0.08 else f"{m[1]}, {m[2]}", self.words(2, 18)) + self.rng.choice("...!?")
        return " ".join(one() for _ in range(self.rng.randint(low, high)))

    def named(self, names: str) -> str:
        joined = names.replace(" ", self.rng.choice((" ", "-", "_")))
        return self.rng.choice((f' class="{joined}"', f' id="{joined}"', f' class="{joined} {self.word()}"', f" class='{joined}'"))

    def wrapped(self, kind: str, body: str, tags: tuple[str, ...] = ("div", "section", "div")) -> str:
        tag = self.rng.choice(tags)
        plain = tag in ("nav", "header", "footer", "aside", "form") and self.rng.random() < 0.6
        names = "" if plain else self.named(self.rng.choice(_SIDE_NAMES[kind]))
        return f'<{tag}{names} data-label="0">{body}</{tag}>'

    def links(self, low: int, high: int, short: bool = True) -> str:
        items = [f'<a href="/{self.word()}">{self.words(1, 3) if short else self.words(3, 12)}</a>' for _ in range(self.rng.randint(low, high))]
        style = self.rng.random()
        if style < 0.6:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return self.rng.choice((" | ", " · ", " ", "<br>")).join(items)

    def side(self, kind: str) -> str:
        r = self.rng
        if kind == "menu":
            return self.wrapped(kind, self.links(3, 9), ("nav", "nav", "div", "ul"))
        if kind == "header":
            body = r.choice((f"<h1>{self.words(1, 3)}</h1>", f"<a href='/'>{self.words(1, 3)}</a>", f"<p>{self.words(2, 6)}</p>"))
            return self.wrapped(kind, body + (self.side("menu") if r.random() < 0.4 else ""), ("header", "header", "div"))
        if kind == "footer":
            body = r.choice((f"&copy; {r.randint(1990, 2030)} {self.words(1, 4)}", f"&copy; {self.word()}.example &middot; {self.sentences(1, 1)}", self.links(2, 6), f"<p>{self.sentences(1, 2)}</p><p>Copyright {self.words(1, 3)}</p>"))
            return self.wrapped(kind, body, ("footer", "footer", "div"))
        if kind == "aside":
            body = f"<h3>{self.words(1, 3)}</h3>" + r.choice((self.links(3, 8, False), f"<p>{self.sentences(1, 3)}</p>", self.links(2, 5)))
            return self.wrapped(kind, body, ("aside", "aside", "div"))
        if kind == "notice":
            return self.wrapped(kind, r.choice((f"<p>{self.sentences(1, 3)}</p>", self.sentences(1, 2)) ) + f"<button>{self.words(1, 2)}</button>" * r.randint(0, 1), ("div", "div", "section", "dialog"))
        if kind == "advert":
            return self.wrapped(kind, r.choice((self.sentences(1, 4), f"<p>{self.sentences(1, 3)}</p>", f"<a href='#'>{self.words(3, 9)}</a>")), ("div", "div", "div", "aside", "section"))
        if kind == "form":
            return self.wrapped(kind, f"<label>{self.words(1, 4)}</label><input type=text><p>{self.words(2, 8)}</p><button>{self.words(1, 2)}</button>", ("form",))
        if kind == "comments":
            tag = r.choice(("div", "li", "article"))
            one = lambda: f"<{tag}{self.named('comment')}><b>{self.words(1, 2)}</b>: <p>{self.sentences(1, 4)}</p></{tag}>"
            return self.wrapped(kind, f"<h3>{self.words(1, 2)}</h3>" + "".join(one() for _ in range(r.randint(1, 5))), ("section", "div", "div", "ul"))
        return self.wrapped("share", self.links(2, 5))

    def main(self) -> str:
        r = self.rng
        parts = [f"<h1>{self.words(2, 10)}</h1>"] if r.random() < 0.85 else []
        for _ in range(r.choice((1, 2, 3, 5, 8, 12))):
            x = r.random()
            text = self.sentences(1, 7)
            if x < 0.62:
                parts.append(f"<p>{text}</p>")
            elif x < 0.72:
                parts.append(f"<p><b>{text}<br>")  # end tags are often left out
            elif x < 0.78:
                parts.append(f"<h2>{self.words(1, 6)}</h2>")
            elif x < 0.84:
                parts.append("<ul>" + "".join(f"<li>{self.words(2, 14)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif x < 0.88:
                parts.append(f"<blockquote>{text}</blockquote>")
            elif x < 0.92:
                parts.append(f"<div>{text}</div>")
            elif x < 0.95:
                parts.append(f"<pre>{self.words(3, 20)}</pre>")
            else:
                parts.append(f"<table><tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr></table>")
            if r.random() < 0.06:
                parts.append(self.side(r.choice(("advert", "aside", "notice", "share", "form"))))
        if r.random() < 0.12:
            parts.append(self.side("comments"))
        body, names = "".join(parts), r.choice(_CONTENT_NAMES)
        style = r.random()
        if style < 0.4:
            return f'<article data-label="1">{body}</article>'
        if style < 0.5:
            return f'<main><article{self.named(names)} data-label="1">{body}</article></main>'
        if style < 0.65:
            return f'<main data-label="1">{body}</main>'
        if style < 0.92:
            return f'<{r.choice(("div", "section"))}{self.named(names)} data-label="1">{body}</div></section>'
        return f'<div data-label="1">{body}</div>'

    def page(self) -> str:
        r = self.rng
        before = [self.side(k) for k in ("notice", "header", "menu", "advert", "form") if r.random() < 0.5]
        after = [self.side(k) for k in ("share", "comments", "aside", "advert", "form", "menu", "notice", "footer") if r.random() < 0.4]
        r.shuffle(before)
        return f'<html><head><title>{self.words(2, 6)}</title></head><body data-label="0">' + "".join(before) + self.main() + "".join(after) + "</body></html>"


def labelled_pages(count: int = 500, seed: int = 3) -> list[list[Block]]:
    writer = _Writer(seed)
    return [blocks_of(writer.page()) for _ in range(count)]


# --- on DataFrames ------------------------------------------------------------------------------------------------


def extract(pages: DataFrame, model: Field | None = None, html: str = "html", out: tuple[str, str] = ("text", "n_chars")) -> DataFrame:
    """``pages`` without its html, with the main text of each page and its number of code points.

    A page without main text, an empty one and a null one have empty text. White space inside a block becomes one
    space, blocks are joined by one line end; whole pages are read, of any size. Columns named as in ``out`` are
    replaced; repeated rows give equal texts. No rows give no rows.
    """
    spark = tune(pages.sparkSession)
    shared = spark.sparkContext.broadcast(model or fit(labelled_pages()))  # a weight per feature of the labelled pages
    keep = [f for f in pages.schema.fields if f.name not in (html, *out)]
    schema = T.StructType([*keep, T.StructField(out[0], T.StringType()), T.StructField(out[1], T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            texts = [main_text(known, h) for h in b.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema.names
            )

    rows = pages.select(*[pages[f"`{f.name}`"].alias(f"_c{i}") for i, f in enumerate(keep)], pages[f"`{html}`"].cast("string").alias("_html"))
    return rows.mapInArrow(run, schema)
