"""Main-text extraction by a maximum-scoring subsequence of a page's tokens.

A page becomes a sequence of tags and pieces of text. A piece scores its words
times the sum of its features' weights: of the element it stands in, of
standing in an element whose name, class, id or role is a cue for boilerplate,
and of standing in the page's ``article`` or ``main``. A tag scores below zero.
One linear scan (Kadane's) finds the contiguous region of the highest score: the
content. Pieces of the region that score below zero are left out.

Weights are log-odds of lying inside a page's ``article`` or ``main`` element,
learned from a bounded sample of pages that mark it (the labelled pages). Keys
are an element's name with its first class or id; keys not seen there fall back
to the element's name. Where no page is labelled, PRIORS stand in.

Defined results: null or empty html: empty text; unclosed elements end where
their parent does; a tag or comment that the page's end cuts off goes with what
it holds, as in a browser; repeated pages give repeated rows; empty table: no
rows. Nothing is dropped or capped for length, and time is linear in it.
"""

from __future__ import annotations

import html as html_module
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches

#: Pages that weights are learned from, chosen by a hash of their id.
MAX_LABELLED = 2000

#: Weights of the features cue and content where nothing is labelled, and the range of what is learned: cues outweigh all else.
PRIORS = {"f:cue": -4.0, "f:content": 2.0}
RANGES = {"w": (-1.0, 1.0), "f:cue": (-4.0, 0.0), "f:content": (0.0, 2.0)}

# quotes count after = only; an attribute that the page's end cuts off takes the rest of the page
_ATTRS = r"(?:=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))|[^>])*+"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|select|svg(?!{_ATTRS}(?<=/)>))\b{_ATTRS}(?:>.*?(?:</(?P=raw)\s*>|\Z)|\Z)"
    rf"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>{_ATTRS})(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|[^<]++|<",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
#: Elements that stand in a line of text; all others separate blocks.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr nobr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose text is never the article's.
BOILERPLATE = frozenset("nav header footer aside form button menu dialog fieldset legend option datalist object audio video canvas map".split())
#: Words in class, id or role that mark boilerplate.
CUES = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion promoted menu nav navbar navigation breadcrumb breadcrumbs sidebar side aside"
    " widget footer foot header masthead notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup login comment comments respond"
    " disqus reply replies discussion share sharing social related recommended recommendations toolbar pagination pager tags copyright legal skip hidden contentinfo complementary search form".split()
)
#: Cues that also name parts of an article: inside one they do not count.
AMBIGUOUS = frozenset("side head header foot form search discussion legal notice notices alert reply replies respond promotion social copyright skip tags".split())
#: Words that may stand beside cues in a name like site-header.
LAYOUT = frozenset("site page main top bottom left right upper lower global primary secondary box bar block area section container wrapper inner outer list links buttons widgets unit slot".split())
#: Elements whose id is a link target named after their text.
TARGETS = frozenset("h1 h2 h3 h4 h5 h6 p section li dt dd td th tr a span figure figcaption table blockquote pre".split())
#: Elements that do not end the head.
HEAD = frozenset("head title meta link base script style noscript template".split())
#: Elements that begin afresh: open boilerplate ends before them.
CONTENT = frozenset({"article", "main"})


def cued(token: str, inside: bool) -> bool:
    """Whether a whole class, id or role names boilerplate: it holds a cue and no word of another kind."""
    words = {w for w in re.split(r"[^a-z0-9]+", token) if w and not w.isdigit()}
    return words <= CUES | LAYOUT and not words.isdisjoint(CUES - AMBIGUOUS if inside else CUES)


def key_of(name: str, attrs: str, inside: bool = False) -> tuple[str, bool]:
    """An element's weight key, and whether its name or attributes mark boilerplate, inside an article or not."""
    marked, label = name in BOILERPLATE, ""
    for attr, value in ATTRIBUTE.findall(attrs) if attrs else ():
        attr, value = attr.lower(), value.strip("\"'").lower()
        if attr in ("class", "id", "role"):
            label = label or (value.split() or [""])[0]
            if name not in ("html", "body", *CONTENT) and not (attr == "id" and name in TARGETS):
                marked = marked or any(cued(token, inside) for token in value.split())
        elif attr == "hidden" or (attr == "aria-hidden" and value == "true") or (attr == "style" and re.search(r"display\s*:\s*none", value)):
            marked = True
    return f"{name}.{label}" if label else name, marked


class _Open:
    """The open elements of a page; every question about them takes constant time."""

    def __init__(self):
        self.stack: list[tuple[str, str, bool, bool]] = []  # name, key, boilerplate, content
        self.places: dict[str, list[int]] = {}  # where each name stands
        self.blocks: list[int] = []  # where what is not inline stands

    def push(self, name: str, key: str, boiler: bool, content: bool) -> None:
        self.places.setdefault(name, []).append(len(self.stack))
        if name not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append((name, key, boiler, content))

    def pop(self) -> None:
        name = self.stack.pop()[0]
        self.places[name].pop()
        if name not in INLINE:
            self.blocks.pop()

    def close(self, name: str) -> bool:
        """End the innermost element of a name and all in it; an inline one does not reach out of its block."""
        if not self.places.get(name):
            return True
        at = self.places[name][-1]
        if name in INLINE and self.blocks and self.blocks[-1] > at:
            return False
        while len(self.stack) > at:
            self.pop()
        return True

    def top(self) -> tuple[str, bool, bool]:
        return self.stack[-1][1:] if self.stack else ("", False, False)


def tokens(page: str | None) -> Iterator[tuple[str, str, str, bool, bool]]:
    """(kind, value, element key, boilerplate, in article or main) of a page's tags and texts.

    Kinds: ``text``, ``open`` and ``close`` (value: the element's name).
    """
    have = _Open()
    stack, in_head = have.stack, False
    for m in TOKEN.finditer(page or ""):
        name = m["name"]
        if in_head:  # ends at its end tag, or before the first text or tag that a head does not hold
            tag = (name or m["raw"] or "").lower()
            if tag == "head" and m["end"]:
                in_head = False
                continue
            if tag in HEAD or (m["end"] and tag not in ("body", "html")) or (not tag and (m[0].isspace() or m[0][:2] in ("<!", "<?", "</"))):
                continue
            in_head = False
        if name is None:
            text = m[0]
            if m["raw"] or (text[0] == "<" and len(text) > 1):
                continue
            yield "text", html_module.unescape(text) if "&" in text else text, *have.top()
            continue
        name = name.lower()
        if name == "head":  # one inside the body is ignored
            in_head = not m["end"] and len(stack) == len(have.places.get("html", ()))
            continue
        if m["end"]:
            if have.close(name):
                yield "close", name, *have.top()
            continue
        if name in CONTENT:
            while stack and stack[-1][2] and not stack[-1][3]:
                have.pop()
        elif name not in INLINE and name not in VOID:
            # an open paragraph ends where the next block begins
            while stack and (stack[-1][0] == "p" or (stack[-1][0] in INLINE and have.places.get("p"))):
                have.pop()
        _, boiler, content = have.top()
        inside = content or name in CONTENT
        key, marked = key_of(name, m["attrs"], inside)
        # a header inside the article may carry its title
        marked = marked and not (name == "header" and inside and "." not in key)
        if name not in VOID and not m["attrs"].endswith("/"):
            have.push(name, key if name not in INLINE else (stack[-1][1] if stack else key), boiler or marked, inside)
        yield "open", name, key, boiler or marked, inside


def page_counts(page: str | None) -> dict[str, list[int]]:
    """Inside and outside counts of text words and tags by feature, for a page that marks its content."""
    out: dict[str, list[int]] = {}

    def add(key: str, n: int, content: bool) -> None:
        out.setdefault(key, [0, 0])[0 if content else 1] += n

    for kind, value, key, boiler, content in tokens(page):
        if kind == "text" and (n := len(value.split())):
            # what stands under a cue says nothing about the element that it stands in
            add("f:cue" if boiler else "w:" + key, n, content)
            if content:
                add("f:content", n, content)
        elif kind == "open":
            add("t:" + key, 1, content)
    return out if any(a for a, _ in out.values()) else {}


def learn_weights(pages: DataFrame, page_id: str = "page_id", html: str = "html", most: int = MAX_LABELLED) -> dict[str, float]:
    """Weights by key from at most ``most`` pages that mark their content."""
    small_batches(pages.sparkSession)
    marked = pages.where(F.col(html).rlike(r"(?i)<(article|main)\b")).select(F.col(page_id).alias("page_id"), F.col(html).cast("string").alias("html"))
    keys = marked.select("page_id", F.xxhash64("page_id").alias("h")).orderBy("h", "page_id").limit(most)
    sample = marked.join(F.broadcast(keys.select("page_id").distinct()), "page_id")  # most rows of 8 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[str, list[int]] = {}
            for value in batch.column(1):
                for k, (a, b) in page_counts(value.as_py()).items():
                    cell = total.setdefault(k, [0, 0])
                    cell[0] += a
                    cell[1] += b
            rows = [*total.items()]
            columns = [pa.array([k for k, _ in rows], pa.string()), *(pa.array([c[i] for _, c in rows], pa.int64()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "inside", "outside"])

    sums = sample.mapInArrow(run, "key string, inside bigint, outside bigint").groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    out = {}
    for r in sums.collect():  # the keys of at most ``most`` pages
        odds = math.log((r["inside"] + 0.5) / (r["outside"] + 0.5))
        # words score positive where content holds them; tags always negative
        low, high = RANGES.get(r["key"]) or RANGES["w"]
        out[r["key"]] = -max(0.01, min(1.0, -odds)) if r["key"].startswith("t:") else max(low, min(high, odds))
    return out


def scored_pieces(page: str | None, weights: dict[str, float]) -> list[tuple[float, str | None]]:
    """(score, text) of a page's tokens; None stands for the end of a block."""
    cue, within = (weights.get(f, PRIORS[f]) for f in ("f:cue", "f:content"))
    parts: list[tuple[float, str | None]] = []
    for kind, value, key, boiler, content in tokens(page):
        if kind != "text":
            if value not in INLINE:
                parts.append((weights.get("t:" + (key if kind == "open" else value), -0.1), None))
            continue
        # an element that the labelled pages do not hold: by its name, else as content
        known = weights.get("w:" + key, weights.get("w:" + key.split(".")[0], 1.0))
        weight = known + cue * boiler + within * content
        # what stands out of place costs the region little: an advert does not end an article
        parts.append((len(value.split()) * (weight if weight > 0 else max(weight, -0.05 if boiler else weight)), value))
    return parts


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous run of the highest total, in one pass (Kadane's scan)."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, at = total, (start, i + 1)
    return at


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The main text of a page."""
    parts = scored_pieces(page, weights)
    blocks, open_ = [], []
    for score, text in [*parts[slice(*best_region([s for s, _ in parts]))], (0.0, None)]:
        if text is None:
            if block := " ".join("".join(open_).split()):
                blocks.append(block)
            open_ = []
        elif score >= 0:
            open_.append(text)
    return " ".join(blocks)


def main_text(html: Column, weights: dict[str, float]) -> Column:
    """Column of main texts."""

    @F.pandas_udf("string")
    def run(batch):
        return batch.map(lambda page: extract(page if isinstance(page, str) else None, weights))

    return run(html.cast("string"))
