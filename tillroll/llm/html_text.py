"""Main text of web pages: the best contiguous region of words against tags.

A page is read as a sequence of words and tags. Words score above zero, tags
below, with weights counted on labelled pages (pages whose markup names the
article). One linear scan finds the region with the largest sum. Elements
that can't be article text (menus, forms, scripts, comments of readers, ...)
score nothing and are left out of the region's text.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import append_columns, read, ship

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|noscript|template|svg|iframe|xmp)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|</?[a-zA-Z][^>]*>?",
    re.S | re.I)
_ATTR = re.compile(r"(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_PART = re.compile(r"[a-z0-9]+")

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font",
          "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr", "nobr", "ruby", "rb", "rt", "rp"}
#: Elements that never hold article text.
NEVER = {"head", "nav", "footer", "aside", "form", "button", "select", "option", "datalist", "fieldset", "menu",
         "dialog", "canvas", "object", "applet", "audio", "video", "map", "math", "title"}
#: Words in class, id or role that mark such an element.
MARKS = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo",
         "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar",
         "footer", "cookie", "cookies", "consent", "gdpr", "notice", "alert", "popup", "modal", "overlay",
         "newsletter", "subscribe", "subscription", "share", "sharing", "social", "related", "recommended",
         "widget", "pagination", "pager", "skip", "complementary", "contentinfo", "search", "toolbar", "tags"}
READERS = {"comment", "comments", "commentlist", "respond", "reply", "replies", "disqus"}
ARTICLE = {"article", "main"}


@dataclass
class Weights:
    """Score of a word by the block it stands in, and of a tag by its name."""
    word: dict[str, float] = field(default_factory=dict)
    tag: dict[str, float] = field(default_factory=dict)
    other_word: float = 1.0
    other_tag: float = -0.4


def _marked(attrs: str) -> str:
    """'' , 'no' (an element to leave out) or 'readers'."""
    kind = ""
    for name, value in _ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            kind = kind or "no"
        elif name == "style":
            if re.search(r"display\s*:\s*none", value):
                kind = kind or "no"
        else:
            parts = set(_PART.findall(value))
            if parts & READERS:
                return "readers"
            if parts & MARKS:
                kind = "no"
    return kind


def tokens(page: str):
    """Yield (kind, key, text, inside, left_out): each run of text and each tag in page order.

    ``kind`` is "text" or "tag"; ``key`` the enclosing block element's name, or
    the tag's name with / for an end tag; ``inside`` whether it lies in an
    ``article`` or ``main`` element; ``left_out`` whether an enclosing element
    can't hold article text.
    """
    stack: list[tuple[str, str]] = []  # (name, "" | "no" | "readers")
    open_: Counter = Counter()         # names on the stack
    forgiven = 0                       # elements below this height count as "", whatever their kind
    out = article = readers = 0
    block = ["body"]
    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            yield "text", block[-1], page[at:m.start()], article > 0, out > 0
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        if not m["close"]:
            kind = _marked(m["attrs"])
            if name in NEVER or (name == "header" and not article):
                kind = kind or "no"
            if name in ARTICLE and not kind and out and not readers:
                forgiven, out = len(stack), 0        # an element before it was never closed
            yield "tag", name, "", article > 0, out > 0 or kind != ""
            if name in VOID or m["attrs"].endswith("/"):
                continue
            stack.append((name, kind))
            open_[name] += 1
            out += kind != ""
            readers += kind == "readers"
            article += name in ARTICLE and kind == ""
            if name not in INLINE:
                block.append(name)
        else:
            known = open_[name] > 0
            while known and stack:
                n, kind = stack.pop()
                open_[n] -= 1
                if len(stack) < forgiven:
                    kind, forgiven = "", len(stack)
                out -= kind != ""
                readers -= kind == "readers"
                article -= n in ARTICLE and kind == ""
                if n not in INLINE and len(block) > 1:
                    block.pop()
                if n == name:
                    break
            article = max(article, 0)
            yield "tag", "/" + name, "", article > 0, out > 0
    if at < len(page):
        yield "text", block[-1], page[at:], article > 0, out > 0


def count_page(page: str, counts: Counter) -> None:
    """Add a labelled page: words by block and tags by name, inside and outside its article."""
    for kind, key, text, inside, left_out in tokens(page):
        if left_out:
            continue
        n = len(text.split()) if kind == "text" else 1
        if n and not (kind == "tag" and key in INLINE | {"/" + x for x in INLINE}):
            counts[kind, key, inside] += n


def weights_from(counts) -> Weights:
    """Log odds of lying in the article, above zero for words and below for tags.

    A tag that bounds the article (its start tag is counted outside, its end
    tag too) scores low, one that mostly stands within it only just below zero.
    """
    w = Weights()
    by = defaultdict(lambda: [0, 0])
    for (kind, key, inside), n in counts.items():
        by[kind, key][bool(inside)] += n
    for (kind, key), (outside, inside) in by.items():
        odds = math.log((inside + 1) / (outside + 1))
        if kind == "text":
            w.word[key] = min(max(odds, 0.05), 5.0)
        else:
            w.tag[key] = min(max(odds - 5.0, -8.0), -0.05)
    return w


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous run with the largest sum above zero, the first of equals; (0, 0) if none."""
    best, at, total, start = 0.0, (0, 0), 0.0, 0
    for k, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += s
        if total > best:
            best, at = total, (start, k + 1)
    return at


def page_scores(parts: list[tuple], w: Weights) -> list[float]:
    scores = []
    for kind, key, text, _, left_out in parts:
        if kind == "text":
            scores.append(0.0 if left_out else len(text.split()) * w.word.get(key, w.other_word))
        elif key.lstrip("/") in INLINE:
            scores.append(0.0)
        else:
            scores.append(w.tag.get(key, w.other_tag))
    return scores


def main_text(page: str | None, w: Weights) -> str:
    """Blocks of the best region, white space within a block as one space, joined by two line feeds."""
    parts = list(tokens(page or ""))
    start, end = best_region(page_scores(parts, w))
    blocks: list[list[str]] = [[]]
    for kind, key, text, _, left_out in parts[start:end]:
        if kind == "text":
            if not left_out:
                blocks[-1].append(html_lib.unescape(text))
        elif key.lstrip("/") == "br":
            blocks[-1].append(" ")
        elif key.lstrip("/") not in INLINE:
            blocks.append([])
    return "\n\n".join(x for x in (" ".join("".join(b).split()) for b in blocks) if x)


def fit_weights(pages: DataFrame, html: str = "html", fit_pages: int = 2000) -> Weights:
    """Weights from about ``fit_pages`` pages that label their own article by markup.

    The sample is fixed by a hash of the page; the tables grow with the tag
    names of the sample only. Without labelled pages the defaults hold.
    """
    ship(pages.sparkSession)
    labelled = pages.select(F.col(html).alias("html")).where(F.col(html).rlike(r"(?i)<(article|main)[\s>]"))
    total = pages.count()
    share = min(1.0, fit_pages / total) if total else 0.0
    sample = labelled.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def count(batches):
        counts = Counter()
        for b in batches:
            for page in b["html"]:
                count_page(page, counts)
        yield pd.DataFrame([(k, key, inside, n) for (k, key, inside), n in counts.items()],
                           columns=["kind", "key", "inside", "n"])

    rows = (sample.mapInPandas(count, "kind string, key string, inside boolean, n long")
            .groupBy("kind", "key", "inside").agg(F.sum("n").alias("n")).collect())
    return weights_from({(r.kind, r.key, r.inside): r.n for r in rows})


def extract_main_text(pages: DataFrame, weights: Weights, html: str = "html", out: str = "text") -> DataFrame:
    """Add the main text of each page in column ``out`` (replaced if it is there).

    Null or empty html, or a page without words: empty text. Whole pages are
    read, whatever their length; each page is a row of its own, so repeated
    rows and any number of partitions are fine, and an empty table stays empty.
    """
    return append_columns(pages, [html], f"`{out}` string",
                          lambda found: [[main_text(h, weights) for h in found]])


def query(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract_main_text(pages, fit_weights(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
