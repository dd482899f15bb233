"""Main text of web pages by consensus host paths.

Each page's containers are scored; those that hold nearly all of the page's own text (what is no part of a menu,
notice, form and the like, and no link) are candidates, and the page votes for the innermost or best named of
them as a generalised path of tags and classes. Votes are summed by host in Spark. Every page is then read again
under the candidate, of its own, that most of its host's votes went to. A path that holds less than nearly all of
a page's text is never taken there, however many votes it has: the page is read under an ancestor instead.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_etl.llm.common import materialize

#: Votes of hosts are broadcast up to this many rows; beyond, pages are joined with their paths instead.
MAX_BROADCAST_ROWS = 200_000
#: A container is a candidate if it holds this share of the page's own text.
NEARLY_ALL = 0.95

# Tags of HTML by their role.
RAW_TAGS = {"script", "style", "noscript", "template", "textarea", "title", "svg", "iframe"}
BOILER_TAGS = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "head"}
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CONTAINERS = {"body", "main", "article", "section", "div", "td", "center"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSES_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
BOILER_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies",
    "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pagination", "popup",
    "promo", "promos", "promotion", "related", "replies", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget", "widgets",
}
CONTENT_WORDS = {"article", "body", "container", "content", "entry", "layout", "main", "page", "post", "story", "wrapper"}
STATE_WORDS = {"has", "with", "no", "without", "is", "js"}
BOILER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar"}
#: What decides between candidates: how likely the tag is to hold an article, then the depth.
BONUS = {"article": 0.4, "main": 0.3, "section": 0.05, "div": 0.1, "td": 0.05}

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")


class Frame:
    __slots__ = ("tag", "path", "skip", "chars")

    def __init__(self, tag: str, path: str, skip: bool):
        self.tag, self.path, self.skip, self.chars = tag, path, skip, 0


def _no_article(name: str) -> bool:
    """Whether a class or id names a part that is no article: post-comments does, page-with-sidebar doesn't."""
    words = [w.lower() for w in _SPLIT.split(name) if w]
    if not words or words[0] in STATE_WORDS or STATE_WORDS & set(words[:-1]):
        return False
    return words[-1] in BOILER_WORDS or bool(BOILER_WORDS & set(words)) and not CONTENT_WORDS & set(words)


def _described(tag: str, attributes: str) -> tuple[str, bool]:
    """The tag with its generalised classes, and whether it is no part of an article."""
    skip, step = tag in BOILER_TAGS, tag
    if attributes and attributes.strip():
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), (m[2] or "").strip("\"'")
            if name == "class":
                step += "".join("." + c for c in sorted(set(re.sub(r"\d+", "#", value).split())))
            if name in ("class", "id"):
                skip |= tag not in ("body", "html") and any(map(_no_article, value.split()))
            elif name == "role":
                skip |= value.lower() in BOILER_ROLES
            elif name == "hidden" or value.lower() == "true":
                skip = True
    return step, skip


def walk(page: str) -> Iterator[tuple[str, object, str]]:
    """Events of a page: ("open", frame, ""), ("close", frame, ""), ("text", frame, text), ("break", frame, "")."""
    root = Frame("", "", False)
    stack, at = [root], 0

    def close(n: int) -> Iterator[tuple[str, Frame, str]]:
        while len(stack) > n:
            yield "close", stack.pop(), ""

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            if at < len(page):
                yield "text", stack[-1], page[at:]
            break
        if m.start() > at:
            yield "text", stack[-1], page[at : m.start()]
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    yield from close(k)
                    break
                if tag in INLINE and stack[k].tag in CONTAINERS:
                    break
            continue
        if tag in RAW_TAGS:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            if not m[0].endswith("/>"):
                at = end.end() if end else len(page)
            yield "break", stack[-1], ""
            continue
        if tag in VOID_TAGS:
            yield "break" if tag in ("br", "hr", "img") else "none", stack[-1], ""
            continue
        if tag in CLOSES_P or tag in ("li", "dt", "dd", "tr", "td", "th"):
            ends = ("p",) if tag in CLOSES_P else ("li", "p") if tag == "li" else ("dt", "dd", "p") if tag in ("dt", "dd") else ("td", "th", "p") if tag in ("td", "th") else ("tr", "td", "th", "p")
            stops = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "td": ("tr", "table"), "th": ("tr", "table"), "tr": ("table",)}.get(tag, ())
            cut = len(stack)
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in stops or (stack[k].tag in CONTAINERS and stack[k].tag not in ends) or stack[k].tag == "table":
                    break
                if stack[k].tag in ends:
                    cut = k
            yield from close(cut)
        step, skip = _described(tag, m[3] or "")
        top = stack[-1]
        frame = Frame(tag, f"{top.path}>{step}" if tag in CONTAINERS else top.path, skip or top.skip)
        stack.append(frame)
        yield "open", frame, ""
    yield from close(1)
    yield "close", root, ""


def candidates(page: str) -> list[tuple[str, float]]:
    """(path, score) of the containers with nearly all of the page's own text, best first."""
    held: dict[str, int] = {}
    open_frames: list[Frame] = [Frame("", "", False)]
    total = 0
    for kind, frame, text in walk(page):
        if kind == "text" and not frame.skip:
            n = len(text.strip())
            if n and not any(f.tag == "a" for f in open_frames):
                open_frames[-1].chars += n
                total += n
        elif kind == "open":
            open_frames.append(frame)
        elif kind == "close" and len(open_frames) > 1 and frame is open_frames[-1]:
            open_frames.pop()
            open_frames[-1].chars += frame.chars
            if frame.tag in CONTAINERS and not frame.skip:
                held[frame.path] = max(held.get(frame.path, 0), frame.chars)
    out = []
    for path, chars in held.items():
        if total and chars >= NEARLY_ALL * total:
            last = path.rpartition(">")[2].partition(".")[0]
            out.append((path, BONUS.get(last, 0.0) + 0.01 * path.count(">")))
    # An article is read whole: what it holds is no better place than the article itself.
    articles = [path + ">" for path, _ in out if path.rpartition(">")[2].partition(".")[0] == "article"]
    return sorted((x for x in out if not x[0].startswith(tuple(articles))), key=lambda x: (-x[1], x[0]))


def extract(page: str, path: str | None) -> str:
    """The text under the containers of that path; of the whole page if path is null or not there."""
    parts: list[str] = []
    inside, there = 0 if path else 1, not path
    for kind, frame, text in walk(page):
        if kind == "open":
            if path and frame.tag in CONTAINERS and frame.path == path:
                inside, there = inside + 1, True
            if frame.tag not in INLINE:
                parts.append(" ")
        elif kind == "close":
            if path and frame.tag in CONTAINERS and frame.path == path:
                inside -= 1
            if frame.tag not in INLINE:
                parts.append(" ")
        elif kind == "break":
            parts.append(" ")
        elif kind == "text" and inside > 0 and not frame.skip:
            parts.append(entities.unescape(text) if "&" in text else text)
    return " ".join("".join(parts).split()) if there else extract(page, None)


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [candidates(x) if x else [] for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page"), batch.column("host"), pa.array([[p for p, _ in c] for c in found], pa.list_(pa.string()))],
            names=["page", "host", "paths"],
        )


def host_of(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Returns (id, url, text, n_chars) for every row of pages; nothing is cut.

    Defined cases: a null or empty page, and one without text, gives the empty text; pages with a null or
    odd URL vote together as one host; rows that repeat an id or have none are read one by one; a page without
    candidates is read whole.
    """
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host_of(url_col).alias("host"))
    kind = dict(rows.dtypes)["page"]
    own = materialize(rows.select("page", "host", "html").mapInArrow(_scored, f"page {kind}, host string, paths array<string>"), "html-paths")
    # Each page votes for its best path only; sums by host are combined before the shuffle.
    votes = own.filter("size(paths) > 0").groupBy("host", F.element_at("paths", 1).alias("path")).agg(F.count("*").alias("votes"))
    votes = materialize(votes, "html-votes")
    if votes.count() <= max_broadcast_rows:
        shared = pages.sparkSession.sparkContext.broadcast({(r[0], r[1]): r[2] for r in votes.toLocalIterator()})

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = []
                for page, host in zip(batch.column("html").to_pylist(), batch.column("host").to_pylist()):
                    named = [p for p, _ in candidates(page)] if page else []
                    best = max(named, key=lambda p: shared.value.get((host, p), 0)) if named else None
                    texts.append(extract(page, best) if page else "")
                yield _answer(batch, texts)

        out = rows.mapInArrow(read, f"page {kind}, url string, text string, n_chars long")
    else:
        # Pages are stored under a key of their own, as ids may repeat or be null.
        keyed = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "html-rows")
        listed = keyed.select(F.col("row").alias("page"), "host", "html").mapInArrow(_scored, "page long, host string, paths array<string>")
        listed = listed.select(F.col("page").alias("own"), "host", F.posexplode("paths").alias("rank", "path"))
        chosen = listed.join(votes, ["host", "path"], "left").groupBy("own").agg(F.max_by("path", F.struct(F.coalesce("votes", F.lit(0)), -F.col("rank"))).alias("path"))
        chosen = materialize(chosen, "html-chosen")

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                both = zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())
                yield _answer(batch, [extract(page, path) if page else "" for page, path in both])

        out = keyed.join(chosen, F.col("row") == F.col("own"), "left").select("page", "url", "html", "path").mapInArrow(read, f"page {kind}, url string, text string, n_chars long")
    return out.withColumnsRenamed({"page": id_col, "url": url_col} if url_col != "url" else {"page": id_col})


def _answer(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch.column("page"), batch.column("url"), pa.array(texts, pa.string()), pa.array(np.array([len(t) for t in texts], np.int64))], names=["page", "url", "text", "n_chars"])


def op5_html_extract(spark, sf_dir: str) -> DataFrame:
    """The main text of all pages. Null, empty and textless pages give the empty text; rows that repeat an id or have
    none are read one by one; a null URL's pages vote as one host."""
    return extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))
