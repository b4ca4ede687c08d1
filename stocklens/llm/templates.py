"""Main text of web pages: roles of elements first, then template subtrees that recur on a host.

Each page is parsed once. Elements whose tag, role or class names them as menu, header, footer,
sidebar, notice, advert, form, comment or script are left out. Every other element outside the
article is hashed with its whole subtree (tag, text, children); Spark counts the
hashes per host, and the subtrees that recur beside different texts of a host are deleted. What
stands inside an article (or main) element is the page's own text: a passage that
many articles of a host share is no template and stays.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocklens.llm.redirects import host_of
from stocklens.llm.shared import texts_of, written

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
LEFT_OUT = RAW | frozenset(
    "head nav footer aside form noscript template svg math object canvas audio video button"
    " select dialog menu datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp"
    " small span strike strong sub sup time tt u var wbr img".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6"
    " header hr main nav ol p pre section table ul".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog form".split())
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment"
    " comments consent cookie cookies disclaimer footer header masthead menu modal nav navbar"
    " navigation newsletter notice notification popup promo promoted promotion related share"
    " sharing sidebar signup social sponsor sponsored subscribe toolbar".split()
)
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+))")
WHOLE = ("html", "body")
MOST = 0.8  # of a page's characters: a subtree with more is the page itself
SPACE = re.compile(r"\s+")
NAME = re.compile(r"[a-z]+")


class _Element:
    __slots__ = ("tag", "hidden", "own", "digest", "number")

    def __init__(self, tag: str, hidden: bool, own: bool, number: int):
        self.tag, self.hidden, self.own, self.number = tag, hidden, own, number
        self.digest = hashlib.blake2b(tag.encode("utf-8", "surrogatepass"), digest_size=8)


def _hides(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in LEFT_OUT or (tag == "header" and not in_article):
        return True
    if not attributes.strip():
        return False
    for name, *values in ATTRIBUTE.findall(attributes):
        value, name = "".join(values).lower(), name.lower()
        if name == "role" and value in ROLES or name == "aria-hidden" and value == "true":
            return True
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            if not NAMED.isdisjoint(NAME.findall(value)):
                return True
    return bool(re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)))


def parse_page(page: str | None) -> tuple[list[tuple[str, list[int]]], list[int]]:
    """Blocks (text, hashes of the subtrees it is in) and the distinct subtree hashes of a page.

    Blocks inside an article have no hashes. html, body and what holds most of the page have none.
    """
    page = page or ""
    stack: list[_Element] = [_Element("", False, False, -1)]
    blocks: list[tuple[str, list[int]]] = []
    hashes: list[int | None] = []
    sizes: list[int] = []
    parts: list[str] = []

    def flush() -> None:
        text = SPACE.sub(" ", "".join(parts)).strip()
        if text:
            top = stack[-1]
            chain = [e.number for e in stack[1:] if not e.own and e.tag not in WHOLE]
            for number in chain:
                sizes[number] += len(text)
            blocks.append((text, [] if top.own else chain))
        parts.clear()

    def close(element: _Element) -> None:
        hashes[element.number] = int.from_bytes(element.digest.digest(), "big", signed=True)
        stack[-1].digest.update(element.digest.digest())

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1].tag not in INLINE:
                flush()
            close(stack.pop())

    def text(value: str) -> None:
        if value and not stack[-1].hidden:
            value = html.unescape(value)
            parts.append(value)
            stack[-1].digest.update(SPACE.sub(" ", value).strip().encode("utf-8", "surrogatepass"))

    at = 0
    while True:
        found = MARKUP.search(page, at)
        text(page[at : found.start()] if found else page[at:])
        if not found:
            break
        at = found.end()
        ending, tag, attributes = found.group(1, 2, 3)
        if tag is None:
            continue
        tag = tag.lower()
        if ending:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    pop_to(depth)
                    break
            continue
        if tag not in INLINE:
            if tag == "br":
                parts.append(" ")
                continue
            flush()
        if tag in VOID:
            continue
        if tag in CLOSES_P or tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = ("p",) if tag in CLOSES_P else (tag,)
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in same:
                    pop_to(depth)
                    break
                if stack[depth].tag not in INLINE:
                    break
        top = stack[-1]
        hidden = top.hidden or _hides(tag, attributes, top.own)
        own = not hidden and (top.own or tag in ("article", "main"))
        stack.append(_Element(tag, hidden, own, len(hashes)))
        hashes.append(None)
        sizes.append(0)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else len(page)
            close(stack.pop())
    flush()
    pop_to(1)
    most = MOST * sum(len(t) for t, _ in blocks)
    rows = [(t, [hashes[k] for k in chain if sizes[k] <= most]) for t, chain in blocks]
    return rows, sorted({h for _, chain in rows for h in chain})


def _content(blocks: list[tuple[str, list[int]]]) -> int:
    text = " ".join(t for t, _ in blocks).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)


def main_text(pages: DataFrame, *, min_pages: int = 5) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    A subtree outside an article is a template when it recurs on pages of a host with ``min_pages``
    different texts at least, whatever the size of the host: copies of a page count once. Pages
    without a host share the empty host. Null and
    empty html give empty text; unclosed and broken markup is read as far as it goes. White space
    inside a block becomes one space, blocks are joined by one space. Repeated rows and ids
    each keep a row; other columns are ignored. The text of a page without a subtree to look up, as
    where all of it stands inside an article, is not shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, sources in texts_of(batches, "html"):
            parsed = [parse_page(s) for s in sources]
            open_ = [bool(hashes) for _, hashes in parsed]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(
                        [None if o else " ".join(t for t, _ in b) for (b, _), o in zip(parsed, open_)],
                        pa.string(),
                    ),
                    pa.array(
                        [[{"text": t, "within": c} for t, c in b] if o else [] for (b, _), o in zip(parsed, open_)],
                        pa.list_(pa.struct([("text", pa.string()), ("within", pa.list_(pa.int64()))])),
                    ),
                    pa.array([h for _, h in parsed], pa.list_(pa.int64())),
                    pa.array([_content(b) if o else None for (b, _), o in zip(parsed, open_)], pa.int64()),
                ],
                names=["page_id", "url", "host", "text", "blocks", "subtrees", "content"],
            )

    parsed = written(
        pages.select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
        .mapInArrow(
            run,
            "page_id long, url string, host string, text string,"
            " blocks array<struct<text: string, within: array<long>>>, subtrees array<long>, content long",
        )
        .withColumn("row", F.monotonically_increasing_id())
    )
    seen = parsed.select("row", "host", "content", F.explode("subtrees").alias("subtree"))
    templates = (
        seen.select("host", "subtree", "content")
        .distinct()
        .groupBy("host", "subtree")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_pages)
        .select("host", "subtree")
    )
    hits = seen.join(templates, ["host", "subtree"]).groupBy("row").agg(
        F.collect_set("subtree").alias("drop")
    )
    settled = parsed.filter("text is not null").select("page_id", "url", "text")
    left = F.filter(
        "blocks", lambda b: ~F.arrays_overlap(b["within"], F.coalesce("drop", F.array().cast("array<long>")))
    )
    opened = (
        parsed.filter("text is null")
        .join(hits, "row", "left")
        .select("page_id", "url", F.array_join(F.transform(left, lambda b: b["text"]), " ").alias("text"))
    )
    return settled.unionByName(opened).withColumn("n_chars", F.char_length("text").cast("long"))
