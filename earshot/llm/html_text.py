"""Main text of web pages with removal of site templates.

Each page is parsed once into blocks of text and hashed element subtrees (the hash of an
element covers its tag and all below it).  Subtrees are counted by host over different pages;
one that recurs on many of them is part of the site's template and is deleted.  Menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles and reader comments are left out by
element and class name as well, since they may differ from page to page.

The content of ``<article>`` (or ``<main>``) is never taken for a template, however often a
paragraph recurs: only what stands outside of it may be deleted, and pages without such an
element depend on the template alone.

At scale: one row per (host, page, subtree) is made distinct and counted with a map-side
combine; a busy host spreads over its subtrees.  The decisions come back by a join on host
and page, of which the optimiser can split a skewed side; copies of a page share one key.

Null html is empty text.  A null url counts as the empty host.  Repeated rows give repeated
results.  Further columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A subtree on so many different pages of a host belongs to its template.
MIN_PAGES = 10
#: ... if that is also this share of the host's different pages.
MIN_SHARE = 0.02

# Elements by their part in a page.
_BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_RAW = frozenset("script style textarea title noscript template iframe object svg xmp".split())
_NOISE = frozenset(
    "nav header footer aside form menu dialog button select label fieldset head".split()
)
# Whole names only: a common word as a part of a longer name says nothing.
_NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside "
    "widget cookie cookies consent notice notices alert popup modal newsletter subscribe "
    "comment comments disqus replies reply-list social share sharing related pagination pager "
    "contentinfo complementary search".split()
)
# Known longer names of the same parts, with - for _ as well.
_NOISE_COMPOUNDS = re.compile(
    r"(?:site|page|main|top|bottom|global|left|right|primary|secondary|mobile)-"
    r"(?:nav|navbar|navigation|menu|header|footer|sidebar|banner|search)(?:-(?:menu|bar|wrapper|container|inner))?"
    r"|(?:nav|navbar|navigation|menu|footer|sidebar|breadcrumbs?|header)-"
    r"(?:menu|bar|list|links|nav|wrapper|container|inner|widget|area)"
    r"|(?:ad|ads|advert|banner|sponsor|sponsored|promo)-"
    r"(?:slot|box|unit|banner|container|wrapper|block|label|links?|content|top|bottom|sidebar)"
    r"|(?:nav|navbar|menu)-(?:main|primary|secondary|top|bottom|mobile)"
    r"|(?:banner|google|sidebar|top|bottom)-ads?|ads?-[0-9x-]+"
    r"|cookies?-(?:notice|banner|consent|bar|popup|alert|message|policy-banner)"
    r"|consent-(?:banner|popup|bar|modal)|gdpr-(?:banner|notice|consent)"
    r"|newsletter-(?:signup|sign-up|form|box|popup|subscribe)|subscribe-(?:box|form|popup)"
    r"|popup-(?:overlay|box|container)"
    r"|comments?-(?:list|section|area|form|thread|container|wrapper)|disqus-thread"
    r"|(?:social|share|sharing)-(?:links|buttons|bar|icons)|social-media-(?:links|buttons|icons)"
    r"|related-(?:posts|articles|links|stories|content|news|products|items)"
    r"|search-(?:form|box|bar|widget)|widget-(?:area|container|box)|post-(?:navigation|pagination)|pagination-(?:links|list|nav)"
)
_KEPT = frozenset("html body article main".split())
_ENDS_P = _BLOCKS - {"option", "optgroup"}
_SELF_NESTING = {"li": "li", "dt": "dd", "dd": "dt", "tr": "tr", "td": "th", "th": "td", "option": "option"}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*[^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.DOTALL,
)
# One attribute after the other, so that values and names like data-id are never taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?|["'][^\s>]*""")
#: The ids of these mark a place in the text, and do not say what the element is for.
_ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 p section".split())
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


class _Element:
    __slots__ = ("tag", "noise", "main", "parts", "hash", "parent")

    def __init__(self, tag: str, noise: bool, main: bool, parent: _Element | None) -> None:
        self.tag, self.noise, self.main, self.parent = tag, noise, main, parent
        self.parts: list[bytes] = []
        self.hash = 0

    def close(self) -> None:
        if self.main:
            return
        digest = blake2b(b"\0".join([self.tag.encode(), *self.parts]), digest_size=8).digest()
        self.hash = int.from_bytes(digest, "big", signed=True)
        if self.parent is not None:
            self.parent.parts.append(digest)


def _decode(text: str) -> str:
    """``text`` with its character references decoded; the commonest one by itself."""
    if "&" not in text:
        return text
    return "&".join(entities.unescape(part) for part in text.split("&amp;"))


def _is_noise(tag: str, attributes: str) -> bool:
    if tag in _KEPT:
        return False
    if tag in _NOISE:
        return True
    if "=" not in attributes:
        return False
    seen = set()
    for found in _ATTRIBUTE.finditer(attributes):
        key = (found[1] or "").lower()
        if key not in ("class", "id", "role") or key in seen:
            continue
        seen.add(key)  # the first of equal attributes holds
        if key == "id" and tag in _ANCHORED:
            continue
        for name in _decode(found[2] or found[3] or found[4] or "").lower().split():
            if name in _NOISE_NAMES or _NOISE_COMPOUNDS.fullmatch(name.replace("_", "-")):
                return True
    return False


def parse_page(source: str) -> tuple[list[tuple[str, list[int]]], list[int]]:
    """Blocks (text, hashes of the elements around it) of the main part; all deletable subtrees.

    Blocks inside an article have no hashes: nothing around them may be deleted.
    """
    root = _Element("", False, False, None)
    stack, closed = [root], []
    blocks: list[tuple[str, _Element]] = []
    pending: list[str] = []

    def flush() -> None:
        if pending:
            text = " ".join(_decode("".join(pending)).split())
            pending.clear()
            top = stack[-1]
            if text:
                if not top.main:
                    top.parts.append(text.encode("utf-8", "surrogatepass"))
                if not top.noise:
                    blocks.append((text, top))

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            element = stack.pop()
            element.close()
            closed.append(element)

    def in_scope(tags: set[str]) -> int | None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                return depth
            if stack[depth].tag in ("ul", "ol", "dl", "table", "select", "article", "div"):
                return None
        return None

    at, end = 0, len(source)
    while at < end:
        found = _MARKUP.search(source, at)
        if found is None:
            pending.append(source[at:])
            break
        if found.start() > at:
            pending.append(source[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:  # an end tag
            if tag == "br" or tag not in _BLOCKS and all(e.tag != tag for e in stack):
                continue
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag), None)
            if tag in _BLOCKS:
                flush()
            if depth is not None:
                if any(e.tag in _BLOCKS for e in stack[depth + 1 :]) and tag not in _BLOCKS:
                    continue  # an inline element that blocks have grown out of
                pop_to(depth)
            continue
        if tag in _VOID:
            if tag == "br":
                pending.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in _RAW:
            if not found[3].endswith("/"):
                stop = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.IGNORECASE).search(source, at)
                at = stop.end() if stop else end
            continue
        if tag in _BLOCKS:
            flush()
            if tag in _ENDS_P and (depth := in_scope({"p"})) is not None:
                pop_to(depth)
            if tag in _SELF_NESTING and (depth := in_scope({tag, _SELF_NESTING[tag]})) is not None:
                pop_to(depth)
            top = stack[-1]
            stack.append(
                _Element(
                    tag,
                    top.noise or _is_noise(tag, found[3]),
                    top.main or tag in ("article", "main"),
                    top,
                )
            )
        else:
            # Inline elements matter only if their names say that they are noise.
            top = stack[-1]
            if not found[3].endswith("/") and _is_noise(tag, found[3]):
                flush()
                stack.append(_Element(tag, True, top.main, top))
    flush()
    pop_to(1)

    inside = [(text, e) for text, e in blocks if e.main]
    if any(e.main for e in closed):
        kept = [(text, []) for text, _ in inside]
    else:
        kept = []
        for text, element in blocks:
            around = []
            while element is not None and element.tag not in ("", "html", "body"):
                around.append(element.hash)
                element = element.parent
            kept.append((text, around))
    # Elements that hold the article are no template either.
    holds: set[int] = set()
    for e in closed:
        if e.tag in ("article", "main"):
            while e is not None:
                holds.add(id(e))
                e = e.parent
    subtrees = {
        e.hash
        for e in closed
        if not e.main and id(e) not in holds and e.parts and e.tag not in ("html", "body")
    }
    return kept, sorted(subtrees)


def host_of(url: Column) -> Column:
    """The host of a URL in small letters; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url.cast("string"), _HOST, 1), F.lit("")))


def keyed_pages(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """(page_id, url, host, page_key, html); copies of a page have one key, a 64-bit hash."""
    source = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    return pages.select(
        F.col(f"`{page_id}`").alias("page_id"),
        F.col(f"`{url}`").cast("string").alias("url"),
        host_of(F.col(f"`{url}`")).alias("host"),
        F.xxhash64(source).alias("page_key"),
        source.alias("html"),
    )


def parse_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """(page_id, url, host, page_key, texts, around, subtrees) for each row."""
    id_type = pages.schema[page_id].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, around, subtrees = [], [], []
                for value in part.column(4):
                    blocks, hashes = parse_page(value.as_py() or "")
                    texts.append([b[0] for b in blocks])
                    around.append([b[1] for b in blocks])
                    subtrees.append(hashes)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:4],
                        pa.array(texts, pa.list_(pa.string())),
                        pa.array(around, pa.list_(pa.list_(pa.int64()))),
                        pa.array(subtrees, pa.list_(pa.int64())),
                    ],
                    names=["page_id", "url", "host", "page_key", "texts", "around", "subtrees"],
                )

    return keyed_pages(pages, page_id, url, html).mapInArrow(
        parse,
        f"page_id {id_type}, url string, host string, page_key long, texts array<string>, "
        "around array<array<bigint>>, subtrees array<bigint>",
    )


def extract_text(
    pages: DataFrame,
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(page_id, url, text, n_chars, n_template_subtrees): one row for each page."""
    parsed = parse_pages(pages, page_id, url, html)
    # Free of nulls from the start, so that both uses have the same plan and share its exchange.
    seen = (
        parsed.select("host", "page_key", F.explode("subtrees").alias("subtree"))
        .where("host IS NOT NULL AND page_key IS NOT NULL AND subtree IS NOT NULL")
        .distinct()
    )
    different = keyed_pages(pages, page_id, url, html).select("host", "page_key").distinct()
    sizes = different.groupBy("host").agg(F.count("*").alias("host_pages"))
    counted = (
        seen.groupBy("host", "subtree")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_pages)
    )
    template = (
        counted.join(sizes, "host")
        .where(F.col("n") >= min_share * F.col("host_pages"))
        .select("host", "subtree")
    )
    deleted = (
        seen.join(template, ["host", "subtree"])
        .groupBy("host", "page_key")
        .agg(F.collect_set("subtree").alias("deleted"))
    )
    none = F.array().cast("array<bigint>")
    joined = parsed.select("page_id", "url", "host", "page_key", "texts", "around").join(
        deleted, ["host", "page_key"], "left"
    )
    joined = joined.select(
        "page_id", "url", "texts", "around", F.coalesce("deleted", none).alias("deleted")
    )
    left = F.filter(
        F.zip_with(
            "texts",
            "around",
            lambda text, around: F.when(~F.arrays_overlap(around, F.col("deleted")), text),
        ),
        lambda text: text.isNotNull(),
    )
    text = joined.select(
        "page_id",
        "url",
        F.array_join(left, "\n").alias("text"),
        F.size("deleted").cast("long").alias("n_template_subtrees"),
    )
    return text.select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_template_subtrees"
    )
