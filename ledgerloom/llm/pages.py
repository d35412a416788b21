"""Main text of web pages by minimum-cut labelling of their text blocks.

A page is cut into blocks at block-level tags.  A classifier gives each block the
chance of being content: fixed weights for what its tags, classes and ids say, plus
log-odds of its length, links, punctuation and tag that are counted over all pages
(blocks inside article-like and menu-like elements serve as their labels).  The
chances become the capacities of a block's arcs to source and sink; edges between
neighbouring blocks, stronger the closer they are in the tree, smooth the labels.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from math import exp, log
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import arrow, slices, table
from .mincut import min_cut

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is never seen by a reader of the article.
SILENT_TAGS = frozenset("button canvas datalist head iframe noscript object option select svg template textarea title".split())
RAW_TAGS = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")
#: A start tag of the key ends an open element of these kinds.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "body": ("head",),
}

CONTENT_NAMES = re.compile(r"\b(article|articlebody|content|entry|main|post|postbody|story|body[-_]?text)\b", re.I)
BOILERPLATE_NAMES = re.compile(
    r"(?<![a-z])(ad|ads|advert\w*|adslot|banner|breadcrumbs?|byline|categor\w+|comments?|commentlist|consent|cookies?|copyright|disqus|disclaimer|dropdown|"
    r"foot|footer|gdpr|head|header|legal|links?|login|masthead|menu|meta|modal|nav\w*|newsletter|notices?|overlay|pager|paging|pagination|paywall|"
    r"popular|popup|privacy|promo\w*|recommend\w*|related|replies|reply|respond|search|share|sharing|side|sidebar|sidenav|signup|site-?info|skip|"
    r"social|sponsor\w*|subscribe|tags?|teaser|toolbar|topbar|trending|widgets?)(?![a-z])",
    re.I,
)
#: Names that can only be those of a part beside the article, whatever is around: comments, adverts, sidebars, notices, navigation, sharing.
CLEAR_NAMES = re.compile(
    r"((post|entry|article|site|page|user|reader|the)-)?(comments?|replies|respond)(-?(area|list|section|box|form|thread|wrap\w*|container|block|body|content|text|item|count))*|"
    r"comment-?list|disqus\w*(-\w+)*|ads?|ad-?(slot|box|banner|unit|container|wrap\w*|block|label|space|sense)|advert\w*(-\w+)*|sponsor(ed)?(-(content|links?|posts?|box))?|"
    r"promo(tion|ted)?s?(-(box|block|banner))?|((left|right|main|page|site)-)?side-?(bar|nav|menu)s?(-\w+)*|((cookies?|privacy|consent|gdpr|site|legal)-)?notices?(-\w+)?|"
    r"(cookies?|consent|gdpr)(-?(bar|banner|box|popup|consent|message|policy|overlay|wall))?|newsletters?(-\w+)*|subscribe(-\w+)*|sign-?up(-\w+)*|"
    r"((site|main|top|page|post|primary|secondary)-)?nav(bar|igation)?(-(bar|menu|links?|list|wrap\w*))?|breadcrumbs?|menu|pagination|pager|paging|"
    r"((social|post)-)?(share|sharing)(-?(bar|box|buttons?|links?|icons?|tools?|this|widget))?|social(-?(bar|box|buttons?|links?|icons?|media|share|sharing))?|"
    r"related-?(posts?|articles?|stories|links|content|items)|recommend(ed|ations?)(-(posts?|articles?|stories|for-you))?|popup|modal|paywall",
    re.I,
)
#: Words that make a content name that of a part beside the content ("post-footer"), and names that tell a topic or a layout.
PART_NAMES = re.compile(r"(?<![a-z])(comments?|commentlist|related|side|sidebar|sidenav|foot|footer|nav\w*|menu|promo\w*|share|sharing|sponsor\w*|ads?)(?![a-z])", re.I)
TOPICS = re.compile(r"(tag|category|cat|topic|author|type|status|format|has|no|with|without)-", re.I)
HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?(?:false|until))|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: What an element around a block says, as log-odds of content; the innermost saying of each kind holds.
BOILERPLATE_TAGS = {"nav": -8.0, "footer": -8.0, "aside": -8.0, "form": -8.0, "menu": -8.0, "dialog": -8.0, "fieldset": -8.0, "header": -6.0}
CONTENT_TAGS = {"article": 4.0, "main": 3.0}
NAMED_BOILERPLATE, NAMED_CONTENT = -8.0, 2.5
#: What a boilerplate name says inside a content element, whatever is around: text odds and neighbours can outweigh it.
NAMED_INSIDE = -1.5
#: Names of these are about the page or its topic ("right-sidebar", "tag-president"); only content names count there.
WHOLE_TAGS = frozenset(("html", "body", "article", "main"))

NEIGHBOUR, SAME_PARENT, COUSIN = 0.3, 0.9, 0.5
LIMIT = 3.0

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</?([a-zA-Z][^\s/>]*)((?:[^<>\"']+|\"(?:[^\"<]|<(?![a-zA-Z/!?]))*+\"|'(?:[^'<]|<(?![a-zA-Z/!?]))*+')*+)>|</?([a-zA-Z][^\s/>]*)([^>]*)>|[^<]+|<",
    re.S,
)
_TEXT = re.compile("[^<]+|<")
_NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in RAW_TAGS}


@dataclass
class Block:
    text: str
    tag: str
    links: int
    parent: int
    grand: int
    hint: float
    labelled: int  # 1 inside an article-like, 0 inside a menu-like element, -1 neither


class Element(NamedTuple):
    """An open element: what it says itself, and what it and all around it say together."""

    tag: str
    number: int
    says: float
    kind: int
    silent: bool
    link: bool
    worst: float
    unsure: bool
    total: float
    inside: float  # of those that say something for the counts
    known: int  # the innermost kind that is sure or unsure
    block: int  # place of the innermost block element


@lru_cache(4096)
def _says(tag: str, attributes: str, inside: bool) -> tuple[float, int]:
    """Log-odds that an element adds (0: says nothing) and, for the counts, its kind (2: unsure)."""
    if tag in BOILERPLATE_TAGS and not (tag == "header" and inside):
        return BOILERPLATE_TAGS[tag], 0
    if attributes:
        names = " ".join(x for m in _NAMES.finditer(attributes) for x in m.groups() if x)
        if names:
            if tag not in WHOLE_TAGS and any(CLEAR_NAMES.fullmatch(x.replace("_", "-")) for x in names.split()):
                return NAMED_BOILERPLATE, 0
            content = CONTENT_NAMES.search(names)
            if tag not in WHOLE_TAGS and not content and BOILERPLATE_NAMES.search(names.replace("_", "-")):
                return (NAMED_INSIDE, 2) if inside else (NAMED_BOILERPLATE, 0)
            if tag not in WHOLE_TAGS and content:
                against = [x for x in names.replace("_", "-").split() if not TOPICS.match(x) and PART_NAMES.search(x)]
                if against:
                    part = any(CONTENT_NAMES.search(x) for x in against)  # "post-footer", as opposed to "post right-sidebar"
                    return (NAMED_BOILERPLATE, 0) if part and not inside else (NAMED_INSIDE, 2)
            if content:
                return max(NAMED_CONTENT, CONTENT_TAGS.get(tag, 0)), -1 if tag in ("html", "body") else 1
    return (CONTENT_TAGS[tag], 1) if tag in CONTENT_TAGS else (0.0, -1)


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page, in order; markup need not be well formed."""
    out: list[Block] = []
    # What holds for an open element and all around it is carried along, so that deep nesting costs no more.
    stack = [Element("", 0, 0.0, -1, False, False, 0.0, False, 0.0, 0.0, -1, 0)]
    opened: Counter[str] = Counter()
    pieces: list[str] = []
    made, linked = 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(entities.unescape("".join(pieces)).split())
            if text:
                top = stack[-1]
                holder = stack[top.block]
                above = stack[top.block - 1].block if top.block else 0
                hint = top.worst if top.worst <= -6 else NAMED_INSIDE if top.unsure else min(holder.total, 5.0)
                kind = 0 if top.worst <= -6 else -1 if top.unsure else top.known
                out.append(Block(text, holder.tag, min(linked, len(text)), stack[above].number, stack[max(above - 1, 0)].number, hint, kind))
        pieces.clear()
        linked = 0

    def close(down_to: int) -> None:
        for e in stack[down_to:]:
            opened[e.tag] -= 1
        del stack[down_to:]

    at, n, last = 0, len(page), page.rfind(">")
    while at < n:
        # Behind the last ">" there are no tags, only text and comments that are never closed.
        m = _TOKEN.match(page, at) if at <= last or page.startswith(("<!--", "<![CDATA["), at) else _TEXT.match(page, at)
        at = m.end()
        tag = (m[1] or m[3]) if m.re is _TOKEN else None
        if not tag:
            piece = m[0]
            if piece[:2] in ("<!", "<?") and len(piece) > 2:
                continue
            top = stack[-1]
            if not top.silent:
                pieces.append(piece)
                if top.link:
                    linked += len(piece)
            continue
        tag, attributes = tag.lower(), m[2] if m[1] else m[4]
        if m[0][1] == "/":
            if tag == "p" and not opened["p"]:
                flush()
                continue
            if not opened[tag]:
                continue
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    if tag in BLOCK_TAGS or any(e.tag in BLOCK_TAGS for e in stack[k:]):
                        flush()
                    close(k)
                    break
                if stack[k].tag in BLOCK_TAGS and tag not in BLOCK_TAGS:
                    break  # an inline end tag doesn't close the block around it
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p" and tag not in ("option",):
                    close(k)
                    break
                if stack[k].tag in BLOCK_TAGS:
                    break
            if tag in CLOSES and any(opened[t] for t in CLOSES[tag]):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in CLOSES[tag]:
                        close(k)
                        break
                    if stack[k].tag in ("ul", "ol", "dl", "table", "menu") and stack[k].tag != tag:
                        break
        if tag in VOID_TAGS or attributes.endswith("/") and tag not in BLOCK_TAGS:
            continue
        if tag in RAW_TAGS:
            end = _END[tag].search(page, at)
            at = end.end() if end else n
            continue
        top = stack[-1]
        says, kind = _says(tag, attributes, top.inside > 0)
        made += 1
        silent = top.silent or tag in SILENT_TAGS or bool(attributes and HIDDEN.search(attributes))
        known = kind if kind >= 0 else top.known
        block = len(stack) if tag in BLOCK_TAGS else top.block
        inside = top.inside + (says if kind >= 0 else 0.0)
        stack.append(
            Element(tag, made, says, kind, silent, top.link or tag == "a", min(top.worst, says), top.unsure or kind == 2, top.total + says, inside, known, block)
        )
        opened[tag] += 1
    flush()
    return out


def traits(b: Block) -> tuple[str, ...]:
    """What the classifier sees of a block's text: a few small classes, bounded for any page."""
    size = len(b.text)
    share = b.links / size
    stops = sum(b.text.count(c) for c in ".!?,;:")
    return (
        f"length {min(size.bit_length(), 12)}",
        f"links {0 if not share else 1 if share < 0.3 else 2 if share < 0.8 else 3}",
        f"stops {min(stops, 3)}",
        f"tag {b.tag if b.tag in ('p', 'li', 'div', 'td', 'h1', 'h2', 'h3', 'pre', 'blockquote', 'section', 'article') else 'other'}",
    )


def learn(pages: DataFrame) -> dict[str, float]:
    """Log-odds of content per trait, from the blocks of all pages (``id, html``) that lie in telling elements."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = Counter(), Counter()
        for b in slices(batches):
            for page in b.column(1).to_pylist():
                for block in blocks_of(page or ""):
                    if block.labelled >= 0:
                        seen[block.labelled].update(traits(block))
        names = sorted(seen[0].keys() | seen[1].keys())
        if names:
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([seen[1][t] for t in names]), pa.array([seen[0][t] for t in names])], names=["trait", "yes", "no"])

    rows = arrow(pages, step, "trait string, yes bigint, no bigint").groupBy("trait").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).collect()
    total: Counter = Counter()
    for r in rows:
        kind = r["trait"].split()[0]
        total[kind, 1] += r["yes"]
        total[kind, 0] += r["no"]
    return {
        r["trait"]: log((r["yes"] + 1) / (total[r["trait"].split()[0], 1] + 10)) - log((r["no"] + 1) / (total[r["trait"].split()[0], 0] + 10))
        for r in rows
    }


def main_text(page: str, weights: dict[str, float]) -> str:
    """The blocks labelled content, joined by an empty line."""
    blocks = blocks_of(page)
    keep, drop = [], []
    for b in blocks:
        learned = sum(weights.get(t, 0.0) for t in traits(b))
        odds = b.hint + max(-LIMIT, min(LIMIT, learned))
        chance = 1 / (1 + exp(-max(-30.0, min(30.0, odds))))
        keep.append(-log(chance))
        drop.append(-log(max(1 - chance, 1e-13)))
    edges = []
    last: dict[int, int] = {}
    for i, b in enumerate(blocks):
        if i:
            a = blocks[i - 1]
            edges.append((i - 1, i, SAME_PARENT if a.parent == b.parent else COUSIN if a.grand == b.grand else NEIGHBOUR))
        if b.parent in last and last[b.parent] < i - 1:
            edges.append((last[b.parent], i, COUSIN))
        last[b.parent] = i
    return "\n\n".join(b.text for b, kept in zip(blocks, min_cut(keep, drop, edges)) if kept)


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``pages`` with a column ``text``, and one ``n_chars`` of its code points (columns of these names are replaced).

    Null and empty pages, and pages without content, give empty text.  Rows are
    treated one by one, so repeated pages and ids give repeated results.
    """
    weights = pages.sparkSession.sparkContext.broadcast(learn(pages.select(F.lit(0).alias("id"), F.col(html_col).alias("html"))))
    kept = pages.drop(*[c for c in pages.columns if c.lower() in ("text", "n_chars")])
    schema = StructType([*kept.schema.fields, StructField("text", StringType())])
    at = kept.columns.index(html_col)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, column=at):
            found = [main_text(page or "", weights.value) for page in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.string())], names=[*b.schema.names, "text"])

    return kept.mapInArrow(step, schema).withColumn("n_chars", F.length("text").cast("bigint"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select("page_id", "url", "text", "n_chars")
