"""Main-text extraction with consensus host paths (operator 7).

1. *Score.* Each page is read into blocks of text under a chain of structural
   containers.  A container scores its own paragraphs' text outside links plus
   a share of its children's scores; article-like tags and containers that hold
   the main heading weigh more, those whose names only hint at boilerplate
   less, and boilerplate nothing.
2. *Vote.* A container's path is its chain of tag.class steps with digits
   generalised.  Pages vote for their best paths, and the votes are summed per
   host in Spark, pre-aggregated per batch, so a hot host costs no more than
   its number of paths.
3. *Re-extract.* Each page takes the first of its host's leading paths that it
   has, and keeps the blocks below it that lie in no boilerplate container.

A page whose host's paths it lacks uses its own best container.

Boilerplate is what its tag or role says (nav, footer, aside, form, ...), and
what a class or id says with nothing else in the word: every part of it is a
boilerplate word or a word of layout ("comment-list", "sidebar-left").  A name
with any other part ("related-work", "menu-prices", "side-by-side") lowers the
container's score by HINTED, and its text stays if the container wins or lies
in the winner, unless most of it is links.

Text: character references are decoded, white space inside a block becomes one
space, blocks are trimmed and joined by one newline in page order.

Cases: null or empty html, and pages without text, give an empty text; null
urls share the empty host; unclosed, crossed or truncated markup is read as
far as it goes; very long pages are read whole.  Repeated rows are pages of
their own.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.scratch import materialise, text_batches

#: leading paths kept per host
PATHS = 8
#: hosts whose paths may be broadcast (about 500 bytes each); beyond, a shuffle join
BROADCAST_HOSTS = 100_000
CHILD_SHARE = 0.6
#: weight of article-like tags, and of a container that holds the main heading itself
GOOD, HEADED = 2.0, 1.8
#: characters beyond which a path's head becomes a digest
PATH_CHARS = 2_000
#: weight of a container with a boilerplate word among others in its name
HINTED = 0.5

# elements that hold other blocks and may be a container
STRUCTURE = frozenset("body article main section div nav header footer aside form ul ol dl table tbody thead tr td th figure details dialog menu fieldset center".split())
# elements that begin and end a block of text
BLOCK = STRUCTURE | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption address hr caption summary legend title option label".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# elements whose content is no text
RAW = "script|style|iframe|textarea|title|noscript|xmp"
# the same, but an unclosed one does not swallow the rest of the page: end tags are looked up once per page
CLOSED = "template|svg|math|object|canvas|select|button|audio|video|map|datalist"
SKIP_TAGS = frozenset("nav footer aside form menu dialog fieldset".split())
GOOD_TAGS = frozenset(("article", "main"))
SKIP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login comment comments commentlist disqus reply replies respond share sharing social related recommended sidebar side "
    "widget widgets breadcrumb breadcrumbs menu nav navbar navigation footer masthead pagination pager toolbar skip hidden".split()
)
# words that say where a thing is or how it is drawn, not what it is
LAYOUT_WORDS = frozenset(
    "left right top bottom main site page global primary secondary upper lower inner outer box block list item items wrap wrapper wrapping container content area section region "
    "panel row col column columns bar strip button buttons btn icons icon link links post posts article articles story stories news thread form group unit slot text title header "
    "head body small large mobile desktop sticky fixed js the a an to us policy message msg tags media follow and".split()
)
PARTS = re.compile(r"[^\W_]+")
HEADERS = frozenset(("site", "page", "global", "top", "main"))


def named(names: str) -> int:
    """2 for a class or id that names boilerplate, 1 for a hint of it among other words, 0 for none."""
    found = 0
    for name in names.lower().split():
        parts = [p.rstrip("0123456789") for p in PARTS.findall(name)]
        parts = [p for p in parts if p]
        bad = any(p in SKIP_WORDS for p in parts) or ("header" in parts and len(parts) == 2 and not HEADERS.isdisjoint(parts)) or (len(parts) == 1 and parts[0].endswith("header") and parts[0][:-6] in HEADERS)
        if bad and all(p in SKIP_WORDS or p in LAYOUT_WORDS or p.endswith("header") for p in parts):
            return 2
        found = max(found, int(bad))
    return found


SKIP_ROLE = re.compile(r"\brole\s*=\s*[\"']?(?:navigation|banner|contentinfo|complementary|search|dialog|alert|menu)", re.I)
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<closed>{CLOSED})\b[^>]*>|"
    r"<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/a-zA-Z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I,
)
CLOSERS = re.compile(rf"</(?P<name>{CLOSED})\s*>", re.I)
CLASS = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
IDENT = re.compile(r"(?<![\w-])id\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
DIGITS = re.compile(r"\d+")


class Node:
    __slots__ = ("tag", "path", "parent", "skip", "hinted", "own", "link", "order", "headed")

    def __init__(self, tag: str, path: str, parent: Node | None, skip: bool, order: int, hinted: bool = False):
        self.tag, self.path, self.parent, self.skip, self.order, self.hinted = tag, path, parent, skip, order, hinted
        self.own, self.link, self.headed = 0, 0, False


def _name(rx: re.Pattern, attrs: str) -> str:
    m = rx.search(attrs)
    return next((g for g in m.groups() if g is not None), "") if m else ""


def _below(path: str, step: str) -> str:
    """A path's child; the head of a very long path is folded into a digest, so that deep pages stay linear."""
    if len(path) > PATH_CHARS:
        path = hashlib.md5(path.encode()).hexdigest()
    return f"{path}>{step}"


def _tokens(page: str) -> Iterator[re.Match]:
    """Tokens in page order; what lies in a closed element is passed over."""
    ends: dict[str, list[int]] | None = None
    at = 0
    while (m := TOKEN.match(page, at)) is not None:
        at = m.end()
        closed = m["closed"]
        if closed is None:
            yield m
            continue
        if ends is None:
            ends = {}
            for c in CLOSERS.finditer(page):
                ends.setdefault(c["name"].lower(), []).append(c.end())
        mine = ends.get(closed.lower(), [])
        k = bisect_right(mine, at)
        if k < len(mine):
            at = mine[k]


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """Containers in page order, and (container, text) blocks in page order."""
    root = Node("", "", None, False, 0)
    nodes, blocks, stack = [root], [], [root]
    opened: Counter[str] = Counter()
    held: list[str] = []
    link = 0
    link_chars = 0
    mute = False  # inside a paragraph whose own name marks it as boilerplate
    heading = False

    def flush() -> None:
        nonlocal link_chars
        if held:
            text = " ".join(html_lib.unescape("".join(held)).split())
            held.clear()
            if text and not mute:
                node = stack[-1]
                node.own += len(text)
                node.headed = node.headed or heading
                node.link += min(link_chars, len(text))
                blocks.append((node, text))
        link_chars = 0

    for m in _tokens(page):
        text = m["text"]
        if text is not None:
            held.append(text)
            if link:
                link_chars += len(text)
            continue
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        closing = m["end"] == "/"
        if tag == "a":
            link = 0 if closing else 1
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag not in BLOCK:
            continue
        flush()
        link = 0
        mute = False
        heading = tag == "h1" and not closing
        if tag not in STRUCTURE:
            attrs = m["attrs"]
            mute = not closing and bool(attrs) and named(_name(CLASS, attrs) + " " + _name(IDENT, attrs)) == 2
            continue
        if closing:
            while opened[tag]:
                last = stack.pop()
                opened[last.tag] -= 1
                if last.tag == tag:
                    break
            continue
        attrs = m["attrs"]
        top = stack[-1]
        if tag == "body" and top.tag == "body":
            continue
        names = (_name(CLASS, attrs) + " " + _name(IDENT, attrs)).strip() if attrs else ""
        skip = tag in SKIP_TAGS or (tag == "header" and not any(opened[t] for t in GOOD_TAGS))
        hint = 0
        if not skip and attrs and tag not in ("body", "article", "main"):
            hint = named(names) if names else 0
            skip = hint == 2 or bool(SKIP_ROLE.search(attrs))
        step = tag
        if attrs and tag != "body":  # a body's classes often name the single page
            classes = sorted(_name(CLASS, attrs).lower().split())
            if classes:
                step += "." + ".".join(DIGITS.sub("#", c) for c in classes)
        node = Node(tag, _below(top.path, step), top, skip or top.skip, len(nodes), hint == 1)
        nodes.append(node)
        if not attrs.endswith("/") or tag == "div":
            stack.append(node)
            opened[tag] += 1
    flush()
    # a hint and mostly links: boilerplate after all
    text, links = [n.own for n in nodes], [n.link for n in nodes]
    for n in reversed(nodes):
        if n.parent is not None:
            text[n.parent.order] += text[n.order]
            links[n.parent.order] += links[n.order]
    for n in nodes:
        n.skip = n.skip or (n.parent is not None and n.parent.skip) or (n.hinted and 2 * links[n.order] > text[n.order])
    return nodes, blocks


def scores(nodes: list[Node]) -> dict[str, float]:
    """Score by path, over the page's containers that are no boilerplate."""
    total = [0.0] * len(nodes)
    for n in reversed(nodes):
        if n.skip:
            continue
        total[n.order] += n.own - n.link
        if n.parent is not None:
            total[n.parent.order] += CHILD_SHARE * total[n.order]
    out: dict[str, float] = {}
    for n in nodes:
        if not n.skip and total[n.order] > 0:
            weight = (HINTED if n.hinted else 1.0) * (GOOD if n.tag in GOOD_TAGS else 1.0) * (HEADED if n.headed and n.tag != "body" else 1.0)
            out[n.path] = out.get(n.path, 0.0) + total[n.order] * weight
    return out


def _ranked(found: dict[str, float]) -> list[str]:
    return sorted(found, key=lambda p: (-found[p], p))


def extract(page: str | None, paths: list[str]) -> str:
    """Main text of a page, by the first of the paths that it has."""
    if not page:
        return ""
    nodes, blocks = parse(page)
    if not blocks:
        return ""
    there = {n.path for n in nodes if not n.skip}
    own = None
    for path in [p for p in paths if p in there] + [None]:
        if path is None:
            own = _ranked(scores(nodes))
            if not own:
                return ""
            path = own[0]
        chosen = {n.order for n in nodes if n.path == path and not n.skip}
        if not chosen:
            continue
        below = [False] * len(nodes)
        for n in nodes:
            below[n.order] = n.order in chosen or (n.parent is not None and below[n.parent.order])
        kept = [t for n, t in blocks if below[n.order] and not n.skip]
        if kept:
            return "\n".join(kept)
    return ""


def _vote(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        votes: dict[tuple[str, str], list[float]] = {}
        for host, page in zip(pdf["host"], pdf["html"], strict=True):
            if not isinstance(page, str) or not page:
                continue
            found = scores(parse(page)[0])
            whole = sum(found.values())
            for p, score in found.items():
                v = votes.setdefault((host, p), [0.0, 0])
                v[0] += score / whole
                v[1] += 1
        if votes:
            yield pd.DataFrame({"host": [h for h, _ in votes], "path": [p for _, p in votes], "vote": [v[0] for v in votes.values()], "pages": [v[1] for v in votes.values()]})


def host_paths(pages: DataFrame, keep: int = PATHS) -> DataFrame:
    """(host, paths): each host's leading container paths, most votes first."""
    votes = _hosted(pages).select("host", "html").mapInPandas(_vote, "host string, path string, vote double, pages long")
    # votes are rounded so that the order of summing cannot turn a tie
    votes = votes.groupBy("host", "path").agg(F.round(F.sum("vote"), 6).alias("vote"), F.sum("pages").alias("pages"))
    rank = F.row_number().over(W.partitionBy("host").orderBy(F.desc("vote"), F.desc("pages"), "path"))
    best = votes.withColumn("rank", rank).where(F.col("rank") <= keep)
    return best.groupBy("host").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "path"))), lambda x: x["path"]).alias("paths"))


def _hosted(pages: DataFrame) -> DataFrame:
    url = F.col("url").cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host.alias("host"), F.col("html").cast("string").alias("html"))


def _extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        text = [extract(h if isinstance(h, str) else "", list(p) if p is not None else []) for h, p in zip(pdf["html"], pdf["paths"], strict=True)]
        yield pdf[["page_id", "url"]].assign(text=text, n_chars=[len(t) for t in text])


def extract_main_text(pages: DataFrame, broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    text_batches(pages.sparkSession)
    best = materialise(host_paths(pages), "paths")
    if best.count() <= broadcast_hosts:
        best = F.broadcast(best)
    joined = _hosted(pages).join(best, "host", "left").select("page_id", "url", "html", "paths")
    return joined.mapInPandas(_extract, "page_id long, url string, text string, n_chars long")
