"""Main text of web pages by deducing each host's template from token occurrences.

A token is an element with its path of containers. Tokens that occur equally often on every page of a host (equal
occurrence vectors, compared by sums of page hashes) form an equivalence class. Classes found on half of a host's pages
whose tokens always come in one order are valid; nested by their paths they are the template, and the text between them
fills its slots. A slot that says the same on all pages is part of the template, menus, notices and other furniture are told
by their elements and names, and the rest inside the main container is extracted, whether in articles or around them.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossweave.llm.common import filled
from glossweave.session import materialise

#: Templates that are broadcast at most (a few kB each); more hosts are joined by shuffling.
BROADCAST_HOSTS = 20_000
#: Template tokens (about 100 bytes each) that are broadcast at most; more are joined by shuffling, in salted groups.
BROADCAST_TOKENS = 200_000
SALTS = 32
#: A slot with one text on this many pages of a host belongs to the template.
CONSTANT_PAGES = 3

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|title|textarea|iframe|noscript|template|svg|noembed|noframes|xmp)\b[^>]*+>.*?(?:</\1\b[^>]*+>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?(?=[\s/>]|\Z)""", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var img wbr".split()
)
CONTAINERS = frozenset("html body div section article main td th li dd center blockquote".split())
#: Elements that never hold the article's own text.
FURNITURE = frozenset("head nav header footer aside form button select menu dialog object audio video canvas map datalist".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
_FURNITURE_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead topbar footer sidebar aside widget widgets related recommended "
    "recommendation recommendations ad ads advert adverts advertisement advertisements advertising adsense adslot adbox sponsor sponsored promo "
    "promotion banner cookie cookies consent gdpr notice notices alert newsletter subscribe subscription signup popup modal overlay share sharing "
    "social comment comments commentlist commentsection respond replies reply disqus login search searchform form pagination pager skip hidden "
    "legal disclaimer toolbar teaser teasers".split()
)
#: Words that say nothing of what a box holds, beside which a word of furniture still decides.
_LAYOUT_WORDS = frozenset(
    "box boxes list lists bar bars wrap wrapper container inner outer left right top bottom site page main global primary secondary sub mobile "
    "desktop block blocks section area zone region panel pane slot unit units group row col column columns grid module component part header head "
    "title heading label body content contents item items entry link links button buttons btn icon icons input field fields media post posts "
    "article articles reader readers user users thread threads author meta count policy sticky fixed floating inline small large wide "
    "horizontal vertical default view holder frame layer dialog toggle trigger email".split()
)
_PARTS = re.compile(r"[^\W\d_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Block:
    """A stretch of text between block boundaries."""

    __slots__ = ("text", "path", "dropped", "article", "link")

    def __init__(self, text: str, path: str, dropped: bool, article: int, link: int):
        self.text, self.path, self.dropped, self.article, self.link = text, path, dropped, article, link


@lru_cache(maxsize=100_000)
def named_furniture(names: str, inside: bool) -> bool:
    """Whether one of the class names tells furniture: each of its words does, or is one of layout beside such a word.

    ``social-links`` does, ``social-science`` does not: a word of furniture next to one of content is a subject. Such a box goes
    only by a second sign, links or repetition on the host. A header outside an article counts as furniture.
    """
    words = _FURNITURE_WORDS if inside else _FURNITURE_WORDS | {"header"}
    for name in names.split():
        if name.lower().rstrip("0123456789") in words:
            return True
        parts = [p.lower() for p in _PARTS.findall(_CAMEL.sub("-", name))]
        if any(p in words for p in parts) and all(p in words or p in _LAYOUT_WORDS or len(p) < 3 for p in parts):
            return True
    return False


def _is_furniture(name: str, attributes: dict[str, str], inside: bool) -> bool:
    if name in FURNITURE:
        return not (name == "header" and inside)
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if name in ("html", "body", "main"):
        return False
    if attributes.get("role", "").lower() in ROLES:
        return True
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".strip()
    return bool(names) and named_furniture(names, inside)


def parse_page(page: str) -> tuple[list[Block], list[str]]:
    """Blocks in page order, and the tokens (container paths) in order of opening."""
    blocks: list[Block] = []
    tokens: list[str] = []
    # name, path, dropped, article, link
    stack: list[tuple[str, str, bool, int, bool]] = [("", "", False, -1, False)]
    parts: list[str] = []
    linked, articles, last = 0, 0, 0

    def close_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                top = stack[-1]
                blocks.append(Block(text, top[1], top[2], top[3], linked))
            parts.clear()
        linked = 0

    for m in _MARKUP.finditer(page):
        if m.start() > last:
            piece = page[last : m.start()]
            parts.append(piece)
            if stack[-1][4]:
                linked += len(piece)
        last = m.end()
        closing, name, rest = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not name:
            continue
        name = name.lower()
        if name not in INLINE:
            close_block()
        elif name == "wbr":
            continue
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if name in INLINE and stack[k][0] not in INLINE:
                    break
            continue
        if name in VOID:
            continue
        if name not in INLINE:
            ends = {"p"} if name not in ("li", "dd", "dt", "tr", "td", "th", "option") else {"p", name}
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in ends:
                    del stack[k:]
                    break
                if stack[k][0] in CONTAINERS or stack[k][0] in ("ul", "ol", "table"):
                    break
        _, path, dropped, article, link = stack[-1]
        attributes = {}
        if rest and len(rest) > 1:
            for a in _ATTRIBUTE.finditer(rest):
                attributes.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
        inside = article >= 0
        dropped = dropped or _is_furniture(name, attributes, inside)
        if name in INLINE:
            stack.append((name, path, dropped, article, link or name == "a"))
            continue
        if name == "article" and not dropped and not inside:
            article, articles = articles, articles + 1
        if not (rest and rest.endswith("/")) or name in CONTAINERS or name == "p":
            sign = re.sub(r"\d+", "0", ".".join(filter(None, (name, attributes.get("class", ""), attributes.get("id", "")))))
            path = f"{path}/{sign}"
            tokens.append(path)
            stack.append((name, path, dropped, article, link))
    if last < len(page):
        parts.append(page[last:])
    close_block()
    return blocks, tokens


def extract_text(page: str, main: str | None, constant: frozenset[str]) -> str:
    """The text of the page's main container outside furniture and constant slots, one block a line.

    ``main`` and ``constant`` are those of the host's template; a page that has none of that container is read by its own.
    Everything in the container stays: all its articles, and what stands before, between and after them. Articles are a hint:
    they widen a container inside one, and if they hold half of the text of a container that is only the page's body, they
    are the container together.
    """
    blocks, _ = parse_page(page)
    roots = {b.article: _article_root(b.path) for b in blocks if b.article >= 0}
    own = [b for b in blocks if not b.dropped and not _is_template(b, roots, main, constant)]
    held: list[Block] = []
    for root in (main, main_container(_masses(own))):
        if root is not None and not held:
            root = next((r for r in roots.values() if _under(root, r)), root)
            held = [b for b in own if _under(b.path, root)]
            whole = root.rsplit("/", 1)[-1].split(".")[0] in ("", "html", "body")
    in_articles = [b for b in held if b.article >= 0]
    if held and whole and 2 * sum(len(b.text) for b in in_articles) >= sum(len(b.text) for b in held):
        held = in_articles
    return "\n".join(b.text for b in held)


def _article_root(path: str) -> str:
    """The path of the outermost article that ``path`` lies in."""
    names = path.split("/")
    return "/".join(names[: 1 + next(k for k, sign in enumerate(names) if sign.split(".")[0] == "article")])


def _is_template(block: Block, roots: dict[int, str], main: str | None, constant: frozenset[str]) -> bool:
    """Whether a block is a constant slot, or links outside articles or in a box with a word of furniture in its name.

    In an article that is the case in a box of its own, which has a class or id or is a division; a bare heading or list is the
    writer's, though it may say the same on some pages. Pages that are all alike (no varying slot) have no box there.
    """
    if block.article < 0:
        return block.path in constant or 2 * block.link > len(block.text)
    inside = block.path[len(roots[block.article]) + 1 :].split("/")
    if 2 * block.link > len(block.text) and any(p.lower() in _FURNITURE_WORDS for sign in inside for p in _PARTS.findall(_CAMEL.sub("-", sign.partition(".")[2]))):
        return True
    return main is not None and block.path in constant and any("." in sign or sign in ("div", "section") for sign in inside)


def _under(path: str, root: str) -> bool:
    return not root or path == root or path.startswith(f"{root}/")


def _masses(blocks: list[Block]) -> Counter:
    out = Counter()
    for b in blocks:
        out[b.path] += max(len(b.text) - b.link, 0)
    return out


def main_container(masses: dict[str, int]) -> str:
    """``main`` if there is one, else the deepest container that holds seven tenths of the text."""
    under = Counter()
    for path, size in masses.items():
        at = path
        while at:
            if at.rsplit("/", 1)[1].split(".")[0] in CONTAINERS:
                under[at] += size
            at = at.rsplit("/", 1)[0]
    total = sum(masses.values())
    named = [p for p in under if p.rsplit("/", 1)[1].split(".")[0] == "main"]
    large = named or [p for p, size in under.items() if 10 * size >= 7 * total]
    return max(large, key=lambda p: (p.count("/"), under[p], p)) if large and total else ""


def page_tokens(pages: DataFrame) -> DataFrame:
    """Per page and token: how often it occurs, its rank among first openings, and hash and sizes of its slot's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for host, key, page in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                blocks, tokens = parse_page(page)
                count, slots, plain = Counter(tokens), {}, Counter()
                for b in blocks:
                    slots.setdefault(b.path, []).append(b.text)
                    if not b.dropped:
                        plain[b.path] += max(len(b.text) - b.link, 0)
                for rank, path in enumerate(dict.fromkeys(tokens)):
                    text = "\n".join(slots.get(path, ()))
                    signed = xxhash.xxh64_intdigest(text) - (1 << 63) if text else None
                    rows.append((host, key, path, count[path], rank, signed, plain[path]))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            names = ["host", "page", "token", "n", "rank", "said", "plain"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return pages.mapInArrow(run, "host string, page bigint, token string, n int, rank int, said bigint, plain bigint")


def host_templates(pages: DataFrame) -> DataFrame:
    """(``host``, ``main``, ``constant``): the main container and the constant slots of each host's template.

    Occurrence vectors are sums of hashes of (page, count), so no vector is ever gathered. The order of a class is valid if
    its tokens first open in the same sequence on all its pages; sequences are compared by their hashes. A host's tokens on at
    least half of its pages are at most twice as many as a page has on average, so they fit one row.
    """
    tokens = materialise(page_tokens(pages), "tokens")
    sign = F.xxhash64("page", "n")
    seen = tokens.groupBy("host", "token").agg(
        F.count("*").alias("support"), F.sum(sign.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.sum(F.shiftrightunsigned(sign, 32)).alias("high"),
        F.min("rank").alias("first"), F.count("said").alias("speaks"),
        (F.min("said") == F.max("said")).alias("same"), F.sum("plain").alias("plain"),
    )
    size = tokens.filter("rank = 0").groupBy("host").agg(F.count("*").alias("pages"))
    common = seen.join(size, "host").filter((2 * F.col("support") >= F.col("pages")) & (F.col("support") >= 2))
    member = F.struct("token", "first", "speaks", "same", "plain")
    classes = common.groupBy("host", "support", "low", "high").agg(F.collect_list(member).alias("members"))
    classes = materialise(classes.withColumn("class", F.xxhash64("support", "low", "high")), "classes")
    ordered = classes.select("host", "class", "support", "members").join(_ordered(tokens, classes), ["host", "class"], "left")
    kept = F.struct("support", "members", F.coalesce("ordered", F.size("members") == 1).alias("ordered"))
    hosts = ordered.groupBy("host").agg(F.collect_list(kept).alias("classes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(host, *deduce_template(classes)) for host, classes in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            kinds = (pa.string(), pa.string(), pa.list_(pa.string()))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["host", "main", "constant"])

    return hosts.mapInArrow(run, "host string, main string, constant array<string>")


def _ordered(tokens: DataFrame, classes: DataFrame) -> DataFrame:
    """(``host``, ``class``, ``ordered``) of classes of several tokens: whether all pages open them in one sequence."""
    member = classes.filter(F.size("members") > 1).select("host", "class", F.explode("members.token").alias("token"))
    if member.count() <= BROADCAST_TOKENS:
        found = tokens.join(F.broadcast(member), ["host", "token"])
    else:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
        found = tokens.withColumn("salt", F.pmod("page", F.lit(SALTS))).join(member.select("*", salts), ["host", "token", "salt"])
    # pages that repeat add the same ranks again
    sequence = F.transform(F.sort_array(F.collect_set(F.struct("rank", "token"))), lambda t: t["token"])
    pages = found.groupBy("host", "page", "class").agg(F.xxhash64(sequence).alias("sequence"))
    return pages.groupBy("host", "class").agg((F.min("sequence") == F.max("sequence")).alias("ordered"))


def deduce_template(classes: list[dict]) -> tuple[str | None, list[str]]:
    """Main container and constant slots from a host's equivalence classes."""
    template: dict[str, dict] = {}
    for group in sorted(classes, key=lambda c: -c["support"]):
        members = sorted(group["members"], key=lambda t: (t["first"], t["token"]))
        if group["ordered"] and all(_parent_known(t["token"], template, members) for t in members):
            template.update({t["token"]: t for t in members})
    constant = [t["token"] for t in template.values() if t["same"] and t["speaks"] >= CONSTANT_PAGES]
    varying = {t["token"]: t["plain"] for t in template.values() if t["plain"] and t["token"] not in constant}
    return (main_container(varying) or None) if varying else None, sorted(constant)


def _parent_known(token: str, template: dict[str, dict], members: list[dict]) -> bool:
    parent = token.rsplit("/", 1)[0]
    return not parent or parent in template or any(m["token"] == parent for m in members)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def main_texts(pages: DataFrame, url: str = "url", html: str = "html", into: str = "text") -> DataFrame:
    """``pages`` with the main text of ``html`` in column ``into``; empty if there is none.

    A NULL or empty page has no text. Pages without a host, and hosts of a single page, are read without a template. Rows that
    repeat count as pages of their own. An empty table stays empty.
    """
    body = filled(F.col(html))
    known = pages.select(host_of(F.col(url)).alias("host"), F.xxhash64(F.col(url), body).alias("page"), body.alias("html"))
    templates = materialise(host_templates(known.filter("host <> ''")), "templates")
    templates = templates.select(F.col("host").alias("__host"), F.struct("main", "constant").alias("__template"))
    templates = F.broadcast(templates) if templates.count() <= BROADCAST_HOSTS else templates

    @F.arrow_udf("string")
    def extracted(page: pa.Array, main: pa.Array, constant: pa.Array) -> pa.Array:
        rows = zip(page.to_pylist(), main.to_pylist(), constant.to_pylist(), strict=True)
        return pa.array([extract_text(p, m, frozenset(c or ())) for p, m, c in rows], pa.string())

    joined = pages.join(templates, host_of(F.col(url)) == F.col("__host"), "left")
    text = extracted(body, F.col("__template.main"), F.col("__template.constant"))
    return joined.withColumn("__extracted", text).select(*[F.col(f"`{c}`") for c in pages.columns if c != into], F.col("__extracted").alias(into))
