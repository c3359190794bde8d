"""Main text of web pages, by templates deduced per host.

Method: equivalence classes. Tokens are block tags with their path from the root, and blocks of text with
the path of the element around them. The occurrence vector of a token counts it on every distinct page of its
host; tokens of a host with equal vectors form a class. Vectors are compared by an exclusive-or of hashes of
(page, count), so a host of any size is reduced by plain partial aggregation.

A class is a candidate if it occurs on at least `SUPPORT` pages and most pages of the host and has two tokens or more,
one of them a tag. Its tokens must follow each other in one order on all pages, and the class must nest: all of its tokens
stand in one slot, the gap after one token of a class that more pages hold. Tokens that break the order leave the
class; classes that do not nest leave the template. What is no template token is the content of the slots.

The main slot is the container, of the class of the most frequent token or with a main name on most pages, that
has most of the text that is no link and not under a boilerplate element; article and main elements go before
others. Its text is extracted without text tokens of the template. Template text that is more than
half of the main slots of a host is no template but a family of copies, and stays; so does a page's text if nothing else is left.

Slots hold data of any kind, so within them a lexicon still tells menus, adverts, reader comments and the like from the article: by
tag, role and the words of class and id; by class and id only where they are not around the main text, and
not for what a name says to be there or missing (has-sidebar). Text outside the template is never dropped for being repeated: copies are whole.

Rows: one per input row. Null or empty html, or pages without text, give an empty text. A page without
its host's main slot is read by its own best slot. Pages without a host share the template of host "". Repeated pages count once in a
template. Only `url`, `html` and the kept columns are read; others, whatever their names, change nothing. Work
grows linearly with the length and the depth of a page.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lendframe.llm.common import arrow_batches, per_text
from lendframe.llm.url_rules import host_of
from lendframe.operators.lookup import attach
from lendframe.session import LOOKUP_ROWS, materialise

# Elements by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg math xmp noembed noframes object canvas".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul title head option legend caption".split()
)
CLOSED_BY = {
    "p": BLOCK - {"td", "th", "tr"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "td": frozenset({"td", "th", "tr"}),
    "th": frozenset({"td", "th", "tr"}),
    "tr": frozenset({"tr"}),
    "option": frozenset({"option"}),
    "head": frozenset({"body"}),
}
SCOPES = frozenset("table td th ul ol dl div article section main body html form blockquote aside nav".split())
BOILERPLATE = frozenset("nav aside footer form button select dialog menu head title datalist label input".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar "
    "navigation menu menubar breadcrumb breadcrumbs sidebar sidebars widget widgets footer masthead cookie cookies "
    "consent gdpr notice notices notification notifications alert alerts popup modal overlay subscribe subscription "
    "newsletter signup login signin comment comments reply replies disqus respond share sharing social related "
    "recommended recommendations pagination pager toolbar skip copyright disclaimer hidden search searchbox".split()
)
MAIN_WORDS = frozenset("article content main post entry story body text articlebody maincontent maintext".split())
STATES = frozenset("has with without no not".split())  # "has-sidebar" says what a wrapper holds, not what it is
CONTAINERS = frozenset("article main section div td body center blockquote table tbody tr html".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^<>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])|[^A-Za-z]+")
MAJORITY = 0.5
SUPPORT = 10  # distinct pages of a host
BROADCAST_TOKENS = 500_000  # template tokens of all hosts, 24 bytes each


class Node:
    """An open element: tag, hashed path, marks of its own, and whether its text is boilerplate or a link.

    `fixed`: boilerplate by tag, role or attribute (`barred`: or below such an element); `named`: by class or id, which `blocks_of` may overrule.
    `core`: in an article or main element, with no mark below it. `titled`: in a container with a main word,
    with no mark around or below it. `at`, `end`: its place among the tokens of the page and that of the last token in it.
    """

    __slots__ = (
        "at", "barred", "boiler", "clear", "core", "depth", "end", "fixed", "key", "link", "main", "named", "parent", "sig", "tag",
        "titled",
    )

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None, at: int):
        tokens = (attributes.get("class", "") + " " + attributes.get("id", "")).split()
        split = [[w.lower() for w in _CAMEL.split(t) if w] for t in tokens]
        words = {w for t in split for w in t}
        self.sig = tag + "".join("." + w for w in sorted(words))
        self.tag, self.parent, self.at, self.end = tag, parent, at, at
        self.depth = parent.depth + 1 if parent else 0
        self.key = xxhash.xxh3_64_intdigest(f"{parent.key if parent else 0:x}/{self.sig}")
        role = attributes.get("role", "").lower()
        holder = tag in ("article", "main") or role in ("main", "article")
        self.main = bool(parent and parent.main) or holder
        exempt = tag in ("html", "body", "main")
        says = {w for t in split if not (len(t) > 1 and t[0] in STATES) for w in t}
        marked = says & WORDS if tag != "article" else says & {"comment", "comments", "reply"}
        self.named = not exempt and bool(marked)
        self.fixed = not exempt and bool(
            tag in BOILERPLATE
            or tag == "header" and not (parent and parent.main)
            or role in ROLES
            or "hidden" in attributes
        )
        self.barred = self.fixed or bool(parent and parent.barred)
        own = self.named or self.fixed
        self.clear = not own and (parent is None or parent.clear)
        self.core = not own and (holder or bool(parent and parent.core))
        self.titled = self.clear and (bool(parent and parent.titled) or tag in CONTAINERS and not exempt and bool(MAIN_WORDS & words))
        self.boiler = bool(parent and parent.boiler) or own
        self.link = bool(parent and parent.link) or tag == "a"

    @property
    def path(self) -> str:
        """Depth, hash of the whole path and the element's own signature."""
        return f"{self.depth}:{self.key:016x}/{self.sig}"


class Block(NamedTuple):
    """A block of text, the innermost element around it, its characters in links and its place among the tokens."""

    node: Node | None
    text: str
    linked: int
    at: int

    @property
    def plain(self) -> int:
        return max(len(self.text) - self.linked, 0)

    @property
    def boiler(self) -> bool:
        return bool(self.node and self.node.boiler)

    @property
    def token(self) -> int:
        return xxhash.xxh3_64_intdigest(f"{self.node.key if self.node else 0:x} {self.text}") >> 1


def attributes_of(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def under(opened: list[Node], slot: str | None) -> set[Node]:
    """Elements in `slot`, itself included; all without one."""
    within: set[Node] = set()
    for n in opened:
        if slot is None or n.parent in within or n.path == slot:
            within.add(n)
    return within


def blocks_of(page: str, slot: str | None = None) -> tuple[list[Node], list[Block]]:
    """Elements and blocks of `parsed`, once it is settled which elements are boilerplate.

    An element is not boilerplate by name if it lies around `slot` or holds most of the page's unlinked text:
    that of article and main elements, if there are any, else all text in containers below it. Where text stands in a container with
    a main word and no mark around it, there is nothing to overrule.
    """
    opened, blocks = parsed(page)
    if not any(n.named for n in opened):
        return opened, blocks
    around: set[Node] = set()
    for n in opened if slot is not None else ():
        at = n if n.path == slot else None
        while at is not None and at not in around:
            around.add(at)
            at = at.parent
    texts = [b for b in blocks if b.node and not b.node.barred]
    counted = [b for b in texts if b.node.core and b.plain]
    core = bool(counted)
    if not core and not any(b.node.titled and b.plain for b in texts):
        counted = [b for b in texts if b.plain]
    # Characters below an element: all, and those that have a container without a mark between.
    held: dict[Node, list[int]] = {}
    for b in counted:
        mine = held.setdefault(b.node, [0, 0])
        mine[0] += b.plain
        mine[1] += b.plain if core else 0
    total = sum(b.plain for b in counted)
    for n in reversed(opened):
        if n in held and n.parent:
            everything, wrapped = held[n]
            above = held.setdefault(n.parent, [0, 0])
            above[0] += everything
            above[1] += everything if not n.named and n.tag in CONTAINERS else wrapped
    for n in opened:
        most = n in held and held[n][1] > MAJORITY * total
        n.boiler = bool(n.parent and n.parent.boiler) or n.fixed or n.named and n not in around and not most
    return opened, blocks


def parsed(page: str) -> tuple[list[Node], list[Block]]:
    """All elements and all blocks of text, in page order."""
    opened: list[Node] = []
    blocks: list[Block] = []
    stack: list[Node] = []
    counts: dict[str, int] = {}
    parts: list[str] = []
    linked = 0
    at = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                blocks.append(Block(stack[-1] if stack else None, text, linked, len(opened) + len(blocks)))
            parts.clear()
            linked = 0

    def collect(text: str) -> None:
        nonlocal linked
        parts.append(text)
        if stack and stack[-1].link:
            linked += len(text.strip())

    def leave() -> Node:
        node = stack.pop()
        counts[node.tag] -= 1
        node.end = len(opened) + len(blocks) - 1
        return node

    while at < len(page):
        m = _TOKEN.search(page, at)
        if m is None:
            collect(page[at:])
            break
        if m.start() > at:
            collect(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if counts.get(tag):
                closes_block = tag in BLOCK
                if closes_block:
                    flush()
                while stack:
                    if stack[-1].tag != tag and stack[-1].tag in BLOCK and not closes_block:
                        break  # an inline end tag does not close blocks
                    if leave().tag == tag:
                        break
            elif tag in ("p", "br"):
                flush()
            continue
        if tag in RAW:
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in BLOCK:
            flush()
            if any(counts.get(t) and tag in by for t, by in CLOSED_BY.items()):
                for i in range(len(stack) - 1, -1, -1):
                    if tag in CLOSED_BY.get(stack[i].tag, ()):
                        while len(stack) > i:
                            leave()
                        break
                    if stack[i].tag in SCOPES:
                        break
        if tag == "br":
            parts.append("\n")
            continue
        if tag in VOID:
            continue
        attributes = attributes_of(m[3])
        node = Node(tag, attributes, stack[-1] if stack else None, len(opened) + len(blocks))
        # A boilerplate inline element inside a block must not leak into the block's text.
        if (node.named or node.fixed) and tag not in BLOCK:
            flush()
            node.at = node.end = len(opened) + len(blocks)
        opened.append(node)
        stack.append(node)
        counts[tag] = counts.get(tag, 0) + 1
    flush()
    while stack:
        leave()
    return opened, blocks


def tier(path: str) -> int:
    """How strongly a container's own name says that it holds the article."""
    tag, *words = path.rsplit("/", 1)[-1].split(".")
    return 3 if tag == "article" else 2 if tag == "main" else 1 if MAIN_WORDS & set(words) else 0


class Token:
    """A token of a page: path if it may be the main slot, is it a tag, occurrences, places, characters of text in it."""

    __slots__ = ("chars", "end", "first", "last", "n", "path", "tag")

    def __init__(self, path: str | None, tag: bool, first: int):
        self.path, self.tag, self.first = path, tag, first
        self.n, self.last, self.end, self.chars = 0, first, first, 0


def tokens_of(page: str | None) -> dict[int, Token]:
    """Tokens of a page. Characters are of text that is neither link nor boilerplate."""
    opened, blocks = blocks_of(page or "")
    chars: dict[Node, int] = {}
    found: dict[int, Token] = {}
    for b in blocks:
        mine = found.setdefault(b.token, Token(None, False, b.at))
        mine.n, mine.last, mine.end = mine.n + 1, b.at, b.at
        if b.node and not b.boiler:
            chars[b.node] = chars.get(b.node, 0) + b.plain
        mine.chars += 0 if b.boiler else b.plain
    for n in reversed(opened):
        if n.parent and n in chars:
            chars[n.parent] = chars.get(n.parent, 0) + chars[n]
    for n in opened:
        if n.tag in BLOCK:
            # Dropped by name here, an element may hold the main text of other pages: it is counted all the same.
            slot = n.tag in CONTAINERS and not n.barred
            mine = found.setdefault(n.key >> 1, Token(n.path if slot else None, True, n.at))
            mine.n, mine.last, mine.end = mine.n + 1, n.at, max(mine.end, n.end)
            mine.chars += chars.get(n, 0)
    return found


def main_slot(found: dict[int, Token]) -> str | None:
    """The slot that a single page would choose: by name, then the deepest with most of the text."""
    slots = [(t.path, t.chars, int(t.path.split(":", 1)[0])) for t in found.values() if t.path]
    total = max((c for _, c, _ in slots), default=0)
    rated = [(tier(p), depth, c, p) for p, c, depth in slots if c > MAJORITY * total]
    if not rated:
        return None
    named = [r for r in rated if r[0]]
    return max(named, key=lambda r: (r[0], -r[1], *r[2:]))[3] if named else max(rated, key=lambda r: r[1:])[3]


def text_of(page: str | None, slot: str | None, template: frozenset[int] = frozenset()) -> str:
    """Blocks of the main slot that are neither boilerplate nor text of the `template`, joined by empty lines."""
    opened, blocks = blocks_of(page or "", slot)
    rows = [b for b in blocks if not b.boiler]
    within = under(opened, slot) if slot is not None else ()
    inside = [b for b in rows if b.node in within]
    if not inside:
        own = main_slot(tokens_of(page))
        within = under(opened, own)
        inside = [b for b in rows if own is None or b.node in within]
    left = [b for b in inside if b.token not in template] if template else inside
    return "\n\n".join(b.text for b in left or inside)


def page_tokens(pages: DataFrame) -> DataFrame:
    """host, page (hash of its html), total and the tokens as arrays, for every row of `pages` (url, html)."""

    def start() -> Callable[[str | None], tuple]:
        def row(page: str | None) -> tuple:
            found = tokens_of(page)
            total = max((t.chars for t in found.values() if t.path), default=0)
            fields = ("path", "tag", "n", "first", "last", "end", "chars")
            key = xxhash.xxh3_64_intdigest(page or "") >> 1
            return key, total, list(found), *([getattr(t, f) for t in found.values()] for f in fields)

        return row

    kind = (
        "page long, total long, token array<long>, path array<string>, tag array<boolean>, n array<int>, "
        "first array<int>, last array<int>, end array<int>, chars array<long>"
    )
    return per_text(pages.select(host_of(F.col("url")).alias("host"), "html"), "html", ("host",), kind, start)


def classes(rows: DataFrame) -> DataFrame:
    """host, token, path, tag, pages, vector, chars, total: tokens of `page_tokens` with what they are alike by."""
    each = rows.select("host", "page", "total", F.inline(F.arrays_zip("token", "path", "tag", "n", "chars")))
    # Equal pages count once.
    once = each.groupBy("host", "token", "page").agg(
        *(F.first(c).alias(c) for c in ("path", "tag", "n", "chars", "total"))
    )
    return once.groupBy("host", "token").agg(
        F.max("path").alias("path"), F.max("tag").alias("tag"), F.count(F.lit(1)).alias("pages"), F.sum(F.col("n").cast("long")).alias("n"),
        F.expr("bit_xor(xxhash64(page, n))").alias("vector"), F.sum("chars").alias("chars"), F.sum("total").alias("total"),
    )


def main_slots(tokens: DataFrame) -> DataFrame:
    """host, slot, main, whole: path and token of the main slot of every host and the pages of its most frequent container."""
    tokens = tokens.where("path IS NOT NULL")
    depth = F.split("path", ":")[0].cast("int")
    last = F.element_at(F.split("path", "/"), -1)
    named = (
        F.when(last.rlike(r"^article(\.|$)"), 3).when(last.rlike(r"^main(\.|$)"), 2)
        .when(last.rlike(r"\.(" + "|".join(sorted(MAIN_WORDS)) + r")(\.|$)"), 1).otherwise(0)
    )
    # The skeleton is the class with the vector of the whole host: the body, once on every page.
    whole = tokens.groupBy("host").agg(F.max(F.struct("pages", -F.col("n"), "vector")).alias("w"))
    skeleton = F.col("pages").eqNullSafe(F.col("w.pages")) & (F.col("vector") == F.col("w.vector"))
    rated = tokens.join(whole, "host").select(
        "host", "path", "token", named.alias("named"), depth.alias("depth"), "chars", F.col("w.pages").alias("whole"),
        (F.col("chars") > MAJORITY * F.col("total")).alias("most"),
        (skeleton | (named > 0) & (F.col("pages") > MAJORITY * F.col("w.pages"))).alias("valid"),
    )
    order = F.struct(
        "named", F.when(F.col("named") > 0, -F.col("depth")).otherwise(F.col("depth")).alias("d"), "chars", "path", "token"
    )
    best = F.max(F.when(F.col("valid") & F.col("most"), order))
    return rated.groupBy("host").agg(best.getField("path").alias("slot"), best.getField("token").alias("main"), F.max("whole").alias("whole"))


def relations(tokens, first, last, end, chars, known, pages, kinds, slot: int) -> list[tuple]:
    """(token, class, is it in order, token before it in its class, token whose gap it stands in, characters in the main slot) per
    template token of a page, and one row for token -1 with all characters in the main slot.

    The gap is that after the nearest earlier token of a class that more pages hold.
    """
    of = {t: (p, k) for t, p, k in zip(known, pages, kinds)}
    place = next((i for i, t in enumerate(tokens) if t == slot), None)
    low, high = (first[place], end[place]) if place is not None else (0, -1)
    out: list[tuple] = [(-1, 0, True, 0, 0, int(chars[place]) if place is not None else 0)]
    before: dict[int, tuple[int, int]] = {}
    around: list[tuple[int, int]] = []  # pages, token: falling numbers of pages
    for i in np.argsort(first, kind="stable"):
        token = int(tokens[i])
        if token not in of:
            continue
        held, kind = of[token]
        while around and around[-1][0] <= held:
            around.pop()
        previous, previous_last = before.get(kind, (0, -1))
        # A class in one order has its last occurrences in the order of the first ones.
        ordered = last[i] > previous_last
        before[kind] = token, last[i]
        inside = int(chars[i]) if low <= first[i] <= high else 0
        out.append((token, int(kind), bool(ordered), previous, around[-1][1] if around else 0, inside))
        around.append((held, token))
    return out


def templates(pages: DataFrame) -> DataFrame:
    """host, slot, texts: the main slot of every host of `pages` (url, html) and the text tokens of its template."""
    rows = materialise(page_tokens(pages), "page_tokens")
    tokens = materialise(classes(rows), "tokens")
    slots = materialise(main_slots(tokens), "slots")
    hosts = slots.where(F.col("whole") >= SUPPORT)
    frequent = tokens.join(hosts, "host").where((F.col("pages") >= SUPPORT) & (F.col("pages") > MAJORITY * F.col("whole")))
    # At most two tokens per token of an average page pass, so a host's candidates are as few as a page's tokens.
    alike = Window.partitionBy("host", "pages", "vector")
    candidates = (
        frequent.withColumn("size", F.count(F.lit(1)).over(alike)).withColumn("tags", F.max("tag").over(alike))
        .where("size > 1 AND tags")
        .select("host", "main", "token", "tag", "pages", F.xxhash64("pages", "vector").alias("class"))
    )
    candidates = materialise(candidates, "candidates")
    listed = candidates.groupBy("host").agg(
        F.array_sort(F.collect_list(F.struct("token", "pages", "class"))).alias("t"),
        F.max("main").alias("main"),
    )
    columns = F.col("t.token").alias("known"), F.col("t.pages").alias("of"), F.col("t.class").alias("kinds")
    listed = materialise(listed.select("host", "main", *columns), "listed")

    @F.pandas_udf("array<struct<token:long,class:long,ordered:boolean,previous:long,gap:long,inside:long>>")
    def related(token: pd.Series, first: pd.Series, last: pd.Series, end: pd.Series, chars: pd.Series,
                known: pd.Series, of: pd.Series, kinds: pd.Series, main: pd.Series) -> pd.Series:
        slot = main.fillna(-1).astype("int64")
        return pd.Series([relations(*r) for r in zip(token, first, last, end, chars, known, of, kinds, slot)], dtype=object)

    joined = attach(rows.select("host", "token", "first", "last", "end", "chars"), listed, "host", is_small(listed, "known"))
    seen = joined.where("known IS NOT NULL").select(
        "host", F.inline(related("token", "first", "last", "end", "chars", "known", "of", "kinds", "main"))
    )
    facts = seen.groupBy("host", "token", "class").agg(
        (F.min("ordered") & (F.min("previous") == F.max("previous"))).alias("ordered"), F.min("gap").alias("low"), F.max("gap").alias("high"),
        F.sum("inside").alias("inside"),
    )
    facts = materialise(facts, "facts")
    nested = facts.groupBy("host", "class").agg((F.min("low") == F.max("high")).alias("nested"))
    texts = candidates.where("NOT tag").select("host", "token")
    texts = facts.where("ordered").join(nested.where("nested"), ["host", "class"]).join(texts, ["host", "token"])
    texts = texts.groupBy("host").agg(F.array_sort(F.collect_list("token")).alias("texts"), F.sum("inside").alias("inside"))
    everything = facts.where("token = -1").select("host", F.col("inside").alias("everything"))
    texts = texts.join(everything, "host").where(F.col("inside") <= MAJORITY * F.col("everything")).select("host", "texts")
    return slots.where("slot IS NOT NULL").join(texts, "host", "left").select("host", "slot", "texts")


def is_small(table: DataFrame, column: str) -> bool:
    """May a table of arrays, one row per host, be broadcast?"""
    size = table.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size(column).cast("long")), F.lit(0)).alias("items")).first()
    return size.rows <= LOOKUP_ROWS and size["items"] <= BROADCAST_TOKENS


def extract(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """`keep` columns, text and n_chars (code points) of every row of `pages` (url, html)."""
    arrow_batches(pages.sparkSession)
    found = materialise(templates(pages).withColumnRenamed("host", "_host"), "templates")
    rows = pages.select(*keep, F.col("html").alias("_html"), host_of(F.col("url")).alias("_host"))
    joined = attach(rows, found, "_host", is_small(found, "texts"))

    @F.pandas_udf("string")
    def run(html: pd.Series, slot: pd.Series, texts: pd.Series) -> pd.Series:
        rows = zip(html, slot, texts)
        return pd.Series([text_of(h, s, frozenset(t) if t is not None else frozenset()) for h, s, t in rows], dtype=object)

    text = run("_html", "slot", "texts").alias("text")
    return joined.select(*keep, text).withColumn("n_chars", F.length("text").cast("long"))
