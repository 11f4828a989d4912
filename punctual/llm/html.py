"""Main text of pages by template deduction.

The tokens of a page are its tags and its strings between tags, each under the path of open elements.
Tokens that occur equally often on the same pages of a host, that is, with the same occurrence
vector, form an equivalence class. A vector is kept as the number of its pages and the XOR of a hash
of each (page, count), so tasks can merge it in any order. A class is valid if it holds two tags, is
on enough pages of the host, and its elements lie inside elements of a valid class: this nests the
classes into the template of the host. What the template leaves open between two of its tags is a
slot; the main text is the slots of the article, without the strings that the template fixes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from punctual.llm.common import BROADCAST_ROWS, broadcast_if_small, written

#: A class is on at least so many pages of its host and at least this share of them.
LEAST_PAGES, LEAST_SHARE = 5, 0.5

# Elements of HTML by their role.
RAW = "script style textarea title iframe noscript".split()
RAW_BLOCKS = "textarea title".split()
FOREIGN = "svg math".split()
HIDDEN = [*FOREIGN, *"object button select template".split()]
HIDDEN_BLOCKS = "select button".split()
HEAD = "base basefont bgsound head link meta title style script noscript template".split()
# Tags that end svg and math left open.
NOT_FOREIGN = set(
    "address article aside blockquote body center dd details div dl dt embed fieldset figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr li main menu nav ol p pre section table ul".split()
)
# Elements of svg and math that may hold HTML.
HOLDS_HTML = "foreignobject desc annotation-xml".split()
INLINE = (
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr del"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
FRAME = "nav footer aside form dialog menu".split()
NAMED_FRAME = "nav footer aside header dialog menu".split()
MAIN = "article main".split()
CLOSES_ITSELF = "p li dt dd tr td th option".split()
# Whole names in class, id or role that hint at what surrounds an article.
FRAME_WORDS = set(
    "ad ads advert advertisement adverts advertising alert banner breadcrumb breadcrumbs comment comments consent contentinfo "
    "cookie cookies copyright dialog discussion disqus footer form gdpr legal login masthead menu modal nav navbar navigation "
    "newsletter notice notices notification pager pagination popup promo promoted promotion recommended related replies reply "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription teaser toolbar topbar widget "
    "ad-banner ad-container adsbygoogle breadcrumb-nav breadcrumb-trail comment-form comment-list comment-respond comments-area "
    "comments-list comments-section cookie-banner cookie-consent cookie-notice footer-widgets left-sidebar main-footer main-menu "
    "main-nav main-navigation nav-links nav-menu newsletter-signup page-footer post-comments post-navigation primary-sidebar "
    "related-articles related-posts right-sidebar share-buttons share-links sharedaddy side-bar sidebar-left sidebar-right "
    "site-footer site-header site-navigation skip-link social-icons social-links social-share widget-area"
    .split()
)

_TAG = r"""<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
_BROKEN = r"<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)(?:>|\Z)"
TOKENS = re.compile(rf"<!--.*?(?:-->|\Z)|{_TAG}|{_BROKEN}|<[!?/][^>]*+(?:>|\Z)|(?P<text>[^<]++|<)", re.S)
NAMES = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_END = {name: re.compile(rf"</{name}\b[^>]*+(?:>|\Z)", re.I) for name in RAW}
ANY_HIDDEN = re.compile(rf"<(?:{'|'.join(HIDDEN)})\b", re.I)
HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", re.I)


def host_of(url: str | None) -> str:
    found = HOST.match(url or "")
    return found[1].lower() if found else ""


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - 2**63


@dataclass(slots=True, eq=False)
class Element:
    """An open element and the one around it; the page itself has none around it."""

    token: int
    around: Element | None
    hinted: bool = False  # by its name or class it surrounds an article
    named: bool = False  # by its name alone, and not a form
    main: bool = False  # an article or main element
    framed: bool = False  # it or an element around it surrounds the article
    unlinked: int = 0  # code points in it outside links
    own: int = 0  # of these, the ones outside hinted elements in it
    article: Element | None = None  # the outermost article that it is in


@dataclass(slots=True)
class Tag:
    """An element begins: its token, the token of the element around it."""

    token: int
    parent: int
    element: Element | None = None  # none if it holds no blocks


@dataclass(slots=True)
class Block:
    """A string between tags of blocks."""

    text: str
    token: int
    parent: int
    inside: Element
    unlinked: int  # code points outside links


def _tokens(html: str) -> Iterator[tuple[int, str | None, str, str, str]]:
    """(position, text, name, closes, attributes) of texts and tags, without comments and what raw elements hold.

    A raw element without an end tag reaches to the end of the page. Only within svg and math can one close itself.
    """
    at, foreign = 0, False
    while found := TOKENS.match(html, at):
        start, at = at, found.end()
        if (text := found["text"]) is not None:
            yield start, text, "", "", ""
            continue
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        closes = found["close"] or found["close2"]
        attrs = found["attrs"] or found["attrs2"] or ""
        if name in FOREIGN:
            foreign = not closes and not attrs.endswith("/")
        elif name in NOT_FOREIGN:
            foreign = False
        yield start, None, name, closes, attrs
        if name in RAW and not closes and not (foreign and attrs.endswith("/")):
            end = _END[name].search(html, at)
            at = end.end() if end else len(html)


def _closed(html: str) -> set[int]:
    """Positions of the hidden elements that have an end tag of their own before the element around them ends."""
    out: set[int] = set()
    stack: list[tuple[str, int]] = []
    # how many elements of each name are open, and where: no tag searches the stack
    open_: Counter[str] = Counter()
    special: list[int] = []  # positions of svg, math and what may hold HTML within them
    hidden_at: dict[str, int] = {}  # position of the last open element of HIDDEN_BLOCKS

    def pop() -> tuple[str, int]:
        last = stack.pop()
        open_[last[0]] -= 1
        if special and special[-1] == len(stack):
            special.pop()
        while stack and not stack[-1][0]:  # taken out before
            stack.pop()
        return last

    for at, text, name, closes, attrs in _tokens(html):
        if text is not None or name in RAW or name in VOID or name in INLINE:
            continue
        if closes:
            while open_[name]:
                last = pop()
                if last[0] == name:
                    out.add(last[1])
                    break
            continue
        if name in FOREIGN and attrs.endswith("/"):
            continue
        if name in NOT_FOREIGN and special and stack[special[-1]][0] in FOREIGN:  # ends svg and math, but for HTML that they hold
            depth = special[-1]
            while len(stack) > depth:
                pop()
        if name in HIDDEN_BLOCKS:  # not within its like: the one before was left open
            if open_[name]:
                open_[name] = 0
                stack[hidden_at[name]] = ("", 0)
                while stack and not stack[-1][0]:
                    stack.pop()
        if stack and stack[-1][0] in CLOSES_ITSELF and (stack[-1][0] == name or stack[-1][0] == "p") and name not in HIDDEN:
            pop()
        if name in FOREIGN or name in HOLDS_HTML:
            special.append(len(stack))
        elif name in HIDDEN_BLOCKS:
            hidden_at[name] = len(stack)
        stack.append((name, at))
        open_[name] += 1
    return out


def parse(html: str | None) -> Iterator[Tag | Block]:
    """Tags and blocks of a page in order. Elements that are not closed end with the ones around them.

    A hidden element shows nothing of what it holds. One without an end tag of its own hides what comes
    before the next tag of a block.
    """
    stack = [("", Element(0, None))]
    pending: list[str] = []
    linked = in_link = mains = 0
    html = html or ""
    closed = _closed(html) if ANY_HIDDEN.search(html) else set()
    hiding: list[str] = []  # open elements from the outermost hidden one on
    # how many elements of each name are open, and of the hidden ones
    open_, hidden = Counter(), Counter()
    until_block = False  # within a hidden element without an end tag

    def block() -> Iterator[Block]:
        nonlocal linked
        text = " ".join(unescape("".join(pending)).split())
        pending.clear()
        if text:
            inside = stack[-1][1]
            yield Block(text, _hash(f"{inside.token} {text}"), inside.token, inside, max(len(text) - linked, 0))
        linked = 0

    for at, text, name, closes, attrs in _tokens(html):
        if hiding:
            if text is not None or name in RAW or name in VOID or name in INLINE:
                continue
            if not closes:
                if not (name in FOREIGN and attrs.endswith("/")):
                    hiding.append(name)
                    hidden[name] += 1
            elif hidden[name]:
                last = ""
                while last != name:
                    last = hiding.pop()
                    hidden[last] -= 1
            continue
        if text is not None:
            if stack[-1][0] == "head" and text.strip():
                yield from block()
                open_[stack.pop()[0]] -= 1
            if not until_block:
                pending.append(text)
                if in_link:
                    linked += len(text.strip())
            continue
        if stack[-1][0] == "head" and name not in HEAD:  # may be left open
            yield from block()
            open_[stack.pop()[0]] -= 1
        if name in RAW:
            if not closes and name in RAW_BLOCKS:
                yield from block()
                yield Tag(_hash(f"{stack[-1][1].token} {name}"), stack[-1][1].token)
            continue
        if name in INLINE:
            if name == "a":
                in_link = not closes
            if name in ("br", "img"):
                pending.append(" ")
            continue
        if name in HIDDEN:
            if name in HIDDEN_BLOCKS:
                yield from block()
                in_link = 0
                if not closes:
                    yield Tag(_hash(f"{stack[-1][1].token} {name}"), stack[-1][1].token)
            if closes:
                until_block = False
            elif at in closed:
                hiding.append(name)
                hidden[name] += 1
            elif not (name in FOREIGN and attrs.endswith("/")):
                until_block = True
            continue
        until_block = False
        yield from block()
        in_link = 0
        if closes:
            last = ""
            while open_[name] and last != name:
                last, x = stack.pop()
                open_[last] -= 1
                mains -= x.main
            continue
        if stack[-1][0] in CLOSES_ITSELF and (stack[-1][0] == name or stack[-1][0] == "p"):
            open_[stack.pop()[0]] -= 1
        named = " ".join(b or c or d for _, b, c, d in NAMES.findall(attrs)).lower()
        around = stack[-1][1]
        token = _hash(f"{around.token} {name} {named}")
        if name in VOID:
            yield Tag(token, around.token)
            continue
        hinted = name in FRAME or name == "header" and not mains or not FRAME_WORDS.isdisjoint(named.split())
        element = Element(token, around, hinted, hinted and name in NAMED_FRAME, name in MAIN)
        yield Tag(token, around.token, element)
        mains += name in MAIN
        stack.append((name, element))
        open_[name] += 1
    yield from block()


def _host_column() -> Column:
    host = F.lower(F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    return F.coalesce(host, F.lit(""))


def _different(pages: DataFrame) -> DataFrame:
    """``pages`` with equal payloads of a host as one page.

    Only pages that may repeat are shuffled, one of each payload per task; with more repeated payloads
    than a broadcast holds, one of every payload per task is.
    """
    keyed = pages.withColumn("host", _host_column()).withColumn("html", F.coalesce("html", F.lit("")))
    key = F.xxhash64("host", "html").alias("payload")
    again = keyed.select(key).groupBy("payload").agg(F.count("*").alias("n")).where("n > 1").select("payload")
    again = written(again, "repeated_payloads")
    n = again.count()
    if not n:
        return pages
    if n > BROADCAST_ROWS:
        return keyed.dropDuplicates(["host", "html"]).drop("host")
    keyed = keyed.withColumn("payload", key)
    once = keyed.join(F.broadcast(again), "payload", "left_anti").drop("payload")
    one_each = keyed.join(F.broadcast(again), "payload", "left_semi").drop("payload").dropDuplicates(["host", "html"])
    return once.unionByName(one_each).drop("host")


def _vectors(pages: DataFrame) -> DataFrame:
    """(host, token, parent, is_tag, pages, vector) of ``pages`` (page_no, url, html)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            merged: dict[tuple[str, int], list] = {}
            for no, url, html in zip(batch["page_no"], batch["url"], batch["html"], strict=True):
                host, first = host_of(url), {}
                for x in parse(html):
                    first.setdefault(x.token, [0, x])[0] += 1
                for token, (n, x) in first.items():
                    held = merged.setdefault((host, token), [0, 0, x.parent, isinstance(x, Tag)])
                    held[0] += 1
                    held[1] ^= _hash(f"{no} {n}")
            rows = [(host, token, v[2], v[3], v[0], v[1]) for (host, token), v in merged.items()]
            if rows:  # none if all pages are empty
                yield pd.DataFrame(rows, columns=["host", "token", "parent", "is_tag", "pages", "vector"])

    kinds = "host string, token bigint, parent bigint, is_tag boolean, pages bigint, vector bigint"
    each = pages.mapInPandas(count, kinds)
    return each.groupBy("host", "token").agg(
        F.first("parent").alias("parent"), F.first("is_tag").alias("is_tag"),
        F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"),
    )


def _nested(tokens: pd.DataFrame) -> pd.DataFrame:
    """The tokens of one host that are in the template, and the class of each.

    ``tokens`` are those on enough pages, at most a few times what one page holds.
    """
    every = {r.token: r for r in tokens.itertuples()}
    held = Counter((r.pages, r.vector) for r in every.values() if r.is_tag)
    rows = {t: r for t, r in every.items() if held[r.pages, r.vector] >= 2}
    inside: dict[int, bool] = {0: True}

    def nests(token: int) -> bool:
        """The nearest element around it that is of a valid class nests, and is on no fewer pages."""
        chain = []
        while token not in inside:
            chain.append(token)
            around = rows[token].parent
            while around and around not in rows:
                if around not in every:
                    return False
                around = every[around].parent
            if around and rows[around].pages < rows[token].pages:
                inside[token] = False
            else:
                token = around
        inside.update(dict.fromkeys(chain, inside[token]))
        return inside[token]

    kept = [r for r in rows.values() if nests(r.token)]
    found = pd.DataFrame({
        "host": [r.host for r in kept], "token": [r.token for r in kept],
        "is_tag": [r.is_tag for r in kept], "class": [r.vector for r in kept],
    })
    # also where nothing nests
    return found.astype({"host": object, "token": "int64", "is_tag": bool, "class": "int64"})


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, tags, strings): tokens of the template of each host that has one.

    Pages of a host with equal payloads count as one: what copies share is not what a host repeats.
    """
    vectors = written(_vectors(_different(pages)), "occurrence_vectors")
    # the root of every page counts the different pages of the host
    size = vectors.groupBy("host").agg(F.max("pages").alias("most"))
    enough = F.col("pages") >= F.greatest(F.lit(least_pages), F.col("most") * least_share)
    often = vectors.where(F.col("pages") >= least_pages).join(size, "host").where(enough).drop("most")
    kinds = "host string, token bigint, is_tag boolean, class bigint"
    kept = often.groupBy("host").applyInPandas(_nested, kinds)
    return kept.groupBy("host").agg(
        F.collect_list(F.when(F.col("is_tag"), F.col("token"))).alias("tags"),
        F.collect_list(F.when(~F.col("is_tag"), F.col("token"))).alias("strings"),
    )


def _frame(elements: list[Element], blocks: list[Block]) -> None:
    """Decide for each element, given in order, whether it surrounds the article.

    A hint does not hold for an element that holds the article: the innermost article or main element with a
    third of the largest one's unlinked text, hinted parts apart. Nor does it for one with most of the page's
    unlinked text, unless the article lies beside it and has a third as much, or any text beside a footer, nav, aside or header.
    """
    for x in blocks:
        x.inside.unlinked += x.unlinked
        x.inside.own += x.unlinked
    for x in reversed(elements):
        x.around.unlinked += x.unlinked
        x.around.own += 0 if x.hinted else x.own
    most = sum(x.unlinked for x in blocks) / 2
    largest = max((x.own for x in elements if x.main), default=0)
    outer, article = set(), None
    for x in reversed(elements):
        if x.main and x.own and 3 * x.own >= largest and x not in outer and not (article and article.own > x.own):
            article = x
        if x in outer or x.main and 3 * x.own >= largest:
            outer.add(x.around)
    holds, x = set(), article
    while x:
        holds.add(x)
        x = x.around
    within = {article} if article else set()
    for x in elements:
        around = x.around
        if around in within:
            within.add(x)
        beside = article and x not in within and (x.named or 3 * article.own >= x.unlinked)
        hides = x.hinted and x not in holds and (x.unlinked <= most or beside)
        x.framed = around.framed or bool(hides)
        x.article = around.article or (x if x.main and not x.framed else None)


def _around(elements: list[Element], tags: set[int]) -> Element:
    """The nearest element of the template, or else the page, that holds all of ``elements``."""

    def above(x: Element) -> Element:
        while x.around and x.token not in tags:
            x = x.around
        return x

    chain, x = [], above(elements[0])
    while True:
        chain.append(x)
        if not x.around:
            break
        x = above(x.around)
    depth, at = {x: i for i, x in enumerate(chain)}, 0
    for x in dict.fromkeys(elements):
        path = []
        while x not in depth:
            path.append(x)
            x = x.around
        depth.update(dict.fromkeys(path, depth[x]))
        at = max(at, depth[x])
    return chain[at]


def main_text(html: str | None, tags: set[int], strings: set[int]) -> str:
    """The blocks of the slots that hold the article.

    An article or main element with as much unlinked text as the largest slot outside such elements is chosen
    with all others like it. Else slots with as much unlinked text as a third of the largest mark the article:
    it is all slots, of any size, from the first to the last with unlinked text in the nearest element of the
    template that holds them; for a single slot that is an element, in the one around it. What frames an article
    is left out. ``tags`` and ``strings`` are the template.
    """
    elements, found = [], []
    slot = 0
    for x in parse(html):
        if isinstance(x, Block):
            found.append((slot, x))
        else:
            if x.element:
                elements.append(x.element)
            if x.token in tags:
                slot = x.token
    _frame(elements, [x for _, x in found])
    found = [(slot, x) for slot, x in found if not x.inside.framed and x.token not in strings]
    articles, outside, size = Counter(), Counter(), Counter()
    for slot, x in found:
        size[slot] += x.unlinked
        if x.inside.article:
            articles[x.inside.article] += x.unlinked
        else:
            outside[slot] += x.unlinked
    if articles and max(articles.values()) >= max(outside.values(), default=0):
        return "\n".join(x.text for _, x in found if x.inside.article)
    most = max(size.values(), default=0)
    if not most:
        return ""
    large = {k for k, n in size.items() if 3 * n >= most}
    around = _around([x.inside for k, x in found if k in large], tags)
    if len(large) == 1 and around.around and around.token in large:
        around = _around([around.around], tags)
    below = {around}
    for x in elements:
        if x.around in below:
            below.add(x)
    found = [(k, x) for k, x in found if x.inside in below]
    content = [i for i, (k, _) in enumerate(found) if size[k] > 0]
    return "\n".join(x.text for _, x in found[content[0] : content[-1] + 1])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text.

    A null or empty page has the empty text. Pages whose url names no host form one group. A host of under
    ``LEAST_PAGES`` different pages has no template: its pages are judged by their elements alone. Character
    references are decoded, white space within a block is one space, blocks are joined by a line feed. Repeated
    rows have rows of their own in the result. Other columns are ignored. Pages are read up to four times and
    not shuffled, but for copies and hosts beyond the size up to which their templates are broadcast.
    """
    narrow = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    found = written(templates(narrow.withColumn("page_no", F.monotonically_increasing_id())), "templates")
    tokens = found.agg(F.coalesce(F.sum(F.size("tags") + F.size("strings")), F.lit(0)).alias("n")).first()["n"]
    known = narrow.withColumn("host", _host_column()).join(broadcast_if_small(found, tokens), "host", "left")

    def cut(batches):
        for htmls, tags, strings in batches:
            sets: dict[tuple, set] = {}
            out = []
            for html, t, s in zip(htmls, tags, strings, strict=True):
                own = []
                for x in (t, s):
                    key = (0 if x is None else len(x), None if x is None or not len(x) else (x[0], x[-1], sum(map(int, x))))
                    own.append(sets.setdefault(key, set() if x is None else {int(v) for v in x}))
                out.append(main_text(html, *own))
            yield pd.Series(out)

    cut.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    text = F.pandas_udf(cut, "string")("html", "tags", "strings")
    return known.select("id", "url", text.alias("text"))
