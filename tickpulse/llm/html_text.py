"""Operator 6: main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags, outside of comments, scripts, styles and other unseen elements.
First pass: stop-word density, length and link density call each block good, bad, or (short, or nearly
good) undecided; only what lies in menus, headers, footers, sidebars, notices, adverts, forms or comments is bad
before that. Second pass: undecided blocks take the label of their nearest decided neighbours (good where
both sides are good, or where the nearer one is; headings look at what follows).

The mark of an <article> or <main> is a prior for undecided blocks and doesn't overrule a good one. In a marked
element few stop words alone leave a block undecided. Where the articles hold at least as much text as the
good blocks outside of them, an undecided block in them is good unless the decided blocks on both sides are bad.
Otherwise they are cards beside the story: each is settled by its own blocks, and is bad without a good one.

A class or id name can set a generic wrapper (div, section, table parts) aside; names that only tell of the
layout (has-sidebar, no-comments) don't. An article, main element or content container (``GOOD_NAMES``) inside such a
wrapper is taken back where it holds at least as much text as what lies outside of these wrappers.

The result is the good blocks in page order, character references decoded, white space within a block
collapsed, joined by one space; nothing else is dropped. A null or empty page, and one without a good block,
gives an empty text. Malformed markup (unclosed tags or quotes, ends without beginnings, a page that ends inside a
tag) is read as far as it goes, in time linear in the page. Rows stay as they
are (repeated rows and null ids too); other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from itertools import groupby

from pyspark.sql import DataFrame, functions as F

from .common import map_texts

#: Common function words of the corpus languages.
STOP_WORDS = frozenset("""
the of and to in a is that it was for on are as with be by this at from or an he his they not but have had were which
you we their has been will would there what all if can her one so up out about who them then she do more when
der die das und in zu den von ist mit für auf ein eine als im dem nicht sich des auch es an werden aus er hat dass sie nach
wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man
le la les de des du un une et en que qui dans pour pas sur par est plus au aux avec ce il sont se ne son sa ses ou mais
comme on leur nous vous elle cette été être fait à
el los las del y en un una que es por con para se no su al lo como más o pero sus le ha este sí porque esta entre
cuando muy sin sobre también me hasta hay donde quien desde todo nos
""".split())

#: Element names by what they do here.
UNSEEN = frozenset("head script style noscript template svg math iframe object select textarea button canvas audio video".split())
ASIDE = frozenset("nav header footer aside form menu dialog fieldset".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BLOCKS = HEADINGS | ASIDE | frozenset(
    """html body address article blockquote br caption center col colgroup dd details div dl dt figcaption figure hr
    legend li main ol option p pre section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Parts of class and id names (between hyphens, underscores and case changes) of boilerplate and of the article.
BAD_NAMES = frozenset(
    """ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies consent copyright
    disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice overlay pagination pager
    popup promo promoted promotion related reply replies respond share sharing sidebar signup social sponsor sponsored
    subscribe subscription tags teaser toolbar topbar widget""".split())
#: The rest of a name after one of these tells what a page's layout has or lacks, not what an element is.
MODIFIERS = frozenset("has with without no not hide show".split())
#: Elements that only wrap, so that an article inside may undo what their names say.
GENERIC = frozenset("div section center table tbody tr td".split())
BAD_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
GOOD_NAMES = frozenset("article articlebody content main post story entry body text".split())

# Thresholds of the block rules; in a marked element, links up to LINKS_MARKED leave a block undecided.
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH = 0.10, 0.22
LINKS_MOST, LINKS_MARKED = 0.4, 0.8

_OPEN = re.compile(r"<(?:(!--)|[!?]|(/?)([A-Za-z][A-Za-z0-9:-]*))")
_STOP = re.compile("[>\"']")
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "template", "iframe")}
_ATTRS = re.compile(r"""\b(class|id|role|hidden|aria-hidden|itemprop)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


class Block:
    __slots__ = ("parts", "linked", "heading", "label", "article", "main", "aside", "wrapper", "content", "text")

    def __init__(self, heading: bool, article: int, main: bool, aside: bool, wrapper: int, content: int):
        self.parts: list[str] = []
        self.linked = 0
        self.heading, self.article, self.main, self.aside = heading, article, main, aside
        self.wrapper, self.content = wrapper, content
        self.label = self.text = ""


def _names(value: str) -> set[str]:
    """Parts of class or id names, without those after a modifier."""
    out = set()
    for name in value.split():
        for p in _NAME_PARTS.findall(name):
            if p.lower() in MODIFIERS:
                break
            out.add(p.lower())
    return out


def _role(tag: str, attrs: str) -> tuple[bool, bool, bool, bool, bool]:
    """Does an element set its contents aside; do only its names; does it mark an article; does it mark the page's
    main part; is it a content container."""
    aside, article, main = tag in ASIDE, tag == "article", tag == "main"
    names: set[str] = set()
    if attrs and "=" in attrs or "hidden" in attrs:
        for name, a, b, c in _ATTRS.findall(attrs):
            name, value = name.lower(), a or b or c
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
                aside = True
            elif name == "role":
                aside |= value.lower() in BAD_ROLES
                article |= value.lower() == "article"
                main |= value.lower() == "main"
            elif name == "itemprop":
                article |= value.lower() == "articlebody"
            elif name in ("class", "id"):
                names |= _names(value)
    article |= tag in ("div", "section", "td") and bool(names & {"article", "articlebody"})
    bad = bool(names & BAD_NAMES) and tag not in ("html", "body", "article", "main")
    content = tag in GENERIC and not bad and bool(names & GOOD_NAMES)
    if bad and tag not in GENERIC:
        aside = True
    return aside, bad and not aside, article, main, content


class TagEnds:
    """Where tags of a page end: at the first ">" outside of quoted values. A quote without a partner is a plain
    character, and where a tag's quotes reach over all the rest its first ">" ends it. Positions from which
    no end was found are remembered, so all scans of a page together are linear in it."""

    def __init__(self, page: str):
        self.page = page
        self.last = {q: page.rfind(q) for q in "\"'"}
        self.dead: set[int] = set()

    def after(self, at: int) -> int:
        """The place behind the tag's end; 0 without one."""
        page, seen, p = self.page, [], at
        while p not in self.dead:
            seen.append(p)
            m = _STOP.search(page, p)
            if m is None:
                break
            if m[0] == ">":
                return m.end()
            p = m.end()
            if m.start() < self.last[m[0]]:
                p = page.find(m[0], p) + 1
        self.dead.update(seen)
        return page.find(">", at) + 1


def blocks(page: str) -> list[Block]:
    """The page's text blocks, in order."""
    out: list[Block] = []
    # element; own and inherited: aside, number of the wrapper that is aside by name (0: none), 1 in a content container
    # and 2 in an article or main element within it, number of the outermost article (0: none), main, unseen
    stack: list[tuple[str, bool, int, int, int, bool, bool]] = []
    open_tags: Counter[str] = Counter()
    links = heading = articles = wrappers = 0
    current: Block | None = None
    body = False

    def state() -> tuple[bool, int, int, int, bool, bool]:
        return stack[-1][1:] if stack else (False, 0, 0, 0, False, False)

    def text(s: str) -> None:
        nonlocal current
        aside, wrapper, content, article, main, unseen = state()
        if unseen or not s:
            return
        if current is None:
            if s.isspace():
                return
            current = Block(heading > 0, article, main, aside or wrapper > 0, 0 if aside else wrapper, content)
            out.append(current)
        current.parts.append(s)
        if links:
            current.linked += len(s.strip())

    at, n, ends = 0, len(page), TagEnds(page)
    while at < n:
        m = _OPEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        if m[1]:
            end = page.find("-->", m.end()) + 3
            end = end if end > 2 else n
        elif m[3]:
            end = ends.after(m.end())
        else:
            end = page.find(">", m.end()) + 1
        if not end:  # the page's end cuts off its last tag
            text(page[at:max(page.rfind("<"), m.start())])
            break
        text(page[at:m.start()])
        at = end
        tag, attrs = (m[3] or "").lower(), page[m.end():end - 1]
        if not tag:
            continue
        if tag in BLOCKS:
            current = None
        if m[2]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in HEADINGS:
                heading = max(0, heading - 1)
            while open_tags[tag]:  # an end without its beginning closes nothing
                closed = stack.pop()[0]
                open_tags[closed] -= 1
                if closed == tag:
                    break
            continue
        if tag == "body" and not body:
            body, open_tags["head"] = True, 0
            stack = [e for e in stack if e[0] != "head"]
        if tag == "a":
            links += 1
        if tag in HEADINGS:
            heading += 1
        if tag in VOID or attrs.endswith("/"):
            continue
        if tag in ("p", "li") and stack and stack[-1][0] == tag:
            open_tags[stack.pop()[0]] -= 1  # these end where the next one begins
        aside, wrapper, content, article, main, unseen = state()
        own_aside, own_bad, own_article, own_main, own_content = _role(tag, attrs)
        if own_article or own_main:
            own_bad = False
            own_aside = own_aside and (aside or wrapper > 0)
        header_of_article = tag == "header" and (article or main)
        unseen = unseen or tag in UNSEEN or tag == "title"
        if tag in _RAW_END:
            end = _RAW_END[tag].search(page, at)
            if end is None:
                break
            at = end.end()
            if tag in BLOCKS:
                current = None
            continue
        if own_article and not article:
            articles += 1
            article = articles
        if own_bad:
            wrappers += 1
            wrapper, content = wrappers, 0
        elif wrapper and (own_article or own_main):
            content = 2
        elif wrapper and own_content:
            content = content or 1
        if tag in BLOCKS or own_aside or own_article or own_main or unseen or tag in ("span", "a"):
            open_tags[tag] += 1
            stack.append((tag, aside or own_aside and not header_of_article, wrapper, content, article, main or own_main, unseen))
    for b in out:
        b.text = _SPACE.sub(" ", entities.unescape("".join(b.parts))).strip()
    return [b for b in out if b.text]


def first_pass(b: Block) -> str:
    """good, bad, near (nearly good) or short."""
    if b.aside:
        return "bad"
    marked = b.article or b.main
    size = len(b.text)
    links = b.linked / size
    if links > LINKS_MOST or "©" in b.text[:30] and not marked:
        return "short" if marked and links <= LINKS_MARKED else "bad"
    if size < SHORT:
        return "short"
    words = b.text.lower().split()
    density = sum(w.strip(".,;:!?()\"'") in STOP_WORDS for w in words) / len(words)
    if density >= STOP_HIGH:
        return "good" if size > LONG else "near"
    return "near" if density >= STOP_LOW or marked else "bad"


def settle_marked(found: list[Block]) -> None:
    """The trusted mark's word on nearly good blocks: good, unless the decided blocks on both sides are bad."""
    sides = []
    for way in (found, found[::-1]):
        seen, out = "", []
        for b in way:
            out.append(seen)
            seen = b.label if b.label in ("good", "bad") else seen
        sides.append(out)
    for b, before, after in zip(found, sides[0], sides[1][::-1]):
        if b.label == "near":
            b.label = "bad" if before == after == "bad" else "good"
    if not any(b.label == "good" for b in found):
        for b in found:  # an article of short blocks only
            b.label = "good" if b.label == "short" else b.label


def second_pass(found: list[Block]) -> None:
    """Labels of undecided blocks: those of the nearest decided blocks, counted in blocks."""
    first = [b.label for b in found]
    n = len(first)
    before: list[tuple[str, int]] = []
    seen = ("bad", n + 1)
    for i, label in enumerate(first):
        before.append((seen[0], i - seen[1] if seen[1] <= n else n + 1))
        if label in ("good", "bad"):
            seen = (label, i)
    seen = ("bad", -1)
    for i in range(n - 1, -1, -1):
        if first[i] in ("good", "bad"):
            seen = (first[i], i)
            continue
        after = (seen[0], seen[1] - i if seen[1] >= 0 else n + 1)
        a, b = before[i], after
        if a[0] == b[0]:
            label = a[0]
        elif found[i].heading:
            label = b[0]
        else:
            label = a[0] if a[1] < b[1] else b[0] if b[1] < a[1] else "good" if first[i] == "near" else "bad"
        if first[i] == "near" and n == 1 and not found[i].article:
            label = "good"
        found[i].label = label


def _size(found: list[Block]) -> int:
    """Characters of blocks that aren't mostly links."""
    return sum(len(b.text) for b in found if b.linked <= LINKS_MOST * len(b.text))


def _prose(found: list[Block]) -> int:
    return sum(len(b.text) for b in found if b.label == "good")


def take_back(found: list[Block]) -> None:
    """Contents of wrappers that are aside by name, the largest first, where they outweigh all that isn't aside."""
    held: dict[int, list[Block]] = {}
    for b in found:
        if b.wrapper and b.content:
            held.setdefault(b.wrapper, []).append(b)
    if not held:
        return
    for own in held.values():
        for b in own:
            b.aside = False
            b.label = first_pass(b)
            b.aside = True

    def weight(own: list[Block]) -> int:
        """Text of the largest article, main element or content container."""
        parts = [list(p) for _, p in groupby(own, key=lambda b: (b.content, b.article))]
        return max(_size(p) if p[0].content == 2 else _prose(p) for p in parts)

    plain = [b for b in found if not b.aside]
    other = _size([b for b in plain if b.article or b.main]) + _prose([b for b in plain if not (b.article or b.main)])
    for own in sorted(held.values(), key=weight, reverse=True):
        if weight(own) < max(1, other):
            break
        other += _size(own)
        for b in own:
            b.aside = False
    for b in found:
        if b.aside:
            b.label = "bad"


def main_text(page: str | None) -> str:
    if not page:
        return ""
    found = blocks(page)
    for b in found:
        b.label = first_pass(b)
    take_back(found)
    seen = [b for b in found if not b.aside]
    in_article, outside = [b for b in seen if b.article], [b for b in seen if not b.article]
    cards = _size(in_article) < _prose(outside)
    marked = [b for b in seen if b.main and not b.article or b.article and not cards]
    if _size(marked) < _prose([b for b in outside if not b.main]):
        marked = []
    settle_marked(marked)
    second_pass(marked)
    trusted = set(map(id, marked))
    for inside, run in groupby((b for b in found if not (cards and b.article) or b.aside), key=lambda b: id(b) in trusted):
        if not inside:  # what lies before, between or after the marked blocks
            second_pass(list(run))
    if cards:
        for _, card in groupby(in_article, key=lambda b: b.article):
            second_pass(list(card))
    return " ".join(b.text for b in found if b.label == "good")


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    def texts(pages):
        found = [main_text(p) for p in pages]
        return [found, [len(t) for t in found]]

    return map_texts(df, [F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url")], html_col,
                     lambda: texts, {"text": "string", "n_chars": "long"})
