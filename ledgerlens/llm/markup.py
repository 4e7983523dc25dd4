"""Reads a web page into blocks of text, each with the part of the page that its elements name."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

#: Parts: named boilerplate, text that no element names, a named main part, a named article.
NAMED, OPEN, MAIN, ARTICLE = range(4)

# Names of HTML elements, of ARIA roles, and words in common use for classes and ids.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub "
                   "sup time tt u var wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
ENDS_ITSELF = frozenset("p li dt dd tr td th option".split())
NO_TEXT = frozenset("head script style textarea title noscript template iframe noembed noframes svg math object canvas audio video select button datalist "
                    "nav aside footer form menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar tablist status".split())
BOILERPLATE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu submenu "
    "breadcrumb breadcrumbs masthead topbar footer sidebar aside widget widgets cookie cookies consent gdpr notice notices disclaimer popup modal overlay "
    "newsletter subscribe subscription signup login search share sharing social related recommended recommendations comment comments commentlist disqus "
    "reply replies respond pagination pager toolbar skip".split())
ABOUT_LAYOUT = frozenset("has with no is without not".split())
ARTICLE_NAMES = frozenset("article article-body article-content article-text articlebody entry-content post-content post-body story-body story-content".split())
MAIN_NAMES = frozenset("main main-content maincontent main-text".split())
NAMEABLE = frozenset("div section ul ol dl table p article center fieldset".split())

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: The rest of a tag. Nothing is tried twice; a quote without its like is a character among others.
TAG_REST = re.compile(r"""(?:[^"'>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|[="'])*+>""")
RAW_END = {name: re.compile(f"</{name}(?=[\\s/>]|$)", re.IGNORECASE) for name in RAW}
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
ASKED = ("class", "id", "role", "itemprop", "hidden", "aria-hidden", "style")


class Block(NamedTuple):
    part: int
    element: str
    words: list[str]


def tag_end(page: str, start: int) -> int:
    """Place of the ``>`` that ends a tag, outside of quoted values; the end of the page without one."""
    m = TAG_REST.match(page, start)
    return m.end() - 1 if m else len(page)


def attributes(tag: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(tag):
        name = m[1].lower()
        if name in ASKED:
            value = unescape(m[2] or m[3] or m[4] or "")
            out.setdefault(name, (HUMP.sub("-", value) if name in ("class", "id") else value).lower())
    return out


def is_boilerplate_name(name: str) -> bool:
    parts = [p.rstrip("0123456789") for p in re.split(r"[-_]+", name)]
    return parts[0] not in ABOUT_LAYOUT and not BOILERPLATE.isdisjoint((name, parts[0], parts[-1]))


def part_of(element: str, given: dict[str, str], around: int) -> int:
    """The part that an element's text belongs to, inside one of part ``around``."""
    if element == "main" or given.get("role") == "main":
        return max(MAIN, around)
    if around == NAMED or element in NO_TEXT or given.get("role") in ROLES or "hidden" in given or given.get("aria-hidden") == "true":
        return NAMED
    if element == "header":
        return around if around >= MAIN else NAMED
    if not given:
        return ARTICLE if element == "article" else around
    if re.search(r"display\s*:\s*none", given.get("style", "")):
        return NAMED
    names = f"{given.get('class', '')} {given.get('id', '')}".split()
    if element in NAMEABLE and any(map(is_boilerplate_name, names)) and ARTICLE_NAMES.isdisjoint(names):
        return NAMED
    if element == "article" or given.get("role") == "article" or "articlebody" in given.get("itemprop", "") or not ARTICLE_NAMES.isdisjoint(names):
        return ARTICLE
    return around if MAIN_NAMES.isdisjoint(names) else max(MAIN, around)


def blocks(page: str) -> list[Block]:
    """Blocks in page order: part, innermost block element, words with character references decoded.

    Elements that are never closed end with the element around them. A comment or
    a script without an end takes the rest of the page. Time is linear in the page.
    """
    out: list[Block] = []
    stack: list[tuple[str, int]] = [("", OPEN)]
    opened: Counter[str] = Counter()
    pieces: list[str] = []

    def flush() -> None:
        words = "".join(pieces).split()
        if words:
            out.append(Block(stack[-1][1], next((e for e, _ in reversed(stack[-8:]) if e not in INLINE), ""), words))
        pieces.clear()

    i, n = 0, len(page)
    while i < n:
        k = page.find("<", i)
        if k < 0:
            k = n
        if k > i:
            text = page[i:k]
            pieces.append(unescape(text) if "&" in text else text)
        if k == n:
            break
        mark = page[k + 1:k + 2]
        if page.startswith("<!--", k):
            end = page.find("-->", k + 4)
            i = n if end < 0 else end + 3
            continue
        if mark in ("!", "?") or (mark == "/" and not page[k + 2:k + 3].isalpha()):
            i = tag_end(page, k) + 1 if mark == "!" or mark == "?" or page[k + 2:k + 3] else n
            continue
        closing = mark == "/"
        m = NAME.match(page, k + 1 + closing)
        if m is None:
            pieces.append("<")
            i = k + 1
            continue
        name = m[0].lower()
        end = tag_end(page, m.end())
        i = end + 1
        if name not in INLINE:
            flush()
        if closing:
            while opened[name]:
                top, part = stack[-1]
                if part != stack[-2][1]:
                    flush()
                stack.pop()
                opened[top] -= 1
                if top == name:
                    break
            continue
        if name in VOID:
            continue
        if stack[-1][0] == name and name in ENDS_ITSELF or stack[-1][0] == "p" and name not in INLINE:
            opened[stack.pop()[0]] -= 1
        rest = page[m.end():end]
        around = stack[-1][1]
        part = part_of(name, attributes(rest) if "=" in rest or "hidden" in rest else {}, around)
        if part != around:
            flush()
        if name in RAW:
            close = RAW_END[name].search(page, i)
            i = n if close is None else tag_end(page, close.end()) + 1
        elif not (rest.endswith("/") and name in ("svg", "math")):
            stack.append((name, part))
            opened[name] += 1
    flush()
    return out
