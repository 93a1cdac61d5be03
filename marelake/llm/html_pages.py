"""Leaf blocks of an HTML page, and a grammar of labelled pages to learn from."""

from __future__ import annotations

import html
import random
import re
from typing import NamedTuple

TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)\]\]>|<[!?][^>]*>?|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[a-z]+")
#: fixed values of the HTML standard: elements without an end, with raw text, inside a line, and those that end an open one of their kind
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea title".split())
FOREIGN = frozenset("svg math".split())
INLINE = FOREIGN | frozenset("a abbr acronym b bdi bdo big br canvas cite code data del dfn em font i img ins kbd label mark noscript object q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("ul ol dl table select body html article section main div aside nav header footer form".split())
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


#: a tag of these ends drawings and formulas that are still open; all other tags in them stand inside the line
LEAVES = ENDS_P | frozenset(CLOSES) | frozenset("body head html".split())


class Block(NamedTuple):
    tags: tuple[str, ...]
    names: frozenset[str]
    text: str
    link_chars: int


def blocks(page: str) -> list[Block]:
    """The page's runs of text between block elements, in order, with their ancestors and the names these carry."""
    out: list[Block] = []
    stack: list[tuple[str, frozenset[str]]] = []
    parts: list[str] = []
    links = 0

    def flush():
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                tags = tuple(t for t, _ in stack if t not in INLINE)
                out.append(Block(tags, frozenset().union(*(n for _, n in stack)), text, links))
            parts.clear()
        links = 0

    def drop(kinds, scopes=SCOPES):
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in kinds:
                del stack[i:]
                return
            if stack[i][0] in scopes:
                return

    def in_line(tag):
        return tag in INLINE or tag not in LEAVES and any(t in FOREIGN for t, _ in stack)

    at, end = 0, len(page)
    while at < end:
        found = TAG.search(page, at)
        piece = page[at : found.start()] if found else page[at:]
        if piece:
            parts.append(piece)
            if any(t == "a" for t, _ in stack):
                links += len(piece)
        if not found:
            break
        at = found.end()
        if found[1] is not None:
            parts.append(html.escape(found[1], quote=False))
        if not found[3]:
            continue
        tag = found[3].lower()
        if found[2]:
            if not in_line(tag):
                flush()
            drop((tag,), frozenset() if tag in SCOPES else SCOPES)
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\s*>", re.I).search(page, at) if not found[4].rstrip().endswith("/") else None
            at = close.end() if close else (at if found[4].rstrip().endswith("/") else end)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if not in_line(tag):
            flush()
            for i, (t, _) in enumerate(stack):
                if t in FOREIGN:
                    del stack[i:]
                    break
            # what stands inside a line ends with its block
            while stack and stack[-1][0] in INLINE:
                stack.pop()
            if tag in ENDS_P:
                drop(("p",))
            if tag in CLOSES:
                drop(CLOSES[tag])
        if tag not in VOID and not found[4].rstrip().endswith("/"):
            stack.append((tag, _names(found[4])))
    flush()
    return out


def _names(attributes: str) -> frozenset[str]:
    """Words of class, id and role, and whether the element is hidden."""
    if not attributes.strip():
        return frozenset()
    out = set()
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name in ("class", "id", "role", "itemprop", "aria-label"):
            out.update(NAME.findall(value))
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            out.add("(hidden)")
    return frozenset(out)


def _bucket(n: float, steps) -> int:
    return sum(n >= s for s in steps)


def features(page: list[Block]) -> list[list[str]]:
    """Names of the features that hold for each block."""
    out, last = [], max(1, len(page) - 1)
    for i, b in enumerate(page):
        words = b.text.count(" ") + 1
        size, linked = _bucket(words, (2, 4, 8, 16, 32, 64)), _bucket(b.link_chars / max(1, len(b.text)), (0.05, 0.3, 0.7))
        own = b.tags[-1] if b.tags else "-"
        f = ["always", f"tag {own}", f"words {size}", f"links {linked}", f"tag {own} words {size}", f"stop {b.text[-1] in '.!?:;…»”' or b.text[-1] == chr(34)}", f"place {_bucket(i / last, (0.1, 0.3, 0.7, 0.9))}"]
        f += [f"in {t}" for t in set(b.tags)]
        f += [f"name {n}" for n in b.names]
        f += [f"mark {m}" for m in ("©", "|", "·", "→", "»", "@") if m in b.text]
        if "article" in b.tags or "main" in b.tags:
            inner = [t for t in b.tags[b.tags.index("article" if "article" in b.tags else "main") :] if t in ("header", "footer", "nav", "aside", "form")]
            f.append(f"article with {inner[-1] if inner else 'nothing'}")
        else:
            f.append("no article")
        out.append(f)
    return out


#: fixed values: names that sites give to the parts of a page; the first list holds the article
PARTS = {
    "content": "content article post entry story main body text page articlebody postcontent".split(),
    "menu": "menu nav navbar navigation breadcrumb breadcrumbs topnav tabs links toc".split(),
    "header": "header masthead banner top logo branding".split(),
    "footer": "footer bottom copyright legal colophon foot".split(),
    "sidebar": "sidebar side aside related widget rail recommended popular trending more".split(),
    "notice": "notice cookie cookies consent gdpr alert popup modal newsletter subscribe message overlay paywall".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion banner".split(),
    "comments": "comment comments discussion replies reply reader respond disqus".split(),
    "social": "share social sharing follow buttons".split(),
    "form": "form search login signup contact".split(),
}
ELEMENTS = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "notice": "div", "advert": "div", "comments": "section", "social": "div", "form": "form"}


def labelled_pages(n: int, seed: int = 0) -> list[tuple[list[Block], list[int]]]:
    """Pages of a small grammar; a block is labelled 1 inside the article and 0 inside any other part.

    Parts come as their own element or as ``div`` with one of their usual names, in any order that sites use, and
    may stand inside the article.  The words are invented, so that only markup and shape can be learned.
    """
    r = random.Random(seed)

    def words(low, high):
        return " ".join("".join(r.choice(("ta", "ro", "mi", "en", "sol", "ka", "ver", "li", "dun")) for _ in range(r.randint(1, 4))) for _ in range(r.randint(low, high)))

    def paragraph(label):
        text = words(1, 12) if r.random() < 0.3 else words(8, 120)
        if r.random() < 0.25:
            text = text.replace(" ", f" <a href='x'>{words(1, 3)}</a> ", 1)
        return f"{mark(label)}{text.capitalize()}{r.choice(('.', '.', '.', '!', '?', '', ':'))}"

    def mark(label):
        return f"\x02{label}"

    def part(kind):
        tag = ELEMENTS[kind] if r.random() < 0.5 else r.choice(("div", "section", "ul" if kind == "menu" else "div"))
        name = r.choice(PARTS[kind])
        if tag in ("div", "section", "ul") and r.random() < 0.85 or r.random() < 0.3:
            tag_open = f"<{tag} {r.choice(('class', 'id'))}='{name}{r.choice(('', '-box', ' wide', '_1'))}'>"
        else:
            tag_open = f"<{ELEMENTS[kind]}>"
            tag = ELEMENTS[kind]
        if kind == "menu":
            body = "".join(f"<li><a href='/'>{mark(0)}{words(1, 3)}</a></li>" for _ in range(r.randint(2, 9)))
            body = body if tag == "ul" else f"<ul>{body}</ul>"
        elif kind == "header":
            body = f"<{r.choice(('div', 'p', 'h1', 'h2'))}>{mark(0)}{words(1, 6)}</p>" + (part("menu") if r.random() < 0.4 else "")
        elif kind == "footer":
            body = f"<p>{mark(0)}{r.choice(('&copy; ', '', ''))}{words(2, 25)}{r.choice((' &middot; ', ' | ', '. '))}{words(1, 20)}." if r.random() < 0.6 else f"{mark(0)}&copy; {words(1, 4)} &middot; {words(1, 20)}."
        elif kind == "comments":
            body = f"<h3>{mark(0)}{words(1, 3)}</h3>" + "".join(f"<div class='{r.choice(PARTS[kind])}'><p>{paragraph(0)}</p></div>" for _ in range(r.randint(1, 5)))
        elif kind == "form":
            body = f"<label>{mark(0)}{words(1, 4)}</label><input type='text'><button>{mark(0)}{words(1, 2)}</button>"
        elif kind == "sidebar":
            body = f"<h3>{mark(0)}{words(1, 4)}</h3>" + "".join(r.choice((f"<p>{paragraph(0)}</p>", f"<li><a href='/'>{mark(0)}{words(2, 9)}</a></li>")) for _ in range(r.randint(1, 5)))
        else:
            body = paragraph(0) if r.random() < 0.5 else f"<p>{paragraph(0)}</p>"
        return f"{tag_open}{body}</{tag}>"

    def article():
        kinds, out = ("p",) * 9 + ("h2", "ul", "blockquote", "pre", "table", "h3", "div"), []
        if r.random() < 0.8:
            title = f"<h1>{mark(1)}{words(2, 14)}</h1>"
            out.append(f"<header>{title}</header>" if r.random() < 0.15 else title)
        if r.random() < 0.3:
            out.append(f"<p>{mark(1)}<b>{words(3, 30)}.<br>")
        for _ in range(r.randint(1, 14)):
            kind = r.choice(kinds)
            if kind == "ul":
                out.append("<ul>" + "".join(f"<li>{mark(1)}{words(1, 20)}</li>" for _ in range(r.randint(1, 5))) + "</ul>")
            elif kind == "table":
                out.append(f"<table><tr><td>{mark(1)}{words(1, 4)}</td><td>{mark(1)}{words(1, 8)}</td></tr></table>")
            elif kind in ("h2", "h3"):
                out.append(f"<{kind}>{mark(1)}{words(1, 8)}</{kind}>")
            else:
                out.append(f"<{kind}>{paragraph(1)}</{kind}>" if r.random() < 0.9 else f"<{kind}>{paragraph(1)}")
            if r.random() < 0.07:
                out.append(part(r.choice(("advert", "sidebar", "notice", "social", "form"))))
        body = "".join(out) + (part("comments") if r.random() < 0.08 else "")
        how = r.random()
        if how < 0.45:
            return f"<article>{body}</article>"
        if how < 0.6:
            return f"<main>{body}</main>"
        if how < 0.9:
            return f"<div {r.choice(('class', 'id'))}='{r.choice(PARTS['content'])}'>{body}</div>"
        return body

    pages = []
    for _ in range(n):
        above = [part(k) for k in ("notice", "header", "menu", "advert", "form") if r.random() < 0.45]
        below = [part(k) for k in ("social", "advert", "comments", "sidebar", "notice", "form") if r.random() < 0.3]
        r.shuffle(below)
        middle = article()
        if r.random() < 0.2:
            middle = f"<div class='{r.choice(('wrap', 'container', 'row', 'layout'))}'>{part('sidebar')}{middle}</div>"
        page = f"<html><head><title>x</title></head><body>{''.join(above)}{middle}{''.join(below)}{part('footer') if r.random() < 0.85 else ''}</body></html>"
        found = blocks(page)
        labels = [int("\x021" in b.text) for b in found]
        clean = [b._replace(text=re.sub("\x02[01]", "", b.text).strip() or "x") for b in found]
        pages.append((clean, labels))
    return pages
