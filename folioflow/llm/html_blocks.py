"""Leaf text blocks of an HTML page with the features of their ancestors and text."""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections import Counter

#: no part of a tag is tried twice (possessive), so a match takes time in proportion to what it reads
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^>\"'])*+)>|([^<]+|<)", re.S)
_TAG = re.compile(r"</?[a-zA-Z]")
_SIGN = re.compile("[\"'>]")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

#: fixed values of the HTML language: elements without content, with text that is not shown, and inside a line
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg math iframe object canvas audio video select datalist".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img br nobr".split())
#: a start tag of the first kind ends an open element of the second
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol table dl div article section aside nav main body".split())

#: fixed values: words that stand for page furniture in English, German, French and Spanish
CUES = ("©", "copyright", "all rights", "cookie", "privacy", "newsletter", "subscribe", "sign up", "signup", "log in", "login", "sign in",
        "advert", "sponsor", "share this", "reply", "related", "read more", "menu", "search", "datenschutz", "impressum", "anmelden",
        "werbung", "kommentar", "antworten", "confidentialité", "s'abonner", "publicité", "commentaire", "répondre", "privacidad",
        "suscr", "publicidad", "comentario", "responder")
_COMMENTS = re.compile(r"comments?\b")


def count_cues(text: str) -> int:
    """How often the whole text holds a cue."""
    low = text.lower()
    n = sum(low.count(c) for c in CUES if c in low)
    return n + len(_COMMENTS.findall(low)) if "comment" in low else n


def _element(tag: str, attributes: str) -> tuple[str, ...]:
    """Features of one element: its tag, the words of its class, id and role, and whether it is hidden."""
    out = ["a:" + tag]
    if attributes and not attributes.isspace():
        for name, value in _ATTRIBUTE.findall(attributes):
            name = name.lower()
            if name in ("class", "id", "role", "itemprop", "aria-label"):
                out += ["c:" + p.lower() for p in _PART.findall(value)]
            elif name == "hidden" or name == "aria-hidden" and "true" in value or name == "style" and re.search(
                    r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                out.append("hidden")
    return tuple(dict.fromkeys(out))


class _TagEnds:
    """Whether the tag that starts at a place has an end, for pages with a tag that has none (one pass from the back)."""

    def __init__(self, page: str):
        self.at = [m.start() for m in _SIGN.finditer(page)]
        n = len(self.at)
        self.ends = [False] * (n + 1)                # by the next sign, outside of quotes
        quote = {'"': n, "'": n}                     # the next quote of either kind
        for i in range(n - 1, -1, -1):
            c = page[self.at[i]]
            if c == ">":
                self.ends[i] = True
            else:
                j = quote[c]
                self.ends[i] = j < n and self.ends[j + 1]
                quote[c] = i

    def has_end(self, start: int) -> bool:
        return self.ends[bisect_left(self.at, start)]


def _bucket(x: float, edges) -> int:
    return sum(x >= e for e in edges)


def blocks(page: str) -> list[tuple[str, tuple, tuple]]:
    """``(text, ancestor features, text features)`` of every block of the page, in order."""
    raw_end = None
    stack: list[tuple[str, tuple]] = []              # open elements with the features down to them
    path: tuple = ()
    text: list[str] = []
    linked, in_link = 0, 0
    found: list[tuple[str, tuple, int, str]] = []
    at, size = 0, len(page)
    last = page.rfind(">")
    ends: _TagEnds | None = None
    open_tags: Counter = Counter()

    def flush():
        nonlocal linked
        if text:
            t = " ".join("".join(text).split())
            if t:
                leaf = next((x for x, _ in reversed(stack) if x not in INLINE), "")
                found.append((t, path, linked, leaf))
            text.clear()
        linked = 0

    def close(k: int):
        nonlocal path, in_link
        in_link -= sum(x == "a" for x, _ in stack[k:])
        open_tags.subtract(x for x, _ in stack[k:])
        del stack[k:]
        path = stack[-1][1] if stack else ()

    while at < size:
        # a sign that starts no tag is text; comments may be open to the end
        if page[at] == "<" and not page.startswith("<!--", at) and (
                at > last or ends is not None and _TAG.match(page, at) and not ends.has_end(at)):
            text.append("<")
            at += 1
            continue
        m = _TOKEN.match(page, at)
        if m[4] == "<" and ends is None and _TAG.match(page, at):
            ends = _TagEnds(page)                    # a tag without an end
        at = m.end()
        if m[4] is not None:
            t = html.unescape(m[4])
            text.append(t)
            if in_link:
                linked += len(t.split())
            continue
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if not open_tags[tag]:
                if tag not in INLINE:
                    flush()
            elif tag in INLINE:
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag or stack[k][0] not in INLINE), -1)
                if k >= 0 and stack[k][0] == tag:
                    close(k)
            else:
                flush()
                k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), -1)
                if k >= 0:
                    close(k)
            continue
        if tag in RAW:                               # nothing inside is page text
            if not m[3].rstrip().endswith("/"):
                raw_end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = raw_end.end() if raw_end else size
            if tag not in INLINE:
                text.append(" ")
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag not in INLINE:
            flush()
            closed = SAME.get(tag, ())
            found_open = any(open_tags[x] for x in closed) or tag in CLOSES_P and open_tags["p"]
            for k in range(len(stack) - 1, -1, -1) if found_open else ():
                if stack[k][0] in closed or tag in CLOSES_P and stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in SCOPE:
                    break
        if tag == "a":
            in_link += 1
        own = _element(tag, m[3]) if tag not in INLINE or "=" in m[3] and tag != "a" else ()
        new = tuple(x for x in own if x not in path)
        path = path + new if new else path
        stack.append((tag, path))
        open_tags[tag] += 1
    flush()

    out, n = [], len(found)
    for k, (t, p, links, leaf) in enumerate(found):
        words = t.count(" ") + 1
        f = ("bias", "l:" + leaf, f"w:{_bucket(words, (2, 5, 10, 25))}", f"k:{_bucket(links / words, (0.01, 0.4, 0.8))}",
             "end" if t[-1] in ".!?…:;\"”»" else "noend", f"pos:{_bucket(k / n, (0.1, 0.3, 0.7, 0.9))}")
        cues = count_cues(t)
        if cues:
            f += ("cue", f"cue{_bucket(words, (5, 25))}", f"cues{_bucket(cues / words, (0.01, 0.05, 0.2))}")
        out.append((t, p, f))
    return out
