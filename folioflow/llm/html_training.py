"""Labelled pages for the block CRF, laid out at random from common page structures.

Each page is a list of parts; a part is HTML whose text blocks all carry one
label.  Words are random, so the model cannot learn texts: it has to learn the
structure around them and the shape of blocks.
"""

from __future__ import annotations

import random

#: fixed values: names that pages give to their parts
MAIN = ["content", "post", "entry-content", "article-body", "story", "main-content", "text", "page-content", "body-copy",
        "post-body", "articleText", "blog-post", "single", "prose", "markdown", "entry", "article", "main", "story-body"]
FURNITURE = {
    "nav": ["nav", "menu", "navbar", "main-menu", "top-nav", "breadcrumb", "breadcrumbs", "navigation", "toc", "pagination"],
    "header": ["header", "site-header", "masthead", "top-bar", "logo", "branding", "tagline", "site-title"],
    "footer": ["footer", "site-footer", "copyright", "legal", "colophon", "bottom", "imprint"],
    "aside": ["sidebar", "side", "related", "widget", "recommended", "popular", "trending", "more-stories", "teaser", "rail"],
    "notice": ["cookie-notice", "consent", "gdpr", "notice", "alert", "banner", "popup", "modal", "privacy-banner", "cookies",
               "overlay", "message-bar"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "adbox", "sponsor", "commercial"],
    "form": ["newsletter", "subscribe", "signup", "search", "login", "contact-form", "search-form", "register"],
    "comments": ["comments", "comment", "comment-list", "responses", "replies", "discussion", "comment-body", "disqus"],
    "share": ["share", "social", "sharing", "share-bar", "follow-us", "tags", "byline-links", "tools"],
}
#: phrases of page furniture that articles hold now and then, too
PHRASES = ["All rights reserved", "Copyright 2020", "Licensed under a public license", "read more", "comments", "reply", "cookies",
           "subscribe", "menu", "search", "privacy", "sign up", "related"]

#: stands in front of each sentence of the article; block features do not see it
MARK = "\ue000"


class _Page:
    def __init__(self, rng: random.Random):
        self.rng = rng
        parts = ["an", "er", "th", "in", "on", "re", "é", "sch", "ción", "ou", "ti", "ng", "le", "ment", "ü", "ß", "os", "ka"]
        self.mark = ""
        self.words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(80)]

    def sentence(self, lo: int, hi: int) -> str:
        r = self.rng
        w = r.choices(self.words, k=r.randint(lo, hi))
        if r.random() < (0.08 if self.mark else 0.15):
            w = [r.choice(PHRASES)] + (w if r.random() < 0.5 else [])
        style = r.random()
        if style < 0.08:
            w = [x.upper() + r.choice(["!!", "!", ""]) for x in w]
        elif style < 0.16:
            w = [x + r.choice(["***", "###", "$$$", "%%%", "&amp;&amp;&amp;"]) for x in w]
        elif style < 0.2:
            w = [x + " |" for x in w]
        elif style < 0.26:
            w = [x + r.choice(["", "", " " + str(r.randint(1, 2030))]) for x in w]
        return self.mark + " ".join(w).capitalize() + r.choice([".", ".", ".", "", "?", "!"])

    def paragraph(self) -> str:
        r = self.rng
        k = r.choice([1, 1, 2, 4, 8])
        t = " ".join(self.sentence(1 if r.random() < 0.2 else 4, 14) for _ in range(k))
        if r.random() < 0.15:
            t = f'<a href="/x">{t}</a>' if r.random() < 0.2 else f'{t} <a href="/x">{self.sentence(1, 4)}</a> {self.sentence(1, 6)}'
        if r.random() < 0.2:
            t = f"<b>{t}</b>" if r.random() < 0.5 else f"<b>{t}"
        return t + ("<br>" if r.random() < 0.1 else "")

    def content(self) -> str:
        r, out = self.rng, []
        if r.random() < 0.85:
            h = f"<h1>{self.sentence(1, 10)}</h1>"
            out.append(f"<header>{h}</header>" if r.random() < 0.1 else h)
        for _ in range(r.choice([1, 2, 4, 8, 15])):
            kind = r.random()
            if kind < 0.75:
                p = r.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<div>{}</div>", "<section><p>{}</p></section>"])
                out.append(p.format(self.paragraph()))
            elif kind < 0.83:
                h = f"h{r.randint(2, 4)}"
                out.append(f"<{h}>{self.sentence(1, 6)}</{h}>")
            elif kind < 0.9:
                t = r.choice(["ul", "ol"])
                out.append(f"<{t}>" + "".join(f"<li>{self.sentence(1, 12)}</li>" for _ in range(r.randint(2, 5))) + f"</{t}>")
            elif kind < 0.95:
                out.append(f"<blockquote>{self.paragraph()}</blockquote>")
            else:
                out.append("<table>" + "".join(f"<tr><td>{self.sentence(1, 3)}</td><td>{self.sentence(1, 3)}</td></tr>"
                                               for _ in range(2)) + "</table>")
        return "".join(out)

    def furniture(self, kind: str) -> str:
        r = self.rng
        name = r.choice(FURNITURE[kind])
        attr = r.choice([f' class="{name}"', f' id="{name}"', f' class="{name} {r.choice(["wide", "box", "clearfix"])}"', ""])
        links = lambda: "<ul>" + "".join(f'<li><a href="/{k}">{self.sentence(1, 2)}</a></li>' for k in range(r.randint(2, 7))) + "</ul>"
        texts = lambda: "".join(f"<p>{self.sentence(3, 14)}</p>" for _ in range(r.randint(1, 3)))
        if kind == "nav":
            return f"<nav{attr}>{links()}</nav>" if r.random() < 0.6 else f'<div class="{name}">{links()}</div>'
        if kind == "header":
            inner = r.choice([f"<a href='/'>{self.sentence(1, 3)}</a>", f"<h2>{self.sentence(1, 3)}</h2><p>{self.sentence(3, 8)}</p>",
                              links(), f"<span>{self.sentence(1, 4)}</span>"])
            return f"<header{attr}>{inner}</header>" if r.random() < 0.6 else f'<div class="{name}">{inner}</div>'
        if kind == "footer":
            inner = r.choice([f"&copy; example &middot; {self.sentence(2, 20)}", f"<p>&copy; {r.randint(1999, 2030)} {self.sentence(2, 9)}</p>",
                              links(), texts(), f"<p>Copyright {self.sentence(2, 6)} All rights reserved.</p>"])
            return f"<footer{attr}>{inner}</footer>" if r.random() < 0.7 else f'<div class="{name}">{inner}</div>'
        if kind == "aside":
            inner = f"<h3>{self.sentence(1, 3)}</h3>" + r.choice([links(), texts()])
            return f"<aside{attr}>{inner}</aside>" if r.random() < 0.5 else f'<div class="{name}">{inner}</div>'
        if kind == "form":
            inner = (f"<label>{self.sentence(1, 3)}</label><input name=q><button>{self.sentence(1, 2)}</button>"
                     + r.choice(["", f"<p>{self.sentence(3, 10)}</p>", f"<h3>{self.sentence(1, 4)}</h3>"]))
            return f"<form{attr}>{inner}</form>" if r.random() < 0.7 else f'<div class="{name}"><form>{inner}</form></div>'
        if kind == "comments":
            box = r.choice(["div", "li", "article"])
            one = lambda: f'<{box} class="comment"><b>{self.sentence(1, 2)}</b><p>{self.paragraph()}</p></{box}>'
            tag = r.choice(["section", "div", "ol"])
            return f'<{tag} id="{name}"><h3>{self.sentence(1, 2)}</h3>' + "".join(one() for _ in range(r.randint(1, 4))) + f"</{tag}>"
        inner = r.choice([self.sentence(3, 16), texts(), f"<p>{self.sentence(3, 12)}</p><button>{self.sentence(1, 2)}</button>",
                          f'{self.sentence(2, 8)} <a href="/x">{self.sentence(1, 3)}</a>'])
        return f'<{(t := r.choice(["div", "div", "section", "p", "span"]))} class="{name}">{inner}</{t}>'

    def article(self, part) -> str:
        self.mark = MARK
        out = part()
        self.mark = ""
        return out

    def html(self) -> str:
        r = self.rng
        kinds = list(FURNITURE)
        some = lambda n, pool=kinds: [self.furniture(r.choice(pool)) for _ in range(n)]
        wrap = r.random()
        if wrap < 0.4:
            open_, close = "<article>", "</article>"
        elif wrap < 0.55:
            open_, close = f'<main><div class="{r.choice(MAIN)}">', "</div></main>"
        elif wrap < 0.85:
            tag = r.choice(["div", "section", "article"])
            open_, close = f'<{tag} {r.choice(["class", "id"])}="{r.choice(MAIN)}">', f"</{tag}>"
        elif wrap < 0.93:
            open_, close = '<div role="main">', "</div>"
        else:
            open_, close = "", ""
        if r.random() < 0.1:                         # nothing but the article
            return f"<html><body>{open_}{self.article(self.content)}{close}</body></html>"
        out = [self.furniture("nav")] if r.random() < 0.8 else []
        out += some(r.randint(0, 3), ["header", "nav", "notice", "ad", "form", "share"])
        out += [open_, self.article(self.content)]
        while r.random() < 0.3:                      # furniture in the middle of the article
            out += some(1, ["ad", "aside", "share", "form", "notice", "nav"]) + [self.article(
                lambda: "".join(f"<p>{self.paragraph()}</p>" for _ in range(r.randint(1, 4))))]
        if r.random() < 0.2:
            out += some(1, ["comments", "share", "aside"])
        out.append(close)
        out += some(r.randint(0, 3), ["comments", "aside", "ad", "form", "share", "notice"])
        if r.random() < 0.85:
            out.append(self.furniture("footer"))
        return "<html><head><title>t</title></head><body>" + "".join(out) + "</body></html>"


def labelled_pages(n: int, seed: int = 7) -> list[tuple[list, list[int]]]:
    """``(blocks, labels)`` of ``n`` pages."""
    from .html_blocks import blocks
    out = []
    for k in range(n):
        page = blocks(_Page(random.Random(f"{seed}-{k}")).html())
        if page:
            out.append((page, [int(MARK in text) for text, _, _ in page]))
    return out
