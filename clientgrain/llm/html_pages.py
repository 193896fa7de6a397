"""Labelled pages to train block labelling on, made up from many layouts.

Words are invented, so nothing can be learnt from them; what differs between
article and rest is where a block stands and what its text looks like.
"""

from __future__ import annotations

import html
import random

SYLLABLES = "an be co da el fi go ha in ju ka le mo ni or pa que ri sa te un vo wa xi yo zu ler ton mar sen vil dor".split()
BOXES = {
    "menu": ("nav", "menu", "main-nav", "navbar", "breadcrumbs", "navigation", "pagination", "site-menu"),
    "top": ("header", "masthead", "topbar", "site-header", "branding", "page-top"),
    "bottom": ("footer", "site-footer", "bottom", "copyright", "legal", "colophon"),
    "side": ("sidebar", "widget", "related-posts", "right-rail", "trending", "aside-box", "more-stories"),
    "advert": ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner-ad", "ad-slot"),
    "notice": ("notice", "cookie-banner", "consent", "alert", "newsletter", "popup", "subscribe-box", "gdpr", "paywall-message"),
    "comment": ("comments", "comment-list", "comment", "replies", "disqus", "reader-comments", "discussion"),
    "form": ("search-form", "login", "signup", "contact-form", "searchbox"),
    "social": ("share", "social-links", "follow-us", "sharing-buttons", "post-meta"),
}
CONTENT = ("content", "post", "entry-content", "article-body", "story", "main-text", "post-content", "text", "page-content", "c1", "x-12", "wrap")


class Page:
    """A page under construction: markup, and the label of each block in order."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)
        self.out: list[str] = []
        self.truth: list[tuple[str, int]] = []

    def words(self, least: int, most: int) -> str:
        return " ".join("".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 4))) for _ in range(self.r.randint(least, most)))

    def sentences(self, least: int, most: int) -> str:
        if self.r.random() < 0.12:
            return " | ".join(self.words(1, 2) for _ in range(self.r.randint(3, 25)))
        return " ".join(self.words(1, 16).capitalize() + self.r.choice(["., ".strip(), ".", ".", "?", "!"]).replace(",", "") for _ in range(self.r.randint(least, most)))

    def block(self, tag: str, text: str, label: int, attrs: str = "", closed: bool = True) -> None:
        shown = html.escape(text, quote=False)
        if self.r.random() < 0.05:
            inside, kind = self.words(1, 2), self.r.choice(["math", "noscript", "object", "svg"])
            held = {"math": f"<math><mi>{inside}</mi></math>", "svg": f'<svg class="icon"><title>no</title><path d="M0"/><text>{inside}</text></svg>'}
            shown += " " + held.get(kind, f"<{kind}>{inside}</{kind}>")
            text += f" {inside}"
        if self.r.random() < 0.15 and label:
            shown = f"<{self.r.choice(['b', 'em', 'span', 'strong'])}>{shown}"  # an inline element left open
        self.out.append(f"<{tag}{attrs}>{shown}" + (f"</{tag}>" if closed else ""))
        self.truth.append((text, label))

    def links(self, tag: str, n: int, label: int = 0) -> None:
        self.out.append(f"<{tag}>")
        for _ in range(n):
            text = self.words(1, 12 if label else 3)
            self.out.append(f'<li><a href="/{text}">{html.escape(text)}</a>' + ("</li>" if self.r.random() < 0.8 else ""))
            self.truth.append((text, label))
        self.out.append(f"</{tag}>")

    def box(self, kind: str) -> None:
        r = self.r
        held = r.choice(["noscript", "iframe", "object", "template"]) if kind in ("advert", "notice", "side") and r.random() < 0.1 else None
        if held:
            self.out.append(f"<{held}>")
        semantic = {"menu": "nav", "top": "header", "bottom": "footer", "side": "aside", "form": "form"}.get(kind)
        tag = semantic if semantic and r.random() < 0.6 else r.choice(["div", "section", "div"])
        named = tag not in ("nav", "header", "footer", "aside", "form") or r.random() < 0.4
        name = r.choice(BOXES[kind])
        self.out.append(f"<{tag}" + (f' {r.choice(["class", "class", "id"])}="{name}"' if named else "") + ">")
        if kind == "menu" or kind == "social":
            self.links(r.choice(["ul", "ul", "ol", "div"]) if kind == "menu" else "ul", r.randint(1, 8))
        elif kind == "top":
            self.block(r.choice(["div", "h1", "p", "h2"]), self.words(1, 6), 0)
            if r.random() < 0.5:
                self.links("ul", r.randint(2, 6))
        elif kind == "bottom":
            self.block(r.choice(["p", "div", "span"]), "© " + self.words(1, 4) + r.choice([" · ", ". ", " "]) + self.sentences(1, 3), 0)
            if r.random() < 0.4:
                self.links("ul", r.randint(1, 5))
        elif kind == "form":
            self.block("label", self.words(1, 3), 0)
            self.out.append('<input type="text">')
            self.block("button", self.words(1, 2), 0)
        elif kind == "comment":
            for _ in range(r.randint(1, 5)):
                self.block(r.choice(["p", "div", "li"]), self.sentences(1, 5), 0)
        else:
            if r.random() < 0.4:
                self.block(r.choice(["h3", "h4", "p"]), self.words(1, 4), 0)
            for _ in range(r.randint(1, 3)):
                self.block(r.choice(["p", "div", "p"]), self.sentences(1, 4), 0)
            if kind == "side" and r.random() < 0.6:
                self.links("ul", r.randint(2, 6))
        self.out.append(f"</{tag}>" + (f"</{held}>" if held else ""))

    def article(self) -> None:
        r = self.r
        tag = r.choice(["article", "article", "main", "div", "section", "div"])
        named = tag in ("div", "section") or r.random() < 0.3
        self.out.append(f"<{tag}" + (f' {r.choice(["class", "id"])}="{r.choice(CONTENT)}"' if named else "") + ">")
        if r.random() < 0.85:
            self.block(r.choice(["h1", "h1", "h2"]), self.sentences(1, 1) if r.random() < 0.5 else self.words(2, 10), 1)
        for _ in range(r.choice([1, 2, 4, 8, 15])):
            kind = r.random()
            if kind < 0.7:
                self.block("p", self.sentences(1, r.choice([1, 3, 8, 20])), 1, closed=r.random() < 0.85)
            elif kind < 0.78:
                self.block(r.choice(["h2", "h3"]), self.words(1, 6), 1)
            elif kind < 0.84:
                self.out.append("<ul>")
                for _ in range(r.randint(1, 4)):
                    self.block("li", self.sentences(1, 2), 1)
                self.out.append("</ul>")
            elif kind < 0.9:
                self.block(r.choice(["blockquote", "pre", "figcaption", "div"]), self.sentences(1, 3), 1)
            elif kind < 0.92:
                self.block("p", self.words(1, 2) + ".", 1)
            elif kind < 0.94:
                self.links(r.choice(["ul", "ol"]), r.randint(1, 5), 1)
            elif kind < 0.955:
                held = r.choice(["noscript", "object", "canvas", "iframe", "template", "video"])
                self.out.append(f"<{held}>")
                self.block("p", self.sentences(1, 3), 1)
                self.out.append(f"</{held}>")
            else:
                self.box(r.choice(["advert", "social", "notice", "side", "advert"]))
        if r.random() < 0.15:
            self.box(r.choice(["comment", "social"]))
        self.out.append(f"</{tag}>")

    def whole(self) -> str:
        r = self.r
        title = self.words(2, 8)
        self.out.append(f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style>'
                        '<script>var t="</p><p>";</script></head><body>')
        for kind in ("top", "menu", "notice", "form", "advert"):
            if r.random() < 0.55:
                self.box(kind)
        if r.random() < 0.3:
            self.out.append(f'<div class="{r.choice(["wrap", "container", "row", "layout"])}">')
        if r.random() < 0.2:
            self.box("side")
        self.article()
        for kind in ("side", "comment", "social", "advert", "form", "notice", "menu", "bottom"):
            if r.random() < (0.8 if kind == "bottom" else 0.35):
                self.box(kind)
        if r.random() < 0.8:
            self.out.append("</body></html>")
        return "".join(self.out)


def labelled_page(seed: int) -> tuple[str, list[tuple[str, int]]]:
    """A page and the text and label (1: article) of each of its blocks."""
    page = Page(seed)
    return page.whole(), page.truth
