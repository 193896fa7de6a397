"""A page as a sequence of text blocks, each with the features of its place and text."""

from __future__ import annotations

import functools
import html
import re

# Comments, declarations and tags; quoted attribute values may hold '>'.  The
# possessive quantifiers keep damaged markup linear.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
SPLIT = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Their content is no text of the page.  Without an end tag, that of the first two lasts to the end of the page, that of the others is read on.
RAW = {"script", "style", "title", "textarea", "select"}
TO_THE_END = {"script", "style"}
# Elements that may stand inside a sentence and whose content is read where it stands.
EMBEDDED = {"noscript", "iframe", "object", "canvas", "video", "audio", "svg", "math"}
# Inside these all tags are part of the line, but for the tags of HTML that a page uses behind an unclosed one.
FOREIGN = {"svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark",
          "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "ruby", "rt", "rp"}
# An opening tag of the key ends an open element of the set, up to a container.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "tbody", "thead", "div", "section", "article", "main", "aside", "nav", "body", "form"}
PLACES = {"article", "main", "nav", "footer", "header", "aside", "form", "section", "div", "ul", "ol", "li", "table", "td", "p", "h1", "h2",
          "h3", "h4", "blockquote", "pre", "figure", "figcaption", "button", "label", "fieldset", "details", "address", "menu", "dialog", "dl",
          "template", *EMBEDDED}
BREAKS_OUT = PLACES - EMBEDDED - {"label"} | {"body", "br", "center", "dd", "dt", "h5", "h6", "hr", "tbody", "thead", "tr", "th", "b", "em", "i", "strong", "span", "img"}

# What names in class, id and role say, by the beginning of a word.
GROUPS = {
    "content": ("content", "article", "post", "entry", "story", "main", "text", "page", "body", "prose", "blog", "news"),
    "menu": ("nav", "menu", "breadcrumb", "crumb", "toc", "tab", "pag", "pager", "skip"),
    "top": ("header", "masthead", "top", "brand", "logo", "hero"),
    "bottom": ("foot", "bottom", "copyright", "legal", "colophon", "credit", "contentinfo"),
    "side": ("side", "aside", "rail", "widget", "related", "recommend", "trending", "popular", "teaser", "complementary", "more", "see"),
    "advert": ("ad", "ads", "advert", "sponsor", "promo", "banner", "dfp", "commercial", "adsense", "affiliate", "outbrain", "taboola"),
    "notice": ("notice", "cookie", "consent", "gdpr", "alert", "popup", "modal", "overlay", "subscribe", "newsletter", "paywall", "disclaimer",
               "toast", "privacy", "dialog", "hint", "message", "announcement"),
    "comment": ("comment", "reply", "replies", "disqus", "respond", "discussion", "feedback", "reader", "thread", "review", "user"),
    "form": ("form", "search", "login", "signup", "register", "contact", "input", "field"),
    "social": ("share", "sharing", "social", "follow", "tweet", "like", "tag", "meta", "byline", "author"),
}
# Short names mean this only as a whole word.
WHOLE = {"ad", "ads", "top", "tab", "see", "tag", "nav", "pag", "more", "side", "like", "user", "foot", "page", "body", "post", "text", "main", "toc",
         "meta", "news", "blog", "rail", "form", "field", "hint"}
STARTS = [(name, group) for group, names in GROUPS.items() for name in names if name not in WHOLE]
_groups: dict[str, tuple[str, ...]] = {}


def groups_of(word: str) -> tuple[str, ...]:
    if word not in _groups:
        if len(_groups) > 50_000:
            _groups.clear()
        _groups[word] = tuple({g for g, names in GROUPS.items() if word in names or (word.endswith("s") and word[:-1] in names)}
                              | {g for name, g in STARTS if word.startswith(name)})
    return _groups[word]


def names_of(attrs: str) -> tuple[set[str], bool]:
    """The groups that class, id and role name, and whether the element is hidden."""
    found, hidden = set(), False
    for m in ATTRIBUTE.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id", "role", "data-role", "aria-label", "itemprop"):
            for word in SPLIT.split(CAMEL.sub("-", html.unescape(value)).lower()):
                found.update(groups_of(word) if word else ())
        elif key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value)):
            hidden = True
    return found, hidden


class Open:
    """An open element: its tag, the features of its place, whether it is in a link, and whether it is in a formula or drawing."""
    __slots__ = ("tag", "features", "link", "foreign")

    def __init__(self, tag: str, features: frozenset[str], link: bool, foreign: bool = False) -> None:
        self.tag, self.features, self.link, self.foreign = tag, features, link, foreign


def opened(above: Open, tag: str, attrs: str) -> Open:
    extra = set()
    if tag in PLACES:
        extra.add(f"in {tag}")
    if attrs and attrs != "/":
        named, hidden = names_of(attrs)
        if tag not in INLINE and tag not in FOREIGN and not above.foreign:
            extra |= {f"named {g}" for g in named}
        if hidden and tag not in FOREIGN and not above.foreign:
            extra.add("hidden")
    return Open(tag, above.features | extra if extra else above.features, above.link or tag == "a", above.foreign or tag in FOREIGN)


def text_features(text: str, n: int, linked: int) -> list[str]:
    words = text.count(" ") + 1
    share = linked / max(1, n)
    out = [f"words {min(words.bit_length(), 7)}", "links none" if not linked else "links few" if share < 0.3 else "links some" if share < 0.8 else "links all"]
    last = text[-1]
    out.append("ends sentence" if last in ".!?…。！？\"”»" else "ends open")
    stops = text.count(". ") + text.count(", ") + text.count("? ") + text.count("! ")
    out.append(f"stops {min(stops.bit_length(), 3)}")
    if "©" in text or "(c)" in text.lower():
        out.append("copyright sign")
    if "|" in text or "·" in text or "»" in text:
        out.append("separators")
    if sum(map(str.isdigit, text)) * 4 > n:
        out.append("digits")
    return out


@functools.cache
def end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I)


def blocks(page: str | None) -> list[tuple[str, list[str]]]:
    """(text, features) of every leaf block with text, in page order.

    Character references are decoded and white space inside a block is one
    space.  Only scripts, styles, titles, text areas and selections are skipped.
    Formulas, drawings, objects, frames and what stands for scripts are read
    where they stand, as part of their sentence.  Broken markup is read as far
    as it goes: unclosed elements last to the end of what holds them, drawings
    and formulas to the next tag of HTML, scripts and styles to the end of the
    page; unmatched end tags are ignored.
    """
    if not page:
        return []
    out: list[tuple[str, list[str]]] = []
    base = Open("", frozenset(), False)
    stack = [base]
    parts: list[str] = []
    linked = 0
    place = base

    def add(piece: str) -> None:
        nonlocal linked, place
        if not piece:
            return
        if "&" in piece:
            piece = html.unescape(piece)
        if not parts or not place_set[0]:
            if piece.strip():
                place, place_set[0] = stack[-1], True
        parts.append(piece)
        if stack[-1].link:
            linked += len("".join(piece.split()))

    place_set = [False]

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((text, [*place.features, f"leaf {place.tag if place.tag in PLACES or place.tag == 'a' else 'other'}",
                                   *text_features(text, len(text) - text.count(" "), linked)]))
            parts.clear()
        linked = 0
        place_set[0] = False

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at:m.start()])
        at = m.end()
        tag = m["tag"] or m["tag2"]
        if tag is None:
            continue
        tag, closing, attrs = tag.lower(), m["end"] or m["end2"], m["attrs"] or m["attrs2"] or ""
        if stack[-1].foreign and tag in BREAKS_OUT and (not closing or any(o.tag == tag and not o.foreign for o in stack)):
            while stack[-1].foreign:
                stack.pop()
        if stack[-1].foreign and tag not in FOREIGN:
            if tag in RAW and not closing:
                stop = end_of(tag).search(page, at)
                at = stop.end() if stop and not attrs.rstrip().endswith("/") else at
            elif tag in ("text", "tspan", "mtext"):
                add(" ")
            continue
        in_line = tag in INLINE or tag in EMBEDDED
        if closing:
            if not in_line:
                end_block()
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            # An inline end tag does not close blocks; that of an embedded element ends what is open in it.
            if depth and any(o.tag not in INLINE and o.tag not in EMBEDDED for o in stack[depth + 1:]):
                if tag in INLINE:
                    continue
                end_block()
            if depth:
                del stack[depth:]
            continue
        if not in_line:
            end_block()
        if tag in VOID or tag == "head":
            continue
        if tag in RAW:
            stop = end_of(tag).search(page, at)
            if stop or tag in TO_THE_END:
                at = stop.end() if stop else n
            continue
        if not in_line:
            # A block ends an open paragraph; items end items before them.
            ends = ENDS.get(tag, set()) | {"p"}
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    del stack[i:]
                    break
                if stack[i].tag in SCOPE:
                    break
        if tag in FOREIGN and attrs.rstrip().endswith("/"):
            continue
        stack.append(opened(stack[-1], tag, attrs))
    end_block()
    return out
