"""A small element tree over Python's own ``html.parser``, used inside tasks only."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

# Elements that never have content.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Elements whose content is not text of the page.
SILENT = frozenset(("script", "style", "template"))


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag = tag
        self.attrs = attrs
        self.children: list[Element | str] = []

    def classes(self) -> list[str]:
        return self.attrs.get("class", "").split()

    def has_class(self, wanted: str) -> bool:
        """One class token, or the whole class attribute when ``wanted`` has a space."""
        tokens = self.classes()
        return wanted in tokens or " ".join(tokens) == wanted

    def walk(self) -> Iterator[Element]:
        """Descendants in document order, without recursion."""
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, Element):
                    yield child
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()

    def all(self, tag: str, css: str | None = None) -> Iterator[Element]:
        for node in self.walk():
            if node.tag == tag and (css is None or node.has_class(css)):
                yield node

    def first(self, tag: str, css: str | None = None) -> Element | None:
        return next(self.all(tag, css), None)

    def strings(self) -> Iterator[str]:
        stack = [iter(self.children)]
        while stack:
            for child in stack[-1]:
                if isinstance(child, str):
                    yield child
                elif child.tag not in SILENT:
                    stack.append(iter(child.children))
                    break
            else:
                stack.pop()

    def raw_text(self) -> str:
        return "".join(self.strings())

    def text(self) -> str:
        """Each text node stripped, then joined with nothing between."""
        return "".join(part.strip() for part in self.strings())

    def remove(self, unwanted: Callable[[Element], bool]) -> None:
        """Delete every descendant ``unwanted`` says yes to, with all it contains."""
        stack = [self]
        while stack:
            node = stack.pop()
            elements = [c for c in node.children if isinstance(c, Element)]
            gone = {id(c): c for c in elements if unwanted(c)}
            node.children = [c for c in node.children if id(c) not in gone]
            stack.extend(c for c in elements if id(c) not in gone)
            for element in gone.values():
                for inner in (element, *list(element.walk())):
                    inner.children = []


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("", {})
        self.open = [self.root]
        self.open_names: Counter[str] = Counter()
        self.in_text = False

    def handle_starttag(self, tag, attrs):
        self.in_text = False
        node = Element(tag, {name: value or "" for name, value in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.open_names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        # An end tag closes up to the nearest open element of its name; a stray one is
        # ignored. Nothing else closes an element.
        self.in_text = False
        if not self.open_names[tag]:
            return
        closed = None
        while closed != tag:
            closed = self.open.pop().tag
            self.open_names[closed] -= 1

    def handle_data(self, data):
        # The parser may hand over one text node in pieces.
        siblings = self.open[-1].children
        if self.in_text:
            siblings[-1] += data
        else:
            siblings.append(data)
        self.in_text = True

    def handle_comment(self, data):
        self.in_text = False

    handle_decl = handle_pi = unknown_decl = handle_comment


# Elements whose content the parser reads by other rules, in some version of it.
RAW = frozenset(
    "script style title textarea iframe noembed noframes noscript xmp plaintext".split()
)
# Fixed value: tags remembered at most; pages of one site share most of their tags.
REMEMBERED = 4096
_NAME = r"[a-zA-Z][-a-zA-Z0-9_:.]*"
_ATTRIBUTE = re.compile(rf"""({_NAME})(?:="([^"]*)"|='([^']*)')?""")
# What stands between < and >, as far as every version of the parser reads it the same way.
_START = re.compile(
    rf"""([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r]+{_NAME}(?:="[^"&]*"|='[^'&]*')?)*)[ \t\n\r]*(/?)"""
)
_END = re.compile(r"/([a-zA-Z][a-zA-Z0-9]*)")
_DOCTYPE = re.compile(r"""!(?:DOCTYPE|doctype) [^"'\[\]]*""")
_tags: dict[str, tuple] = {}


def _read_tag(inner: str) -> tuple | None:
    """(start name, attributes, whether it holds nothing, whether it is one of ``RAW``, end
    name) of a plain tag. Elements share the attributes, which nobody changes."""
    start = _START.fullmatch(inner)
    if start:
        attributes = {name.lower(): one or two for name, one, two in _ATTRIBUTE.findall(start[2])}
        tag = start[1].lower()
        read = (tag, attributes, bool(start[3]) or tag in VOID, tag in RAW, "")
    elif end := _END.fullmatch(inner):
        read = ("", None, False, False, end[1].lower())
    elif _DOCTYPE.fullmatch(inner):
        read = ("", None, False, False, "")
    else:
        return None
    if len(_tags) >= REMEMBERED:
        _tags.clear()
    _tags[inner] = read
    return read


def _parse_plain(html: str) -> Element | None:
    """The tree of a page in plain markup, cut at every <; None for any other page. It is the
    tree that ``_Builder`` makes, several times faster."""
    root = Element("", {})
    opened, open_names, remembered = [root], {}, _tags.get
    children, raw, comment, held = root.children, "", False, []
    text, *chunks = html.split("<")
    if text:
        children.append(unescape(text) if "&" in text else text)
    for chunk in chunks:
        if raw and not chunk.startswith(f"/{raw}>"):
            # Scripts and styles may hold anything but what looks like their end.
            if raw not in ("script", "style") or chunk.startswith("!--"):
                return None
            if chunk[:1] == "/" and chunk[1:].lstrip().lower().startswith(raw):
                return None
            held.append(chunk)
            continue
        if held:
            content = "<".join(held)
            if content:
                children.append(content)
            held = []
        if comment or chunk[:3] == "!--":
            body = chunk if comment else chunk[3:]
            end = body.find("--")
            if (not comment and body.startswith((">", "->"))) or (end >= 0 and body[end + 2 : end + 3] != ">"):
                return None
            comment = end < 0
            if comment:
                continue
            text = body[end + 3 :]
        else:
            inner, closing, text = chunk.partition(">")
            if not closing:
                return None
            read = remembered(inner) or _read_tag(inner)
            if read is None:
                return None
            tag, attributes, empty, special, closing = read
            if tag:
                node = Element(tag, attributes)
                children.append(node)
                if special:
                    if empty:
                        return None
                    raw = tag
                if not empty:
                    opened.append(node)
                    open_names[tag] = open_names.get(tag, 0) + 1
                    children = node.children
                    if special and tag in ("script", "style"):
                        held = [text]
                        continue
            elif closing:
                raw = ""
                if open_names.get(closing):
                    closed = opened.pop().tag
                    open_names[closed] -= 1
                    while closed != closing:
                        closed = opened.pop().tag
                        open_names[closed] -= 1
                    children = opened[-1].children
        if text:
            if "&" in text:
                if raw and raw != "title":
                    return None
                text = unescape(text)
            children.append(text)
    return None if raw or comment else root


def parse(html: str | None) -> Element:
    plain = _parse_plain(html or "")
    if plain is not None:
        return plain
    builder = _Builder()
    builder.feed(html or "")
    builder.close()
    return builder.root


class _Spans(HTMLParser):
    """Places in the source of elements that ``drop`` chooses by their attributes."""

    def __init__(self, html: str, drop: Callable[[dict[str, str]], bool]):
        super().__init__(convert_charrefs=False)
        self.drop, self.source = drop, html
        self.lines = [0, *[i + 1 for i, c in enumerate(html) if c == "\n"]]
        self.open: list[tuple[str, int | None]] = []
        self.spans: list[tuple[int, int]] = []
        self.feed(html)
        self.close()
        self._shut(0, len(html))

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def _shut(self, depth: int, end: int) -> None:
        self.spans += [(start, end) for _, start in self.open[depth:] if start is not None]
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        at = self._at()
        chosen = self.drop({name: value or "" for name, value in attrs})
        if tag not in VOID:
            self.open.append((tag, at if chosen else None))
        elif chosen:
            self.spans.append((at, at + len(self.get_starttag_text())))

    def handle_startendtag(self, tag, attrs):
        # Closed at once, as in the tree: it holds nothing.
        at = self._at()
        if self.drop({name: value or "" for name, value in attrs}):
            self.spans.append((at, at + len(self.get_starttag_text())))

    def handle_endtag(self, tag):
        at = self._at()
        depth = next((i for i in reversed(range(len(self.open))) if self.open[i][0] == tag), None)
        if depth is None:
            return
        self._shut(depth + 1, at)
        end = self.source.find(">", at) + 1
        self._shut(depth, end or len(self.source))


def without(html: str, drop: Callable[[dict[str, str]], bool]) -> str:
    """The source without the chosen elements and all they hold."""
    parts, done = [], 0
    for start, end in sorted(_Spans(html, drop).spans):
        if start >= done:
            parts.append(html[done:start])
        done = max(done, end)
    return "".join([*parts, html[done:]])
