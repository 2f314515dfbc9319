"""The leaf blocks of an HTML page: runs of text without a block-level tag inside.

White space and inline tags do not end a block; start and end tags of block-level elements do.
Comments, declarations and the content of elements that hold no text to read are left out.
Unclosed and stray tags are taken as browsers do in the common cases: a tag that cannot nest in
itself closes the one before, and an end tag without a start is ignored.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

#: Elements that interrupt a line of text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup hr "
    "html label legend li main menu nav noframes ol optgroup option p pre search section select "
    "summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements without content, and elements whose content is never text to read.
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT_TAGS = ("script", "style", "noscript", "template", "textarea", "iframe", "svg", "object", "title")
#: What a start tag closes if it is open.
CLOSES = {
    **dict.fromkeys(
        "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
        "main nav ol p pre section table ul".split(),
        ("p",),
    ),
    "li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"),
    "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"),
    "option": ("option",), "body": ("head",),
}
#: A search for something to close ends at these.
SCOPES = frozenset("ul ol dl table td th div article section body html select".split())

_SILENT = "|".join(
    rf"<{t}\b[^>]*+>(?:[^<]++|<(?!/{t}\b))*+(?:</{t}\b[^>]*+>?|\Z)" for t in SILENT_TAGS
)
_TOKEN = re.compile(
    rf"(?P<skip><!--(?:[^-]++|-(?!->))*+(?:-->|\Z)|<[!?][^>]*+>?|{_SILENT})"
    r"|</(?P<end>[a-z][^\s/>]*+)[^>]*+>?"
    r"|<(?P<start>[a-z][^\s/>]*+)(?P<attributes>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<broken>[a-z][^\s/>]*+)[^>]*+>?",
    re.IGNORECASE,
)
_ATTRIBUTE = re.compile(
    r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE
)
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Block(NamedTuple):
    """A leaf block: its text, its ancestors from the root on, and how much of it is links.

    An ancestor is a tag name followed by the words of its class, id and role.
    """

    text: str
    path: tuple[str, ...]
    link_chars: int


def _ancestor(tag: str, attributes: str) -> str:
    if "=" not in attributes:
        return tag
    names = [
        word.lower()
        for found in _ATTRIBUTE.findall(attributes)
        for word in _NAME_WORD.findall(" ".join(found[1:]))
    ]
    return " ".join([tag, *names])


def blocks(html: str) -> list[Block]:
    """All leaf blocks with text, in page order."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    held: list[str] = []
    linked, in_link = 0, 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                out.append(Block(text, tuple(a for _, a in stack), linked))
            held.clear()
            linked = 0

    def pop_to(at: int) -> None:
        nonlocal in_link
        in_link -= sum(t == "a" for t, _ in stack[at:])
        del stack[at:]

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = unescape(text) if "&" in text else text
            held.append(text)
            if in_link:
                linked += len(text.strip())

    position = 0
    for token in _TOKEN.finditer(html):
        add(html[position : token.start()])
        position = token.end()
        end, start = token["end"], token["start"] or token["broken"]
        if end:
            end = end.lower()
            if end in BLOCK_TAGS:
                flush()
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == end:
                    pop_to(at)
                    break
        elif start:
            tag = start.lower()
            if tag == "br":
                held.append(" ")
            if tag in BLOCK_TAGS:
                flush()
            closes = CLOSES.get(tag)
            if closes:
                for at in range(len(stack) - 1, -1, -1):
                    if stack[at][0] in closes:
                        pop_to(at)
                        break
                    if stack[at][0] in SCOPES:
                        break
            if tag not in VOID_TAGS and not (token["attributes"] or "").endswith("/"):
                stack.append((tag, _ancestor(tag, token["attributes"] or "")))
                in_link += tag == "a"
    add(html[position:])
    flush()
    return out
