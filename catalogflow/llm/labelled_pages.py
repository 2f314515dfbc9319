"""Labelled pages for training the extractor, built from a seed.

Every page is put together from parts whose label is known: the article (1) or anything around
it (0). Page layouts, element and class names, texts and lengths vary at random, so that no
single name or length decides. The words are invented.
"""

from __future__ import annotations

import random

from catalogflow.llm.html_blocks import blocks

SYLLABLES = "ba co di fu ga he lo mi na pe qua ro se ti vu wa xi yo zu tra ste ion ent".split()

#: Names that pages give to their parts.
NAMES = {
    "menu": "nav navbar menu navigation topnav main-menu breadcrumb breadcrumbs site-nav nav-links",
    "header": "header masthead site-header top-bar brand logo page-header banner-top",
    "footer": "footer site-footer foot bottom colophon copyright legal",
    "sidebar": "sidebar side aside widget rail side-column widget-area right-column",
    "advert": "ad ads advert advertisement sponsored sponsor promo banner ad-slot adbox",
    "notice": "notice cookie cookie-notice consent alert message warning gdpr popup modal disclaimer",
    "form": "form search search-form newsletter subscribe signup login contact-form",
    "comments": "comments comment-list comment discussion replies respond responses reader-comments",
    "related": "related recommended more-stories read-next share social sharing tags pagination",
    "article": "article content post entry story post-body entry-content article-body main text page-content",
}
_TAGS = {
    "menu": ("nav", "nav", "div", "ul"), "header": ("header", "div"), "footer": ("footer", "div"),
    "sidebar": ("aside", "div", "section"), "advert": ("div", "aside", "section", "p"),
    "notice": ("div", "section", "p"), "form": ("form", "form", "div"),
    "comments": ("section", "div", "ol"), "related": ("div", "section", "ul"),
}


class Writer:
    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.random
        style = r.random()
        found = []
        for _ in range(r.randint(low, high)):
            word = "".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 5)))
            if style < 0.1:
                word += r.choice(("###", "$$$", "%%%", "&amp;&amp;&amp;", "***"))
            elif style < 0.2:
                word = word.upper() + "!!"
            found.append(word)
        text, out = "", []
        for i, word in enumerate(found):
            out.append(word + (r.choice((",", ".", "", "", "", "")) if style >= 0.2 else ""))
        text = " ".join(out)
        return (text[:1].upper() + text[1:]) + r.choice((".", ".", "", "?"))

    def name(self, kind: str) -> str:
        """An attribute that names a part, or none."""
        r = self.random
        if r.random() < 0.15:
            return ""
        value = r.choice(NAMES[kind].split())
        return f' {r.choice(("class", "class", "id"))}="{value}"'

    def part(self, kind: str) -> str:
        """A part around the article."""
        r = self.random
        tag = r.choice(_TAGS[kind])
        named = self.name(kind)
        if tag in ("div", "section", "p", "ul", "ol") and not named:
            named = f' class="{r.choice(NAMES[kind].split())}"'
        if kind in ("menu", "related") or (kind in ("sidebar", "footer", "header") and r.random() < 0.4):
            items = "".join(
                f'<li><a href="/{i}">{self.words(1, 4)}</a></li>' for i in range(r.randint(2, 9))
            )
            inner = items if tag in ("ul", "ol") else r.choice((f"<ul>{items}</ul>", items))
            if kind == "sidebar":
                inner = f"<h3>{self.words(1, 3)}</h3>{inner}"
        elif kind == "form":
            inner = (
                f"<label>{self.words(1, 3)}</label><input name=x><select><option>{self.words(1, 2)}"
                f"</option></select><button>{self.words(1, 2)}</button>"
            )
            if r.random() < 0.4:
                inner = f"<p>{self.words(2, 20)}</p>" + inner
        elif kind == "comments":
            item = "li" if tag == "ol" else "div"
            inner = f"<h3>{self.words(1, 3)}</h3>" if r.random() < 0.6 and item == "div" else ""
            for _ in range(r.randint(1, 5)):
                body = r.choice(("<p>{}</p>", "{}")).format(self.words(3, 60))
                inner += f'<{item}{self.name("comments")}><b>{self.words(1, 2)}</b>: {body}</{item}>'
        elif tag == "p" or r.random() < 0.5:
            inner = self.words(1, 25)
        else:
            inner = "".join(
                f"<{t}>{self.words(1, 25)}</{t}>" for t in r.choices(("p", "div", "h4", "span"), k=2)
            )
        return f"<{tag}{named}>{inner}</{tag}>"

    def article(self) -> str:
        r = self.random
        head = r.choice(("h1", "h1", "h2"))
        out = [f"<{head}>{self.words(1, 9)}</{head}>"] if r.random() < 0.9 else []
        for _ in range(r.randint(1, 9)):
            text = self.words(1, 140) if r.random() < 0.8 else self.words(1, 6)
            kind = r.random()
            if kind < 0.62:
                out.append(f"<p>{text}</p>")
            elif kind < 0.72:
                out.append(f"<p><b>{text}<br>")
            elif kind < 0.8:
                out.append(f"<h2>{self.words(1, 7)}</h2><p>{text} <a href=x>{self.words(1, 2)}</a></p>")
            elif kind < 0.87:
                items = "".join(f"<li>{self.words(2, 20)}</li>" for _ in range(r.randint(1, 4)))
                out.append(f"<ul>{items}</ul>")
            elif kind < 0.92:
                out.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.96:
                out.append(f"<table><tr><td>{self.words(1, 5)}</td><td>{self.words(1, 5)}</td></tr></table>")
            else:
                out.append(f"<pre>{text}</pre>")
        return out

    def page(self) -> tuple[str, list[int]]:
        """A page and the label of each of its leaf blocks."""
        r = self.random
        parts: list[tuple[str, int]] = []

        def some(kinds: tuple[str, ...], chance: float) -> list[tuple[str, int]]:
            return [(self.part(k), 0) for k in kinds if r.random() < chance]

        parts += some(("notice", "header", "menu", "form", "advert"), 0.5)
        inside: list[tuple[str, int]] = []
        for piece in self.article():
            inside.append((piece, 1))
            if r.random() < 0.06:
                inside.append((self.part(r.choice(("advert", "notice", "related", "form"))), 0))
        tag = r.choice(("article", "article", "article", "main", "div", "section"))
        name = self.name("article")
        if tag in ("div", "section") and not name:
            name = f' class="{r.choice(NAMES["article"].split())}"'
        opened, closed = f"<{tag}{name}>", f"</{tag}>"
        if r.random() < 0.3:
            opened, closed = f"<main><div{self.name('article')}>" + opened, closed + "</div></main>"
        body = [(opened, None), *inside, (closed, None)]
        sides = some(("sidebar",), 0.4)
        parts += sides + body if r.random() < 0.5 else body + sides
        parts += some(("related", "comments", "advert", "form", "notice"), 0.35)
        parts += some(("footer",), 0.85)
        if r.random() < 0.25:
            parts = [('<div id="page"><div class="wrapper">', None), *parts, ("</div></div>", None)]
        # Labels ride along as marks in the text and are taken out again.
        marked = "".join(
            p if label is None else p.replace(">", f">\x01{label}\x02") for p, label in parts
        )
        labels, clean = [], []
        for block in blocks(marked):
            found = {x[0] for x in block.text.split("\x01")[1:]}
            text = _without_marks(block.text)
            if text:
                labels.append(int(max(found, default="0")))
                clean.append(text)
        html = "".join(p for p, _ in parts)
        return html, labels


def _without_marks(text: str) -> str:
    for label in "01":
        text = text.replace(f"\x01{label}\x02", "")
    return " ".join(text.split())


def labelled_pages(n: int, seed: int = 7) -> list[tuple[str, list[int]]]:
    writer, out = Writer(seed), []
    while len(out) < n:
        html, labels = writer.page()
        if len(blocks(html)) == len(labels):
            out.append((f"<html><head><title>t</title></head><body>{html}</body></html>", labels))
    return out
