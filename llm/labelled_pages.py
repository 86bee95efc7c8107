"""Labelled pages to train the extractor on: random layouts with known main text.

Each page is a list of ``(html, label)`` parts. Main text stands in one of many usual
containers, or in none; menus, headers, footers, sidebars, notices, adverts, forms
and reader comments stand around it and inside it. Words are made up, so structure
is what a model can learn.
"""

from __future__ import annotations

import random

_SYLLABLES = "ka lo mi ten ra su ver do ni pel tar os um ben fi gra".split()

# Names that sites give to boxes. Fixed values.
_MAIN = "content main post article entry story text body article-body post-content entry-content main-content page-content".split()
_ASIDE = {
    "menu": "nav menu navbar navigation topbar breadcrumb breadcrumbs tabs pagination toc".split(),
    "header": "header masthead site-header logo branding top".split(),
    "footer": "footer site-footer bottom copyright legal colophon".split(),
    "sidebar": "sidebar side aside widget related rail recommended more-stories trending tags".split(),
    "notice": "notice cookie cookies consent gdpr alert banner popup modal message disclaimer paywall".split(),
    "advert": "ad ads advert advertisement sponsor sponsored promo promotion".split(),
    "form": "form newsletter subscribe signup login search search-box contact-form".split(),
    "comments": "comments comment reply replies discussion respond comment-list disqus responses".split(),
    "share": "share social sharing buttons meta byline author-box".split(),
}


class Page:
    """One page and the label of every text block, in page order."""

    def __init__(self, seed: int) -> None:
        self._r = random.Random(seed)
        self.html = ""
        self.labels: list[tuple[str, int]] = []
        self._page()

    def _words(self, low: int, high: int, end: str = ".") -> str:
        r = self._r
        words = ["".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 3))) for _ in range(r.randint(low, high))]
        return " ".join(words).capitalize() + (end if r.random() < 0.9 else "")

    def _block(self, tag: str, text: str, label: int, inner: str = "{}") -> None:
        self.html += f"<{tag}>{inner.format(text)}</{tag.split()[0]}>" + self._r.choice(["", "\n", "\n  "])
        self.labels.append((text, label))

    def _name(self, names: list[str]) -> str:
        r = self._r
        name = r.choice(names)
        extra = r.choice(["", "", " wrap", " row", " clearfix", " block-2"])
        return r.choice([f'class="{name}{extra}"', f'id="{name}"', f'class="c{r.randint(1, 9)} {name}"'])

    def _aside(self, kind: str) -> None:
        r = self._r
        own = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "form": "form", "comments": "section"}.get(kind, "div")
        tag = own if r.random() < 0.5 else r.choice(["div", "div", "section"])
        attributes = "" if tag in ("nav", "header", "footer", "aside", "form") and r.random() < 0.6 else " " + self._name(_ASIDE[kind])
        self.html += f"<{tag}{attributes}>"
        if kind in ("menu", "sidebar", "share") and r.random() < 0.55:
            if r.random() < 0.4:
                self._block("h3", self._words(1, 3, ""), 0)
            self.html += "<ul>"
            for _ in range(r.randint(2, 8)):
                self._block("li", self._words(1, 7, ""), 0, '<a href="/x">{}</a>')
            self.html += "</ul>"
        elif kind == "form":
            for _ in range(r.randint(1, 3)):
                self._block("label", self._words(1, 3, ""), 0)
                self.html += "<input type=text>"
            self._block("button", self._words(1, 2, ""), 0)
            if r.random() < 0.5:
                self._block("p", self._words(4, 20), 0)
        elif kind == "comments":
            self._block("h3", self._words(1, 3, ""), 0)
            for _ in range(r.randint(1, 6)):
                self.html += f"<div {self._name(_ASIDE['comments'])}>" if r.random() < 0.6 else "<div>"
                self._block(r.choice(["span class=user", "div class=meta", "h4"]), self._words(1, 3, ""), 0)
                self._block("p", self._words(3, 60), 0)
                self.html += "</div>"
        else:
            for _ in range(r.randint(1, 3)):
                self._block(r.choice(["p", "div", "span", "p"]) if r.random() < 0.8 else "a", self._words(2, 25), 0)
        self.html += f"</{tag}>"

    def _main(self) -> None:
        r = self._r
        if r.random() < 0.9:
            self._block("h1", self._words(2, 10, ""), 1)
        for _ in range(r.randint(1, 14)):
            pick = r.random()
            if pick < 0.62:
                self._block("p", self._words(1, 8) if r.random() < 0.2 else self._words(8, 110), 1, r.choice(["{}"] * 4 + ["<b>{}</b>", "{} <a href=y></a>"]))
            elif pick < 0.7:
                self._block(r.choice(["h2", "h3"]), self._words(1, 7, ""), 1)
            elif pick < 0.76:
                self.html += "<ul>"
                for _ in range(r.randint(2, 5)):
                    self._block("li", self._words(2, 25), 1)
                self.html += "</ul>"
            elif pick < 0.82:
                self._block(r.choice(["blockquote", "pre", "div", "td", "figcaption"]), self._words(3, 50), 1)
            elif pick < 0.94:
                self._aside(r.choice(["advert", "share", "notice", "sidebar", "form", "menu"]))

    def _page(self) -> None:
        r = self._r
        self.html += "<!DOCTYPE html><html><head>"
        self._block("title", self._words(2, 9, ""), 0)
        self.html += "</head><body>"
        before = [k for k in ("notice", "header", "menu", "form", "advert") if r.random() < 0.55]
        r.shuffle(before)
        for kind in before:
            self._aside(kind)
        wrap = r.random() < 0.3
        self.html += f'<div {self._name(["wrapper", "container", "page", "layout"])}>' if wrap else ""
        if r.random() < 0.25:
            self._aside("sidebar")
        pick = r.random()
        tag = "article" if pick < 0.35 else "main" if pick < 0.5 else r.choice(["div", "div", "section", "td"])
        named = r.random() < (0.3 if tag in ("article", "main") else 0.85)
        bare = tag not in ("article", "main") and not named
        self.html += "" if bare else f"<{tag}{' ' + self._name(_MAIN) if named else ''}>"
        self._main()
        if r.random() < 0.2:
            self._aside("comments")
        self.html += "" if bare else f"</{tag}>"
        self.html += "</div>" if wrap else ""
        after = [k for k in ("share", "advert", "comments", "sidebar", "form", "notice", "footer") if r.random() < 0.5]
        for kind in after:
            self._aside(kind)
        self.html += "</body></html>"
