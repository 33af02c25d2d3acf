"""Made-up pages whose main text is known, for fitting the classifier of page nodes.

Every page draws a style (semantic elements, classes, both, or bare boxes), wrappers, an article of
varied blocks and the boilerplate around and inside it. Words are random syllables, so nothing of a
language is learned. The same seed gives the same pages.
"""

from __future__ import annotations

import html
import random

SYLLABLES = "ba ce di fo gu ha je ki lo mu na pe ri so tu va we xi yo zu ar el in os un".split()
NEUTRAL = "site page block box inner wrap left right col section main top area module".split()
#: Words that classes and ids are made of, and elements that fit, by what a part is.
PARTS = {
    "menu": ("nav navbar menu navigation topnav links breadcrumb breadcrumbs tabs", "nav nav ul div"),
    "header": ("header masthead banner logo branding brand topbar", "header div"),
    "footer": ("footer bottom copyright legal colophon imprint", "footer div"),
    "sidebar": ("sidebar aside related widget rail trending popular recommended more teaser", "aside div section"),
    "notice": ("notice cookie cookies consent gdpr alert popup modal overlay message disclaimer", "div aside section"),
    "advert": ("ad ads advert advertisement sponsor sponsored promo promotion adsense", "div aside ins section"),
    "form": ("form search newsletter subscribe login signup contact", "form div"),
    "comments": ("comments comment replies discussion responses disqus thread", "section div ol"),
    "share": ("share social follow sharing buttons", "div ul"),
    "content": ("article content post entry story body text articlebody", "article main div section"),
}
TELLING = frozenset("nav header footer aside form article main".split())
ARIA = {"menu": "navigation", "header": "banner", "footer": "contentinfo", "sidebar": "complementary", "form": "search", "content": "main"}


class Maker:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)
        self.style = self.rng.choice(("semantic", "classed", "classed", "both", "bare"))
        self.truth: list[str] = []

    def some(self, low: int, high: int) -> range:
        return range(self.rng.randint(low, high))

    def word(self) -> str:
        return "".join(self.rng.choice(SYLLABLES) for _ in self.some(1, 4))

    def phrase(self, low: int = 1, high: int = 4) -> str:
        return " ".join(self.word() for _ in self.some(low, high)).capitalize()

    def sentences(self, low: int = 1, high: int = 6) -> str:
        made = []
        for _ in self.some(low, high):
            text = self.phrase(2, 18)
            if self.rng.random() < 0.4:
                text = text.replace(" ", ", ", 1)
            made.append(text + self.rng.choice("....?!"))
        return " ".join(made)

    def attributes(self, part: str, tag: str) -> str:
        """Elements that tell nothing have a class, as on real pages, but for bare ones."""
        rng = self.rng
        if (self.style == "semantic" and tag in TELLING or self.style == "bare") and rng.random() < 0.85:
            return f' role="{ARIA[part]}"' if self.style == "semantic" and part in ARIA and rng.random() < 0.2 else ""
        words = [rng.choice(PARTS[part][0].split())]
        if rng.random() < 0.5:
            words.insert(rng.randint(0, 1), rng.choice(NEUTRAL))
        if rng.random() < 0.15:
            words.append(self.word())
        shape = rng.choice(("-", "_", " ", "camel"))
        name = words[0] + "".join(w.capitalize() for w in words[1:]) if shape == "camel" else shape.join(words)
        return rng.choice((f' class="{name}"', f' class="{name}"', f' id="{name}"', f" class={name.replace(' ', '-')}", f' data-x="1" class="{name}"'))

    def part(self, part: str, inner: str) -> str:
        fit = PARTS[part][1].split()
        tag = self.rng.choice(fit if self.style in ("semantic", "both") else [t for t in fit if t in ("div", "ul", "form", "ol", "ins")])
        if tag in ("ul", "ol"):
            inner = f"<li>{inner}</li>" if "<li" not in inner[:4] else inner
        return f"<{tag}{self.attributes(part, tag)}>{inner}</{tag}>"

    def link(self, low: int = 1, high: int = 3) -> str:
        return f'<a href="/{self.word()}">{self.phrase(low, high)}</a>'

    def links(self, low: int, high: int, words: int = 3) -> str:
        made = [self.link(1, words) for _ in self.some(low, high)]
        shape = self.rng.random()
        if shape < 0.6:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in made) + "</ul>"
        return self.rng.choice((" | ", " ", "<br>", " &middot; ")).join(made) if shape < 0.85 else "".join(f"<div>{x}</div>" for x in made)

    # boilerplate

    def menu(self) -> str:
        return self.part("menu", self.links(3, 12))

    def header(self) -> str:
        bits = [f"<div>{self.phrase()}</div>", f"<p>{self.phrase(3, 8)}</p>", self.links(2, 6), f"<h1>{self.phrase()}</h1>", f"<h2>{self.link()}</h2>"]
        if self.style == "bare":  # nothing but its links tells it from an article
            bits = [bits[2], f"{self.phrase()} {self.links(2, 6)}"]
            return self.part("header", self.rng.choice(bits))
        return self.part("header", "".join(self.rng.sample(bits, self.rng.randint(1, 3))))

    def footer(self) -> str:
        bits = [f"&copy; {self.phrase()} &middot; {self.sentences(1, 2)}", f"<p>{self.sentences(1, 3)}</p>", self.links(3, 8), f"&copy; 20{self.rng.randint(10, 26)} {self.phrase()}"]
        if self.style == "bare":
            return self.part("footer", self.rng.choice((bits[2], bits[3], bits[3] + " " + bits[2])))
        return self.part("footer", "".join(self.rng.sample(bits, self.rng.randint(1, 3))))

    def sidebar(self) -> str:
        teasers = "".join(f"<div><h4>{self.link(3, 8)}</h4><p>{self.sentences(1, 2)}</p></div>" for _ in self.some(1, 4))
        if self.style == "bare":
            return self.part("sidebar", self.links(3, 9, 9))
        return self.part("sidebar", f"<h3>{self.phrase()}</h3>" + self.rng.choice((self.links(3, 9, 9), teasers, f"<p>{self.sentences(1, 3)}</p>" + self.links(1, 5, 6))))

    def notice(self) -> str:
        return self.part("notice", self.rng.choice((f"<p>{self.sentences(1, 3)}</p>", self.sentences(1, 3))) + self.rng.choice((f"<button>{self.phrase()}</button>", "", self.link())))

    def advert(self) -> str:
        return self.part("advert", self.rng.choice((self.sentences(1, 1), f"<p>{self.sentences(1, 2)}</p>", self.link(2, 8), self.phrase(2, 8), f'<img src="/x.png">{self.sentences(1, 1)}')))

    def form(self) -> str:
        fields = "".join(f"<label>{self.phrase()}</label><input name={self.word()}>" for _ in self.some(1, 3))
        return self.part("form", self.rng.choice(("", f"<p>{self.sentences(1, 2)}</p>", f"<h3>{self.phrase()}</h3>")) + fields + f"<button>{self.phrase(1, 2)}</button>")

    def comments(self) -> str:
        tag = self.rng.choice(("div", "div", "li", "article" if self.style == "both" else "div"))
        own = ' class="comment"' if self.style != "bare" and self.rng.random() < 0.6 else ""
        made = [f"<{tag}{own}><b>{self.phrase(1, 2)}</b> <div><p>{self.sentences(1, 4)}</p></div>{self.link()}</{tag}>" for _ in self.some(1, 6)]
        return self.part("comments", f"<h3>{self.phrase()}</h3>" + "".join(made) + (self.form() if self.rng.random() < 0.3 else ""))

    def share(self) -> str:
        return self.part("share", self.links(2, 6, 1))

    # the article

    def kept(self, text: str, shown: str | None = None) -> str:
        self.truth.append(text)
        return html.escape(text, quote=False) if shown is None else shown

    def marked(self) -> str:
        """A paragraph with inline elements, references, breaks and odd white space."""
        words = self.sentences().split(" ")
        shown = [html.escape(w, quote=False) for w in words]
        k = self.rng.randrange(len(shown))
        shown[k] = self.rng.choice(("<b>{}</b>", "<em>{}</em>", '<a href="/x">{}</a>', '<span class="x">{}</span>', "<b>{}")).format(shown[k])
        blank = self.rng.choice((" ", " ", "\n", "  \n\t", "<br>"))
        return self.kept(" ".join(words), shown[0] + blank + " ".join(shown[1:]) if len(shown) > 1 else shown[0])

    def block(self) -> str:
        kind = self.rng.random()
        if kind < 0.62:
            shown = self.marked() if self.rng.random() < 0.4 else self.kept(self.sentences(1, 8))
            return self.rng.choice(("<p>{}</p>", "<p>{}</p>", "<p>{}</p>\n", "<p>{}")).format(shown) if self.style != "bare" or self.rng.random() < 0.7 else f"<div>{shown}</div>"
        if kind < 0.70:
            return f"<h2>{self.kept(self.phrase(1, 6))}</h2>"
        if kind < 0.78:
            return "<ul>" + "".join(f"<li>{self.kept(self.sentences(1, 2))}" for _ in self.some(1, 5)) + "</ul>"
        if kind < 0.84:
            return f"<blockquote><p>{self.kept(self.sentences())}</p></blockquote>"
        if kind < 0.88:
            return f"<pre>{self.kept(self.phrase(3, 20))}</pre>"
        if kind < 0.92:
            return f'<figure><img src="/x.png"><figcaption>{self.kept(self.sentences(1, 2))}</figcaption></figure>'
        if kind < 0.96:
            rows = "".join("<tr>" + "".join(f"<td>{self.kept(self.phrase(1, 3))}</td>" for _ in range(3)) + "</tr>" for _ in self.some(1, 4))
            return f"<table>{rows}</table>"
        return f"<p><b>{self.kept(self.sentences(1, 2))}<br>"  # left open

    def article(self) -> str:
        rng = self.rng
        title = f"<h1>{self.kept(self.phrase(2, 9))}</h1>" if rng.random() < 0.8 else ""
        made = [title]
        for _ in self.some(*rng.choices(((1, 14), (1, 2), (60, 250)), (78, 18, 4))[0]):
            made.append(self.block())
            if rng.random() < 0.08:
                made.append(rng.choice((self.advert, self.share, self.sidebar, self.form) if self.style != "bare" else (self.form,))())
        for _ in range(rng.choice((0, 0, 0, 1, 2)) if self.style != "bare" else 0):
            made.append(rng.choice((self.share, self.sidebar, self.comments, self.form))())
        return self.part("content", "".join(made))

    def page(self) -> str:
        rng, bare = self.rng, self.style == "bare"
        if bare and rng.random() < 0.15:  # an article and nothing else
            return rng.choice(("{}", "<html><body>{}</body></html>", "<div>{}</div>")).format("".join(self.block() for _ in self.some(1, 8)))

        def maybe(chance: float, *made) -> list[str]:
            return [rng.choice(made)()] if rng.random() < chance else []

        above = maybe(0.3, self.notice) * (not bare) + maybe(0.6, self.header) + maybe(0.7, self.menu) + maybe(0.35, self.advert) * (not bare)
        before, after = maybe(0.15, self.sidebar, self.form, self.menu), maybe(0.4, self.sidebar) + maybe(0.2, self.form)
        middle = [*before, self.article(), *maybe(0.3, self.comments) * (not bare), *after]
        rng.shuffle(above)
        below = maybe(0.75, self.footer) + maybe(0.15, self.notice) * (not bare) + maybe(0.1, self.menu)
        body = "".join(middle)
        for _ in self.some(0, 3):
            name = "" if bare else f' class="{rng.choice(NEUTRAL)}"'
            body = f"<div{name}>{body}</div>"
        noise = rng.choice(("", f'<script>var t="</p><p>{self.phrase()}";</script>', f"<!-- {self.phrase()} --><style>p{{margin:0}}</style>"))
        title = f"<title>{self.phrase(2, 8)}</title>"
        return f"<!DOCTYPE html><html><head>{title}{noise}</head><body>{''.join(above)}{noise}{body}{''.join(below)}" + rng.choice(("</body></html>", ""))


def made_page(seed: int) -> tuple[str, list[str]]:
    """(html, blocks of the main text in page order)."""
    maker = Maker(seed)
    return maker.page(), maker.truth
