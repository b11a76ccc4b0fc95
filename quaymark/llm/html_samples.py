"""Generated web pages of which the main text is known, to fit the extractor on."""

from __future__ import annotations

import random

# Words of class and id attributes, by what the element holds.
_MAIN = "content main post entry article story body text page single blog news detail copy prose markdown rich richtext wrapper container inner column primary center hentry document chapter".split()
_PARTS = {
    "nav": "nav menu navbar navigation breadcrumb breadcrumbs topnav links toc pagination pager skip tabs sitemap".split(),
    "header": "header masthead top banner logo branding site title hero topbar".split(),
    "footer": "footer copyright bottom legal colophon credits foot siteinfo".split(),
    "aside": "sidebar aside widget related recommended rail secondary popular trending more archive tags tagcloud categories latest".split(),
    "notice": "cookie cookies consent notice gdpr alert notification disclaimer warning popup modal overlay paywall message toast privacy".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion adsense adbox banner dfp affiliate commercial outbrain taboola".split(),
    "share": "share social sharing follow like buttons tools meta byline author toolbar print".split(),
    "form": "form search newsletter subscribe signup login contact register searchform".split(),
    "comments": "comments comment commentlist disqus respond reply replies discussion responses thread feedback reader reviews".split(),
}
#: Sounds that words are made of, by rule, and some of other scripts.
_SOUNDS = [c + v for c in "bdfgklmnprtvz" for v in "aeiou"] + "ar el im on us å ø ñ ç ß да но ки 山 水 の ع ש".split()
#: Names that sites give to no purpose that one could learn from.
_NEUTRAL = "a b c box row col grid left right wrap flex g1 g2 block unit layer zone cell item".split()


class _Writer:
    def __init__(self, rng: random.Random):
        self.r = rng
        self.main: set[str] = set()
        self.lexicon = ["".join(rng.choice(_SOUNDS) for _ in range(rng.randint(1, 4))) for _ in range(120)]

    def words(self, low: int, high: int) -> list[str]:
        return [self.r.choice(self.lexicon) for _ in range(self.r.randint(low, high))]

    def sentence(self, low: int = 3, high: int = 18) -> str:
        w = self.words(low, high)
        if len(w) > 6 and self.r.random() < 0.5:
            w[len(w) // 2] += ","
        return " ".join(w).capitalize() + self.r.choice("....!?")

    def prose(self, most: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(1, most)))

    def attributes(self, tokens: list[str], chance: float) -> str:
        if self.r.random() > chance:
            return ""
        value = self.r.choice(["", "site-", "page-", "js-", "c-", "block "]) + self.r.choice(["-", " ", "_"]).join(self.r.sample(tokens, min(len(tokens), self.r.randint(1, 2))))
        return f' {self.r.choice(["class", "class", "id", "role"])}="{value}"'

    def mark(self, text: str) -> str:
        """Main text, noted as such, with markup here and there."""
        self.main.add(" ".join(text.split()))
        w = text.split(" ")
        if len(w) > 3 and self.r.random() < 0.35:
            k = self.r.randrange(len(w) - 1)
            tag = self.r.choice(["b", "i", "em", "strong", "span", "code", 'a href="/x"'])
            w[k] = f"<{tag}>{w[k]}" + (f"</{tag.split()[0]}>" if self.r.random() < 0.9 else "")
        return self.r.choice([" ", " ", "\n"]).join(w) + self.r.choice(["", "", "", "<br>"])

    def paragraph(self, tag: str = "p", most: int = 6) -> str:
        return f"<{tag}>{self.mark(self.prose(most))}" + (f"</{tag}>" if tag != "p" or self.r.random() < 0.85 else "")

    def main_block(self) -> str:
        kind = self.r.random()
        if kind < 0.62:
            return self.paragraph()
        if kind < 0.7:
            t = self.r.choice(["h2", "h3", "h4"])
            return f"<{t}>{self.mark(' '.join(self.words(1, 8)).capitalize())}</{t}>"
        if kind < 0.78:
            t = self.r.choice(["ul", "ol"])
            return f"<{t}>" + "".join(f"<li>{self.mark(self.sentence(2, 14))}</li>" for _ in range(self.r.randint(2, 6))) + f"</{t}>"
        if kind < 0.84:
            return f"<blockquote>{self.paragraph()}</blockquote>" if self.r.random() < 0.5 else f"<blockquote>{self.mark(self.prose(2))}</blockquote>"
        if kind < 0.88:
            return "<table>" + "".join("<tr>" + "".join(f"<td>{self.mark(' '.join(self.words(1, 5)))}</td>" for _ in range(2)) + "</tr>" for _ in range(self.r.randint(1, 4))) + "</table>"
        if kind < 0.91:
            return f"<pre>{self.mark(' '.join(self.words(3, 20)))}</pre>"
        if kind < 0.94:
            return f'<figure><img src="/p.png"><figcaption>{self.mark(self.sentence())}</figcaption></figure>'
        return f"<div>{self.mark(self.prose(4))}</div>" if self.r.random() < 0.5 else f"<section>{self.paragraph()}{self.paragraph()}</section>"

    def links(self, low: int, high: int) -> str:
        """A list of links: in items, in paragraphs, in a row, some with a word or date beside them."""
        made = []
        for k in range(self.r.randint(low, high)):
            name = " ".join(self.words(1, 5))
            made.append(f'<a href="{self.r.choice(["/", "#", "https://x.example/"])}{k}">{name}</a>' + (f" {self.r.randint(1, 99)}" if self.r.random() < 0.08 else ""))
        kind = self.r.random()
        if kind < 0.55:
            t = self.r.choice(["ul", "ul", "ol"])
            return f"<{t}>" + "".join(f"<li>{x}{self.r.choice(['</li>', '</li>', ''])}" for x in made) + f"</{t}>"
        if kind < 0.65:
            return "".join(f"<p>{x}</p>" for x in made)
        if kind < 0.72:
            return "".join(f"<div>{x}</div>" for x in made)
        return self.r.choice([" | ", " ", "\n", "", " &raquo; ", "<br>"]).join(made)

    def aside_text(self) -> str:
        r = self.r.random()
        if r < 0.4:
            return self.prose(3)
        if r < 0.8:
            return "".join(f"<p>{self.prose(2)}</p>" for _ in range(self.r.randint(1, 2)))
        return f"<h3>{' '.join(self.words(1, 4))}</h3><p>{self.prose(3)}</p>"

    def part(self, kind: str) -> str:
        """Something that isn't main text."""
        tags = {"nav": ["nav"] * 3 + ["div"], "header": ["header"] * 2 + ["div"], "footer": ["footer"] * 3 + ["div"], "aside": ["aside"] * 2 + ["div", "section"], "form": ["form"] * 2 + ["div"]}
        tag = self.r.choice(tags.get(kind, ["div", "div", "section", "aside" if kind in ("ad", "notice") else "div"]))
        named = self.attributes(_PARTS[kind], 0.6 if tag in ("nav", "header", "footer", "aside", "form") else 1.0)
        if kind in ("nav", "aside", "footer") and self.r.random() < 0.25:  # only what it holds tells what it is
            named = self.attributes(_NEUTRAL, 0.4)
            head = f"<h4>{' '.join(self.words(1, 3))}</h4>" if self.r.random() < 0.25 else ""
            return f"<div{named}>{head}{self.links(3, 12)}</div>"
        if kind == "nav":
            inside = self.links(1, 12)
        elif kind == "header":
            inside = self.r.choice([f"<h1>{' '.join(self.words(1, 5))}</h1>", f'<a href="/">{" ".join(self.words(1, 3))}</a>', f"<p>{self.sentence()}</p>"]) + (self.links(2, 6) if self.r.random() < 0.5 else "")
        elif kind == "footer":
            rights = f"{self.r.choice(['&copy;', '©', '(c)', 'Copyright'])} {self.r.randint(1995, 2030)} {' '.join(self.words(1, 5))}"
            inside = self.r.choice([rights, f"<p>{rights}. {self.sentence()}</p>", f"{self.links(2, 6)}<p>{rights}</p>", f"<p>{self.prose(3)}</p>", f"<small>{self.prose(2)}</small>", self.links(2, 8)])
        elif kind == "aside":
            inside = self.r.choice([self.links(2, 8), self.aside_text(), f"<h3>{' '.join(self.words(1, 3))}</h3>" + self.links(3, 6)])
        elif kind == "form":
            inside = f"<label>{' '.join(self.words(1, 3))}</label><input type='text'><button>{' '.join(self.words(1, 2))}</button>" + (f"<p>{self.prose(2)}</p>" if self.r.random() < 0.5 else "")
        elif kind == "share":
            inside = self.r.choice([self.links(2, 5), " ".join(self.words(2, 6))])
        elif kind == "comments":
            one = self.r.choice(["li", "div", "article"])
            named_one = self.attributes(_PARTS["comments"], 0.8)
            inside = self.r.choice(["", f"<h3>{' '.join(self.words(1, 3))}</h3>"]) + "".join(f"<{one}{named_one}><b>{self.r.choice(self.lexicon)}</b> <p>{self.prose(4)}</p></{one}>" for _ in range(self.r.randint(1, 5)))
        else:
            inside = self.aside_text()
        if kind in ("notice", "ad", "form", "share") and self.r.random() < 0.12:
            named = self.r.choice([' hidden', ' style="display:none"', ' style="display: none; width:1px"'])
        return f"<{tag}{named}>{inside}</{tag}>"

    def parts(self, kinds: list[str], chance: float) -> str:
        return "".join(self.part(k) for k in kinds if self.r.random() < chance)

    def article(self) -> tuple[str, bool]:
        """The main text in its element, and whether reader comments are in it."""
        blocks = []
        if self.r.random() < 0.75:
            heading = f"<{(t := self.r.choice(['h1', 'h1', 'h1', 'h2']))}>{self.mark(' '.join(self.words(1, 12)).capitalize())}</{t}>"
            blocks.append(f"<header>{heading}</header>" if self.r.random() < 0.08 else heading)
        for _ in range(self.r.choice([1, 1, 2, 3, 4, 6, 9, 14, 25])):
            blocks.append(self.main_block())
        for kind in ("ad", "share", "aside", "form", "notice", "nav"):
            if self.r.random() < 0.1:
                blocks.insert(self.r.randint(1, len(blocks)), self.part(kind))
        inside = self.r.choice(["", "\n", "\n  "]).join(blocks)
        commented = self.r.random() < 0.12
        inside += self.part("comments") if commented else ""
        style = self.r.random()
        if style < 0.3:
            return f"<article{self.attributes(_MAIN, 0.4)}>{inside}</article>", commented
        if style < 0.45:
            return f"<main{self.attributes(_MAIN, 0.4)}>{inside}</main>", commented
        if style < 0.75:
            return f"<div{self.attributes(_MAIN, 1.0)}>{inside}</div>", commented
        if style < 0.9:
            return f"<{(t := self.r.choice(['div', 'section']))}{self.attributes(_NEUTRAL, 0.5)}>{inside}</{t}>", commented
        return inside, commented

    def body(self) -> str:
        """One of several ways to lay a page out."""
        main, commented = self.article()
        late = self.part("comments") if not commented and self.r.random() < 0.25 else ""
        side = lambda chance: self.parts(["aside", "nav", "ad", "form", "aside"], chance)
        layout = self.r.choice(["flow", "flow", "columns", "columns", "cells", "deep", "plain"])
        if layout == "plain":
            return main + late + self.parts(["footer"], 0.3)
        if layout == "columns":
            columns = [f"<div{self.attributes(_NEUTRAL + _MAIN, 0.6)}>{main}{late}</div>"]
            for _ in range(self.r.randint(1, 2)):
                columns.insert(self.r.choice([0, len(columns)]), f"<{(t := self.r.choice(['div', 'div', 'aside', 'section']))}{self.attributes(_NEUTRAL + _PARTS['aside'], 0.6)}>{side(0.5) or self.part('aside')}</{t}>")
            main, late = f"<div{self.attributes(_NEUTRAL, 0.6)}>{''.join(columns)}</div>", ""
        if layout == "cells":  # as pages were laid out once
            cells = [f"<td>{main}{late}</td>"]
            cells.insert(self.r.choice([0, 1]), f"<td>{side(0.5) or self.part('nav')}</td>")
            main, late = f"<table><tr>{''.join(cells)}</tr></table>", ""
        if layout == "deep":
            for _ in range(self.r.randint(1, 5)):
                main = f"<div{self.attributes(_NEUTRAL + _MAIN, 0.5)}>{side(0.08)}{main}{side(0.08)}</div>"
        top = self.parts(["notice", "header", "nav", "ad", "form"], 0.45)
        return top + main + late + side(0.15) + self.parts(["share", "notice"], 0.2) + self.parts(["footer"], 0.8)

    def page(self) -> str:
        head = f"<title>{' '.join(self.words(1, 6))}</title>" if self.r.random() < 0.8 else ""
        head += self.r.choice(["", f"<style>.{self.r.choice(_NEUTRAL)}{{color:#{self.r.randint(100, 999)}}}</style>", '<link rel="stylesheet" href="/s.css">'])
        head += self.r.choice(["", f"<script>window.x={self.r.randint(0, 9)}</script>", '<script src="/a.js"></script>', '<meta name="viewport" content="width=device-width">'])
        body = self.body() + self.r.choice(["", "", f"<script>f({self.r.randint(0, 9)});</script>", "<!-- end -->"])
        if self.r.random() < 0.15:
            return body  # a fragment
        return f"{self.r.choice(['<!DOCTYPE html>', '<!doctype html>', ''])}<html><head>{head}</head><body{self.attributes(_NEUTRAL, 0.2)}>{body}{self.r.choice(['</body></html>', '</body></html>', ''])}"


def generate(pages: int, seed: int) -> list[tuple[str, set[str]]]:
    """(html, runs of main text) of so many pages; the same for the same seed."""
    out = []
    for k in range(pages):
        writer = _Writer(random.Random(seed * 1_000_003 + k))
        out.append((writer.page(), writer.main))
    return out
