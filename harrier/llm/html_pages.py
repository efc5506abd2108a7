"""Labelled pages to train and test the extraction on: generated, with the main text known.

Five families of layout differ in how they mark what a block is: elements of their own (semantic), class names
(classes), ids (ids), tables and old attributes (tables), and roles (roles). Within a family a seed chooses
what holds the article, which boilerplate stands where, and how sloppy the markup is. Texts of article
and boilerplate come from the same distribution, so a model must go by structure more than by words. A family can be
left out of the training to see how the model does on layouts of a kind that it hasn't met.
"""

from __future__ import annotations

import html
import random

FAMILIES = ("semantic", "classes", "ids", "tables", "roles")
ONSETS, NUCLEI, CODAS = "b br c d dr f g gl h j k l m n p pr qu r s sk t tr v w z".split(), "a e i o u ai ea io ou é ö å".split(), " n r s l m t nd rk st".split(" ")
#: What stands on a page besides the article, in words that sites use for it.
NAMES = {
    "nav": "nav menu navbar navigation breadcrumbs breadcrumb topnav main-nav site-menu nav-links tabs pagination pager".split(),
    "header": "header masthead site-header topbar logo banner brand page-header top branding".split(),
    "ad": "ad ads advert advertisement sponsored sponsor promo adsbygoogle ad-slot ad-banner promotion affiliate".split(),
    "side": "sidebar widget related recommended popular more side aside trending also-read latest teaser secondary".split(),
    "notice": "notice cookie cookie-banner alert popup newsletter consent modal subscribe paywall gdpr overlay disclaimer".split(),
    "form": "search login signup contact-form newsletter-form feedback search-box".split(),
    "social": "share social tags toolbar sharing follow-us share-buttons tag-list".split(),
    "comments": "comments commentlist discussion comment comment-list replies reader-comments responses thread reply disqus".split(),
    "footer": "footer copyright site-footer bottom legal colophon page-footer imprint foot".split(),
}
CONTENT = "content post-content entry story main-text article page-content article-body post body-text entry-content text story-body".split()
#: The element and the role that say it, where there is one.
ELEMENTS = {"nav": "nav", "header": "header", "ad": "aside", "side": "aside", "notice": "dialog", "form": "form", "footer": "footer", "comments": "section", "social": "ul"}
ROLES = {"nav": "navigation", "header": "banner", "ad": "complementary", "side": "complementary", "notice": "alertdialog", "form": "search", "footer": "contentinfo"}


class Page:
    def __init__(self, seed: int, families: tuple[str, ...] = FAMILIES):
        self.r, self.out, self.main = random.Random(seed), [], []
        self.family = self.r.choice(families)
        self.raw = self._page()

    def _words(self, n: int) -> str:
        r = self.r
        out = ["".join(r.choice(ONSETS) + r.choice(NUCLEI) + r.choice(CODAS) for _ in range(r.choice([1, 1, 2, 2, 3]))) for _ in range(n)]
        odd = r.random()
        if odd < 0.08:
            out = [x + r.choice(["***", "%", " &", "!!", "$9", " < 2"]) for x in out]
        elif odd < 0.12:
            out = [x.upper() for x in out]
        return " ".join(out).capitalize() + r.choice([".", ".", ".", "", "!", "?", " & son."])

    def _text(self, n: int, main: bool) -> str:
        text = self._words(n)
        if main:
            self.main.append(" ".join(text.split()))
        coded = html.escape(text, quote=False)
        if self.r.random() < 0.2 and (a := coded.find(" ")) > 0 and "&" not in coded[:a]:
            tag = self.r.choice(["b", "em", "strong", "span", "i", 'a href="/ref"'])
            coded = f"<{tag}>{coded[:a]}</{tag.split()[0]}>{coded[a:]}"
        return coded.replace(" ", self.r.choice([" ", " ", "\n  ", "&nbsp;" if not main else " "]), 1)

    def _mark(self, kind: str) -> tuple[str, str]:
        """The element and the attributes by which the page's family says what a block is."""
        r, names = self.r, NAMES.get(kind, CONTENT)
        word = r.choice(names)
        if r.random() < 0.25:
            word += " " + r.choice(["wide", "box", "block", "clearfix", "dark", r.choice(names)])
        family = self.family if r.random() < 0.85 else "classes"
        if family == "semantic" and (kind in ELEMENTS or kind == "content"):
            tag = ELEMENTS.get(kind) or r.choice(["article", "article", "main", "section"])
            named = tag in ("section", "ul") or r.random() < 0.3
            return tag, f' class="{word}"' if named else ""
        if family == "roles":
            role = ROLES.get(kind, "main" if kind == "content" else "")
            return r.choice(["div", "div", "section"]), (f' role="{role}"' if role else f' class="{word}"') + (f' class="{word}"' if role and r.random() < 0.4 else "")
        if family == "ids":
            return r.choice(["div", "div", "section", "ul" if kind in ("nav", "social") else "div"]), f" id='{word}'"
        if family == "tables":
            return "td", r.choice([f' class="{word}"', f" id={word.split()[0]} valign=top", f' class="{word}" width="160"'])
        tag = "ul" if kind in ("nav", "social") and r.random() < 0.4 else "p" if kind == "notice" and r.random() < 0.15 else "ol" if kind == "comments" and r.random() < 0.2 else r.choice(["div", "div", "div", "section", "aside" if kind in ("ad", "side") else "div"])
        return tag, f' class="{word}"'

    def _style(self) -> str:
        """A class that says how a block looks, not what it is; any block may have one."""
        r = self.r
        if r.random() < 0.7:
            return ""
        return f' class={r.choice(["lead", "first", "indent", "large", "x", self._words(1).lower().split()[0].strip(".!?&*%<") or "q", "c" + str(r.randint(1, 99))])}'

    def _boiler(self, kind: str, inline: bool = False) -> str:
        r = self.r
        tag, attributes = self._mark(kind)
        if inline and tag == "td":
            tag = "div"
        n = lambda: r.choice([1, 2, 4, 8, 14, 30, 55])
        link = lambda: f'<a href="/{r.randint(1, 99)}">{self._text(r.randint(1, 3), False)}</a>'
        if tag in ("ul", "ol"):
            body = "".join(f"<li>{link() if r.random() < 0.6 and kind != 'comments' else self._text(n(), False)}</li>" for _ in range(r.randint(1, 6)))
        elif kind in ("nav", "social") or kind == "side" and r.random() < 0.5:
            shape = r.random()
            body = f"<ul>{''.join(f'<li>{link()}</li>' for _ in range(r.randint(2, 7)))}</ul>" if shape < 0.6 else r.choice([" | ", " ", " &raquo; "]).join(link() for _ in range(r.randint(2, 5)))
        elif kind == "form":
            body = r.choice(["<label>{}</label><input name=k><button>{}</button>", "<p>{}</p><textarea rows=3></textarea><input type='submit' value='ok'>{}", "<select><option>{}</option></select><fieldset>{}</fieldset>"]).format(self._text(2, False), self._text(n(), False))
        elif kind == "footer":
            body = r.choice(["&copy; {0} {1}", "<p>{1}</p>", "<small>Copyright {0} {1}</small>", "<ul><li>{1}</li><li>&#169; {0}</li></ul>", "<div>{1}</div><div>&copy; {0}</div>"]).format(r.randint(1990, 2025), self._text(n(), False))
        elif kind == "comments":
            one = lambda: r.choice(["<div class=comment><b>{}</b><p>{}</p></div>", "<p>{}: {}</p>", "<div><span>{}</span> {}</div>", "<article class='comment'><header>{}</header><p>{}</p></article>"]).format(self._text(1, False), self._text(n(), False))
            body = (f"<h3>{self._text(2, False)}</h3>" if r.random() < 0.5 else "") + "".join(one() for _ in range(r.randint(1, 4)))
        elif r.random() < 0.5 or tag == "p":
            body = self._text(n(), False)
        else:
            body = "".join(f"<{t}{self._style()}>{self._text(n(), False)}</{t}>" for t in r.choices(["p", "p", "div", "h3", "h4"], k=r.randint(1, 4)))
        return f"<{tag}{attributes}>{body}</{tag}>"

    def _main(self) -> str:
        r = self.r
        tag, attributes = self._mark("content")
        if self.family != "tables" and r.random() < 0.25:
            tag, attributes = "article", r.choice(["", ' class="post"', ' id="story"'])
        elif r.random() < 0.1:
            attributes = ""
        out = [f"<{tag}{attributes}>"]
        if r.random() < 0.8:
            out.append(f"<h1>{self._text(r.randint(1, 10), True)}</h1>")
        for _ in range(r.choice([1, 2, 3, 5, 8, 12])):
            kind, n = r.random(), r.choice([1, 2, 5, 12, 30, 60, 90])
            if kind < 0.68:
                out.append(f"<p{self._style()}>{self._text(n, True)}" + ("</p>" if r.random() < 0.8 else "<br>"))
            elif kind < 0.75:
                t = r.choice(["h2", "h3"])
                out.append(f"<{t}>{self._text(r.randint(1, 6), True)}</{t}>")
            elif kind < 0.82:
                t = r.choice(["ul", "ol"])
                out.append(f"<{t}>{''.join(f'<li>{self._text(r.randint(1, 12), True)}</li>' for _ in range(r.randint(1, 5)))}</{t}>")
            elif kind < 0.86:
                out.append(f"<blockquote>{self._text(n, True)}</blockquote>")
            elif kind < 0.9:
                out.append(f"<table><tr><td>{self._text(2, True)}</td><td>{self._text(3, True)}</td></tr></table>")
            elif kind < 0.93:
                out.append(f"<div>{self._text(n, True)}</div>")
            elif kind < 0.95:
                out.append(f"<pre>{self._text(n, True)}</pre>")
            else:
                out.append(self._boiler(r.choice(["ad", "social", "side", "notice"]), True))
        if r.random() < 0.15:
            out.append(self._boiler("comments", True))
        out.append(f"</{tag}>" if tag == "td" or r.random() < 0.9 else "")
        return "".join(out)

    def _page(self) -> str:
        r = self.r
        before = [k for k, p in (("nav", 0.7), ("header", 0.45), ("notice", 0.3), ("ad", 0.45), ("side", 0.2), ("form", 0.2), ("nav", 0.1)) if r.random() < p]
        after = [k for k, p in (("social", 0.15), ("side", 0.3), ("comments", 0.35), ("ad", 0.2), ("form", 0.2), ("notice", 0.1), ("footer", 0.85)) if r.random() < p]
        r.shuffle(before)
        parts = [self._boiler(k) for k in before]
        main = self._main()
        rest = [self._boiler(k) for k in after]
        if self.family == "tables":
            rows = [f"<tr>{x}</tr>" for x in [*parts, main, *rest]]
            body = f'<table width="100%" border=0>{"".join(rows)}</table>'
        else:
            if r.random() < 0.2:
                parts.append(r.choice(["<!-- begin -->", "<!-- <p>old</p> -->", "<!-- slot -->"]))
            if r.random() < 0.25:
                main = f'<div class="{r.choice(["wrapper", "container", "row", "page", "inner"])}">{main}</div>'
            body = "".join([*parts, main, *rest])
        head = r.choice(["", f"<title>{html.escape(self._words(4))}</title>", f"<meta charset=utf-8><title>{html.escape(self._words(3))}</title><link rel=stylesheet href=/s.css>"])
        head += r.choice(["", "<style>.x { color: red }</style>", "<script>if (1 < 2) document.title = '<b>';</script>", "<noscript>on</noscript>"])
        return r.choice(["<!doctype html>", ""]) + f"<html><head>{head}</head><body>{body}" + ("</body></html>" if r.random() < 0.8 else "")


def labelled_pages(n: int, seed: int = 1, families: tuple[str, ...] = FAMILIES) -> list[tuple[str, str]]:
    """(html, main text) of n generated pages of these families."""
    made = [Page(seed * 1_000_003 + i, families) for i in range(n)]
    return [(p.raw, " ".join(p.main)) for p in made]
