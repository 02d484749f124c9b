"""Seeded generator of labelled pages: what the block labeller learns from.

Pages are drawn from a grammar of layouts with words of invented languages, so that the labeller learns tag
paths, common boilerplate words and the order of blocks rather than any vocabulary.
"""

from __future__ import annotations

import random

#: Containers by role as "tag.class"; a role's text is (usually) furniture words or invented ones.
CONTAINERS = {
    "menu": "nav nav.main div.nav div.menu div.navbar ul.menu ul.nav div.breadcrumbs div.navigation div.toolbar".split(),
    "header": "header header.site div.header div.masthead div.top div.branding div.banner".split(),
    "advert": "div.ad div.ads div.advert div.advertisement aside.ad div.sponsored div.promo div.sponsor section.ads p.ad".split(),
    "sidebar": "aside div.sidebar aside.sidebar div.side div.widget div.related section.related div.recommended div.popular".split(),
    "notice": "div.cookie div.cookies div.notice div.consent div.alert div.popup div.modal div.newsletter div.subscribe "
              "section.notice p.notice div.paywall div.disclaimer dialog aside.notice".split(),
    "form": "form form.search form.login div.form form.contact form.signup form.newsletter".split(),
    "comments": "section.comments div.comments ol.comments div.comment ul.comments section.discussion div.replies "
                "div.responses article.comment div.disqus".split(),
    "footer": "footer footer.site div.footer div.bottom div.copyright div.legal div.colophon".split(),
    "share": "div.share div.social div.tags ul.social div.sharing div.pagination".split(),
}
MAIN = ("article main main/article div.content div.main div.post div.entry div.article div.story section.content "
        "div.content/article article.post div.text div.page/div.body article/div.entry main/div.content").split()
FURNITURE = ("home about contact login search menu news sports archive terms privacy policy cookies accept subscribe "
             "newsletter copyright rights reserved share tweet print email related posts popular read more next previous "
             "comments reply says report sponsored advertisement sign up password username submit follow us").split()


class Grammar:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def page(self) -> tuple[str, list[bool]]:
        """HTML and, block by block, whether it belongs to the article."""
        r = self.r
        self.out, self.labels = [], []
        self.syllables = ["".join(r.choice("bcdfghklmnprstvwzßñç") for _ in range(r.randint(0, 2))) + r.choice("aeiouéüóy")
                          for _ in range(40)]
        r_ = r.random
        self.out.append(f"<!DOCTYPE html><html><head><title>{self.words(6)}</title><style>p{{margin:0}}</style></head><body>")
        wrap = r_() < 0.4
        if wrap:
            self.out.append(f'<div class="{r.choice(["wrapper", "container", "page", "site", "layout"])}">')
        before = [k for k, p in (("header", 0.5), ("menu", 0.8), ("notice", 0.35), ("advert", 0.45), ("form", 0.15),
                                 ("sidebar", 0.2)) if r_() < p]
        after = [k for k, p in (("share", 0.3), ("advert", 0.25), ("sidebar", 0.4), ("comments", 0.45), ("form", 0.3),
                                ("notice", 0.2), ("menu", 0.15)) if r_() < p]
        if r_() < 0.3:
            r.shuffle(before)
        if r_() < 0.5:
            r.shuffle(after)
        for kind in before:
            self.furniture(kind)
        inside = []
        if after and r_() < 0.35:
            inside = [after.pop(0)]
        self.article(inside)
        for kind in after:
            self.furniture(kind)
        if r_() < 0.9:
            self.furniture("footer")
        if r_() < 0.9:
            self.out.append("</div>" * wrap + "</body></html>")
        return "".join(self.out), self.labels

    def word(self) -> str:
        return "".join(self.r.choice(self.syllables) for _ in range(self.r.randint(1, 4)))

    def words(self, n: int, furniture: float = 0.0) -> str:
        return " ".join(self.r.choice(FURNITURE) if self.r.random() < furniture else self.word() for _ in range(max(1, n)))

    def sentence(self, n: int, furniture: float = 0.0) -> str:
        text = " ".join([self.word()] * n) if self.r.random() < 0.04 else self.words(n, furniture)
        if self.r.random() < 0.1:
            text = " ".join(w + self.r.choice(["***", "###", "&amp;&amp;", "!!", "%%%", " |"]) for w in text.split())
        return (text[0].upper() + text[1:] + self.r.choice([".", ".", ".", "!", ""])) if self.r.random() < 0.95 else text.upper()

    def put(self, label: bool, tag: str, text: str) -> None:
        close = "" if tag in ("p", "li", "td") and self.r.random() < 0.1 else f"</{tag.split(' ')[0]}>"
        self.out.append(f"<{tag}>{text}{close}")
        self.labels.append(label)

    def open(self, spec: str) -> str:
        ends = []
        for step in spec.split("/"):
            tag, _, name = step.partition(".")
            attr = ""
            if name:
                name = self.r.choice([name, name, f"{name}-{self.r.choice(['box', 'wrap', 'area', 'list', 'main', 'inner'])}",
                                      f"{self.word()[:4]}-{name}", f"{name} {self.word()}"])
                attr = f' {self.r.choice(["class", "class", "class", "id"])}="{name}"'
            elif self.r.random() < 0.2:
                attr = f' class="{self.word()}"'
            self.out.append(f"<{tag}{attr}>")
            ends.append(f"</{tag}>")
        return "".join(reversed(ends))

    def furniture(self, kind: str) -> None:
        r = self.r
        spec = r.choice(CONTAINERS[kind])
        share = r.choice([0.0, 0.0, 0.3, 0.8])
        if spec.startswith("p."):
            self.put(False, f'p class="{spec[2:]}"', self.sentence(r.randint(3, 20), share))
            return
        end = self.open(spec)
        items = spec.split(".")[0] in ("ul", "ol")
        if kind in ("menu", "share") or items or kind == "footer" and r.random() < 0.3:
            if not items:
                self.out.append("<ul>")
            for _ in range(r.randint(2, 9)):
                text = self.words(r.randint(1, 3), share) if kind != "comments" else self.sentence(r.randint(3, 40), share)
                self.put(False, "li", f'<a href="/{self.word()}">{text}</a>' if r.random() < 0.85 and kind != "comments" else text)
            if not items:
                self.out.append("</ul>")
        elif kind == "form":
            for _ in range(r.randint(1, 4)):
                self.put(False, r.choice(["p", "div", "button", "label", "legend"]).replace("label", "p"), self.words(r.randint(1, 5), 0.5))
        elif kind in ("advert", "notice", "footer") and r.random() < 0.6:
            text = self.sentence(r.randint(2, 25), share)
            if kind == "footer":
                text = f"&copy; {self.word()}.example.com &middot; {text}" if r.random() < 0.7 else text
            self.out.append(text)
            self.labels.append(False)
        else:
            if r.random() < 0.5:
                self.put(False, r.choice(["h1", "h2", "h3", "h4"] if kind == "header" else ["h2", "h3", "h4"]), self.words(r.randint(1, 4), share))
            for _ in range(r.randint(1, 6 if kind == "comments" else 4)):
                if kind == "comments" and r.random() < 0.5:
                    self.out.append(f'<{"article" if r.random() < 0.3 else "div"} class="comment">')
                    self.put(False, "p", self.sentence(r.randint(2, 60), share))
                    self.out.append("</article>" if "<article" in self.out[-2] else "</div>")
                else:
                    self.put(False, r.choice(["p", "p", "div", "li"]) if kind != "header" else "p", self.sentence(r.randint(2, 45), share))
        self.out.append(end)

    def article(self, inside: list[str]) -> None:
        r = self.r
        bare = r.random() < 0.08
        end = "" if bare else self.open(r.choice(MAIN) if r.random() < 0.6 else "article")
        if r.random() < 0.85:
            lead = r.random() < 0.15
            self.out.append("<header>" if lead else "")
            self.put(True, "h1", self.words(r.randint(2, 12)))
            self.out.append("</header>" if lead else "")
        n = r.choice([1, 1, 2, 3, 4, 5, 6, 8, 10, 14, 25])
        for i in range(n):
            kind = r.random()
            if inside and i == n // 2:
                self.furniture(inside.pop())
            if kind < 0.75:
                text = self.sentence(r.choice([1, 2, 4, 8, 15, 30, 60, 120, 240]))
                if r.random() < 0.2:
                    text = f'<b>{text}' + ("</b>" if r.random() < 0.5 else "<br>")
                if r.random() < 0.15:
                    text += f' <a href="/{self.word()}">{self.words(2)}</a> {self.word()}'
                self.put(True, "p" if r.random() < 0.92 else "div", text)
            elif kind < 0.83:
                self.put(True, r.choice(["h2", "h3", "h4"]), self.words(r.randint(1, 7)))
            elif kind < 0.9:
                tag = r.choice(["ul", "ol"])
                self.out.append(f"<{tag}>")
                for _ in range(r.randint(2, 5)):
                    self.put(True, "li", self.sentence(r.randint(2, 18)))
                self.out.append(f"</{tag}>")
            elif kind < 0.95:
                self.put(True, r.choice(["blockquote", "pre", "figcaption"]), self.sentence(r.randint(3, 30)))
            else:
                self.out.append("<table>")
                for _ in range(r.randint(1, 3)):
                    self.out.append("<tr>")
                    for _ in range(2):
                        self.put(True, "td", self.words(r.randint(1, 4)))
                    self.out.append("</tr>")
                self.out.append("</table>")
        self.out.append(end)
