"""Labelled pages to learn from: made from usual page layouts, with every block of article text marked.

The layouts differ in what holds the article and in what stands around and
within it. Words are made up, but for the phrases that such places usually have.
"""

from __future__ import annotations

import random

#: Begins every block of article text; no page has it otherwise.
MARK = "\ue000"

# What usually holds an article, from the outside in.
HOLDERS = [
    ['article'], ['main'], ['main', 'article'], ['div class="content"'], ['div id="content"'], ['div class="post-content"'],
    ['div class="entry-content"'], ['div class="article-body"'], ['section class="story"'], ['div id="main" class="main"'],
    ['div role="main"'], ['main', 'article', 'div class="body"'], ['div class="wrapper"', 'div class="post"', 'div class="entry"'],
    ['div class="container"', 'div class="text"'], ['table', 'tr', 'td class="content"'], ['div class="page"', 'article class="article"'],
    ['section', 'div class="post-body"'], ['div id="article"'], ['div class="main-content"', 'div class="article-text"'], [],
]
HEADERS = ['header', 'div id="header"', 'div class="masthead"', 'div class="site-header"', 'div class="topbar"', 'div class="header"']
MENUS = ['nav', 'div class="nav"', 'div id="navbar"', 'div class="menu"', 'div id="menu"', 'div class="breadcrumbs"', 'div class="navigation"', 'nav class="breadcrumb"', 'div role="navigation"']
SIDES = ['aside', 'div class="sidebar"', 'div id="sidebar"', 'div class="widget"', 'div id="secondary"', 'aside class="related"', 'div class="related-posts"', 'section class="recommended"', 'div class="side-column"']
ADVERTS = ['div class="ad"', 'div class="ads"', 'div class="advert"', 'div class="advertisement"', 'div class="sponsored"', 'div class="promo"', 'div id="ad-top"', 'div class="banner-ad"', 'aside class="ad"', 'div class="sponsor"']
NOTICES = ['div class="cookie-notice"', 'div id="cookie-banner"', 'div class="notice"', 'div class="alert"', 'div role="alert"', 'div class="popup"', 'div class="modal"', 'div class="gdpr-consent"', 'section class="notice"', 'div class="paywall"']
FORMS = ['form', 'form class="search"', 'form id="login"', 'form class="newsletter"', 'div class="subscribe"', 'div class="newsletter-signup"', 'div class="search-form"']
COMMENTS = ['section class="comments"', 'div id="comments"', 'div class="comment-list"', 'section id="comments"', 'div class="reader-comments"', 'div class="responses"', 'div class="discussion"', 'div class="user-comments"']
SHARES = ['div class="share"', 'div class="social"', 'div class="share-buttons"', 'div class="tags"']
FOOTERS = ['footer', 'div id="footer"', 'div class="footer"', 'div class="site-footer"', 'footer class="colophon"', 'div class="copyright"']

NOTICE_WORDS = ["We use cookies to improve this site.", "By continuing you accept our privacy policy.", "This site uses cookies. Accept", "Please subscribe to read more.", "You have read all free articles of this month."]
FORM_WORDS = ["Search", "Subscribe to our newsletter", "Your email", "Sign up", "Log in", "Password", "Send"]
COMMENT_WORDS = ["Comments", "3 comments", "Leave a reply", "Reply", "Log in to comment", "Report"]
SHARE_WORDS = ["Share", "Tweet", "Share this", "Print", "Email this"]
FOOTER_WORDS = ["© 2020", "All rights reserved.", "Privacy policy", "Terms of use", "Contact", "Imprint", "Powered by"]
SIDE_WORDS = ["Related", "Most read", "Latest news", "See also", "Archive", "About us"]


class _Page:
    def __init__(self, rng: random.Random):
        self.rng = rng

    def word(self) -> str:
        return "".join(self.rng.choice(["a", "e", "i", "o", "th", "er", "an", "re", "st", "nd", "qu", "é", "ü", "le"]) for _ in range(self.rng.randint(1, 5)))

    def words(self, least: int, most: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(least, most))).capitalize()

    def sentences(self, most: int) -> str:
        out = []
        for _ in range(self.rng.randint(1, most)):
            out.append(self.words(1, 5) if self.rng.random() < 0.2 else f"{self.words(4, 12)}, {self.words(2, 8).lower()}")
        return " ".join(f"{s}{self.rng.choice('....?!')}" for s in out)

    def within(self, holders: list[str], inner: str) -> str:
        for holder in reversed(holders):
            inner = f"<{holder}>{inner}</{holder.split()[0]}>"
        return inner

    def links(self, least: int = 2, most: int = 8) -> str:
        items = [f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(self.rng.randint(least, most))]
        style = self.rng.random()
        if style < 0.6:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return " | ".join(items) if style < 0.8 else "".join(f"<div>{i}</div>" for i in items)

    def paragraph(self) -> str:
        """One block of article text, or some."""
        rng, kind = self.rng, self.rng.random()
        text = MARK + self.sentences(rng.choice([1, 1, 2, 4, 8]))
        if rng.random() < 0.2:
            text += f' <a href="/{self.word()}">{self.words(1, 4)}</a> {self.words(2, 6).lower()}.'
        if kind < 0.55:
            opening = rng.choice(["<p>", "<p>", "<p>", '<p class="text">', '<p class="lead">', "<p><b>", "<p><em>"])
            return opening + text + rng.choice(["</p>", "</p>", "<br>", ""])
        if kind < 0.65:
            return f"<h{(n := rng.randint(2, 4))}>{MARK}{self.words(1, 8)}</h{n}>"
        if kind < 0.75:
            tag = rng.choice(["ul", "ol"])
            items = "".join(f"<li>{MARK}{rng.choice([self.words(1, 6), self.sentences(2)])}</li>" for _ in range(rng.randint(1, 5)))
            return f"<{tag}>{items}</{tag}>"
        if kind < 0.82:
            return f"<blockquote><p>{text}</p></blockquote>"
        if kind < 0.9:
            return f"<div>{text}</div>"
        if kind < 0.95:
            return f"<figure><img src='x.png'><figcaption>{MARK}{self.words(2, 9)}</figcaption></figure>"
        rows = "".join("<tr>" + "".join(f"<td>{MARK}{self.words(1, 4)}</td>" for _ in range(2)) + "</tr>" for _ in range(rng.randint(1, 3)))
        return f"<table>{rows}</table>"

    def place(self, holders: list[str], phrases: list[str], links: float = 0.5) -> str:
        """A part of the page that is not article text."""
        rng, parts = self.rng, []
        for _ in range(rng.randint(1, 3)):
            if rng.random() < links:
                parts.append(self.links())
            else:
                text = rng.choice([rng.choice(phrases) if phrases else self.words(1, 5), self.sentences(3)])
                parts.append(rng.choice([f"<p>{text}</p>", text, f"<h3>{text}</h3>", f"<div>{text}</div>", f"<span>{text}</span> "]))
        return self.within([rng.choice(holders)], "".join(parts))

    def comments(self) -> str:
        rng = self.rng
        entries = []
        for _ in range(rng.randint(1, 6)):
            body = f'<span class="author">{self.words(1, 2)}</span> <p>{self.sentences(4)}</p>'
            entries.append(self.within([rng.choice(['div class="comment"', "li", 'article class="comment"', "div"])], body))
        return self.within([rng.choice(COMMENTS)], f"<h3>{rng.choice(COMMENT_WORDS)}</h3>" + "".join(entries) + rng.choice(["", "<form><label>Reply</label><button>Send</button></form>"]))

    def page(self) -> str:
        rng = self.rng

        def maybe(share: float, make) -> str:
            return make() if rng.random() < share else ""

        def advert() -> str:
            return self.place(ADVERTS, ["Advertisement", "Sponsored", self.words(3, 9), self.sentences(2)], 0.15)

        def notice() -> str:
            return self.place(NOTICES, NOTICE_WORDS, 0.1)

        def form() -> str:
            phrase = rng.choice(FORM_WORDS)
            return self.within([rng.choice(FORMS)], f"<label>{phrase}</label><input name='q'>{maybe(0.5, lambda: f'<p>{self.sentences(2)}</p>')}<button>{rng.choice(FORM_WORDS)}</button>")

        title = self.words(2, 9)
        body = [rng.choice([f"<h1>{MARK}{title}</h1>", f"<h1>{MARK}{title}</h1>", f"<header><h1>{MARK}{title}</h1></header>", ""])]
        for _ in range(rng.choice([1, 2, 4, 8, 12])):
            body.append(self.paragraph())
            body.append(maybe(0.1, advert) + maybe(0.05, notice) + maybe(0.03, lambda: self.place(SIDES, SIDE_WORDS, 0.7)) + maybe(0.02, form))
        body.append(maybe(0.25, lambda: self.place(SHARES, SHARE_WORDS, 0.3)))
        inside = rng.random() < 0.3
        article = self.within(rng.choice(HOLDERS), "".join(body) + (self.comments() if inside else ""))
        side = maybe(0.5, lambda: self.place(SIDES, SIDE_WORDS))
        parts = [
            maybe(0.25, notice),
            maybe(0.6, lambda: self.place(HEADERS, [self.words(1, 3)], 0.4)),
            maybe(0.8, lambda: self.within([rng.choice(MENUS)], self.links())),
            maybe(0.4, advert),
            *([side, article] if rng.random() < 0.5 else [article, side]),
            "" if inside else maybe(0.4, self.comments),
            maybe(0.2, form),
            maybe(0.8, lambda: self.place(FOOTERS, FOOTER_WORDS, 0.4)),
            maybe(0.15, notice),
        ]
        if rng.random() < 0.2:  # nothing around the article
            parts = [article]
        head = f"<!DOCTYPE html><html><head><title>{title}</title><script>var a = '<p>';</script></head>"
        return f"{head}<body>{''.join(parts)}</body></html>"


def labelled_pages(n: int, seed: int) -> list[str]:
    """``n`` pages, the same for the same seed; article blocks begin with ``MARK``."""
    rng = random.Random(seed)
    return [_Page(rng).page() for _ in range(n)]
