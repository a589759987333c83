"""Pages with known main text, drawn from many layouts: the labelled data that the extractor is trained on."""

from __future__ import annotations

import random

_ONSETS = "b c d f g h k l m n p r s t v w br ch cl dr fl gr pl pr sh sp st th tr é ü ñ".split()
_VOWELS = "a e i o u ai ea ie ou é ä ö".split()
_MENU = ("Home", "About", "Contact", "News", "Sport", "Login", "Blog", "Shop", "Help", "Archive")
_CONTENT = ("content", "post", "entry-content", "article-body", "story", "main-text", "page-content", "post-body", "text")


class Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def word(self) -> str:
        return "".join(self.r.choice(_ONSETS) + self.r.choice(_VOWELS) for _ in range(self.r.randint(1, 3)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self) -> str:
        return self.words(1 if self.r.random() < 0.15 else 4, 18).capitalize() + self.r.choice("....?!")

    def paragraph(self) -> str:
        text = " ".join(self.sentence() for _ in range(self.r.choice((1, 1, 2, 3, 5, 8))))
        if self.r.random() < 0.12:  # tables turned to text, junk and unfinished sentences
            mark = self.r.choice((" | ", "*** ", "%%% ", ", ", " - "))
            text = text.replace(" ", mark).rstrip(".?!") + self.r.choice(("", mark.rstrip()))
        return text

    def links(self, n: int) -> str:
        name = lambda: self.r.choice(_MENU) if self.r.random() < 0.3 else self.words(1, 2)
        item = lambda: f'<a href="/{self.word()}">{name()}</a>'
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{item()}</li>" for _ in range(n)) + "</ul>"
        return self.r.choice((" | ", " ")).join(item() for _ in range(n))


def _boxed(w: Writer, tag: str, marks: tuple[str, ...], inner: str) -> str:
    if tag != "div":
        return f"<{tag}{f' class="{w.r.choice(marks)}"' if w.r.random() < 0.4 else ''}>{inner}</{tag}>"
    return f'<div {w.r.choice(("class", "id"))}="{w.r.choice(marks)}">{inner}</div>'


def _noise(w: Writer, kind: str) -> str:
    r = w.r
    tag = lambda own: own if r.random() < 0.6 else "div"
    if kind == "menu":
        return _boxed(w, tag("nav"), ("menu", "nav", "navbar", "breadcrumb", "navigation"), w.links(r.randint(3, 8)))
    if kind == "header":
        inner = f"<div>{w.words(1, 3)}</div>" + (w.links(3) if r.random() < 0.5 else f"<p>{w.sentence()}</p>")
        return _boxed(w, tag("header"), ("header", "masthead", "site-header", "top", "banner"), inner)
    if kind == "footer":
        inner = f"<p>&copy; {r.randint(1999, 2025)} {w.words(1, 4)} &middot; {w.sentence()}</p>" if r.random() < 0.5 else f"&copy; {w.word()}.{w.word()} &middot; {w.sentence()}"
        return _boxed(w, tag("footer"), ("footer", "site-footer", "bottom", "copyright", "legal"), inner + (w.links(3) if r.random() < 0.3 else ""))
    if kind == "aside":
        inner = f"<h3>{w.words(1, 3)}</h3>" + (w.links(r.randint(3, 6)) if r.random() < 0.6 else f"<p>{w.paragraph()}</p>")
        return _boxed(w, tag("aside"), ("sidebar", "related", "widget", "aside", "recommended", "popular"), inner)
    if kind == "advert":
        return _boxed(w, "div", ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner-ad"), w.paragraph() if r.random() < 0.6 else f"<p>{w.sentence()}</p>")
    if kind == "notice":
        inner = f"<p>{w.paragraph()}</p>" + (f"<button>{w.words(1, 2)}</button>" if r.random() < 0.6 else "")
        return _boxed(w, "div", ("cookie", "cookie-notice", "notice", "consent", "gdpr", "alert", "popup", "modal", "newsletter", "cookie-banner"), inner)
    if kind == "form":
        inner = f"<label>{w.words(1, 3)}</label><input name=q>" + (f"<p>{w.sentence()}</p>" if r.random() < 0.5 else "") + f"<button>{w.words(1, 2)}</button>"
        return f"<form action=/{w.word()}>{inner}</form>"
    if kind == "share":
        return _boxed(w, "div", ("share", "social", "tags", "meta", "byline", "toolbar"), w.links(3))
    one = lambda: _boxed(w, "div", ("comment", "reply", "comment-body"), f"<b>{w.word()}</b><p>{w.paragraph()}</p>")
    inner = f"<h3>{w.words(1, 2)}</h3>" + "".join(one() for _ in range(r.randint(1, 4)))
    return _boxed(w, "section" if r.random() < 0.5 else "div", ("comments", "comment-list", "discussion", "responses", "reader-comments"), inner)


def _article(w: Writer) -> tuple[str, list[str]]:
    r, texts, html = w.r, [], []

    def put(tag: str, text: str, shown: str | None = None) -> None:
        texts.append(text)
        html.append(f"<{tag}>{shown or text}</{tag}>")

    if r.random() < 0.85:
        put("h1", w.words(3, 12).capitalize() + r.choice(("", ".")))
    for _ in range(r.choice((1, 2, 4, 6, 9, 14))):
        x = r.random()
        if x < 0.75:
            a, b = w.paragraph(), w.sentence()
            if r.random() < 0.25:
                html.append(f"<p><b>{a}<br>")
                texts.append(a)
            elif r.random() < 0.25:
                put("p", f"{a} {b}", f"{a} <a href=/{w.word()}>{b}</a>" if r.random() < 0.6 else f"{a} <em>{b}</em>")
            else:
                put("p", a)
        elif x < 0.84:
            put(r.choice(("h2", "h3")), w.words(2, 6).capitalize())
        elif x < 0.92:
            html.append("<ul>")
            for _ in range(r.randint(2, 5)):
                put("li", w.words(3, 14))
            html.append("</ul>")
        elif x < 0.97:
            html.append("<blockquote>")
            put("p", w.paragraph())
            html.append("</blockquote>")
        else:
            html.append("<table><tr>")
            for _ in range(3):
                put("td", w.words(1, 5))
            html.append("</tr></table>")
        if r.random() < 0.04:
            html.append(_noise(w, r.choice(("advert", "aside", "share"))))
    return "".join(html), texts


def labelled_page(seed: int) -> tuple[str, set[str]]:
    """(html, texts of the main blocks) of one page; its layout follows from the seed."""
    w = Writer(seed)
    r = w.r
    body, texts = _article(w)
    comments = _noise(w, "comments") if r.random() < 0.35 else ""
    x = r.random()
    if x < 0.45:
        body = f"<article>{body}{comments if r.random() < 0.3 else ''}</article>" + (comments if r.random() < 0.7 else "")
    elif x < 0.65:
        body = f"<main>{body}</main>{comments}"
    elif x < 0.9:
        body = f'<div {r.choice(("class", "id"))}="{r.choice(_CONTENT)}">{body}</div>{comments}'
    else:
        body = f"<div>{body}</div>{comments}"
    if r.random() < 0.2:
        body = f'<div class="wrapper {w.word()}">{body}</div>'
    before = [_noise(w, k) for k in ("header", "menu", "notice", "advert", "form") if r.random() < 0.5]
    after = [_noise(w, k) for k in ("aside", "share", "form", "advert", "notice", "footer", "menu") if r.random() < 0.4]
    r.shuffle(before)
    title = texts[0][:60] if r.random() < 0.6 else w.words(2, 6)
    head = f"<!DOCTYPE html><html><head><meta charset=utf-8><title>{title}</title><style>p{{}}</style></head><body>"
    page = head + "".join(before) + body + "".join(after) + "</body></html>"
    if r.random() < 0.1:
        page = page[: int(len(page) * r.uniform(0.6, 0.98))]
    return page, set(texts)


def plain_page(seed: int) -> tuple[str, set[str]]:
    """(html, texts of the main blocks) of a page with little markup and few or no marks: paragraphs, bare text, lists of terms."""
    w = Writer(seed)
    r = w.r
    texts: list[str] = []

    def text(*choices: str) -> str:
        texts.append(r.choice(choices))
        return texts[-1]

    def paragraph() -> str:
        return f"<p>{text(w.sentence(), w.paragraph(), w.words(1, 6).capitalize() + '.')}</p>"

    def terms() -> str:
        pairs = (f"<dt>{text(w.words(1, 4), w.words(1, 4).capitalize())}</dt><dd>{text(w.sentence(), w.words(2, 9))}</dd>" for _ in range(r.randint(2, 5)))
        return f"<dl>{''.join(pairs)}</dl>"

    kind = r.random()
    if kind < 0.45:
        body = "".join(paragraph() for _ in range(r.choice((1, 1, 1, 2, 4))))
    elif kind < 0.7:
        body = text(w.sentence(), w.paragraph())
    else:
        body = (f"<h1>{text(w.words(1, 6).capitalize())}</h1>" if r.random() < 0.6 else "") + (paragraph() if r.random() < 0.7 else "") + terms() + (paragraph() if r.random() < 0.5 else "")
    for _ in range(r.choice((0, 0, 1, 1, 2))):
        mark = f' class="{r.choice(_CONTENT)}"' if kind >= 0.7 and r.random() < 0.4 else ""
        tag = r.choice(("article", "main")) if kind >= 0.7 and not mark and r.random() < 0.4 else "div"
        body = f"<{tag}{mark}>{body}</{tag}>"
    if r.random() < 0.4:
        body = _noise(w, r.choice(("menu", "header", "notice"))) + body
    if r.random() < 0.4:
        body += _noise(w, r.choice(("footer", "aside", "share", "advert")))
    if r.random() < 0.7:
        title = f"<title>{w.words(1, 5)}</title>" if r.random() < 0.5 else ""
        body = f"<html><head>{title}</head><body>{body}</body></html>"
    return body, set(texts)
