"""Labelled pages for training: composed by rule from parts that are content or not."""

from __future__ import annotations

import random
from collections.abc import Iterator

#: The attribute that marks a content block.
MARK = "data-is-content"
PAGES = 900

# Names that page authors give to parts, by what the part is.
_BODY = "content article post entry story body main text prose blog news page read markdown"
_NAVIGATION = "nav menu navbar navigation breadcrumb breadcrumbs pagination pager toc links tabs topbar toolbar"
_HEADER = "header masthead banner logo branding top site-header hero"
_FOOTER = "footer copyright legal colophon bottom site-footer imprint"
_SIDE = "sidebar aside related widget recommended trending popular tags archive categories more recent rail"
_NOTICE = "cookie notice consent alert gdpr popup modal overlay disclaimer warning paywall message"
_ADVERT = "ad ads advert advertisement sponsored promo promotion adsense sponsor dfp outbrain taboola"
_FORM = "form search newsletter subscribe signup login contact register"
_SHARE = "share social follow buttons like tweet"
_COMMENT = "comment comments commentlist replies disqus discussion responses reviews reply thread"
_SYLLABLES = "the an ri to se lo va che mu ein de la con per ist und qua ste nor wel tra pos um fi".split()


def _words(r: random.Random, low: int, high: int) -> str:
    return " ".join("".join(r.choices(_SYLLABLES, k=r.randint(1, 3))) for _ in range(r.randint(low, high)))


def _sentences(r: random.Random, low: int, high: int) -> str:
    parts = [_words(r, 2, 24).capitalize() + r.choice(".......!?") for _ in range(r.randint(low, high))]
    return " ".join(p if r.random() > 0.04 else f'<a href="/{i}">{p}</a>' for i, p in enumerate(parts))


def _name(r: random.Random, names: str, prefix: str = "") -> str:
    word = r.choice(names.split())
    shape = r.choice(["{0}", "{0}-{1}", "{1}-{0}", "{0}_{1}", "site-{0}", "{0}-wrapper", "{0}-inner", "{0} {1}", "js-{0}"])
    other = r.choice("box block area list item section container left right col".split())
    return r.choice(["class", "class", "id"]) + f'="{prefix}{shape.format(word, other)}"'


def _links(r: random.Random) -> str:
    items = [f'<a href="/{i}">{_words(r, 1, 4)}</a>' for i in range(r.randint(2, 9))]
    close = "</li>" if r.random() < 0.8 else ""
    return r.choice([" | ".join(items), " ".join(items), "<ul>" + "".join(f"<li>{x}{close}" for x in items) + "</ul>"])


def _paragraph(r: random.Random, mark: str) -> str:
    text = _sentences(r, 1, 7) if r.random() < 0.85 else _words(r, 1, 6)
    if r.random() < 0.06:
        text = " ".join([_words(r, 1, 1) + r.choice(["", ",", "."])] * r.randint(3, 60))  # junk is text, too
    if r.random() < 0.15:
        text = f"<b>{text}" + r.choice(["</b>", "<br>"])
    kind = r.random()
    if kind < 0.8:
        return f"<p {mark}>{text}" + ("</p>" if r.random() < 0.9 else "")
    if kind < 0.85:
        return f"<blockquote {mark}>{text}</blockquote>"
    if kind < 0.92:
        return "<ul>" + "".join(f"<li {mark}>{_words(r, 2, 14)}</li>" for _ in range(r.randint(2, 5))) + "</ul>"
    if kind < 0.96:
        return f"<pre {mark}>{_words(r, 3, 20)}</pre>"
    return "<table><tr>" + "".join(f"<td {mark}>{_words(r, 1, 5)}</td>" for _ in range(r.randint(2, 4))) + "</tr></table>"


def _article(r: random.Random) -> str:
    mark = MARK
    title = f"<h1 {mark}>{_words(r, 2, 12).capitalize()}</h1>"
    if r.random() < 0.2:
        title = f"<header>{title}</header>"
    parts = [title] if r.random() < 0.85 else []
    for _ in range(r.randint(1, 12)):
        if r.random() < 0.15:
            level = r.randint(2, 4)
            parts.append(f"<h{level} {mark}>{_words(r, 1, 8).capitalize()}</h{level}>")
        parts.append(_paragraph(r, mark))
        if r.random() < 0.05:
            parts.append(_other(r, _ADVERT))
        if r.random() < 0.04:
            parts.append(_share(r))
    inner = "".join(parts)
    shape = r.random()
    if shape < 0.3:
        return f"<article {_name(r, _BODY) if r.random() < 0.5 else ''}>{inner}</article>"
    if shape < 0.4:
        return f"<main>{inner}</main>"
    if shape < 0.85:
        inner = f"<div {_name(r, _BODY)}>{inner}</div>"
        return f"<div {_name(r, _BODY)}>{inner}</div>" if r.random() < 0.5 else inner
    if shape < 0.93:
        return f"<section>{inner}</section>"
    if shape < 0.97:
        return f"<table><tr><td>{_links(r)}</td><td>{inner}</td></tr></table>"
    return inner


def _other(r: random.Random, names: str, tag: str = "div") -> str:
    text = r.choice([_sentences(r, 1, 3), _sentences(r, 1, 5), _words(r, 2, 10), f"<p>{_sentences(r, 1, 4)}</p>"])
    head = f"<h{r.randint(2, 4)}>{_words(r, 1, 3)}</h3>" if r.random() < 0.3 else ""
    tag = r.choice([tag, "div", "section"])
    hidden = r.choice([" hidden", ' style="display:none"', ' aria-hidden="true"']) if r.random() < 0.05 else ""
    return f"<{tag} {_name(r, names)}{hidden}>{head}{text}</{tag}>"


def _share(r: random.Random) -> str:
    return f"<div {_name(r, _SHARE)}>{_links(r)}</div>"


def _form(r: random.Random) -> str:
    fields = f"<label>{_words(r, 1, 3)}</label><input name=q><button>{_words(r, 1, 2)}</button>"
    text = f"<p>{_sentences(r, 1, 2)}</p>" if r.random() < 0.5 else ""
    inner = f"<form {_name(r, _FORM) if r.random() < 0.6 else ''}>{text}{fields}</form>"
    return f"<div {_name(r, _FORM)}><h3>{_words(r, 1, 4)}</h3>{inner}</div>" if r.random() < 0.5 else inner


def _comments(r: random.Random) -> str:
    def one() -> str:
        who = f"<{r.choice(['span', 'div', 'h4', 'p'])} class=author>{_words(r, 1, 2)}</span>"
        said = "".join(f"<p>{_sentences(r, 1, 4)}</p>" for _ in range(r.randint(1, 2)))
        return f"{who}{said}"

    many = range(r.randint(1, 5))
    if r.random() < 0.5:
        inner = "<ol>" + "".join(f"<li {_name(r, _COMMENT)}>{one()}</li>" for _ in many) + "</ol>"
    else:
        inner = "".join(f"<div {_name(r, _COMMENT)}>{one()}</div>" for _ in many)
    tag = r.choice(["div", "section", "aside"])
    return f"<{tag} {_name(r, _COMMENT)}><h3>{_words(r, 1, 3)}</h3>{inner}</{tag}>"


def _page(r: random.Random) -> str:
    if r.random() < 0.12:  # nothing but the text
        plain = "".join(_paragraph(r, MARK) for _ in range(r.randint(1, 4)))
        texts = [_article(r), plain, plain, f"<div {MARK}>{_sentences(r, 1, 4)}</div>"]
        return r.choice(["{}", "<html><body>{}</body></html>", "<body>{}"]).format(r.choice(texts))
    top = [
        f"<nav>{_links(r)}</nav>",
        f"<div {_name(r, _NAVIGATION)}>{_links(r)}</div>",
        f"<header>{_words(r, 1, 4)}{_links(r)}</header>",
        f"<div {_name(r, _HEADER)}><h{r.randint(1, 2)}>{_words(r, 1, 4)}</h1><p>{_words(r, 2, 8)}</p></div>",
        f"<header {_name(r, _HEADER)}><p>{_sentences(r, 1, 2)}</p></header>",
        _other(r, _NOTICE), _other(r, _ADVERT), _form(r), f"<ul>{_links(r)}</ul>",
    ]
    low = [
        _other(r, _SIDE, "aside"), f"<aside>{_links(r)}<p>{_sentences(r, 1, 3)}</p></aside>", _other(r, _ADVERT, "aside"),
        f"<div {_name(r, _SIDE)}><h3>{_words(r, 1, 3)}</h3>{_links(r)}</div>", _other(r, _NOTICE), _share(r), _form(r),
        _comments(r), _comments(r), f"<div {_name(r, _NAVIGATION)}>{_links(r)}</div>",
    ]
    end = [
        f"<footer>&copy; {_words(r, 1, 5)} &middot; {_sentences(r, 1, 2)}</footer>",
        f"<div {_name(r, _FOOTER)}><p>{_sentences(r, 1, 3)}</p>{_links(r)}</div>",
        f"<footer {_name(r, _FOOTER)}>{_links(r)}<p>{_words(r, 2, 12)}</p></footer>",
    ]
    before = r.sample(top, r.randint(1, 4))
    after = r.sample(low, r.randint(0, 4)) + r.sample(end, r.randint(0, 2))
    if r.random() < 0.25 and after:
        before.append(after.pop(0))
    inner = "".join(before) + _article(r) + "".join(after)
    if r.random() < 0.3:
        inner = f"<div {r.choice(['', 'id=wrapper', 'class=container', 'id=page'])}>{inner}</div>"
    close = "</body></html>" if r.random() < 0.9 else ""
    return f"<!DOCTYPE html><html><head><title>{_words(r, 2, 6)}</title></head><body>{inner}{close}"


def composed_pages(pages: int = PAGES, seed: int = 11) -> Iterator[str]:
    """The same pages at every call."""
    r = random.Random(seed)
    for _ in range(pages):
        yield _page(r)
