"""Labelled web pages to train the extraction model on: varied layouts with marked content.

``data-content="1"`` marks an element whose text is the article, ``"0"`` one whose
text is not; the mark holds for what is inside. Lengths of content and of the
rest overlap on purpose, so that neither a short article nor a long notice is
told by its length alone. An article stands in ``article``, ``main`` or a box with
a telling name, in boxes without a name or with one that says nothing, or right
in ``body`` between other parts of the page; readers' comments stand after it
or inside it.
"""

from __future__ import annotations

import random

# Class and id names by what they hold.
NAMES = {
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion banner adsense teaser".split(),
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs topbar toc pagination pager tabs".split(),
    "header": "header masthead top logo branding site".split(),
    "footer": "footer foot bottom copyright colophon legal".split(),
    "sidebar": "sidebar side aside related recommended widget rail popular trending more".split(),
    "notice": "cookie cookies consent notice gdpr banner popup modal alert overlay disclaimer privacy".split(),
    "form": "newsletter subscribe signup search login form register contact".split(),
    "comments": "comments comment discussion replies reply respond disqus reader responses".split(),
    "share": "share social sharing follow tags meta byline author".split(),
}
BODY = "content article post entry story main body text page".split()
_SYLLABLES = "an be co da el fi go hu in ka le mo nu or pa re sa ti um va we xo ye zu".split()


# Names that say nothing about what is inside.
PLAIN = "c x wrap wrapper container inner outer col row box grid layout section block css sc el app root site page center left right".split()


def _words(rng: random.Random, least: int, most: int) -> str:
    out = ["".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(least, most))]
    return " ".join(out).capitalize() + rng.choice([".", ".", "", "!", "?"])


def _links(rng: random.Random) -> str:
    return "".join(f'<li><a href="/x">{_words(rng, 1, 3)}</a></li>' for _ in range(rng.randint(2, 7)))


def _named(rng: random.Random, kind: str) -> str:
    name = rng.choice(NAMES[kind])
    if rng.random() < 0.3:
        name += rng.choice(["-box", " block", "-wrap", "-inner", "_top", " x1"])
    return rng.choice([f'class="{name}"', f'id="{name}"', f'class="{rng.choice(PLAIN)}{rng.randint(1, 9)} {name}"'])


def _other(rng: random.Random, kind: str) -> str:
    """A part of a page that is not its article."""
    box, text = _named(rng, kind), _words(rng, 2, 40)
    inner = rng.choice([text, f"<p>{text}</p>", f"<p>{text}</p><p>{_words(rng, 2, 25)}</p>", f"<h3>{_words(rng, 1, 4)}</h3><p>{text}</p>"])
    if kind == "menu":
        return rng.choice([f'<nav data-content="0"><ul>{_links(rng)}</ul></nav>', f'<div {box} data-content="0"><ul>{_links(rng)}</ul></div>', f'<ul {box} data-content="0">{_links(rng)}</ul>'])
    if kind == "header":
        title = f"<h1>{_words(rng, 1, 4)}</h1>" if rng.random() < 0.3 else f"<h2>{_words(rng, 1, 4)}</h2>"
        logo = rng.choice([f'<a href="/">{_words(rng, 1, 3)}</a>', f'<div class="logo">{_words(rng, 1, 3)}</div>', f"<h1>{_words(rng, 1, 3)}</h1>", f"<p>{text}</p>"])
        return rng.choice([f'<header data-content="0">{logo}</header>', f'<header {box} data-content="0">{logo}</header>', f'<header data-content="0">{title}{text}</header>', f'<div {box} data-content="0">{title}<p>{text}</p></div>'])
    if kind == "footer":
        return rng.choice([f'<footer data-content="0">&copy; {text}</footer>', f'<footer data-content="0">{inner}</footer>', f'<div {box} data-content="0">{inner}</div>'])
    if kind == "sidebar":
        return rng.choice([f'<aside data-content="0">{inner}</aside>', f'<aside {box} data-content="0">{inner}<ul>{_links(rng)}</ul></aside>', f'<div {box} data-content="0">{inner}</div>'])
    if kind == "form":
        controls = '<input name="q"><button>Go</button>'
        return rng.choice([f'<form data-content="0"><p>{text}</p>{controls}</form>', f'<form {box} data-content="0"><label>{text}</label>{controls}</form>', f'<div {box} data-content="0"><form>{text}{controls}</form></div>'])
    if kind == "comments":
        return _comments(rng, box)
    tag = rng.choice(["div", "div", "section", "aside", "p"])
    return f'<{tag} {box} data-content="0">{text if tag == "p" else inner}</{tag}>'


def _comments(rng: random.Random, box: str) -> str:
    """What readers wrote: plain blocks, or boxes with a name of their own for each, as long as paragraphs of an article."""
    tag, own = rng.choice(["p", "div", "li"]), rng.choice(["comment", "reply", "response", "item"])
    each = []
    for _ in range(rng.randint(1, 5)):
        text = _words(rng, 3, 60)
        each.append(rng.choice([
            f"<{tag}>{text}</{tag}>",
            f'<div class="{own}"><p>{text}</p></div>',
            f'<article class="{own}"><header>{_words(rng, 1, 2)}</header><p>{text}</p></article>',
            f'<li class="{own}"><div class="{own}-body"><p>{text}</p><p>{_words(rng, 2, 30)}</p></div></li>',
            f"<blockquote>{text}</blockquote>",
        ]))
    title = rng.choice(["", f"<h2>{_words(rng, 1, 3)}</h2>", f"<h3>{_words(rng, 1, 3)}</h3>"])
    outer = rng.choice(["section", "div", "div", "ol", "ul"])
    return f'<{outer} {box} data-content="0">{title}{"".join(each)}</{outer}>'


def _plain(rng: random.Random) -> str:
    """An attribute that tells nothing, or none."""
    kind = rng.random()
    if kind < 0.4:
        return ""
    name = f"{rng.choice(PLAIN)}{rng.choice(['', '', rng.randint(1, 20), '-' + rng.choice(PLAIN)])}" if kind < 0.75 else _words(rng, 1, 1).lower().strip(".!?")
    return f' {rng.choice(["class", "class", "id"])}="{name}"'


def _heading(rng: random.Random) -> str:
    tag = rng.choice(["h2", "h2", "h3", "h3", "h4", "h5", "h6"])
    return f"<{tag}>{_words(rng, 1, 6)}</{tag}>"


def _block(rng: random.Random) -> str:
    """A block of an article."""
    text = _words(rng, 1, 60)
    if rng.random() < 0.2:
        text = f"<b>{text}" + rng.choice(["</b>", "<br>"])
    if rng.random() < 0.15:
        text += f' <a href="/y">{_words(rng, 1, 3)}</a>'
    kind = rng.random()
    if kind < 0.57:
        about = _plain(rng) if rng.random() < 0.25 else ""
        return f"<p{about}>{text}" + rng.choice(["</p>", "</p>", "</p>", ""])
    if kind < 0.64:
        return _heading(rng)
    if kind < 0.74:
        tag = rng.choice(["ul", "ol"])
        return f"<{tag}>" + "".join(f"<li>{_words(rng, 1, 15)}</li>" for _ in range(rng.randint(1, 4))) + f"</{tag}>"
    if kind < 0.77:
        return "<dl>" + "".join(f"<dt>{_words(rng, 1, 4)}</dt><dd>{_words(rng, 1, 20)}</dd>" for _ in range(rng.randint(1, 3))) + "</dl>"
    if kind < 0.81:
        return f"<blockquote>{text}</blockquote>"
    if kind < 0.86:
        head = rng.choice(["", f"<tr><th>{_words(rng, 1, 3)}</th><th>{_words(rng, 1, 3)}</th></tr>"])
        return f"<table>{head}<tr><td>{_words(rng, 1, 5)}</td><td>{_words(rng, 1, 5)}</td></tr></table>"
    if kind < 0.9:
        return f'<figure><img src="/i"><figcaption>{_words(rng, 1, 20)}</figcaption></figure>'
    if kind < 0.92:
        return f"<pre>{text}</pre>"
    if kind < 0.97:
        return f"<div{_plain(rng)}>{text}</div>"
    return _other(rng, rng.choice(["ad", "share", "form", "sidebar"]))


def _nested(rng: random.Random, parts: list[str]) -> list[str]:
    """The blocks of an article below sections or plain divs, as they are laid out on many pages."""
    out, at, tag = [], 0, rng.choice(["section", "div"])
    while at < len(parts):
        n = rng.randint(1, 4)
        heading = _heading(rng) if rng.random() < (0.8 if tag == "section" else 0.2) else ""
        out.append(f"<{tag}{_plain(rng) if rng.random() < 0.4 else ''}>{heading}{''.join(parts[at : at + n])}</{tag}>")
        at += n
    return [f"<div>{''.join(out)}</div>"] if rng.random() < 0.25 else out


def _article(rng: random.Random) -> tuple[str, bool]:
    """An article, and whether it has an element of its own (else what stands around it is marked)."""
    brief = rng.random() < 0.25  # a few words, often fewer than what readers wrote about them
    parts = [f"<p>{_words(rng, 1, 6)}</p>"] if brief else [_block(rng) for _ in range(rng.randint(1, 7))]
    if rng.random() < 0.45 and not brief:
        parts = _nested(rng, parts)
    title = rng.choice(["", f"<h1>{_words(rng, 2, 9)}</h1>", f"<h1>{_words(rng, 2, 9)}</h1>", f"<header><h1>{_words(rng, 2, 9)}</h1></header>"])
    if rng.random() < 0.3:
        parts.append(_other(rng, "comments"))
    layout = rng.random()
    if layout >= 0.84:  # a header in body is that of the site
        title = title.removeprefix("<header>").removesuffix("</header>")
    inner, name = title + "".join(parts), rng.choice(BODY)
    if layout < 0.28:
        return f'<article data-content="1">{inner}</article>', True
    if layout < 0.36:
        return f'<main data-content="1">{inner}</main>', True
    if layout < 0.43:
        return f'<main><article data-content="1">{inner}</article></main>', True
    if layout < 0.56:
        return f'<div class="{name}" data-content="1">{inner}</div>', True
    if layout < 0.66:
        return f'<div id="{name}"><div class="{rng.choice(BODY)}" data-content="1">{inner}</div></div>', True
    if layout < 0.84:  # one to three boxes that tell nothing
        inner = f'<div{_plain(rng)} data-content="1">{inner}</div>'
        for _ in range(rng.randint(0, 2)):
            inner = f"<div{_plain(rng)}>{inner}</div>"
        return inner, True
    return inner, False


def labelled_pages(n: int = 1200, seed: int = 6) -> list[str]:
    rng, out = random.Random(seed), []
    kinds = [k for k in NAMES if k not in ("footer", "comments", "share")]
    for _ in range(n):
        before = [_other(rng, k) for k in rng.sample(kinds, rng.randint(0, 3))]
        after = [_other(rng, k) for k in rng.sample(list(NAMES), rng.randint(0, 4))]
        for kind in ("comments", "notice"):  # often more words than a brief article has
            if rng.random() < 0.3:
                after.insert(0, _other(rng, kind))
        article, own = _article(rng)
        middle, mark = "".join([*before, article, *after]), "" if own else ' data-content="1"'
        if rng.random() < 0.25:
            middle = f'<div class="{rng.choice(["wrapper", "container", "page", "site", "main", "x"])}"{mark}>{middle}</div>'
        head = f"<head><title>{_words(rng, 1, 6)}</title><style>p{{}}</style><script>a()</script></head>"
        out.append(f"<!DOCTYPE html><html>{head}<body{mark}>{middle}</body></html>")
    return out
