"""Main text of hand-written pages: articles in body, in boxes that tell nothing, with comments inside, with formulas."""

import numpy as np
import pytest

from emporia.llm import html_extract, labelled_pages

L = "This is a long paragraph of an article, with several clauses and enough words to count as real text of a page, as it stands in many of them."
M = "Another paragraph that goes on for a while about the same matter, so that a reader learns something more about it than the title says."
S = "A short one."
N = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>"
F = "<footer>&copy; us</footer>"
PAGES = [
    (f"<body><h1>Title</h1><p>{L}</p><p>{M}</p></body>", f"Title {L} {M}"),
    (f"<div class='c1'><div class='c2'><p>{L}</p></div></div>", L),
    (f"<div class='c1'><div class='c2'><p>{L}</p><p>{M}</p></div></div>", f"{L} {M}"),
    (f"<article><h1>T of it</h1><p>{L}</p><section class='comments'><h3>Replies</h3><p>{M}</p></section></article>", f"T of it {L}"),
    (f"<article><p>{L} <math><mi>a</mi><mo>+</mo><mn>1</mn></math></p></article>", f"{L} a+1"),
    (f"<body>{N}<h1>Title</h1><p>{L}</p><p>{S}</p><p>{M}</p>{F}</body>", f"Title {L} {S} {M}"),
    (f"<body>{N}<div><h1>Title</h1><p>{L}</p><p>{M}</p></div>{F}</body>", f"Title {L} {M}"),
    (f"<body>{N}<div class='css-x1'><div class='css-y2'><h1>Title</h1><p>{L}</p><p>{M}</p></div></div>{F}</body>", f"Title {L} {M}"),
    (f"<body><div id=root><div id=app>{N}<div><p>{L}</p><p>{M}</p></div></div></div>{F}</body>", f"{L} {M}"),
    (f"<body>{N}<h1>Title</h1><p>{L}</p><h2>Part</h2><p>{M}</p><ul><li>One thing</li><li>And another</li></ul>{F}</body>", f"Title {L} Part {M} One thing And another"),
    (f"<body>{N}<h1>Title</h1><p>{L}</p><div class='ad'>Buy this now</div><p>{M}</p>{F}</body>", f"Title {L} {M}"),
    (f"<body>{N}<p>{L}</p><blockquote>{M}</blockquote><p>{L}</p></body>", f"{L} {M} {L}"),
    (f"<article><p>{L}</p><div id='comments'><article class='comment'><header>Ann</header><p>{M}</p></article></div></article>{F}", L),
    (f"<article><p>{L}</p><ol class='comment-list'><li class='comment'><div class='comment-body'><p>{M}</p></div></li></ol></article>", L),
    (f"<main><h1>Title</h1><p>{L}</p><div class='responses'><div class='response'><p>{M}</p></div></div></main>", f"Title {L}"),
    (f"<div class=c1><p>{L}</p><p>{M}</p><div class='comments'><p>{L}</p></div></div>", f"{L} {M}"),
    (f"<body><h1>Title</h1><p>{L}</p><p>{M}</p><div class=comments><h3>Comments</h3><p>{L}</p><p>{M}</p></div></body>", f"Title {L} {M}"),
    (f"<body><div class='cookie-consent'><p>{M}</p></div><h1>Title</h1><p>{L}</p></body>", f"Title {L}"),
    (f"<body><div class='wrapper'>{N}<h1>Title</h1><p>{L}</p><p>{M}</p><aside><h3>More</h3><p>{S}</p></aside></div>{F}</body>", f"Title {L} {M}"),
    (f"<div><div><div><h1>Title</h1><div><p>{L}</p></div><div><p>{M}</p></div></div></div></div>", f"Title {L} {M}"),
    (f"<body>{N}<div class=row><div class=col><h1>Title</h1><p>{L}</p><p>{M}</p></div><div class='col sidebar'><h3>Popular</h3><ul><li><a href=x>One</a></li></ul></div></div>{F}</body>", f"Title {L} {M}"),
    (f"<section><h1>Title</h1><p>{L}</p><p>{M}</p></section>{F}", f"Title {L} {M}"),
    (f"<body>{N}<center><h1>Title</h1><p>{L}</p></center><p>{M}</p></body>", f"Title {L} {M}"),
    (f"<body><table class=x><tr><td><p>{L}</p><p>{M}</p></td></tr></table>{F}</body>", f"{L} {M}"),
    (f"<body>{N}<div><p>{L}</p><form><label>Mail</label><input></form><p>{M}</p></div>{F}</body>", f"{L} {M}"),
    (f"<body><p>{L}</p><p>{M}</p><form class=newsletter><p>{S}</p></form></body>", f"{L} {M}"),
    (f"<article><h1>Title</h1><p>{L}</p><section><h2>Part</h2><p>{M}</p></section><section id=discussion><h2>What readers say</h2><blockquote>{L}</blockquote></section></article>", f"Title {L} Part {M}"),
    (f"<body><header><h1>Site</h1></header><h1>Title</h1><p>{L}</p><p>{M}</p><footer><p>{S}</p></footer></body>", f"Title {L} {M}"),
]


@pytest.mark.parametrize("html, text", PAGES)
def test_main_text_of_layouts(html, text):
    assert html_extract.main_text(html, html_extract.default_model()) == text


def test_messages_over_all_pages_are_those_of_each():
    pages = [html_extract.parse(x) for x in labelled_pages.labelled_pages(30, seed=3)]
    forest, rng = html_extract.Forest(pages), np.random.default_rng(1)
    weights, edges = rng.normal(size=len(forest.names)), rng.normal(size=(2, 2))
    found, counts = forest.expected(weights, edges)
    model = html_extract.Model(dict(zip(forest.names, weights.tolist())), edges.tolist())
    each = [html_extract.marginals(p, model) for p in pages]
    assert found == pytest.approx([x for own, _ in each for x in own], abs=1e-9)
    assert counts == pytest.approx(sum(np.array(c) for _, c in each), abs=1e-6)


def test_the_model_is_fitted_once_and_always_the_same():
    again = html_extract.train(labelled_pages.labelled_pages())
    assert again == html_extract.default_model() is html_extract.default_model()
