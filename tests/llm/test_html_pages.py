"""Main text: malformed pages in linear time, articles in doubtful containers, and tags found by a plain search."""

from __future__ import annotations

import random
import re
import time

import pytest

from vasculum.llm import html_text

BODY = "".join(f"<p>Body, paragraph, number {i}, with some more words in it, and commas.</p>" for i in range(8))
TEXT = "\n".join(f"Body, paragraph, number {i}, with some more words in it, and commas." for i in range(8))
COMMENTS = "<div id=comments>" + "<p>Nice, but I beg to differ, as always, on every point that you make here.</p>" * 30 + "</div>"


def test_articles_in_doubtful_containers():
    form = f"<body><form action=x><div class=menu><a href=a>A</a></div><h1>T</h1>{BODY}<input name=q><select><option>one</select></form><footer>f</footer></body>"
    assert html_text.main_text(form) == f"T\n{TEXT}"
    assert html_text.main_text(f"<body><section class='search-engines'>{BODY}</section><p>tiny</p></body>") == f"{TEXT}\ntiny"
    quote = "<blockquote class=related-quote>As they said, long ago.</blockquote>"
    assert html_text.main_text(f"<article>{BODY}{quote}</article>") == f"{TEXT}\nAs they said, long ago."
    # Comments may be longer than the article, a short form or a notice may be all there is beside it: they go as before.
    assert html_text.main_text(f"<body><div>{BODY}</div>{COMMENTS}<form>Name, please<input></form><div class=cookies>We use cookies.</div></body>") == TEXT
    assert html_text.main_text(f"<body>{COMMENTS}<div class=newsletter>Sign up</div></body>") == ""


MALFORMED = {
    "open tags": "<a b ", "odd quotes": "<a b=\"'", "crossed quotes": "<a b='x\" ", "names": "<a", "declarations": "<!", "items": "<li>x", "cells": "<table><tr><td>x",
    "nested paragraphs": "<div><p>x", "raw ends": "<script>a</script ", "references": "&amp", "headings": "<h2>a</h2><p>b,c</p>",
}


@pytest.mark.parametrize("kind", [*MALFORMED, "nested", "unmatched ends", "inline before paragraphs"])
def test_malformed_pages_take_linear_time(kind):
    million = 1_000_000
    pages = {
        "nested": "<div>" * (million // 11) + "x" + "</div>" * (million // 11), "unmatched ends": "<b>" * (million // 6) + "</i>" * (million // 8),
        "inline before paragraphs": "<b>" * (million // 6) + "<p>x" * (million // 8),
    }
    page = pages[kind] if kind in pages else MALFORMED[kind] * (million // len(MALFORMED[kind]))
    before = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - before < 10  # a pass over the page for each tag takes hours


def test_tags_are_those_of_a_plain_search():
    """Brute force: at every < the whole tag is matched anew."""
    tag = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.DOTALL)
    parts = ["<p>", "</p>", "<a b=\"", "<i '", "\"", "'", ">", "<!", "<!-- c", "-->", "<?x?>", "<b c=d e='>'>", "<", "</", "text, ", "<br/>", "< p>", "<é>"]
    rng = random.Random(4)
    for _ in range(5_000):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))
        want = [(m.start(), m.end(), (m[2] or "").lower(), m[1] == "/", m[3] or "") for m in tag.finditer(page)]
        assert list(html_text._Tags(page)) == want, page


def test_made_pages_give_their_article():
    """Pages put together from blocks whose text is known, in containers and furniture drawn at random."""
    rng = random.Random(8)
    for _ in range(300):
        blocks = [" ".join(rng.choice(["word", "text, and", "more", "said,", "é&amp;"]) for _ in range(rng.randrange(15, 60))) for _ in range(rng.randrange(4, 12))]
        body = "".join(rng.choice(["<p>{}</p>", "<p>\n {}", "<p>{}<!-- c --></p>", "<pre>{}</pre>", "<ul><li>{}</ul>"]).format(b) for b in blocks)
        inner = rng.choice(["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div><div>{}</div></div>", "<section class=related-work>{}</section>", "<form id=main>{}</form>"]).format(body)
        before = "".join(rng.sample(["<nav><a href=a>Menu</a></nav>", "<header>Top of page</header>", "<div class=sidebar><p>Side, bar.</p></div>", "<script>var a='<p>';</script>"], 2))
        after = "".join(rng.sample(["<footer>&copy; x</footer>", COMMENTS, "<div class=cookies>We use cookies.</div>", "<aside>Other, matters.</aside>", "<div><a href=b>next</a></div>"], 3))
        want = "\n".join(b.replace("&amp;", "&") for b in blocks)
        assert html_text.main_text(f"<html><body>{before}{inner}{after}</body></html>") == want
