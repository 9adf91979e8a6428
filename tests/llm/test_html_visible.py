"""Visible text where tags are implied or misplaced, and in elements that show text of their own."""

from __future__ import annotations

import pytest

from hyphalake.llm import html_layout


@pytest.mark.parametrize("html, text", [
    ("<html><head><title>T</title><h1>A</h1><p>text", "A\n\ntext"), ("<head><meta charset=x><style>p{}</style>words<p>b</p></head>", "words\n\nb"),
    ("<head><noscript><img></noscript><title>T</title></head><body>x", "x"), ("<head><custom-tag>seen</custom-tag>", "seen"),
    ("<table><tr><td>a</td>stray<td>b</td></tr></table>", "stray\na  b"), ("<table><tr><form><td>f</td></form><td>b</td></tr></table>", "f\nb"),
    ("<table><tbody><tr><td>a</td><li>x</li></tr><tr><td>c", "x\na\nc"), ("<table><tr> <td>a</td> <td>b</td> </tr></table>", "a  b"),
    ("<p>x <math><mi>y</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math> z", "x y=1 z"),
    ("<svg><title>tip</title><desc>no</desc><text>one</text><path d='M0'/><text>two</text></svg>", "one\ntwo"), ("<desc>seen</desc>", "seen"),
    ("<p>pick <select><option>one<option selected>two</select> now", "pick\none\ntwo\nnow"),
    ("<select><optgroup label=G><option>a</option></optgroup><optgroup label=H><option>b</select>", "G\na\nH\nb"), ("<datalist><option>no</datalist>yes", "yes"),
])
def test_visible_text_stays(html, text):
    assert html_layout.render(html) == text


@pytest.mark.parametrize("html, text", [
    ("<li>w<th>t", "- w\n  t"), ("<ul><tr><td>a</td><td>b</td></tr><li>c</ul>", "a  b\n- c"), ("<pre>x<tr><td>a</td><td>b</td></tr></pre>", "xa  b"),
])
def test_rows_outside_tables_are_lines(html, text):
    assert [x.strip(" -") for x in html_layout.render(html).split("\n")] == [x.strip(" -") for x in text.split("\n")]


@pytest.mark.parametrize("page", [
    lambda n: "<p><button>" + "<span>" * n + "<div></div>" * n, lambda n: "<x><table><td>" + "<b>" * n + "</x>" * n, lambda n: "<p><button>" + "<span>x" * n + "<div>y</div>" * n,
    lambda n: "<i>a" * n + "</i>b" * n, lambda n: "<select>" + "<option>" * n + "</p>" * n, lambda n: "<table>" + "<tr><td>" * n + "</tr>" * n,
])
def test_time_follows_the_length_of_the_page(page):
    import time

    def took(n):
        began = time.process_time()
        html_layout.render(page(n))
        return time.process_time() - began

    small = max(took(3000), 0.02)
    assert took(30_000) < 40 * small  # ten times the page; a quadratic one would take a hundred times as long


def test_any_order_of_tags_renders():
    import random

    rng = random.Random(5)
    tags = "p div span b button table tr td th tbody thead ul ol li dl dd select option optgroup svg math title body html head h1 a form pre blockquote text".split()
    for _ in range(3000):
        html_layout.render("".join(rng.choice([f"<{rng.choice(tags)}>", f"</{rng.choice(tags)}>", "w ", "t"]) for _ in range(rng.randint(3, 60))))
