"""op10: ratios, smoothing and threshold choose the region; structure only vetoes; malformed pages."""

import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fathomline.llm import html_ttr

PART = "A sentence of the article that is long enough to count as its content. "
ARTICLE = [PART * n for n in (5, 4, 6, 1, 5)]


def page(draw) -> tuple[str, str]:
    """A page without article or main element or telling names, and its main text."""
    link = lambda: f"<li><a href=x>{'link ' * draw.integers(1, 4)}</a></li>"
    few = lambda n: "".join(f"<li><span>{draw.integers(1, 99)}</span> <i>views</i></li>" for _ in range(n))
    teaser = f"<li>{'some words of a teaser ' * 4}</li>"
    parts = [PART * draw.integers(3, 7) for _ in range(6)]
    body = "<h1>Title</h1>" + "".join(f"<p>{p}</p>" for p in parts)
    html = f"<div><ul>{''.join(link() for _ in range(5))}</ul><ul>{few(5)}</ul></div><div><div>{body}</div></div><div><ul>{few(6)}{teaser}{few(6)}</ul></div>"
    return f"<html><body>{html}</body></html>", "\n".join(["Title", *(p.strip() for p in parts)])


def share(seeds=range(20)) -> float:
    made = [page(np.random.default_rng(s)) for s in seeds]
    return sum(html_ttr.extract(h) == t for h, t in made) / len(made)


def test_regions_without_structure():
    assert share() == 1


def test_without_smoothing_regions_change(monkeypatch):
    monkeypatch.setattr(html_ttr, "smooth", lambda ratio: ratio)
    assert share() < 0.2


def test_without_ratio_regions_change(monkeypatch):
    monkeypatch.setattr(html_ttr, "ratios", lambda texts, linked, tags: np.ones(len(texts)))
    assert share() < 0.2


def test_without_threshold_regions_change(monkeypatch):
    monkeypatch.setattr(html_ttr, "content", lambda ratio: ratio > 0)
    assert share() < 0.2


@pytest.mark.parametrize(
    "html, text",
    [
        ("<![foo[bar]]>text", "text"),
        ("<![%foo;[x]]>t", "t"),
        ("<p>a</p><![ bar", "a"),
        ("<!-- open", ""),
        ("<p>a</p><!-- open <p>b</p>", "a"),
        ("a<!-->b<!--->c<!-- x --!>d", "abcd"),
        ("<p>a<?php echo 1 ?>b</p>", "ab"),
        ("<p>a <b", "a"),
        ("<head><title>x</title><body><p>no end of the head</p>", "no end of the head"),
        ("<p>x <math><mi>y</mi></math> <svg><text>z</text></svg></p>", "x y z"),
        ("<p><a href=x>only a link</a></p>", "only a link"),
        (None, ""),
    ],
)
def test_malformed(html, text):
    assert html_ttr.extract(html) == text


WRAPPERS = ["<div class='content-sidebar-wrap'>", "<div class='has-sidebar'>", "<div class='with-comments'>", "<body class='menu-open'>", "<form action=x>", "<div class='site-wrap overlay-container'>"]


@pytest.mark.parametrize("wrapper", WRAPPERS)
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_layout_around_an_article_is_no_furniture(wrapper, inner):
    text = "\n".join(p.strip() for p in ARTICLE)
    html = f"{wrapper}<nav>menu</nav><{inner}>{''.join(f'<p>{p}</p>' for p in ARTICLE)}</{inner}><div class='sidebar'>{PART}</div><div id='comments'><p>{PART * 3}</p></div>"
    assert html_ttr.extract(html) == text


@pytest.mark.parametrize("name", ["related-work", "sponsoring-history", "recommended-dosage", "notice-of-motion"])
def test_a_name_that_only_holds_such_a_word_is_kept(name):
    text = "\n".join(p.strip() for p in ARTICLE)
    inner = "".join(f"<p>{p}</p>" for p in ARTICLE[:3]) + f"<div class='{name}'><p>{ARTICLE[3]}</p></div><p>{ARTICLE[4]}</p>"
    assert html_ttr.extract(f"<main>{inner}</main>") == text


@pytest.mark.parametrize("aside", ["<div class='related-posts'>", "<div class='google-ad'>", "<section id=comments>", "<div class='td-sidebar-wrap'>", "<div class='cookie-notice'>", "<footer>", "<aside>", "<form>", "<div role=navigation>", "<div hidden>", "<article class='comment'>", "<div class='site-notice'>"])
def test_furniture_is_dropped(aside):
    text = "\n".join(p.strip() for p in ARTICLE)
    body = "".join(f"<p>{p}</p>" for p in ARTICLE)
    end = aside[1:].split()[0].rstrip(">")
    for html in (f"<main>{body}{aside}<p>{PART}</p></{end}></main>", f"<div>{body}{aside}<p>{PART}</p></{end}></div>"):
        assert html_ttr.extract(html) == text


PIECES = st.sampled_from(["<", ">", "<!--", "-->", "<![", "]]>", "<!", "<?", "</", "&", "&#", "&amp", ";", "<p>", "</p>", "<article>", "</article>", "<div class='ad'>", "</div>", "<script>", "</script>", "text ", "\x00", "<a href=x>", "</a>", "<li>", "<td>", "'", '"', "=", "/", "é", "\ud800"])


@given(st.lists(PIECES, max_size=40))
@settings(max_examples=400, deadline=None)
def test_any_page_gives_a_text(parts):
    got = html_ttr.extract("".join(parts))
    assert all(line and line == " ".join(line.split()) for line in got.split("\n")) or not got


@pytest.mark.parametrize("piece", ["<!--", "<a ", "<", "</", "<![", "<?", "<a b='", "<script>", "<p><b>", "<li><b>", "<!-- x -->", "<div class='ad'>"])
def test_time_is_in_proportion(piece):
    began = time.process_time()
    html_ttr.extract(piece * (100_000 // len(piece)))
    assert time.process_time() - began < 2
