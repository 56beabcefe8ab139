"""op10: articles that lie in several sibling holders."""

import pytest

from fathomline.llm import html_ttr

PART = "A sentence of the article that is long enough to count as its content. "


@pytest.mark.parametrize("tag", ["div", "section"])
def test_siblings_are_one_article(tag):
    long, short = (PART * 7).strip(), (PART * 3).strip()
    page = f"<nav>menu</nav><div id=content><{tag}><p>{long}</p></{tag}><{tag}><p>{short}</p></{tag}></div><footer>f</footer>"
    assert html_ttr.extract(page) == f"{long}\n{short}"
