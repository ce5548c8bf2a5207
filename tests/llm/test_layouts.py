"""Articles inside containers whose class names hold a word of what stands beside an article."""

import pytest

from costweave.llm import wrappers


@pytest.mark.parametrize("name", ["site-content has-sidebar", "with-sidebar", "no-comments", "post comments-open", "sidebar", "content-sidebar-wrap"])
@pytest.mark.parametrize("region", ["article", "main"])
def test_an_article_in_a_marked_container_stays(name, region):
    pages = [f"<body><div class=menu>Menu</div><div class='{name}'><{region}><h1>T{n}</h1><p>Text {n}</p><div class=ad>Buy</div>"
             f"<aside>More</aside></{region}><div class=sidebar>Side</div></div></body>" for n in range(4)]
    wrapper = wrappers.Wrapper(wrappers.infer(pages[:3]))
    for n, page in enumerate(pages):
        assert wrappers.main_text(page, wrapper) == wrappers.main_text(page, None) == f"T{n}\nText {n}"


def test_layout_names_without_an_article_and_articles_in_asides():
    page = "<body><div class='x has-sidebar'><p>Text</p><div class='sidebar-left'>Side</div></div></body>"
    assert wrappers.main_text(page, None) == "Text"
    page = "<body><form><main><p>Text</p><form>Mail</form></main></form></body>"
    assert wrappers.main_text(page, None) == "Text"
    page = "<body><article><p>Text</p><div class=comments><article>Nice</article></div></article><div class=related><article>Teaser</article></div></body>"
    assert wrappers.main_text(page, None) == "Text"
