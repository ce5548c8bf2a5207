"""A host's wrapper describes every form of its pages, however rare, and however they are dealt to tasks."""

import pytest

from costweave.llm import wrappers

LAYOUTS = ["blockquote", "pre", "figure", "center", "address", "dl", "fieldset", "details", "hgroup", "section", "table", "dir"]


def page(layout, n):
    return f"<body><div class=top>All about us</div><{layout}><div><p>Text {n}</p></div></{layout}></body>"


@pytest.mark.parametrize("part", [256, 3, 1])
def test_rare_layouts_lose_the_template_too(spark, part):
    rows = [(i, "http://site/x", page(LAYOUTS[i % len(LAYOUTS)], i)) for i in range(48)] + [(None, "http://site/y", page("ol", 99))]
    rows += [(100, "http://other/", page("ul", 1)), (101, None, "<p>alone</p>"), (102, "http://site/", None)]
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), streams_per_part=part).collect()}
    assert got == {**{i: f"Text {i}" for i in range(48)}, None: "Text 99", 100: "All about us\nText 1", 101: "alone", 102: ""}


def test_all_pages_match_what_is_inferred():
    pages = [page(LAYOUTS[i % len(LAYOUTS)], i) for i in range(40)] + [page("ul", i).replace("<p>", "<p>more</p><p>") for i in range(4)]
    wrapper = wrappers.Wrapper(wrappers.infer_all(pages))
    assert all(wrapper.matched(wrappers.tokens(p)[0]) for p in pages)
    assert wrappers.infer_all([]) == []
