import html
import re

import pytest

from kestrel.llm import maintext

TREE = maintext.train()


def test_tree_fits_its_table():
    assert all(maintext.decide(TREE, r[:-1]) == r[-1] for r in maintext.LABELLED)


def test_leaving_rows_out():
    """Each row judged by a tree trained without it."""
    right = sum(maintext.decide(maintext.train(maintext.LABELLED[:k] + maintext.LABELLED[k + 1:]), r[:-1]) == r[-1]
                for k, r in enumerate(maintext.LABELLED))
    assert right >= 0.9 * len(maintext.LABELLED)


LONG = "Some plain sentence of the article that has enough words to be taken for prose by anyone."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   ", ""), ("<html><head><title>T</title></head><body></body></html>", ""),
    (f"<article><h1>Head</h1><p>{LONG}</p></article><footer>foot</footer>", f"Head {LONG}"),
    (f"<nav><a href=x>a</a></nav><main><p>{LONG}<p>x &amp; y&nbsp;z &#233;</main>", f"{LONG} x & y z é"),
    (f"<div class='ad'>Buy<article><p>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG}</p><div class=\"comments\"><p>{LONG}</p></div><form>Mail <input></form></article>", LONG),
    (f"<article><p>{LONG}</p><aside>More</aside><div id=related-links><a href=q>w</a></div><p>End.</p></article>", f"{LONG} End."),
    (f"<article><p>a<b>b</b>\n c</p><script>if (a<b) \"</p>\"</script><!-- <p>no</p> --><p>{LONG}", f"ab c {LONG}"),
    (f"<body><div class=menu><ul><li><a href=1>x</a></li></ul></div><p>{LONG}</p><p>{LONG}</p></body>", f"{LONG} {LONG}"),
    (f"<article><p>{LONG}</p><p>cut <b", f"{LONG} cut"),
])
def test_pages(page, text):
    assert maintext.main_text(page, TREE) == text


def test_real_pages(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    for r in d:
        m = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)
        body = re.sub(r"</?(?:p|h1|br)>", "\x01", m.group(1) if m else "")
        parts = (" ".join(html.unescape(x).split()) for x in re.sub(r"<[^>]*>?", "", body).split("\x01"))
        assert maintext.main_text(r["html"], TREE) == " ".join(x for x in parts if x)


def test_operator(spark):
    schema = "page_id long, url string, html string, text string, i string, h string, u string"
    rows = [(1, "u", f"<article><p>{LONG}</p></article>", "a", "b", "c", "d"), (None, None, None, *[None] * 4),
            (2, "v", "<p>" + "word " * 50_000, "a", "b", "c", "d"), (2, "v", "", "a", "b", "c", "d")]
    got = maintext.extract(spark.createDataFrame(rows, schema))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["page_id"] or 0, r["n_chars"]) for r in got.collect()) == [(0, 0), (1, len(LONG)), (2, 0), (2, 249_999)]
    assert maintext.extract(spark.createDataFrame([], schema)).count() == 0
