import html as escapes
import re

from catalogflow.llm import html_text
from catalogflow.llm.html_blocks import blocks
from catalogflow.llm.labelled_pages import labelled_pages


def test_held_out_labelled_pages():
    field = html_text.trained()
    right = total = 0
    for html, labels in labelled_pages(150, seed=99):
        found = field.label(blocks(html))
        right += sum(a == b for a, b in zip(found, labels))
        total += len(labels)
    assert right / total > 0.985


def test_given_pages(spark, rows):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    found = {r.page_id: r for r in html_text.main_text(pages, keep=("url",)).collect()}
    for page in pages.collect():
        inside = re.search(r"<article>(.*?)(</article>|$)", page.html or "", re.S)
        want = " ".join(re.split(r"<[a-z/!][^>]*>", inside[1])) if inside else ""
        want = " ".join(escapes.unescape(want).split())
        assert found[page.page_id].text == want
        assert found[page.page_id].n_chars == len(want)
        assert found[page.page_id].url == page.url


def test_blocks_of_broken_pages():
    def texts(html):
        return [b.text for b in blocks(html)]

    assert texts("<p>a <b>b<p>c&amp;&#233;&lt;i") == ["a b", "c&é<i"]
    assert texts("<div>x<script>if (a<b) '</div>'</script>y</div>z") == ["xy", "z"]
    assert texts("<!-- <p>no</p> --><ul><li>1<li>2</ul>3 < 4 & 5") == ["1", "2", "3 < 4 & 5"]
    assert texts("</div></p>t<br>u\n\t v<style>p{}") == ["t u v"]
    assert texts('<p title="a > b">c</p><p class=x') == ["c"]
    assert [b.path[-1] for b in blocks("<li>1<li>2</li><td>3")] == ["li", "li", "td"]
    assert texts("") == texts("<p> \n </p>") == []
    assert len(texts("<p>" * 20_000 + "<a \"" * 20_000)) == 0


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "plain"), (3, "plain"), (None, "<article><h1>T</h1><p>x, y.</p></article>")]
    pages = spark.createDataFrame(rows, "page_id bigint, html string").selectExpr("*", "1 id", "2 keep_0")
    found = html_text.main_text(pages).collect()
    assert len(found) == 5
    assert [r.text for r in found if r.page_id in (1, 2)] == ["", ""]
    assert [r.text for r in found if r.page_id is None] == ["T x, y."]
    assert html_text.main_text(pages.limit(0)).count() == 0
