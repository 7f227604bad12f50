import html
import re

import duckdb
import pytest

from tokenloom.llm import extract

PROSE = "the cat and the dog of the house were in the garden as it was to be that way for them and on it went "


def test_articles_of_the_pages_are_whole():
    rows = duckdb.sql("SELECT html FROM '/root/testdata/sf0.01/pages.parquet'").fetchall()
    for (page,) in rows:
        inside = re.search("<article>(.*?)(</article>|$)", page, re.S)[1]
        plain = re.sub("<(?!/?b>)[^>]*>", " ", inside).replace("<b>", "").replace("</b>", "")
        assert extract.main_text(page) == " ".join(html.unescape(plain).split())


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<p>", ""),
        ("<article>a<b>b</b>c &amp;lt; &eacute;&#233;&nbsp; d<br>e</article>", "abc &lt; éé d e"),
        ("<nav><article><p>x</article>", "x"),
        ("<article>x<div class='user-comments'><article>no</article></div><aside>n</aside><form>f</form></article><p>y", "x"),
        ("<article>a<script>if(a<b){'</p>'}</script><style>p{}</style><!-- c --><noscript>n</noscript>b</article>", "ab"),
        ("<article><header><h1>T</h1></header><p>b<footer>f</footer></article><header>h</header>", "T b"),
        ("<article>" + "<p>p</p>" * 300, " ".join(["p"] * 300)),
        ("<html><head><title>t</title><article><p>Body text</p></article>", "Body text"),
        ("<html><head><meta charset=x><style>p{}</style><h1>Head</h1><article><p>Body", "Body"),
        ("<article><p>One</p><button>b<p>Two</p></article>", "One Two"),
        ("<article><p>One<button>b</button> more</p><select><option>x<div>Two</div></article>", "One more Two"),
        ("<article><svg><text>x</text><p>One</p></article><p>y", "One"),
        ("<article><iframe>x<p>y</article><p>z", ""),
        ("<div><noscript><p>x</p></div><article>One</article>", "One"),
        ("<article><p class='alert'>unclosed<p>Second</p><p>Third</p></article>", "unclosed Second Third"),
        ("<article><p class='form-note'>real</p><p id='search-engines'>a<h2 id='menu-of-the-day'>b</h2></article>", "real a b"),
        ("<article><section id='related-work'>w</section><div class='box ad'>x</div><ul class='user-comments'><li>c</ul>t</article>", "w t"),
        ("<article><p><a href=x>A paragraph that is one link</a></p><h2><a href=y>Head</a></h2></article>", "A paragraph that is one link Head"),
        ("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be</p></article>", "Let x=2 be"),
        ("<article><ul><li class=share>a<li>b<ul><li>c</ul><li>d</ul></article>", "a b c d"),
        ("<body><ul><li class=share>a<li>b</ul><table><tr><td class=ad>c<td>d<tr><td>e</table>", ""),
        ("<article><div id='cookie-notice'>c</div><ul><li><a href=x>menu</a></li></ul>t</article>", "t"),
    ],
)
def test_containers(page, text):
    assert extract.main_text(page) == text


def test_blocks_without_containers_are_judged_by_words_links_and_neighbours():
    prose = (PROSE * 3).strip()
    page = f"<p>Home</p><div><a href=1>links</a> <a href=2>more links</a></div><p>{prose}</p><p>Short.</p><p>{prose}</p><p>Tail</p>"
    assert extract.main_text(page) == f"{prose} Short. {prose}"
    middling = f"<h2>Head</h2><p>{prose}</p><p>{PROSE.strip()}</p>"
    assert extract.main_text(middling) == f"Head {prose} {PROSE.strip()}"
    blocks = extract.blocks_of(f"<p>{prose}</p><p>xq zv kw {'qq ' * 80}</p>")
    assert [extract.first_label(b, False) for b in blocks] == [extract.GOOD, extract.BAD]


def test_pages_and_cases(spark):
    rows = [(1, "u", "<article>é x</article>", "t"), (1, "u", "<article>é x</article>", "t"), (None, None, None, None), (2, "v", "", "t")]
    rows.append((3, "w", "<article>" + "word " * 200_000 + "</article>", "t"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract.extract_pages(pages).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in got) == [("1", 3), ("1", 3), ("2", 0), ("3", 999_999), ("None", 0)]
    assert all(len(r.text) == r.n_chars for r in got)
    assert extract.extract_pages(pages.limit(0)).count() == 0
