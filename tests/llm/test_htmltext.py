import html
import re

import numpy as np
import pytest
from conftest import SF_DIR

from tickloom.llm import htmltext


def article(page):
    """The article element of the test pages, by what their templates are."""
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S).group(1)
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", inner)]
    return "\n".join(x for x in parts if x)


def test_pages_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    found = {r.page_id: r for r in htmltext.extract(pages, 50_000).collect()}
    rows = pages.collect()
    assert len(found) == len(rows)
    for r in rows:
        assert found[r.page_id].text == article(r.html) and found[r.page_id].n_chars == len(article(r.html))


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &lt;text&gt; &amp;c", "plain <text> &c"),
    ("<p>a<p>b  \n c&nbsp;d</p>", "a\nb c d"), ("<article><p>a <b>b</b>c</p></article><p>no</p>", "a bc"),
    ("<script>if (a < b) { '</p>' }</script><p>x</p><style>p{}</style><!-- <p>no</p> -->", "x"),
    ("<nav>menu<ul><li>one</ul></nav><main><h1>T</h1><p>x</p></main><footer>f</footer>", "T\nx"),
    ("<body class='with-sidebar'><p>x</p><div class=\"cookie-notice\">c<div>d</div></div><p>y</p></body>", "x\ny"),
    ("<div class=ad>buy<article><p>x</p></article>", "x"), ("<article><p>x</p><section id='comments'><p>no</p></section><p>y", "x\ny"),
    ("<article><header><h1>T</h1></header><p>x<form><input>sign up</form></article>", "T\nx"),
    ("<ul><li>a<li>b</ul><table><tr><td>1</td><td>2</td></tr></table>", "a\nb\n1 2"),
    ("<p title='a>b'>x</p><div aria-hidden=true>no</div><div role=\"navigation\">no</div>", "x"),
    ("<title>t</title><p>&#233;&eacute;&copy; &bogus; &am", "éé© &bogus; &am"), ("<p>x</p><script>never closed <p>no", "x"),
    ("<p>x <br> y</p>", "x\ny"), ("<div class='shadow added'>x</div>", "x")])
def test_markup(page, text):
    assert htmltext.main_texts([page]) == [text]


def test_runs_repeated_across_pages_go_where_nothing_marks_the_article():
    words = "this long passage stands at the top of every page of the host and says nothing new".split()
    top = " ".join(words)
    pages = [f"<div>{top}</div><div>own text {' '.join(f'w{i}x{j}' for j in range(30))}</div>" for i in range(5)]
    assert htmltext.main_texts(pages) == [re.findall("<div>(own.*?)</div>", p)[0] for p in pages]
    assert htmltext.main_texts(pages[:2])[0].startswith("this long passage")
    within = [f"<article><p>{top}</p><p>own {i}</p></article>" for i in range(5)]
    assert htmltext.main_texts(within) == [f"{top}\nown {i}" for i in range(5)]


def test_suffix_array_matches_all_runs():
    draw = np.random.default_rng(4)
    for _ in range(30):
        ids = draw.integers(0, 3, 200)
        pages = np.sort(draw.integers(0, 6, 200))
        where = {}
        for i in range(200 - 4):
            if pages[i] == pages[i + 4]:
                where.setdefault(tuple(ids[i:i + 5]), []).append(i)
        wanted = np.zeros(200, bool)
        for places in where.values():
            if len({pages[i] for i in places}) >= 3:
                for i in places:
                    wanted[i:i + 5] = True
        assert (htmltext.repeated(ids, pages, 5, 3) == wanted).all()
    assert not htmltext.repeated(np.zeros(0, np.int64), np.zeros(0, np.int64)).size


def test_edge_rows(spark):
    rows = [(1, None, "<p>x</p>"), (1, None, "<p>x</p>"), (None, "http://h/a", None), (3, "no url at all", ""), (4, "http://H/b", "<p>" + "y " * 200_000)]
    pages = spark.createDataFrame([(*r, "a", 1, "b") for r in rows], "page_id long, url string, html string, host string, part int, text string")
    found = htmltext.extract(pages, 1000).collect()
    assert sorted((repr(r.page_id), r.url, r.n_chars) for r in found if r.url) == [("3", "no url at all", 0), ("4", "http://H/b", 399_999), ("None", "http://h/a", 0)]
    assert [r.text for r in found if r.page_id == 1] == ["x", "x"]
    assert htmltext.extract(pages.limit(0)).count() == 0


def test_runs_are_counted_over_the_whole_host_whatever_its_size(spark):
    top = " ".join(f"top{j}" for j in range(20))
    rows = [(i, f"http://{host}/{i}", f"<div>{top}</div><div>" * (i % 20 == 0) + " ".join(f"{host}{i}x{j}" for j in range(40)))
            for host in ("a", "b") for i in range(80 if host == "a" else 20)]
    pages = spark.createDataFrame([(*r[:2], r[2]) for r in rows], "page_id long, url string, html string")
    texts = [{(r.url, r.text) for r in htmltext.extract(pages, size).collect()} for size in (1 << 20, 2000, 300)]
    assert texts[0] == texts[1] == texts[2] and len(texts[0]) == 100
    # Four pages of host a hold the passage, one page of host b.
    assert [u for u, t in sorted(texts[0]) if "top0" in t] == ["http://b/0"]


def test_copies_do_not_count_as_pages_with_a_run(spark):
    body = " ".join(f"w{j}" for j in range(40))
    copies = [f"<p>{body}</p><!-- {i} -->" for i in range(6)]
    assert htmltext.main_texts(copies) == [body] * 6
    pages = spark.createDataFrame([(i, f"http://a/{i}", p) for i, p in enumerate(copies)], "page_id long, url string, html string")
    assert [r.text for r in htmltext.extract(pages, 200).collect()] == [body] * 6


def test_whole_blocks_at_the_edge_of_pages_may_be_short(spark):
    own = [" ".join(f"p{i}x{j}" for j in range(30)) for i in range(5)]
    pages = [f"<p>Daily news</p><p>{t}</p><p>short line</p><p>{t} the end</p><div>(c) 2024 all rights are reserved here</div>" for t in own]
    kept = [f"{t}\nshort line\n{t} the end" for t in own]
    assert htmltext.main_texts(pages) == kept
    rows = spark.createDataFrame([(i, f"http://a/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    assert sorted(r.text for r in htmltext.extract(rows, 500).collect()) == kept
    # The last words of a block are no whole block.
    assert htmltext.main_texts([f"<p>{t} the end" for t in own]) == [f"{t} the end" for t in own]
    assert htmltext.main_texts(["<p>a", "<p>a b", "<p>a c"]) == ["a", "a b", "a c"]


@pytest.mark.parametrize("page, text", [
    ("<article><p class=notice>x<p>real text<p>more</article>", "real text\nmore"),
    ("<article><ul><li class=ad>x<li>real</ul><p>more</article>", "real\nmore"),
    ("<dl><dt class=ad>x<dd>real</dl><table><tr class=promo><td>no<tr><td class=ad>no<td>yes</table>", "real\nyes"),
    ("<div><div class=ad>buy</div><section><div class=ad>buy<div>more</div></section><p>real</p></div>", "real"),
    ("<body><div class=ad>buy <b>it</b><p>real</p></body>", "real"), ("<form action=x><input>find<p>real<p>text", "real\ntext"),
    ("<nav><ul><li>a<li>b</ul><h1>real</h1><p>text", "real\ntext"), ("<p>real</p><footer><p>no<p>no", "real"),
    ("<ul><li class=menu>no<ul><li>no</ul><li>real</ul>", "real"), ("<p>a <span class=ad>no</span> b</p>", "a\nb"),
    ("<div class=ad><p>no</div></div></p><p>real</p></span>", "real"), ("<p><span class=ad>no<p>real", "real"),
    ("<article><h2 id=related>R</h2><h2 id=related-work>W</h2><section id=social-history>s</section><p id=reply-to-critics>r</p></article>",
     "R\nW\ns\nr"),
    ("<div class='page-with-sidebar'><p>x</p><div class='related-posts widget_area'>no</div><div class=shareButtons>no</div></div>", "x"),
    ("<div class=entry-header><h1>T</h1></div><div class='site-header top'>no</div><p>x", "T\nx"),
    ("<article><p>x</p></article><section id=comments><article><p>no</p></article><article>no</article></section>", "x"),
    ("<article><p>x</p><section id=comments><article>no</article></section><p>y</p></article>", "x\ny"),
    ("<article><p>x</p><div class=comment-list><article>no</div><p>y</p></article><p>z</p>", "x\ny"),
    ("<div class=widget><article><p>x</p></article></div>", "x")])
def test_what_is_dropped_ends_where_its_element_does(page, text):
    assert htmltext.main_texts([page]) == [text]
