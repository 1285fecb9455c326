import json
import random

import pytest

from fleetwarden.llm import html_wrappers as hw


def alone(page):
    return hw.main_text(page, None)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("no markup &amp; all", "no markup & all"),
        ("<article><h1>A</h1><p>b  <b>c</b>d\n e</p><p>f</article>", "A b cd e f"),
        ("<body><nav>menu</nav><article>x<br>y<wbr>z<aside>side</aside> w</article><footer>end</footer>", "x yz side".replace(" side", " w")),
        ("<p>one<script>var t='</p>';</script> two</p><style>p{}</style>", "one two"),
        ("<p>a<!-- <p>b</p> -->c</p>", "ac"),
        ("<p>&lt;b&gt; &#233;&nbsp;x &am &amp y</p>", "<b> é x &am & y"),
        ("<div class='content'>t</div><div class='comments'><p>long long long long reader</p></div>", "t"),
        ("<main><p>x</p><form><input value=1>q</form><div class=\"cookie-notice\">n</div></main>", "x"),
        ("<article><p>un<i>closed<p>next</div></article>", "unclosed next"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"),
        ("<p title='a>b'>q</p", "q"),
        ("<article>a <span class=ad>buy</span> b</article>", "a b"),
        ("<p>unfinished <a href='x", "unfinished <a href='x"),
        ("<x-y>own</x-y>er", "owner"),
        ("<body class='has-sidebar'><div class='with-sidebar'><article>a</article><div class=sidebar>s</div></div>", "a"),
        ("<article>a</article><ol class='comment-list'><li><article>b</article></ol>", "a"),
        ("<main>m<article class='comment'>c</article></main>", "m"),
    ],
)
def test_pages_on_their_own(page, text):
    assert alone(page) == text


def test_deep_and_long_pages():
    assert alone("<div>" * 5000 + "x" + "</div>" * 5000) == "x"
    assert len(alone("<article>" + "<p>word word</p>" * 50_000 + "</article>")) == 50_000 * 10 - 1


def test_elements_below_the_depth_end_themselves():
    deep, up = "<div>" * 250, "</div>" * 250
    page = f"<body><div>top<div><article>a{deep}b<nav>menu<p>x</p></nav>c<p>d<p>e</p>{up}f</article></div>end</div></body>"
    assert alone(page) == "a b c d e f"
    layout = f"<main>{deep}<div class=sidebar>s<b>t</b><nav>n</nav></div>a<div class=with-sidebar>b<div class=menu>c<article>d</article>e</div>f</div>g{up}h</main>"
    assert alone(layout) == "a b c d e f g h"
    assert alone("<p>a</p>" + "<nav>" * 20_000 + "x" + "</nav>" * 20_000 + "<p>b</p>") == "a b"
    assert alone("<p>a</p>" + "<div class=menu>" * 20_000 + "<main>x</main>" + "</div>" * 20_000) == "a x"


def expression(page):
    return hw.expression(hw.parse(page))


def shape(item):
    """An expression as text: slots as _, fixed texts as T."""
    if item[0] == "#":
        return ("_" if item[2] is None else "T") + item[1].replace("1", "")
    inner = " ".join(map(shape, item[2]))
    return f"{item[0]}({inner})" + item[1].replace("1", "")


def joined(*pages):
    wrapper = expression(pages[0])
    for page in pages[1:]:
        wrapper = hw._merge(wrapper, expression(page))
    return shape(wrapper)


def test_slots_repeats_and_options():
    assert joined("<p>a</p>", "<p>b</p>") == "#root(p(_))"
    assert joined("<p>a</p>", "<p>a</p>") == "#root(p(T))"
    assert joined("<h1>t</h1><p>a</p><p>b</p><p>c</p>", "<h1>t</h1><p>a</p>") == "#root(h1(T) p(_)+)"
    assert joined("<h1>t</h1><p>a</p>", "<p>a</p>") == "#root(h1(T)? p(T))"
    assert joined("<h2>a</h2><p>b</p><h2>c</h2><p>d</p>") == "#root(h2(_)+ p(_)+)"
    assert joined("<ul><li>a</ul>", "<ul><li>a<li>b</ul>", "<p>x</p>") == "#root(ul(li(_)+)? p(T)?)"


def test_parts_combine_to_the_same_shape():
    generator = random.Random(1)
    pages = ["<h1>t</h1>" + "".join(f"<p>{generator.random()}</p>" for _ in range(generator.randrange(1, 5))) for _ in range(12)]
    whole, half = expression(pages[0]), [expression(p) for p in (pages[0], pages[6])]
    for p in pages[1:]:
        whole = hw._merge(whole, expression(p))
    for k in range(1, 6):
        half = [hw._merge(half[0], expression(pages[k])), hw._merge(half[1], expression(pages[6 + k]))]
    assert shape(hw._merge(half[0], json.loads(json.dumps(half[1])))) == shape(whole) == "#root(h1(T) p(_)+)"


def site(i, body):
    return (
        f"<html><head><title>t{i}</title></head><body><div id='top'><a href='/'>Home</a> <a>News</a></div>"
        f"<div id='mid'><div id='left'>{body}</div><div id='right'>Always the same side text, long enough to "
        "outweigh a short page and to be taken for it where only one page is seen.</div></div>"
        "<div id='low'>Company name and address</div></body></html>"
    )


def test_slots_show_the_article_where_nothing_names_it(spark):
    bodies = [f"<h1>Story {i}</h1>" + "<p>words of story %d</p>" % i * (1 + i % 3) for i in range(30)]
    rows = [(i, f"http://Host.example:80/{i}", site(i, b)) for i, b in enumerate(bodies)]
    got = hw.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(5))
    for r in got.collect():
        i = r.page_id
        assert r.text == " ".join([f"Story {i}", *[f"words of story {i}"] * (1 + i % 3)]) and r.n_chars == len(r.text)


def test_hosts(spark):
    urls = [("http://u:p@A.b:81/x", "a.b"), ("https://a.b?q", "a.b"), ("nothing", ""), (None, ""), ("ftp://x#y", "x")]
    df = spark.createDataFrame([(u,) for u, _ in urls], "url string")
    assert [r[0] for r in df.select(hw.host_of(df.url)).collect()] == [h for _, h in urls]


def test_odd_tables(spark):
    rows = [(1, None, None, "x"), (None, "http://a/", "", "x"), (2, "http://a/", "<article>A  b</article>", None), (2, "http://a/", "<article>A  b</article>", None),
            (3, None, "<nav>n</nav>", "x"), (4, "http://a/", "<p>stray</p>", "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string").selectExpr("*", "'x' as host", "'y' as path")
    got = hw.extract_text(df).collect()
    assert sorted((str(r.page_id), r.text) for r in got) == [("1", ""), ("2", "A b"), ("2", "A b"), ("3", ""), ("4", "stray"), ("None", "")]
    assert hw.extract_text(df.limit(0)).count() == 0
