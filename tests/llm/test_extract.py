"""Main text by wrappers: given pages against a plain reading, made hosts with known articles, broken markup."""

import html as entities
import random
import re

import pytest

from tickflow.llm import extract, wrappers


def shape(html):
    return wrappers.dump(wrappers.folded(wrappers.parse(html)[0]))


def test_query_against_a_plain_reading(spark, sf):
    """The given pages say what their article is; between its tags every p and h1 is a block."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = extract.op12_html_extraction(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", "", p.replace("<br>", " "))).split()) for p in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(p for p in parts if p) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def words(draw, n):
    return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 8))) for _ in range(n))


def paragraphs(draw):
    return [words(draw, draw.randint(12, 60)) for _ in range(draw.randint(1, 7))]


def with_article(draw, title, texts):
    note = f'<div class="newsletter-box"><p>{words(draw, 9)}</p></div>' if draw.random() < 0.5 else ""
    body = "".join(f"<p>{t}" + ("</p>" if draw.random() < 0.7 else "") for t in texts)
    return f"""<body class="has-sidebar"><header><h2>Site</h2></header><div id="cookie-banner">{words(draw, 8)}</div><main><article class=post><header><h1>{title}</h1></header>{note}{body}
    <form>{words(draw, 4)}</form><section id="comments"><h2>Comments</h2><article class="comment"><p>{words(draw, 20)}</p></article></section></article></main><aside>{words(draw, 30)}</aside><div class="related"><article>{words(draw, 12)}</article></div><footer>x</footer>"""


def without(draw, title, texts):
    """No element says what the article is; one notice and the menus have no telling class."""
    links = "".join(f"<li><a href=/{k}>{words(draw, 2)}</a></li>" for k in range(draw.randint(3, 9)))
    body = "".join(f"<p>{t}</p>" for t in texts)
    return f"""<html><body><div class=top><div>My site, all of it</div></div><div class=wrap><div class=left><ul>{links}</ul></div><div class=text><h1>{title}</h1><div>We use your data on every page of this site, as you may know.</div>{body}</div></div><div class=sidebar>{words(draw, 50)}</div><div>{words(draw, 3)} all rights</div>"""


@pytest.mark.parametrize("page", [with_article, without])
def test_hosts_of_known_articles(spark, page):
    draw = random.Random(4)
    rows, want = [], {}
    for k in range(120):
        title, texts = words(draw, 5), paragraphs(draw)
        rows.append((k, f"http://{'A' if k % 3 else 'b'}.example.com/{k}", page(draw, title, texts)))
        want[k] = "\n\n".join([title, *texts])
    got = {r.page_id: r.text for r in extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == want


def test_hosts_of_one_page(spark):
    """Without a second page nothing is known to be a template, so only what elements and classes say is left out."""
    draw = random.Random(5)
    texts = paragraphs(draw) + [words(draw, 40)]
    html = f"<body><nav>menu</nav><div><h1>Title</h1>{''.join(f'<p>{t}</p>' for t in texts)}</div><div class='footer'>foot</div>"
    got = extract.main_text(spark.createDataFrame([(1, "http://only.example.com/", html)], "page_id long, url string, html string")).first()
    assert got.text == "\n\n".join(["Title", *texts])


def test_a_host_of_many_expressions(spark):
    """Groups of three expressions at a time come to one wrapper, and every slot has its place."""
    draw = random.Random(6)
    rows = []
    for k in range(80):
        body = "".join(f"<{(t := draw.choice(['p', 'h2', 'ul', 'blockquote', 'pre']))}>{words(draw, 6)}</{t}>" for _ in range(draw.randint(1, 15)))
        rows.append(("h" if k % 5 else "g", shape(f"<body><div class=a>{body}</div><div class=b>x</div>")))
    frame = spark.createDataFrame(sorted(set(rows)), "host string, expression string")
    found = {r.host: r.wrapper for r in extract.host_wrappers(frame, group=3).collect()}
    assert set(found) == {"g", "h"}
    for host, expression in rows:
        places = extract.placed(expression, found[host])
        assert -1 not in places
        last = len(wrappers.slots(wrappers.load(found[host]))) - 1
        assert last < 20  # the size follows the kinds of elements
        assert places[-1] == last and last not in places[:-1]


def test_folding_and_alignment():
    li = '["li",1,2,[["#",1,1,[]]]]'
    assert li in shape("<ul><li>a<li>b<li>c</ul>")
    assert '["*h2|p",1,2' in shape("<h2>a</h2><p>b</p><h2>c</h2><p>d</p><h2>e</h2><p>f</p>")
    one, two = (wrappers.load(shape(h)) for h in ("<h1>a</h1><p>b</p>", "<h1>a</h1><div>x</div><p>b</p><p>c</p>"))
    merged = wrappers.align(one.kids, two.kids)
    assert [(n.key, n.lo, n.hi) for n in merged] == [("h1", 1, 1), ("div", 0, 1), ("p", 1, 2)]
    assert wrappers.dump(wrappers.load(shape("<div><p>a<p>b</div>"))) == shape("<div><p>a<p>b</div>")
    # a sequence met once is taken for the repeated group of another page
    grouped = wrappers.align(wrappers.load(shape("<h2>a</h2><p>b</p><h2>c</h2><p>d</p>")).kids, wrappers.load(shape("<h2>a</h2><p>b</p>")).kids)
    assert [(n.key, n.lo, n.hi) for n in grouped] == [("*h2|p", 1, 2)]


@pytest.mark.parametrize(
    "html, want",
    [
        ("<article><p>a &amp; b&nbsp;&#x41;&lt;i&gt; &eacute;&copy</article>", "a & b A<i> é©"),
        ("<article>one<br>two<p>three <b>fo</b>ur<!-- no > --><i>five</article>", "one two\n\nthree fourfive"),
        ("<article><p>x<script>if (a<b) {'</p>'}</script>y<style>p</style>z</p></article", "xyz"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table><p>d</p></article>", "a\n\nb\n\nc\n\nd"),
        ("<ARTICLE><P TITLE='a > b' class=\"x\">1 < 2 <p>t</ARTICLE> tail", "1 < 2\n\nt"),
        ("<article><h1>t</h1><p>a<div class='ad'>buy</div><p>b<span class=advert>buy</span> c</p><p>d", "t\n\na\n\nb\n\nc\n\nd"),
        ("<article><p>cut <a href='x", "cut"),
        ("<body><article><p>a</p></div></section></p>b</article>", "a\n\nb"),
        ("", ""),
        ("<", "<"),
        ("plain text only", "plain text only"),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
        ("<article>" + "<p>x <a href='" * 2000, " ".join(["x"] * 1000)),  # a quote ends at the next one, every other time
    ],
)
def test_markup(spark, html, want):
    tree, texts = wrappers.parse(html)
    tree = wrappers.folded(tree)
    whole = wrappers.dump(tree)
    stats = "{" + ",".join(f'"{k}": [1, 1, true, 9, 0]' for k in range(len(wrappers.slots(tree)))) + "}"
    keep = extract.kept(whole, whole, stats, extract.placed(whole, whole))
    of = {b: k for k, s in enumerate(wrappers.slots(tree)) for b in s.own}
    assert "\n\n".join(t for k, (t, _) in enumerate(texts) if keep[of[k]]) == want


def test_hard_rows(spark):
    long = "<article><p>" + "word " * 200_000 + "</p></article>"
    page = "<nav>n</nav><article><p>a</p></article>"
    rows = [(1, "http://h/", None, "x", 1), (2, None, "", "x", 1), (3, "no host", page, "x", 1), (4, "http://H/", page, "x", 1), (4, "http://H/", page, "x", 1), (None, "http://h/", page, "x", 1), (5, "http://h/\n", long, "x", 1), (6, "", "<p>", "x", 1)]
    df = spark.createDataFrame(rows, "`page id` long, url string, `ht.ml` string, host string, text int")
    names = {"id_col": "page id", "html_col": "ht.ml"}
    got = sorted(((r.page_id or 99, r.url, r.text, r.n_chars) for r in extract.main_text(df, **names).collect()), key=lambda r: r[0])
    assert [r[2] for r in got] == ["", "", "a", "a", "a", " ".join(["word"] * 200_000), "", "a"]
    assert all(r[3] == len(r[2]) for r in got) and got[1][1] is None and got[3] == got[4]
    assert extract.main_text(df.limit(0), **names).count() == 0
