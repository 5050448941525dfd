"""Main text: the generator's pages against their articles, hand-made pages, votes."""

import html
import re
import time

from gridloom.llm import pages as G

PAGE = """<html><head><title>T</title></head><body class="has-sidebar"><header class="site-header"><h1>Site</h1></header>
<nav><a>x</a></nav><div id="cookie-notice">We use cookies</div><div class="content-wrap"><div class="post-12 entry"><h1>Head &amp; line</h1>
<p>First para <a href=x>link</a> with some more text in it.<p>Second <b>bold</b>, with &nbsp; space<br>after break.</p><div class="ad-slot">BUY</div>
<ul><li>one<li>two</ul><aside>rel</aside><script>var a="</p><p>no";</script><table><tr><td>c1<td>c2</table></div>
<div class="comments"><p>a reader's comment that is far longer than the article itself: la la la la la la la la la la la la la la la la la</p></div>
</div><div class="sidebar"><p>other</p></div><form><p>search</p></form><footer>c</footer></body></html>"""
MAIN = "Head & line\n\nFirst para link with some more text in it.\n\nSecond bold, with space after break.\n\none\n\ntwo\n\nc1\n\nc2"


def test_hand_made_page():
    assert G.extract(PAGE, None) == MAIN
    assert G.extract(PAGE, ">html>body.has-sidebar>div.content-wrap>div.entry.post-9") == MAIN
    for odd in (None, "", "   ", "<", "<p", "<!-- x", "<div class='", "</p></div>"):
        assert isinstance(G.extract(odd, None), str)
    assert G.extract("plain &lt;text&gt; only", None) == "plain <text> only"
    assert G.extract("<div class=menu>only &am this &amp</div>", None) == "only &am this &"
    assert G.extract("<p>a" * 5000, None).count("a") == 5000
    assert G.extract("<div>" * 3000 + "deep", None) == "deep"


def test_generated_pages_give_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    text = {r.page_id: r.text for r in G.extract_pages(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = (html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))) for b in re.split(r"</?(?:p|h1)>", article))
        assert text[r.page_id] == "\n\n".join(x for x in (" ".join(b.split()) for b in blocks) if x)


def test_a_host_agrees_on_a_path(spark):
    body = "<div class=box{n}><p>{t}</p></div><div class=rest><p>{r}</p></div>"
    long, short = "many words of the story " * 9, "few words"
    rows = [(i, "http://h.example/a", body.format(n=i, t=long, r=short)) for i in range(5)]
    rows += [(9, "http://H.example:80/b", body.format(n=9, t=short, r=long)), (10, None, None), (None, "x", ""), (10, None, None)]
    pages = spark.createDataFrame([(*r, "u") for r in rows], "page_id long, url string, html string, host string")
    got = sorted((str(r.page_id), r.text) for r in G.extract_pages(pages).collect())
    assert ("9", short) in got and ("0", " ".join(long.split())) in got and got.count(("10", "")) == 2 and ("None", "") in got
    assert all(r.n_chars == len(r.text) for r in G.extract_pages(pages).collect())
    assert G.extract_pages(pages.where("page_id < 0")).count() == 0


LEAD, BODY, NOTE = "a lead of some words", "many words of the story " * 30, "a closing note"
PARTS = "<h1>Head</h1><p>{0}</p><div class=body><div class=inner><p>{1}</p></div><p>{2}</p></div><p>{2}</p>".format(LEAD, BODY, NOTE)
WHOLE = "\n\n".join(["Head", LEAD, BODY.strip(), NOTE, NOTE])


def test_parts_of_an_article_beside_its_body_stay(spark):
    for page in (
        f"<body><div>some site</div><article>{PARTS}</article></body>",
        f"<body><div>some site</div><main><div><a href=x>home</a></div><div class=story>{PARTS}</div></main></body>",
        f"<body><div>some site</div><div class=story>{PARTS}</div></body>",
    ):
        assert G.extract(page, None) == WHOLE
    # Most pages of the host have nothing beside the body; the one that has does not lose it.
    plain = f"<main><div class=body><p>{BODY}</p></div></main>"
    rows = [(i, "http://h.example/", plain) for i in range(5)] + [(9, "http://h.example/", f"<main>{PARTS}</main>")]
    got = {r.page_id: r.text for r in G.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == WHOLE and got[0] == BODY.strip()


def test_names_of_chrome_do_not_cut_prose_out_of_an_article():
    said = "We talk at length about what was found and what it may mean"
    parts = [
        "<section id='discussion'><h2 id='related-work'>Related work</h2><p>Short.</p></section>", f"<section id='search'><p>{said}</p></section>",
        f"<div class='response'><p>{said}</p></div>", "<p>The <span class='search-term'>word</span> stays.</p>", "<div class='market-share'>9 %</div>",
        "<div class='related-work'>Cited</div>", "<h2 class='alert'>Alert</h2>",
    ]
    chrome = [
        f"<div class='ad'><p>{said}</p></div>", f"<div id='comments'><p>{said}</p></div>", f"<div class='cookie-notice'>{said}</div>", "<div class='share'>Tweet</div>",
        f"<section id='comments'>{said}</section>", "<div class='related-posts'><a href=x>Another story that has a rather long name indeed</a></div>",
        "<div class='social'>Follow us</div>", "<p>The <span class='ad-slot'>BUY</span>end.</p>",
    ]
    want = f"Related work\n\nShort.\n\n{said}\n\n{said}\n\nThe word stays.\n\n9 %\n\nCited\n\nAlert\n\nThe end."
    for tag in ("article", "main"):
        assert G.extract(f"<body><{tag}>{''.join(parts + chrome)}</{tag}></body>", None) == want
    page = f"<body><div class=story><h1>Head</h1><p>{said}</p>{''.join(parts[:4])}{''.join(chrome[:4])}</div><div class='sidebar-x'>more</div></body>"
    assert G.extract(page, None) == f"Head\n\n{said}\n\nRelated work\n\nShort.\n\n{said}\n\n{said}\n\nThe word stays."


def test_deep_and_broken_nesting():
    """Paths are not stored as text, and open elements are found by tag: 60,000 levels take seconds, not the square."""
    start, deep = time.time(), "<html><body>" + "<div class=x>" * 60_000 + "<p>" + "some words of an article " * 20
    page = G.read_page(deep)
    path = page.path_text(page.proposal()[0])
    assert G.extract(deep, path) == ("some words of an article " * 20).strip()
    odd = "<td>" + "<div>" * 30_000 + "</b></p>" * 30_000 + "<article>" + "<span class=a>" * 30_000 + "x"
    assert G.extract(odd, None) == "x"
    assert time.time() - start < 60


def test_paths_are_read_back():
    page = G.read_page('<div><div class="a>b"><p>one</p></div><div class="a"><div class="b"><p>two</p></div></div></div>')
    for e in range(1, len(page.path)):
        assert e in page.at_path(page.path_text(e))
        assert {page.path_text(x) for x in page.at_path(page.path_text(e))} == {page.path_text(e)}
    assert page.at_path("") == page.at_path(">div>none") == page.at_path("div") == []
