"""Operator 3: pages with furniture around an article."""

from tickspark.llm.html_extract import blocks, extract_pages, fit_tree, main_text

RICH = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body>
<header class="site"><a href="/">Home</a> <p>Site of the year</p></header>
<nav><ul><li><a href=a>One</a></li><li><a href=b>Two</a></li></ul></nav>
<div class="cookie-notice">We use cookies to make this page work well for all of our readers today.</div>
<article><header><h1>A &amp; B</h1></header>
<p>First   paragraph with <a href="x">a link</a> and some more words to read&nbsp;here.<br>Second line.
<p><b>Unclosed bold
<div class="advert">Buy now the best thing that there ever was in the whole wide world of things.</div>
<p>Short.</p>
<section id="comments"><h2>Comments</h2><p>I think this is a very long comment by a reader of this page, really.</p></section>
</article>
<aside><p>Related words of a sidebar that are quite long but do not belong to the article at all.</p></aside>
<form><p>Sign up for our letter with your mail address</p><input name=a><button>Go</button></form>
<!-- <p>hidden</p> --><noscript>Turn on scripts</noscript>
<footer>&copy; site <p>All rights are reserved by the people of this site.</p></footer></body></html>"""


def test_article_only(spark):
    tree = fit_tree(spark)
    assert main_text(tree, RICH).split("\n") == [
        "A & B", "First paragraph with a link and some more words to read here. Second line.", "Unclosed bold", "Short."]


def test_page_without_article_mark(spark):
    words = " ".join(["word"] * 40)
    page = f"<body><ul><li><a href=a>Home</a></li><li><a href=b>News</a></li></ul><h1>Head</h1><p>{words}</p><p>{words}</p>" \
           "<ul><li><a href=c>About us</a></li></ul>"
    assert main_text(fit_tree(spark), page) == f"Head\n{words}\n{words}"


def test_odd_pages(spark):
    odd = [None, "", "plain text", "<p>cut &am", "<article><p>cut <b", "<p", "<article><p>" + "w " * 50_000 + "</p></article>", "<a><a></p></div>"]
    df = spark.createDataFrame([(i, "u", h, "x") for i, h in enumerate(odd)] + [(0, "u", None, "x")],
                               "page_id long, url string, html string, text string")
    rows = extract_pages(df).collect()
    assert len(rows) == len(odd) + 1
    got = {r.page_id: r for r in rows}
    assert got[0].text == "" and got[0].n_chars == 0 and got[4].text == "cut" and got[6].n_chars == 99_999
    assert extract_pages(df.limit(0)).collect() == []


def test_link_density():
    assert [(b[1], b[2]) for b in blocks("<p><a>a b</a> c</p><li><a>d</a>")] == [(3, 2), (1, 1)]
