import pytest

from strataflow.llm import html

FULL = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head>
<body class="nav-open"><header class="site"><h2>Site</h2><a href=/>home</a></header><div class="cookie-notice">We use cookies</div>
<div class="layout"><div id="main-content" class="post-12 content"><header><h1>T &amp; t</h1><span>By A</span></header>
<p>One   two<br>three &lt;b&gt;<p>Four <b>five <i>six</b> seven<ul><li>a<li>b</ul><div class="ad-box">BUY</div>
<form><p>Search</p></form><pre>x  y</pre>bare text <a href="q">link</a><!-- <p>hidden</p> --><noscript><p>js</p></noscript></div>
<div class="sidebar"><p>side side side side side side side</p></div>
<section id="comments"><article class="comment"><p>Nice post!</p></article></section></div><footer>f</footer></body></html>"""


def test_one_page():
    page = html.Page(FULL)
    assert page.paths[page.best()] == "body>div.layout>div.content.post-#"
    assert page.extract([]) == "T & t\nOne two three <b>\nFour five six seven\na\nb\nx y\nbare text link"


@pytest.mark.parametrize(
    "broken,text",
    [
        ("", ""), ("<", "<"), ("a < b", "a < b"), ("<p>x", "x"), ("<p a='>'>x</p>", "x"), ('<p a=">x', "x"), ("<script>x", ""),
        ("<!-- x", ""), ("</div></p>x", "x"), ("<p>&nbsp;a&#x41;&bogus;</p>", "aA&bogus;"), ("<P>x</P><DIV>y</DIV>", "x\ny"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<textarea><p>no</p></textarea>x", "x"), ("<dl><dt>a<dd>b</dl>", "a\nb"),
    ],
)
def test_broken_markup(broken, text):
    assert html.Page(broken).extract(["body"]) == text


def page(k, body, extra=""):
    return f"<html><body><nav><a href=a>menu</a></nav>{extra}<div class='wrap p{k}'>{body}</div><footer>end</footer></body></html>"


def test_hosts_agree(spark):
    """A short article next to long unmarked text is found by the path of the host's other pages."""
    text = "".join(f"<p>sentence number {k} of the article</p>" for k in range(20))
    rows = [(k, f"http://Example.com/{k}", page(k, f"<div class='story'>{text}</div>"), "x") for k in range(5)]
    rows.append((9, "http://example.com/9", page(9, "<div class='story'><p>short</p></div>", "<div><p>" + "other words " * 50 + "</p></div>"), "x"))
    rows.append((10, "http://other.com/", page(1, "<div class='else'><p>own path</p></div>"), "x"))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, paths string")
    found = {r["page_id"]: r["text"] for r in html.main_texts(frame).collect()}
    assert found[9] == "short" and found[10] == "own path"
    assert found[0].count("\n") == 19


def test_odd_rows(spark):
    rows = [(1, None, FULL), (2, "not a url", None), (None, "http://a.b/", ""), (3, "http://a.b/", "<p>x</p>"), (3, "http://a.b/", "<p>x</p>"),
            (4, "http://a.b/", "<p>" + "w " * 200_000 + "</p>"), (5, "http://[bad/", "<p>y</p>")]
    found = html.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = {(r["page_id"], r["url"]): r["text"] for r in found}
    assert len(found) == len(rows) and texts[2, "not a url"] == "" and texts[None, "http://a.b/"] == ""
    assert texts[3, "http://a.b/"] == "x" and texts[5, "http://[bad/"] == "y"
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert html.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []
