import html as stdlib
import re
import time

from sievework.llm import html

from .helpers import saved

ARTICLE = "<h1>Title of it</h1><p>First long paragraph of the article, with <b>bold</b> &amp; <a href=x>a link</a>.<p>Short.</p><ul><li>one<li>two</ul><p>Last long paragraph of the article,\n over two lines&nbsp;of source.</p>"
TEXT = "Title of it\nFirst long paragraph of the article, with bold & a link.\nShort.\none\ntwo\nLast long paragraph of the article, over two lines of source."
NOISE = {
    "nav": "<nav><ul><li><a href=/>Home</a><li><a href=/b>Other things to read here</a></ul></nav>",
    "menu": "<div class='main-menu'><a href=/>Home</a> <a href=/x>About us</a></div>",
    "header": "<header><div>Site name and its long slogan for all pages</div></header>",
    "ad": "<div class=ad>Buy this now, it is a really long text about a product that nobody needs at all, buy it today.</div>",
    "cookie": "<div id='cookie-notice' role=dialog><p>We use cookies on this site and here is a long text about that.</p></div>",
    "script": "<script>var t = '</p><p>not text</p>';</script><style>p{margin:0}</style>",
    "form": "<form action=/s><label>Your name</label> <input name=n><button>Send it now</button></form>",
    "aside": "<aside><p>A sidebar that talks about other articles at some length, to be left out.</p></aside>",
}
AFTER = {
    "comments": "<section class=comments><h2>Comments</h2><article class=comment><p>I have read this whole article and I want to say a lot about it.</p></article></section>",
    "footer": "<footer>&copy; 2020 a site &middot; imprint</footer>",
}


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title></head><body>{body}</body></html>"


def test_regions():
    before, after = "".join(NOISE.values()), "".join(AFTER.values())
    for open_, close in (("<article>", "</article>"), ("<main><div>", "</div></main>"), ("<div class=content>", "</div>"), ("<div id=text><section>", "</section></div>")):
        assert html.main_text(page(before + open_ + ARTICLE + close + after)) == TEXT
        assert html.main_text(page(before + open_ + ARTICLE + AFTER["comments"] + close + after)) == TEXT


def test_uneven_sections():
    long = "A long sentence of the body that goes on for quite a while. " * 20
    for open_, close in (("<article>", "</article>"), ("<main>", "</main>")):
        for first, body in (("<section>Short intro.</section>", f"<section><p>{long}</p><p>{long}</p></section>"), ("<p class=lead>Short intro.</p>", f"<div class=body><p>{long}</p><p>{long}</p></div>")):
            got = html.main_text(page(NOISE["nav"] + open_ + "<h1>Title of it</h1>" + first + body + "<section>Short end.</section>" + close + AFTER["footer"]))
            assert got == "\n".join(["Title of it", "Short intro.", long.strip(), long.strip(), "Short end."])


def test_edges():
    assert html.main_text(None) == html.main_text("") == html.main_text(page("")) == ""
    assert html.main_text("only  text &lt;b&gt;\n more") == "only text <b> more"
    assert html.main_text(page("<nav><a href=/>Home</a></nav>")) == ""
    assert html.main_text("<p>never closed <i>at all") == "never closed at all"
    assert html.main_text(page("<article><p>" + "word " * 50_000 + "</article>")) == " ".join(["word"] * 50_000)


def test_pages(spark, data):
    df = spark.read.parquet(f"{data}/pages.parquet")
    found = {r.page_id: r for r in html.op7_html_text(spark, data).collect()}
    assert len(found) == df.count()
    for r in df.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1].replace("<br>", " ")
        blocks = [" ".join(stdlib.unescape(re.sub("<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert found[r.page_id].text == "\n".join(b for b in blocks if b)
        assert found[r.page_id].n_chars == len(found[r.page_id].text)


def test_table_edges(spark, tmp_path):
    rows = [(1, "u", None), (1, "u", None), (2, None, ""), (None, "u", "<p>x y")]
    folder = saved(spark, tmp_path, pages=spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in html.op7_html_text(spark, folder).collect()) == [("1", "", 0), ("1", "", 0), ("2", "", 0), ("None", "x y", 3)]


def test_layout_words_do_not_take_the_article():
    comments = "<div class=comments>" + "<p>A reader says a lot of things that are not part of it.</p>" * 40 + "</div>"
    for name in ("content has-sidebar", "no-sidebar", "page-footer-fixed", "elementor-widget-container", "social-science", "share-price"):
        for inner in (ARTICLE, f"<article>{ARTICLE}</article>", f"<div class=text>{ARTICLE}</div>"):
            body = f"<div class='{name}'>{inner}<div class=sidebar><p>Other things to read on this site.</p></div></div>"
            assert html.main_text(page(NOISE["nav"] + body + AFTER["footer"])) == TEXT
            assert html.main_text(page(NOISE["nav"] + f"<div class=content>{inner}</div>" + comments)) == TEXT
    assert html.main_text(page("<div class='widget'><p>All the text there is on this page.</p></div>")) == "All the text there is on this page."


def test_time_follows_the_length_of_the_page():
    def seconds(piece, n, more=""):
        text = page("<p>text</p>" + piece * n + more * n)
        began = time.process_time()
        html.main_text(text)
        return time.process_time() - began

    for piece, more in (("<div>a word ", ""), ("<div>", "</span>x"), ("<span><article><b>", "</span>"), ("<section>", "<dt>x</dt>"), ("<div class=sidebar>x ", "")):
        seconds(piece, 100, more)
        assert seconds(piece, 24_000, more) < 16 * max(seconds(piece, 3_000, more), 0.02)


def test_empty_table_and_columns_of_any_name(spark, tmp_path):
    rows = spark.createDataFrame([(1, "u", "<p>x", 5, 6)], "page_id long, url string, html string, __text int, row int")
    assert html.extracted(rows).columns == ["page_id", "url", "row", "__text"] and html.extracted(rows).first()["__text"] == "x"
    folder = saved(spark, tmp_path, pages=rows.limit(0))
    assert html.op7_html_text(spark, folder).count() == 0


def test_ratios_choose_the_region():
    """Pages without telling names: only ratios can tell the text from the short lines around it."""
    long = "A sentence of the article that says one thing after another, and goes on. "
    article = "".join(f"<p>{long * (2 + k % 3)}</p>" + ("<p>Short.</p>" if k == 3 else "") for k in range(8))
    text = "\n".join(x for k in range(8) for x in [(long * (2 + k % 3)).strip(), *(["Short."] if k == 3 else [])])
    before = "<div>" + "".join(f"<div><span><b>Item {k}</b></span></div>" for k in range(9)) + "</div>"
    after = "<div>" + "".join(f"<div><i>Word {k}</i><br><i>more</i></div>" for k in range(12)) + "</div>"
    for wrap in ("<div>{}</div>", "<div><div>{}</div></div>", "<table><tr><td><div>{}</div></td></tr></table>"):
        assert html.main_text(page(before + wrap.format(article) + after)) == text


def test_other_ratios_choose_other_lines(data):
    import numpy as np
    import pyarrow.parquet as pq

    pages = pq.read_table(f"{data}/pages.parquet").column("html").to_pylist()
    found, smoothed, rng = [html.main_text(x) for x in pages], html.smoothed, np.random.default_rng(1)
    try:
        html.smoothed = lambda x: rng.random(len(x))
        other = [html.main_text(x) for x in pages]
    finally:
        html.smoothed = smoothed
    assert sum(a != b for a, b in zip(found, other)) > len(pages) / 2


def test_links_count_however_deep_they_are():
    links = "<div>" + "".join(f"<div><a href=/{k}><span><b><i><u><em>{'A long title of some other page to go to' * 2} {k}</em></u></i></b></span></a></div>" for k in range(3)) + "</div>"
    body = "<p>" + "The only text of the page. " * 30 + "</p>"
    assert html.main_text(page(links + body)) == ("The only text of the page. " * 30).strip()


def test_many_short_lines_stay_with_a_long_one():
    short = "".join("<p>Word ok</p>" for _ in range(170))
    got = html.main_text(page(NOISE["nav"] + f"<div><h1>The title of this page</h1><p>{'Words and words. ' * 300}</p>{short}</div>" + AFTER["footer"]))
    assert got.split("\n") == ["The title of this page", ("Words and words. " * 300).strip(), *["Word ok"] * 170]
