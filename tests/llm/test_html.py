import html
import re

import pytest
from conftest import DATA

from ratingloom.llm.html_blocks import path_key, read_page, score_containers
from ratingloom.llm.html_extract import extract, host_of, main_text, winning_paths

ARTICLE = "<h1>Title &amp; more</h1><p>First  paragraph,\nof some length, as they are.</p><p>Second <b>par</b>agraph with <a href='x'>a link</a>.</p>"
TITLE = "<h1>Title &amp; more</h1>"
WANT = "Title & more First paragraph, of some length, as they are. Second paragraph with a link."


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>T</title>{head}</head><body>{body}</body></html>"


PAGES = {
    "plain": page(f"<nav><a href='/'>Home</a></nav><article>{ARTICLE}</article><footer>&copy; us</footer>"),
    "classes": page(
        f"<div class='site-header'>Site name</div><div id='menu'><ul><li>One<li>Two</ul></div><div class='post-content'>{ARTICLE}"
        "<div class='share-buttons'>Share this</div><div class=advert>Buy now!</div></div>"
        "<div class='sidebar'><p>Much text in a sidebar, longer than one would like it to be, on and on and on.</p></div>"
        "<div id='comments'><h2>Comments</h2><div class='comment'><p>A reader says a lot of things here, really a lot, "
        "and goes on about it for a long time, longer than the article itself was in the first place.</p></div></div>"
    ),
    "scripts": page(f"<script>var t='</p><p>no';</script><style>p{{}}</style><main><article>{ARTICLE}<script>x<y</script></article></main>"),
    "forms": page(f"<article>{ARTICLE}<form><label>Mail</label><input><button>Go</button></form><noscript>Turn it on</noscript></article>"),
    "notice": page(f"<div class='cookie-notice'>We use cookies, many of them, for your own good.</div><article>{ARTICLE}</article>"),
    "unclosed": f"<body><nav><ul><li>x<li>y</ul></nav><article>{ARTICLE.replace('</p>', '')}",
    "header": page(f"<header><h2>Site</h2></header><article><header>{TITLE}<p>by someone</p></header>{ARTICLE.removeprefix(TITLE)}</article>"),
    "footer": page(
        f"<div class='content with-sidebar'><div class='entry'>{ARTICLE}<div class='entry-footer'>Filed under: things</div></div></div>"
        "<div id='pageFooter'><p>All about us and how to reach us, in many words that nobody reads to the end.</p></div>"
    ),
    "upper": page(f"<ARTICLE>{ARTICLE}</ARTICLE><FOOTER>end</FOOTER>"),
    "comment": page(f"<article><!-- <p>not this</p> -->{ARTICLE}<!-- open </article>"),
}


@pytest.mark.parametrize("name", sorted(PAGES))
def test_article_without_the_rest(name):
    assert main_text(read_page(PAGES[name]), []) == WANT


def test_consensus_overrides_a_page_of_its_own(spark):
    def built(words):
        return page(f"<div class='c{words}'><p>{'body text ' * words}</p></div><div class='extra'><p>{'aside words ' * 30}</p></div>")

    usual = [(i, "http://a.example/x", built(60 + i).replace(f"c{60 + i}", "text-1")) for i in range(8)]
    odd = (99, "http://a.example/y", built(20).replace("c20", "text-2"))
    rows = {r.page_id: r.text for r in extract(spark.createDataFrame([*usual, odd], "page_id long, url string, html string")).collect()}
    assert rows[99] == " ".join(["body text"] * 20)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{DATA}/pages.parquet")
    got = {r.page_id: r for r in extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", r.html, re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_messy_pages(spark):
    rows = [
        (1, None, None), (2, "", ""), (3, "not a url", "only text, no tags"), (None, "http://U:p@Host:80/", PAGES["plain"]),
        (4, "http://h/", "<p>" * 3000 + "deep"), (4, "http://h/", "<p>" * 3000 + "deep"), (5, "x://", "<<<a <b >>> &#x41; &nbsp; &bogus;"),
        (6, "http://h/", "<a title=\"unclosed><p>text</p>"), (7, "http://h/", "<div>" * 500 + "x" * 200_000),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'own' as host", "1 as paths")
    got = extract(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars", "host"]
    texts = [(r.page_id, r.text) for r in got.collect()]
    assert len(texts) == len(rows) and all(t is not None for _, t in texts)
    assert (1, "") in texts and (2, "") in texts and (None, WANT) in texts and (3, "only text, no tags") in texts
    assert (7, "x" * 200_000) in texts
    assert extract(frame.limit(0)).count() == 0


def test_hosts_and_votes(spark):
    hosts = spark.createDataFrame([("http://u:p@A.b:8/x",), (None,), ("c.d/e",)], "url string").select(host_of(__import__("pyspark.sql.functions").sql.functions.col("url"))).collect()
    assert [r[0] for r in hosts] == ["a.b", "", ""]
    votes = [("h", "/b", 1.0)] * 3 + [("h", "/a", 9.0)] * 3 + [("h", "/c", 99.0)]
    best = winning_paths(spark.createDataFrame(votes, "host string, path string, score double"), 2).first()
    assert best.paths == ["/a", "/b"]


def test_scores_prefer_the_article():
    p = read_page(PAGES["classes"])
    assert p.containers[score_containers(p)].path.endswith("div.post-content")


@pytest.mark.parametrize(
    "name", ["related-work", "skip-list", "poll", "disclaimer", "rating-note", "social", "share-price", "alert-levels", "cookie-recipes"]
)
def test_a_word_of_a_class_does_not_drop_article_text(name):
    body = f"<article>{ARTICLE}<div class='{name}'><p>This part is text of the article, with <a href='x'>one link</a> in it.</p></div></article>"
    assert main_text(read_page(page(body)), []) == WANT + " This part is text of the article, with one link in it."


@pytest.mark.parametrize("name", ["related-posts", "share-buttons", "social", "comment-list", "newsletter-signup", "cookieNotice", "adSlot", "poll-links", "wp-block-latest-comments", "fb-share", "onetrust-consent-sdk"])
def test_known_names_and_lists_of_links_go(name):
    body = f"<article>{ARTICLE}<div class='{name}'><a href='a'>Something else to read</a> <a href='b'>And more</a></div></article>"
    assert main_text(read_page(page(body)), []) == WANT


def test_deeply_nested_pages_stay_small():
    import tracemalloc

    source = "<div class='wrap'>" * 50_000 + "<p>deep text</p>"
    tracemalloc.start()
    found = main_text(read_page(source), ["/div.wrap"])
    assert tracemalloc.get_traced_memory()[1] < 200_000_000
    tracemalloc.stop()
    assert found == "deep text"


def test_keys_are_those_of_the_paths():
    found = read_page(PAGES["classes"])
    assert all(c.key == path_key(c.path) for c in found.containers)


def test_a_host_with_two_templates(spark):
    """Pages of the second template also have the container that the first one keeps its article in, as a teaser."""

    def first(i):
        return page(f"<div class='lead'><p>{f'first template {i} ' * 40}</p></div>")

    def second(i):
        return page(f"<div class='lead'><p>{'a teaser ' * 20}</p></div><div class='piece'><p>{f'second template {i} ' * 40}</p></div>")

    rows = [(i, "http://t.example/x", first(i)) for i in range(9)] + [(100 + i, "http://t.example/x", second(i)) for i in range(4)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == " ".join([f"first template {i}"] * 40) for i in range(9))
    assert all(got[100 + i] == " ".join([f"second template {i}"] * 40) for i in range(4))
