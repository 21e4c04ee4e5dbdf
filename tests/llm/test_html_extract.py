import html
import re

import numpy as np
import pytest

from aerostat.llm import html_extract as hx
from tests.conftest import SF001


@pytest.fixture(scope="module")
def tree(spark):
    return hx.train(spark)


def text_of(page, tree):
    texts, rows = hx.blocks(page)
    return "\n".join(t for t, ok in zip(texts, hx.decide(tree, rows)) if ok)


def test_tree_fits_its_table(tree):
    rows, labels = hx.labelled_blocks()
    assert (hx.decide(tree, rows) == labels).mean() > 0.97 and labels.sum() > 20 and (~labels).sum() > 20


def test_whole_table_is_the_article(spark, tree):
    """The pages' main text, cut out by hand-written patterns for their one template."""
    for r in hx.op2_extract_text(spark, SF001).join(spark.read.parquet(f"{SF001}/pages.parquet").select("page_id", "html"), "page_id").collect():
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1] if "<article>" in r.html else ""
        body = re.sub(r"<[^<>]*\Z", "", body)
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " " if "br" in p else "", p)).split()) for p in re.split(r"</?(?:h1|p)>", body)]
        assert re.sub(r"\s", "", r.text) == re.sub(r"\s", "", "".join(re.sub("<br>", " ", p) for p in parts)), r.page_id
        assert r.n_chars == len(r.text) and not re.search(r"  |^\s|\s$|\n\n", r.text)


ARTICLE = "<p>The first paragraph of the story has quite a few words in it.</p><p>Short.</p><h2>Part two</h2><ul><li>one item</li></ul>"
WANT = "The first paragraph of the story has quite a few words in it.\nShort.\nPart two\none item"


@pytest.mark.parametrize("extra", [
    '<nav><a href="/">Home</a> <a href="/x">More</a></nav>', '<div class="sidebar"><p>Some long text beside the story that nobody asked for today.</p></div>', "<footer>Imprint and all the rest of it</footer>",
    '<div id="cookie-notice"><p>We use cookies to make our pages better for everyone who reads them.</p><button>OK</button></div>', '<form action="/s"><label>Search our pages</label><input name=q></form>',
    '<aside>Beside the point, but in many many words, as they often are.</aside>', '<section class="comments"><h3>Comments</h3><article><p>I have read it twice and liked it both times, really.</p></article></section>',
    '<div class="ad banner">Buy one and get one free in all our shops until the end of May.</div>', "<script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> -->", '<select><option>Red</option></select><noscript>Turn it on</noscript>'])
@pytest.mark.parametrize("where", ["before", "after"])
def test_furniture_goes(extra, where, tree):
    main = f"<article>{ARTICLE}</article>"
    page = f"<html><head><title>T</title></head><body>{extra + main if where == 'before' else main + extra}</body></html>"
    assert text_of(page, tree) == WANT


def test_references_white_space_and_broken_markup(tree):
    assert text_of("<article><p>A&amp;B &lt;i&gt; &eacute;&#233; &copy;\n\t and <b>bo</b>ld<br>line<p>next <a href='x>y'>one</a></article>", tree) == "A&B <i> éé © and bold line\nnext one"
    assert text_of("<article><p>It ends in the mid", tree) == "It ends in the mid"
    assert text_of("<article><p>cut tag <a hre", tree) == "cut tag"
    assert text_of("</div></p><article></b><p>ok 1 < 2 and <3</p>", tree).startswith("ok 1")
    assert text_of("<div class=ad>open box<article><p>The story goes on here with words.</p></article>", tree) == "The story goes on here with words."
    assert text_of("<article><p>a<script>x</p></article>", tree) == "a"


def test_cases(spark, tree):
    df = spark.createDataFrame([(1, "u", None, "t"), (2, None, "", "t"), (3, "u", "<article><p>é x</p></article>", "t"), (3, "u", "<article><p>é x</p></article>", "t"), (None, "u", "<p>" * 20_000, "t")],
                               "page_id long, url string, html string, text string")
    got = sorted((str(r.id), str(r.url), r.text) for r in hx.extract(df, "page_id", "url", "html", tree).collect())
    assert got == [("1", "u", ""), ("2", "None", ""), ("3", "u", "é x"), ("3", "u", "é x"), ("None", "u", "")]
    assert hx.extract(df.limit(0), "page_id", "url", "html", tree).count() == 0


def test_neighbours_are_features():
    texts, rows = hx.blocks("<p>one two three</p><p><a href=x>all linked</a></p><p>four</p>")
    assert texts == ["one two three", "all linked", "four"]
    assert rows[1, :6].tolist() == [2, 1, 3, 0, 1, 0] and np.array_equal(rows[0, 2:6], [0, 0, 2, 1])


LONG = "The town kept its boats on land until the ice broke in the early spring of that year, and so did all the others."


@pytest.mark.parametrize("page, want", [
    (f'<article><header class="entry-header"><h1>Headline</h1></header><p>{LONG}</p></article>', f"Headline\n{LONG}"),
    (f'<article><div class="header"><h1>Headline</h1></div><p>{LONG}</p></article>', f"Headline\n{LONG}"),
    (f'<article><section id="related-work"><h2>Related work</h2><p>{LONG}</p></section></article>', f"Related work\n{LONG}"),
    (f'<main><h2 id="search-results">Results</h2><p>{LONG}</p><h2 id="legal-history">History</h2><h3 id="search">Search</h3></main>', f"Results\n{LONG}\nHistory\nSearch"),
    (f'<article><p>{LONG}</p><section id="discussion"><h2>Discussion</h2><p>{LONG}</p></section></article>', f"{LONG}\nDiscussion\n{LONG}"),
    (f'<article><p>{LONG}</p></article><section class="discussion"><h2>Discussion</h2><div class="comment"><p>{LONG}</p></div></section>', LONG),
    (f'<article><p>{LONG}</p></article><section class="discussion"><p>{LONG}</p><form><p>Say something</p></form></section>', LONG),
    (f'<body class="single comments-open has-sidebar"><div class="content"><h1>Headline</h1><p>{LONG}</p></div><div class="acme-sidebar"><p>{LONG}</p></div></body>', f"Headline\n{LONG}"),
    (f'<html class="no-js header-fixed overlay"><article class="post tag-cookies category-legal"><p>{LONG}</p><footer class="entry-footer">Filed under</footer></article></html>', LONG),
    (f'<article><p>{LONG}</p></article><div class="site-header__inner"><p>{LONG}</p></div><div id="related-posts"><p>{LONG}</p></div><ul class="wp-block-social-links"><li>{LONG}</ul><div class="comments-area"><p>{LONG}</p></div>', LONG)])
def test_names_are_judged_whole(page, want, tree):
    assert text_of(page, tree) == want


@pytest.mark.parametrize("page", [
    f"<html><head><title>T</title><body><article><p>{LONG}</article>", f"<html><head><title>T</title><meta charset=utf-8><link rel=x href=y><style>p{{}}</style><article><p>{LONG}</article>",
    f"<head><script>var a</script><noscript><style>p{{}}</style></noscript><main><p>{LONG}</main>", f"<head><title>T</title></head><article><iframe src=x><p>{LONG}</article>",
    *[f"<article><{e}><p>{LONG}</article>" for e in ("iframe", "object", "svg", "video", "select", "noscript", "template", "audio", "canvas")],
    f"<article><select><option>Red<option>Blue<p>{LONG}<select><option>Green</select></article>", f"<article><svg><svg><text>a</text></svg><text>b</text></svg><p>{LONG}</article>",
    f"<article><iframe src=x><p>{LONG}<iframe>no</iframe></article>", f"<svg><title>Icon</svg><article><p>{LONG}</article><svg><title>t</title></svg>"])
def test_heads_and_elements_without_end_tag_drop_nothing(page, tree):
    assert text_of(page, tree) == LONG


def test_raw_text_runs_to_the_end(tree):
    for e in ("script", "style", "textarea", "title"):
        assert text_of(f"<article><p>a<{e}>x</p><p>{LONG}</p></article>", tree) == "a"


def test_tree_rests_on_shape(tree):
    used = set()

    def walk(t):
        if not isinstance(t, bool):
            used.add(hx.FEATURES[t[0]])
            walk(t[2]), walk(t[3])
    walk(tree)
    assert {"words", "link_density", "links", "main_after"} <= used and {"link_density_before", "link_density_after"} & used


BAR = "<div><a href=/>Home</a> <a href=/s>Our shop</a> <a href=/c>Contact</a></div>"


@pytest.mark.parametrize("page, want", [
    ("<p>Short story.</p><p>It ends.</p>", "Short story.\nIt ends."), ("<p>One.</p>", "One."),
    (f"{BAR}<h1>Boats</h1><p>{LONG}</p><h2>Part two</h2><p>Bye.</p>{BAR}<p>All rights reserved</p>", f"Boats\n{LONG}\nPart two\nBye."),
    (f"<h1>Headline</h1><article><p>{LONG}</p></article>", f"Headline\n{LONG}"), (f"<p>Log in</p><h1>Headline</h1><article><p>Yes.</p></article><h1>More</h1>", "Headline\nYes."),
    (f"<header><h1>The Daily Page</h1></header><article><p>{LONG}</p></article>", LONG), (f"<h3>Latest</h3><article><p>{LONG}</p></article>", LONG),
    (f'<article><p>{LONG}</p><div class="tools"><a href=/f>Facebook</a> <a href=/p>Print</a></div><p>It ends.</p></article>', f"{LONG}\nIt ends."),
    (f"<article><p>{LONG} <a>one</a> <a>two</a> <a>three</a> <a>four</a> <a>five</a> <a>six</a></p><ul><li><a href=/r>A source</a></ul></article>", f"{LONG} one two three four five six\nA source"),
    (f"<p>{LONG}</p><div id=comments><p>Nice.</p><p>{LONG}</p></div>", LONG)])
def test_lengths_links_and_neighbours_decide(page, want, tree):
    assert text_of(page, tree) == want


def test_pages_without_names_or_article_marks(tree):
    """All class, id and role attributes and the article's tags taken away: most of the words are still told apart."""
    from collections import Counter
    import pyarrow.parquet as pq
    both = got_all = want_all = 0
    for page in pq.read_table(f"{SF001}/pages.parquet", columns=["html"]).column(0).to_pylist():
        bare = re.sub(r"\s(?:class|id|role)=(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", re.sub(r"</?(?:article|main)[^>]*>", "", page or ""))
        want, got = Counter(text_of(page or "", tree).split()), Counter(text_of(bare, tree).split())
        both, got_all, want_all = both + sum((want & got).values()), got_all + sum(got.values()), want_all + sum(want.values())
    assert both >= 0.9 * got_all and both >= 0.9 * want_all


@pytest.mark.parametrize("page", ["<ul>" * 40_000 + "x", "<ul></div>" * 20_000 + "x", "<section class=discussion><p>x" * 20_000, "<div class=ad>" * 20_000 + "<div class=content><p>y</p></section>" * 20_000])
def test_deep_nesting_takes_time_in_proportion(page):
    import time
    start = time.process_time()
    hx.blocks(page)
    assert time.process_time() - start < 10
