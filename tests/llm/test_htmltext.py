import pytest

from starfold.llm.htmltext import extract, main_text
from starfold.llm.queries import op9_tree_scored_text

P1 = "The first paragraph is long enough to count, has commas, and says something about the matter at hand."
P2 = "The second one goes on, with more words than are needed, so that the container collects some points."
P3 = "A third one ends the story, as third ones do, and adds a few more commas, here, there, and there."


def page(body, head="<title>T</title><style>p{color:red}</style>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


BOILERPLATE = [
    '<nav><ul><li><a href="/a">Home page</a></li><li><a href="/b">About us, and more</a></li></ul></nav>',
    "<header><h1>Site name</h1><p>The best site, of all sites, says the owner of the site.</p></header>",
    '<div class="sidebar"><p>Read more, on the side, about things that are not the article at all.</p></div>',
    '<div id="cookie-notice"><p>We use cookies, as everybody does, please agree to everything now.</p></div>',
    '<div class="ad-banner">Buy this, buy that, buy more.</div>',
    '<form action="/s"><label>Search</label><input name="q"><button>Go</button></form>',
    '<script>var x = "<p>not text, at all, ever</p>";</script><noscript>Enable it</noscript>',
    '<section id="comments"><article class="comment"><p>First, I disagree, with all of this, strongly and loudly.</p></article></section>',
    '<div role="complementary"><p>Also popular, among readers, are these other stories of ours.</p></div>',
    '<div style="display: none"><p>Hidden, but long, and full of commas, for the machines only.</p></div>',
    '<ul class="x"><li><a href="/1">One story</a></li><li><a href="/2">Two story</a></li><li><a href="/3">Three story</a></li></ul>',
    "<footer><p>Copyright, all rights reserved, and so on, for ever and ever.</p></footer>",
    "<aside><p>An aside, to the side, for those who like asides, if any do.</p></aside>",
]


@pytest.mark.parametrize("holder", ["article", "div", "main", 'div class="post-content"', "section", 'div id="page-wrap" class="with-sidebar"'])
@pytest.mark.parametrize("junk", [*BOILERPLATE, "".join(BOILERPLATE)])
def test_boilerplate_goes(holder, junk):
    name = holder.split()[0]
    body = f"{junk}<{holder}><h1>Title</h1><p>{P1}</p><p>{P2}</p><p>{P3}</p></{name}>{junk}"
    assert main_text(page(body)) == "\n\n".join(["Title", P1, P2, P3])


@pytest.mark.parametrize("junk", BOILERPLATE)
def test_boilerplate_within_the_article_goes(junk):
    if "<header" in junk:
        return
    assert main_text(page(f"<article><h1>Title</h1><p>{P1}</p>{junk}<p>{P2}</p></article>")) == "\n\n".join(["Title", P1, P2])


def test_inline_adverts_go():
    body = f'<article><p>{P1} <span class="ad">Buy <span>now</span> here</span> on.</p><p><ins class="adsbygoogle">x{P2}</p><p>{P3}</p></article>'
    assert main_text(page(body)) == "\n\n".join([f"{P1} on.", P3])
    kept = '<article><p class="lead"><span class="title">Commentary</span> <a href="/x" class="link">stays</a></p></article>'
    assert main_text(page(kept)) == "Commentary stays"
    comments = f'<article><p>{P1}</p><p>{P2}</p></article><ol class="commentlist"><li>{P3}</li></ol>'
    assert main_text(page(comments)) == f"{P1}\n\n{P2}"


def test_siblings_are_kept():
    body = f"<div><h2>Title</h2><div><p>{P1}</p><p>{P2}</p></div><div><p>{P3}</p><p>{P1}</p></div><p>Short end.</p></div>"
    assert main_text(page(body)) == "\n\n".join(["Title", P1, P2, P3, P1, "Short end."])


LONG_ARTICLE = "".join(f"<p>{text}</p>" for text in (P1, P2, P3) * 4)
WANTED = "\n\n".join([P1, P2, P3] * 4)


@pytest.mark.parametrize("junk", ["", *BOILERPLATE, "".join(BOILERPLATE)])
@pytest.mark.parametrize(
    "start, end",
    [
        ('<form id="aspnet"><article>', "</article></form>"),
        ('<form method="post"><div>', "</div></form>"),
        ('<div class="elementor-widget"><article>', "</article></div>"),
        ('<div class="elementor-widget"><div class="elementor-widget-container">', "</div></div>"),
        ('<div class="social-news"><article>', "</article></div>"),
        ('<div class="social-news">', "</div>"),
        ('<article class="post hentry comment-status open comments-open">', "</article>"),
        ('<div class="post share-enabled">', "</div>"),
        ('<section id="discussion-paper">', "</section>"),
        ('<section id="discussion-paper"><article>', "</article></section>"),
        ('<main><div class="widget"><article>', "</article></div></main>"),
        ('<form><div class="widget modal"><section id="promo">', "</section></div></form>"),
    ],
)
def test_words_do_not_delete_the_article(start, end, junk):
    assert main_text(page(f"{junk}{start}{LONG_ARTICLE}{end}{junk}")) == WANTED
    if "<header" not in junk:
        assert main_text(page(f"{start}{junk}{LONG_ARTICLE}{junk}{end}")) == WANTED


def test_an_article_in_several_suspects():
    body = "".join(f'<div class="elementor-widget"><p>{text}</p><p>{P1}</p></div>' for text in (P1, P2, P3))
    assert main_text(page(f"<div>{body}</div>{''.join(BOILERPLATE)}")) == "\n\n".join([P1, P1, P2, P1, P3, P1])


def test_long_suspects_beside_an_article_go():
    side = f'<div class="sidebar">{LONG_ARTICLE}</div>'
    remarks = "".join(f'<article class="comment"><p>{P2}</p></article>' for _ in range(9))
    cards = "".join(f"<article><p>{P3}</p></article>" for _ in range(4))
    body = f'{side}<article><p>{P1}</p><p>{P2}</p><p>{P1}</p></article><section id="comments">{remarks}</section><div class="related">{cards}</div>'
    assert main_text(page(body)) == "\n\n".join([P1, P2, P1])


def test_many_nested_suspects():
    deep = '<div class="widget">' * 2000 + f"<p>{P1}</p>" + "</div>" * 2000
    assert main_text(page(deep)) == P1


def test_blocks_and_white_space():
    body = f"<article><p>  One\n\t two&nbsp;&amp; <b>bo</b>ld<br>line </p><ul><li>item <i>a</i><li>item b</ul>loose <a href=x>link</a> text<pre>a\n  b</pre><p>{P1}</article>"
    assert main_text(page(body)) == "\n\n".join(["One two & bold line", "item a", "item b", "loose link text", "a b", P1])


def test_broken_markup():
    assert main_text(page(f"<article><p><b>{P1}<br><p>{P2}</div></article></span><p>{P3}")) == "\n\n".join([P1, P2, P3])
    assert main_text(f"<p>{P1}<p>{P2}") == f"{P1}\n\n{P2}"
    assert main_text(f"<article><p>{P1} 1 < 2 > 0 &lt;b&gt; &#x41;&copy</p><!-- no -- end") == f"{P1} 1 < 2 > 0 <b> A©"
    assert main_text("just text") == "just text"
    assert main_text('<p title="a > b">x</p><p title="never closed>y</p>') .startswith("x")


@pytest.mark.parametrize("text", [None, "", "<html></html>", "<script>x</script>", "<nav><p>menu</p></nav>", "<", "<p", "&"])
def test_pages_without_article(text):
    assert main_text(text) == ("&" if text == "&" else text if text in ("<", "<p") else "")


def test_deep_and_long_pages():
    deep = "<div>" * 5000 + f"<p>{P1}</p>" + "</div>" * 5000
    assert main_text(page(deep)) == P1
    many = "".join(f"<p>{P1} {i}</p>" for i in range(5000))
    assert main_text(page(f"<article>{many}</article>")).count("\n\n") == 4999
    assert main_text("<" * 20_000) and main_text("<a title='" * 500) is not None


def test_nothing_is_capped():
    short = "".join(f"<p>w{i}</p>" for i in range(300))
    assert main_text(page(f"<article>{short}</article>")).split("\n\n") == [f"w{i}" for i in range(300)]


def test_table_with_clashing_columns(spark):
    rows = [(1, "u", page(f"<article><p>{P1}</p></article>"), "old", None), (1, "u", None, None, 2), (None, None, "", "x", 3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    found = extract(pages)
    assert found.columns == ["page_id", "url", "n_chars", "text"]
    assert sorted(row["text"] for row in found.collect()) == ["", "", P1]
    assert extract(pages.limit(0)).count() == 0


def test_query(spark):
    found = op9_tree_scored_text(spark, "/root/testdata/sf0.001")
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    pages = {row["page_id"]: row["html"] for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    for row in found.collect():
        assert row["text"] == main_text(pages.pop(row["page_id"])) and row["n_chars"] == len(row["text"])
    assert not pages
