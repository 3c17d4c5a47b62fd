"""Main text of known pages, broken markup and edge rows."""

import html
import re

from lendgrade.llm import extraction, registry

ARTICLE = (
    "<!DOCTYPE html><html><head><title>No title</title><style>p{{}}</style></head><body>"
    "<header><a href=/>Site name</a></header><nav><ul><li><a>Menu one</a><li><a>Menu two</a></ul></nav>"
    "<div class='cookie-notice'>We use cookies here</div>"
    "{open}<h1>The  title</h1><p>First <b>para</b>graph &amp; more&nbsp;text of it.<p>Second one, which is longer, <a href=x>with a link</a>.</p>"
    "<div class=\"ad banner\">Buy it now</div><script>var a = '<p>not text</p>';</script><form><input><button>Send</button></form>"
    "<p>Last words of the article are here.</p>{close}"
    "<aside>Aside words</aside><section id=comments><p>First! says a reader</p></section><footer>&copy; nobody</footer></body></html>"
)
TEXT = "The title First paragraph & more text of it. Second one, which is longer, with a link. Last words of the article are here."


def test_templates():
    weights = extraction.learn([ARTICLE.format(open="<article>", close="</article>")] * 10)
    for o, c in (("<article>", "</article>"), ("<main>", "</main>"), ("<div class=content>", "</div>")):
        assert extraction.main_text(ARTICLE.format(open=o, close=c), weights) == TEXT
    assert extraction.main_text(ARTICLE.format(open="<article>", close="</article>"), extraction.Weights()) == TEXT


def test_long_furniture_does_not_cut_the_article():
    given = "<body><nav><ul><li>Menu</ul></nav>{article}<div class=ad>Buy it now</div><footer>Nobody</footer></body>"
    weights = extraction.learn([given.format(article="<article><h1>One title</h1><p>Some words of it.</article>")] * 10)
    short, rest = "word " * 20, "rest " * 400
    adverts = f"<div class='ad'>{'buy ' * 30}</div>", f"<form>{'<p>fill <input> in</p>' * 300}</form>", f"<nav><ul>{'<li><a>part</a></li>' * 300}</ul></nav>"
    for w in (weights, extraction.Weights()):
        for advert in adverts:
            for one, two in ((short, rest), (rest, short), (short, short)):
                page = given.format(article=f"<article><p>{one}</p>{advert}<p>{two}</p></article>")
                assert extraction.main_text(page, w) == (one + two).strip()


def test_scan_finds_the_greatest_run():
    weights = extraction.Weights()
    page = "".join(f"<p>{'w ' * n}" + "<i></i>" * m for n, m in ((3, 9), (8, 1), (1, 20), (6, 4), (2, 2)))
    items = list(extraction.features(page))
    scores = [n * weights.word(f[2:]) if t[0] == "text" else weights.tag(f[2:]) for f, n, t in items]
    best = max(sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1))
    i, j = extraction.region(items, weights)
    assert abs(sum(scores[i:j]) - best) < 1e-9


def test_broken_pages():
    weights = extraction.Weights()
    cases = {
        "": "",
        "<p>": "",
        "plain words only": "plain words only",
        "<!-- open comment": "",
        "<script>var x = 'words words'": "",
        "a < b and c": "a < b and c",
        "<p title='a > b'>some words of text": "some words of text",
        "<p>one two three &lt;tag&gt; four</p": "one two three <tag> four",
    }
    for page, text in cases.items():
        assert extraction.main_text(page, weights) == text, page
    long = "<article>" + "<p>" + "many words " * 100_000 + "</article>"
    assert extraction.main_text(long, weights) == ("many words " * 100_000).strip()


def test_raw_elements_end_where_they_end():
    first, last = "<p>One of the paragraphs here</p>", "<p>Two of the paragraphs here</p>"
    one, two = "One of the paragraphs here", "Two of the paragraphs here"
    cases = {
        "<svg-icon name='x'></svg-icon>": f"{one} {two}",
        "<template-card>some more words of it</template-card>": f"{one} some more words of it {two}",
        "<svg viewBox='0 0 1 1' class=\"a/b > c\" />": f"{one} {two}",
        "<svg/><svg a=b><path d='m 0'/><text>no</text></svg>": f"{one} {two}",
        "<script src=x>'no' words of it</script><SVG><title>no</title></SVG>": f"{one} {two}",
    }
    for between, text in cases.items():
        assert extraction.main_text(first + between + last, extraction.Weights()) == text, between


def test_content_under_names_of_furniture():
    page = "<article><p>{0}</p>{1}<p>{0}</p></article><div class=related>{0}</div>"
    words = "some words of the article itself"
    kept = "<figure><img src=x><figcaption>a caption</figcaption></figure>", "<section id='discussion'>a discussion</section>", "<div class='copyright notice'>a notice</div>", "<p class=related>a paper</p>"
    for inner in kept:
        text = " ".join([words, *re.sub(r"<[^>]*>", " ", inner).split(), words])
        assert extraction.main_text(page.format(words, inner), extraction.Weights()) == text, inner
    weights = extraction.learn([page.format(words, "")] * 10)
    assert extraction.main_text(page.format(words, "<div class=related>elsewhere</div>"), weights) == f"{words} {words}"
    for inner in ("<div class='cookie notice'>no</div>", "<section id=comments>no</section>", "<div class='ad related'>no</div>", "<video>no</video>"):
        assert extraction.main_text(page.format(words, inner), extraction.Weights()) == f"{words} {words}", inner


def test_query_and_edge_rows(spark, sf_small):
    rows = registry.op6_html_extraction(spark, sf_small).collect()
    pages = {r.page_id: r for r in registry.table(spark, sf_small, "pages").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        inner = re.sub(r"</?b>", "", re.sub(r"<(?!/?b>)[^>]*>", " ", inner))
        assert r.text == " ".join(html.unescape(inner).split()) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url
    ddl = "page_id bigint, url string, html string, text string, n_chars bigint"
    odd = spark.createDataFrame([(None, None, None, "x", 1), (1, "u", "", "x", 1), (2, "u", "<p>some words here", "x", 1)] * 2, ddl)
    got = extraction.extract(odd, keep=["page_id"]).collect()
    assert sorted(map(repr, got)) == sorted(["Row(page_id=None, text='', n_chars=0)", "Row(page_id=1, text='', n_chars=0)", "Row(page_id=2, text='some words here', n_chars=15)"] * 2)
    assert extraction.extract(odd.limit(0), keep=["page_id"]).collect() == []


def both_weights():
    given = "<body><header>Site name</header><nav><ul><li>Menu</ul></nav><article><h1>One title</h1><p>Some words of it.</article><div class=sidebar>Aside</div><div class=banner>Buy</div><footer>Nobody</footer></body>"
    return extraction.Weights(), extraction.learn([given] * 10)


def test_parts_of_class_names_lose_no_article():
    body = "<h1>A long title</h1><p>Some words of the article itself, and some more of them.</p><p>Last words of it.</p>"
    text = "A long title Some words of the article itself, and some more of them. Last words of it."
    pages = [
        f"<article><p class='ad-hoc'>{text}</p></article>",
        f"<div class='has-sidebar content'>{body}</div>",
        f"<div class='page page-with-nav'>{body}</div><footer>Nobody</footer>",
        body.replace("<h1>", "<h1 class='banner-title'>"),
        f"<div id=non-menu_page class='no-comments layout-sidebar-right'>{body}</div>",
        f"<div class=sidebar><article>{body}</article></div>",  # a wrapper, whatever its name
        f"<form action=x><nav>Menu words</nav>{body}</form>",
        f"<div class='widget box'>{body}</div><div class='site-footer'>Nobody</div>",
        f"<nav>Menu</nav><div class=banner><p>{text}</p></div>",  # nearly all words of the page
    ]
    for w in both_weights():
        for page in pages:
            assert extraction.main_text(f"<html><body>{page}</body></html>", w) == text, page


def test_whole_names_and_compounds_are_left_out():
    text = "Some words of the article itself, and some more of them. Last words of it."
    out = ["<div class='x ad'>", "<div id=main-nav>", "<div class=site-footer>", "<ul class='menu_list'>", "<div class=cookie-notice>", "<div role=banner>", "<div class=ad_box-2>", "<div class='comment-list'>"]
    for w in both_weights():
        for tag in out:
            name = tag[1:].split()[0]
            page = f"<body><p>Some words of the article itself, and some more of them.</p>{tag}<p>Other words here</p></{name}><p>Last words of it.</p></body>"
            assert extraction.main_text(page, w) == text, page
        comments = f"<body><p>{text}</p><div class=comments>{'<p>I do not think so at all</p>' * 200}</div></body>"
        assert extraction.main_text(comments, w) == text


def test_headers_of_the_site_go_those_of_the_article_stay():
    text = "A title Some words of the article itself, and some more of them."
    body = "<p>Some words of the article itself, and some more of them.</p>"
    for w in both_weights():
        for header in ("<header>{}</header>", "<div class=header>{}</div>", "<div id=header>{}</div>", "<div class='site-header'>{}</div>"):
            site = header.format("<h1>Site name</h1> <a>Log in</a>")
            for page in (f"{site}<h1>A title</h1>{body}", f"{site}<article><h1>A title</h1>{body}</article>", f"{site}<article>{header.format('<h1>A title</h1>')}{body}</article>", f"{site}<div class=content>{header.format('<h1>A title</h1>')}{body}</div>"):
                assert extraction.main_text(f"<body>{page}</body>", w) == text, page


def test_unclosed_tags_take_linear_time():
    import time

    pages = ["<div>" * 20_000 + "</p>" * 20_000 + "some words", "<div class=ad>" * 20_000 + "words", "<p class=notice>" * 20_000 + "</div>" * 5000 + "words", "<div><b>" * 20_000 + "</i></b>" * 20_000]
    for page in pages:
        start = time.process_time()
        extraction.main_text(page, extraction.Weights())
        assert time.process_time() - start < 1.5
