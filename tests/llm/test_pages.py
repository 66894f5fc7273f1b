import numpy as np
import pytest
from page_texts import PAGES as WRITTEN

from quarrylane.llm import html_extract, url_filter
from quarrylane.llm.dom import read

PAGES = "page_id bigint, url string, html string, text string, rule string"


@pytest.fixture(scope="module")
def pages_of(spark):
    return lambda rows: spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], PAGES)


@pytest.mark.parametrize(
    "url,host,path,rule,verdict",
    [
        ("https://WWW.Example.COM/en/1?x=1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("https://blog.example.com/en/1", "blog.example.com", "/en/1", "example.com/en/", "block"),
        ("http://example.com/EN/1", "example.com", "/EN/1", "com/", "allow"),
        ("http://notexample.com/en/porn", "notexample.com", "/en/porn", "com/", "allow"),
        ("http://a.example.net/es/x#y", "a.example.net", "/es/x", "net/es/", "block"),
        ("http://net/fr/", "net", "/fr/", "net/fr/", "block"),
        ("http://a.org/porn-site", "a.org", "/porn-site", None, "block"),
        ("http://a.org/pornography", "a.org", "/pornography", None, "allow"),
        ("http://a.org/casino/free", "a.org", "/casino/free", None, "block"),
        ("http://a.org/casino/casino", "a.org", "/casino/casino", None, "allow"),
        ("http://a.com", "a.com", "", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        ("http://x?y://z/w", "x", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
    ],
)
def test_url(pages_of, url, host, path, rule, verdict):
    (r,) = url_filter.judged(pages_of([(1, url, "")])).collect()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def test_url_odd_rows(pages_of):
    rows = [(None, None, None), (1, "http://a.org/" + "x" * 100_000, None), (1, "http://a.org/", ""), (1, "http://a.org/", "")]
    assert url_filter.judged(pages_of(rows)).count() == 4
    assert url_filter.judged(pages_of(rows).limit(0)).count() == 0
    (r,) = url_filter.judged(pages_of([(1, "http://a.org/porn", "")]), rules=(), strict=(), soft=()).collect()
    assert r.verdict == "allow" and r.rule is None


def test_weighted_vocabulary_from_a_table(spark, pages_of):
    terms = spark.createDataFrame([("Strict", 1.5), ("half", 0.5), ("third", 0.34), ("third", 0.1), (None, 1.0), ("none", 0.0), ("less", -1.0), (" third two ", 0.33), ("third3", 0.33)], "term string, weight double")
    known = url_filter.vocabulary_of(terms)
    assert known == {"strict": 1.5, "half": 0.5, "third": 0.34, "third two": 0.33, "third3": 0.33}
    urls = ["STRICT", "half", "half/half", "half/third", "half/third/third3", "third/third3/x-third two", "strictly", "none"]
    out = {r.page_id: (r.verdict, r.n_strict, r.n_soft) for r in url_filter.judged(pages_of([(k, f"http://a.org/{u}", "") for k, u in enumerate(urls)]), vocabulary=known).collect()}
    assert out == {0: ("block", 1, 0), 1: ("allow", 0, 1), 2: ("allow", 0, 1), 3: ("allow", 0, 2), 4: ("block", 0, 3), 5: ("block", 0, 3), 6: ("allow", 0, 0), 7: ("allow", 0, 0)}
    with pytest.raises(ValueError, match="at most"):
        url_filter.vocabulary_of(terms, 3)
    (r,) = url_filter.judged(pages_of([(1, "http://a.org/a/b/c", "")]), soft=("a", "b", "c"), soft_limit=3).collect()
    assert r.verdict == "block"


@pytest.fixture(scope="module")
def model():
    words = [f"wort{i} thing{i} über{i}" for i in range(60)]
    return html_extract.fit([f"<p>{' '.join(words)}</p>"])


ARTICLE = "<h1>The title &amp; more</h1><p>First <b>block</b>,\n with&nbsp;words and quite a few more of them, so that it reads like prose.</p><p><b>Unclosed words of a second paragraph.<br><p>The third paragraph has some more words in it.</p>"
WANT = "The title & more\nFirst block, with words and quite a few more of them, so that it reads like prose.\nUnclosed words of a second paragraph.\nThe third paragraph has some more words in it."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title><script>var a='</p><p>no';</script></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>Best</a></li></ul></nav><div class=ad>Buy this now.</div><article>{ARTICLE}</article><footer>&copy; all of it</footer></body></html>",
        f"<body><div id=header><p>Site name</p></div><div class='cookie-notice'><p>We use cookies.</p></div><div class=content>{ARTICLE}</div><div class=sidebar><h3>More</h3><ul><li><a href=x>Other story</a></li></ul></div><div id=comments><p>I disagree with all of this, really.</p></div>",
        f"<main><article>{ARTICLE}<!-- c --><form><label>Mail</label><input><button>Go</button></form><style>p{{}}</style></article></main><footer><p>Contact us.</p></footer>",
    ],
)
def test_layouts(model, page):
    assert html_extract.texts_of([page], model) == [WANT]


@pytest.mark.parametrize("name", WRITTEN)
def test_written_pages(model, name):
    page, want = WRITTEN[name]
    assert html_extract.texts_of([page], model) == [want]


@pytest.mark.parametrize("page,want", [("<p>One line only</p>", "One line only"), ("<body><h1>Title</h1><p>Short words.</p></body>", "Title\nShort words."), ("", "")])
def test_small_pages(model, page, want):
    assert html_extract.texts_of([page], model) == [want]


def test_held_out_layouts(model):
    rng, words = np.random.default_rng(77), [f"neu{i}" for i in range(500)]
    main = found = other = wrong = 0
    for _ in range(120):
        page = html_extract.layout(rng, words)
        kept = set(html_extract.texts_of([page], model)[0].split("\n"))
        for e, text in read(page)[1]:
            good = "data-main" in e.attributes or e.tag == "body"
            main, found = main + good, found + (good and text in kept)
            other, wrong = other + (not good), wrong + (not good and text in kept)
    assert found / main > 0.97 and wrong / other < 0.03


def test_no_contradiction(model):
    rng = np.random.default_rng(5)
    for _ in range(30):
        elements, _ = read(html_extract.layout(rng, ["a", "b"]))
        kept = html_extract.keep(elements, rng.normal(size=len(elements)))
        assert all(kept[e.parent.index] for e in elements if kept[e.index] and e.parent)


def _read(page):
    return "\n".join(t for _, t in read(page)[1])


@pytest.mark.parametrize(
    "page",
    [
        "<head><meta charset=x><title>t</title><style>a</style><h1>Title</h1><p>article",
        "<head><script>'<p>'</script><noscript><style>b</style></noscript><!-- c -->\n<body class=a><h1>Title</h1><p>article",
        "<head><title>t</title></body><h1>Title</h1><p>article",
        *(f"<div><{t}>left out<x>x</x></div><h1>Title</h1><p>article" for t in ("svg", "object", "noscript", "template", "select", "canvas", "audio", "video", "math")),
        "<div><canvas>left out</div><h1>Title</h1><p>article</p><canvas>left out</canvas>",
        "<div><svg><path d=1><h1>Title</h1><p>article",
        "<a href=x><svg><path></a><h1>Title</h1><p>article",
        "<p><video>left out<h1>Title</h1><p>article",
        "<object>a<object>b</object>left out</object><svg><foreignObject><p>left out</p></foreignObject></svg><h1>Title</h1><p>article<script>left out",
    ],
)
def test_elements_without_end_tags(page):
    assert _read(page).replace(" ", "\n").split() == ["Title", "article"]


@pytest.mark.parametrize(
    "page,want",
    [
        ('<p title="a""b>text</p>', "text"),
        ("<a title=it's>link</a><p class=it's>more</p>", "link more"),
        ('<p title="a > b" x=\'>\'>text</p>', "text"),
        ('<p ""><b "=\'>te</b>xt', "text"),
        ("<p a = 'x' b= \"y>\" c>text", "text"),
        ('<p title="never closed>text</p><p>more', "text more"),
    ],
)
def test_stray_quotes(page, want):
    assert _read(page).replace("\n", " ") == want


@pytest.mark.parametrize("unit", ['<a title="x ', "<a title='x ", '<a title="x>', "<a b=\"'>", "<p a", "<svg><p>", "<b ", "</", "<!", "x &amp; <", '="', "<li>a", "<object>", "<td>"])
def test_time_grows_with_the_page(unit):
    """Ten times the page takes some ten times as long, not a hundred times."""
    import time

    def seconds(n):
        began = time.process_time()
        read(unit * n)
        return time.process_time() - began

    assert seconds(3000) < 30 * max(seconds(300), 0.01)
    assert seconds(30_000) < 30 * max(seconds(3000), 0.01)


STACKS = (
    "<div>|</section>", "<b>|<div>x</div>", "<b>|<p>x</p>|</i>", "<div>|<svg></svg>", "<svg>|<g>|</x>|</g>", "<svg><foreignObject>|<g>|<b>x</b>", "<svg><p>|x|</svg>", "<b>|<svg></svg>", "<a>|<li>x|</a>", "<i><div>|<b>|</i>",
    "<head>|<noscript>|x", "<ul><li>|<b>|<li>", "<table><tr>|<td>|</tr>", "<x>|</y>|<canvas>", "<video>|<b>|<li>x",
)


@pytest.mark.parametrize("page", STACKS)
def test_deep_stacks_take_linear_time(page):
    """A megabyte of open elements, whatever asks about them, is read in seconds."""
    import time

    def seconds(n):
        began = time.process_time()
        read("".join(part * n for part in page.split("|")))
        return time.process_time() - began

    assert seconds(40_000) < 25 * max(seconds(4000), 0.02)


def test_attributes():
    (_, e), _ = read("<div class=\"a b\" ID='x&amp;y' data-x role=main>t")
    assert [e.attribute(k) for k in ("class", "id", "data-x", "role", "none")] == ["a b", "x&y", "", "main", ""]


def test_no_switch_by_size():
    elements, blocks = read("<div>" + "<p>words</p>" * 100)
    rows = html_extract.features(elements, blocks)
    assert [r[13] for r in rows[2:]] == [i / 100 for i in range(100)]
    assert _read("<p>article <img src=data:" + "x" * 10_000) == "article"


def test_odd_pages(pages_of):
    rows = [(None, None, None), (1, "u", ""), (1, "u", ""), (2, "u", "<p"), (3, "u", "plain text < 3"), (4, "u", "<div>" * 3000 + "deep"), (5, "u", "</p></div><li>x"), (6, "u", "<article><p>" + "long words. " * 20000)]
    out = html_extract.extracted(pages_of(rows)).collect()
    assert len(out) == len(rows) and all(r.n_chars == len(r.text) for r in out)
    assert html_extract.extracted(pages_of(rows).limit(0)).count() == 0
