import random

import pytest

from starloom.llm import extraction
from starloom.llm.common import workers_import
from tests.conftest import SF_SMALL


def table(spark, pages):
    workers_import(spark)
    return spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)


def texts(spark, pages):
    return {r.page_id: r.text for r in extraction.extract_text(table(spark, pages)).collect()}


@pytest.mark.parametrize(("html", "want"), [
    (None, ""), ("", ""), ("plain  text\n here", "plain text here"), ("<p>a<p>b", "a\nb"), ("<p><b>a<br><p>b</p>", "a\nb"),
    ("<p>a<br>b</p>", "a b"), ("<p>x &lt;b&gt; &amp;amp; &#233; &copy; &euro;</p>", "x <b> &amp; é © €"),
    ("<script>var t='</p>';</script><p>a</p><style>p{}</style>", "a"), ("<p>a</p><script>unclosed", "a"), ("<p>a<!-- b --> c</p><!-- open", "a c"),
    ("<div>a<div>b</div>c</div>", "a\nb\nc"), ("<ul><li>a<li>b</ul>", "a\nb"), ("<p title='a>b'>c</p>", "c"), ("<p title=\"open>c</p>", "c"),
    ("<table><tr><td>a</td><td>b</td></tr><tr><td>c</td></tr></table>", "a b\nc"), ("a < b <3 c", "a < b <3 c"),
    ("<head><title>t</title></head><body><p>a</p></body>", "a"), ("<p hidden>a</p><p style='display: none'>b</p><p>c</p>", "c"),
    ("<p>a</b></i></p></div>b", "a\nb"), ("<P>A</P><H1>B</H1>", "A\nB"), ("<p>a\xa0 \x0b b</p>", "a\xa0 b"), ("<textarea><p>a</p></textarea>b", "b"),
])
def test_blocks_of_one_page(html, want):
    assert extraction.main_text(html, frozenset()) == want


def page(n, body, noise):
    return (f"<!DOCTYPE html><html><head><title>t{n}</title><style>x</style></head><body><header class=top>Site name</header>"
            f"<nav><ul><li><a href=/>Home</a><li>About</ul></nav><div class='side-bar'>{noise}</div><div class=zq7>{noise}</div>"
            f"<article><h1>Title {n}</h1>{body}<form>Sign up<input></form><section class=comments><p>Reader {n}: nice</p></section>"
            f"<aside>Related</aside></article><div id='cookie-notice'>We use cookies</div><footer>&copy; {n}</footer></body></html>")


def test_noise_is_cut_and_articles_stay(spark):
    pages = [(i, f"http://a.org/{i}", page(i, f"<p>Para {i} one.</p><p>Para {i}\n two.<p>shared line", "Buy now")) for i in range(30)]
    pages += [(100 + i, "http://copies.org/x", page(7, "<p>same text</p>", "Buy")) for i in range(12)]
    pages += [(200, "http://single.org/", page(9, "<p>only</p>", "Rare")), (201, None, page(9, "<p>null url</p>", "Rare"))]
    got = texts(spark, pages)
    for i in range(30):
        assert got[i] == f"Title {i}\nPara {i} one.\nPara {i} two.\nshared line"
    assert {got[100 + i] for i in range(12)} == {"Title 7\nsame text"}
    assert (got[200], got[201]) == ("Title 9\nonly", "Title 9\nnull url")


def test_entropy_finds_noise_without_names_or_landmarks(spark):
    """No landmark and no telling names: only the style tree knows which branch repeats."""
    rng = random.Random(1)
    pages = []
    for i in range(40):
        body = "".join(f"<p>{' '.join(rng.choice('abcdefgh') * rng.randint(1, 8) for _ in range(9))}</p>" for _ in range(3))
        pages.append((i, "http://x.net/p", f"<body><div class=q1><p>Welcome to x</p></div><div class=q2>{body}</div><div class=q3>All rights</div></body>"))
    got = texts(spark, pages)
    for i, _, html in pages:
        assert got[i].count("\n") == 2 and "Welcome" not in got[i] and "rights" not in got[i]
        assert got[i].split("\n")[0] in html
    tree = {r.path: r.importance for r in extraction._importance(extraction.style_tree(table(spark, pages)), ["host"]).collect()}
    assert tree["/div.q2"] > 0.85 and tree["/div.q1"] < 0.05 and tree["/div.q3"] < 0.05 and tree["/div.q1"] < tree[""] < tree["/div.q2"]


def test_query_extracts_the_articles(spark):
    import html as references
    import re
    raw = spark.read.parquet(f"{SF_SMALL}/pages.parquet").toPandas().set_index("page_id")
    got = extraction.op2_html_style_tree(spark, SF_SMALL).collect()
    assert len(got) == len(raw)
    for r in got:
        article = re.search(r"<article>(.*)</article>", raw.html[r.page_id], re.S)[1]
        blocks = (re.sub(r"\s+", " ", references.unescape(re.sub("<[^>]+>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", article))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == raw.url[r.page_id]


def test_random_markup_never_crashes():
    rng = random.Random(2)
    bits = ["<", ">", "</", "p", "div", "<p>", "</p>", "<nav>", "<article>", "</article>", "'", '"', "<!--", "-->", "&", "&#x;", "a b", "<script>", "<td>", "<li", "=", "\n"]
    for _ in range(3000):
        html = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        text = extraction.main_text(html, frozenset({"/!nav"}))
        assert text == text.strip(" ") and "  " not in text


def test_repeats_and_empty_tables(spark):
    assert extraction.extract_text(table(spark, [])).count() == 0
    rows = [(1, "http://a/", "<p>x</p>")] * 3 + [(None, "no scheme", None), (2, "http://b/", "<p>" + "long " * 200_000)]
    got = sorted((r.page_id or 0, r.n_chars) for r in extraction.extract_text(table(spark, rows)).collect())
    assert got == [(0, 0), (1, 1), (1, 1), (1, 1), (2, 999_999)]


def test_copies_are_one_page(spark):
    """Articles in neutral containers that occur on two or on all pages of a host, and on many hosts."""
    def body(n):
        return f"<div class=q1><p>Welcome</p></div><div class=q2><p>Text {n} one</p><p>Text {n} two</p></div>"
    pages = [(i, f"http://twice.org/{i}", body(i // 2)) for i in range(20)]
    pages += [(100 + i, f"http://same.org/{i}", body("s")) for i in range(30)]
    pages += [(200 + i, f"http://mirror{i}.org/", body("m").replace("q2", "q7")) for i in range(12)]
    got = texts(spark, pages)
    assert all(got[i] == f"Text {i // 2} one\nText {i // 2} two" for i in range(20))
    assert all("Text s one\nText s two" in got[100 + i] for i in range(30))
    assert all("Text m one\nText m two" in got[200 + i] for i in range(12))


@pytest.mark.parametrize("landmark", ["article", "div role=main"])
def test_containers_in_copied_landmarks_stay(spark, landmark):
    """The pages differ by a line, the lists, tables and divisions of their landmark do not."""
    inner = "<ul><li>first<li>second</ul><table><tr><td>cell</td></tr></table><div class=k><p>deep</p></div>"
    pages = [(i, f"http://a.org/{i}", f"<{landmark}><p>Line {i}</p>{inner}<div class=comments>Nice</div></{landmark.split()[0]}>") for i in range(20)]
    got = texts(spark, pages)
    assert all(got[i] == f"Line {i}\nfirst\nsecond\ncell\ndeep" for i in range(20))


def test_names_that_text_has_too(spark):
    """Text that differs on every page stays under an ambiguous name, repeated text and plainly named noise go."""
    names = ["header class=entry-header", "section id=related-work", "div class=discussion", "div class=notice-text"]
    for outer in ("article", "div class=q"):
        tag = outer.split()[0]
        pages = [(i, f"http://a.org/{i}", f"<body><div class=search-box><p>Find it</p></div><{outer}>" + "".join(
            f"<{n}><h2>Own {k} of {i}</h2></{n.split()[0]}>" for k, n in enumerate(names))
            + f"<div class=share><p>Share this</p></div><p>Body {i}</p><div class=comments>Nice {i}</div></{tag}></body>") for i in range(12)]
        pages.append((99, "http://other.net/", "<div class=promo><p>Only here</p></div><p>Text</p>"))
        got = texts(spark, pages)
        assert all(got[i] == "\n".join([*(f"Own {k} of {i}" for k in range(4)), f"Body {i}"]) for i in range(12))
        assert got[99] == "Text"


@pytest.mark.parametrize(("body", "want"), [
    ("<div class='story'><p>Story {n} one</p><p>Story {n} two</p></div><aside><article>teaser {n}</article></aside>", "Story {n} one\nStory {n} two"),
    ("<div class='post'><p>Post {n}</p></div><div class='comments'><article id='c1'>reader {n}</article></div>", "Post {n}"),
    ("<div class='content'><h1>Head {n}</h1><p>lead {n}</p><main><p>main {n}</p></main></div>", "Head {n}\nlead {n}\nmain {n}"),
    ("<div class='content'><p data-hidden>Shown {n}</p><p hidden>not</p><p hidden=''>nor</p><p class='x'>end {n}</p></div>", "Shown {n}\nend {n}"),
])
def test_no_text_is_lost_beside_landmarks(spark, body, want):
    pages = [(i, f"http://a.org/{i}", f"<body><nav>Home</nav>{body.replace('{n}', str(i))}<footer>(c)</footer></body>") for i in range(20)]
    assert texts(spark, pages) == {i: want.replace("{n}", str(i)) for i in range(20)}


def test_importance_against_plain_entropies(spark):
    """Importance of each style path of a host by a plain loop over its pages."""
    import math
    r = random.Random(3)
    bodies = [f"<div class=a><p>{r.choice(['x', 'y', i])}</p>{'<ul class=u><li>z</ul>' if r.random() < .5 else ''}</div><div class=b><p>same</p></div>"
              for i in range(24)]
    tree = extraction.style_tree(table(spark, [(i, f"http://h/{i}", b) for i, b in enumerate(bodies)]))
    got = {row.path: row.importance for row in extraction._importance(tree, ["host"]).collect()}
    features = {}
    for b in bodies:
        blocks, shapes = extraction.parse(b)
        features.setdefault(tuple(sorted({t for _, _, t in blocks})), (blocks, shapes))   # pages with the same blocks are one
    pages = list(features.values())
    paths = {p for _, shapes in pages for p, _ in shapes}
    for path in paths:
        m = sum(any(p == path for p, _ in shapes) for _, shapes in pages)
        log_m = math.log(max(m, 2))

        def entropy(counts):
            return sum(c / m * math.log(m / c) for c in counts if c) / log_m
        shapes_of = [s for _, shapes in pages for p, s in set(shapes) if p == path]
        presentation = min(entropy([shapes_of.count(s) for s in set(shapes_of)]), 1)
        content, n = 0.0, 0
        for sub in {p for blocks, _ in pages for p, _, _ in blocks if p == path or p.startswith(path + "/")}:
            sub_m = max(sum(any(p == sub for p, _ in shapes) for _, shapes in pages), 2)
            own = [t for blocks, _ in pages for t in {t for p, _, t in blocks if p == sub}]
            distinct = set(own)
            content += max(len(distinct) - sum(math.log(own.count(t)) for t in distinct) / math.log(sub_m), 0)
            n += len(distinct)
        want = 0.1 * presentation + 0.9 * (content / n if n else 1)
        assert got[path] == pytest.approx(want), path
    assert len(paths) >= 3
