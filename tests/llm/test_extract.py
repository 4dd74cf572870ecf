import html
import re

import numpy as np
import pytest

from firstpour.llm import extract as e
from firstpour.llm import registry
from tests.conftest import SF
from tests.llm.helpers import edges

LINE = "There was the river and the stone, and nobody in the house had seen the light by then. It was late."
PARAGRAPHS = "".join(f"<p>Part {i}. {LINE}</p>" for i in range(3))
TEXT = [f"Part {i}. {LINE}" for i in range(3)]
PAGES = {
    "divs": (
        f"<body><div id=header><a href=/>Home</a> <a href=/x>News</a></div><div class='sidebar'><ul><li><a href=1>One</a></li></ul></div>"
        f"<div class='post-content'><h1>Title here</h1>{PARAGRAPHS}</div><div class=cookie-notice><p>We use cookies.</p></div><div id=footer>Copyright</div>",
        ["Title here", *TEXT],
    ),
    "inside": (
        f"<body><header><nav><a href=1>Menu</a></nav></header><main><article><header><h1>Big Title</h1></header>{PARAGRAPHS}<aside>Buy now</aside>"
        "<form><input><label>Mail</label><button>Go</button></form><section class='comments'><h2>Comments</h2><p>I like this.</p></section></article></main>"
        "<footer><p>Imprint.</p></footer>",
        ["Big Title", *TEXT],
    ),
    "unnamed": (
        f"<body><div><div><a href=1>A</a> | <a href=2>B</a></div><div><h1>Some title</h1>{PARAGRAPHS}</div><div><a href=4>Terms</a></div></div>",
        ["Some title", *TEXT],
    ),
    "markup": (
        "<nav>x</nav><article><p>Keep 1 < 2 &amp; this.<script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>a<br>b  <i>c</i>d &nbsp;e</article>",
        ["Keep 1 < 2 & this.", "a b cd e"],
    ),
    "none": ("<body><nav><a href=1>x</a></nav><footer>&copy; me</footer>", []),
}


@pytest.fixture(scope="module")
def trees(spark):
    return e.learn(spark.read.parquet(f"{SF}/pages.parquet"))


@pytest.mark.parametrize("name", PAGES)
def test_templates(trees, name):
    source, expected = PAGES[name]
    page = e.parse(source)
    assert e.main_text(page, e.decode(page, trees.probability(e.described(page)))).split("\n") == (expected or [""])


def test_query_by_brute_force(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in registry.op2_extract(spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages[row["page_id"]], re.S)[1]
        blocks = [re.sub(r"</?b>", "", x).replace("<br>", " ") for x in re.split(r"</?(?:h1|p)>", article)]
        blocks = [" ".join(html.unescape(b).split()) for b in blocks]
        assert row["text"] == "\n".join(b for b in blocks if b) and row["n_chars"] == len(row["text"])


def test_nothing_is_kept_inside_of_what_is_dropped():
    draw = np.random.default_rng(3)
    for source, _ in PAGES.values():
        page = e.parse(source)
        n = len(page.nodes)
        for _ in range(5):
            p = draw.random(n)
            kept = e.decode(page, p)
            assert all(kept[x.parent] for i, x in enumerate(page.nodes) if i and kept[i])

            def value(choice, p=p):
                return sum(np.log(p[i] if c else 1 - p[i]) for i, c in enumerate(choice))

            for i in range(n):  # no single change that keeps the rule is better
                other = [c != (i == k) for k, c in enumerate(kept)]
                if all(other[x.parent] for k, x in enumerate(page.nodes) if k and other[k]):
                    assert value(other) <= value(kept) + 1e-9


@pytest.mark.parametrize("start", ["<body class=x>", "", "Lone text. ", "<noscript><link></noscript><body>", "<noscript><meta><body>", "<bgsound src=x>"])
def test_head_without_an_end_tag(start):
    """As with one, but for what is in ``start`` itself."""
    head = "<!doctype html><html><head>\n<meta charset=utf-8><title>No</title><style>no</style><script>no</script><link rel=x>\n"
    page = e.parse(f"{head}{start}<main><article><h1>Title</h1>{PARAGRAPHS}</article></main>")
    assert [t for _, t, _ in page.runs] == [*["Lone text."] * ("Lone" in start), "Title", *TEXT]
    closed = e.parse(f"{head}</head><body><article><p>{LINE}</article>")
    assert [t for _, t, _ in closed.runs] == [LINE]
    hidden = e.parse(f"{head}<noscript><p>no</p></noscript><template><body><p>no</template></head><body><p>yes")
    assert [t for _, t, _ in hidden.runs] == ["yes"]


@pytest.mark.parametrize("count", [1, 63, 64, 500])
def test_place_among_siblings(count):
    rows = e.described(e.parse("<article>" + "<p>x</p>" * count + "</article>"))
    assert np.allclose(rows[-count:, e.FEATURES.index("place")], np.arange(1, count + 1) / count)


def test_boosting_learns_a_threshold_pair():
    draw = np.random.default_rng(5)
    x = draw.random((4000, 3)).astype(np.float32)
    y = ((x[:, 0] > 0.6) & (x[:, 1] < 0.5)).astype(float)
    assert ((e.Trees().fit(x[:3000], y[:3000]).probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97


def test_copies_of_a_page_train_once(spark):
    pages = spark.createDataFrame([(f"<p>{n % 6}</p>" if n % 7 else None,) for n in range(200)], "html string")
    picked = [r["html"] for r in e.sample(pages, "html", 5).collect()]
    assert len(picked) == len(set(picked)) == 5
    assert len(e.sample(pages, "html", 50).collect()) == 6


def test_edges(spark, trees):
    odd = ["<", "<p", "<p <b>x", "</p></div>", "<!-- open", "<script>never closed", "<a href='x>y", "<p>" * 3000 + "deep", "<div>" * 3000 + "x", "plain text"]
    pages = edges(spark, [(n, t) for n, t in enumerate([None, "", *odd, odd[0]])])
    rows = e.extract(pages, trees, source="text", into="main").collect()
    assert len(rows) == 13 and all(r["main"] is not None for r in rows)
    assert e.extract(pages, None, source="text", into="main").count() == 13
    assert e.learn(pages.limit(0), source="text") is None
    assert e.extract(pages.limit(0), trees, source="text", into="main").count() == 0
