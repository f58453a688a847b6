import html
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from suturestar.llm import html_text as h


def _article(page):
    """The article of the test pages by plain pattern matching: headings and paragraphs."""
    inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", inside).replace("<br>", " "))
    return "\n\n".join(t for t in (" ".join(html.unescape(p).split()) for p in parts) if t)


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").collect()]


@pytest.fixture(scope="module")
def model(pages):
    return h.train(*h.lesson(pages[:120]))


def test_whole_main_text_of_pages_it_has_not_seen(model, pages):
    rest = pages[120:]
    wrong = [k for k, (got, page) in enumerate(zip(h.main_texts(model, rest), rest)) if got != _article(page)]
    assert len(wrong) <= len(rest) // 50


def test_held_out_blocks_in_other_surroundings(model, pages):
    xs, ys = h.lesson(pages[150:200])
    got = np.concatenate(h.probabilities(model, xs)) >= 0.5
    assert (got == (np.concatenate(ys) > 0)).mean() > 0.99


def test_unknown_page(model):
    page = (
        '<html><head><title>T</title><style>p{}</style></head><body><div class="cookie-notice"><p>We use cookies.</p></div>'
        "<main><h1>Heading &amp; more</h1><p>One  two\n three.</p><p>Four <i>five</i> six.<script>if(a<b){x='</p>'}</script></p></main>"
        '<aside>elsewhere</aside><form><label>Name</label></form><section id="comments"><p>Nice post, thanks.</p></section><footer>x</footer>'
    )
    assert h.main_texts(model, [page]) == ["Heading & more\n\nOne two three.\n\nFour five six."]


def test_batches_do_not_change_labels(model, pages):
    xs = [h.vectors(h.blocks(p)) for p in pages[:40]]
    alone = np.concatenate([h.probabilities(model, [x])[0] for x in xs])
    assert np.allclose(alone, np.concatenate(h.probabilities(model, xs)), atol=1e-4)


def test_gradients():
    rng = np.random.default_rng(1)
    p = {k: v.astype(np.float64) for k, v in h._start().items()}
    x, mask = rng.normal(0, 1, (3, 5, h.SIZE)), np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], float)
    weight = rng.normal(0, 1, (3, 5, h.HIDDEN))
    for d in "fb":
        _, trace = h._pass(p, d, x, mask, True)
        grad = {k: np.zeros_like(v) for k, v in p.items()}
        h._back(p, d, x, weight * mask[:, :, None], trace, grad)
        value = lambda: float((h._pass(p, d, x, mask, False)[0] * weight * mask[:, :, None]).sum())  # noqa: B023, E731
        for name in (f"x{d}", f"h{d}", f"c{d}"):
            at = tuple(int(rng.integers(n)) for n in p[name].shape)
            p[name][at] += 1e-5
            up = value()
            p[name][at] -= 2e-5
            down = value()
            p[name][at] += 1e-5
            assert abs((up - down) / 2e-5 - grad[name][at]) < 1e-4


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>a<p>b", ["a", "b"]), ("plain", ["plain"]), ("", []), (None, []), ("a<!-- x <p> -->b", ["ab"]), ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]),
        ("x<br>y", ["x y"]), ("<script>never</script>t", ["t"]), ("<p>1 &lt; 2 &#233;</p>", ["1 < 2 é"]), ("<b>bo<p>ld</b>er", ["bo", "lder"]), ("<div><", ["<"]),
        ("<table><tr><td>a<td>b</table>", ["a", "b"]), ("<p title='a>b'>t</p>", ["t"]),
    ],
)
def test_blocks(page, want):
    assert [b.text for b in h.blocks(page)] == want


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<head><title>T</title><article><p>a</article>", ["a"]),
        ("<html><head><meta charset=x><title>the <div> tag</title><script>x='<div>'</script><noscript><p>n</p></noscript><p>a", ["a"]),
        ("<head><title>T</title>plain <p>a", ["plain", "a"]), ("<head><title>T</title></head>a", ["a"]), ("<head><title>T</title><body>a", ["a"]),
        ("<noscript>x<p>a</p>", ["x", "a"]), ("<p>a<svg><p>b<svg>c</svg>d", ["a", "bd"]), ("<p>a</p><object><param><p>b</p>", ["a", "b"]),
        ("<canvas>x<canvas>y</canvas>z</canvas>a", ["a"]), ("<p>a<svg/>b", ["ab"]), ("<p>a<script>x <!-- y</script> b<p>c <!-- z -->", ["a b", "c"]),
        ("<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p>", ["so x=1 holds"]),
        ("<p title=Bob's>First paragraph. Don't stop</p>", ["First paragraph. Don't stop"]), ("<p don't>a<p title=\"a>b\" class='c>d'>e", ["a", "e"]),
        ("<p title=\"open>a</p>", ["a"]), ("<a href=?q=\"x>a</a> \"b\"", ['a "b"']),
    ],
)
def test_no_text_is_lost_to_open_elements_and_quotes(page, want):
    assert [b.text for b in h.blocks(page)] == want


def test_tags_without_an_end_take_linear_time():
    h.blocks("<p>a</p>" + "<a " + 'x="1" ' * 5000)
    h.blocks("<svg><p>a" * 20000)


def test_odd_rows(spark):
    rows = [(1, "u", None, "old"), (2, None, "", "old"), (3, "u", "<body></body>", None), (None, "u", "<main><p>a</p></main>", "old"), (3, "u", "<body></body>", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = df.withColumn("text", h.extracted(df.html, h.fit(df))).collect()
    assert [r.text for r in got[:3]] == ["", "", ""] and len(got) == 5
    assert h.fit(df.limit(0)) is None and h.main_texts(None, ["<p>a<nav>b</nav>"]) == ["a\n\nb"]


def test_copies_and_pages_without_a_main_part_take_no_training_place(spark, monkeypatch):
    bare = spark.range(50).selectExpr("concat('<p>bare ', id, '</p>') AS html")
    first = bare.orderBy(F.xxhash64("html")).first().html
    taught = [f"<article><p>page {k}</p></article>" for k in range(3)]
    df = spark.createDataFrame([(x,) for x in [first] * 60 + taught * 4 + [None, ""]], "html string")
    seen = []
    monkeypatch.setattr(h, "lesson", lambda pages: seen.extend(pages) or ([], []))
    h.fit(df, limit=30)
    assert sorted(seen) == taught
