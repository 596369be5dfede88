"""Page extraction: the reader, the decoding, and whole pages."""

import itertools

import numpy as np
import pytest

from strata.llm import html_extract as H
from strata.llm.common import table
from strata.llm.html_tree import Tree
from tests.conftest import SF_SMALL


def shown(page):
    tree = Tree(page)
    return H.main_text(tree, np.zeros(tree.size))  # nothing dropped


@pytest.mark.parametrize("page, text", [
    ("", ""), ("<", ""), ("a <b", "a"), ("x &lt y &amp;amp; &#233;&nbsp;z", "x < y &amp; é z"), ("<p>a<p>b", "a\n\nb"),
    ("<p>un<b>bo</b>ld \n\t x<br>y</p>", "unbold x y"), ("<div>a<p>b</div>c", "a\n\nb\n\nc"), ("<b><i>k</b>l</i>", "kl"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", "a\n\nb\n\nc"), ("<!-- <p>no</p> --><p>yes<!-- open", "yes"),
    ("<script>'<p>no</p>'</script><style>p{}</style><p>İyes", "İyes"), ("<script>never closed <p>x", ""),
    ("<p title='a>b'>t</p>", "t"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"), ("</p></div>a", "a"),
    ("<P CLASS=x>A</P><BR/><hr>B", "A\n\nB"), ("<textarea>t</textarea><select><option>o</select>z", "z"),
])
def test_reader(page, text):
    assert shown(page) == text


def test_deep_pages_are_read():
    assert shown("<div>" * 20_000 + "deep") == "deep"


def test_decoding_is_the_best_consistent_labelling():
    rng = np.random.default_rng(0)
    tree = Tree("<div><div><p>a</p><p>b</p></div><p>c</p></div><div><p>d</p></div>")
    n = tree.size
    for _ in range(200):
        odds = np.append(0.0, rng.normal(size=n - 1))
        best = max(sum(o for o, k in zip(odds, keep, strict=True) if k) for keep in itertools.product([False, True], repeat=n)
                   if keep[0] and all(not keep[e] or keep[tree.parent[e]] for e in range(1, n)))
        keep = H.consistent_labels(tree, odds)
        assert all(not keep[e] or keep[tree.parent[e]] for e in range(1, n))
        assert odds[keep].sum() == pytest.approx(best)


@pytest.fixture(scope="module")
def trees(spark):
    return H.learn(table(spark, SF_SMALL, "pages"), "page_id", "html")


def extracted(trees, page):
    tree = Tree(page)
    rows = H.judged(tree)
    odds = np.zeros(tree.size)
    odds[rows] = trees.log_odds(H.node_features(tree)[rows])
    return H.main_text(tree, odds)


def test_held_out_layouts(trees):
    """Words of made pages that the trees have not seen, drawn with another seed."""
    maker = H.PageMaker([f"Sentence number {k} says this, and that." for k in range(400)], seed=12345)
    hit = got = wanted = 0
    for _ in range(150):
        raw = maker.page()
        tree = Tree(raw)
        want = {w for _, t, _ in tree.texts if maker.MARK in t for w in t.replace(maker.MARK, "").split() if w.isdigit()}
        have = {w for w in extracted(trees, raw.replace(maker.MARK, "")).split() if w.isdigit()}
        hit, got, wanted = hit + len(want & have), got + len(have), wanted + len(want)
    assert hit / got >= 0.93 and hit / wanted >= 0.95


ARTICLE = "<h1>A title of the piece</h1><p>First part, with some words in it. And another one.</p><p>Second part &amp; its end.</p>"
TEXT = "A title of the piece\n\nFirst part, with some words in it. And another one.\n\nSecond part & its end."


@pytest.mark.parametrize("around", [
    "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav><article>{}</article><footer>&copy; us. All rights.</footer>",
    "<header><p>My site</p></header><div class='post-content'>{}</div><div class=sidebar><h3>Popular</h3><ul><li><a href=/x>one</a></ul></div>",
    "<div id=cookie-notice><p>We use cookies. Accept them.</p><button>OK</button></div><main>{}</main>",
    "<article>{}</article><section id=comments><h3>Comments</h3><div class=comment><p>I read this, and liked it a lot. Thanks.</p></div></section>",
    "<div class=ad>Buy one now, really.</div><article>{}</article><form><label>Name</label><input><button>Send</button></form>",
])
def test_page_parts_are_left_out(trees, around):
    assert extracted(trees, f"<html><body>{around.format(ARTICLE)}</body></html>") == TEXT


def test_given_pages_and_awkward_rows(spark):
    pages = table(spark, SF_SMALL, "pages")
    out = {r["page_id"]: r for r in H.extract(pages).collect()}
    assert len(out) == pages.count()
    right = 0
    for r in pages.collect():
        inside = r["html"].split("<article>")[1].split("</article>")[0]
        right += out[r["page_id"]]["text"] == shown(inside)
        assert out[r["page_id"]]["n_chars"] == len(out[r["page_id"]]["text"])
    assert right >= 0.97 * len(out)
    odd = spark.createDataFrame([(1, None, None, 1), (1, None, None, 1), (None, "u", "", 2), (3, "u", "<p", 3), (4, "u", "<p>" + "w " * 50_000, 4)],
                                "page_id long, url string, html string, n_chars int")
    got = H.extract(odd.unionByName(pages.selectExpr("page_id", "url", "html", "0 as n_chars"))).collect()
    assert len(got) == 5 + pages.count()
    assert [r["text"] for r in got if r["page_id"] is None] == [""]
    assert H.extract(odd.limit(0)).count() == 0


def test_bad_markup_takes_linear_time():
    import time

    from strata.llm.html_tree import Tree
    shapes = (lambda n: "<div>" * n + "</b>" * n + "x", lambda n: "<a '" * n, lambda n: "<b>" * n + "<div>" * n + "</p>" * n)
    for shape in shapes:
        took = []
        for n in (8_000, 16_000):
            start = time.process_time()
            Tree(shape(n))
            took.append(time.process_time() - start)
        assert took[1] < 3.5 * took[0] + 0.2


def test_a_long_tag_that_the_page_breaks_off_in_is_no_text():
    from strata.llm.html_tree import Tree
    for tail in ('<img src="data:' + "A" * 50_000, "<!-- " + "b" * 9_000, "<", "</", "</di", "<?x " + "c" * 5_000):
        assert "".join(t for _, t, _ in Tree("<p>one < two</p>rest " + tail).texts) == "one < tworest "
