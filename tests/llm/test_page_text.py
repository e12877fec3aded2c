import random
import time

import pytest

from barrio.llm import page_text as P

CASES = [
    ("<p>a<p>b", "a\n\nb"), ("<ul><li>x<li>y</ul>", "x\n\ny"), ('<div class="ad">z</div>t', "t"),
    ("<article><header><h1>T</h1></header><p>x <i>y</i>z&nbsp;&amp; &lt;b&gt;</p><div class='comments'><p>c</p></div>"
     "</article><footer>f", "T\n\nx yz & <b>"),
    ('<p>one<!-- no --> two<br>three</p><script>if(a<b){"</p>"}</script>q', "one two three\n\nq"),
    ("a < b <foo", "a < b"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2\n\n3"), ("", ""), (None, ""),
    ("<nav><p>n</nav>m<p title='>'>k", "m\n\nk"),
    ("<main><aside>s</aside>m1<form><p>f</form>m2</main>open", "m1\n\nm2"),
    ("<p>x</P ><STYLE>p{}</STYLE>&eacute;&#233;&#xe9;&amp", "x\n\nééé&"), ("<h1>cut", "cut"),
    ("<body class='has-sidebar'><article><p>a</p></article><div id=sidebar>s</div>", "a"),
    ("<!-- open comment <p>x", ""), ("<p hidden>h</p><div role=navigation>n</div>t<textarea>q</textarea>", "t"),
]


CASES += [
    ("<main><h1>Title</h1><article><p>a</p></article></main><p>foot", "Title\n\na"),
    ("<main><header><h1>T</h1></header><p>a</main><article>b</article>x", "T\n\na\n\nb"),
    ('<article><section class="social-history"><p>kept</p></section><div id="notice-period">too</div>'
     '<div class="x social-links">gone</div><div class="cookie-notice">gone</div><p id=ads-2>gone</article>', "kept\n\ntoo"),
    ('<div class="main-nav">n</div><div class="sideways">s</div><ul class="comment-list"><li>c</ul>', "s"),
    ("<p title=\"a > b\">x<p title='<p>'>y", "x\n\ny"),
]


@pytest.mark.parametrize("page,text", CASES)
def test_one_page(page, text):
    assert P.main_text(P.page_lines(page or ""), set()) == text


def test_alignment_is_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 9))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        shared, rest = P.shared_lines(a, b), iter(b)
        assert len(shared) == table[-1][-1] and all(any(y == a[i] for y in rest) for i in sorted(shared))


def test_halved_alignment_is_as_long(monkeypatch):
    rng = random.Random(2)
    cases = [[[rng.choice("abcde") for _ in range(rng.randint(0, 40))] for _ in range(2)] for _ in range(200)]
    whole = [len(P.shared_lines(a, b)) for a, b in cases]
    monkeypatch.setattr(P, "TABLE", 4)
    for (a, b), n in zip(cases, whole):
        shared, rest = P.shared_lines(a, b), iter(b)
        assert len(shared) == n and all(any(y == a[i] for y in rest) for i in sorted(shared))


@pytest.mark.parametrize("html", [
    "<b>x</i>" * 130_000, "<li><td>" + "<b>" * 100_000 + "<li></li>" * 60_000, "<div>" * 200_000 + "x",
    "<p>" * 330_000, "<a " * 300_000 + '"', "<a '" * 250_000, "<p title=" * 110_000, "<article>" * 100_000 + "</main>" * 10_000,
    "&amp" * 250_000, "x" * 1_000_000, "<!--" * 250_000])
def test_a_megabyte_of_odd_html_is_read_in_linear_time(html):
    start = time.process_time()
    P.page_lines(html)
    assert time.process_time() - start < 8          # a second or so; a scan per tag takes minutes


@pytest.mark.parametrize("a,b", [(["x"] * 10_000, ["y"] + ["x"] * 9_000 + ["z"] + ["x"] * 500),
                                 (["x", "y"] * 5_000, ["y", "y", "x"] * 3_000),
                                 ([str(i) for i in range(9_000)], [str(i) for i in range(9_000, 0, -1)])])
def test_many_equal_lines_are_aligned_fast(a, b):
    start = time.process_time()
    shared = P.shared_lines(a, b)
    assert time.process_time() - start < 5 and len(shared) <= min(len(a), len(b))


PAGES = [(1, "http://h.com/a/1", "<p>Home<p>own one<p>Imprint"), (2, "http://h.com/a/2", "<p>Home<p>own two<p>Imprint"),
         (3, "http://h.com/b", "<p>Start<p>own three"), (4, "http://g.com/a/1", "<p>Home<p>other host<p>Imprint"),
         (5, "http://h.com/a/1", "<p>Home<p>own one<p>Imprint"), (5, "http://h.com/a/1", "<p>Home<p>own one<p>Imprint"),
         (6, None, "<p>Home<p>x"), (None, "http://h.com/a/3", None), (7, "http://h.com/a/4", ""),
         (8, "http://k.com/1", "<article><p>shared</p></article><p>Foot"),
         (9, "http://k.com/2", "<article><p>shared</p><p>more</p></article><p>Foot")]


def test_shared_lines_go_and_marked_articles_stay(spark):
    df = spark.createDataFrame([(*r, "c") for r in PAGES], "page_id long, url string, html string, text string")
    got = P.extracted(df).collect()
    assert sorted((r.page_id is None, r.page_id or 0, r.url or "") for r in got) == sorted(
        (p is None, p or 0, u or "") for p, u, _ in PAGES)
    texts = {r.page_id: r.text for r in got}
    assert texts[8] == "shared" and texts[9] == "shared\n\nmore" and texts[4] == "Home\n\nother host\n\nImprint"
    assert texts[None] == texts[7] == ""
    assert [texts[i] for i in (1, 2, 3, 5)] == ["own one", "own two", "Start\n\nown three", "own one"]


def test_large_host_over_many_tasks(spark):
    """Every page keeps its own line and loses the frame, wherever ranges are cut."""
    pages = [(i, f"http://h.com/{i:04}", f"<p>Top<p>own {i}<p>Bottom") for i in range(300)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = P.extracted(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((r.page_id, r.text) for r in got) == [(i, f"own {i}") for i in range(300)]


def test_empty_table(spark):
    assert P.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
