import re
import time
from html import unescape

from ledgerlens.llm import extraction
from ledgerlens.llm.markup import ARTICLE, MAIN, NAMED, OPEN, blocks
from tests.llm.helpers import SF

PAGES = "page_id bigint, url string, html string"


def texts(spark, rows, **more):
    return {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(rows, PAGES).repartition(3), **more).collect()}


def plain(page):
    """What stands in the article of the given pages, which are all made the same way."""
    inner = re.search(r"<article>(.*?)</article>", page, re.DOTALL)[1]
    return " ".join(unescape(re.sub(r"<(?!/?b>)[^>]*>", " \n ", inner).replace("<b>", "").replace("</b>", "")).split())


def test_given_pages(spark):
    for sf in (SF, SF.replace("0.001", "0.01")):
        pages = spark.read.parquet(f"{sf}/pages.parquet")
        got = extraction.extract(pages)
        assert got.columns == ["page_id", "url", "text", "n_chars"]
        want = {r.page_id: (r.url, plain(r.html), len(plain(r.html))) for r in pages.collect()}
        assert {r.page_id: (r.url, r.text, r.n_chars) for r in got.collect()} == want


def test_blocks():
    page = """<!doctype html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="has-sidebar">
    <header><h1>Site</h1></header><div id="mainNav">Home</div><script>if (a < b) "</p>"</script>
    <main><p>Intro&nbsp;text <b>bo</b>ld<br>new line</p><ARTICLE class='post'><header><h2>Head &lt;line&gt;</h2></header>
    <p title="a > b" class="lead">First <!-- <p>no</p> --> para &#8212; 5 < 6<p>Second<p class=notice>Cookies<p>Third
    <aside>Aside</aside><ul><li>One<li>Two</ul><form>Name <input><button>Go</button></form><div class="article-footer">Tags</div></article>
    <section id="comments"><article>A comment</article></section></main><footer>&copy; Site</footer><div hidden>Gone</div>
    <div style="display: none">Gone too</div><p>Left over</body></html><!-- never closed <p>x"""
    got = [(b.part, " ".join(b.words)) for b in blocks(page)]
    assert got == [(NAMED, "Site"), (NAMED, "Home"), (MAIN, "Intro text bold"), (MAIN, "new line"), (ARTICLE, "Head <line>"),
                   (ARTICLE, "First para — 5 < 6"), (ARTICLE, "Second"), (NAMED, "Cookies"), (ARTICLE, "Third"), (NAMED, "Aside"), (ARTICLE, "One"),
                   (ARTICLE, "Two"), (NAMED, "Name"), (NAMED, "Go"), (NAMED, "Tags"), (NAMED, "A comment"), (NAMED, "© Site"), (NAMED, "Gone"),
                   (NAMED, "Gone too"), (OPEN, "Left over")]


def test_odd_markup():
    def words(page):
        return [(b.part, " ".join(b.words)) for b in blocks(page)]

    assert words("a<b<c>d</c") == [(OPEN, "a"), (OPEN, "d")] and words("<") == [(OPEN, "<")] and words("x < y </ z> </") == [(OPEN, "x < y")]
    assert words('<p title="never closed>one</p><p>two') == [(OPEN, "one"), (OPEN, "two")]
    assert words("<script>var a = '<p>x</p>'") == [] and words("<SCRIPT>x</Script >y") == [(OPEN, "y")]
    assert words("<article><p>kept</div></span></p></main>too") == [(ARTICLE, "kept"), (ARTICLE, "too")]
    assert words("<nav><div>menu<main>text</main>") == [(NAMED, "menu"), (MAIN, "text")]
    assert words("<span hidden>a</span>b") == [(NAMED, "a"), (OPEN, "b")]
    assert words("&amp &notit; &#x41;&#0;") == [(OPEN, "& ¬it; A�")]


def test_time_is_linear():
    shapes = ['<a href="', "<!--", "<div>", "</div>", "<b><p>", "<", "</", "<a b='", '<a "x" ', "<svg/>", "<script>", "<p>x</b>", "&lt", "<a a=\"b\" c='d' e", "<li><li"]
    for shape in shapes:
        took = []
        for n in (20_000, 80_000):
            began = time.process_time()
            blocks(shape * n)
            took.append(time.process_time() - began)
        assert took[1] < 10 * took[0] + 0.2, (shape, took)


MENU = "<div><ul><li><a>Home</a><li><a>World news</a><li><a>Sport</a><li><a>About us</a><li><a>Contact</a></ul></div>"
LEGAL = "<div>All rights are reserved by the publisher of these pages and its heirs</div>"


def page(body):
    return f"<html><body>{MENU}<div>{body}</div>{LEGAL}</body></html>"


def test_runs_that_repeat_on_a_host_go(spark):
    rows = [(i, f"https://WWW.one.example/{i}", page(f"<h1>Headline {i}</h1><p>The text number {i} has words of its own {i * 7}")) for i in range(6)]
    got = texts(spark, rows)
    assert got == {i: f"Headline {i} The text number {i} has words of its own {i * 7}" for i in range(6)}
    # Another host, and copies of one page under many addresses: nothing repeats between different texts.
    rows = [(i, f"https://host{i}.example/", page(f"<p>Text {i}</p>")) for i in range(2)] + [(9 + i, f"http://copy.example/{i}", page("<p>Same</p>")) for i in range(4)]
    whole = "Home World news Sport About us Contact {} All rights are reserved by the publisher of these pages and its heirs"
    assert texts(spark, rows) == {0: whole.format("Text 0"), 1: whole.format("Text 1"), **{9 + i: whole.format("Same") for i in range(4)}}


def test_covered_words_go_and_unique_runs_stay(spark):
    line = "this page was made by the press office of the city"
    own = [" ".join(f"word{i}_{k} and" for k in range(9)) for i in range(3)]
    rows = [(i, "http://a.example/", f"<div>unique start {i}</div><div>{line} {own[i]}</div>") for i in range(3)]
    assert texts(spark, rows) == {i: f"unique start {i} {own[i]}" for i in range(3)}
    # Beyond half of a block the rest goes with it.
    rows = [(i, "http://a.example/", f"<div>unique start {i}</div><div>{line} at {i}:00</div>") for i in range(3)]
    assert texts(spark, rows) == {i: f"unique start {i}" for i in range(3)}


def plain_repeats(rows, least):
    """Every window of every page against every window of every other page."""
    windows = {i: extraction.page_windows(u, p, least) for i, u, p in rows}
    out = {}
    for i, (body, prints, marks) in windows.items():
        others = {w for b, own, _ in windows.values() if b != body for w in own}
        out[i] = {k for k, (w, m) in enumerate(zip(prints, marks)) if m and w in others}
    return out


def test_repeats_against_every_pair_of_pages(spark):
    given = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/pages.parquet").filter("page_id < 120").collect()
    # Without its names the page has open text only, and what it shares with others of its host must be found.
    rows = [(r.page_id, r.url, re.sub(r"</?(?:nav|article|footer)>|class=\"ad\"", "<div>", r.html)) for r in given]
    want = plain_repeats(rows, 8)
    assert sum(map(bool, want.values())) > 10
    got = texts(spark, rows)
    assert got == {i: extraction.main_text(p, want[i], 8) for i, _, p in rows}
    # A common host and a hot window change nothing.
    rows = [(i, "http://one.example/", p) for i, _, p in rows]
    want = plain_repeats(rows, 8)
    assert texts(spark, rows) == {i: extraction.main_text(p, want[i], 8) for i, _, p in rows}


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, "http://[bad", "<p>No host at all</p>"), (3, "http://a.example", "   "), (4, "http://a.example", "plain text"),
            (4, "http://a.example", "plain text"), (5, "x", "<article></article><div>Beside an empty article</div>"), (6, "x", "<p>" + "word " * 300_000)]
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], PAGES + ", a int, text int, print int").repartition(2)
    out = extraction.extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted(((r.page_id, r.text, r.n_chars) for r in out.collect()), key=str)
    long = " ".join(["word"] * 300_000)
    assert got == sorted([(1, "", 0), (2, "", 0), (None, "No host at all", 14), (3, "", 0), (4, "plain text", 10), (4, "plain text", 10),
                          (5, "Beside an empty article", 23), (6, long, len(long))], key=str)
    assert extraction.extract(df.filter("false")).count() == 0
