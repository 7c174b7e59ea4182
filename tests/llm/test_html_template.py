import random

import pytest

from tests.conftest import SF0001
from usagelens.llm import html_template
from usagelens.llm.html_template import main_text

PAGES = [
    ("", ""), ("plain words", "plain words"), ("<p>a &amp; b<br>c</p> t <!-- no -->u", "a & b c\n\nt u"),
    ("<nav>x</nav><article><h1>T&eacute;</h1><p>  one\n two&nbsp;&#33; <b>bold<p>next</article><footer>f</footer>",
     "Té\n\none two ! bold\n\nnext"),
    ("<article>a<aside>no</aside><form>no</form><div class='ad x'>no</div><section id=comments><p>no</section>b</article>c", "a\n\nb"),
    ("<script>if (a<b) { x('</p>') }</script>z<style>p{}</style><!-- <p>no -->", "z"),
    ("<div class=\"cookie-notice\">no</div><div role='main'><p>yes</div><p>no", "yes"),
    ("a < b <p>c > d &am &lt;p&gt;", "a < b\n\nc > d &am <p>"), ("<a href=\"x> foo <p>bar", "foo\n\nbar"),
    ("<ul><li>1<li>2</ul><table><tr><td>3<td>4</table>", "1\n\n2\n\n3\n\n4"), ("<p>open <i>end", "open end"),
    ("<title>t</title><header>h</header><main>m</main>", "m"), ("<script>never closed <p>x", ""),
    ("<article>" + "<p>word</p>" * 5000 + "</article>", "\n\n".join(["word"] * 5000)),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_main_text(page, text):
    assert main_text(page) == text


WRAPPED = [
    ("<div class='layout sidebar-right'><article><p>a</article></div>", "a"),
    ("<div class='page no-header'><main><p>a</p><div class=ad>no</div></main></div><p>no", "a"),
    ("<form id=aspnetForm><nav>no</nav><article>a<form>no</form>b</article><footer>no</footer></form>", "a\n\nb"),
    ("<div role=main class=has-sidebar><p>a</div>", "a"),
    ("<main><h1>t</h1><div class='row has-sidebar'><article>a</article><aside><article>no</article></aside></div></main>",
     "t\n\na"),
    ("<article>a</article><div class=related-posts><article>no</article></div>", "a"),
    ("<div class='layout sidebar-left'><article>a</article><div class=sidebar><article>no</article></div></div>", "a"),
    ("<main><p>a</p><section id=comments><article>no</article></section></main>", "a"),
    ("<form><article>a</article></form><article>b</article><noscript><article>no</article></noscript>", "a\n\nb"),
]


@pytest.mark.parametrize("page,text", WRAPPED)
def test_wrappers_do_not_hide_the_article(page, text):
    assert main_text(page) == text


def test_unclosed_markup_is_read_in_linear_time():
    assert main_text("<a " * 100_000).startswith("<a")
    assert main_text("<" * 200_000 + ">") == "<" * 200_000 + ">"


def page(i, cookie):
    return (f"<html><body><div class=top>{cookie}</div><div class=text><p>Words {i} of page</p><p>{i * 7} more</p></div>"
            f"<div class=low>All rights reserved</div></body></html>")


def test_template_text_of_a_host_goes(spark):
    rows = [(i, f"http://a.org/{i}", page(i, "We like biscuits")) for i in range(8)]
    rows += [(20 + i, f"http://b.org/{i}", page(i, f"Top {i}")) for i in range(3)]         # too few pages
    rows += [(30 + i, f"http://c.org/{i}", page(1, "We like biscuits")) for i in range(9)]  # copies: nothing varies
    rows += [(40, None, page(1, "x")), (41, "http://a.org/9", None), (None, "http://a.org/8", page(50, "We like biscuits"))]
    rows += [(42 + i, "http://d.org/", f"<nav>{i}</nav><p>{i}<article><p>same article</article>") for i in range(6)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: (r.text, r.n_chars) for r in html_template.extract(df.withColumn("text", df.url)).collect()}
    assert got[3][0] == "Words 3 of page\n\n21 more"
    assert got[None][0] == "Words 50 of page\n\n350 more"
    assert got[21][0] == "Top 1\n\nWords 1 of page\n\n7 more\n\nAll rights reserved"
    assert got[30][0] == "We like biscuits\n\nWords 1 of page\n\n7 more\n\nAll rights reserved"
    assert got[41] == ("", 0) and got[45][0] == "same article" and got[40][1] == len(got[40][0])
    assert len(got) == len(rows)


def test_copies_are_not_a_template(spark):
    def copy(i):
        return (f"<nav><a>{i}</a></nav><div class=count>Page {i}</div><div class=content><h1>Same title</h1>same words here"
                f"<p>One article on many pages</p></div><div class=low>All rights reserved</div>")
    rows = [(i, f"http://e.org/{i}", copy(i)) for i in range(9)]                                   # copies alone
    rows += [(20 + i, f"http://f.org/{i}", copy(i)) for i in range(9)]                             # beside other pages
    rows += [(40 + i, f"http://f.org/x{i}", page(i, "We like biscuits")) for i in range(9)]
    got = {r.page_id: r.text for r in html_template.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    whole = "Same title\n\nsame words here\n\nOne article on many pages"
    assert got[3] == f"Page 3\n\n{whole}\n\nAll rights reserved"
    assert got[23].startswith(f"Page 3\n\n{whole}") and got[43] == "Words 3 of page\n\n21 more"


BOX = "<article><h1>Title {i}</h1><p>Share this story</p><p>Words {i} of an article</p></article>"


def test_template_text_inside_an_article_goes(spark):
    """The result differs from what names alone give."""
    rows = [(i, f"http://g.org/{i}", BOX.format(i=i)) for i in range(8)]
    rows += [(20 + i, f"http://h.org/{i}", BOX.format(i=i)) for i in range(8)]
    rows += [(40, "http://h.org/x", "<article><p>Another one</article>")]  # so it is not on every page of h.org
    got = {r.page_id: (r.text, r.n_blocks, r.n_template) for r in html_template.extract(
        spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert main_text(BOX.format(i=3)) == "Title 3\n\nShare this story\n\nWords 3 of an article"
    assert got[3] == ("Title 3\n\nWords 3 of an article", 3, 1)
    assert got[23] == ("Title 3\n\nShare this story\n\nWords 3 of an article", 3, 0) and got[40][0] == "Another one"


def test_titles_and_words_of_an_article_stay(spark):
    assert main_text("<article><header><h1>T</h1></header><p>a</article>") == "T\n\na"
    assert main_text("<article><section class='related work'>r</section><p>a</article>") == "r\n\na"
    assert main_text("<article><section class=related>r</section><div class='notice'>n</div><p>a</article>") == "a"
    assert main_text("<header>h</header><article><div class='header intro'>i</div><p>a</article>") == "i\n\na"


def brute(pages, min_pages):
    """{(page, path, t): everywhere} of (page, host, html), by comparing whole vectors and sequences."""
    parsed = {n: (of, *html_template.parse(source or "")) for n, of, source in pages}
    out = {}
    for of in {h for h, *_ in parsed.values() if h}:
        own = {n: x for n, x in parsed.items() if x[0] == of}
        vectors = {}
        for n, (_, _, tokens, _) in own.items():
            for path, t, count, *_ in tokens:
                vectors.setdefault((path, t), {})[n] = count
        votes = {k: len({own[n][3] for n in v} - {None}) for k, v in vectors.items()}
        classes = {}
        for k, v in vectors.items():
            if votes[k] >= min_pages:
                classes.setdefault(tuple(sorted(v.items())), []).append(k)
        classes = {v: ks for v, ks in classes.items() if len(ks) > 1}
        while True:
            opens = {path: len(v) for v, ks in classes.items() for path, t in ks if t == 0}
            loose = []
            for v, ks in classes.items():
                parts = [p.split("/") for p, _ in ks]
                around = parts[0][:-1] if all(p == parts[0] for p in parts) else [
                    x[0] for i, x in enumerate(zip(*parts)) if all(len({*y}) == 1 for y in list(zip(*parts))[:i + 1])]
                if "/".join(around) and opens.get("/".join(around), 0) < len(v):
                    loose.append(v)
            if not loose:
                break
            for v in loose:
                del classes[v]
        for v, ks in classes.items():
            orders = {tuple(k[:2] for k in sorted(own[n][2], key=lambda k: k[3]) if k[:2] in ks) for n, _ in v}
            if len(orders) == 1:
                everywhere = v == tuple((n, 1) for n in sorted(own))
                out |= {(n, *k): everywhere for k in ks if k[1] for n, _ in v}
    return out


def random_page(rng, i):
    bits = [f"<div class=top>{rng.choice(['Hello', 'Hello', 'Hi'])}</div>", f"<nav><a>{i}</a><p>{rng.choice('ab')}</nav>",
            "<section class=tools><p>Print</p><p>Save</p></section>" * rng.choice([0, 1, 1]),
            f"<div class=box{i}><p>boxed</p><b>{rng.randrange(3)}</b></div>" * rng.choice([0, 1]),
            f"<article><h1>Title {i}</h1><p>Said before</p><p>Long words {i % 17} of this page {rng.choice(['', 'more'])}</article>",
            "<footer>All rights <p>reserved</footer>"]
    if rng.random() < 0.2:
        bits[0], bits[-1] = bits[-1], bits[0]
    return "<html><body>" + "".join(bits) + "</body></html>"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_deduction_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(i, f"http://h{i % 3 if seed < 3 else 0}.org/{i}", random_page(rng, i) if seed > 1 or i % 5 else page(i, "c"))
            for i in range(40)]
    parsed = html_template.parsed_pages(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3))
    found = html_template.template_texts(html_template.page_tokens(parsed), 4)
    ids = {r.page: (r.page_id, r.host) for r in parsed.collect()}
    got = {(ids[r.page][0], r.path, r.t): r.everywhere for r in found.collect()}
    hosts = dict(ids.values())
    assert got == brute([(i, hosts[i], source) for i, _, source in rows], 4) and got


def test_loose_classes_are_no_template(spark):
    rows = [("h", p, t, v, n) for p, t, v, n in [
        ("", 0, 1, 9), ("/body", 0, 1, 9), ("/body/x/p", 0, 2, 6), ("/body/x/p", 5, 2, 6), ("/body/x/p/q", 0, 3, 6),
        ("/body/x/p/q", 7, 3, 6), ("/body/y", 0, 4, 6), ("/body/y", 8, 4, 6)]]
    valid = spark.createDataFrame(rows, "host string, path string, t long, vector long, n_pages long")
    left = {(r.path, r.t) for r in html_template.nested(valid).collect()}
    assert left == {("", 0), ("/body", 0), ("/body/y", 0), ("/body/y", 8)}  # /body/x opens in no class, so what it holds falls


def test_extract_is_main_text_with_the_template(spark):
    rng = random.Random(9)
    rows = [(i, f"http://h{i % 2}.org/{i}", html) for i, html in enumerate(
        [random_page(rng, i) for i in range(30)] + [p for p, _ in PAGES] + [p for p, _ in WRAPPED])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    parsed = html_template.parsed_pages(df)
    gone = {}
    ids = {r.page: r.page_id for r in parsed.collect()}
    for r in html_template.template_texts(html_template.page_tokens(parsed)).collect():
        gone.setdefault(ids[r.page], {})[r.path, r.t] = r.everywhere
    for r in html_template.extract(df).collect():
        source = rows[r.page_id][2]
        inside = {b[:2]: bool(b[3]) for b in html_template.parse(source)[0]}
        own = frozenset(k for k, everywhere in gone.get(r.page_id, {}).items() if everywhere or not inside.get(k))
        assert (r.text, r.n_chars) == (main_text(source, own), len(main_text(source, own)))


def test_given_pages_and_no_pages(spark):
    df = spark.read.parquet(f"{SF0001}/pages.parquet")
    want = {r.page_id: main_text(r.html) for r in df.collect()}
    assert {r.page_id: r.text for r in html_template.extract(df).collect()} == want
    assert html_template.extract(df.limit(0)).count() == 0
