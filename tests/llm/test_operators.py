import math
import random
import zlib

import numpy as np
import pytest

from kestrel.llm import clusters, html, knn, langid, licenses, linededup, minhash, mixing, packing, quality, urls
from kestrel.llm.components import connected_components
from kestrel.llm.text import hashes, spans, utf8
from tests.llm import brute

SMALL = "/root/testdata/sf0.001"
DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def frame(spark, rows, schema="doc_id bigint, text string"):
    return spark.createDataFrame(rows, schema)


def prose(n, seed, vocabulary=400):
    r = random.Random(seed)
    return ["".join(chr(97 + int(c)) for c in str(1000 + int(r.random() ** 2 * vocabulary))) for _ in range(n)]


EDGE = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE two"), (6, "x" * 70_000 + " y"),
        (7, "word " * 30_000), (None, "a null id with some words"), (8, "é ü ñ é ü ñ é ü ñ")]


# ------------------------------------------------------------------ helpers
def test_word_hashes_equal_words_equal_hashes():
    import pyarrow as pa
    texts = ["Foo bar", None, "", "bar\tfoo É", "foo" * 500_000 + " foo"]
    data, offsets = utf8(pa.array(texts))
    s, e = spans(data, offsets)
    h = hashes(data, s, e)
    names = [w for t in texts for w in brute.words(t, lower=True)]
    assert len(names) == len(h)
    assert len(set(zip(names, h.tolist()))) == len(set(names)) == len(set(h.tolist()))


@pytest.mark.parametrize("shape", ["chain", "star", "random", "empty"])
def test_connected_components(spark, shape):
    r = random.Random(5)
    pairs = {"chain": [(i, i + 1) for i in range(40)], "star": [(0, i) for i in range(1, 60)], "empty": [],
             "random": [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(3, 3), (None, 4)]}[shape]
    got = {x.node: x.component for x in connected_components(frame(spark, pairs, "a bigint, b bigint")).collect()}
    clean = [(a, b) for a, b in pairs if a is not None and a != b]
    assert got == brute.components({x for p in clean for x in p}, clean)


# ------------------------------------------------------------------ 1 URLs
def link(url):
    return f'<html><head><link rel="canonical" href="{url}"></head></html>'


def test_urls_rules_and_aliases(spark):
    refresh = '<meta http-equiv="refresh" content="0; url=http://c.org/x">'
    rows = [
        (1, "http://a.example.com/en/x", None), (2, "https://www.example.com/en/x?q=1", ""), (3, "http://B.net/es/1#t", None),
        (4, "http://b.net/es", None), (5, "http://a.org/1", link("http://b.org/2")), (6, "http://b.org/2", refresh),
        (7, "http://c.org/x/", link("http://d.net/fr/9")), (8, "http://e.org/1", link("http://b.org/2/")),
        (9, "http://f.org/1", link("http://g.com/ok")), (10, "http://h.org/1", link("/en/2")), (11, None, None),
        (12, "no scheme", "x"), (13, "http://f.org/1", link("http://x.net/fr/1")), (14, "http://com", None),
        (5, "http://a.org/1", link("http://b.org/2")),
    ]
    df = frame(spark, rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS verdict", "2 AS host")
    got = {}
    for r in urls.url_verdicts(df).collect():
        got[r.page_id] = (r.host, r.path, r.rule, r.verdict)
    assert got[1] == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert got[2] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[3] == ("b.net", "/es/1", "net/es/", "block")
    assert got[4] == ("b.net", "/es", None, "allow")
    # a -> b -> c -> blocked d.net/fr; e joins through b: all are aliases of a blocked page.
    assert all(got[k][2] is None and got[k][3] == "block" for k in (5, 6, 7, 8))
    # f links to an allowed and to a blocked page: the explicit allow wins.
    assert got[9][3] == got[13][3] == "allow"
    assert got[11] == ("", "", None, "allow") and got[12] == ("", "", None, "allow")
    assert got[14] == ("com", "", None, "allow")
    assert urls.url_verdicts(df).count() == len(rows)
    assert urls.url_verdicts(df.limit(0)).count() == 0


def test_urls_links_as_a_browser_reads_them(spark):
    """References, dot segments, base, comments and scripts; operator and SQL agree on every page."""
    import duckdb
    from kestrel.llm.sql import ORACLE
    far = link("http://x.net/fr/9")
    pages = {
        "http://a.org/1": (link("http://b.org/p?x=1&amp;y=2"), "block"), "http://b.org/p?x=1&y=2": (far, "block"),
        "http://c.org/1": (link("http:&#47;&#x2f;x.net&sol;fr&#0047;1"), "block"), "http://c.org/2": (link("&#0;&#xD800;&#9999999;&zz;&"), "allow"),
        "http://net/de/p": (link("../es/p"), "block"), "http://net/de/q": (link("../../../es/./q"), "block"),
        "http://d.net/a": (link("http://d.net/de/../es/.."), "allow"), "http://d.net/b": (link("/es/x/.."), "block"),
        "http://e.org/1": ('<base target=x><base href="http://x.net/fr/deep/"><link rel=canonical href=page>', "block"),
        "http://e.net/1": ('<base href="fr/"><link rel=canonical href="?q=1">', "block"),
        "http://f.org/1": ("<!-- " + far + " -->", "allow"), "http://f.org/2": ("<script>var s = '" + far + "'</SCRIPT >", "allow"),
        "http://f.org/3": ("<!-- " + far, "allow"), "http://f.org/4": ("<noscript>" + far + "</noscript>", "allow"),
        "http://f.org/5": ("<!-- x -->" + far + "<!-- y -->", "block"),
        "http://g.org/1": ("<link data-rel=canonical href=http://x.net/fr/1><link rel=noncanonical href=http://x.net/fr/1>", "allow"),
        "http://g.org/2": ("<LINK HREF='http://x.net/fr/1' REL='alternate Canonical'>", "block"),
        "http://g.org/3": ("<link rel=canonical data-href='http://x.net/fr/1' href=' http://x.net\n/fr/1 '/>", "block"),
        "http://h.org/1": ('<meta content="5;URL=\'http://x.net/fr/1\'" http-equiv=Refresh>', "block"),
        "http://h.org/2": ("<meta http-equiv=refresh content=5>", "allow"), "http://h.org/3": (link("mailto:a@x.net/fr/"), "allow"),
        "http://h.org/4": (link("#top") + link("?u=http://x.net/fr/1") + link(""), "allow"),
        "http://i.org/a/../b/./c": (None, "block"), "http://i.org/b/c": (far, "block"),
        "http://j.org/1": ("<link rel=canonical " + "x " * 50_000, "allow"), "http://j.org/2": ("<link " * 20_000 + "<!--" * 20_000 + far, "allow"),
        "x": (far, "allow"),
    }
    rows = [(i, url, html) for i, (url, (html, _)) in enumerate(pages.items())]
    got = urls.url_verdicts(frame(spark, rows, "page_id bigint, url string, html string")).toPandas()
    assert dict(zip(got.url, got.verdict)) == {url: verdict for url, (_, verdict) in pages.items()}
    with duckdb.connect() as db:
        db.execute("CREATE TABLE pages(page_id BIGINT, url VARCHAR, html VARCHAR)")
        db.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
        want = db.execute(ORACLE["op1_url_filter"]).df()
    columns = ["page_id", "url", "host", "path", "rule", "verdict", "alias"]
    key = lambda df: sorted(tuple(None if v != v else v for v in r) for r in df[columns].itertuples(index=False))
    assert key(got) == key(want)


def test_urls_all_edges_of_a_page(spark):
    refresh = '<meta http-equiv="refresh" content="0; url=http://x.net/fr/%d">'
    rows = [(1, "http://a.org/1", link("http://a.org/1") + refresh % 1), (2, "http://b.org/1", link("http://b.org/1") + link("/2")),
            (3, "http://b.org/2", refresh % 2), (4, "http://c.org/1", link("http://c.org/1"))]
    df = frame(spark, rows, "page_id bigint, url string, html string")
    assert {r.page_id: r.verdict for r in urls.url_verdicts(df).collect()} == {1: "block", 2: "block", 3: "block", 4: "allow"}


# ------------------------------------------------------------------ 2 HTML
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>x";</script></head><body>
<nav><ul><li><a href=/a>Home</a><li><a href=/b>About</a></ul></nav><div class="ad">Buy this now, it is a long advert.</div>
<article><h1>Head &amp; line</h1><p><b>First  paragraph with
 white space.<br><p>Second &eacute; one.</p><div class="comments"><p>A reader comment.</p></div><p>End.</p></article>
<aside>Side</aside><footer>&copy; foot</footer>"""


def test_html_article():
    assert html.main_text(PAGE) == "Head & line\nFirst paragraph with white space.\nSecond é one.\nEnd."


def test_html_without_article():
    body = "".join(f"<p>{'A long sentence of the text. ' * 6}</p>" for _ in range(5))
    menu = "".join(f"<li><a href=/{i}>m{i}</a></li>" for i in range(30))
    text = html.main_text(f"<body><div><ul>{menu}</ul></div><div>{body}</div><div><ul>{menu}</ul></div></body>")
    assert text.count("\n") == 4 and "m1" not in text


@pytest.mark.parametrize("page,text", [(None, ""), ("", ""), ("<p>", ""), ("plain &lt;text&gt;", "plain <text>"),
                                       ("<article>" + "<div>" * 3000 + "deep", "deep"),
                                       ("<article><p>x</article>" * 2, "x"), ("<script>only", "")])
def test_html_edges(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("wrap", ['<div class="layout has-sidebar">%s</div>', '<div class="no-ads">%s</div>',
                                  '<div id="page-with-comments">%s</div>', '<form action="/x.aspx">%s</form>'])
@pytest.mark.parametrize("inner", ["<article><p>First part.</p><p>Second part.</p></article>",
                                   "<div><p>First part.</p><p>Second part.</p></div>"])
def test_html_layout_wrappers(wrap, inner):
    assert html.main_text(wrap % ('<div class="sidebar">Side.</div>' + inner)) == "First part.\nSecond part."


def test_html_labels_still_count():
    assert html.main_text('<div class="comments"><article><p>Me too, a long comment.</article></div><article>x</article>') == "x"
    assert html.main_text('<article><p class="notice">Note.<p>Text one.<div>Text two.</div></article>') == "Text one.\nText two."


@pytest.mark.parametrize("page,text", [
    ("<html><head><title>T</title><body><article><p>Text.</p></article></body>", "Text."),
    ("<html><head><meta charset=utf-8><title>T</title><article><p>Text.</p></article>", "Text."),
    ("<article><p>One.</p><button>Send<p>Two.</p></article>", "One.\nTwo."),
    ("<article><p>One.</p><select><option>a<option>b<p>Two.</p></article>", "One.\nTwo."),
    ("<article><p>One.<button>Send</button> More.</p></article>", "One. More."),
    ("<article><p>One.</p><section><h2>Comments</h2><p>Me too.</p><div><p>And I.</p></div></section></article>", "One."),
    ("<article><p>One.</p><section><h2>Comments on law</h2><p>Two.</p></section><p>Three.</p></article>",
     "One.\nComments on law\nTwo.\nThree."),
    ("<article><h2>Comments</h2><p>An article of that name.</p></article>", "Comments\nAn article of that name.")])
def test_html_left_out_end_tags_and_reader_comments(page, text):
    assert html.main_text(page) == text


def test_html_ratio_clusters_decide_inside_an_article():
    """A list of links between long paragraphs is no content; without the threshold it stays."""
    long = "A long sentence of the text with a <a href=/x>link</a> in it. " * 8
    links = "".join(f"<li><a href=/{i}>Read {i}</a></li>" for i in range(12))
    plain = "".join(f"<li>Step {i}</li>" for i in range(12))
    page = f"<article>{f'<p>{long}</p>' * 3}<ul>%s</ul><p>End.</p></article>"
    with_links, steps = html.main_text(page % links), html.main_text(page % plain)
    assert "Read 5" not in with_links and with_links.endswith("\nEnd.") and "in it." in with_links
    assert "Read 5" in html.main_text(page % links, share=0.0)
    assert "Step 5" in steps and steps.count("\n") == 15


def test_html_containers():
    assert html.main_text("<main><h1>Title</h1><p>Lead</p><article><p>Body text.</p></article></main>") == "Title\nLead\nBody text."
    parts = [f"Part {i} with some text." for i in range(3)]
    assert html.main_text("".join(f"<article><p>{x}</p></article>" for x in parts)) == "\n".join(parts)
    nested = "<article><p>Outer.</p><article><p>Inner one.</p></article><article><p>Inner two.</p></article></article>"
    assert html.main_text(nested) == "Outer.\nInner one.\nInner two."
    assert html.main_text(f"<article><p>{'Long text. ' * 20}</p></article><article><p>Teaser</p></article>").count("\n") == 0


def test_html_body_keeps_short_ends():
    long = "A long sentence of the text. " * 20
    menu = "".join(f"<li><a href=/{i}>m{i}</a></li>" for i in range(30))
    page = f"<body><ul>{menu}</ul><div><h1>Hi</h1><p>Lead.</p>" + f"<p>{long}</p>" * 4 + f"<p>End.</p></div><ul>{menu}</ul></body>"
    got = html.main_text(page).split("\n")
    assert got[:2] == ["Hi", "Lead."] and got[-1] == "End." and len(got) == 7


def test_html_frame(spark):
    rows = [(1, "u", PAGE), (2, None, None), (2, None, None), (3, "v", "<article><p>" + "long " * 100_000)]
    df = frame(spark, rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS text")
    got = html.extract(df).collect()
    assert sorted(r.page_id for r in got) == [1, 2, 2, 3]
    assert all(r.n_chars == len(r.text) for r in got)
    assert {r.page_id: r.n_chars for r in got}[3] == 499_999


def test_html_synthetic_articles(spark):
    """On generated pages the result is the article's own blocks."""
    import html as std
    import re
    for row in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        inner = re.search(r"<article>(.*)</article>", row.html, re.S).group(1)
        blocks = [re.sub(r"\s+", " ", std.unescape(re.sub(r"<[^>]+>", " ", b))).strip()
                  for b in re.split(r"</?(?:p|h1)\b[^>]*>", inner)]
        assert html.main_text(row.html) == "\n".join(b for b in blocks if b)


# ------------------------------------------------------------------ 3 near duplicates
def near_fixture():
    r = random.Random(3)
    docs, n = list(EDGE[:-2]) + [EDGE[-1]], 100
    for g in range(12):
        base = prose(60 + 20 * g, g)
        for _ in range(6):
            text = list(base)
            for _ in range(r.randrange(0, 8)):
                text[r.randrange(len(text))] = f"new{r.random()}"
            docs.append((n, " ".join(text)))
            n += 1
    return docs + [(n, docs[-1][1]), (n + 1, docs[-1][1].upper())]


def test_near_duplicates_match_brute_force(spark, documents):
    docs = near_fixture() + [(1000 + r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(spark, docs)).collect()}
    assert got == brute.near_duplicates(docs)


def test_near_duplicates_repeats_and_stage(spark):
    text = " ".join(prose(80, 1))
    rows = [(5, text, "en", "s", 1), (5, text, "en", "s", 1), (4, text + " tail", "en", "t", 2), (None, text, None, None, None),
            (9, None, None, None, None), (9, None, None, None, None), (None, "", None, None, 0)]
    df = frame(spark, rows, DOC).selectExpr("*", "1 AS component_id")
    got = minhash.near_duplicates(df).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.component_id or 0, r.kept) for r in got) == [
        (False, 4, 4, True), (False, 5, 4, False), (False, 5, 4, False), (False, 9, 9, True), (False, 9, 9, True),
        (True, 0, 0, True), (True, 0, 4, False)]
    kept = minhash.near_duplicate_stage(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [(False, 4), (False, 9), (False, 9), (True, 0)]
    twice = minhash.near_duplicate_stage(frame(spark, rows[:2], DOC)).collect()
    assert [r.doc_id for r in twice] == [5]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_near_duplicate_stage_keeps_unlinked_texts_of_one_id(spark):
    texts = [" ".join(prose(60, 50 + i, 5000)) for i in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1] + " tail"), (None, texts[1]), (7, texts[2]), (7, texts[3]),
            (7, texts[3]), (3, texts[4]), (None, texts[4]), (7, texts[5]), (8, texts[5]), (None, None), (None, None)]
    got = [(r.doc_id, r.text) for r in minhash.near_duplicate_stage(frame(spark, rows)).collect()]
    pair = [x for x in got if x[1] in (texts[1], texts[1] + " tail")]
    assert len(pair) == 1 and pair[0][0] is None
    want = [(None, texts[0]), (7, texts[2]), (7, texts[3]), (3, texts[4]), (7, texts[5]), (None, None), (None, None)]
    assert sorted((x for x in got if x not in pair), key=str) == sorted(want, key=str)


def test_min_max_estimates_jaccard():
    r = np.random.default_rng(0)
    a = r.integers(0, 2**63, 1000).astype(np.uint64)
    b = np.concatenate([a[:800], r.integers(0, 2**63, 200).astype(np.uint64)])
    sig = minhash.min_max(np.concatenate([a, b]), np.array([0, 1000, 2000]), 2000)
    assert abs((sig[0] == sig[1]).mean() - 800 / 1200) < 0.05


@pytest.mark.parametrize("blocks", [10**9, 300, 40])
def test_cluster_blocks(spark, blocks):
    """Blocks of any size give the same components."""
    import pyarrow as pa
    r = random.Random(1)
    base = list(range(40))
    sets = [sorted(set(base[:r.randrange(30, 41)]) | {r.randrange(1000) for _ in range(3)}) for _ in range(30)]
    rows = [(1, i, len(s), np.array(s, np.uint64).tobytes()) for i, s in enumerate(sets)]
    df = frame(spark, rows, "cluster bigint, node bigint, n bigint, set binary")
    sizes = df.groupBy("cluster").agg({"n": "sum"}).toDF("cluster", "tokens")

    def run(t):
        p = np.array(clusters.links(t, 80)).reshape(-1, 2)
        ids = t["node"].to_numpy()
        return pa.table({"a": ids[p[:, 0].astype(int)], "b": ids[p[:, 1].astype(int)]})
    got = clusters.block_pairs(df, sizes, blocks).groupBy("task").applyInArrow(run, "a bigint, b bigint")
    want = [(i, j) for i in range(30) for j in range(i) if 100 * len(set(sets[i]) & set(sets[j])) >= 80 * len(set(sets[i]) | set(sets[j]))]
    assert brute.components(range(30), [(x.a, x.b) for x in got.collect()]) == brute.components(range(30), want)


# ------------------------------------------------------------------ 4 lines
def line_fixture():
    r = random.Random(4)
    lines = [prose(r.randrange(3, 40), s, 300) for s in range(60)]
    docs = []
    for d in range(80):
        out = []
        for _ in range(r.randrange(1, 5)):
            x = list(r.choice(lines))
            for _ in range(r.randrange(0, 4)):
                x[r.randrange(len(x))] = f"n{r.randrange(50)}"
            out.append(" ".join(x))
        docs.append((d + 10, "\n".join(out) + r.choice(["", "\n", "\n \n"])))
    return [e for e in EDGE if e[0] is not None] + docs


@pytest.mark.parametrize("percent", [80, 90])
def test_lines_match_brute_force(spark, documents, percent):
    docs = line_fixture() + [(1000 + r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: r.removed for r in linededup.dedup_lines(frame(spark, docs), percent).collect()}
    assert got == brute.line_removals(docs, percent)


def test_lines_hot_words_are_split(spark, monkeypatch):
    """Words whose postings are dealt to blocks, and many small groups, change nothing."""
    docs = line_fixture()
    monkeypatch.setattr(linededup, "HOT_POSTINGS", 5)
    monkeypatch.setattr(linededup, "GROUP_POSTINGS", 50)
    monkeypatch.setattr(linededup, "_PAIRS", 7)
    got = {r.doc_id: r.removed for r in linededup.dedup_lines(frame(spark, docs), 80).collect()}
    assert got == brute.line_removals(docs, 80)


def test_lines_text_and_stage(spark):
    rows = [(1, "same line here\nother", "en", "s", 20), (2, "SAME line here\n\nmine only", None, None, 5),
            (2, "SAME line here\n\nmine only", None, None, 5), (3, "same line here", None, None, 1), (4, None, None, None, None),
            (5, "", None, None, 0), (None, "other", None, None, 2)]
    df = frame(spark, rows, DOC).selectExpr("*", "7 AS line")
    got = linededup.dedup_lines(df).collect()
    assert sorted((r.doc_id or 99, r.text, r.n_lines) for r in got if r.text is not None) == [
        (1, "same line here\nother", 2), (2, "\nmine only", 3), (2, "\nmine only", 3), (3, "", 1), (5, "", 1), (99, "", 1)]
    kept = linededup.line_stage(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, r.n_chars or 0) for r in kept.collect()) == [(1, 20), (2, 10), (2, 10), (4, 0), (5, 0)]
    assert linededup.line_stage(df.limit(0)).count() == 0


def test_lines_clashing_columns(spark):
    text = "one two three four five\nsix seven eight\none two three four five"
    rows = [(1, text, "d", "l", 7, 8, "t", 9), (2, "six seven eight", "e", "m", 1, 2, "u", 3)]
    df = frame(spark, rows, "doc_id bigint, text string, _d string, _lines string, removed int, n_lines int, _t string, _doc int")
    kept = sorted(tuple(r) for r in linededup.line_stage(df).collect())
    assert kept == [(1, "one two three four five\nsix seven eight", "d", "l", 7, 8, "t", 9)]
    out = {r.doc_id: r for r in linededup.dedup_lines(df).collect()}
    assert (out[1].removed, out[1].n_lines, out[1]._d, out[1]._lines, out[2].removed, out[2]._doc) == ([2], 3, "d", "l", [0], 3)


def test_line_words_and_prefixes_are_ordered_alike():
    import pyarrow as pa
    s = linededup.line_sets(pa.array(["b a b\n\nc a", None, "", "x", "a b"]))
    assert s["doc"].tolist() == [0, 0, 3, 4] and s["line"].tolist() == [0, 2, 0, 0]
    ends = [*s["start"][1:], len(s["token"])]
    sets = [s["token"][i:j].tolist() for i, j in zip(s["start"], ends)]
    assert sets[0] == sets[3] and all(x == sorted(set(x)) for x in sets) and [len(x) for x in sets] == [2, 2, 1, 2]
    r = np.random.default_rng(3)
    owner = np.sort(r.integers(0, 50, 2000))
    rank, token = r.integers(0, 4, 2000), r.integers(0, 2 ** 63, 2000).astype(np.uint64)
    token[::5] = (token[::5] & np.uint64(0xFFFFFF)) | np.uint64(1 << 60)      # equal leading bits
    assert (linededup._rarest_first(owner, rank, token) == np.lexsort((token, rank, owner))).all()


# ------------------------------------------------------------------ 5 quality
def test_quality_statistics(spark, documents):
    docs = [e for e in EDGE if e[0] is not None] + [(50, "a b c a b c a b c d"), (51, "a b a b a"), (52, "x\ny\nx\n\n x"),
                                                    (53, "# a $b\n& <c> |")]
    docs += [(1000 + r.doc_id, r.text) for r in documents.collect()]
    got = {r.doc_id: tuple(r)[1:6] for r in quality.quality_query(frame(spark, docs)).collect()}
    assert got == {d: brute.statistics(t) for d, t in docs}


def test_quality_verdicts(spark):
    good = ". ".join(" ".join(prose(9, s, 3000)) for s in range(12))
    rows = [(1, good), (2, good.upper()), (3, " ".join(w + "###" for w in good.split())), (4, "word " * 100), (5, None),
            (6, " ".join(w + "!!" for w in good.split())), (7, " ".join("12345" for _ in range(30)) + good[:100]), (1, good)]
    df = frame(spark, rows).selectExpr("*", "true AS kept", "3 AS n_words")
    got = quality.judge(df).collect()
    assert sorted(r.doc_id for r in got if r.kept) == [1, 1]
    assert all(r.base_failed for r in got if r.doc_id in (4, 5))
    stage = quality.quality_stage(df)
    assert stage.columns == df.columns and [r.doc_id for r in stage.collect()] == [1, 1]
    assert quality.quality_stage(df.limit(0)).count() == 0


def test_quality_order_does_not_matter(spark, documents):
    def kept(rules):
        return {r.doc_id for r in quality.quality_stage(documents, rules, sample_rows=0).collect()}
    assert kept(quality.RULES) == kept(quality.RULES[::-1])


def test_quality_keeps_labelled_clean_documents(spark, documents):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    got = quality.quality_query(documents).join(labels, "doc_id").collect()
    assert not any(r.kept for r in got if r.quality == 0)
    assert all(r.kept or r.base_failed for r in got if r.quality == 1)


# ------------------------------------------------------------------ 6 licences
def test_licences(spark):
    rows = [(1, "Under the MIT License, and again mit-license."), (2, None), (3, ""), (4, "permit license mit licenses"),
            (5, "This work is licensed under the GNU General Public License, version 3."),
            (6, "All rights reserved. Licensed under the Apache License, Version 2.0"), (7, "É mit É license mit LICENSE"),
            (8, "word " * 50_000 + "Apache\nLicense"), (1, "Under the MIT License, and again mit-license."),
            (9, "general public public license general public license")]
    df = frame(spark, rows).selectExpr("*", "1 AS score")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    view = {k: (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for k, r in got.items()}
    assert view[1] == (2, 2, 6, "mit", "mit")
    assert view[2] == view[3] == (0, None, None, "", "") and view[4] == (0, None, None, "", "")
    assert view[5] == (1, 7, 7, "gpl", "gpl,gpl-3.0")
    assert view[6] == (1, 6, 6, "apache", "all-rights-reserved,apache,apache-2.0")
    assert view[7] == (1, 4, 4, "mit", "mit")
    assert view[8] == (1, 50_000, 50_000, "apache", "apache")
    assert view[9] == (1, 4, 4, "gpl", "gpl")
    assert all(0 <= r.score <= 1 for r in got.values()) and got[2].score == 0
    assert licenses.scan(df).count() == len(rows) and licenses.scan(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 7 top-k
def vector_rows(n=450, dims=8, seed=2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(6, dims))
    rows = [(i, (centres[r.integers(6)] + 0.2 * r.normal(size=dims)).astype(np.float32).tolist()) for i in range(n)]
    return [(i, v if i % 3 else rows[1][1]) for i, v in rows]  # a third of all rows is one vector


def test_top_k_matches_brute_force(spark):
    rows = vector_rows()
    bad = [(1000, None), (1100, [1.0, None] + [0.0] * 6), (1200, [float("nan")] * 8), (1300, [float("inf")] * 8), (None, [1.0] * 8)]
    df = frame(spark, rows + bad, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS vec")
    vectors = knn.integer_vectors(df)
    want = brute.top_k({i: [math.floor(x * 1024) for x in v] for i, v in rows})
    queries = vectors.where("vec_id % 100 = 0").selectExpr("vec_id AS query_id", "vec")
    for how in ({}, {"pivots": 5, "sample_rows": 40, "block_rows": 20, "query_rows": 2}):
        got = knn.voronoi_topk(queries, vectors, **how).collect()
        assert sorted(map(tuple, got)) == want


def test_top_k_small_and_odd(spark):
    schema = "vec_id bigint, embedding array<float>"
    df = frame(spark, [(0, [1.0, 2.0]), (100, [3.0]), (5, [0.5, 0.5, 9.0]), (7, []), (8, [2.0**40, 2.0**40])], schema)
    v = {0: [1024, 2048, 0], 100: [3072, 0, 0], 5: [512, 512, 9216], 7: [0, 0, 0], 8: [2**50, 2**50, 0]}
    assert sorted(map(tuple, knn.knn_query(df).collect())) == brute.top_k(v)
    assert knn.knn_query(df.limit(0)).count() == 0
    assert knn.knn_query(df.where("vec_id = 5")).count() == 0
    assert knn.knn_query(df.where("vec_id = 0")).count() == 0
    twice = knn.knn_query(frame(spark, [(0, [1.0]), (0, [2.0]), (1, [1.0]), (1, [1.0])], schema)).collect()
    assert [(r.vec_id, r.score) for r in twice] == [(1, 1024 * 1024)] * 2


# ------------------------------------------------------------------ 8 languages
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in langid.language_query(docs).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [d for d in truth if zlib.crc32(str(d).encode()) % 3 == 1]
    assert {d for d, r in got.items() if r.held_out} == set(held)
    assert sum(got[d].lang_pred == truth[d] for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_filter_against_plain_sets():
    r = random.Random(8)
    texts = {lang: [" ".join("".join(r.choice(abc) for _ in range(6)) for _ in range(80)) for _ in range(4)]
             for lang, abc in (("aa", "abcdef"), ("bb", "defghi"), ("cc", "ghijkl"))}
    model = langid.Filter(list(texts), slots=1 << 16)
    plain = {}
    for lang, some in texts.items():
        h, _, _ = langid.grams(some)
        model.add(lang, np.unique(h))
        plain[lang] = set(h.tolist())
    tests = [" ".join(t) for t in texts.values()] + ["abc ghi", "!!", ""]
    h, owner, letters = langid.grams(tests)
    count, total = model.counts(h, owner, len(tests))
    exact = np.array([[sum(int(x) in plain[lang] for x in h[owner == i]) for lang in model.languages] for i in range(len(tests))])
    assert np.abs(count - exact).max() <= 0.02 * max(1, total.max()) + 1
    assert letters.tolist()[-2:] == [0, 0] and total.tolist()[-2:] == [0, 0]
    assert (count[:3].argmax(axis=1) == [0, 1, 2]).all()


def test_language_edges(spark):
    rows = [(i, "abc def " * 5, "x", None, 1) for i in range(30)] + [(i + 30, "xyz uvw " * 5, "y", None, 1) for i in range(30)]
    rows += [(90, None, "x", None, 1), (91, "123 ...", None, None, 1), (92, "", "y", None, 1), (None, "abc", None, None, 1),
             (93, "abc " * 40_000, None, None, 1), (93, "abc " * 40_000, None, None, 1)]
    df = frame(spark, rows, DOC).selectExpr("*", "1 AS lang_pred")
    got = {r.doc_id: r for r in langid.language_query(df).collect()}
    assert [got[k].lang_pred for k in (90, 91, 92, 93, None, 0, 30)] == ["und", "und", "und", "x", "x", "x", "y"]
    assert got[None].held_out is False
    assert langid.language_query(df.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.language_query(df.selectExpr("doc_id", "text")).collect()} == {"und"}


def test_language_learns_from_rare_grams(spark):
    train = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    rows = [(train[0], "quick zebra", "en", None, 1), (train[1], "flott gjort", "no", None, 1), (900, "zebra", None, None, 1),
            (901, "gjort", None, None, 1)]
    got = {r.doc_id: r.lang_pred for r in langid.language_query(frame(spark, rows, DOC)).collect()}
    assert got == {train[0]: "en", train[1]: "no", 900: "en", 901: "no"}
    many = spark.createDataFrame([(i, f"text {i} {j}", f"l{j}") for j in range(5) for i in range(j + 1)],
                                 "doc_id long, text string, lang string")
    assert {r.lang for r in langid.training_sample(many, 10, languages=2).collect()} == {"l3", "l4"}


# ------------------------------------------------------------------ 9 mixing
def water(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Shares by weight; the excess over the caps is reshared until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_ = share * sum(sizes.values()), set(names)
    out = {}
    while open_:
        total = sum(w[s] for s in open_)
        over = [s for s in open_ if left * w[s] / total > cap * sizes[s]]
        if not over:
            return out | {s: left * w[s] / total for s in open_}
        for s in over:
            out[s] = cap * sizes[s]
            open_.discard(s)
        left = share * sum(sizes.values()) - sum(out.values())
    return out


def test_mixing_targets_and_taken(spark):
    r = random.Random(9)
    rows = [(i, " ".join(prose(r.randrange(1, 60), i)), None, r.choice(["a", "a", "a", "b", "é", "z", None]), 1) for i in range(600)]
    rows += [(700, None, None, "a", 1), (701, "", None, "empty", 0), (702, "x " * 3000, None, "b", 1)]
    df = frame(spark, rows, DOC).selectExpr("*", "1 AS size")
    got = mixing.mix(df).collect()
    sizes = {}
    for d, t, _, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(brute.words(t))
    want = water(sizes)
    longest = {s: max(len(brute.words(t)) for _, t, _, x, _ in rows if x == s) for s in sizes}
    assert len(got) == len(rows)
    for x in got:
        assert x.source_size == sizes[x.source] and x.target == pytest.approx(want[x.source])
        assert x.taken <= 2 * x.size
    for s in sizes:
        assert abs(sum(x.taken for x in got if x.source == s) - want[s]) <= longest[s]
    key = lambda rows: sorted((x.doc_id, x.taken) for x in rows)
    assert key(got) == key(mixing.mix(df.repartition(7)).collect())
    stage = mixing.mix_stage(df)
    assert stage.columns == df.columns
    n = {}
    for x in stage.collect():
        n[x.doc_id] = n.get(x.doc_id, 0) + 1
    assert n == {x.doc_id: x.taken // x.size for x in got if x.taken}
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mix_stage(df.limit(0)).count() == 0


def test_mixing_null_ids_and_low_quality(spark):
    """A null id on every row, and texts of the lowest quality, still meet the targets."""
    rows = [(None, f"w{i} " * 10 + ("# " * 40 if s == "c" else ""), None, s, 1) for s in "abc" for i in range(200)]
    got = mixing.mix(frame(spark, rows, DOC), buckets=8).collect()
    for s in "abc":
        mine = [x for x in got if x.source == s]
        assert abs(sum(x.taken for x in mine) - mine[0].target) <= max(x.size for x in mine)


def test_mixing_prefers_quality(spark):
    rows = [(i, "plain words here and there", None, "s", 1) for i in range(0, 2000, 2)]
    rows += [(i, "#$% &*# words <> there", None, "s", 1) for i in range(1, 2000, 2)]
    got = mixing.mix(frame(spark, rows, DOC), share=0.5).collect()
    good = sum(x.taken for x in got if x.doc_id % 2 == 0)
    bad = sum(x.taken for x in got if x.doc_id % 2)
    assert good > 3 * bad


# ------------------------------------------------------------------ 10 packing
def check_packing(rows, docs, capacities):
    by_doc, bins = {}, {}
    for p in rows:
        by_doc.setdefault((p.row, p.doc_id), []).append((p.start, p.length))
        if p.bin_id is not None:
            bins.setdefault(p.bin_id, []).append(p)
    sizes = sorted(len(brute.words(t)) for _, t in docs)
    assert sorted(sum(n for _, n in v) for v in by_doc.values()) == sizes
    for v in by_doc.values():
        at = 0
        for start, n in sorted(v):
            assert start == at
            at += n
    for v in bins.values():
        used = 0
        for p in sorted(v, key=lambda p: p.offset):
            assert p.offset == used
            used += p.length
        assert {p.capacity for p in v} == {min(c for c in capacities if c >= used)}


@pytest.mark.parametrize("shard", [8192, 16])
def test_packing_round_trip(spark, shard):
    docs = [(i, " ".join(prose(n, i))) for i, n in enumerate(random.Random(1).choices(range(1, 900), k=150))]
    docs += [(None, "null id"), (200, None), (201, ""), (5, docs[5][1]), (202, "x " * 5000)]
    df = frame(spark, docs).selectExpr("*", "1 AS length")
    got = packing.pack(df, (64, 128, 256), shard_pieces=shard).collect()
    check_packing(got, docs, (64, 128, 256))
    assert packing.pack(df.limit(0)).count() == 0


def test_packing_quality():
    lengths = np.sort(np.random.default_rng(0).integers(1, 512, 3000))[::-1]
    where, offset, final = packing.pack_jointly(lengths, (128, 256, 512))
    assert len(where) == len(lengths) and sum(final) <= 1.03 * lengths.sum()
    # A lone short piece does not open the largest bin.
    assert packing.pack_jointly(np.array([10]), (64, 512))[2] == [64]
    assert sum(map(packing.cost, final)) <= sum(map(packing.cost, packing.best_fit(lengths, [512])[2]))


def test_language_sample_is_bounded_and_distinct(spark):
    rows = [(i, f"text number {i}", "aa") for i in range(3000)] + [(-1, "one text", "bb")] * 900 + [(-2, "few", "cc")]
    got = langid.training_sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 100)
    assert {r["lang"]: r["count"] for r in got.groupBy("lang").count().collect()} == {"aa": 100, "bb": 1, "cc": 1}
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.training_sample(none, 100).collect() == []
