"""Near-duplicates, nearest neighbours and pages against plain Python."""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkdeck.llm import ann, neardup, pages, textnp
from sparkdeck.llm.common import table
from tests.conftest import SF0001, SF001
from tests.llm import brute


def test_word_hashes_follow_the_words(monkeypatch):
    texts = ["Ab aB, ab", "é É Ab", None, "", "x" * 5000, "a-b_c 1 2 " * 300, "\U0001F600 ab"]
    for piece in (textnp.PIECE, 64):
        monkeypatch.setattr(textnp, "PIECE", piece)
        h, at = textnp.word_hashes(texts)
        seen = {}
        for i, t in enumerate(texts):
            w = brute.words(t)
            assert len(w) == at[i + 1] - at[i]
            for x, y in zip(w, h[at[i]:at[i + 1]].tolist(), strict=True):
                assert seen.setdefault(x, y) == y
        assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("target", [0.3, 0.8])
def test_signatures_estimate_weighted_jaccard(target):
    rng, found, true = np.random.default_rng(1), [], []
    for _ in range(25):
        n = 150
        both = int(2 * n * target / (1 + target))
        ids = rng.integers(1, 2**63, size=2 * n - both).astype(np.uint64)
        wa, wb = rng.integers(1, 9, n), rng.integers(1, 9, n)
        s, t = np.concatenate([ids[:n], ids[n - both:]]), np.repeat([0, 1], n)
        best = neardup.signatures(s, t, np.concatenate([wa, wb]), 2, 256)
        found.append((best[0] == best[1]).mean())
        a, b = dict(zip(ids[:n].tolist(), wa, strict=True)), dict(zip(ids[n - both:].tolist(), wb, strict=True))
        true.append(sum(min(a.get(k, 0), b.get(k, 0)) for k in a | b) / sum(max(a.get(k, 0), b.get(k, 0)) for k in a | b))
    assert abs(np.mean(found) - np.mean(true)) < 0.02


def copies(rng, words, n, share):
    out = []
    for _ in range(n):
        w = list(words)
        for i in rng.sample(range(len(w)), int(share * len(w))):
            w[i] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_classes_equal_brute_force(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(5000)}" for _ in range(rng.randrange(3, 200))] for _ in range(40)]
    texts = [" ".join(b) for b in base] + [t for b in base[:12] if len(b) > 60 for t in copies(rng, b, 25, 0.02)]
    chain = [f"c{i}" for i in range(200)]  # neighbours are alike, the ends are not
    texts += [" ".join(chain[k:k + 120]) for k in range(0, 60, 5)]
    texts += ["", None, "!!", "Same. Text", "same text", "Same. Text", "rep " * 40, "rep " * 44, "rep " * 90, "word " * 30_000]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("digest", F.lit(1)).withColumn("key", F.lit(2))
    got = {r["doc_id"]: r["class_id"] for r in neardup.classes(docs).collect()}
    assert [got[i] for i, _ in rows] == brute.near_classes(rows)
    kept = neardup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(got.values()))


def test_classes_of_repeated_and_nameless_rows(spark):
    rows = [(None, "alpha beta gamma delta epsilon"), (7, "alpha beta gamma delta epsilon"), (7, "alpha beta gamma delta epsilon"),
            (None, ""), (None, None), (3, ""), (4, "alone"), (None, "nameless")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["class_id"])) for r in neardup.classes(docs).collect())
    assert got == sorted([("None", "7"), ("7", "7"), ("7", "7"), ("None", "None"), ("None", "None"), ("3", "3"), ("4", "4"), ("None", "None")])
    kept = sorted(str(tuple(r)) for r in neardup.keep_one(docs).collect())
    assert kept == sorted(str(x) for x in [(7, "alpha beta gamma delta epsilon"), (None, ""), (None, None), (3, ""), (4, "alone"), (None, "nameless")])
    assert neardup.classes(docs.limit(0)).isEmpty() and neardup.keep_one(docs.limit(0)).isEmpty()


def test_components_of_a_long_path(spark):
    n = 70
    links = spark.createDataFrame([(i, i + 1) for i in random.Random(2).sample(range(n), n)] + [(900, 901)], "a long, b long")
    got = {r["node"]: r["root"] for r in neardup.components(links).collect()}
    assert got == {**dict.fromkeys(range(n + 1), 0), 900: 900, 901: 900}


def test_nearest_neighbours_reach_the_recall(spark):
    v = table(spark, SF0001, "embeddings")
    got = ann.search(v.withColumn("v", F.lit(1)).withColumn("dim", F.lit(1)), F.col("vec_id") % 50 == 0, block_rows=100, block_queries=4).collect()
    x = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in v.collect()}
    hits = n = 0
    for q in (i for i in x if i % 50 == 0):
        cos = sorted(((-(x[i] @ x[q]) / np.linalg.norm(x[i]) / np.linalg.norm(x[q]), i) for i in x if i != q))[:5]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        hits += len({i for _, i in cos} & {m[1] for m in mine})
        n += 5
        for _, i, s in mine:
            assert abs(s - x[i] @ x[q] / np.linalg.norm(x[i]) / np.linalg.norm(x[q])) < 1e-12
    assert hits >= 0.9 * n


def test_nearest_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (3, [2.0, 0.0]), (2, [4.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
            (8, [None, 1.0]), (9, []), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (3, [2.0, 0.0]), (100, [0.0, 0.0]), (150, [1e-200, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in ann.search(v, F.col("vec_id") % 50 == 0).collect()]
    assert sorted(g for g in got if g[0] == 0) == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 150, 1.0), (0, 4, 50, 0.0)]
    assert {g[0] for g in got} == {0, 50, 150}
    assert ann.search(v.limit(0), F.col("vec_id") % 50 == 0).isEmpty()


def test_blocks_stay_bounded_when_an_id_repeats(spark, monkeypatch):
    rng = np.random.default_rng(11)
    rows = [(7, x.tolist()) for x in rng.normal(size=(300, 8))] + [(9, [1.0] * 8)] * 300
    rows += [(100 + i, x.tolist()) for i, x in enumerate(rng.normal(size=(300, 8)))]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sizes = spark.sparkContext.accumulator(0)
    class Small(ann.Block):
        def __init__(self, ids, *rest):
            assert len(ids) <= 120, len(ids)
            sizes.add(1)
            super().__init__(ids, *rest)

    monkeypatch.setattr(ann, "Block", Small)
    got = ann.search(vectors, F.col("vec_id") % 50 == 0, block_rows=90).collect()
    assert sizes.value >= 601 // 90 and len({(r["query_id"], r["vec_id"]) for r in got}) == len(got) == 6 * 5


def test_structure_keeps_queries_to_few_files():
    rng = np.random.default_rng(3)
    pivots = ann._unit(rng.normal(size=(64, 16)))
    counts = rng.integers(1, 200, 64)
    counts[5] = 5000  # one file with a third of all rows
    groups = ann.bundles(pivots, counts, 1000)
    assert sorted(f for g in groups for f in g) == list(range(64))
    assert all(counts[g].sum() <= 1000 or g.tolist() == [5] for g in groups)
    index = ann.Index(pivots, counts, 3, 1000, 10)
    order = ann.nearest(pivots[5:6], pivots, 64)[0]
    assert order[0] == 5 and index.visited(order).tolist() == order[:3].tolist()
    parts = [b for b, files in index.deal(np.array([5]), None)]
    assert len(parts) == 5 and {b for p in range(20) for b, _ in index.deal(np.array([5]), p)} == set(parts)


def test_clustered_vectors_are_found_without_a_look_at_most_rows(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(100, 24))
    x = centres[np.arange(4000) % 100] + 0.1 * rng.normal(size=(4000, 24))
    v = spark.createDataFrame([(i * 7, r.tolist()) for i, r in enumerate(x)], "vec_id long, v array<double>")
    sized = v.withColumn("dim", F.lit(24))
    pivots = {d: p for d, (_, p) in ann.sample_rows(sized, {24: 4000}, {24: 256}).items()}
    asked = ann.sample_rows(sized.where(F.col("vec_id") % 50 == 0), {24: 80}, {24: 80})
    counts, visit = ann.survey(sized, pivots, asked, 5, 2, 0.97)
    assert counts[24].sum() == 8000 and visit[24] < 40
    got = ann.search(v, F.col("vec_id") % 50 == 0, vector="v").collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 4000, 50):
        s = u @ u[q]
        s[q] = -2
        hits += len({r["vec_id"] // 7 for r in got if r["query_id"] == q * 7} & set(np.argsort(-s)[:5].tolist()))
    assert hits >= 0.9 * 400


def naive(page):
    body = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S).group(1)
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("bound", [pages.BROADCAST_TOKENS, 0])
def test_pages_give_their_articles(spark, monkeypatch, bound):
    monkeypatch.setattr(pages, "BROADCAST_TOKENS", bound)
    p = table(spark, SF001, "pages")
    want = {r["page_id"]: naive(r["html"]) for r in p.collect()}
    got = pages.extract(p.withColumn("host", F.lit("h")).withColumn("template", F.lit("t"))).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)


ODD_PAGES = [
    ("", ""), (None, ""), ("plain &amp; text", "plain & text"), ("<p>un<b>closed<p>next &lt;b&gt;", "unclosed\nnext <b>"),
    ("<article><h1>T</h1><p>a  b<br>c</p><aside>no</aside><div class='comments'><p>no</p></div><form>no</form><p>d&nbsp;e</article><footer>no",
     "T\na b c\nd e"),
    ("<header>no</header><main><header><h1>Head</h1></header><p>x</p><script>no('</p>')</script><!-- no --></main>", "Head\nx"),
    ("<body><div id='cookie-notice'>no</div><ul class=menu><li>no</li></ul><div><p>" + "word " * 30 + "</p></div><p><a href=x>just a link</a></p>",
     ("word " * 30).strip()),
    ("<article><p title='a > b'>kept", "kept"), ("<article>a < b</article>", "a < b"), ("<article>" + "long " * 50_000 + "</article>", ("long " * 50_000).strip()),
]


def test_odd_pages(spark):
    rows = [(i, f"https://h{i}.example/x", page) for i, (page, _) in enumerate(ODD_PAGES)]
    p = spark.createDataFrame([*rows, (None, None, "<p>x"), rows[2]], "page_id long, url string, html string")
    got = pages.extract(p).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        assert r["text"] == ("x" if r["page_id"] is None else ODD_PAGES[r["page_id"]][1])
    assert pages.extract(p.limit(0)).isEmpty()


def test_template_text_is_dropped_where_a_host_repeats_it(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    arts = [text(40) for _ in range(8)]
    page = "<html><body><div><p>Our standing offer</p><h2>{0}</h2><p>{1}</p><p>Write to us</p></div></body></html>"
    heads = [text(3) for _ in range(8)]
    rows = [(i, "https://one.example/", page.format(h, a)) for i, (h, a) in enumerate(zip(heads, arts, strict=True))]
    rows += [(100 + i, "https://copy.example/", page.format("Head", arts[0])) for i in range(20)]  # copies of one page: no template
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(8):
        assert got[i] == f"{heads[i]}\n{arts[i]}"
    assert all(arts[0] in got[100 + i] for i in range(20))


def test_nested_articles_are_one():
    assert pages.main_text("<main><h1>Title</h1><p>intro</p><article><p>" + "word " * 30 + "</p></article><article><p>end</article></main>",
                           None) == "Title\nintro\n" + ("word " * 30).strip() + "\nend"
    assert pages.main_text("<article><p>outer text</p><article><p>a longer inner text</p></article><p>rest</p></article><p>no",
                           None) == "outer text\na longer inner text\nrest"


LONG = ("word " * 40).strip()


@pytest.mark.parametrize(("page", "want"), [
    (f"<div class='content has-sidebar'><article><p>{LONG}</p><div class=share>no</div></article><div class=sidebar>no</div></div>", LONG),
    (f"<div class=no-sidebar><main><p>short</p></main></div><div>{LONG}</div>", "short"),
    (f"<div class='page-widget commentary'><article><p>{LONG}</article></div><footer>no", LONG),
    (f"<article><div class='alert'><p>{LONG}</p><div class=share>no</div></div></article>", LONG),
    (f"<div id=skip><p>{LONG}</p><ul class=menu><li>no</ul></div><nav>no</nav>", LONG),
    (f"<div class=comments-open><div><p>{LONG}</p></div></div>", LONG),
    # beside the article, names still drop
    (f"<article><p>story</p></article><div class=related><article>{LONG}</article></div>", "story"),
    (f"<div><p>{LONG}</p></div><div id=comments><article>no</article><article>no, no</article></div>", LONG),
    (f"<div class=commentary><p>{LONG}</p></div><nav>no</nav>", LONG),
    (f"<div class=comments-open><article><p>{LONG}</p></article></div><p>no</p>", LONG),
    (f"<article><p>story</p><div class=comments>{LONG}</div></article>", "story"),
    (f"<div><p>{LONG}</p></div><div class=related><article>teaser</article><article>teaser</article></div>", LONG),
])
def test_names_do_not_drop_what_encloses_the_article(page, want):
    assert pages.main_text(page, None) == want


SHORT_BLOCKS = "<p>A paragraph of some sixty characters, much shorter than others.</p><ul><li>one</li><li>two</li></ul><blockquote>said</blockquote>"
SHORT_LINES = "A paragraph of some sixty characters, much shorter than others.\none\ntwo\nsaid"


@pytest.mark.parametrize("page", [
    "<body><div id=top>Home</div><div><div id=content><h1>T</h1><p>{0}</p>{1}</div></div></body>",
    "<body><div id=top>Home</div><div><div id=content><section><h2>T</h2><p>{0}</p></section><section>{1}</section></div></div></body>",
    "<body><div id=top>Home</div><div><div class=para>T</div><div class=para>{0}</div>{1}</div></body>",
])
def test_short_blocks_of_the_container_stay(spark, page):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(130)) for _ in range(8)]
    assert pages.main_text(page.format(texts[0], SHORT_BLOCKS), None) == f"T\n{texts[0]}\n{SHORT_LINES}"
    # with a template: all tags stand once a page, the short texts differ
    rows = [(i, "https://h.example/", page.format(t, SHORT_BLOCKS.replace("<p>A", f"<p>A{i}").replace("one", f"one{i}")
             .replace("two", f"two{i}").replace("said", f"said{i}")).replace("T<", f"T{i}<")) for i, t in enumerate(texts)]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == f"T{i}\n{t}\n" + SHORT_LINES.replace("A p", f"A{i} p").replace("one", f"one{i}").replace(
            "two", f"two{i}").replace("said", f"said{i}")


def one_of(p, n):
    return p.withColumn("url", F.format_string("https://h%d.example/", F.col("page_id") % n))


def test_classes_equal_plain_occurrence_vectors(spark):
    """Tokens with equal counts on every page of a host, built as plain vectors."""
    p = one_of(table(spark, SF001, "pages"), 2)
    p = p.unionAll(p.where("page_id % 3 = 0"))  # copies count once
    by_host = {}
    for r in p.collect():
        tags, runs, _, _ = pages.parse(r["html"])
        seen = [*tags, *((x.place, x.token) for x in runs if x.token)]
        times, first = {}, {}
        for place, t in seen:
            times[t] = times.get(t, 0) + 1
            first.setdefault(t, place)
        key = frozenset(x.token for x in runs if x.token and x.text.count(" ") >= pages.LONG_RUN) or frozenset(times)
        by_host.setdefault(f"h{r['page_id'] % 2}.example", {})[key] = times, first
    want = {}
    for host, each in by_host.items():
        each = list(each.values())
        classes = {}
        for t in {t for times, _ in each for t in times}:
            vector = tuple(times.get(t, 0) for times, _ in each)
            held = [first[t] for _, first in each if t in first]
            if len(held) >= max(pages.LEAST_PAGES, pages.SHARE * len(each)):
                classes.setdefault(vector, []).append((sum(held) / len(held), t))
        want[host] = sorted([t for _, t in sorted(c)] for c in classes.values() if len(c) > 1)
    assert all(want.values())
    got = pages.deduce_templates(p.select(pages.host_of(F.col("url")).alias("host"), "html")).collect()
    assert {r["host"]: sorted(list(map(list, r["template"]))) for r in got} == want
    assert all(r["region"] for r in got)


@pytest.mark.parametrize("changes", [
    [("<article>", '<div class="q7">'), ("</article>", "</div>")],
    [("</?article>", "")],
    [("<article>", '<div class="q7"><div class="q8">'), ("</article>", "</div></div>")],
    [("<article>", '<div class="q7">'), ("</article>", "</div>"), ("<(nav|footer)>", '<div class="u$1">'), ("</(nav|footer)>", "</div>")],
    [("<article>(<h1>.*?</h1>)", '<div class="q7">$1<div class="z9">$1</div><div class="q8">'), ("</article>", "</div></div>")],
])
def test_the_template_finds_articles_without_tags_and_names(spark, changes):
    p = one_of(table(spark, SF001, "pages"), 2)
    want = {r["page_id"]: naive(r["html"]) for r in p.collect()}
    for a, b in [('class="ad"', 'class="z3"'), *changes]:
        p = p.withColumn("html", F.regexp_replace("html", a, b))
    assert {r["page_id"]: r["text"] for r in pages.extract(p).collect()} == want


def test_no_article_text_is_dropped_for_being_repeated(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    parts = [(text(3), text(40), text(20)) for _ in range(8)]
    line = "<p>Reporting by the newsroom staff</p>"
    forms = {"tag": "<body><div class=a>Our offer {0}</div><article><h1>{0}</h1>" + line + "<p>{1}</p>" + line + "<p>{2}</p>" + line + "</article></body>",
             "div": "<body><div class=a>Our offer {0}</div><div class=b><h1>{0}</h1>" + line + "<p>{1}</p>" + line + "<p>{2}</p></div></body>"}
    rows = [(i, f"https://{k}.example/", f.format(*x)) for k, f in forms.items() for i, x in enumerate(parts)]
    staff = "Reporting by the newsroom staff"
    for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        a, b, c = parts[r["page_id"]]
        assert r["text"] == "\n".join([a, staff, b, staff, c] + [staff] * r["url"].startswith("https://tag"))


def test_a_region_is_of_the_host_not_of_the_page(spark):
    """A short article next to a longer teaser, and an empty one, by the pages around them."""
    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    arts = [text(60) for _ in range(9)] + ["short", ""]
    rows = [(i, "https://h.example/", f"<body><div class=x>{text(8)}</div><div class=y><h2>{a[:9]}</h2><p>{a}</p></div><div class=z>{text(9)}</div></body>")
            for i, a in enumerate(arts)]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"{a[:9]}\n{a}".strip() for i, a in enumerate(arts)}


def test_regions_of_plain_sums():
    box = lambda t, a, text, own, page=False: (t, a, page, text, own)
    assert pages.region_of([]) == []
    assert pages.region_of([box(1, 0, 100, 90, True), box(2, 1, 10, 10)]) == [1]  # the text stands right in the page
    assert pages.region_of([box(1, 0, 100, 0, True), box(2, 1, 40, 40), box(3, 1, 40, 40), box(4, 1, 20, 20)]) == []  # spread
    assert pages.region_of([box(1, 0, 100, 0, True), box(2, 1, 80, 10), box(3, 2, 70, 70)]) == [2]  # the heading and the text
    assert pages.region_of([box(1, 0, 100, 0, True), box(2, 1, 90, 5), box(3, 2, 70, 70), box(4, 2, 15, 15)]) == [3, 2]
