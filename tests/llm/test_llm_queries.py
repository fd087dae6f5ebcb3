"""Queries against their SQL; near copies, passages, pages and the pipeline against brute force and planted cases."""

import os
import random
import re
import sys

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mattone.llm import decontamination, near_duplicates, rules, wrappers
from mattone.llm.queries import ORACLE, QUERIES
import corpus_pipeline

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
from compare import connect, difference  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), ORACLE[name], connect(SMALL)) == ""


@pytest.mark.parametrize("name", ["op3_adaptive_rules", "op5_benchmark_decontamination"])
def test_native_queries_run_no_python(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def vocabulary(seed, n=4000):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(n)], rng


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_by_brute_force(spark, percent):
    """Chains of small changes around the threshold, and a large group of copies that are near each other."""
    words, rng = vocabulary(10)
    rows = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.randrange(30, 160))]
        for step in range(12):
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
            for _ in range(rng.randrange(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
    text = [rng.choice(words) for _ in range(120)]
    for _ in range(120):
        near = list(text)
        near[rng.randrange(120)] = rng.choice(words)
        rows.append((2000 + len(rows), " ".join(near)))
    sets = {d: shingles(t) for d, t in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.component_id, r.kept, r.n_shingles) for r in near_duplicates.near_duplicates(docs, percent).collect()}
    assert got == {d: (root(d), root(d) == d, len(sets[d])) for d in ids}


def test_passages_with_changes(spark):
    """An item with a changed, a missing or an added word is found where the exact similarity says so, and nothing else is."""
    words, rng = vocabulary(5)
    items, rows, expected = [], [], set()
    for i in range(30):
        item = [rng.choice(words) for _ in range(rng.randrange(20, 70))]
        items.append((i, " ".join(item)))
        for kind in range(4):
            text = list(item)
            if kind == 1:
                text[-2 if i % 2 else 1] = "changed"
            elif kind == 2:
                del text[0]
            elif kind == 3:
                text = text[: len(text) // 2]
            lead, tail = ([rng.choice(words) for _ in range(rng.randrange(0, 90))] for _ in "ab")
            rows.append((4 * i + kind, " ".join([*lead, *text, *tail])))
    for doc, text in rows:
        w = text.split()
        for i, item in items:
            v = item.split()
            bag = [tuple(v[j : j + 5]) for j in range(len(v) - 4)]
            best = max((len(set(bag) & {tuple(w[s + j : s + j + 5]) for j in range(len(bag))}) for s in range(len(w) - len(v) + 1)), default=0)
            if best / (2 * len(bag) - best) >= 0.8:
                expected.add((doc, i))
    assert {(4 * i, i) for i in range(30)} <= expected and any(d % 4 == 2 for d, _ in expected)
    got = decontamination.find_items(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == expected


def test_texts_shorter_than_an_item(spark):
    """An item less some of its words is found where the similarity of the whole text says so, however small both are."""
    words, rng = vocabulary(6)
    items, rows, expected = [], [], {}
    for i, size in enumerate([60, *range(5, 45)]):
        item = [rng.choice(words) for _ in range(size)]
        items.append((i, " ".join(item)))
        for cut, kind in enumerate((item[:-1], item[1:], item[:-2], item[2:-2], item[: size // 2], [*item[:3], *item[4:]], [*item[:-3], "other"])):
            rows.append((10 * i + cut, " ".join(kind)))
    for doc, text in rows:
        for i, item in items:
            x, y = ({tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (text.split(), item.split()))
            if len(text.split()) < len(item.split()) and x and len(x & y) / len(x | y) >= 0.8:
                expected[doc, i] = len(x & y) / len(x | y)
    assert expected[0, 0] == 55 / 56 and len({i for _, i in expected}) > 30
    got = decontamination.find_items(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): r.similarity for r in got.collect()} == pytest.approx(expected)


def test_rules_keep_clean_documents(spark):
    """Clean labelled documents pass, whatever their source; junk beside them does not."""
    folder = "/root/testdata/sf0.01"
    judged = rules.judge(spark.read.parquet(f"{folder}/documents.parquet")).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("n_words >= 20").collect()
    good, bad = [r for r in judged if r.quality == 1], [r for r in judged if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(r.kept for r in bad) <= 0.5 * len(bad)


@pytest.mark.parametrize("wrapper", ["div class='page has-sidebar'", "div class=no-sidebar", "div id='search-result'", "div class='social-science'", "form action='/'", "div class='sidebar'"])
@pytest.mark.parametrize("inner", ["div", "article"])
def test_wrappers_named_like_roles_keep_the_main_text(wrapper, inner):
    html = f"<html><body><nav>menu of links</nav><{wrapper}><{inner}><p>The main text has most of the words of its page</p></{inner}><div class='ad left'>buy this</div></{wrapper.split()[0]}><footer>below</footer></body></html>"
    assert wrappers.Page(html).main_text() == "The main text has most of the words of its page"


def test_roles_beside_an_article_stay():
    html = "<body><article><p>Short text</p></article><aside><article>a teaser with more words than the text</article></aside><div class='comments'>me too and more and more and more</div></body>"
    assert wrappers.Page(html).main_text() == "Short text"


def page(i, host, body, closed=True):
    return (i, f"https://{host}/p/{i}", f"<html><head><title>t{i}</title><script>var a = '</p>' + {i};</script></head><body>{body}" + ("</body></html>" if closed else ""))


def test_wrapper_induction(spark):
    """Constant texts of a host go, varying ones stay; roles go even if they vary; an article keeps its own repeats."""
    rows = []
    for i in range(8):
        rows.append(page(i, "a.example", f"<nav><a>m{i}</a></nav><div><p>All rights of this site</p><div><h2>Title {i}</h2><p>Body&nbsp;{i} &amp; <b>more</b> text<br>here</p></div><p>Powered by words</p></div><div class='comments'><p>me {i}</p></div>", i % 2))
        rows.append(page(100 + i, "b.example", f"<header>h{i}</header><article><h1>T {i}</h1><p>Same in each<p>Own {i}</article><aside>x</aside><form><p>f{i}</form><footer>c</footer>"))
    rows.append(page(200, "c.example", "<div><p>alone</p></div>"))
    got = {r.page_id: r.text for r in wrappers.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    for i in range(8):
        assert got[i] == f"Title {i}\nBody {i} & more text here"
        assert got[100 + i] == f"T {i}\nSame in each\nOwn {i}"
    assert got[200] == "alone"


def plain_matching(page, reference):
    """Simple tree matching by its definition: every pair of children weighed anew, pairs of text nodes given."""

    def kids(p, node):
        return [c for c in range(len(p.tag)) if p.parent[c] == node and not p.role[c] and (p.tag[c] != "#text" or p.words(c))]

    def match(x, y):
        if page.tag[x] != reference.tag[y]:
            return 0, []
        a, b = kids(page, x), kids(reference, y)
        own = [[match(u, v) for v in b] for u in a]
        rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                rows[i + 1][j + 1] = max(rows[i][j + 1], rows[i + 1][j], rows[i][j] + own[i][j][0])
        i, j, texts = len(a), len(b), [(x, y)] if page.tag[x] == "#text" else []
        while i and j:
            if rows[i][j] == rows[i - 1][j]:
                i -= 1
            elif rows[i][j] == rows[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                texts = texts + own[i][j][1]
        return rows[-1][-1] + 1, texts

    return match(0, 0)[1]


def test_matchings_are_shared_by_pages_laid_out_alike(monkeypatch):
    """Pairs are those of plain tree matching; pages that differ in their words alone are weighed once for all, and each reference outlined once."""
    rng = random.Random(5)
    weighed, outlined = [], []
    monkeypatch.setattr(wrappers.Shapes, "_matching", lambda self, x, y, run=wrappers.Shapes._matching: weighed.append((x, y)) or run(self, x, y))
    monkeypatch.setattr(wrappers.Shapes, "outline", lambda self, page, run=wrappers.Shapes.outline: outlined.append(page) or run(self, page))
    shapes = wrappers.Shapes()
    for _ in range(60):
        layouts = []
        for _ in range(2):
            parts = [rng.choice(["<div>", "<p>", "<ul><li>", "</div>", "</ul>", "<b>", "</b>", " {} ", "<nav>{}</nav>", "<p>{}</p>"]) for _ in range(rng.randint(0, 14))]
            layouts.append("".join(parts))
        reference = wrappers.Page(layouts[0].replace("{}", "same"))
        before = len(weighed), len(outlined)
        for n in range(4):
            page = wrappers.Page(layouts[1].replace("{}", f"words {n}"))
            assert sorted(wrappers.align(page, reference, shapes)) == sorted(plain_matching(page, reference))
            if n == 0:
                first = len(weighed)
        assert len(weighed) == first and len(outlined) == before[1] + 5
    assert len(set(weighed)) == len(weighed) > 50


def test_shapes_forgotten_between_pages_change_nothing(monkeypatch):
    rows = [f"<div><h2>T {i}</h2>" + "<p>x</p>" * (i % 7) + f"<ul><li>{i}</ul><p>All rights</p></div>" for i in range(40)]
    batch = pa.RecordBatch.from_pydict({"host": ["h"] * 40, "html": rows, "reference": [rows[i % 3] for i in range(40)]})
    kept = next(wrappers._counts(iter([batch]))).to_pylist()
    monkeypatch.setattr(wrappers, "KEPT_PAIRS", 0)
    monkeypatch.setattr(wrappers, "KEPT_REFERENCES", 1)
    assert next(wrappers._counts(iter([batch]))).to_pylist() == kept != []


def test_white_space_of_blocks():
    pieces = ["a", "b\u3000c", " ", "  ", "\t", "\n", "\x0b\x0c\r", "\xa0", "\x1c", "\u2003"]
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        page = wrappers.Page(f"<p>{text}</p>")
        spaced = re.sub(r"[\x20\x09-\x0D\xa0]+", " ", text).strip(" ")
        assert page.main_text() == spaced
        assert [page.blank(n) for n, t in enumerate(page.tag) if t == "#text"] == [not spaced] * bool(text)


def test_references_are_found_without_shuffling_pages(spark, tmp_path, monkeypatch):
    """The smallest page_ids of the hosts are joined to the pages by broadcast; of repeated ones the least html is the reference."""
    rows = [page(i, "a.example", f"<div><p>Title {i}</p><p>All rights</p></div>") for i in range(6)] + [page(0, "a.example", "<p>another first page</p>")]
    joins = []
    run = wrappers.written
    monkeypatch.setattr(wrappers, "written", lambda df, purpose: joins.append((purpose, df._jdf.queryExecution().executedPlan().toString())) or run(df, purpose))
    got = wrappers.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    plans = dict(joins)
    assert "BroadcastHashJoin" in plans["references"] and "SortMergeJoin" not in plans["references"]
    assert sorted(r.text for r in got if r.page_id) == [f"Title {i}" for i in range(1, 6)]


def test_pages_of_the_table(spark):
    """On the given pages the main text is the article's blocks."""
    rows = QUERIES["op7_wrapper_induction"](spark, SMALL).join(spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html"), "page_id").collect()
    from html import unescape

    for r in rows:
        inside = re.search(r"<article>(.*?)(</article>|<footer>|$)", r.html, re.S).group(1)
        blocks = [re.sub(r"[\x20\x09-\x0D\xa0]+", " ", unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b)))).strip(" ") for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b), r.page_id
        assert r.n_chars == len(r.text)


def test_pipeline(spark):
    """Stages keep what they should, each judged on its own input."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, SMALL).cache()
        kept, before = {r.doc_id for r in out.collect()}, {r.doc_id: r.text for r in left.collect()}
        assert kept <= set(before)
        if name == "near_dedup":
            groups = near_duplicates.near_duplicates(left, 80)
            assert kept == {r.component_id for r in groups.collect()}
        if name == "decontaminate":
            items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
            assert set(before) - kept == {r.doc_id for r in decontamination.find_items(left, items).collect()}
        if name == "redact_personal_data":
            assert kept == set(before)
            assert out.where(F.col("n_chars") != F.length("text")).count() == 0
        left = out
    encoded = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in encoded.collect()} == {r.doc_id for r in left.collect()}


def test_items_and_shorter_texts_equal_sql(spark, tmp_path):
    """Texts that are an item less some words, an item with words around it, and one changed word, beside the SQL."""
    words, rng = vocabulary(77)
    items = [[rng.choice(words) for _ in range(n)] for n in (4, 9, 30, 60)]
    texts = []
    for item in items:
        n = len(item)
        texts += [item, item[:-1], item[1:], item[: n - n // 10], item[: n // 2], ["before"] + item + ["after"], item[: n // 2] + ["other"] + item[n // 2 + 1 :]]
    spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    import duckdb

    duck = duckdb.connect()
    for name in ("benchmark", "documents"):
        duck.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    got = sorted(tuple(r) for r in QUERIES["op5_benchmark_decontamination"](spark, str(tmp_path)).collect())
    want = sorted(duck.sql(ORACLE["op5_benchmark_decontamination"]).fetchall())
    assert [g[:2] for g in got] == [w[:2] for w in want] and all(abs(g[2] - w[2]) < 1e-12 for g, w in zip(got, want))
    assert (22, 3) in {g[:2] for g in got}
