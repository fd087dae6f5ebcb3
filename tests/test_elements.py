"""The element table against a stack, and its selectors."""

import random
import re

import pytest
from pyspark.sql import functions as F

from mattone.functions import elements as E
from mattone.functions.html import Node


def by_stack(html):
    """(begin, end, tag, depth) of every element, one stack per tag."""
    pieces = (html or "").split("<")
    open_, depth, out = {}, 0, []
    for at, piece in enumerate(pieces):
        name = at and re.match(r"/?([A-Za-z][A-Za-z0-9]*)(?=[\s>/])", piece)
        if not name:
            continue
        tag = name.group(1).lower()
        if piece.startswith("/"):
            depth -= 1
            if open_.get(tag):
                out[open_[tag].pop()][1] = at
        else:
            out.append([at, len(pieces), tag, depth + 1])
            if tag in E.VOID or re.match(r"[^>]*/>", piece):
                out[-1][1] = at
            else:
                open_.setdefault(tag, []).append(len(out) - 1)
                depth += 1
    return [tuple(e) for e in out]


def test_elements_against_a_stack(spark):
    """Nested, crossing, unclosed and stray tags, comparisons in the text, comments and void elements."""
    rng = random.Random(4)
    rows = [(0, None), (1, ""), (2, "p>no tag"), (3, "<p>"), (4, "</p></p><p>x</p>")]
    for k in range(5, 300):
        parts = []
        for _ in range(rng.randrange(0, 40)):
            tag = rng.choice(["p", "div", "LI", "br", "span"])
            parts.append(rng.choice([f"<{tag}>", f"</{tag}>", f"<{tag} class='a'>", "text ", "< b", "<!-- c -->", f"<{tag}/>"]))
        rows.append((k, "".join(parts)))
    table = E.with_elements(spark.createDataFrame(rows, "k int, html string"))
    got = {r.k: [tuple(e) for e in r.elements] for r in table.collect()}
    assert got == {k: by_stack(html) for k, html in rows}


def test_a_long_flat_page_and_a_deep_one(spark):
    rows = [(1, "<ul>" + "<li>x</li>" * 20_000 + "</ul>"), (2, "<div>" * 20_000 + "x" + "</div>" * 20_000)]
    table = E.with_elements(spark.createDataFrame(rows, "k int, html string"))
    got = {r.k: r for r in table.select("k", F.size("elements").alias("n"), F.array_max("elements.depth").alias("deep"), F.col("elements")[0].alias("first")).collect()}
    assert (got[1].n, got[1].deep, got[1].first.end) == (20_001, 2, 40_002)
    assert (got[2].n, got[2].deep, got[2].first.end) == (20_000, 20_000, 40_000)


def test_selectors(spark):
    html = '<div class="a b"><p>one<p id="x">two</p></p></div><p>three</p><div class="b"><span><p>four</p></span>'
    table = E.with_elements(spark.createDataFrame([(html,)], "html string"))

    def texts(path):
        found = E.select_path(table, path, "found")
        return found.select(F.transform("found", lambda e: E.text_of(e)).alias("t")).first().t

    assert texts((Node("p"),)) == ["one two", "two", "three", "four"]
    assert texts((Node("div", "class", "b"), Node("p"))) == ["one two", "two", "four"]
    assert texts((Node("div", "class", "a"), Node("p"))) == ["one two", "two"]
    assert texts((Node("div"), Node("span"), Node("p"))) == ["four"]
    whole = table.select(F.size(E.select(Node("div", "class", "b"), whole=True)).alias("n"), E.inside(E.first(Node("table"))).alias("none")).first()
    assert (whole.n, whole.none) == (1, "")
    assert "Python" not in table._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["page_elements", "element_path"])
def test_elements_of_pages_stay_in_their_row(spark, name):
    from conftest import SMALL
    from mattone.plans.queries import QUERIES

    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan
