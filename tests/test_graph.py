"""Similarity graph against small examples and brute force."""

import random

import pytest
from pyspark.sql import functions as F

from mattone.operators import graph
from mattone.operators.joins import best_per_key
from mattone.sources import files
from mattone.session import work_folder


def make(spark, edges, ids=None):
    ids = ids if ids is not None else sorted({e for s, d, _ in edges for e in (s, d)})
    nodes = spark.createDataFrame([(i, f"text {i}") for i in ids], "id int, text string")
    return nodes, spark.createDataFrame(edges, "src int, dst int, score double")


def start(nodes, i):
    return nodes.where(F.col("id") == i).select("id")


def test_neighbourhood(spark):
    nodes, edges = make(spark, [(1, 2, 0.8), (2, 3, 0.9), (1, 3, 0.5)])
    found = graph.rank_neighbours(graph.neighbourhood(nodes, edges, start(nodes, 1))).collect()
    assert [(r.node, r.distance, round(r.score, 6)) for r in found] == [(2, 1, 0.8), (3, 1, 0.5), (3, 2, 1.7), (2, 2, 1.4)]
    assert found[0].text == "text 2"


def test_strong_shortest_paths(spark):
    nodes, edges = make(spark, [(1, 2, 0.8), (2, 3, 0.9), (1, 3, 0.7), (4, 1, 0.9), (3, 4, 0.95)])
    found = graph.strong_shortest_paths(nodes, edges, start(nodes, 1))
    assert {r.node: (r.distance, r.mid) for r in found.collect()} == {2: (1, None), 4: (1, None), 3: (2, 2)}
    path = {r.node: r for r in graph.as_paths(found).collect()}[3]
    assert [n.id for n in path.nodes] == [1, 2, 3] and [r.score for r in path.relationships] == [0.8, 0.9]
    out = work_folder(spark, "json")
    files.write_paths_json(graph.as_paths(found), out)
    assert spark.read.json(out).count() == 3


def brute(edges):
    """All walks of one or two edges, no edge twice, end other than start."""
    best, short = {}, {}
    ends = {e for s, d, _ in edges for e in (s, d)}
    step = lambda n: [(i, d if s == n else s) for i, (s, d, _) in enumerate(edges) if n in (s, d)]
    for a in ends:
        for e1, m in step(a):
            walks = [((e1,), m)] + [((e1, e2), b) for e2, b in step(m) if e2 != e1]
            for walk, b in walks:
                if b == a:
                    continue
                scores = [edges[e][2] for e in walk]
                total = None if None in scores else sum(scores)
                key = (a, b, len(walk))
                known = best.get(key)
                best[key] = total if known is None else known if total is None else max(known, total)
                if all(s is not None and s > 0.7 for s in scores):
                    short[a, b] = min(short.get((a, b), 9), len(walk))
    return best, short


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    pairs = {(rnd.randrange(9), rnd.randrange(9)) for _ in range(25)}
    edges = [(s, d, rnd.choice([None, round(rnd.random(), 2), 0.9])) for s, d in sorted(pairs)]
    nodes, table = make(spark, edges)
    best, short = brute(edges)
    found = {(r.start, r.node, r.distance): r.score for r in graph.neighbourhood(nodes, table, nodes).collect()}
    assert found.keys() == best.keys()
    assert all(found[k] == pytest.approx(best[k]) for k in best)
    paths = graph.strong_shortest_paths(nodes, table, nodes)
    assert {(r.start, r.node): r.distance for r in paths.collect()} == short
    one = graph.neighbourhood(nodes, table, start(nodes, edges[0][0]))
    assert {(r.start, r.node, r.distance): r.score for r in one.collect()} == {k: v for k, v in found.items() if k[0] == edges[0][0]}


def test_a_hot_middle_node_is_split(spark):
    """One node holds nearly all edges; adaptive execution must cut its join partition up."""
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        for n, v in names.items():
            spark.conf.set(n, v)
        spokes = spark.range(1, 3001, 1, 8).select(
            F.col("id").cast("int").alias("src"), F.lit(0).alias("dst"), F.lit(0.5).alias("score")
        )
        nodes = spark.range(0, 3001).select(F.col("id").cast("int").alias("id"), F.lit("t").alias("text"))
        starts = nodes.where("id < 3")
        found = graph.neighbourhood(nodes, spokes, starts)
        # 0 reaches every spoke; 1 and 2 reach 0 and, through it, every other spoke.
        assert len(found.collect()) == 3000 + 2 * (1 + 2999)
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, v in before.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def test_wide_rows(spark):
    shape = "id_ref string, text_ref string, id_similar_1 string, text_similar_1 string, sim1 double, id_similar_2 string, text_similar_2 string, sim2 double"
    wide = spark.createDataFrame([("1", "one", "2", "two", 0.85, "3", "three", 0.9), ("2", "zwei", "", "", 0.1, None, None, None)], shape)
    assert [(r.src, r.dst, r.score) for r in graph.wide_to_edges(wide).collect()] == [("1", "2", 0.85), ("1", "3", 0.9)]
    nodes = graph.wide_to_nodes(wide.withColumn("row", F.col("id_ref").cast("int")), ["row"])
    known = spark.createDataFrame([("1", "uno")], "id string, text string")
    merged = {r.id: r.text for r in graph.merge_nodes(known, nodes.where("id <> ''"), ["row", "slot"]).collect()}
    assert merged == {"1": "uno", "2": "two", "3": "three"}


def test_merge_edges(spark):
    nodes, old = make(spark, [(1, 2, 0.8), (2, 3, 0.1)])
    new = spark.createDataFrame([(1, 2, 0.7, 1), (1, 2, 0.9, 2), (2, 1, 0.5, 3), (1, 9, 0.4, 4)], "src int, dst int, score double, at int")
    merged = {(r.src, r.dst): r.score for r in graph.merge_edges(old, new, nodes, ["at"]).collect()}
    assert merged == {(1, 2): 0.9, (2, 3): 0.1, (2, 1): 0.5}


def far(edges, start, most):
    """All walks without an edge twice, as (nodes, scores)."""
    out, at = [], [((start,), (), frozenset())]
    for _ in range(most):
        moved = []
        for nodes, scores, used in at:
            for i, (a, b, score) in enumerate(edges):
                if i not in used and nodes[-1] in (a, b):
                    moved.append(((*nodes, b if nodes[-1] == a else a), (*scores, score), used | {i}))
        at = moved
        out += [(n, s) for n, s, _ in at if n[-1] != start]
    return out


@pytest.mark.parametrize("most", [1, 2, 3, 5])
def test_walks_of_any_length(spark, most):
    rnd = random.Random(most)
    pairs = sorted({(rnd.randrange(7), rnd.randrange(7)) for _ in range(11)})
    edges = [(s, d, round(rnd.random(), 2)) for s, d in pairs]
    nodes, table = make(spark, edges)
    ids = [r.id for r in nodes.collect()]
    want = sorted((i, n[-1], len(s), n, s) for i in ids for n, s in far(edges, i, most))
    got = graph.walks(table, nodes, most).collect()
    assert sorted((r.start, r.node, r.distance, tuple(r.walk), tuple(r.scores)) for r in got) == want
    best = {}
    for i, node, distance, _, scores in want:
        best[i, node, distance] = max(best.get((i, node, distance), 0), sum(scores))
    found = {(r.start, r.node, r.distance): r.score for r in graph.neighbourhood(nodes, table, nodes, most).collect()}
    assert found.keys() == best.keys() and all(found[k] == pytest.approx(best[k]) for k in best)
    short = {}
    for i, node, distance, walk, _ in want:
        short[i, node] = min(short.get((i, node), (99,)), (distance,))
    near = {(r.start, r.node): r for r in graph.shortest_walks(table, nodes, most).collect()}
    assert {k: (r.distance,) for k, r in near.items()} == short
    for (i, node), r in near.items():
        before = [w[-2] for a, b, d, w, _ in want if (a, b, d) == (i, node, r.distance)]
        assert r.walk[0] == i and r.walk[-1] == node and r.walk[-2] == min(before) and len(r.scores) == r.distance


def test_a_hub_is_walked_once(spark):
    """A hub with thousands of leaves and a tail behind it: each node is reached once, none is listed per pair of leaves."""
    edges = [(0, leaf, 0.9) for leaf in range(1, 3001)] + [(0, 5000, 0.8), (5000, 5001, 0.8), (5001, 5002, 0.8)]
    nodes, table = make(spark, edges)
    got = graph.shortest_walks(table, start(nodes, 1), 6).groupBy("distance").count().collect()
    assert {r.distance: r["count"] for r in got} == {1: 1, 2: 3000, 3: 1, 4: 1}
    with pytest.raises(ValueError):
        graph.shortest_walks(table, start(nodes, 1), 0)


@pytest.mark.parametrize("k, most", [(1, 1), (2, 2), (3, 3), (50, 4)])
def test_best_neighbours_are_the_head_of_the_ranking(spark, k, most):
    rnd = random.Random(10 * k + most)
    pairs = sorted({(rnd.randrange(9), rnd.randrange(9)) for _ in range(14)})
    nodes, table = make(spark, [(s, d, None if n % 5 == 0 else round(rnd.random(), 1)) for n, (s, d) in enumerate(pairs)])
    nodes = nodes.where("id <> 3")
    want = {}
    for r in graph.rank_neighbours(graph.neighbourhood(nodes, table, nodes, most)).collect():
        rows = want.setdefault(r.start, [])
        if len(rows) < k:
            rows.append((r.node, r.text, r.distance, r.score, len(rows) + 1))
    got = {}
    for r in graph.best_neighbours(nodes, table, nodes, k, most).orderBy("start", "place").collect():
        got.setdefault(r.start, []).append((r.node, r.text, r.distance, r.score, r.place))
    plain = lambda rows: [tuple(round(x, 9) if isinstance(x, float) else x for x in row) for row in rows]
    assert {i: plain(rows) for i, rows in got.items()} == {i: plain(rows) for i, rows in want.items()}


def test_best_per_key_is_cut_inside_the_tasks(spark):
    df = spark.range(1000).selectExpr("id % 3 AS a", "id")
    best = best_per_key(df, "a", [F.col("id").desc()], 2)
    plan = best._jdf.queryExecution().sparkPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert sorted((r.a, r.id) for r in best.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]


def test_starts_that_have_enough_walk_no_further(spark, monkeypatch):
    """A hub with many leaves that lead on: its first k rows are found without walking from any leaf."""
    edges = [(0, leaf, leaf / 1000) for leaf in range(1, 501)] + [(leaf, 1000 + leaf, 0.5) for leaf in range(1, 501)]
    nodes, table = make(spark, edges)
    rounds, kept = [], graph._round
    monkeypatch.setattr(graph, "_round", lambda df: rounds.append(kept(df)) or rounds[-1])
    found = graph.best_neighbours(nodes, table, start(nodes, 0), 3, 4).orderBy("place").collect()
    assert [(r.node, r.distance) for r in found] == [(500, 1), (499, 1), (498, 1)]
    assert [df.count() for df in rounds] == [500, 3, 0, 0, 0, 0, 0, 0]
