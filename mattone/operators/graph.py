"""Similarity graph over ``nodes(id, text)`` and ``edges(src, dst, score)``: walks of two hops, or of any number.

Edges are directed and unique per (src, dst); the path queries walk them both ways.
A walk of two hops never uses one edge twice as long as it does not end where it
started, so ``hops`` needs no edge bookkeeping; ``walks`` and ``shortest_walks`` take one round per hop, each
written as a table, so that a lost executor repeats one round and no plan grows with the length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mattone.operators.joins import best_per_key, first_per_key
from mattone.session import work_folder

STRONG = 0.7


def _given(df: DataFrame, column: str) -> Column:
    """True where an id is set: not null, not empty, not zero."""
    empty = F.lit("") if isinstance(df.schema[column].dataType, T.StringType) else F.lit(0)
    return F.col(column).isNotNull() & (F.col(column) != empty)


def wide_to_edges(wide: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Rows (id_ref, id_similar_1, sim1, id_similar_2, sim2) to one edge per similar id that is set."""
    carried = order or []
    slots = F.array(
        *[
            F.struct(
                F.col("id_ref").alias("src"),
                F.when(_given(wide, f"id_similar_{i}"), F.col(f"id_similar_{i}")).alias("dst"),
                F.col(f"sim{i}").cast("double").alias("score"),
                F.lit(i).alias("slot"),
            )
            for i in (1, 2)
        ]
    )
    return wide.select(*carried, F.inline(slots)).where(F.col("dst").isNotNull())


def wide_to_nodes(wide: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The three nodes of each wide row; a null id makes no node."""
    carried = order or []
    names = [("id_ref", "text_ref"), ("id_similar_1", "text_similar_1"), ("id_similar_2", "text_similar_2")]
    slots = F.array(
        *[F.struct(F.col(i).alias("id"), F.col(t).alias("text"), F.lit(n).alias("slot")) for n, (i, t) in enumerate(names)]
    )
    return wide.select(*carried, F.inline(slots)).where(F.col("id").isNotNull())


def merge_nodes(existing: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    """Existing nodes untouched, plus the first row of each id they lack."""
    firsts = first_per_key(new.where(F.col("id").isNotNull()), "id", [F.col(c) for c in order])
    added = firsts.join(existing.select("id"), "id", "left_anti")
    return existing.select("id", "text").unionByName(added.select("id", "text"))


def merge_edges(existing: DataFrame, new: DataFrame, nodes: DataFrame, order: list[str]) -> DataFrame:
    """Existing edges with the last written score of each; an edge needs both its nodes."""
    latest = latest_edges(new, nodes, order)
    versions = existing.select("src", "dst", "score", F.lit(0).alias("_v")).unionByName(
        latest.select("src", "dst", "score", F.lit(1).alias("_v"))
    )
    return versions.groupBy("src", "dst").agg(F.max_by("score", "_v").alias("score"))


def latest_edges(new: DataFrame, nodes: DataFrame, order: list[str]) -> DataFrame:
    """The last written score of each edge whose two nodes exist."""
    latest = new.groupBy("src", "dst").agg(F.max_by("score", F.struct(*order)).alias("score"))
    ids = nodes.select("id")
    for end in ("src", "dst"):
        latest = latest.join(ids.withColumnRenamed("id", end), end, "left_semi")
    return latest.select("src", "dst", "score")


def steps(edges: DataFrame) -> DataFrame:
    """Every edge as a step (a, b) in both directions, a loop once; one pass over the edges."""
    there = F.struct(F.col("src").alias("a"), F.col("dst").alias("b"), "score", "src")
    back = F.struct(F.col("dst").alias("a"), F.col("src").alias("b"), "score", "src")
    return edges.select(F.inline(F.when(F.col("src") == F.col("dst"), F.array(there)).otherwise(F.array(there, back))))


def hops(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """All walks of one or two steps from the ids of ``starts`` to another node.

    The second join matches walks and steps on the middle node.  Where one middle
    node is hot, adaptive execution splits either side of this inner join; nothing
    is gathered per node.
    """
    s = steps(edges)
    first = s.join(starts.select(F.col("id").alias("a")).distinct(), "a", "left_semi").select(
        F.col("a").alias("start"), F.col("b").alias("mid"), F.col("score").alias("score1"), F.col("src").alias("via1")
    )
    one = first.where(F.col("mid") != F.col("start")).select(
        "start",
        F.col("mid").alias("node"),
        F.lit(1).alias("distance"),
        F.lit(None).cast(s.schema["a"].dataType).alias("mid"),
        "score1",
        F.lit(None).cast("double").alias("score2"),
        "via1",
        F.lit(None).cast(s.schema["a"].dataType).alias("via2"),
    )
    second = s.select(F.col("a").alias("mid"), F.col("b").alias("node"), F.col("score").alias("score2"), F.col("src").alias("via2"))
    two = first.join(second, "mid").where(F.col("node") != F.col("start"))
    return one.unionByName(two.withColumn("distance", F.lit(2)))


def _round(df: DataFrame) -> DataFrame:
    """The rows of one hop, stored for the next one."""
    path = work_folder(df.sparkSession, "walks")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _marked_steps(edges: DataFrame) -> DataFrame:
    """The steps with the edge each belongs to."""
    dst = F.when(F.col("src") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    return steps(edges).select("a", "b", "score", F.struct("src", dst.alias("dst")).alias("edge"))


def walks(edges: DataFrame, starts: DataFrame, most: int) -> DataFrame:
    """(start, node, distance, walk, scores): every walk of 1 to ``most`` steps from the ids of ``starts`` that uses no edge twice
    and ends elsewhere; ``walk`` lists the nodes on the way.

    All walks are listed, as many as there are; for the best or the nearest ones only, ask ``neighbourhood`` or ``shortest_walks``.
    """
    if most < 1:
        raise ValueError("a walk has at least one step")
    s = _marked_steps(edges)
    kinds = s.schema
    at = starts.select(F.col("id").alias("start")).distinct().select(
        "start",
        F.col("start").alias("node"),
        F.array("start").alias("walk"),
        F.array().cast(T.ArrayType(kinds["score"].dataType)).alias("scores"),
        F.array().cast(T.ArrayType(kinds["edge"].dataType)).alias("used"),
    )
    out = None
    for distance in range(1, most + 1):
        moved = at.join(s, F.col("node") == F.col("a")).where(~F.array_contains("used", F.col("edge")))
        at = _round(
            moved.select(
                "start",
                F.col("b").alias("node"),
                F.array_append("walk", F.col("b")).alias("walk"),
                F.array_append("scores", F.col("score")).alias("scores"),
                F.array_append("used", F.col("edge")).alias("used"),
            )
        )
        ended = at.where("node <> start").select("start", "node", F.lit(distance).alias("distance"), "walk", "scores")
        out = ended if out is None else out.unionByName(ended)
    return out


def shortest_walks(edges: DataFrame, starts: DataFrame, most: int) -> DataFrame:
    """(start, node, distance, walk, scores): one shortest walk of at most ``most`` steps per start and other node.

    Each round moves on only from the nodes first reached in the last one; of several ways to a node the one over the smallest node before
    it is kept, then over the smallest edge.  That choice is a minimum each task takes on its own rows first, so a hub costs as many rows
    as it has edges, once per start.  The rounds end early when nothing new is reached.
    """
    if most < 1:
        raise ValueError("a walk has at least one step")
    s = steps(edges).withColumnRenamed("src", "via")
    first = starts.select(F.col("id").alias("start")).distinct()
    none = F.array().cast(T.ArrayType(s.schema["score"].dataType))
    rounds = [_round(first.select("start", F.col("start").alias("node"), F.lit(0).alias("distance"), F.array("start").alias("walk"), none.alias("scores")))]
    for distance in range(1, most + 1):
        known = rounds[0].select("start", "node")
        for earlier in rounds[1:]:
            known = known.union(earlier.select("start", "node"))
        moved = rounds[-1].join(s, F.col("node") == F.col("a")).select(
            "start", F.col("b").alias("node"), F.struct(F.col("node").alias("before"), "via", "score", "walk", "scores").alias("way")
        )
        fresh = moved.join(known, ["start", "node"], "left_anti").groupBy("start", "node").agg(F.min("way").alias("way"))
        reached = _round(
            fresh.select(
                "start",
                "node",
                F.lit(distance).alias("distance"),
                F.array_append("way.walk", F.col("node")).alias("walk"),
                F.array_append("way.scores", F.col("way.score")).alias("scores"),
            )
        )
        if reached.isEmpty():
            break
        rounds.append(reached)
    out = rounds[0].where("distance > 0")
    for reached in rounds[1:]:
        out = out.unionByName(reached)
    return out


def strong_walks(nodes: DataFrame, edges: DataFrame, starts: DataFrame, above: float = STRONG, most: int = 2) -> DataFrame:
    """``shortest_walks`` over edges scored above the bound, between known nodes, with the text of the node reached."""
    found = shortest_walks(edges.where(F.col("score") > above), starts, most)
    return found.join(nodes.select(F.col("id").alias("node"), F.col("text").alias("node_text")), "node")


def neighbourhood(nodes: DataFrame, edges: DataFrame, starts: DataFrame, most: int = 2) -> DataFrame:
    """Best summed score per (start, node, distance) over walks of at most ``most`` steps, with the node's text."""
    if most == 2:
        total = F.when(F.col("distance") == 1, F.col("score1")).otherwise(F.col("score1") + F.col("score2"))
        scored = hops(edges, starts).select("start", "node", "distance", total.alias("total"))
    else:
        total = F.aggregate("scores", F.lit(0.0), lambda sum_, x: sum_ + x)
        scored = walks(edges, starts, most).select("start", "node", "distance", total.alias("total"))
    best = scored.groupBy("start", "node", "distance").agg(F.max("total").alias("score"))
    texts = nodes.select(F.col("id").alias("node"), "text")
    return best.join(texts, "node").select("start", "node", "text", "distance", "score")


def rank_neighbours(found: DataFrame) -> DataFrame:
    """Nearest first, best score first; an unknown score counts as the highest, node id breaks ties."""
    return found.orderBy(F.col("start"), *_ranking())


def _ranking() -> list[Column]:
    return [F.col("distance").asc(), F.col("score").desc_nulls_first(), F.col("node").asc()]


def best_neighbours(nodes: DataFrame, edges: DataFrame, starts: DataFrame, k: int, most: int = 2) -> DataFrame:
    """(start, node, text, distance, score, place): the first k rows of each start in the order of ``rank_neighbours``.

    Nearer rows come first, so a start that has k of them walks no further: a hub costs its own edges, not its whole reach.
    Each hop's rows are cut to k per start inside the tasks, and texts are read for the rows that stay.  A start with fewer than k
    rows has all of them; a node without a text of its own is walked through but is no row.
    """
    if most < 1 or k < 1:
        raise ValueError("a walk has at least one step, an answer at least one row")
    s = _marked_steps(edges)
    ids = nodes.select(F.col("id").alias("node"))
    at = starts.select(F.col("id").alias("start")).where(F.col("start").isNotNull()).distinct().select(
        "start", F.col("start").alias("node"), F.lit(0.0).alias("total"), F.array().cast(T.ArrayType(s.schema["edge"].dataType)).alias("used")
    )
    held = None
    for distance in range(1, most + 1):
        moved = at.join(s, F.col("node") == F.col("a")).where(~F.array_contains("used", F.col("edge")))
        at = _round(moved.select("start", F.col("b").alias("node"), (F.col("total") + F.col("score")).alias("total"), F.array_append("used", F.col("edge")).alias("used")))
        ended = at.where("node <> start").join(ids, "node", "left_semi")
        scored = ended.groupBy("start", "node").agg(F.max("total").alias("score")).withColumn("distance", F.lit(distance))
        reached = _round(best_per_key(scored, "start", _ranking(), k))
        held = reached if held is None else held.unionByName(reached)
        if distance < most:
            enough = held.groupBy("start").count().where(F.col("count") >= k)
            at = at.join(enough, "start", "left_anti")
    texts = nodes.select(F.col("id").alias("node"), "text")
    best = best_per_key(held, "start", _ranking(), k, "place")
    return best.join(texts, "node").select("start", "node", "text", "distance", "score", "place")


def strong_shortest_paths(nodes: DataFrame, edges: DataFrame, starts: DataFrame, above: float = STRONG) -> DataFrame:
    """One shortest walk per (start, other node) over edges scored above the bound.

    Among equally short walks the smallest middle node wins, then the smallest edges.
    The weak edges are dropped before the join, and the choice is a minimum that each
    task takes on its own rows first.
    """
    strong = edges.where(F.col("score") > above)
    rank = F.struct("distance", "mid", "via1", "via2", "score1", "score2")
    chosen = hops(strong, starts).groupBy("start", "node").agg(F.min(rank).alias("p"))
    flat = chosen.select("start", "node", "p.distance", "p.mid", "p.score1", "p.score2")

    def text_of(df: DataFrame, column: str, out: str) -> DataFrame:
        return df.join(nodes.select(F.col("id").alias(column), F.col("text").alias(out)), column)

    # Text of the starts comes through a table of starts, small when they are few.
    start_texts = text_of(starts.select(F.col("id").alias("start")).distinct(), "start", "start_text")
    ended = text_of(flat.join(start_texts, "start"), "node", "node_text")
    direct = ended.where(F.col("distance") == 1).withColumn("mid_text", F.lit(None).cast("string"))
    through = text_of(ended.where(F.col("distance") == 2), "mid", "mid_text")
    return direct.unionByName(through)


def as_paths(found: DataFrame) -> DataFrame:
    """Nested form: ``nodes`` as (id, text) in walking order, ``relationships`` as (score)."""

    def node(i: str, t: str) -> Column:
        return F.struct(F.col(i).alias("id"), F.col(t).alias("text"))

    def rel(s: str) -> Column:
        return F.struct(F.col(s).alias("score"))

    first, last = node("start", "start_text"), node("node", "node_text")
    direct = F.col("distance") == 1
    return found.select(
        "start",
        "node",
        F.when(direct, F.array(first, last)).otherwise(F.array(first, node("mid", "mid_text"), last)).alias("nodes"),
        F.when(direct, F.array(rel("score1"))).otherwise(F.array(rel("score1"), rel("score2"))).alias("relationships"),
    )
