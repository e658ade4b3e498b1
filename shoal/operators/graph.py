"""Random walks on weighted graphs."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.draws import uniform
from ..session import bucketed, stored, wide_partitions
from .sampling import bounds, bucket_of, crowded, in_line, unit_intervals, weighted_draws

#: Edges of a node that every draw at it may be compared with; nodes with more have buckets.
LIGHT = 256


def edges_of(df: DataFrame) -> DataFrame:
    """``src, dst, weight`` as string, string, double, by position."""
    a, b, w = df.columns[:3]
    return df.select(F.col(a).cast("string").alias("src"), F.col(b).cast("string").alias("dst"), F.col(w).cast("double").alias("weight"))


def both_ways(edges: DataFrame, directed: bool) -> DataFrame:
    if directed:
        return edges
    ends = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return edges.select(F.explode(ends).alias("e"), "weight").select("e.src", "e.dst", "weight")


def merged_edges(edges: DataFrame, directed: bool) -> DataFrame:
    """One row per directed edge, parallel edges added up."""
    return _summed(both_ways(edges, directed))


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def nodes_of(edges: DataFrame, kind: str) -> DataFrame:
    """Distinct start nodes, end nodes, or all."""
    if kind == "start":
        return edges.select(F.col("src").alias("node")).distinct()
    if kind == "end":
        return edges.select(F.col("dst").alias("node")).distinct()
    return edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()


def node_index(edges: DataFrame) -> DataFrame:
    """``node, index``: consecutive integers for all nodes."""
    from .cf import dense_ids

    return dense_ids(nodes_of(edges, "all"), "node", "index")


class Drawing(NamedTuple):
    """``nodes`` (``node``) with an edge out, ``leading`` those with one to a known node; ``drawn`` adds ``next, edges`` to rows with ``node, u``; ``known`` adds ``_known``, whether (one, two) is an edge."""

    nodes: DataFrame
    leading: DataFrame
    drawn: Callable[[DataFrame], DataFrame]
    known: Callable[[DataFrame, str, str], DataFrame]


@contextmanager
def drawing(rows: DataFrame, directed: bool) -> Iterator[Drawing]:
    """Tables for weighted steps from the edges ``src, dst, weight``, parallel ones added up on the way.

    Edges are shuffled once, by node, and stay there with their running sums; a draw is compared with the edges of its node.
    Nodes with more than LIGHT edges, and ends of a directed graph where a crowd arrives, have a guide table: buckets of
    equal probability, as many as edges in or out, an edge in each that its interval touches. A draw looks up one
    bucket, so a hub's visitors spread. Crowded nodes never lie in one task.
    """
    width = wide_partitions(rows.sparkSession)
    given = rows.where(F.col("src").isNotNull())
    big, busy = crowded(given, "src"), crowded(given, "dst") if directed else None
    usual = given if big is None else given.join(big, "src", "left_anti")
    lined = in_line(_summed(usual.repartition(width, "src")).where(F.col("weight") > 0))
    inside = (F.col("u") >= F.col("low")) & (F.col("u") < F.col("high"))

    with bucketed((lined, ["src"]), dealt=True) as (table,):
        nodes = table.select(F.col("src").alias("node")).distinct()
        # Rows without a start are nowhere met again: one walk of no steps.
        nodes = nodes.unionByName(_summed(rows.where(F.col("src").isNull())).where(F.col("weight") > 0).select(F.col("src").alias("node")).distinct())
        light, heavy = table.where(F.col("edges") <= LIGHT), table.where(F.col("edges") > LIGHT)
        if busy is not None:
            ends = busy.select(F.col("dst").alias("src"))
            heavy = heavy.unionByName(light.join(ends, "src", "left_semi").select(*table.columns))
            light = light.join(ends, "src", "left_anti")
        light = light.where(F.col("dst").isNotNull()).select("src", "dst", *bounds(), "edges")
        leading = table.where(F.col("dst").isNotNull()).select(F.col("src").alias("node")).distinct()
        if big is None and heavy.isEmpty():
            yield Drawing(nodes, leading, lambda frame: _beside(frame, light, inside),
                          lambda frame, one, two: _known(frame, light, one, two))
            return
        heavy = heavy.where(F.col("dst").isNotNull()).select("src", "dst", *bounds(), "edges")
        if big is not None:
            hubs = stored(_summed(given.join(big, "src", "left_semi")).where(F.col("weight") > 0).withColumn("weight", F.col("weight").cast("double")), "hubs")
            sizes = hubs.groupBy("src").agg(F.count("*").alias("edges"))
            heavy = heavy.unionByName(unit_intervals(hubs).join(sizes, "src").select("src", "dst", "low", "high", "edges"))
            nodes = nodes.unionByName(sizes.select(F.col("src").alias("node")))
            leading = leading.unionByName(hubs.where(F.col("dst").isNotNull()).select(F.col("src").alias("node")).distinct())
        heavy = stored(heavy, "heavy")
        counts = heavy.groupBy("src").agg(F.max("edges").alias("buckets"))
        if directed:
            into = given.where(F.col("weight") > 0).groupBy(F.col("dst").alias("src")).agg(F.count("*").alias("_in"))
            counts = counts.join(into, "src", "left").select("src", F.greatest("buckets", F.coalesce("_in", F.lit(0))).alias("buckets"))
        counts = stored(counts, "bucket-counts")
        touched = F.explode(F.sequence(*[bucket_of(F.col(c), F.col("buckets")) for c in ("low", "high")]))
        guide = heavy.join(counts, "src").select("src", touched.alias("bucket"), "low", "high", "dst", "edges")
        with bucketed((guide, ["src", "bucket"])) as (guided,):

            def drawn(frame: DataFrame) -> DataFrame:
                at = frame.join(counts.withColumnRenamed("src", "node"), "node").withColumn("bucket", bucket_of(F.col("u"), F.col("buckets")))
                found = at.join(guided.withColumnsRenamed({"src": "node", "dst": "next"}), ["node", "bucket"]).where(inside)
                return _beside(frame, light, inside).unionByName(found.select(*frame.columns, "next", "edges"))

            def known(frame: DataFrame, one: str, two: str) -> DataFrame:
                far = heavy.select(F.col("src").alias(one), F.col("dst").alias(two), F.lit(True).alias("_far"))
                both = _known(frame, light, one, two).join(far, [one, two], "left")
                return both.withColumn("_known", F.col("_known") | F.col("_far").isNotNull()).drop("_far")

            yield Drawing(nodes, leading, drawn, known)


def _beside(frame: DataFrame, light: DataFrame, inside: Column) -> DataFrame:
    """Draws go to the edges of their node; the table stays where it is."""
    edges = light.withColumnsRenamed({"src": "node", "dst": "next"})
    return frame.hint("shuffle_hash").join(edges, "node").where(inside).select(*frame.columns, "next", "edges")


def _known(frame: DataFrame, light: DataFrame, one: str, two: str) -> DataFrame:
    # Two bounds and no second key, so that the table is not shuffled by both.
    edges = light.select(F.col("src").alias("_src"), F.col("dst").alias("_dst"))
    same = (F.col(one) == F.col("_src")) & (F.col(two) >= F.col("_dst")) & (F.col(two) <= F.col("_dst"))
    return frame.hint("shuffle_hash").join(edges, same, "left").select(*frame.columns, F.col("_dst").isNotNull().alias("_known"))


def deep_walk(df: DataFrame, seq_length: int = 20, keep: str = "end", directed: bool = False, mode: str = "dfs",
              bfs_ratio: float = 0.5, seed=42) -> DataFrame:
    """``walk, pos, node``: one walk from every node with an edge out, as long rows in the order of ``pos``.

    seq_length + 1 steps, each to a neighbour drawn by edge weight. With mode
    ``dfs&bfs`` a step draws a second neighbour of the same node when its coin is
    at or above ``bfs_ratio`` and goes on from that. A walk that reaches a node
    without edges stops there. ``keep`` filters the nodes shown: the graph's
    start nodes, end nodes or all.

    A step is one equi join of the walks' heads with the tables of :func:`drawing`.
    Every step is stored, so the plan stays short and a lost executor costs one step.
    """
    edges = stored(edges_of(df), "edges")
    with drawing(both_ways(edges, directed), directed) as tables:

        def drawn(frame: DataFrame, label: str) -> DataFrame:
            return tables.drawn(frame.withColumn("u", uniform(seed, "walk", F.lit(label)))).drop("u", "edges")

        heads = stored(tables.nodes.select(F.col("node").alias("walk"), "node"), "heads")
        steps = [heads.select("walk", F.lit(0).alias("pos"), "node")]
        for step in range(seq_length + 1):
            moved = drawn(heads, f"{step}a")
            if mode == "dfs":
                heads = stored(moved.select("walk", F.col("next").alias("node")), "step")
                steps.append(heads.select("walk", F.lit(step + 1).alias("pos"), "node"))
                continue
            # The first neighbour is written before the second is drawn at the same node.
            moved = stored(moved.select("walk", "node", F.col("next").alias("first"),
                                        (uniform(seed, "walk", F.lit(f"{step}c")) < bfs_ratio).alias("_single")), "first")
            again = drawn(moved.where(~F.col("_single")), f"{step}b").select("walk", "first", F.col("next").alias("second"))
            single = moved.where("_single").select("walk", "first", F.lit(None).cast("string").alias("second"))
            state = stored(single.unionByName(again), "step")
            steps.append(state.select("walk", F.lit(2 * step + 1).alias("pos"), F.col("first").alias("node")))
            steps.append(state.where(F.col("second").isNotNull())
                         .select("walk", F.lit(2 * step + 2).alias("pos"), F.col("second").alias("node")))
            heads = state.select("walk", F.coalesce("second", "first").alias("node"))
    return _shown(reduce(DataFrame.unionByName, steps), edges, keep)


def _shown(walks: DataFrame, edges: DataFrame, keep: str) -> DataFrame:
    """Only the wanted node type; every walked node is in the graph, so ``all`` needs no filter."""
    return walks if keep == "all" else walks.join(nodes_of(edges, keep), "node", "left_semi").select("walk", "pos", "node")


def capped_neighbours(edges: DataFrame, max_neighbours: int, seed=42) -> DataFrame:
    """Edges where nodes with more than ``max_neighbours`` keep that many weighted draws with replacement.

    A neighbour drawn c times counts c-fold, as c parallel edges of its weight would.
    """
    degree = edges.groupBy("src").agg(F.count("*").alias("_n"))
    sized = edges.join(degree, "src")
    small = sized.where(F.col("_n") <= max_neighbours).drop("_n")
    large = sized.where(F.col("_n") > max_neighbours).drop("_n")
    chosen = (weighted_draws(large, max_neighbours, seed).groupBy("src", "dst").agg(F.count("*").alias("_c"))
              .join(large, ["src", "dst"]).select("src", "dst", (F.col("weight") * F.col("_c")).alias("weight")))
    return small.unionByName(chosen)


def second_order(edges: DataFrame, p: float = 1.0, q: float = 1.0) -> DataFrame:
    """``prev, cur, next, kind, weight``: unnormalised step weights after the edge prev → cur.

    ``back`` (to prev) weighs w/p, ``shared`` (a neighbour of prev) w, ``far`` w/q.
    """
    first = edges.select(F.col("src").alias("prev"), F.col("dst").alias("cur"))
    second = edges.select(F.col("src").alias("cur"), F.col("dst").alias("next"), "weight")
    known = edges.select(F.col("src").alias("prev"), F.col("dst").alias("next"), F.lit(True).alias("_known"))
    kind = (F.when(F.col("prev") == F.col("next"), "back").when(F.col("_known"), "shared").otherwise("far"))
    scale = F.when(F.col("kind") == "back", F.lit(1.0 / p)).when(F.col("kind") == "shared", F.lit(1.0)).otherwise(F.lit(1.0 / q))
    return (first.join(second, "cur").join(known, ["prev", "next"], "left").withColumn("kind", kind)
            .select("prev", "cur", "next", "kind", (F.col("weight") * scale).alias("weight")))


def closing(lists: DataFrame) -> DataFrame:
    """``corner, other, thirds``: one row per edge of a triangle's lowest corner, with all the nodes that close it.

    ``lists`` holds ``corner, others``, the ends of a node's edges in an order of the nodes. The list of ``other`` goes to ``corner``
    whole, so two edges of a corner are no row of their own.
    """
    asked = lists.where(F.size("others") > 1).select("corner", F.explode("others").alias("other"))
    beyond = lists.select(F.col("corner").alias("other"), F.col("others").alias("beyond"))
    met = asked.join(beyond, "other").join(lists, "corner").select("corner", "other", F.array_intersect("beyond", "others").alias("thirds"))
    return met.where(F.size("thirds") > 0)


def second_order_sums(edges: DataFrame, p: float = 1.0, q: float = 1.0) -> DataFrame:
    """``prev, cur, kind, n, weight``: :func:`second_order` added up by kind, without its rows; parallel edges are added up.

    ``back`` is the reverse edge. ``shared`` comes from triangles, each found once at its corner of lowest degree: edges
    run from the lower degree to the higher one, so that even a hub has at most sqrt(2 * edges) of them, and a corner gets
    the lists of those it leads to (:func:`closing`). ``far`` is what is left of the edges of ``cur``.
    Loops are handled apart: a loop of ``cur`` is shared with every ``prev``, and after a loop all other steps are shared.
    """
    from .cf import dense_ids

    # One row per pair of nodes, with the weights of its edges in both directions; a missing end stays where it is.
    down = F.coalesce(F.col("src") > F.col("dst"), F.lit(False))
    ties = stored(edges.groupBy(F.when(down, F.col("dst")).otherwise(F.col("src")).alias("a"), F.when(down, F.col("src")).otherwise(F.col("dst")).alias("b")).agg(
        F.sum(F.when(~down, F.col("weight"))).alias("ab"), F.sum(F.when(down, F.col("weight"))).alias("ba"),
        F.max(~down).alias("has_ab"), F.max(down).alias("has_ba")), "ties")
    between, loop = F.coalesce(F.col("a") != F.col("b"), F.lit(False)), F.coalesce(F.col("a") == F.col("b"), F.lit(False))
    ends = ties.select(between.alias("tie"), loop.alias("looped"), F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("has_ab").alias("out"), F.col("ab").alias("weight")),
        F.struct(F.col("b").alias("node"), F.col("has_ba").alias("out"), F.col("ba").alias("weight")))).alias("e")).select("tie", "looped", "e.*")
    nodes = stored(ends.where(F.col("node").isNotNull() & (F.col("tie") | F.col("out"))).groupBy("node").agg(
        F.count_if("tie").alias("d"), F.count_if("out").alias("all_n"), F.sum("weight").alias("all_weight"),
        F.max(F.when(F.col("looped"), F.col("weight"))).alias("loop"), F.max("looped").alias("looped")), "nodes")
    indexed = stored(nodes.drop("looped").join(dense_ids(nodes, "node", "id"), "node"), "indexed")
    side = lambda n: indexed.select(F.col("node").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in ("id", "d", "all_n", "all_weight", "loop")])
    turn = F.struct("d_a", "id_a") > F.struct("d_b", "id_b")
    sized = ties.where(between).join(side("a"), "a").join(side("b"), "b").withColumn("turn", turn)
    pick = lambda x, y: F.when(F.col("turn"), F.col(x)).otherwise(F.col(y))
    sized = stored(sized.withColumns({"corner": pick("id_b", "id_a"), "other": pick("id_a", "id_b")}).drop("id_a", "id_b", "d_a", "d_b"), "sized")
    lists = stored(sized.groupBy("corner").agg(F.collect_list("other").alias("others")), "lists")
    # Written before they are joined, so that Spark knows whether they are few.
    triangles = stored(closing(lists).select("corner", "other", F.explode("thirds").alias("third")), "triangles")
    weights = sized.select("corner", "other", pick("ba", "ab").alias("out"), pick("ab", "ba").alias("into"))
    # One look-up for the three sides of a triangle.
    x, y, z = "x", "y", "z"
    sides, corners = [(x, y), (x, z), (y, z)], triangles.toDF(x, y, z)
    asked = corners.select(x, y, z, F.explode(F.array(*[F.struct(F.col(u).alias("corner"), F.col(v).alias("other"), F.lit(u + v).alias("side"))
                                                        for u, v in sides])).alias("s")).select(x, y, z, "s.*")
    of = lambda u, v, c: F.max(F.when(F.col("side") == u + v, F.col(c)))
    weighed = asked.join(weights, ["corner", "other"]).groupBy(x, y, z).agg(
        *[of(u, v, "out").alias(u + v) for u, v in sides], *[of(u, v, "into").alias(v + u) for u, v in sides])
    weight = {(u, v): u + v for u in (x, y, z) for v in (x, y, z) if u != v}
    known = lambda *of: reduce(Column.__and__, [F.col(weight[e]).isNotNull() for e in of])
    step = F.explode(F.array(*[F.struct(F.col(u).alias("corner"), F.col(v).alias("other"),
                                        F.when(known((u, v), (u, w)), F.col(weight[v, w])).alias("up"),
                                        F.when(known((v, u), (v, w)), F.col(weight[u, w])).alias("down"))
                               for u, v, w in ((x, y, z), (x, z, y), (y, z, x))]))
    shared = stored(weighed.select(step.alias("s")).select("s.*").groupBy("corner", "other").agg(
        F.count("up").alias("up_n"), F.sum("up").alias("up_weight"), F.count("down").alias("down_n"), F.sum("down").alias("down_weight")), "shared")
    # Both directions of a pair of nodes: a step from the corner goes up.
    steps = sized.join(shared, ["corner", "other"], "left").select(F.explode(F.array(*[
        F.struct(F.col(u).alias("prev"), F.col(v).alias("cur"), F.col(f"has_{u}{v}").alias("has"), F.col(f"{v}{u}").alias("back"), n.alias("n"), w.alias("weight"),
                 *[F.col(f"{c}_{v}").alias(c) for c in ("all_n", "all_weight", "loop")])
        for u, v, n, w in (("a", "b", pick("down_n", "up_n"), pick("down_weight", "up_weight")),
                           ("b", "a", pick("up_n", "down_n"), pick("up_weight", "down_weight")))])).alias("s")).select("s.*").where("has")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    once = lambda c: F.when(F.col(c).isNotNull(), 1).otherwise(0)
    shared_n, shared_weight = zero("n") + once("loop"), zero("weight") + zero("loop")
    summed = steps.select("prev", "cur", F.array(
        F.struct(F.lit("back").alias("kind"), once("back").cast("long").alias("n"), zero("back").cast("double").alias("weight")),
        F.struct(F.lit("shared").alias("kind"), shared_n.cast("long").alias("n"), shared_weight.cast("double").alias("weight")),
        F.struct(F.lit("far").alias("kind"), (F.col("all_n") - once("back") - shared_n).cast("long").alias("n"),
                 (F.col("all_weight") - zero("back") - shared_weight).cast("double").alias("weight"))).alias("kinds"))
    after_loop = nodes.where("looped").select(F.col("node").alias("prev"), F.col("node").alias("cur"), F.array(
        F.struct(F.lit("back").alias("kind"), F.lit(1).cast("long").alias("n"), F.col("loop").cast("double").alias("weight")),
        F.struct(F.lit("shared").alias("kind"), (F.col("all_n") - 1).cast("long").alias("n"),
                 (F.col("all_weight") - F.col("loop")).cast("double").alias("weight"))).alias("kinds"))
    scale = F.when(F.col("k.kind") == "back", F.lit(1.0 / p)).when(F.col("k.kind") == "far", F.lit(1.0 / q)).otherwise(F.lit(1.0))
    return (summed.unionByName(after_loop).select("prev", "cur", F.explode("kinds").alias("k")).where(F.col("k.n") > 0)
            .select("prev", "cur", "k.kind", "k.n", (F.col("k.weight") * scale).alias("weight")))


def edge_probabilities(df: DataFrame, directed: bool = True, max_neighbours: int | None = None, p: float = 1.0,
                       q: float = 1.0, seed=42, summed: bool = False) -> DataFrame:
    """:func:`second_order`; with ``max_neighbours``, on the graph in which no node has more edges.

    ``summed`` gives :func:`second_order_sums`, which needs no row for each two edges of a hub.
    """
    if summed and max_neighbours is None:
        return second_order_sums(both_ways(edges_of(df), directed), p, q)
    graph = stored(merged_edges(edges_of(df), directed), "edges")
    graph = graph if max_neighbours is None else capped_neighbours(graph, max_neighbours, seed)
    return (second_order_sums if summed else second_order)(graph, p, q)


#: Draws of the first round for each walk; every further round draws so many times more.
FIRST_DRAWS, MORE_DRAWS = 4, 4


def node2vec_walks(df: DataFrame, seq_length: int = 5, keep: str = "end", directed: bool = True,
                   max_neighbours: int | None = None, p: float = 1.0, q: float = 1.0, seed=42) -> DataFrame:
    """``walk, pos, node``: walks whose steps depend on the last two nodes.

    The first step goes by edge weight, the seq_length steps after it by the second-order weights, by rejection: a
    target is drawn by edge weight alone from the guide table, and accepted with its factor (1/p back, 1 to a
    neighbour of the node before, 1/q elsewhere) divided by the largest of the three. That needs one look-up of (prev,
    target) and never all edges of a hub. Draws are numbered; a walk takes its first accepted one. Walks without one
    draw again, four times as often in each round, until all have moved; the only edge of a node needs no coin.
    """
    edges = stored(edges_of(df), "edges")
    rows = both_ways(edges, directed)
    if max_neighbours is not None:
        rows = stored(capped_neighbours(stored(_summed(rows), "edges"), max_neighbours, seed), "graph")
    back, shared, far = 1.0 / p, 1.0, 1.0 / q
    most = max(back, shared, far)
    # A graph whose nodes are capped has other edges in than out.
    with drawing(rows, directed or max_neighbours is not None) as tables:
        empty = F.lit(None).cast("string")
        heads = stored(tables.nodes.select(F.col("node").alias("walk"), empty.alias("prev"), "node"), "heads")
        steps = [heads.select("walk", F.lit(0).alias("pos"), "node")]
        alone = Window.partitionBy("walk")

        def moved(frame: DataFrame) -> DataFrame:
            return frame.select("walk", F.col("node").alias("prev"), F.col("next").alias("node"))

        for step in range(seq_length + 1):
            if step == 0:
                heads = stored(moved(tables.drawn(heads.withColumn("u", uniform(seed, "walk", F.lit(step), F.lit(0))))), "step")
            else:
                # A walk at a node without edges ends.
                waiting, first, many, done = heads.join(tables.leading, "node", "left_semi").select(*heads.columns), 0, FIRST_DRAWS, []
                waiting = stored(waiting, "heads")
                while not waiting.isEmpty():
                    # Walks go to their node before their draws multiply.
                    tried = (waiting.repartition(wide_partitions(edges.sparkSession), "node")
                             .withColumn("draw", F.explode(F.sequence(F.lit(first), F.lit(first + many - 1))))
                             .withColumn("u", uniform(seed, "walk", F.lit(step), "draw")))
                    coin = uniform(seed, "walk", F.lit(step), "draw", F.lit("coin")) * F.lit(most)
                    tried = tables.drawn(tried).withColumn("coin", coin).drop("u")
                    # Most draws are taken or refused whether or not (prev, next) is an edge; only what is before the first sure one is looked up.
                    least = F.when(F.col("next") == F.col("prev"), F.lit(back)).otherwise(F.lit(min(shared, far)))
                    best = F.when(F.col("next") == F.col("prev"), F.lit(back)).otherwise(F.lit(max(shared, far)))
                    tried = tried.withColumn("sure", (F.col("edges") == 1) | (F.col("coin") < least)).where(F.col("sure") | (F.col("coin") < best)).drop("edges")
                    tried = tried.withColumn("_first", F.min(F.when(F.col("sure"), F.col("draw"))).over(alone))
                    tried = stored(tried.where(F.col("_first").isNull() | (F.col("draw") <= F.col("_first"))).drop("_first"), "tried")
                    asked = tables.known(tried.where(~F.col("sure")), "prev", "next")
                    asked = asked.where(F.col("coin") < F.when(F.col("_known"), F.lit(shared)).otherwise(F.lit(far))).drop("_known")
                    taken = tried.where("sure").unionByName(asked)
                    chosen = taken.groupBy("walk").agg(F.min_by(F.struct("node", "next"), "draw").alias("s"))
                    done.append(stored(moved(chosen.select("walk", "s.*")), "accepted"))
                    waiting = stored(waiting.join(done[-1].select("walk"), "walk", "left_anti"), "waiting")
                    first, many = first + many, many * MORE_DRAWS
                heads = reduce(DataFrame.unionByName, done) if done else heads.limit(0)
            steps.append(heads.select("walk", F.lit(step + 1).alias("pos"), "node"))
    return _shown(reduce(DataFrame.unionByName, steps), edges, keep)


def paths(walks: DataFrame) -> DataFrame:
    """``walk, path``: the nodes of each walk in order, at most twice its steps."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "node")))
    return walks.groupBy("walk").agg(F.transform(ordered, lambda s: s["node"]).alias("path"))


def skip_gram_pairs(walks: DataFrame, window: int = 5) -> DataFrame:
    """``centre, context, offset`` of places at most ``window`` apart in ``walk, pos, node``.

    An equi join on (walk, place): no sequence is collected or cut, whatever its length.
    """
    offsets = F.explode(F.array(*[F.lit(k) for k in range(-window, window + 1) if k]))
    near = walks.select("walk", F.col("node").alias("centre"), F.col("pos").alias("_at"), offsets.alias("offset"))
    near = near.withColumn("pos", F.col("_at") + F.col("offset"))
    return near.join(walks.select("walk", "pos", F.col("node").alias("context")), ["walk", "pos"]).select("centre", "context", "offset")


def item_positions(df: DataFrame, user: str, item: str, order: str) -> DataFrame:
    """``walk, pos, node``: each user's items in time order, ties by item.

    ``order`` is a number. Places are counted inside slices of time, shifted by the
    slices before, so a busy user's items are ordered in different tasks. The slices'
    bounds share out the rows and do not change the places.
    """
    n = min(1024, wide_partitions(df.sparkSession))
    cut = df.agg(F.percentile_approx(order, [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else None
    bounds = F.array(*[F.lit(x) for x in sorted(set(cut or []))])
    sliced = df.withColumn("_slice", F.size(F.filter(bounds, lambda b: b <= F.col(order))) if cut else F.lit(0))
    earlier = Window.partitionBy(user).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (sliced.groupBy(user, "_slice").agg(F.count("*").alias("_n"))
              .select(user, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_shift")))
    place = F.row_number().over(Window.partitionBy(user, "_slice").orderBy(order, item)) - 1
    return (sliced.withColumn("_in", place).join(shifts, [user, "_slice"])
            .select(F.col(user).alias("walk"), (F.col("_shift") + F.col("_in")).cast("int").alias("pos"), F.col(item).cast("string").alias("node")))


def sentences(places: DataFrame, length: int) -> DataFrame:
    """``walk, path``: sequences as sentences of ``length`` nodes, which bound what one row holds."""
    chunk = F.floor(F.col("pos") / length)
    ordered = F.array_sort(F.collect_list(F.struct("pos", "node")))
    return places.groupBy("walk", chunk.alias("chunk")).agg(F.transform(ordered, lambda s: s["node"]).alias("path")).drop("chunk")


def bridges(places: DataFrame, length: int, window: int) -> DataFrame:
    """``walk, path``: two nodes each, the pairs at most ``window`` apart that cuts every ``length`` places part.

    With :func:`sentences` every pair of a sequence stands in exactly one sentence. ``length`` must be at least ``window``.
    """
    inside = F.col("pos") % length
    left = places.where(inside >= length - window).select("walk", (F.floor(F.col("pos") / length) + 1).alias("cut"),
                                                          F.col("pos").alias("_at"), F.col("node").alias("_left"))
    right = places.where((inside < window) & (F.col("pos") >= length)).select("walk", F.floor(F.col("pos") / length).alias("cut"), "pos", "node")
    near = left.join(right, ["walk", "cut"]).where(F.col("pos") - F.col("_at") <= window)
    return near.select("walk", F.array("_left", "node").alias("path"))


def word2vec_items(sequences: DataFrame, min_count: int, column: str = "path", size: int = 128, window: int = 5,
                   max_iter: int = 2, partitions: int | None = None, seed: int = 42) -> DataFrame:
    """``item, vector`` from item sequences, trained in as many tasks as a shuffle has.

    Items with fewer than ``min_count`` occurrences have no vector. No sentence is cut.
    """
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array

    longest = sequences.agg(F.max(F.size(column))).first()[0] or 1
    model = Word2Vec(vectorSize=size, minCount=min_count, windowSize=window, maxSentenceLength=max(longest, 1), maxIter=max_iter,
                     numPartitions=partitions or wide_partitions(sequences.sparkSession), seed=seed, inputCol=column,
                     outputCol="_v").fit(sequences)
    return model.getVectors().select(F.col("word").alias("item"), vector_to_array("vector").alias("vector"))


def item_vectors(df: DataFrame, user: str, item: str, order: str, min_count: int, size: int = 128, window: int = 5, max_iter: int = 2,
                 length: int = 1000, partitions: int | None = None, seed: int = 42) -> DataFrame:
    """``item, n, vector``: a vector for every item that occurs at least ``min_count`` times in the users' sequences.

    Rarer items leave the sequences before places are counted, so that their neighbours move together. Sequences are
    written as sentences of ``length`` places and the pairs across the cuts, so that no pair of a long one is lost.
    """
    rows = stored(df.select(user, F.col(item).cast("string").alias(item), order), "rows")
    counts = rows.groupBy(F.col(item).alias("item")).agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    common = rows.join(counts.select(F.col("item").alias(item)), item, "left_semi")
    places = stored(item_positions(common, user, item, order), "places")
    length = max(length, window)
    corpus = sentences(places, length).unionByName(bridges(places, length, window))
    vectors = word2vec_items(stored(corpus.select("path"), "sentences"), 0, size=size, window=window, max_iter=max_iter, partitions=partitions, seed=seed)
    return counts.join(vectors, "item")
