"""Transitive closure, reduction, levels and trees over edges (src, dst).

The closure doubles path lengths each round by joining the pairs that are new with
all pairs, on either side, so depth d takes about log2(d) rounds and no pair of old
pairs meets again; set semantics, and cycles end because a round that adds no pair
is the last. With one end given, :func:`reach` walks from it and never builds the
rest. Rounds are checkpointed, which cuts the plan.
"""

from __future__ import annotations

import tempfile
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint to the folder that the session names; a local session without one gets a temporary folder."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="eventweave-"))
    return df.checkpoint()


def closure(edges: DataFrame, rounds: int = 64, by: tuple[str, ...] = ()) -> DataFrame:
    """Distinct (src, dst) joined by a path of one edge or more. ``rounds`` doublings reach any depth that fits a table.

    Columns in ``by`` name the graph that an edge is of: a path stays in one graph, and all graphs take their rounds together.
    """
    ends = [*by, "src", "dst"]
    pairs = new = cut(edges.select(*ends).dropna(subset=["src", "dst"]).distinct())

    def step(a: DataFrame, b: DataFrame) -> DataFrame:
        met = a.select(*by, "src", F.col("dst").alias("via")).join(b.select(*by, F.col("src").alias("via"), "dst"), [*by, "via"])
        return met.select(*ends)

    for _ in range(rounds):
        far = step(new, pairs).unionByName(step(pairs, new)).distinct()
        new = cut(far.join(pairs, ends, "left_anti"))
        if new.isEmpty():
            return pairs
        pairs = cut(pairs.unionByName(new))
    raise RuntimeError(f"the closure did not settle in {rounds} rounds")


def reach(edges: DataFrame, seeds: DataFrame, backward: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """The closure's pairs (src, dst) whose src (``backward``: dst) is among the seeds (node): a walk of as many rounds as the longest path has edges.

    With ``by`` each graph is walked apart; seeds without these columns are seeds in every graph.
    """
    near, far = ("dst", "src") if backward else ("src", "dst")
    e = edges.select(*by, F.col(near).alias("near"), F.col(far).alias("far")).dropna(subset=["near", "far"]).distinct()
    own = [c for c in by if c in seeds.columns]
    front = seeds.select(*own, F.col("node").alias("seed"), F.col("node").alias("near")).distinct()
    if len(own) < len(by):
        front = front.join(e.select(*by, "near").distinct(), [*own, "near"]).select(*by, "seed", "near")
    seen = None
    while True:
        next_ = front.join(e, [*by, "near"]).select(*by, "seed", F.col("far").alias("near")).distinct()
        front = cut(next_ if seen is None else next_.join(seen, [*by, "seed", "near"], "left_anti"))
        if front.isEmpty():
            out = (front if seen is None else seen).select(*by, F.col("seed").alias(near), F.col("near").alias(far))
            return out.select(*by, "src", "dst")
        seen = front if seen is None else cut(seen.unionByName(front))


def transitive_reduction(edges: DataFrame) -> DataFrame:
    """The edges of an acyclic graph that no longer path implies."""
    e = edges.select("src", "dst").distinct()
    pairs = closure(e)
    implied = e.alias("a").join(pairs.alias("b"), F.col("a.dst") == F.col("b.src")).select(F.col("a.src").alias("src"), F.col("b.dst").alias("dst"))
    return e.join(implied.distinct(), ["src", "dst"], "left_anti")


def levels(edges: DataFrame) -> DataFrame:
    """(node, level) of an acyclic graph: the length of the longest path that ends at the node.

    Each round takes the nodes that nothing left leads to; if none is free while
    some are left, the graph has a cycle, which is an error.
    """
    rest = cut(edges.select("src", "dst").distinct())
    left = cut(rest.select(F.col("src").alias("node")).union(rest.select("dst")).distinct())
    out, level = None, 0
    while not left.isEmpty():
        free = cut(left.join(rest.select(F.col("dst").alias("node")).distinct(), "node", "left_anti"))
        if free.isEmpty():
            raise ValueError("the graph has a cycle")
        found = free.withColumn("level", F.lit(level))
        out = found if out is None else out.unionByName(found)
        left = cut(left.join(free, "node", "left_anti"))
        rest = cut(rest.join(free.withColumnRenamed("node", "src"), "src", "left_anti"))
        level += 1
    return left.withColumn("level", F.lit(0)) if out is None else out


def _walk(near: dict, a, b):
    """One step of a search at a time: None while it goes on, then whether it met ``b``."""
    seen, stack = {a}, [iter(near.get(a, ()))]
    while stack:
        x = next(stack[-1], None)
        if x is None:
            stack.pop()
        elif x == b:
            yield True
            return
        elif x not in seen:
            seen.add(x)
            stack.append(iter(near.get(x, ())))
        yield None
    yield False


def _reaches(below: dict, above: dict, a, b) -> bool:
    """Does a path lead from ``a`` to ``b``? Searched from both ends in turn; the first to end decides, so a node with many children costs no more than its ancestors."""
    if a == b:
        return True
    down, up = _walk(below, a, b), _walk(above, b, a)
    while True:
        for search in (up, down):
            found = next(search)
            if found is not None:
                return found


def _tree(pdf: pd.DataFrame, root: str) -> pd.DataFrame:
    """Insert edges by day unless their ends already reach each other, reduce, then prune from the newest."""
    below, above, days = {}, {}, {}  # nodes without children, or parents, have no entry

    def link(a, b):
        below.setdefault(a, {})[b] = None
        above.setdefault(b, {})[a] = None

    def cut_off(a, b):
        for near, x, y in ((below, a, b), (above, b, a)):
            del near[x][y]
            if not near[x]:
                del near[x]

    ordered = pdf.sort_values(["day", "src", "dst"])
    for a, b, day in zip(ordered["src"].tolist(), ordered["dst"].tolist(), ordered["day"].tolist(), strict=True):
        if a == b or _reaches(below, above, a, b) or _reaches(below, above, b, a):
            continue
        link(a, b)
        days[a, b] = day
    for a, b in list(days):
        cut_off(a, b)
        if _reaches(below, above, a, b):
            del days[a, b]
        else:
            link(a, b)
    parents = Counter(b for _, b in days)
    for (a, b), _ in sorted(days.items(), key=lambda x: (x[1], x[0]), reverse=True):
        if parents[b] > 1:
            cut_off(a, b)
            if _reaches(below, above, root, b):
                del days[a, b]
                parents[b] -= 1
            else:
                link(a, b)
    rows = [(a, b, d) for (a, b), d in days.items()]
    return pd.DataFrame(rows, columns=["src", "dst", "day"])


def label_graph(pairs: DataFrame, root: str) -> DataFrame:
    """(graph, src, dst, day): the distinct edges of pairs (graph, parent, topic, day) by first day, with an edge from ``root`` to each parent that is no topic."""
    edges = pairs.groupBy("graph", F.col("parent").alias("src"), F.col("topic").alias("dst")).agg(F.min("day").alias("day"))
    tops = edges.join(edges.select("graph", F.col("dst").alias("src")).distinct(), ["graph", "src"], "left_anti")
    heads = tops.groupBy("graph", F.col("src").alias("dst")).agg(F.min("day").alias("day")).select("graph", F.lit(root).alias("src"), "dst", "day")
    return edges.unionByName(heads)


def topic_trees(edges: DataFrame, root: str) -> DataFrame:
    """(graph, src, dst, day): an acyclic, pruned tree for each ``graph``.

    The order of insertion decides, so each graph is one task's work. Every edge is
    a search among the edges kept before it, from both ends at once: in trees and
    the like it costs the shorter of a node's ancestors and its descendants. Where
    both are many, each edge is a search through many.
    """

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        out = _tree(pdf, root)
        out.insert(0, "graph", pdf["graph"].iloc[0])
        return out

    return edges.select("graph", "src", "dst", "day").groupBy("graph").applyInPandas(grow, "graph string, src string, dst string, day date")
