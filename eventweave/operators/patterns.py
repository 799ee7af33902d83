"""Graph patterns over a triples DataFrame (s, p, o): each builds a logical plan that Catalyst orders and distributes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventweave.operators.closure import closure, reach


def triple(t: DataFrame, predicate: str, s: str, o: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The (s, o) pairs of a predicate under the variables' names.

    Columns in ``by`` say which graph a triple is of and are kept in every pattern, so that joins on common columns stay in one graph.
    """
    return t.where(F.col("p") == predicate).select(*by, F.col("s").alias(s), F.col("o").alias(o))


def of_type(t: DataFrame, kind: str, s: str) -> DataFrame:
    """Distinct subjects of a class."""
    return t.where((F.col("p") == "type") & (F.col("o") == kind)).select(F.col("s").alias(s)).distinct()


def both(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the variables that the two have in common (bag semantics); without any, each solution meets each, as the algebra says."""
    keys = [c for c in a.columns if c in b.columns]
    return a.join(b, keys or F.lit(True), how)


def bgp(*parts: DataFrame) -> DataFrame:
    return reduce(both, parts)


def optional(a: DataFrame, *group: DataFrame) -> DataFrame:
    """The group's patterns are joined first, then attached where they match."""
    return both(a, bgp(*group), "left")


def not_exists(a: DataFrame, b: DataFrame) -> DataFrame:
    return both(a, b, "left_anti")


def exists_flag(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
    keys = [c for c in a.columns if c in b.columns]
    return a.join(b.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def union(*parts: DataFrame) -> DataFrame:
    """Bag union; variables that a branch lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def sequence(t: DataFrame, predicates: list[str], s: str, o: str) -> DataFrame:
    """p1/p2/...: a join chain over fresh variables, one row for each path."""
    out = triple(t, predicates[0], s, "v0_")
    for i, p in enumerate(predicates[1:]):
        out = both(out, triple(t, p, f"v{i}_", f"v{i + 1}_"))
    return out.select(s, F.col(f"v{len(predicates) - 1}_").alias(o))


def plus(t: DataFrame, predicate: str, s: str, o: str, start: DataFrame | None = None, end: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """p+: distinct pairs over one step or more. With nodes (one column beside those of ``by``) to ``start`` from or to ``end`` at, only these are walked."""
    edges = triple(t, predicate, "src", "dst", by)
    if start is None and end is None:
        pairs = closure(edges, by=by)
    else:
        seeds = start if start is not None else end
        pairs = reach(edges, _nodes(seeds, "node", by), backward=start is None, by=by)
    return pairs.select(*by, F.col("src").alias(s), F.col("dst").alias(o))


def _nodes(nodes: DataFrame, name: str, by: tuple[str, ...]) -> DataFrame:
    own = [c for c in by if c in nodes.columns]
    return nodes.select(*own, F.col(next(c for c in nodes.columns if c not in by)).alias(name)).distinct()


def _selves(nodes: DataFrame, s: str, o: str, by: tuple[str, ...], t: DataFrame) -> DataFrame:
    """Each node with itself, in every graph if the nodes name none."""
    own = _nodes(nodes, s, by)
    if any(c not in own.columns for c in by):
        own = own.crossJoin(t.select(*by).distinct())
    return own.select(*by, s, F.col(s).alias(o))


def star(
    t: DataFrame, predicate: str, s: str, o: str, nodes: DataFrame, start: DataFrame | None = None, end: DataFrame | None = None, by: tuple[str, ...] = ()
) -> DataFrame:
    """p*: p+ and every node (one column) with itself; a ``start`` or ``end`` stands for all nodes."""
    given = start if start is not None else end if end is not None else nodes
    return plus(t, predicate, s, o, start, end, by).unionByName(_selves(given, s, o, by, t)).distinct()


def maybe(
    t: DataFrame, predicate: str, s: str, o: str, nodes: DataFrame, start: DataFrame | None = None, end: DataFrame | None = None, by: tuple[str, ...] = ()
) -> DataFrame:
    """p?: one step or none; a ``start`` or ``end`` stands for all nodes."""
    step = triple(t, predicate, s, o, by)
    for nodes_, c in ((start, s), (end, o)):
        if nodes_ is not None:
            step = step.join(_nodes(nodes_, c, by), [*(k for k in by if k in nodes_.columns), c], "left_semi")
    given = start if start is not None else end if end is not None else nodes
    return step.unionByName(_selves(given, s, o, by, t)).distinct()


def arg_min(df: DataFrame, keys: list[str], order: list[Column], keep: list[str]) -> DataFrame:
    """Of each key's rows the one with the least ``order``: one partial aggregate, no sort of the groups."""
    row = F.struct(*[c.alias(f"o{i}_") for i, c in enumerate(order)], *keep)
    return df.groupBy(*keys).agg(F.min(row).alias("row_")).select(*keys, *[F.col(f"row_.{c}").alias(c) for c in keep])
