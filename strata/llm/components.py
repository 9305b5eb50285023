"""Connected components of an edge table by contraction.

Each round maps every edge to its end points' labels, hooks every label to
its smallest neighbour, and follows hooks to their roots by doubling; edges
inside a label disappear. A label only ever falls and the smallest id of a
component never hooks, so the last label is the component's smallest id.
Hubs are safe: minima are aggregated before the shuffle. Rounds are written
tables; the number of rounds grows with the logarithm of the diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import materialize


def _step(hooks: DataFrame) -> DataFrame:
    """Hooks followed two steps further."""
    nxt = hooks.toDF("to", "further")
    for _ in range(2):
        hooks = hooks.join(nxt, "to", "left").select("v", F.coalesce("further", "to").alias("to"))
    return hooks


def _roots(hooks: DataFrame) -> DataFrame:
    """(v, to) with ``to`` replaced by the end of its chain of hooks; every
    round at least triples the length of chain that is resolved."""
    while True:
        stepped = materialize(_step(hooks), "hooks")
        nxt = stepped.filter("v <> to").toDF("to", "further")
        if not stepped.join(nxt, "to", "left_semi").limit(1).count():
            return stepped
        hooks = stepped


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest id reachable, for every end point of
    an edge that is not a loop."""
    pairs = edges.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).filter("x <> y")
    live = materialize(pairs.union(pairs.select("y", "x")).distinct(), "edges")
    labels = None
    while live.limit(1).count():
        hooks = live.groupBy(F.col("x").alias("v")).agg(F.min("y").alias("y")) \
            .select("v", F.least("v", "y").alias("to"))
        roots = _roots(materialize(hooks, "hooks"))
        moved = (live.join(roots.toDF("x", "tx"), "x").join(roots.toDF("y", "ty"), "y")
                 .filter("tx <> ty").select(F.col("tx").alias("x"), F.col("ty").alias("y")))
        live = materialize(moved.distinct(), "edges")
        labels = roots.toDF("node", "component") if labels is None else materialize(
            labels.join(roots.toDF("component", "to"), "component", "left").select(
                "node", F.coalesce("to", "component").alias("component")), "labels")
    if labels is None:
        return pairs.toDF("node", "component").filter(F.lit(False))
    return labels
