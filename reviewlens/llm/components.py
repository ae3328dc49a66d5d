"""Connected components by repeated contraction, without holding a component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reviewlens.llm.common import written


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (``u``, ``v`` bigint); one root per component.

    Each round maps every node to the first of its closed neighbourhood in a fresh pseudo-random
    order and links the images; the number of nodes that still have links shrinks by a constant
    factor, so rounds grow with the logarithm of the nodes. Neighbourhoods are minima, combined
    before the shuffle, so a hub costs no more than its links. Links of a node to itself and
    repeats are ignored; no links give no rows.
    """
    left = written(links.select("u", "v").filter("u <> v").distinct(), "links")
    steps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.union(left.select("v", "u"))
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(len(steps))), F.col(c).alias("node"))
        first = both.groupBy(F.col("u").alias("node")).agg(F.min(order("v")).alias("_v"))
        first = first.select("node", F.least(order("node"), F.col("_v"))["node"].alias("root"))
        step = written(first, "step")
        steps.append(step)
        on_u = step.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        on_v = step.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        moved = left.join(on_u, "u").join(on_v, "v").filter("ru <> rv")
        left = written(
            moved.select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct(), "links"
        )
    if not steps:
        return left.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = steps[0]
    for step in steps[1:]:
        after = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(after, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
