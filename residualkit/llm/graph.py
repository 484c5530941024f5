"""Connected components by alternating large-star and small-star steps.

Each step is one aggregation (the smallest neighbour of every node, combined
before the shuffle) and one join of two written tables, so a node with very many
links is summed up early and its rows can be split over several tasks.
Every step is written to the checkpoint folder: the loop has no lineage, and
nothing but two numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from residualkit.staging import stage

Mark = tuple[int, int]


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` of every linked node; ``component`` is its smallest reachable node.

    ``links`` may hold pairs in any direction, repeated, and from a node to
    itself; pairs with a NULL end are ignored. Nodes without a link to another node are not
    returned. Raises if ``max_rounds`` do not suffice; the rounds needed grow
    with the logarithm of the longest chain.
    """
    x, y = F.col(a), F.col(b)
    usable = links.filter(x.isNotNull() & y.isNotNull() & (x != y))
    edges, before = _marked(usable.select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct(), "links")
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        edges, now = _small_star(_large_star(edges))
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("node"), "component").distinct())


def _marked(edges: DataFrame, label: str) -> tuple[DataFrame, Mark]:
    """Write edges and learn, while writing, how many they are and a sum over them that tells two sets apart."""
    seen = Observation()
    counted = edges.observe(
        seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
    )
    written = stage(counted, label)
    values = seen.get
    return written, (values["n"], int(values["h"] or 0))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours; pairs may repeat."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = stage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "smallest")
    linked = both.join(smallest, "u").filter("v > u and v <> m")
    return stage(linked.select(F.col("v").alias("u"), F.col("m").alias("v")), "large_star")


def _small_star(edges: DataFrame) -> tuple[DataFrame, Mark]:
    """Link a node and its smaller neighbours to the smallest of them."""
    smallest = stage(edges.groupBy("u").agg(F.min("v").alias("m")), "smallest")
    others = edges.join(smallest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _marked(smallest.select("u", F.col("m").alias("v")).unionByName(others).distinct(), "small_star")
