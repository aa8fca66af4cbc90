"""Connected components of a link table, by large and small stars; nothing but counts comes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import materialise


def _directed(edges: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller end."""
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each linked node with the smallest node of its component: (node, comp).

    Links of a node with itself and repeated links change nothing; rows with a null end are left out. Each round's tables
    are written to the shared folder. The minima of stars are written before they are joined back, so that a star of any
    size can be split among tasks.
    """
    edges = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("u"), F.col(b).alias("v"))
    edges = materialise(_directed(edges), "cc-links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-least")
        large = materialise(_directed(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))), "cc-large")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        small = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        edges = materialise(_directed(small), "cc-small")
        now = _state(edges)
        if now == state:
            break
        state = now
    comps = edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return comps.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def joined_up(comps: DataFrame, links: DataFrame) -> DataFrame:
    """``comps`` (node, comp) after more ``links`` (a, b), written. Only the components that these join are worked on: the
    links between components are a graph of its own, and a small one where most is joined already."""
    ends = links
    for end in ("a", "b"):
        own = comps.select(F.col("node").alias(end), F.col("comp").alias(f"comp_{end}"))
        ends = ends.join(own, end, "left").withColumn(f"comp_{end}", F.coalesce(f"comp_{end}", end))
    between = materialise(ends.select("comp_a", "comp_b").filter("comp_a <> comp_b").distinct(), "cc-between")
    if between.isEmpty():
        return comps
    moved = materialise(connected_components(between, "comp_a", "comp_b"), "cc-moved")
    later = comps.join(moved.select(F.col("node").alias("comp"), F.col("comp").alias("later")), "comp", "left").select("node", F.coalesce("later", "comp").alias("comp"))
    return materialise(later.unionByName(moved.join(comps.select("node"), "node", "left_anti")), "cc-joined")
