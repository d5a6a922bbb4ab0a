"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import workspace
from .arrays import stored


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of `links`; the root is the least node of its component.

    Stars grow with the logarithm of the longest path.  Every step writes what each node sees of its neighbours,
    and then the new links, to the shared folder, so a lost executor costs one step.  It ends as soon as each
    node is a root or hangs on one, which what it sees tells.  A star that would change no link is left out.
    Nodes of any degree are joined, never collected.
    No links: no rows.  Null ends and links of a node to itself are left out.
    """
    root = workspace(links.sparkSession)
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col("u") != F.col("v"))
    step, large = 0, False
    while True:
        edges = stored(edges.distinct(), f"edges-{step}", root)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        seen = both.groupBy("u").agg(
            F.least("u", F.min("v")).alias("m"), F.count_if(F.col("v") < F.col("u")).alias("below"), F.count_if(F.col("v") > F.col("u")).alias("above")
        )
        seen = stored(seen, f"seen-{step}", root)
        # A node between others is changed by a large star, one above several by a small star.
        between, forked = seen.agg(F.max(F.expr("below > 0 AND above > 0")), F.max(F.expr("below > 1"))).first()
        if not between and not forked:
            return seen.select(F.col("u").alias("node"), F.col("m").alias("root"))
        step, large = step + 1, between and not (large and forked)
        least = seen.select("u", "m")
        if large:
            edges = edges.join(least.withColumnRenamed("u", "v"), "v").select("u", F.col("m").alias("v"))
        else:
            edges = (
                edges.join(least, "u")
                .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
                .select("e.*")
                .where("u != v")
            )
