"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydroflow.session import stored


def _toward_smallest(edges: DataFrame, by: str, to: str) -> DataFrame:
    """Edges (u, v) with the smallest neighbour ``m`` of their ``by`` end attached."""
    smallest = edges.groupBy(F.col(by).alias("at")).agg(F.min(to).alias("m"))
    return edges.join(smallest, F.col(by) == F.col("at"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node are tied to the smallest of all its neighbours."""
    down = edges.groupBy(F.col("u").alias("at")).agg(F.min("v").alias("m"))
    # The smallest neighbour of v is its own smallest smaller one, or v itself.
    joined = edges.join(down, F.col("v") == F.col("at"), "left")
    return joined.select("u", F.coalesce("m", "v").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours of a node, and the node itself, are tied to the smallest of them."""
    tied = _toward_smallest(edges, "u", "v")
    both = F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    return tied.select(F.inline(both)).filter("u != v").distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Rows (node, root) for every node that has a smaller one in its component; root is the smallest node.

    ``edges`` has two columns of one orderable type; NULLs and loops are left out, an empty table gives no rows.
    Each round is written to the shared folder, so that plans stay short and a lost executor costs one round. Hubs
    are aggregated before their shuffle, and joins toward a hub are split by the adaptive skew join.
    """
    pairs = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    current, seen = stored(pairs, "star"), None
    while True:
        state = current.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        current = stored(_small_star(_large_star(current)), "star")
