"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.functions.lineage import discard, materialise


def components(links: DataFrame) -> DataFrame:
    """``node, root``: for each node of ``links`` (long columns ``a, b``) that is not itself the
    smallest of its component, that smallest node. Nodes missing here are their own root.

    Alternates large and small stars until the edges stand still; each round's edges are written to
    the shared folder, so a lost executor costs one round. Edges never multiply: a round makes
    at most one edge for each edge it reads. Self links, repeated links and rows with a null are
    allowed; no links give an empty result."""
    a, b = F.col("a"), F.col("b")
    edges = materialise(links.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    state = _state(edges)
    while state[0]:
        # Large star: the larger neighbours of a node move to the smallest of its neighbourhood.
        lowest = edges.groupBy(F.col("u").alias("v")).agg(F.min("v").alias("low"))
        moved = edges.join(lowest, "v", "left").select("u", F.coalesce("low", "v").alias("v"))
        # Small star: a node and its smaller neighbours move to the smallest of them.
        smallest = moved.groupBy("u").agg(F.min("v").alias("m"))
        pairs = moved.join(smallest, "u").select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        read, edges = edges, materialise(pairs.select("e.*").filter("u <> v").distinct())
        discard(read)
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple[int, int | None]:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return row["n"], row["x"]
