"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize


#: At most twice so many nodes have more than one of so many edges.
HOT_SHARE = 1000
#: Fewer edges are never hot.
HOT_EDGES = 100


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(edges: DataFrame, directed: DataFrame, name: str, n_edges: int) -> DataFrame:
    """Hang the ``v`` of ``edges`` onto the smallest neighbour of their ``u``.

    A ``u`` with more than one of ``HOT_SHARE`` edges is hot. Edges add up, so
    there are few such, and they are broadcast; their edges stay where they are.
    """
    lowest = directed.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("n"))
    lowest = lowest.select("u", F.least("u", "low").alias("low"), "n")
    is_hot = F.col("n") > F.lit(max(HOT_EDGES, 2 * n_edges // HOT_SHARE))
    marked = edges.join(F.broadcast(lowest.where(is_hot).select("u", "low")), "u", "left")
    rest = marked.where("low IS NULL").select("u", "v").join(lowest.where(~is_hot).select("u", "low"), "u")
    found = marked.where("low IS NOT NULL").select("u", "v", "low").unionByName(rest)
    hung = found.select(F.col("v").alias("u"), F.col("low").alias("v"))
    return materialize(hung.where("u != v").distinct(), name)


def components(links: DataFrame) -> DataFrame:
    """``(doc_id, component_id)`` for every document in ``links (a, b)``: the smallest id it can reach.

    Large and small stars in turn, until all links point to the smallest id of
    their component. Every round is a written table.
    """
    pairs = links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialize(pairs.distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        larger = both.where("v > u").unionByName(edges.select("u", F.col("u").alias("v")))
        edges = _star(larger, both, "large-star", state[0])
        # All neighbours are smaller now; the node itself hangs onto the smallest as well.
        own = edges.select("u", F.col("u").alias("v"))
        edges = _star(edges.unionByName(own).distinct(), edges, "small-star", state[0])
        state, before = _state(edges), state
        if state == before:
            break
    roots = edges.select(F.col("v").alias("doc_id"), F.col("v").alias("component_id")).distinct()
    return edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component_id")).unionByName(roots)
