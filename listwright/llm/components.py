"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listwright.llm import worker
from listwright.session import cut_lineage


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("l")).select("l.a", "l.b")


def _to_least(sides: DataFrame, above: bool, links: int) -> DataFrame:
    """Hangs nodes on the least node next to `a`: those above `a`, or those up to `a`.

    `links` is their number. The table of least nodes is no longer than twice
    that; it is broadcast while it is short. Beyond that it is written first,
    so that the join shuffles both sides anew and AQE can split a node with
    very many neighbours.
    """
    if not above:
        sides = sides.where("b < a")
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("at"), F.least("at", "m").alias("m"))
    least = F.broadcast(least) if 2 * links <= worker.BROADCAST_ROWS else cut_lineage(least)
    joined = sides.join(least, F.col("a") == F.col("at"))
    if above:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select(F.col("at").alias("a"), F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of `links(a, b)` reaches.

    Every round hangs the larger neighbours of each node on the least of them
    and then does the same among the smaller ones; links only ever move
    towards smaller nodes, the number of rounds grows with the logarithm of
    the longest path, and all links end at their component's least node. Links
    to oneself and repeated links change nothing; a null end drops the link;
    no links give no rows.
    """
    edges = cut_lineage(links.where("a != b").select("a", "b").distinct())
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == state or not now["n"]:
            break
        state = now
        edges = cut_lineage(_to_least(_to_least(_both_ways(edges), True, now["n"]), False, now["n"]))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
