"""Connected components by alternating large-star and small-star contractions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

__all__ = ["connected_components"]


def _sign(e: DataFrame):
    r = e.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` of every node that a link names; the component is
    its smallest node.  Null ends and loops are no links; repeated links count
    once; an empty input gives no rows.

    Each round works on the links alone: every node learns its smallest
    neighbour (an aggregate with map-side combine), and hands it to its
    larger (large star), then to its smaller neighbours (small star).  The
    number of rounds grows with the logarithm of the longest path.  Each
    round's links are checkpointed; none reach the driver."""
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct()
    e = cut_lineage(e)
    last = _sign(e)
    for _ in range(max_rounds):
        if not last[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        m2 = big.groupBy("u").agg(F.min("v").alias("m"))
        small = big.join(m2, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u != v").distinct()
        e = cut_lineage(small)
        now = _sign(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
