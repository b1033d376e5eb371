"""Connected components of an undirected graph given as a table of links.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014): every round replaces links by as
many links to smaller nodes, until each component is a star around its
smallest node.  The links are written once a round; the driver sees one count
and one checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import written

#: Parts that the links of a node are dealt into, by the other node.
SALTS = 32


def _least(links: DataFrame) -> DataFrame:
    """``links`` (u, v) with ``low``, the least v of each u.

    The root of a large component has a link to every node in it, so a node's
    links meet in SALTS parts, and only the least of each part meets the others.
    """
    dealt = links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    parts = dealt.groupBy("u", "salt").agg(F.min("v").alias("part"))
    whole = parts.groupBy("u").agg(F.min("part").alias("low"))
    return dealt.join(parts.join(whole, "u").select("u", "salt", "low"), ["u", "salt"]).drop("salt")


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) of every node that has a link to another; the root is the
    smallest node of its component."""
    down = written(links.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = None
    while True:
        both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.least("low", "u").alias("v")).distinct()
        small = _least(large).select(F.explode(F.array(
            F.struct(F.col("u"), F.col("low").alias("v")), F.struct(F.col("v").alias("u"), F.col("low").alias("v"))))
            .alias("e")).select("e.u", "e.v").where("u != v").distinct()
        down = written(small, "links")
        now = tuple(down.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if now == before:
            return down.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                down.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
