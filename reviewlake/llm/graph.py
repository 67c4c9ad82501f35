"""Connected components of a table of links, by alternating large and small stars.

Every round is aggregates and joins on node ids; nothing but a count and a checksum per round reaches
the driver. A node with very many links is the hot side of a plain join, which Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.common import cut


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "at")
    joined = down.join(least, F.col("u") == F.col("at"))
    return joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
        least.select(F.col("at").alias("u"), F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link to another.

    ``links`` has two columns of ids. Null ends and links of a node to itself are left out.
    """
    stars = links.toDF("u", "v").filter("u != v").distinct()
    seen = None
    while True:
        stars = cut(_small_star(_large_star(stars)).filter("u != v").distinct(), "stars")
        row = stars.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 31)).alias("sum")).first()
        if (row["n"], row["sum"]) == seen or not row["n"]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = row["n"], row["sum"]
