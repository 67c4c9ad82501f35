"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Every source gets words in proportion to its weight, but never more than ``max_epochs`` times what it
holds; the excess of capped sources is shared among the others by weight, again and again, until no
source is above its cap. A source takes whole repetitions of all its documents and one fractional
repetition: a seeded order of its documents up to the remaining words. Documents are taken whole, so
a source misses its target by at most half of one document (the one at the cut).

Everything that is held per source is a row of a table; only the water level, one number a round,
passes through the driver. The seeded order is never sorted as a whole: it is cut into 4,096 buckets
whose sizes are summed, and only the bucket in which a source's cut falls is ordered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.llm.common import cut, registered, row_but, table, word_count

# The buckets of the seeded order: prefixes of three hexadecimal digits.
BUCKET_DIGITS = 3


def water_level(sources: DataFrame, max_epochs: float) -> float:
    """The level at which ``least(max_epochs * source_size, level * weight)`` adds up to all sizes.

    ``sources`` has ``source_size`` and ``weight``. Each round is one aggregate over one row per
    source. Infinite when every source is at its cap.
    """
    cap = F.col("source_size") * max_epochs
    level, capped = None, -1
    while True:
        full = F.lit(False) if level is None else cap <= F.col("weight") * level
        row = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(full, cap)), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("weight"),
            F.count_if(full).alias("n"),
        ).first()
        if row["n"] == capped:
            return level
        capped = row["n"]
        if not row["weight"]:
            return math.inf
        level = (row["total"] - row["held"]) / row["weight"]


def source_order(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank``, from 1, by code points of ``source``, null last.

    Ranges are ranked on their own and shifted by the counts of the ranges before them, so no task
    holds all sources.
    """
    by = F.col("source").asc_nulls_last()
    ranged = cut(sources.repartitionByRange(by).withColumn("part", F.spark_partition_id()), "sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = ranged.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("shift"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(by))
    return ranged.join(shift, "part").withColumn("rank", rank + F.col("shift")).drop("part", "shift")


def cyclic_weights(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """``sources`` with ``weight``: the given numbers, repeating, in the order of the sources."""
    of = F.array(*map(F.lit, weights))
    at = ((F.col("rank") - 1) % len(weights)).cast("int")
    return source_order(sources).withColumn("weight", F.get(of, at)).drop("rank")


def sample_key(id_column: str, seed: int) -> Column:
    """The place of a document in the seeded order, as hexadecimal text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("null"))))


def mix_sources(
    documents: DataFrame,
    weights: tuple[int, ...] | DataFrame,
    max_epochs: float = 3.0,
    seed: int = 11,
) -> DataFrame:
    """The documents with ``mix``: a struct of size, source_size, target, repeats and taken.

    ``weights``: numbers given to the sources in their order, repeating; or a table (source, weight).
    A source that the table lacks, or that has a null weight, weighs 0 and takes nothing.

    - Null text has size 0; a null source is a source like others; a null doc_id has one fixed place.
    - Rows with the same doc_id have the same place in the order and are taken alike.
    - Sizes of 0 everywhere, or no rows: all targets are 0. Other columns pass through unchanged.
    """
    key = sample_key("doc_id", seed)
    sized = documents.select("source", word_count(F.col("text")).alias("size"), key.alias("key"))
    buckets = cut(
        sized.groupBy("source", F.substring("key", 1, BUCKET_DIGITS).alias("bucket"))
        .agg(F.sum("size").alias("bucket_size")),
        "mix-buckets",
    )
    sources = buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("of"), F.col("weight").cast("double"))
        sources = sources.join(given, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        sources = cut(sources.fillna(0.0, ["weight"]), "mix-sources")
    else:
        sources = cut(cyclic_weights(sources, weights), "mix-sources")
    level = water_level(sources, max_epochs)
    target = F.least(F.col("source_size") * F.lit(float(max_epochs)), F.col("weight") * F.lit(level))
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(F.lit(0))
    aims = (
        sources.withColumn("target", F.when(F.col("weight") > 0, target).otherwise(F.lit(0.0)))
        .withColumn("whole", F.when(F.col("weight") > 0, whole).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    # The bucket of each source's cut, and what the buckets before it hold.
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = F.coalesce(F.sum("bucket_size").over(before), F.lit(0))
    named = aims.select(F.col("source").alias("of"), "rest")
    edge = (
        buckets.withColumn("held", held)
        .join(named, F.col("source").eqNullSafe(F.col("of")))
        .filter((F.col("held") <= F.col("rest")) & (F.col("rest") < F.col("held") + F.col("bucket_size")))
        .select("of", "rest", "held", F.col("bucket").alias("edge"))
    )
    # The last key taken within that bucket.
    running = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    inside = (
        sized.join(edge, F.col("source").eqNullSafe(F.col("of"))
                   & (F.substring("key", 1, BUCKET_DIGITS) == F.col("edge")))
        .groupBy("source", "rest", "held", "key").agg(F.sum("size").alias("size"))
        .withColumn("held", F.col("held") + F.coalesce(F.sum("size").over(running), F.lit(0)))
        .filter(F.col("held") + F.col("size") / 2 <= F.col("rest"))
        .groupBy("source").agg(F.max("key").alias("last"))
        .select(F.col("source").alias("within"), "last")
    )
    cuts = edge.join(inside, F.col("of").eqNullSafe(F.col("within")), "left").select(
        "of", F.coalesce("last", "edge").alias("last"))
    plan = cut(
        aims.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")
        .select(F.col("source").alias("mix_source"), "source_size", "target", "whole", "last"),
        "mix-plan",
    )
    size = word_count(F.col("text"))
    repeats = F.col("whole") + F.when(key <= F.col("last"), 1).otherwise(0)
    mixed = documents.select(row_but(documents, "mix"), "source", "doc_id", "text").join(
        plan, F.col("source").eqNullSafe(F.col("mix_source")))
    return mixed.select(
        "row.*",
        F.struct(size.alias("size"), "source_size", "target", repeats.alias("repeats"),
                 (size * repeats).alias("taken")).alias("mix"),
    )


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                  md5('11:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT source, source_size, source_size * CAST(3 AS DOUBLE) AS cap,
             CASE (r - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
p AS (SELECT *, cap / weight AS fills_at,
             (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
      FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT arg_min(level, fills_at) AS level FROM p WHERE fills_at > level),
t AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, weight * level) END AS target FROM w, l),
a AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
k AS (SELECT source, key, sum(size) AS size FROM d GROUP BY ALL),
c AS (SELECT source, key, size, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held FROM k),
x AS (SELECT c.source, key, held + c.size / 2 <= target - whole * source_size AS extra
      FROM c JOIN a ON c.source IS NOT DISTINCT FROM a.source)
SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, a.source_size, CAST(a.target AS DOUBLE) AS target,
       CAST(d.size * (a.whole + CAST(x.extra AS INT)) AS BIGINT) AS taken
FROM d JOIN a ON d.source IS NOT DISTINCT FROM a.source
JOIN x ON x.source IS NOT DISTINCT FROM d.source AND x.key = d.key
"""


@registered("op4_mix_sources", ORACLE)
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, sources weighing 5, 2, 1 in turn, at most three repetitions."""
    mixed = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), (5, 2, 1))
    return mixed.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")
