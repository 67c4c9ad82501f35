"""Approximate nearest neighbours by an adaptive scan of dimensions.

Vectors are rotated at random and stored by column blocks in the inverted lists of a coarse index. A
query first scans its two nearest lists whole and so learns how near its tenth neighbour is at most.
In the other lists it probes, partial distances grow block by block; after each block a hypothesis test
asks whether the whole distance can still be within that bound, and candidates that fail are abandoned.
What is left is measured exactly on the original vectors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.llm.common import cut, registered, table
from reviewlake.llm.vectors import dimension, k_means, list_count, matrix, meet, sample, squared, usable, with_lists

BLOCK = 16
# The test's width: a partial distance is trusted up to this many deviations.
WIDTH = 2.1


def rotation(d: int, seed: int = 9) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def surviving(query: np.ndarray, blocks: list[np.ndarray], bound: float, d: int) -> np.ndarray:
    """Rows that no test abandons. ``blocks``: the rotated members, dimensions in rows."""
    alive = np.arange(blocks[0].shape[1])
    partial, seen = np.zeros(len(alive)), 0
    for block in blocks:
        part = block[:, alive] - query[seen:seen + len(block), None]
        partial = partial + np.einsum("ij,ij->j", part, part)
        seen += len(block)
        limit = bound * bound if seen == d else bound * bound * seen / d * (1 + WIDTH / np.sqrt(seen)) ** 2
        keep = partial <= limit * (1 + 1e-9)
        alive, partial = alive[keep], partial[keep]
        if not len(alive):
            break
    return alive


def _scan(turn: np.ndarray, d: int, k: int):
    def work(members: pa.Table, queries: pa.Table) -> pa.Table:
        q1, q2, c1, c2, far = [], [], [], [], []
        if members.num_rows and queries.num_rows:
            y, least = matrix(members["embedding"], d), members["least"].to_numpy()
            # Column blocks: a block holds some dimensions of all members of the chunk.
            turned = np.ascontiguousarray((y @ turn).T)
            blocks = [turned[i:i + BLOCK] for i in range(0, d, BLOCK)]
            x = matrix(queries["embedding"], d)
            bounds = queries["bound"].to_numpy(zero_copy_only=False)
            keys = [t[c].to_numpy() for t in (queries, members) for c in ("k1", "k2")]
            for i, (own, rotated) in enumerate(zip(x, x @ turn, strict=True)):
                near = surviving(rotated, blocks, bounds[i], d)
                exact = np.sqrt(((y[near] - own) ** 2).sum(1))
                best = np.lexsort((least[near], exact))[:k]
                rows = near[best]
                q1.append(np.full(len(rows), keys[0][i]))
                q2.append(np.full(len(rows), keys[1][i]))
                c1.append(keys[2][rows])
                c2.append(keys[3][rows])
                far.append(exact[best])
        join = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)
        return pa.table({"q1": join(q1, np.int64), "q2": join(q2, np.int64), "c1": join(c1, np.int64),
                         "c2": join(c2, np.int64), "score": join(far, np.float64)})

    return work


FOUND = "q1 long, q2 long, c1 long, c2 long, score double"


def nearest(embeddings: DataFrame, queries: DataFrame, k: int = 10, probe_share: float = 0.8, first_lists: int = 2) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query, itself excluded.

    ``queries`` are rows of ``embeddings``. Distances are Euclidean; ties go to the smaller vec_id. Each
    query probes the nearest ``probe_share`` of all lists, ``first_lists`` of them without tests.

    - Null and zero vectors, those with null or non-finite components and those of another length than
      the most frequent one take no part, nor do rows without a vec_id.
    - Equal vectors are searched for once; of such a group only its smallest ids can be among the
      nearest, so no more of them are carried. With fewer candidates than ``k`` all probed are returned.
    - Rows that share a vec_id are the same vector to the search and never each other's neighbour.
    - An empty table gives an empty result; other columns take no part.
    """
    d = dimension(embeddings)
    empty = embeddings.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id",
                              F.lit(0.0).alias("score")).limit(0)
    if d is None:
        return empty
    vectors = usable(embeddings, d)
    place = F.row_number().over(Window.partitionBy("k1", "k2").orderBy("vec_id"))
    classes = cut(
        vectors.distinct().withColumn("place", place).filter(F.col("place") <= k + 1).groupBy("k1", "k2").agg(
            F.collect_list("vec_id").alias("ids"), F.min("vec_id").alias("least"), F.first("embedding").alias("embedding")),
        "vector-classes")
    n = classes.count()
    if not n:
        return empty
    asked = cut(usable(queries, d).select("vec_id", "k1", "k2").distinct(), "vector-queries")
    points = sample(classes, d)
    centres, turn = k_means(points, list_count(n)), rotation(d)
    probes = max(min(len(centres), first_lists + 1), int(np.ceil(probe_share * len(centres))))
    members = cut(with_lists(classes, d, lambda x: [np.array([i]) for i in squared(x, centres).argmin(1)], "lists")
                  .select("k1", "k2", "least", "embedding", F.col("lists")[0].alias("list")), "vector-members")
    probing = cut(with_lists(
        classes.select("k1", "k2", "embedding").join(asked.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi"), d,
        lambda x: list(np.argsort(squared(x, centres), axis=1, kind="stable")[:, :probes]), "lists"), "vector-probes")
    first = probing.select("k1", "k2", "embedding", F.lit(float("inf")).alias("bound"),
                           F.explode(F.slice("lists", 1, first_lists)).alias("list"))
    near = cut(meet(members, first, _scan(turn, d, k + 1), FOUND), "near-lists")
    order = Window.partitionBy("q1", "q2").orderBy("score", "c1", "c2")
    # The distance within which k others lie already, if the first lists hold so many.
    bounds = near.withColumn("r", F.row_number().over(order)).filter(F.col("r") == k + 1).select("q1", "q2", F.col("score").alias("bound"))
    rest = probing.join(bounds, (F.col("k1") == F.col("q1")) & (F.col("k2") == F.col("q2")), "left").select(
        "k1", "k2", "embedding", F.coalesce("bound", F.lit(float("inf"))).alias("bound"),
        F.explode(F.slice("lists", first_lists + 1, probes)).alias("list"))
    found = near.union(meet(members, rest, _scan(turn, d, k + 1), FOUND))
    ids = classes.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), "ids", "least")
    best = Window.partitionBy("q1", "q2").orderBy("score", "least")
    top = found.join(ids, ["c1", "c2"]).withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
    pairs = top.join(asked.select(F.col("vec_id").alias("query_id"), F.col("k1").alias("q1"), F.col("k2").alias("q2")),
                     ["q1", "q2"]).select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@registered("op3_nearest")
def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose vec_id is divisible by 100 against all others, the 10 nearest."""
    embeddings = table(spark, sf_dir, "embeddings")
    return nearest(embeddings, embeddings.filter("vec_id % 100 = 0"))
