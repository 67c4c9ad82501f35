"""Vectors in inverted lists: what both searches over embeddings share.

Lists are the cells of centroids fitted on a bounded seeded sample. Within a list, members and the
queries that probe it are both cut into chunks of bounded size, and every pair of chunks is one group,
so a list that holds a third of all vectors is still many small tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Vectors from which an index is fitted, at most, and the most lists.
SAMPLE, MOST_LISTS = 16_384, 1_024
CHUNK_ROWS = 4_096


def dimension(embeddings: DataFrame) -> int | None:
    """The most frequent length of a vector; None if there is no vector."""
    row = (embeddings.filter("embedding is not null and size(embedding) > 0").groupBy(F.size("embedding").alias("d"))
           .count().orderBy(F.desc("count"), "d").first())
    return row["d"] if row else None


def usable(embeddings: DataFrame, d: int) -> DataFrame:
    """(vec_id, embedding, k1, k2) of vectors that take part; the keys name the vector's values."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return embeddings.filter(
        F.col("vec_id").isNotNull() & F.coalesce(
            (F.size("embedding") == d) & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    ).select("vec_id", "embedding", F.xxhash64("embedding").alias("k1"),
             F.xxhash64(F.lit(20), "embedding").alias("k2"))


def matrix(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(-1, d).astype(np.float64)


def sample(vectors: DataFrame, d: int, most: int = SAMPLE, seed: int = 9) -> np.ndarray:
    """At most ``most`` vectors, chosen by a hash of their values."""
    rows = vectors.orderBy(F.xxhash64(F.lit(seed), "k1"), "k2").limit(most).select("embedding").toArrow()
    return matrix(rows["embedding"], d)


def k_means(points: np.ndarray, k: int, rounds: int = 8, seed: int = 9) -> np.ndarray:
    random = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    k = min(k, len(points))
    centres = points[np.sort(random.choice(len(points), k, replace=False))]
    for _ in range(rounds):
        nearest = squared(points, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        count = np.bincount(nearest, minlength=k)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1), 0)


def list_count(n: int) -> int:
    return int(np.clip(round(np.sqrt(n) / 2), 1, MOST_LISTS))


def with_lists(vectors: DataFrame, d: int, choose: Callable[[np.ndarray], list[np.ndarray]], name: str) -> DataFrame:
    """``vectors`` with a column of lists, chosen for each vector."""

    @F.arrow_udf("array<int>")
    def chosen(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = []
            for i in range(0, len(batch), 1024):
                found += choose(matrix(batch[i:i + 1024], d))
            yield pa.array(found, pa.list_(pa.int32()))

    return vectors.withColumn(name, chosen("embedding"))


def in_chunks(members: DataFrame, queries: DataFrame, size: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both with ``list``, ``mc`` and ``qc``: every member meets every query of its list once.

    Both have ``list`` and ``k1``. Chunks follow from counts per list.
    """
    pieces = lambda df, name: df.groupBy("list").agg(
        F.ceil(F.count("*") / size).cast("int").alias(name))
    plan = pieces(members, "n_mc").join(pieces(queries, "n_qc"), "list")
    own = lambda n: F.pmod(F.xxhash64("k1"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = members.join(plan, "list").withColumn("mc", own("n_mc")).withColumn("qc", every("n_qc"))
    right = queries.join(plan, "list").withColumn("qc", own("n_qc")).withColumn("mc", every("n_mc"))
    return left.drop("n_mc", "n_qc"), right.drop("n_mc", "n_qc")


def meet(members: DataFrame, queries: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
         size: int = CHUNK_ROWS) -> DataFrame:
    left, right = in_chunks(members, queries, size)
    keys = ["list", "mc", "qc"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(lambda m, q: work(m, q), schema)
