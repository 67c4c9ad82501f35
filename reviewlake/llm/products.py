"""Embedding near-dedup by product quantisation.

Unit vectors lie in coarse inverted lists; each is stored as the codes of its residual, subspace by
subspace. A query probes every list whose cell its ball can reach, sums distances from lookup tables,
and keeps what may be near enough: the table distance is off by no more than the known error of the
code, so nothing is lost before the exact cosines decide.

Lists lie together on shelves of bounded size, and a vector goes once to each shelf that holds a list it
probes. The shelves are served in rounds, each with about as many copies of vectors as there are
vectors, so the disk in use grows with the table and not with the pairs.

Vectors with equal values are one class. A group counts each query's links and passes on the links of
its local components as stars, never all pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import cut, cut_all, drop, registered, table
from reviewlake.llm.graph import components
from reviewlake.llm.vectors import dimension, k_means, list_count, matrix, sample, squared, usable, with_lists

SUBSPACES, CODES = 8, 64
# Rounding of table distances, which are kept in single precision.
ROUNDING = 1e-3
# Vectors that ask a shelf in one group: a share of all, so many at least, but with so many values at most. A shelf
# holds twice as many.
LEAST_ASKING, ASKING_SHARE, ASKING_VALUES = 4_096, 1 / 16, 1 << 20
# Copies of vectors that one round moves, as a multiple of the vectors, and how many are too few for a round.
ROUND_COPIES, LEAST_COPIES = 3, 400_000
# Pairs whose table distances are held at once.
CELLS = 1 << 21


def unit(x: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither vanish nor overflow.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


class Codebook:
    """Coarse centres and, for each subspace, the code words of residuals."""

    def __init__(self, points: np.ndarray, lists: int, seed: int = 9):
        self.centres = k_means(points, lists, seed=seed)
        d = points.shape[1]
        self.bounds = np.linspace(0, d, min(SUBSPACES, d) + 1).astype(int)
        home = squared(points, self.centres).argmin(1)
        residuals = points - self.centres[home]
        self.words = [k_means(residuals[:, a:b], CODES, seed=seed) for a, b in self.parts()]
        self.between = np.sqrt(squared(self.centres, self.centres))

    def parts(self):
        return list(zip(self.bounds[:-1], self.bounds[1:], strict=True))

    def home(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.array([i]) for i in squared(unit(x), self.centres).argmin(1)]

    def reached(self, x: np.ndarray, radius: float) -> np.ndarray:
        """For unit vectors (rows), which lists have a cell within ``radius``: beyond it lies the plane between two centres."""
        far = squared(x, self.centres)
        own = far.argmin(1)
        gap = (far - far[np.arange(len(far)), own][:, None]) / np.maximum(2 * self.between[own], 1e-12)
        return gap <= radius + 1e-9

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and how far each is from its residual."""
        codes, error = np.empty((len(residuals), len(self.words)), np.uint8), np.zeros(len(residuals))
        for m, (a, b) in enumerate(self.parts()):
            far = squared(residuals[:, a:b], self.words[m])
            codes[:, m] = far.argmin(1)
            error += ((residuals[:, a:b] - self.words[m][codes[:, m]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def table_distances(self, queries: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distances of decoded members (rows) to query residuals (columns)."""
        total = np.zeros((len(codes), len(queries)), np.float32)
        part = np.empty_like(total)
        for m, (a, b) in enumerate(self.parts()):
            distances = squared(self.words[m], queries[:, a:b]).astype(np.float32)
            total += np.take(distances, codes[:, m], axis=0, out=part, mode="clip")
        return total


class Shelves:
    """Where lists lie: neighbours in number share a shelf, a list beyond ``size`` vectors is dealt over several."""

    def __init__(self, held: Mapping[int, int], lists: int, size: int):
        self.first, self.pieces = np.zeros(lists, int), np.ones(lists, int)
        shelf, filled = 0, 0
        for i in range(lists):
            n = held.get(i, 0)
            if filled and filled + n > size:
                shelf, filled = shelf + 1, 0
            self.first[i], self.pieces[i] = shelf, max(1, -(-n // size))
            shelf, filled = (shelf + self.pieces[i], 0) if n > size else (shelf, filled + n)
        self.count = int((self.first + self.pieces).max())
        self.holds = np.zeros((lists, self.count), np.float32)
        for row, a, n in zip(self.holds, self.first, self.pieces, strict=True):
            row[a:a + n] = 1

    def of(self, reached: np.ndarray) -> list[np.ndarray]:
        """The shelves of the lists that each row of ``reached`` has."""
        return [np.flatnonzero(row) for row in reached.astype(np.float32) @ self.holds]


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels of components, each the least node of its own, once nodes ``a`` are linked to nodes ``b``."""
    while True:
        p, q = label[a], label[b]
        apart = p != q
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(p, q)[apart], np.minimum(p, q)[apart])
        while (label[label] != label).any():
            label = label[label]


def _stars(ids: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for each component, from its least id to every other one."""
    order = np.lexsort((ids, label))
    ids, label = ids[order], label[order]
    begins = np.ones(len(ids), bool)
    begins[1:] = label[1:] != label[:-1]
    head = ids[np.maximum.accumulate(np.where(begins, np.arange(len(ids)), 0))]
    star = head != ids
    star[1:] &= begins[1:] | (ids[1:] != ids[:-1])
    return ids[star], head[star]


def _found(book: Codebook, d: int, cosine: float):
    radius = np.sqrt(2 - 2 * cosine)

    def work(members: pa.Table, queries: pa.Table) -> pa.Table:
        x, y = unit(matrix(queries["embedding"], d)), unit(matrix(members["embedding"], d))
        q_id, m_id = queries["head"].to_numpy(), members["head"].to_numpy()
        count, lists = members["n"].to_numpy(), members["list"].to_numpy()
        linked, label = np.zeros(len(x), np.int64), np.arange(len(x) + len(y))
        reached = [book.reached(x[i:i + 1024], radius) for i in range(0, len(x), 1024)]
        reached = np.concatenate(reached) if reached else np.zeros((0, len(book.centres)), bool)
        for own in np.unique(lists):
            centre, held, asking = book.centres[own], np.flatnonzero(lists == own), np.flatnonzero(reached[:, own])
            codes, error = book.encode(y[held] - centre)
            near = ((radius + error + ROUNDING) ** 2).astype(np.float32)[:, None]
            step = max(64, CELLS // len(held))
            for i in range(0, len(asking), step):
                some = asking[i:i + step]
                columns, rows = np.nonzero(book.table_distances(x[some] - centre, codes) <= near)
                for k in range(0, len(rows), 1 << 16):
                    a, b = some[rows[k:k + (1 << 16)]], held[columns[k:k + (1 << 16)]]
                    sure = np.einsum("ij,ij->i", x[a], y[b]) >= cosine
                    a, b = a[sure], b[sure]
                    np.add.at(linked, a, count[b])
                    label = merged(label, a, len(x) + b)
        u, v = _stars(np.concatenate([q_id, m_id]), label)
        some = linked > 0
        nodes = np.concatenate([q_id[some], u]).astype(np.int64)
        links = np.concatenate([np.full(int(some.sum()), -1), v]).astype(np.int64)
        counts = np.concatenate([linked[some], np.full(len(u), -1)]).astype(np.int64)
        return pa.table({"u": nodes, "v": pa.array(links, mask=counts >= 0), "n": pa.array(counts, mask=counts < 0)})

    return work


def in_rounds(copies: list[int], most: int) -> Iterator[list[int]]:
    """Shelves by round: as many as ``most`` copies allow, at least one."""
    some, held = [], 0
    for shelf, n in enumerate(copies):
        if some and held + n > most:
            yield some
            some, held = [], 0
        some, held = [*some, shelf], held + n
    if some:
        yield some


def asking_size(n: int, d: int) -> int:
    return max(1, min(ASKING_VALUES // d, max(LEAST_ASKING, int(n * ASKING_SHARE))))


def meetings(placed: DataFrame, shelves: int, n: int, asking: int, work: Callable[[pa.Table, pa.Table], pa.Table],
             schema: str) -> Iterator[DataFrame]:
    """What ``work`` finds where vectors of a shelf meet those that ask it, up to ``asking`` at once, round by round.

    ``placed`` has the ``shelf`` of every one of ``n`` vectors and, in ``shelves``, all that it asks.
    """
    counted = lambda rows: {r[0]: r[1] for r in rows.groupBy("shelf").count().collect()}
    held, asked = counted(placed), counted(placed.select(F.explode("shelves").alias("shelf")))
    parts = [-(-asked.get(s, 0) // asking) for s in range(shelves)]
    copies = [asked.get(s, 0) + held.get(s, 0) * parts[s] for s in range(shelves)]
    keys = ["shelf", "part"]
    for some in in_rounds(copies, max(LEAST_COPIES, ROUND_COPIES * n)):
        # Into how many parts those that ask a shelf are dealt; 0 for shelves of other rounds.
        of = F.get(F.lit([parts[s] if s in some else 0 for s in range(shelves)]), F.col("shelf"))
        members = placed.filter(of > 0).select("shelf", "list", "head", "n", "embedding",
                                               F.explode(F.sequence(F.lit(0), of - 1)).alias("part"))
        queries = placed.select("k1", "head", "embedding", F.explode(F.array_intersect("shelves", F.lit(some))).alias("shelf")).select(
            "shelf", F.pmod(F.xxhash64("k1"), of).cast("int").alias("part"), "head", "embedding")
        yield members.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(lambda m, q: work(m, q), schema)


def near_duplicate_vectors(embeddings: DataFrame, cosine: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``embeddings``.

    Vectors link if their cosine is at least ``cosine``; n_links counts the other vectors linked directly,
    a component is named by its smallest vec_id.

    - Null and zero vectors, and those with null or non-finite components, link with nothing: 0 links,
      their own id, kept. So do vectors of another length than the most frequent one.
    - A null vec_id takes no part: component_id null, kept. Rows that share a vec_id are vectors of their
      own that share a component.
    - Equal vectors all link. An empty table gives an empty result; other columns take no part.
    """
    d = dimension(embeddings)
    if d is None:
        alone = embeddings.select("vec_id")
        return alone.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                            F.lit(True).alias("kept"))
    vectors = usable(embeddings, d)
    classes = cut(vectors.groupBy("k1", "k2").agg(
        F.min("vec_id").alias("head"), F.count("*").alias("n"), F.first("embedding").alias("embedding")), "vector-classes")
    n = classes.count()
    if n:
        book = Codebook(unit(sample(classes, d)), list_count(n))
        radius = float(np.sqrt(2 - 2 * cosine))
        homes = with_lists(classes, d, book.home, "homes").select(*classes.columns, F.col("homes")[0].alias("list"))
        held = {r["list"]: r["count"] for r in homes.groupBy("list").count().collect()}
        asking = asking_size(n, d)
        shelves = Shelves(held, len(book.centres), 2 * asking)
        first, pieces = (F.get(F.lit(x.tolist()), F.col("list")) for x in (shelves.first, shelves.pieces))
        placed = cut(with_lists(homes, d, lambda x: shelves.of(book.reached(unit(x), radius)), "shelves").withColumn(
            "shelf", (first + F.pmod(F.xxhash64("k1"), pieces)).cast("int")), "vector-shelves")
        drop(classes)
        found = cut_all(meetings(placed, shelves.count, n, asking, _found(book, d, cosine), "u long, v long, n long"),
                        "vector-links")
        classes = placed
    else:
        found = classes.select(F.col("head").alias("u"), F.col("head").alias("v"), "n")
    links = found.filter("n is not null").groupBy(F.col("u").alias("of")).agg((F.sum("n") - 1).alias("n_links"))
    known = components(found.filter("v is not null").select("u", "v").union(
        vectors.join(classes.select("k1", "k2", "head"), ["k1", "k2"]).filter("vec_id != head").select("vec_id", "head")))
    heads = vectors.select("vec_id", "k1", "k2").join(classes.select("k1", "k2", "head"), ["k1", "k2"]).select(
        "k1", "k2", "head").distinct()
    keyed = embeddings.select("vec_id", F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(20), "embedding").alias("k2"))
    return (
        keyed.join(heads, ["k1", "k2"], "left").join(links, F.col("head") == F.col("of"), "left")
        .join(known, F.col("vec_id") == F.col("node"), "left")
        .select("vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).alias("n_links"),
                F.coalesce("component", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
      WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id
      WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.95),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
m AS (SELECT x, min(y) AS low FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(low, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.x = vec_id LEFT JOIN m ON m.x = vec_id
"""


@registered("op8_vector_dedup", ORACLE)
def op8_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, cosine of at least 0.95."""
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
