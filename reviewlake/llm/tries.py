"""A trie of conversations and subtree totals by time-forward processing.

A node is a distinct sequence of first turns; its key is a chained hash of them. Which conversations
share a node is an aggregation by key. Totals of subtrees then move upwards: within a shard nodes come
in reverse level order (Spark's external sort), and each sends its totals ahead, to the time its parent
comes up, through a priority queue that spills. What a shard's topmost nodes send leaves the shard and
meets them, summed by parent, among the nodes that the next pass takes.

Shards are cut by weight: nodes of at most ``light`` conversations are the first pass, those of at most
its square the second, and so on; the topmost node of a pass on each path heads a shard. So a first turn that a
third of all conversations share is split at the nodes below it, and few passes reach the root.
"""

from __future__ import annotations

import heapq
import pickle
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.llm.common import cut, registered, table

ROOT = bytes(16)
# Conversations of a node of the first pass, nodes a shard aims at, messages a queue holds in memory,
# and bytes of a stretch of ids.
LIGHT, SHARD_NODES, IN_MEMORY, STRETCH_BYTES = 4096, 1 << 16, 1 << 18, 1 << 16

PATHS = "conv_id long, depth long, key binary, parent binary, bytes long"
TOTALS = "kind string, key binary, n_children long, n_leaves long, saved_tokens long"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of each conversation's nodes; its turns come in order, over any number of batches."""
    conv, key, depth = None, ROOT, 0
    for batch in batches:
        keys, parents, depths = [], [], []
        for own, role, text in zip(*(batch[c].to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if own != conv:
                conv, key, depth = own, ROOT, 0
            role, text = role.encode(), text.encode()
            parents.append(key)
            key = blake2b(key + len(role).to_bytes(8, "little") + role + text, digest_size=16).digest()
            depth += 1
            keys.append(key)
            depths.append(depth)
        yield pa.RecordBatch.from_arrays(
            [batch["conv_id"], pa.array(depths, pa.int64()), pa.array(keys, pa.binary()), pa.array(parents, pa.binary()),
             batch["bytes"]], names=["conv_id", "depth", "key", "parent", "bytes"])


class SpillingQueue:
    """A priority queue of tuples; what memory does not hold is kept in sorted runs of a scratch file.

    The file belongs to the task and goes with it.
    """

    def __init__(self, in_memory: int = IN_MEMORY):
        self.in_memory, self.heap = in_memory, []
        self.runs: list[tuple] = []  # (first entry, number of the run, the rest of the run)

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.in_memory:
            rest = self._stored(sorted(self.heap))
            heapq.heappush(self.runs, (next(rest), len(self.runs), rest))
            self.heap = []
            if len(self.runs) > 64:
                # Few open files: all runs become one.
                merged = self._stored(self._drained(self.runs))
                self.runs = [(next(merged), 0, merged)]

    @staticmethod
    def _drained(runs: list[tuple]) -> Iterator[tuple]:
        return heapq.merge(*(SpillingQueue._whole(first, rest) for first, _, rest in runs))

    @staticmethod
    def _whole(first: tuple, rest: Iterator[tuple]) -> Iterator[tuple]:
        yield first
        yield from rest

    @staticmethod
    def _stored(entries) -> Iterator[tuple]:
        file = tempfile.TemporaryFile()
        for entry in entries:
            pickle.dump(entry, file)
        end = file.tell()
        file.seek(0)

        def stored() -> Iterator[tuple]:
            with file:
                while file.tell() < end:
                    yield pickle.load(file)

        return stored()

    def least(self) -> tuple | None:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            first, number, rest = heapq.heappop(self.runs)
            following = next(rest, None)
            if following is not None:
                heapq.heappush(self.runs, (following, number, rest))
            return first
        return heapq.heappop(self.heap)


def _forward(in_memory: int):
    """Totals of a shard's nodes, which come deepest first, and what its topmost nodes send."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = SpillingQueue(in_memory)
        for batch in batches:
            out: list[tuple] = []
            columns = ("depth", "key", "parent", "heads", "gain", "children", "leaves", "saved")
            for depth, key, parent, heads, gain, children, leaves, saved in zip(
                    *(batch[c].to_pylist() for c in columns), strict=True):
                while (first := waiting.least()) is not None and first[:2] == (-depth, key):
                    _, _, more_leaves, more_saved = waiting.pop()
                    children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
                leaves, saved = leaves or 1, saved + gain
                out.append(("node", key, children, leaves, saved))
                if not heads:
                    waiting.push((1 - depth, parent, leaves, saved))
                elif parent is not None:
                    out.append(("message", parent, 1, leaves, saved))
            kinds = (pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*out, strict=True) if out else ((),) * 5, kinds, strict=True)],
                names=["kind", "key", "n_children", "n_leaves", "saved_tokens"])

    return totals


@dataclass(frozen=True)
class Trie:
    """``nodes``: key, conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens.

    ``ends``: key and conv_id of every conversation's last node. ``paths``: its nodes by depth.
    """

    nodes: DataFrame
    ends: DataFrame
    paths: DataFrame


def prefix_trie(conversations: DataFrame, turns: DataFrame, light: int = LIGHT, in_memory: int = IN_MEMORY) -> Trie:
    """The trie of ``turns`` (conv_id, place, role, text; no nulls) of all ``conversations`` (conv_id).

    ``place`` is anything that orders a conversation's turns; equal turns are told apart by it alone.
    A conversation without turns ends at the root. ``conversations`` holds each id once. Without
    conversations there is no node.
    """
    told = turns.select("conv_id", "place", "role", "text", F.octet_length("text").cast("long").alias("bytes"))
    chained = told.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_paths, PATHS)
    none = F.lit(None).cast("binary")
    rooted = conversations.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"),
                                  none.alias("parent"), F.lit(0).cast("long").alias("bytes"))
    paths = cut(rooted.union(chained), "paths")
    nodes = paths.groupBy("key", "parent", "depth", "bytes").agg(
        F.min("conv_id").alias("least"), F.count("*").alias("n_convs"))
    # The pass that takes a node: 0 up to ``light`` conversations, 1 up to its square, and so on.
    weighed = cut(nodes.withColumn("pass", F.greatest(
        F.ceil(F.log(float(light), F.col("n_convs")) - 1e-9) - 1, F.lit(0)).cast("int")), "nodes")
    along = paths.select("conv_id", "key").join(weighed, "key")
    path, stretch = Window.partitionBy("conv_id").orderBy("depth"), Window.partitionBy("conv_id", "pass").orderBy("depth")
    placed = along.withColumn("parent_conv_id", F.lag("least").over(path)).withColumn(
        "head", F.first("key").over(stretch)).filter("conv_id = least")
    placed = cut(placed.select(
        "key", "parent", "depth", "conv_id", "parent_conv_id", "n_convs", "pass", "head",
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("gain")), "placed-nodes")
    passes = placed.groupBy("pass").count().collect()  # a number for each pass
    done: list[DataFrame] = []
    for number, size in sorted((r["pass"], r["count"]) for r in passes):
        ready = placed.filter(F.col("pass") == number)
        if done:
            sent = _all(done).filter("kind = 'message'").groupBy("key").agg(
                F.sum("n_children").alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"))
            ready = ready.join(sent, "key", "left")
        else:
            ready = ready.withColumns({c: F.lit(0).cast("long") for c in ("children", "leaves", "saved")})
        zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
        shards = ready.select("depth", "key", "parent", (F.col("head") == F.col("key")).alias("heads"), "gain", "head",
                              zero("children"), zero("leaves"), zero("saved")).repartition(
            max(1, -(-size // SHARD_NODES)), "head").sortWithinPartitions(F.desc("depth"), "key")
        done.append(cut(shards.drop("head").mapInArrow(_forward(in_memory), TOTALS), "totals"))
    if not done:
        totals = placed.sparkSession.createDataFrame([], TOTALS)
    else:
        totals = _all(done)
    found = placed.join(totals.filter("kind = 'node'").drop("kind"), "key").select(
        "key", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    last = paths.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    return Trie(found, paths.join(last, ["conv_id", "depth"]).select("key", "conv_id"), paths)


def _all(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return whole


def _stretches(most: int):
    """Ids on end of one key, joined by commas, in stretches of about ``most`` bytes."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, ids, size = None, 0, [], 0
        for batch in batches:
            out = []
            for own, conv in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if ids and (own != key or size > most):
                    out.append((key, first, ",".join(ids)))
                    ids, size = [], 0
                if not ids:
                    key, first = own, conv
                ids.append(str(conv))
                size += len(ids[-1]) + 1
            yield _rows(out)
        yield _rows([(key, first, ",".join(ids))] if ids else [])

    def _rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.int64()),
             pa.array([x[2] for x in out], pa.string())], names=["key", "first", "ids"])

    return joined


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, sha256()
    for batch in batches:
        out = []
        for own, ids in zip(batch["key"].to_pylist(), batch["ids"].to_pylist(), strict=True):
            if own == key:
                digest.update(b",")
            else:
                if key is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = own, sha256()
            digest.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.string())],
                                         names=["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([digest.hexdigest()])], names=["key", "ends_sha256"])


def end_digests(ends: DataFrame, most: int = STRETCH_BYTES) -> DataFrame:
    """(key, ends_sha256): a digest of each node's ids in order, joined by commas.

    Ids are sorted and joined in ranges, so those of one node are spread over tasks; what meets for a
    node's digest are stretches of them, read one after the other.
    """
    ranges = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    joined = ranges.mapInArrow(_stretches(most), "key binary, first long, ids string")
    return joined.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digests, "key binary, ends_sha256 string")


def head_length(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All conversations, and their turns with a ``place``, after exchanging beginnings.

    Conversation c begins with the first h turns of conversation c - c % 5 (the remainder has the sign
    of c) and goes on with its own after its first h; h is the checksum of c's digits modulo 9.

    - Null role or text is empty. Turns come by ``turn``, null first, equal ones by role and text;
      repeated rows are turns of their own. Rows without a conv_id belong to no conversation.
    - An empty table has no conversations. Other columns are not looked at.
    """
    empty = F.lit("")
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", empty).alias("role"),
        F.coalesce("text", empty).alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    ranked = cut(turns.select("conv_id", "role", "text", (F.row_number().over(order) - 1).cast("long").alias("at")), "turns")
    every = ranked.select("conv_id").distinct()
    own = ranked.filter(F.col("at") >= head_length(F.col("conv_id")))
    follows = every.select(F.col("conv_id").alias("c"), (F.col("conv_id") - F.col("conv_id") % 5).alias("conv_id"))
    heads = ranked.filter("at < 8").join(follows, "conv_id").filter(F.col("at") < head_length(F.col("c")))

    def told(df: DataFrame, name: str, part: int) -> DataFrame:
        return df.select(F.col(name).alias("conv_id"), F.struct(F.lit(part).alias("part"), "at").alias("place"), "role", "text")

    return every, told(own, "conv_id", 1).union(told(heads, "c", 0))


ORACLE = """
WITH tab AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) AS r(i))),
o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 9 AS h FROM (SELECT DISTINCT conv_id FROM o), tab),
r AS (SELECT ids.conv_id, 0 AS part, pos, role, text FROM ids JOIN o ON o.conv_id = base AND pos < h
      UNION ALL SELECT o.conv_id, 1, pos, role, text FROM o JOIN ids ON ids.conv_id = o.conv_id WHERE pos >= h),
s AS (SELECT conv_id, row_number() OVER w AS d, strlen(text) AS b,
      string_agg(md5(strlen(role) || ':' || role || text), '') OVER (w ROWS UNBOUNDED PRECEDING) AS k
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos)),
p AS (SELECT conv_id, 0 AS d, '' AS k, NULL AS up, 0 AS b FROM ids
      UNION ALL SELECT conv_id, d, md5(k), CASE WHEN d = 1 THEN '' ELSE md5(lag(k) OVER (PARTITION BY conv_id ORDER BY d)) END, b FROM s),
n AS (SELECT k, any_value(up) AS up, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(b) AS b FROM p GROUP BY k),
c AS (SELECT up AS k, count(*) AS n FROM n WHERE up IS NOT NULL GROUP BY up),
t AS (SELECT a.k, count(*) FILTER (WHERE c.n IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.b) AS saved_tokens
      FROM (SELECT DISTINCT p.k, q.k AS below FROM p JOIN p AS q ON p.conv_id = q.conv_id AND q.d >= p.d) AS a
      JOIN n ON n.k = below LEFT JOIN c ON c.k = below GROUP BY a.k),
e AS (SELECT k, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
      FROM (SELECT conv_id, arg_max(k, d) AS k FROM p GROUP BY conv_id) GROUP BY k)
SELECT n.conv_id, n.depth::BIGINT AS depth, m.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children, n_leaves,
       saved_tokens::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM n JOIN t USING (k) LEFT JOIN n AS m ON m.k = n.up LEFT JOIN c ON c.k = n.k LEFT JOIN e ON e.k = n.k
"""


@registered("op12_prefix_trie", ORACLE)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, rebuilt."""
    trie = prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))
    return trie.nodes.join(end_digests(trie.ends), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"))
