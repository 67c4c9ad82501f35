"""Removal of long repeated byte strings with longest-previous-factor arrays.

Places where a text may repeat are found through sampled anchors (``runs``). What shares an anchor is put
on end in a shard, and its suffixes are ordered by prefix doubling as deep as ``min_bytes``. In that
order the neighbours with a smaller and a larger position tell whether a suffix matches an earlier or a
later one for at least that length: its longest previous or next factor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import registered, row_but, table
from reviewlake.llm.runs import Windows, recurring, segments, starts_of, text_keys

FOUND = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("least", pa.int64()), ("count", pa.int64())]))


def ordered_starts(data: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` in the order of their suffixes to ``depth`` bytes, equal ones by position, and ranks.

    Every start has at least ``depth`` bytes after it.
    """
    rank, done = data.astype(np.int64), 1
    while done * 2 <= depth:
        pair = rank[:-done] << 32 | rank[done:]
        rank, done = np.unique(pair, return_inverse=True)[1].reshape(-1), done * 2
    # Two overlapping pieces of that length cover the whole depth.
    key = rank[starts] << 32 | rank[starts + depth - done]
    order = np.argsort(key, kind="stable")
    return order, key[order]


def factors(order: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each start the start that matches before it and after it, -1 if none does.

    Where neighbours in suffix order agree to the full depth, the previous one is the nearest smaller
    position and the next one the nearest larger, as equal suffixes are ordered by position.
    """
    before, after = np.full(len(order), -1), np.full(len(order), -1)
    same = key[1:] == key[:-1]
    before[order[1:][same]] = order[:-1][same]
    after[order[:-1][same]] = order[1:][same]
    return before, after


def compare(depth: int):
    """Finds windows of ``depth`` bytes that occur more than once in a shard of contents."""

    def shard(part: pa.Table) -> pa.Table:
        contents = part["content"].to_pylist()
        sizes = np.array([len(x) for x in contents])
        data = np.frombuffer(b"".join(contents), np.uint8)
        begin = np.cumsum(sizes) - sizes
        windows = sizes - depth + 1
        owner = np.repeat(np.arange(len(sizes)), windows)
        within = np.arange(int(windows.sum())) - np.repeat(np.cumsum(windows) - windows, windows)
        order, key = ordered_starts(data, begin[owner] + within, depth)
        before, after = factors(order, key)
        repeated = (before >= 0) | (after >= 0)
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.empty(len(key), np.int64)
        group[order] = np.cumsum(new) - 1
        c, m = (part[x].to_numpy()[owner] for x in "cm")
        count, least = np.bincount(group, c).astype(np.int64), np.full(int(new.sum()), np.iinfo(np.int64).max)
        np.minimum.at(least, group, m)
        count, least = count[group], least[group]
        repeated |= count > 1
        cuts = np.cumsum(windows) - windows
        found = []
        for x, n in zip(cuts, windows, strict=True):
            hit = np.flatnonzero(repeated[x:x + n])
            found.append(segments(hit, least[x:x + n][hit], count[x:x + n][hit]))
        return pa.table([part["fp"], part["h"], pa.array(found, FOUND)], names=["fp", "h", "found"])

    return shard


def _removal(min_bytes: int, keep: str, as_text: bool):
    @F.arrow_udf(f"removed array<struct<a int, b int>>, kept {'string' if as_text else 'binary'}")
    def remove(texts: pa.Array, ids: pa.Array, found: pa.Array) -> pa.Array:
        out = []
        for text, own, spots in zip(texts, ids, found, strict=True):
            text, own, spots = text.as_py(), own.as_py(), spots.as_py()
            if text is None:
                out.append(None)
                continue
            data = np.frombuffer(text.encode(), np.uint8)
            if keep == "none":
                gone = starts_of(spots, lambda x: x["count"] > 1, min_bytes, len(data))
            else:
                gone = starts_of(spots, lambda x: own is not None and x["least"] < own, min_bytes, len(data))  # noqa: B023
                gone |= _repeated_within(data, starts_of(spots, lambda x: x["count"] > 1, min_bytes, len(data)), min_bytes)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            out.append({"removed": [{"a": int(a), "b": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)],
                        "kept": data[~gone].tobytes().decode(errors="ignore") if as_text else data[~gone].tobytes()})
        return pa.array(out, pa.struct([("removed", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))),
                                        ("kept", pa.string() if as_text else pa.binary())]))

    return remove


def _repeated_within(data: np.ndarray, suspect: np.ndarray, depth: int) -> np.ndarray:
    """Bytes covered by a string that starts earlier in the same text; only suspects can be."""
    gone = np.zeros(len(data), bool)
    if suspect.sum() < depth or len(data) <= depth:
        return gone
    starts = np.arange(len(data) - depth + 1)
    before, _ = factors(*ordered_starts(data, starts, depth))
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, starts[before >= 0], 1)
    np.add.at(change, starts[before >= 0] + depth, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(documents: DataFrame, min_bytes: int = 400, keep: str = "none", as_text: bool = False) -> DataFrame:
    """The documents with ``repeats``: removed (byte ranges) and kept (the remaining bytes).

    With ``as_text`` what is kept is text; bytes of a character that a cut has split are dropped.

    A byte goes if a string of ``min_bytes`` bytes that covers it starts anywhere else (``keep="none"``),
    or starts in a document with a smaller doc_id or earlier in the same one (``keep="first"``). Strings
    are judged on the input.

    - Null text is empty: nothing removed, nothing kept. Shorter texts than ``min_bytes`` stay whole.
    - Rows that repeat a doc_id are documents of their own; with ``keep="first"`` none of them is before
      the other. A null doc_id is after all others there and takes part like others else.
    - An empty table gives an empty result; other columns pass through unchanged.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kind = Windows("byte", min_bytes, 1 << ((min_bytes // 3).bit_length() - 1))
    keyed = documents.select(F.coalesce("doc_id", F.lit((1 << 63) - 1)).cast("long").alias("id"),
                             text.alias("text"), *text_keys(text)).filter(F.octet_length("text") >= min_bytes)
    found = recurring(keyed, kind, compare(min_bytes))
    joined = documents.select(row_but(documents, "repeats"), "doc_id", text.alias("text"), *text_keys(text)).join(
        found, ["k1", "k2"], "left")
    some = F.when(F.col("found").isNotNull(), F.col("text"))
    done = joined.withColumn("done", _removal(min_bytes, keep, as_text)(some, F.col("doc_id").cast("long"), F.col("found")))
    return done.select("row.*", F.struct(
        F.coalesce("done.removed", F.array().cast("array<struct<a int, b int>>")).alias("removed"),
        F.coalesce("done.kept", F.col("text").cast("string" if as_text else "binary")).alias("kept")).alias("repeats"))


@registered("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents: every byte of a 400-byte string that occurs elsewhere goes."""
    done = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("repeats.removed", F.lit(0).cast("long"), lambda total, x: total + (x["b"] - x["a"]))
    return done.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        removed.alias("n_removed"), F.size("repeats.removed").cast("long").alias("n_spans"),
        F.sha2("repeats.kept", 256).alias("kept_sha256"))
