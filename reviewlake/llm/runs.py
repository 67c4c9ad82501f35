"""Windows that recur in a corpus, found through sampled anchors.

A text is a row of units (bytes or words). Of every window of ``window`` units the smallest hash of its
``gram``-unit pieces is its anchor, so equal windows have equal anchors wherever they stand; on average
only one anchor in half a window differs from the one before. Windows on end with one anchor form a
run, and what the run covers is its content.

1. Anchors are counted. A batch first settles the anchors it holds twice, so of each anchor at most one
   row per batch meets in one place, however frequent it is.
2. Texts are read again with their recurring anchors; runs of these give their content, once per batch.
3. Equal contents are counted. Where an anchor has one content only, all is known. Contents that share
   an anchor are compared window by window in shards of bounded size, by the operator's own method.
   Anchors with more than ``MOST_CONTENTS`` contents, or more than ``MOST_BYTES`` of them, have their
   windows counted as plain rows instead.

In periodic text a run lasts as long as the period does; its content is cut into pieces of ``PIECE``
windows that overlap by what a window needs, so each window is in one piece.

Texts are known by two 64-bit hashes, so copies of a text share all work but the last join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlake.llm.common import cut
from reviewlake.llm.tokens import BASES, Texts, mixed, powers, slices, space_table, split, word_hashes

# Contents of one anchor that are compared in one shard, and their bytes; bytes of contents a shard aims at.
MOST_CONTENTS = 4096
MOST_BYTES = 1 << 22
SHARD_BYTES = 1 << 21
# Windows in one content.
PIECE = 1 << 16
_SPACES = space_table()
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASES[0]))

SEGMENTS = "array<struct<a int, b int, least long, count long>>"


@dataclass(frozen=True)
class Windows:
    """What a window is: ``unit`` is ``byte`` or ``word``; ``gram`` is a power of two."""

    unit: str
    window: int
    gram: int

    @property
    def width(self) -> int:
        return self.window - self.gram + 1


@dataclass
class Units:
    values: np.ndarray
    of: np.ndarray
    content: Callable[[int, int], bytes]


def units(texts: Texts, kind: Windows) -> Units:
    if kind.unit == "byte":
        return Units(_BYTES[texts.data], texts.offsets, lambda s, e: texts.data[s:e].tobytes())
    words = split(texts, _SPACES)
    return Units(word_hashes(words), words.of,
                 lambda s, e: b" ".join(words.data[words.starts[s]:words.ends[e - 1]].tobytes().split()))


def _span_hashes(values: np.ndarray, length: int, base: int) -> np.ndarray:
    """Hashes of all pieces of a length that is a power of two, by doubling."""
    out, done = values, 1
    while done < length:
        out = out[:-done] * np.uint64(pow(base, done, 1 << 64)) + out[done:]
        done *= 2
    return out


def _slide(values: np.ndarray, width: int, by: np.ufunc, fill: int) -> np.ndarray:
    """The least or greatest of every ``width`` values on end."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, fill, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    head = by.accumulate(blocks, axis=1).reshape(-1)
    tail = by.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return by(tail[:n - width + 1], head[width - 1:n])


@dataclass
class Anchored:
    """Anchors (place, value, text) and runs (first and last window start, value, text)."""

    place: np.ndarray
    value: np.ndarray
    text: np.ndarray
    first: np.ndarray
    last: np.ndarray
    run_value: np.ndarray
    run_text: np.ndarray


def anchored(u: Units, kind: Windows) -> Anchored:
    n, none = len(u.values), np.zeros(0, np.int64)
    if n < kind.window:
        return Anchored(none, none.view(np.uint64), none, none, none, none.view(np.uint64), none)
    grams = mixed(_span_hashes(u.values, kind.gram, BASES[1]) + np.uint64(0))
    least = _slide(grams, kind.width, np.minimum, (1 << 64) - 1)
    starts = len(least)
    # Windows within one text, and where a new run begins.
    long = np.diff(u.of) >= kind.window
    change = np.zeros(starts + 1, np.int32)
    np.add.at(change, u.of[:-1][long], 1)
    np.add.at(change, u.of[1:][long] - kind.window + 1, -1)
    valid = np.cumsum(change[:-1]) > 0
    new = np.ones(starts, bool)
    new[1:] = (least[1:] != least[:-1]) | ~valid[:-1]
    new[u.of[:-1][long]] = True
    first = np.flatnonzero(new & valid)
    ends = np.ones(starts, bool)
    ends[:-1] = new[1:] | ~valid[1:]
    last = np.flatnonzero(ends & valid)
    # A piece is an anchor if it is the least of some window that holds it.
    shown = np.where(valid, least, np.uint64(0))
    padded = np.concatenate([np.zeros(kind.width - 1, np.uint64), shown, np.zeros(kind.width - 1, np.uint64)])
    place = np.flatnonzero(grams == _slide(padded, kind.width, np.maximum, 0))
    text_at = lambda p: np.searchsorted(u.of, p, "right") - 1
    # A piece across two texts belongs to no window.
    place = place[place + kind.gram <= u.of[text_at(place) + 1]]
    return Anchored(place, grams[place], text_at(place), first, last, least[first], text_at(first))


def _distinct(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the batch with a text of their own; for every row its text; how often each text stands."""
    keys = np.stack([batch["k1"].to_numpy(), batch["k2"].to_numpy()], axis=1)
    _, first, inverse, count = np.unique(keys, axis=0, return_index=True, return_inverse=True, return_counts=True)
    return first, inverse.reshape(-1), count


def _anchor_rows(kind: Windows):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first, _, count = _distinct(batch)
            values, owners = [], []
            for a, _, some in slices(batch["text"].take(pa.array(first))):
                found = anchored(units(some, kind), kind)
                values.append(found.value)
                owners.append(found.text + a)
            value, owner = np.concatenate(values), np.concatenate(owners)
            order = np.lexsort((owner, value))
            value, owner = value[order], owner[order]
            fresh = np.ones(len(value), bool)
            fresh[1:] = value[1:] != value[:-1]
            group = np.cumsum(fresh) - 1
            total = np.bincount(group, count[owner]) if len(group) else np.zeros(0)
            once = fresh.copy()
            once[1:] |= owner[1:] != owner[:-1]
            known = (total >= 2)[group[once]] if len(group) else np.zeros(0, bool)
            fp, text = value[once], owner[once]
            k1, k2 = (batch[k].to_numpy()[first][text] for k in ("k1", "k2"))
            # A settled anchor sends one row to where it is counted, and its texts anywhere else.
            dest = np.where(known, mixed(fp ^ mixed(k1.view(np.uint64).copy())), fp)
            marks = np.unique(fp[known])
            n = len(marks)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([dest, marks]).view(np.int64)),
                pa.array(np.concatenate([fp, marks]).view(np.int64)),
                pa.concat_arrays([pa.array(k1), pa.nulls(n, pa.int64())]),
                pa.concat_arrays([pa.array(k2), pa.nulls(n, pa.int64())]),
                pa.array(np.concatenate([known, np.ones(n, bool)]))], names=["dest", "fp", "k1", "k2", "known"])

    return rows


def _pieces_of(first: np.ndarray, last: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows cut into such of at most ``most``: first and last window, and the run of each."""
    number = (last - first) // most + 1
    run = np.repeat(np.arange(len(first)), number)
    begin = first[run] + most * (np.arange(len(run)) - (np.cumsum(number) - number)[run])
    return begin, np.minimum(begin + most - 1, last[run]), run


def _content_rows(kind: Windows, most: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first, inverse, count = _distinct(batch)
            ids = batch["id"].to_numpy(zero_copy_only=False)
            least_id = np.full(len(first), np.iinfo(np.int64).max)
            np.minimum.at(least_id, inverse, ids)
            lists = batch["fps"].take(pa.array(first))
            seen: set[tuple[int, int]] = set()
            for a, b, some in slices(batch["text"].take(pa.array(first))):
                u = units(some, kind)
                found = anchored(u, kind)
                some_lists = lists.slice(a, b - a)
                wanted = some_lists.flatten().to_numpy().view(np.uint64)
                owner = np.repeat(np.arange(b - a), np.diff(some_lists.offsets.to_numpy()))
                salted = lambda v, t: v ^ mixed(t.astype(np.uint64) + np.uint64(1))
                keep = np.isin(salted(found.run_value, found.run_text), salted(wanted, owner))
                s, last, run = _pieces_of(found.first[keep], found.last[keep], most)
                e = last + kind.window
                fp, text = found.run_value[keep][run], found.run_text[keep][run]
                n = len(u.values)
                inverse_base = pow(BASES[0], -1, 1 << 64)
                sums = np.zeros(n + 1, np.uint64)
                np.cumsum(u.values * powers(BASES[0], n), out=sums[1:])
                h = mixed((sums[e] - sums[s]) * powers(inverse_base, n + 1)[s])
                # Runs that hold their anchor more than once may hold a window twice.
                names, dense = np.unique(found.value, return_inverse=True)
                spots = np.sort(dense.astype(np.int64) << 40 | found.place)
                at = np.searchsorted(names, fp).astype(np.int64) << 40
                multi = np.searchsorted(spots, at | (last + kind.width)) - np.searchsorted(spots, at | s) > 1
                content = []
                for i, pair in enumerate(zip(fp.tolist(), h.tolist(), strict=True)):
                    content.append(None if pair in seen else u.content(s[i], e[i]))
                    seen.add(pair)
                row = first[a:b][text]
                yield pa.RecordBatch.from_arrays([
                    pa.array(batch["k1"].to_numpy()[row]), pa.array(batch["k2"].to_numpy()[row]),
                    pa.array(fp.view(np.int64)), pa.array(h.view(np.int64)),
                    pa.array((s - u.of[:-1][text]).astype(np.int32)), pa.array((e - s).astype(np.int32)),
                    pa.array(count[a:b][text]), pa.array(least_id[a:b][text]), pa.array(multi),
                    pa.array(content, pa.binary())],
                    names=["k1", "k2", "fp", "h", "start", "size", "n", "least", "multi", "content"])

    return rows


def pieces(content: bytes, kind: Windows) -> list[bytes]:
    return content.split(b" ") if kind.unit == "word" else content


def segments(a: np.ndarray, least: np.ndarray, count: np.ndarray) -> list[dict]:
    """Window starts on end with the same least id and count, as one segment each."""
    if not len(a):
        return []
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1] + 1) | (least[1:] != least[:-1]) | (count[1:] != count[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(a)) - 1
    return [{"a": int(a[x]), "b": int(a[y]), "least": int(least[x]), "count": int(count[x])}
            for x, y in zip(begin, end, strict=True)]


def _window_rows(kind: Windows):
    """Every window of each content as a row of its own, by two hashes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                content = row["content"]
                u = units(Texts(np.frombuffer(content, np.uint8), np.array([0, len(content)])), kind)
                n = len(u.values) - kind.window + 1
                hashes = []
                for base in BASES:
                    sums = np.zeros(len(u.values) + 1, np.uint64)
                    np.cumsum(u.values * powers(base, len(u.values)), out=sums[1:])
                    whole = (sums[kind.window:] - sums[:-kind.window]) * powers(pow(base, -1, 1 << 64), n)
                    hashes.append(pa.array(mixed(whole).view(np.int64)))
                same = lambda name: pa.array(np.full(n, row[name], np.int64))  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays(
                    [*hashes, same("fp"), same("h"), pa.array(np.arange(n, dtype=np.int32)), same("c"), same("m")],
                    names=["w1", "w2", "fp", "h", "at", "c", "m"])

    return rows


def recurring(documents: DataFrame, kind: Windows, shard: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """(k1, k2, found) for texts with recurring windows.

    ``documents``: id, k1, k2 and text, none of them null. ``found`` lists segments of window starts
    with the least id of a document that holds the window and how often it stands in the corpus.
    ``shard`` turns contents (fp, h, content, c, m) into (fp, h, found), windows of one anchor together.
    """
    lone = documents.select("k1", "k2", "text").mapInArrow(
        _anchor_rows(kind), "dest long, fp long, k1 long, k2 long, known boolean")
    met = F.count("*").over(Window.partitionBy("dest"))
    lists = cut(lone.withColumn("met", met).filter("k1 is not null and (known or met > 1)")
                .groupBy("k1", "k2").agg(F.collect_set("fp").alias("fps")), "recurring-anchors")
    contents = cut(documents.join(lists, ["k1", "k2"]).mapInArrow(
        _content_rows(kind, PIECE), "k1 long, k2 long, fp long, h long, start int, size int, n long, least long, "
                             "multi boolean, content binary"), "anchor-contents")
    totals = contents.groupBy("fp", "h").agg(
        F.sum("n").alias("c"), F.min("least").alias("m"), F.max("multi").alias("multi"), F.max("size").alias("size"),
        F.max(F.octet_length("content")).cast("long").alias("bytes"))
    totals = cut(totals, "content-totals")
    held_bytes = F.greatest("bytes", F.col("size").cast("long") * (1 if kind.unit == "byte" else 8))
    kinds = totals.groupBy("fp").agg(
        F.count("*").alias("d"), F.max("multi").alias("any_multi"), F.sum(held_bytes).alias("bytes"))
    plain = totals.join(kinds.filter("d = 1 and not any_multi").select("fp"), "fp", "left_semi").filter("c > 1")
    known = plain.select("fp", "h", F.array(F.struct(
        F.lit(0).alias("a"), (F.col("size") - kind.window).alias("b"), F.col("m").alias("least"),
        F.col("c").alias("count"))).cast(SEGMENTS).alias("found"))

    def distinct_contents(wanted: DataFrame) -> DataFrame:
        held = contents.filter("content is not null").join(wanted.select("fp"), "fp", "left_semi")
        return held.groupBy("fp", "h").agg(F.first("content").alias("content")).join(
            totals.select("fp", "h", "c", "m"), ["fp", "h"])

    shared = kinds.filter((F.col("d") > 1) | F.col("any_multi"))
    crowded = (F.col("d") > MOST_CONTENTS) | (F.col("bytes") > MOST_BYTES)
    few = distinct_contents(shared.filter(~crowded))
    size = totals.join(shared.select("fp"), "fp", "left_semi").agg(
        F.coalesce(F.sum(held_bytes), F.lit(0))).first()[0]
    shards = max(1, -(-int(size) // SHARD_BYTES))
    compared = few.withColumn("shard", F.pmod(F.xxhash64("fp"), F.lit(shards))).groupBy("shard").applyInArrow(
        lambda part: shard(part), f"fp long, h long, found {SEGMENTS}")
    rows = cut(distinct_contents(shared.filter(crowded)).mapInArrow(
        _window_rows(kind), "w1 long, w2 long, fp long, h long, at int, c long, m long"), "windows")
    sums = rows.groupBy("w1", "w2").agg(F.sum("c").alias("count"), F.min("m").alias("lowest")).filter("count > 1")
    counted = rows.join(sums, ["w1", "w2"]).groupBy("fp", "h").agg(F.collect_list(F.struct(
        F.col("at").alias("a"), F.col("at").alias("b"), F.col("lowest").alias("least"), "count")).cast(SEGMENTS).alias("found"))
    verdicts = cut(known.union(compared).union(counted).filter(F.size("found") > 0), "verdicts")
    # Back to the texts: one row for each place, shifted to the text's own count. A text that several
    # batches held tells its places more than once, which marks nothing twice.
    return cut(
        contents.select("k1", "k2", "fp", "h", "start").join(verdicts, ["fp", "h"])
        .select("k1", "k2", F.explode("found").alias("x"), "start")
        .groupBy("k1", "k2").agg(F.collect_list(F.struct(
            (F.col("start") + F.col("x.a")).alias("a"), (F.col("start") + F.col("x.b")).alias("b"),
            F.col("x.least").alias("least"), F.col("x.count").alias("count"))).cast(SEGMENTS).alias("found")),
        "recurring-windows",
    )


def text_keys(text) -> list:
    """Two hashes that name a text."""
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(20), text).alias("k2")]


def starts_of(found: list[dict] | None, chosen: Callable[[dict], bool], window: int, n: int) -> np.ndarray:
    """A mark for each of ``n`` units that a chosen window covers."""
    change = np.zeros(n + 1, np.int32)
    for x in found or ():
        if chosen(x):
            change[x["a"]] += 1
            change[x["b"] + window] -= 1
    return np.cumsum(change[:-1]) > 0
