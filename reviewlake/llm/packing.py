"""Packing of token sequences by bin completion with branch and bound.

Documents become ids, and what is longer than a sequence is cut into pieces. How many pieces there are
of each length is all that a packing depends on, so the search runs on that table: at most one row for
each length up to the capacity, whatever the corpus holds. A solution is a list of fillings with the
number of sequences that have each; a piece finds its sequence by its rank among those of its length.

Bin completion takes the largest length left and tries the fillings around it that none dominates: no
subset of a filling can give way to one piece left out that is at least as large and still fits. A
branch is cut where the waste it has made shows that it cannot beat the incumbent, which at first is
the best-fit packing. The search ends at the lower bound or after ``nodes`` steps.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.window import Window

from reviewlake.llm.bpe import vocabulary
from reviewlake.llm.common import cut, registered, row_but, table
from reviewlake.llm.units import stretches, word_ids

CAPACITY = 2048
# Steps of the search, and fillings tried around one largest piece.
NODES, FILLINGS = 6_000, 6
# Rows of a file that are ranked together.
RANKED = 1 << 18

Filling = tuple[int, ...]


def best_fit(counts: Counter, capacity: int) -> dict[Filling, int]:
    """Fillings of the best-fit packing in order of decreasing length, with how many bins have each."""
    open_bins: dict[int, Counter] = {}
    done: Counter = Counter()

    def put(filling: Filling, n: int) -> None:
        room = capacity - sum(filling)
        if room:
            open_bins.setdefault(room, Counter())[filling] += n
        else:
            done[filling] += n

    for length in sorted(counts, reverse=True):
        left = counts[length]
        # Rooms only shrink while this length is dealt, so one pass upwards meets the tightest first;
        # what stays open with room for the same length is met again at its new, smaller room.
        while left:
            room = min((r for r in open_bins if r >= length), default=0)
            if not room:
                per = capacity // length
                full, rest = divmod(left, per)
                if full:
                    put((length,) * per, full)
                if rest:
                    put((length,) * rest, 1)
                break
            fillings = open_bins[room]
            filling, bins = next(iter(fillings.items()))
            per = room // length
            take = min(bins, left // per) if left >= per else 1
            times = per if left >= per else left
            fillings[filling] -= take
            if not fillings[filling]:
                del fillings[filling]
                if not fillings:
                    del open_bins[room]
            put(filling + (length,) * times, take)
            left -= take * times
    for fillings in open_bins.values():
        done.update(fillings)
    return dict(done)


def lower_bound(counts: Counter, capacity: int) -> int:
    """Bins that any packing needs: by the sum, and with pieces above a length alone with what fits them."""
    lengths = np.array(sorted(counts), np.int64)
    if not len(lengths):
        return 0
    n = np.array([counts[x] for x in lengths.tolist()], np.int64)
    best = -(-int((lengths * n).sum()) // capacity)
    for small in [x for x in lengths.tolist() if x <= capacity // 2]:
        large = lengths > capacity - small
        middle = (lengths > capacity // 2) & ~large
        light = (lengths >= small) & (lengths <= capacity // 2)
        room = int((n[middle] * (capacity - lengths[middle])).sum())
        over = max(0, int((n[light] * lengths[light]).sum()) - room)
        best = max(best, int(n[large].sum() + n[middle].sum()) - (-over // capacity))
    return best


def _bits(values) -> int:
    out = 0
    for x in values:
        out |= 1 << x
    return out


def undominated(counts: Counter, largest: int, capacity: int, most: int) -> Iterator[Filling]:
    """Fillings around one piece of the largest length, fullest first; at most ``most`` of them.

    Sets of sums are bits of whole numbers. Sums are tried downwards from the fullest; those that the
    lengths from some place on can reach lead to a sum's fillings without dead ends.
    """
    room = capacity - largest
    lengths = [x for x in sorted(counts, reverse=True) if x <= room and counts[x] > (x == largest)]
    if not lengths or lengths[0] == room:
        yield (room,) if lengths else ()  # nothing dominates a piece that fills the rest
        return
    held = {x: counts[x] - (x == largest) for x in lengths}
    whole, reach = (2 << room) - 1, [1]
    for x in reversed(lengths):
        sums, times, step = reach[-1], min(held[x], room // x), 1
        while times:
            step = min(step, times)
            sums |= sums << step * x
            times, step = times - step, step * 2
        reach.append(sums & whole)
    reach.reverse()  # reach[i]: sums of lengths[i:]
    available = _bits(lengths)

    def dominated(filling: Filling, slack: int) -> bool:
        """Whether some of it, but no one piece for its equal, can give way to a larger piece left out."""
        used, sums = Counter(filling), 1
        for x in filling:
            sums |= sums << x
        out = available & ~_bits(x for x, n in used.items() if n == held[x])
        equal = sums & ~_bits(used) & out
        return bool(equal) or any(sums << d & out for d in range(1, slack + 1))

    def of_sum(rest: int, start: int) -> Iterator[Filling]:
        if not rest:
            yield ()
            return
        for i in range(start, len(lengths)):
            if not reach[i] >> rest & 1:
                return
            x = lengths[i]
            for n in range(min(held[x], rest // x), 0, -1):
                if reach[i + 1] >> rest - n * x & 1:
                    for tail in of_sum(rest - n * x, i + 1):
                        yield (x,) * n + tail

    found, tried, total = 0, 0, room
    while total > 0 and found < most and tried < 8 * most:
        for filling in of_sum(total, 0) if reach[0] >> total & 1 else ():
            tried += 1
            if not dominated(filling, room - total):
                found += 1
                yield filling
            if found >= most or tried >= 8 * most:
                break
        total -= 1
    if not found:
        yield next(of_sum(reach[0].bit_length() - 1, 0))


def bin_completion(counts: Counter, capacity: int = CAPACITY, nodes: int = NODES, most: int = FILLINGS) -> dict[Filling, int]:
    """Fillings and how many bins have each, as few bins as the search finds."""
    counts = Counter({x: n for x, n in counts.items() if n > 0})
    best = best_fit(counts, capacity)
    fewest, bound = sum(best.values()), lower_bound(counts, capacity)
    total = sum(x * n for x, n in counts.items())
    left, steps = counts.copy(), 0
    # Each entry of the stack is an open branch: the fillings so far, and how far it went.
    path: list[tuple[Filling, int]] = []

    def choices() -> Iterator[tuple[Filling, int]]:
        largest = max(x for x, n in left.items() if n > 0)
        for filling in undominated(left, largest, capacity, most):
            whole = (largest, *filling)
            times = min(left[x] // n for x, n in Counter(whole).items())
            # As often as it goes, and once, if that leaves another choice for the next bin.
            for n in (times, 1) if times > 1 else (1,):
                yield whole, n

    def change(whole: Filling, n: int) -> None:
        for x in whole:
            left[x] += n

    used = waste = 0
    stack = [choices()] if total else []
    while stack and fewest > bound and steps < nodes:
        move = next(stack[-1], None)
        if move is None:
            stack.pop()
            if path:
                whole, n = path.pop()
                change(whole, n)
                used, waste = used - n, waste - n * (capacity - sum(whole))
            continue
        steps += 1
        whole, n = move
        now, wasted = used + n, waste + n * (capacity - sum(whole))
        # With this much waste, so many bins at least hold what there is.
        if -(-(total + wasted) // capacity) >= fewest:
            continue
        change(whole, -n)
        if not any(left.values()):
            fewest, best = now, Counter()
            for done, times in [*path, (whole, n)]:
                best[done] += times
            change(whole, n)
            continue
        path.append((whole, n))
        used, waste = now, wasted
        stack.append(choices())
    return dict(best)


@dataclass(frozen=True)
class Places:
    """For each length, from which rank on pieces go to which sequences, and where in them.

    Rank ``first[i] + k`` goes to sequence ``sequence[i] + k // per[i]`` at ``offset[i] + k % per[i] * length``.
    """

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    per: np.ndarray
    offset: np.ndarray

    def of(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = self.length << 44 | self.first
        at = np.searchsorted(key, length << 44 | rank, "right") - 1
        k = rank - self.first[at]
        return self.sequence[at] + k // self.per[at], self.offset[at] + k % self.per[at] * length


def places(fillings: dict[Filling, int]) -> Places:
    taken: Counter = Counter()
    rows, sequence = [], 0
    for filling, bins in sorted(fillings.items(), reverse=True):
        offset = 0
        for length, per in sorted(Counter(filling).items(), reverse=True):
            rows.append((length, taken[length], sequence, per, offset))
            taken[length] += per * bins
            offset += length * per
        sequence += bins
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Places(*columns)


def token_pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, end: int = 0) -> DataFrame:
    """Every document's ids, with ``end`` after them, in pieces of at most ``capacity``.

    Adds ``pieces``: piece (from 0), start, length and ids (unsigned 32-bit numbers, little-endian, on
    end). A null or empty text has the one id ``end``. Every row is cut by itself: repeated rows and
    ids are kept, other columns pass through unchanged; a column named ``pieces`` gives way.
    """
    kept = documents.select(row_but(documents, "pieces"), F.col("text").alias("text"))
    row = kept.schema["row"]
    found = StructType.fromDDL("piece int, start long, length long, ids binary")
    mark = np.array([end], np.uint32).tobytes()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(path)
        for batch in batches:
            for first, last, texts in stretches(batch["text"]):
                owner, piece, start, length, ids = [], [], [], [], []
                for i, data in enumerate(words.ids(texts), first):
                    data += mark
                    n = len(data) // 4
                    for k, s in enumerate(range(0, n, capacity)):
                        e = min(n, s + capacity)
                        owner.append(i)
                        piece.append(k)
                        start.append(s)
                        length.append(e - s)
                        ids.append(data[4 * s:4 * e])
                yield pa.RecordBatch.from_arrays([
                    batch["row"].take(pa.array(owner, pa.int32())),
                    pa.StructArray.from_arrays([
                        pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                        pa.array(ids, pa.binary())], names=["piece", "start", "length", "ids"])], names=["row", "pieces"])

    return kept.mapInArrow(cut_up, StructType([row, StructField("pieces", found)])).select("row.*", "pieces")


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Adds ``packed`` (sequence_id, offset) to rows with a ``length`` from 1 to ``capacity``.

    The driver gets one count for each length. Ranks are taken within blocks of a written file, so a
    length that a third of all rows have is ranked in as many tasks as there are blocks of it. An empty
    table gives an empty result; equal rows get places of their own; a length of null or out of range
    is an error.
    """
    held = cut(pieces.select(F.struct(*(pieces[c] for c in pieces.columns if c != "packed")).alias("row"),
                             pieces["length"].cast("long").alias("length")), "pieces")
    wrong = F.col("length").isNull() | (F.col("length") < 1) | (F.col("length") > capacity)
    counts = held.groupBy(F.when(~wrong, F.col("length")).alias("length")).count().collect()
    if any(r["length"] is None for r in counts):
        raise ValueError(f"a piece has no length from 1 to {capacity}")
    plan = places(bin_completion(Counter({r["length"]: r["count"] for r in counts}), capacity, nodes))
    block = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / RANKED))
    rows = held.select("row", "length", block.alias("block"), F.col("_metadata.row_index").alias("at"))
    in_block = rows.groupBy("length", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    begins = in_block.select("length", "block", F.coalesce(before, F.lit(0)).alias("begin"))
    rank = F.row_number().over(Window.partitionBy("length", "block").orderBy("at")) - 1
    ranked = rows.withColumn("rank", rank.cast("long")).join(begins, ["length", "block"])

    @F.arrow_udf("sequence_id long, offset long")
    def placed(length: pa.Array, at: pa.Array) -> pa.Array:
        sequence, offset = plan.of(length.to_numpy(), at.to_numpy())
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"])

    return ranked.select("row", placed("length", F.col("begin") + F.col("rank")).alias("packed")).select("row.*", "packed")


def pack_documents(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with their ids and places: ``pieces`` and ``packed``."""
    cut_up = token_pieces(documents, path, capacity)
    sized = cut_up.select(F.struct("*").alias("doc"), F.col("pieces.length").alias("length"))
    return pack_pieces(sized, capacity).select("doc.*", "packed")


@registered("op13_best_fit_packing")
def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    pieces = token_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary())
    flat = pieces.select("doc_id", "pieces.piece", "pieces.start", "pieces.length", F.crc32("pieces.ids").alias("ids_crc32"))
    return pack_pieces(flat).select("doc_id", "piece", "start", "length", "ids_crc32", "packed.*")
