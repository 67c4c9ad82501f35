"""Alignment of two tokenizers over the same bytes, by divide and conquer at shared cuts.

Both tokenizers end a token at some common byte offsets. In an interval without a known cut, a common end
nearest to its middle is looked for by bisecting the other's ends, outwards in growing steps; it divides the
interval in two, and ends that were looked at are left out of both. All intervals of a level are divided
together. What has no common end inside is a leaf: a group of tokens of either side.

Texts go through both libraries in parts between spaces, each part once while it is remembered. No token of
either vocabulary crosses such a place, so a stretch of a long text ends there and is aligned by itself.

How many documents link a pair of ids is counted over the corpus. Some megabytes of text form a
block; a block tells its distinct pairs once, is given their counts, and applies them to its documents.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reviewlake.llm.bpe import byte_letters, vocabulary
from reviewlake.llm.common import cut, registered, row_but, table
from reviewlake.llm.toxicity import spread
from reviewlake.llm.units import Parts, stretches

# Parts remembered, characters of a stretch, bytes of text in a block.
REMEMBERED, STRETCH, BLOCK_BYTES = 200_000, 1 << 20, 1 << 23
# From so many links on, a group's ids are counted before they are paired.
LARGE = 1 << 12
# Letters of Latin scripts, which both vocabularies take for letters.
LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
MARKS = "!-/:-@\\[-`{-~"
CUT = re.compile(r"(?<=[^ \t-\r])(?= )")
# White space beyond ASCII, and separators that only Python calls so: such texts are taken whole.
UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0  -     　]")

ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups string, block long, links binary, pairs binary"


class Pair:
    """Both tokenizers: ids of a text, and the bytes of each id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=path_b)
        byte = {letter: i for i, letter in enumerate(byte_letters())}
        names = sorted(((i, s) for s, i in self.a.get_vocab(with_added_tokens=True).items()))
        self.bytes_a = {i: bytes(byte[c] for c in s) if all(c in byte for c in s) else s.encode() for i, s in names}
        self.bytes_b = {}
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            self.bytes_b[i] = bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
        self.size_a, self.size_b = (np.array([len(x.get(i, b"")) for i in range(max(x) + 1)], np.int64)
                                    for x in (self.bytes_a, self.bytes_b))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        inner = {c for p in pieces if len(p) < 6 or not p.startswith("<0x") for x, c in zip(p, p[1:]) if x.isalpha()}
        safe = "".join(re.escape(chr(c)) for c in range(128) if not chr(c).isalpha() and chr(c) not in inner)
        self.lines_apart = not any("\n" in p for p in pieces)
        # A word before what never joins a letter; a line end; marks before a space or a line end; else all
        # up to a space that follows no white space, with tabs and line ends in between.
        self.part = re.compile(
            rf" ?[{LETTERS}]+(?=[{safe}]|\Z)|\n(?=[^ \t-\r])|[{MARKS}]+(?= |\n[^ \t-\r]|\Z)|"
            r"[ \t-\r]*[^ \t-\r]+(?:[\t-\r][ \t-\r]*[^ \t-\r]+)*(?:[\t-\r][ \t-\r]*\Z)?|[ \t-\r]+")
        self.word = re.compile(f" ?[{LETTERS}]+")
        self.letters = dict(enumerate(byte_letters()))
        self.parts = Parts(self._encoded, REMEMBERED)

    def _encoded(self, parts: list[str]) -> Iterator[tuple[bytes, bytes] | None]:
        """Ids of parts as 16-bit numbers; None where the bytes are not the part's.

        A line end, which joins nothing, stands for what is before a part without a space.
        """
        word, tokenize, letters = self.word.fullmatch, self.a.model.tokenize, self.letters
        words = [word(p) is not None for p in parts]
        others = [p for p, single in zip(parts, words, strict=True) if not single]
        left = iter(self.a.encode_batch_fast(others, add_special_tokens=False)) if others else iter(())
        right = self.b.encode([p[1:] if p[:1] == " " and p != " " else "\n" + p for p in parts], num_threads=1)
        for part, single, b in zip(parts, words, right, strict=True):
            if part == " " or part[:1] != " ":
                b = b[2:]
            if single:
                a = [t.id for t in tokenize(part.encode().decode("latin-1").translate(letters))]
            else:
                a = next(left).ids
            if not (single and part.isascii()):
                data = part.encode()
                if not data == b"".join([self.bytes_a[i] for i in a]) == b"".join([self.bytes_b[i] for i in b]):
                    yield None
                    continue
            yield array("H", a).tobytes(), array("H", b).tobytes()

    def stretches(self, text: str) -> list[tuple[bytes, bytes]] | None:
        """Ids of a text's stretches by either side; None if it has no tokens."""
        if not text or "▁" in text:
            return None
        text = " " + text
        if UNUSUAL.search(text) or not self.lines_apart:
            whole = next(iter(self._encoded([text])))
            return None if whole is None else [whole]
        out = []
        for some in self._cut(text):
            parts = self.part.findall(some)
            held = self.parts.of(set(parts))
            ids = [held[p] for p in parts]
            if None in ids:
                return None
            out.append((b"".join([a for a, _ in ids]), b"".join([b for _, b in ids])))
        return out

    @staticmethod
    def _cut(text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > STRETCH and (found := CUT.search(text, start + STRETCH)):
            yield text[start:found.start()]
            start = found.start()
        yield text[start:]


@lru_cache(maxsize=2)
def both(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Marks the ends in ``ends_a`` that are common; each interval [first, last) of them is divided."""
    cuts = np.zeros(len(ends_a), bool)
    lo, hi = first[first < last], last[first < last]
    while len(lo):
        mid, at = (lo + hi) >> 1, np.full(len(lo), -1)
        open_, inner, outer = np.arange(len(lo)), np.zeros(len(lo), np.int64), 1
        while len(open_):
            # Places from ``inner`` to ``outer`` steps away from the middle, on either side.
            m, start = mid[open_], inner[open_]
            left = np.maximum(lo[open_], m - outer + 1), m - start + 1
            right = m + np.maximum(start, 1), np.minimum(hi[open_], m + outer)
            n_left, n_right = (np.maximum(0, e - s) for s, e in (left, right))
            place = np.concatenate([spread(left[0], n_left), spread(right[0], n_right)])
            owner = np.concatenate([np.repeat(np.arange(len(open_)), n_left), np.repeat(np.arange(len(open_)), n_right)])
            value = ends_a[place]
            beside = np.searchsorted(ends_b, value)
            hit = np.flatnonzero(ends_b[np.minimum(beside, len(ends_b) - 1)] == value)
            if len(hit):
                # Of each interval the nearest; of two as near, the left one.
                order = np.lexsort((place[hit], np.abs(place[hit] - m[owner[hit]]), owner[hit]))
                own, index = np.unique(owner[hit][order], return_index=True)
                at[open_[own]] = place[hit][order][index]
            unfinished = (at[open_] < 0) & ((m - outer >= lo[open_]) | (m + outer < hi[open_]))
            inner[open_] = outer
            open_, outer = open_[unfinished], outer * 4
        found = at >= 0
        lo, hi, mid, at = lo[found], hi[found], mid[found], at[found]
        cuts[at] = True
        far = np.abs(at - mid)
        # Nothing nearer to the middle is common; a place as far away on the right side may be.
        after = np.where(at < mid, mid + far, at + 1)
        before = np.where(at > mid, mid - far, at)
        lo, hi = np.concatenate([lo, after]), np.concatenate([before, hi])
        some = lo < hi
        lo, hi = lo[some], hi[some]
    return cuts


_DIGITS = np.array([list(b"%05d" % i) for i in range(1 << 16)], np.uint8)
_SHOWN = np.array([[i >= 10 ** (4 - k) or k == 4 for k in range(5)] for i in range(1 << 16)], bool)


def _texts(a, b, na, nb, group_ends) -> list[bytes]:
    """``a1,a2|b1;a3|b2`` for the groups of each stretch; ``group_ends``: where each stretch's groups end."""
    n = len(a) + len(b)
    before_a, before_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    at_a, at_b = spread(before_a + before_b, na), spread(before_a + na + before_b, nb)
    ids, mark = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
    ids[at_a], ids[at_b] = a, b
    ends = before_a + before_b + na
    mark[ends - 1] = ord("|")
    mark[ends + nb - 1] = ord(";")
    shown = np.ones((n, 6), bool)
    shown[:, :5] = _SHOWN[ids]
    bytes_ = np.empty((n, 6), np.uint8)
    bytes_[:, :5], bytes_[:, 5] = _DIGITS[ids], mark
    data = bytes_[shown]
    sizes = np.append(0, np.cumsum(shown.sum(1)))
    edges = np.append(0, sizes[(ends + nb)[group_ends - 1]])
    return [data[s:max(s, e - 1)].tobytes() for s, e in zip(edges[:-1], edges[1:], strict=True)]


def _pairs(a, b, na, nb, owner) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (stretch, pair of ids) as one number, and how many links each has."""
    before_a, before_b = np.cumsum(na) - na, np.cumsum(nb) - nb
    small = na * nb <= LARGE
    tokens = spread(before_a[small], na[small])
    per = np.repeat(nb[small], na[small])
    partner = spread(np.repeat(before_b[small], na[small]), per)
    key = np.repeat(owner[small], na[small] * nb[small]) << 32 | np.repeat(a[tokens], per) << 16 | b[partner]
    keys, counts = np.unique(key, return_counts=True)
    found = [(keys, counts)]
    for g in np.flatnonzero(~small).tolist():
        (x, nx), (y, ny) = (np.unique(v[s:s + n], return_counts=True) for v, s, n in (
            (a, before_a[g], na[g]), (b, before_b[g], nb[g])))
        found.append(((owner[g] << 32 | x[:, None] << 16 | y[None, :]).reshape(-1), (nx[:, None] * ny[None, :]).reshape(-1)))
    return _summed([x for x, _ in found], [x for _, x in found])


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if len(keys) == 1:
        return keys[0], counts[0]
    names, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(names), np.int64)
    np.add.at(total, place, np.concatenate(counts))
    return names, total


def aligned(pair: Pair, texts: list[str]) -> list[tuple]:
    """For each text n_a, n_b, n_groups, n_links, groups, and its pairs of ids with their numbers of links."""
    found, parts = [], []
    for i, text in enumerate(texts):
        for a, b in pair.stretches(text) or ():
            found.append(i)
            parts.append((np.frombuffer(a, np.uint16).astype(np.int64), np.frombuffer(b, np.uint16).astype(np.int64)))
    none = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
    if not parts:
        return [none] * len(texts)
    a, b = (np.concatenate([x[side] for x in parts]) for side in (0, 1))
    n_a, n_b = (np.array([len(x[side]) for x in parts]) for side in (0, 1))
    ends_a, ends_b = np.cumsum(pair.size_a[a]), np.cumsum(pair.size_b[b])
    closes = np.cumsum(n_a)
    # The end of a stretch is common by itself.
    cuts = shared_cuts(ends_a, ends_b, closes - n_a, closes - 1)
    cuts[closes - 1] = True
    at_a = np.flatnonzero(cuts)
    at_b = np.searchsorted(ends_b, ends_a[at_a])
    na, nb = np.diff(at_a, prepend=-1), np.diff(at_b, prepend=-1)
    owner = np.searchsorted(closes, at_a, "right")
    group_ends = np.searchsorted(at_a, closes - 1) + 1
    groups = _texts(a, b, na, nb, group_ends)
    n_groups = np.diff(group_ends, prepend=0)
    n_links = np.bincount(owner, na * nb, len(parts)).astype(np.int64)
    keys, counts = _pairs(a, b, na, nb, owner)
    edges = np.searchsorted(keys >> 32, np.arange(len(parts) + 1))
    out, k = [], 0
    for i in range(len(texts)):
        some = k
        while k < len(found) and found[k] == i:
            k += 1
        if some == k:
            out.append(none)
            continue
        own = [slice(edges[s], edges[s + 1]) for s in range(some, k)]
        names, total = _summed([keys[s] & 0xFFFFFFFF for s in own], [counts[s] for s in own])
        out.append((int(n_a[some:k].sum()), int(n_b[some:k].sum()), int(n_groups[some:k].sum()), int(n_links[some:k].sum()),
                    b";".join(groups[some:k]).decode(), names, total))
    return out


def _stored(places: np.ndarray, times: np.ndarray) -> bytes:
    """Rising places, as differences, and how often each: byte by byte of all numbers, compressed."""
    numbers = np.concatenate([np.diff(places, prepend=0), times]).astype(np.uint32)
    return zstandard.compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _read(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    numbers = np.ascontiguousarray(planes.T).view(np.uint32).reshape(2, -1).astype(np.int64)
    return np.cumsum(numbers[0]), numbers[1]


class _Block:
    """Results of some documents that are told together: links by their place among the block's pairs."""

    def __init__(self, number: int):
        self.number, self.bytes, self.rows, self.results = number, 0, [], []

    def batch(self) -> pa.RecordBatch:
        keys = [r[5] for r in self.results]
        names, place, times = np.unique(np.concatenate(keys), return_inverse=True, return_counts=True)
        # Pairs that more documents hold come first, so that their places are small numbers.
        order = np.argsort(-times, kind="stable")
        to = np.empty(len(names), np.int64)
        to[order] = np.arange(len(names))
        links, at = [], 0
        for *_, key, total in self.results:
            spots = to[place[at:at + len(key)]]
            at += len(key)
            sort = np.argsort(spots)
            links.append(_stored(spots[sort], total[sort]) if len(key) else None)
        pairs = np.stack([names[order], times[order]]).astype(np.int64).tobytes()
        n = len(self.results)
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays(self.rows), *(pa.array([r[k] for r in self.results], pa.int64()) for k in range(4)),
             pa.array([r[4] for r in self.results], pa.string()), pa.array(np.full(n, self.number)),
             pa.array(links, pa.binary()), pa.array([pairs] + [None] * (n - 1), pa.binary())],
            names=["row", "n_a", "n_b", "n_groups", "n_links", "groups", "block", "links", "pairs"])


def align(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The documents with ``aligned``: n_a, n_b, n_groups, n_links, groups and what ``count_links`` takes.

    ``groups`` lists the ids of each group: ``a1,a2|b1;a3|b2,b3``.

    - A text that is null, empty or holds bytes that a tokenizer does not give back has no tokens: zeros
      and an empty text.
    - Every row is aligned by itself, whatever its length; repeated rows and ids are kept. An empty table
      gives an empty result. Other columns pass through unchanged; a column ``aligned`` gives way.
    """
    kept = documents.select(row_but(documents, "aligned"), F.col("text").alias("text"))
    return _align(kept, path_a, path_b).select("row.*", "aligned")


def _align(kept: DataFrame, path_a: str, path_b: str) -> DataFrame:
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = both(path_a, path_b)
        task = TaskContext.get().partitionId() << 32
        block = _Block(task)
        for batch in batches:
            for first, last, texts in stretches(batch["text"]):
                block.rows.append(batch["row"].slice(first, last - first))
                block.results += aligned(pair, texts)
                block.bytes += sum(map(len, texts))
                if block.bytes >= BLOCK_BYTES:
                    yield block.batch()
                    block = _Block(block.number + 1)
        if block.results:
            yield block.batch()

    found = StructType.fromDDL(ALIGNED)
    done = kept.mapInArrow(blocks, StructType([kept.schema["row"], *found]))
    return done.select("row", F.struct(*found.names).alias("aligned"))


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, pairs in zip(batch["block"].to_pylist(), batch["pairs"], strict=True):
            key, times = np.frombuffer(pairs.as_buffer(), np.int64).reshape(2, -1)
            n = len(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), pa.array(np.arange(n, dtype=np.int32)), pa.array(key), pa.array(times)],
                names=["block", "at", "key", "times"])


def _applied(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums over a block's documents by the counts of its pairs."""
    counts, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
    at = right["at"].to_numpy()
    counts[at], best[at] = right["count"].to_numpy(), right["best"].to_numpy()
    n_best, count_sum = [], []
    for links in left["links"].to_pylist():
        places, times = _read(links) if links else (np.zeros(0, np.int64),) * 2
        n_best.append(int((best[places] * times).sum()))
        count_sum.append(int((counts[places] * times).sum()))
    return pa.table([left["row"], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())],
                    names=["row", "n_best", "count_sum"])


def count_links(aligned_rows: DataFrame) -> DataFrame:
    """Adds ``counted`` (n_best, count_sum) to rows of ``align``, of which ``aligned`` is dropped.

    A pair of ids counts once for each row that links it. ``n_best`` are a row's links whose count is
    the highest of their first id, ``count_sum`` is the sum of counts over its links. The best count of
    each first id is broadcast: there are no more of them than the first vocabulary has ids.
    """
    kept = aligned_rows.select(
        F.struct(*(aligned_rows[c] for c in aligned_rows.columns if c not in ("aligned", "counted"))).alias("row"),
        *(F.col(f"aligned.{c}").alias(c) for c in ("block", "links", "pairs")))
    rows = cut(kept, "aligned")
    pairs = rows.filter("pairs is not null").select("block", "pairs").mapInArrow(
        _block_pairs, "block long, at int, key long, times long")
    counts = cut(pairs.groupBy("key").agg(F.sum("times").alias("count")), "pair-counts")
    first = F.shiftright("key", 16)
    top = counts.groupBy(first.alias("a")).agg(F.max("count").alias("top"))
    judged = counts.withColumn("a", first).join(F.broadcast(top), "a").select(
        "key", "count", (F.col("count") == F.col("top")).cast("int").alias("best"))
    known = pairs.join(judged, "key").select("block", "at", "count", "best")
    schema = StructType([rows.schema["row"], *StructType.fromDDL("n_best long, count_sum long")])
    done = rows.select("row", "block", "links").groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_applied, schema)
    return done.select("row.*", F.struct("n_best", "count_sum").alias("counted"))


def align_tokens(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The documents with ``aligned`` (n_a, n_b, n_groups, n_links, groups) and ``counted``; see both steps."""
    done = align(documents, path_a, path_b)
    shown = done.select(F.struct(*(c for c in done.columns if c != "aligned")).alias("doc"), F.struct(
        *(F.col(f"aligned.{c}").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "groups"))).alias("shown"), "aligned")
    return count_links(shown).select("doc.*", F.col("shown").alias("aligned"), "counted")


@registered("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    documents = table(spark, sf_dir, "documents")
    kept = documents.select(F.struct("doc_id").alias("row"), "text")
    done = _align(kept, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    digest = F.when(F.col("aligned.n_a") > 0, F.sha2("aligned.groups", 256)).otherwise("")
    flat = done.select("row.doc_id", *(f"aligned.{c}" for c in ("n_a", "n_b", "n_groups", "n_links")),
                       digest.alias("groups_sha256"), "aligned")
    return count_links(flat).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "counted.*", "groups_sha256")
