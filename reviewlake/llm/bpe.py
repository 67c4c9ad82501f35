"""Encoding and decoding with a word-end BPE vocabulary.

A word's symbols form a doubly linked list; a heap holds the merge ranks of neighbouring symbols, and
entries whose symbols have changed since are skipped when they come up. Decoding puts the vocabulary
strings of the ids together, separated by spaces as the vocabulary file declares no decoder.

Every text is encoded whole and by itself, so the work splits over any number of tasks. A task keeps
the ids of recent words in a cache of fixed size; a word that is all there is between white space has
one entry, not two. Texts are decoded by their ids some at a time.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from reviewlake.llm.common import registered, row_but, table

# White space by its Unicode property; Python's own classes hold four separators more.
SPACE = r"\t-\r \x85\xa0  -     　"
CHUNK = regex.compile(rf"[^{SPACE}]+")
SEPARATORS = regex.compile(r"[\x1c-\x1f]")
# Kept in each half of a task's caches: words as the library spells them, and all other words with the
# chunks between white space. Longer ones are not kept.
CACHED_WORDS, CACHED_CHUNKS, LONGEST = 60_000, 250_000, 64
# Texts encoded at once.
ROWS = 256

SCHEMA = "ids array<int>, decoded string"
_ARROW = pa.struct([("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    letter = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letter[b] for b in range(256)]


class Recent(dict):
    """Results of a function for recent short arguments: at most twice ``most`` of them."""

    def __init__(self, most: int, compute):
        super().__init__()
        self.most, self.compute, self.old = most, compute, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.compute(key)
        if len(key) > LONGEST:
            return value
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordBpe:
    """One vocabulary file and bounded caches of what has been encoded lately."""

    def __init__(self, path: str, words: int = CACHED_WORDS, chunks: int = CACHED_CHUNKS):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        vocab: dict[str, int] = model["vocab"]
        self.strings = {i: s for s, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("|".join(regex.escape(s) for s in self.special) or r"(?!)")
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.library = Tokenizer.from_file(path)
        # The pattern's classes for characters of which every Unicode version says the same; for all others
        # the library's own normaliser and split are asked.
        self.plain = regex.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
        self.word_pattern = regex.compile(pattern.replace(r"\s", SPACE))
        # For each left id the ranks of its merges by right id; what a merge makes is listed by rank.
        none: dict[int, int] = {}
        self.follow = [none] * (max(self.strings) + 1)
        for rank, (a, b) in enumerate(model["merges"]):
            if self.follow[vocab[a]] is none:
                self.follow[vocab[a]] = {}
            self.follow[vocab[a]][vocab[b]] = rank
        self.made = [vocab[a + b] for a, b in model["merges"]]
        letters = byte_letters()
        self.byte_of = {letter: i for i, letter in enumerate(letters)}
        self.inner, self.last = [vocab[c] for c in letters], [vocab[c + self.end] for c in letters]
        self.spelt = pa.array([self.strings.get(i, "") for i in range(len(self.follow))], pa.string())
        self.words, self.chunks = Recent(words, self.merged), Recent(chunks, self.chunk)

    def merged(self, word: str | bytes) -> bytes:
        """The ids of one word, or of its bytes, as 32-bit numbers on end."""
        data = word if isinstance(word, bytes) else word.encode("utf-8", "surrogatepass")
        inner, follow, made = self.inner, self.follow, self.made
        ids = [inner[b] for b in data]
        ids[-1] = self.last[data[-1]]
        n = len(ids)
        if n == 1:
            return array("i", ids).tobytes()
        # The rank of each symbol with the one after it; an entry of the heap that it no longer equals is stale.
        ranks = [follow[a].get(b, -1) for a, b in zip(ids, ids[1:], strict=False)]
        ranks.append(-1)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # A heap entry is a rank and the place of the left symbol in one number.
        shift = n.bit_length()
        place = (1 << shift) - 1
        heap = [rank << shift | i for i, rank in enumerate(ranks) if rank >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            i, rank = top & place, top >> shift
            if ranks[i] != rank:
                continue
            new, j = made[rank], after[i]
            ids[i], ids[j], ranks[j] = new, -1, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                rank = ranks[i] = follow[new].get(ids[k], -1)
                if rank >= 0:
                    heappush(heap, rank << shift | i)
            else:
                ranks[i] = -1
            h = before[i]
            if h >= 0:
                rank = ranks[h] = follow[ids[h]].get(new, -1)
                if rank >= 0:
                    heappush(heap, rank << shift | h)
        return array("i", [x for x in ids if x >= 0]).tobytes()

    def chunk(self, text: str) -> bytes:
        """Ids of what stands between white space, as 32-bit numbers on end."""
        if not self.plain.fullmatch(text):
            byte_of, words = self.byte_of, self.words
            split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return b"".join([words[bytes([byte_of[c] for c in spelt])] for spelt, _ in split])
        plain = text.lower()
        words = [plain] if plain.isalpha() else self.word_pattern.findall(plain)
        if words == [text]:
            return self.merged(text)
        chunks = self.chunks
        return b"".join([chunks[word] for word in words])

    def ids(self, text: str) -> bytes:
        """Ids of a text, as 32-bit numbers on end."""
        chunks = self.chunks
        parts, at = [], 0
        for match in self.special_pattern.finditer(text) if "<" in text else ():
            parts += [chunks[c] for c in CHUNK.findall(text[at:match.start()])]
            parts.append(array("i", [self.special[match.group()]]).tobytes())
            at = match.end()
        rest = text[at:] if at else text
        some = CHUNK.findall(rest) if SEPARATORS.search(rest) else rest.split()
        parts += itemgetter(*some)(chunks) if len(some) > 1 else [chunks[c] for c in some]
        return b"".join(parts)

    def encode_all(self, texts: list[str]) -> pa.StructArray:
        """``ids`` and ``decoded`` of each text."""
        done = [self.ids(text) for text in texts]
        ends = pa.array(np.cumsum([0] + [len(ids) // 4 for ids in done]).astype(np.int32))
        flat = pa.array(np.frombuffer(b"".join(done), np.int32))
        decoded = pc.binary_join(pa.ListArray.from_arrays(ends, self.spelt.take(flat)), " ")
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, flat), decoded], names=["ids", "decoded"])

    def encode(self, text: str) -> tuple[bytes, str]:
        return self.ids(text), self.encode_all([text]).field("decoded")[0].as_py()


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def encoded(text: Column, path: str) -> Column:
    """A struct of ``ids`` and ``decoded`` for a text column.

    Null text counts as empty: no ids, empty decoded text. Marks of special tokens within a text are
    encoded as those tokens. ``path`` is the vocabulary file, found at the same place on every node.
    """

    @F.arrow_udf(SCHEMA)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = load(path)
        for batch in batches:
            # Slices bound what a task holds at once, however long the batch.
            for start in range(0, max(1, len(batch)), ROWS):
                yield bpe.encode_all([x or "" for x in batch.slice(start, ROWS).to_pylist()])

    return encode(text)


def encode_documents(documents: DataFrame, path: str) -> DataFrame:
    """The documents with ``tokens``: ids and decoded text; see ``encoded``.

    Rows are encoded one by one: repeated rows and null or repeated ids are kept, an empty table gives
    an empty result, other columns pass through unchanged.
    """
    return documents.select(row_but(documents, "tokens"), encoded(F.col("text"), path).alias("tokens")).select(
        "row.*", "tokens")


def ids_text(ids: Column) -> Column:
    """Decimal ids with one space between them."""
    listed = ids.cast("string")
    return F.replace(F.substring(listed, F.lit(2), F.length(listed) - 2), F.lit(", "), F.lit(" "))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@registered("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, encoded and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = docs.select("doc_id", encoded(F.col("text"), vocabulary()).alias("tokens"))
    return done.select(
        "doc_id", F.size("tokens.ids").cast("long").alias("n_tokens"),
        F.sha2(ids_text(F.col("tokens.ids")), 256).alias("ids_sha256"),
        F.sha2(F.col("tokens.decoded"), 256).alias("decoded_sha256"))
