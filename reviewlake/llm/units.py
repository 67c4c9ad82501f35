"""Ids of texts by way of their parts: what stands between spaces is encoded once and remembered.

Both byte-level and word vocabularies never merge across such a place, so a text's ids are those of its
parts on end. The caches of a task have a fixed size, and a long text is taken in stretches.
"""

from __future__ import annotations

import gc
import os
import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc

from reviewlake.llm.bpe import CHUNK, SEPARATORS, byte_letters

# Parts a task remembers (twice as many at most), the longest it remembers, and characters of a stretch.
REMEMBERED, LONGEST, STRETCH = 250_000, 64, 1 << 20


class Parts:
    """Encodings of parts, computed many at a time and kept in two halves of bounded size."""

    def __init__(self, compute: Callable[[list[str]], Iterable], most: int = REMEMBERED):
        self.compute, self.most = compute, most
        self.new: dict = {}
        self.old: dict = {}

    def of(self, parts: set[str]) -> dict:
        """A table that holds all of ``parts``, good until the next call."""
        missing = list(parts.difference(self.new))
        if self.old:
            known = {p: v for p in missing if (v := self.old.get(p)) is not None}
            self.new.update(known)
            missing = [p for p in missing if p not in known]
        if missing:
            collects = gc.isenabled()
            gc.disable()  # many small objects, none of them in a cycle
            try:
                self.new.update(zip(missing, self.compute(missing), strict=True))
            finally:
                if collects:
                    gc.enable()
        table = self.new
        if len(table) > self.most:
            self.old = {k: v for k, v in table.items() if len(k) <= LONGEST} if len(table) <= 2 * self.most else {}
            self.new = {}
        return table


def stretches(texts: pa.Array, most: int = STRETCH) -> Iterator[tuple[int, int, list[str]]]:
    """Rows of a batch in runs of about ``most`` characters; null is empty."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    first = total = 0
    for i, size in enumerate(sizes):
        if total and total + size > most:
            yield first, i, [x or "" for x in texts.slice(first, i - first).to_pylist()]
            first, total = i, 0
        total += size
    if first < len(sizes):
        yield first, len(sizes), [x or "" for x in texts.slice(first).to_pylist()]


# Characters whose lower case, composed form and class are the same everywhere: ASCII and Latin-1 letters.
PLAIN = re.compile("[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
# The vocabulary's own split, for such characters in lower case and without white space.
PLAIN_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")


class WordIds:
    """Ids by the ``tokenizers`` library with a lower-case vocabulary that drops white space.

    Of plain parts the library's model encodes each word once; all others go through the whole library.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.letters = dict(enumerate(byte_letters()))
        self.words, self.parts = Parts(self._word_ids), Parts(self._part_ids)

    def _word_ids(self, words: list[str]) -> Iterator[bytes]:
        tokenize, letters = self.library.model.tokenize, self.letters
        for word in words:
            plain = word.isascii() and word.isprintable()
            spelt = word if plain else word.encode().decode("latin-1").translate(letters)
            yield array("I", [token.id for token in tokenize(spelt)]).tobytes()

    def _part_ids(self, parts: list[str]) -> list[bytes]:
        split: list[list[str] | None] = []
        for part in parts:
            if PLAIN.fullmatch(part) and "<|" not in part:
                low = part.lower()
                split.append([low] if low.isalpha() else PLAIN_WORD.findall(low))
            else:
                split.append(None)
        held = self.words.of({w for words in split if words for w in words})
        others = [part for part, words in zip(parts, split, strict=True) if words is None]
        encoded = iter(self.library.encode_batch_fast(others, add_special_tokens=False)) if others else iter(())
        return [array("I", next(encoded).ids).tobytes() if words is None else
                held[words[0]] if len(words) == 1 else b"".join([held[w] for w in words]) for words in split]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as unsigned 32-bit numbers on end."""
        if sum(map(len, texts)) <= 2 * STRETCH:
            words = [self._words(text) for text in texts]
            held = self.parts.of(set().union(*words))
            return [b"".join([held[w] for w in some]) for some in words]
        return [b"".join(b"".join([held[w] for w in some]) for stretch in self._stretched(text)
                         for some in [self._words(stretch)] for held in [self.parts.of(set(some))]) for text in texts]

    @staticmethod
    def _words(text: str) -> list[str]:
        return CHUNK.findall(text) if SEPARATORS.search(text) else text.split()

    @staticmethod
    def _stretched(text: str, most: int = STRETCH) -> Iterator[str]:
        start = 0
        while len(text) - start > most and (end := text.find(" ", start + most)) >= 0:
            yield text[start:end]
            start = end
        yield text[start:]


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    """One for all tasks of a worker."""
    return WordIds(path)
