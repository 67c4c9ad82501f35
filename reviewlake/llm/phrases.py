"""Removal of repeated word passages with Aho-Corasick automata.

Recurring windows are found through sampled anchors (``runs``): those that share an anchor are confirmed
word by word, compiled into the automaton of their shard, and every content of the shard is streamed
through it, which locates each occurrence and the least document that holds it.
"""

from __future__ import annotations

from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import registered, row_but, table
from reviewlake.llm.runs import Windows, recurring, segments, starts_of, text_keys
from reviewlake.llm.suffixes import FOUND
from reviewlake.llm.tokens import slices, space_table, split

_SPACES = space_table()


def located(window: int):
    """Finds windows of ``window`` words that occur more than once in a shard of contents."""

    def shard(part: pa.Table) -> pa.Table:
        numbers: dict[bytes, int] = {}
        contents = [[numbers.setdefault(w, len(numbers)) for w in x.split(b" ")] for x in part["content"].to_pylist()]
        c, m = part["c"].to_pylist(), part["m"].to_pylist()
        # Confirmed passages: windows of which the shard holds two, whole and in order.
        times: Counter = Counter()
        for words, n in zip(contents, c, strict=True):
            for i in range(len(words) - window + 1):
                times[tuple(words[i:i + window])] += n
        phrases = [p for p, n in times.items() if n > 1]
        found: list[list] = [[] for _ in contents]
        if phrases:
            automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
            for i, phrase in enumerate(phrases):
                automaton.add_word(phrase, i)
            automaton.make_automaton()
            places = [[(end - window + 1, i) for end, i in automaton.iter(tuple(words))] for words in contents]
            least = [np.iinfo(np.int64).max] * len(phrases)
            for at, own in zip(places, m, strict=True):
                for _, i in at:
                    if own < least[i]:
                        least[i] = own
            for k, at in enumerate(places):
                if at:
                    starts = np.array([s for s, _ in at])
                    found[k] = segments(starts, np.array([least[i] for _, i in at]),
                                        np.array([times[phrases[i]] for _, i in at]))
        return pa.table([part["fp"], part["h"], pa.array(found, FOUND)], names=["fp", "h", "found"])

    return shard


def _removal(window: int):
    @F.arrow_udf("n_words long, n_removed long, kept string")
    def remove(texts: pa.Array, ids: pa.Array, found: pa.Array) -> pa.Array:
        own, out = ids.to_pylist(), []
        for first, _, some in slices(texts):
            words = split(some, _SPACES)
            for i in range(len(some)):
                a, b = words.of[i], words.of[i + 1]
                me, spots = own[first + i], found[first + i].as_py()
                gone = starts_of(spots, lambda x: me is not None and x["least"] < me, window, b - a)  # noqa: B023
                kept = np.flatnonzero(~gone) + a
                parts = [words.data[words.starts[j]:words.ends[j]].tobytes() for j in kept] if gone.any() else (
                    words.data[words.starts[a]:words.ends[b - 1]].tobytes().split() if b > a else [])
                out.append({"n_words": int(b - a), "n_removed": int(gone.sum()), "kept": b" ".join(parts).decode()})
        return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))

    return remove


def remove_phrases(documents: DataFrame, window: int = 13, gram: int = 4) -> DataFrame:
    """The documents with ``phrases``: n_words, n_removed and kept (words joined by one space).

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller
    doc_id. Windows are judged on the input and never cross documents.

    - Null, empty and blank text: no words. Texts shorter than a window stay whole.
    - Rows that share a doc_id are not before each other. A row without a doc_id loses nothing and
      makes no other row lose anything.
    - An empty table gives an empty result; other columns pass through unchanged.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = documents.filter("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("id"), "text", *text_keys(text))
    found = recurring(keyed, Windows("word", window, gram), located(window))
    joined = documents.select(row_but(documents, "phrases"), "doc_id", text.alias("text"), *text_keys(text)).join(
        found, ["k1", "k2"], "left")
    return joined.withColumn("phrases", _removal(window)("text", F.col("doc_id").cast("long"), "found")).select(
        "row.*", "phrases")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
f AS (SELECT s, min(doc_id) AS low FROM g GROUP BY s),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS j FROM g JOIN f USING (s) WHERE low < doc_id),
e AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
k AS (SELECT e.doc_id, count(*) AS n_words, count(c.j) AS n_removed,
             string_agg(word, ' ' ORDER BY e.j) FILTER (WHERE c.j IS NULL) AS kept
      FROM e LEFT JOIN c ON c.doc_id = e.doc_id AND c.j = e.j GROUP BY e.doc_id)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@registered("op6_repeated_phrases", ORACLE)
def op6_repeated_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, windows of 13 words."""
    done = remove_phrases(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "phrases.n_words", "phrases.n_removed", F.sha2("phrases.kept", 256).alias("kept_sha256"))
