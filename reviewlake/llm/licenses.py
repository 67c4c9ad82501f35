"""Licence scan by a positional index of rare tokens.

The index holds the rarest word of each licence template's mandatory key phrase and where it stands in
the template. How rare a word is comes from its document frequency over the whole input. Every posted
word of a file is looked up; its posting says where the template would have to start. A place counts when
enough of the template's words stand at their positions and its key phrase stands complete. So each place
holds its posted word and every place is found, whatever the frequencies. The short base phrases are all
key phrase.

All of it is array expressions within a row: no shuffle beyond the counts of the template words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import lower_ascii, registered, row_but, table

# Capitals are lower-cased later, word by word, so here they belong to words.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrase and label.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Label, template, mandatory key phrase; words as the scan sees them.
TEMPLATES = (
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-2.0", "this program is licensed under the gnu general public license version 2", "general public license version 2"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("mit", "released under the mit license", "the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by", "licensed under a creative commons attribution license", "creative commons attribution"),
    ("cc0", "dedicated to the public domain under cc0", "public domain under cc0"),
)


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[int, int]  # first and last position of the mandatory phrase


def _template(label: str, text: str, key: str) -> Template:
    words, phrase = tuple(text.split()), key.split()
    at = next(i for i in range(len(words)) if list(words[i:i + len(phrase)]) == phrase)
    return Template(label, words, (at, at + len(phrase) - 1))


def _strings(values) -> Column:
    return F.array(*map(F.lit, values))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def rarity(documents: DataFrame, vocabulary: list[str]) -> list[str]:
    """The vocabulary, rarest first, by the number of documents that hold a word; ties by the word.

    One row per template word reaches the driver, however large the input.
    """
    found = F.array_distinct(F.transform(
        F.filter(words_of(F.col("text")), lambda w: F.lower(w).isin(vocabulary)), lower_ascii))
    counts = {r["word"]: r["count"] for r in
              documents.select(F.explode(found).alias("word")).groupBy("word").count()
              .filter(F.col("word").isin(vocabulary)).collect()}
    return sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))


def scan_licenses(
    documents: DataFrame,
    base: tuple = BASE,
    templates: tuple = TEMPLATES,
    least_aligned: float = 0.6,
) -> DataFrame:
    """The documents with ``scan``: n_words, base (places), found (places), score.

    ``base`` and ``found`` are arrays of (label, word, aligned): the label, the word at which the place
    starts, counted from 0, and the share of the template's words found in their positions. ``found`` has
    every place at which the key phrase stands complete and that share is ``least_aligned`` or more; words
    before or after the text are not aligned, so a template cut by the text's begin has a start below 0.
    ``score`` is the largest share of any place of the method; a file with base places alone scores 0.5,
    one without places 0.

    - Null or empty text: no words, no places, score 0. An empty table gives an empty result.
    - Each row is scanned on its own, so null or repeated ids and repeated rows do no harm.
    - Words equally rare are ranked by their text. Other columns pass through unchanged.
    """
    plain = [_template(label, phrase, phrase) for phrase, label in base]
    whole = [_template(*t) for t in templates]
    vocabulary = sorted({w for t in plain + whole for w in t.words})
    ranked = rarity(documents, vocabulary)
    rank = {w: i for i, w in enumerate(ranked)}
    every = plain + whole
    texts = F.array(*(_strings(t.words) for t in every))
    labels = _strings(t.label for t in every)
    firsts, lasts = (F.array(*(F.lit(t.key[i]) for t in every)) for i in (0, 1))

    # Postings by rank: template and position in one number.
    wide = 1 << 20
    # Starts are kept larger by this, as a template may start before the text.
    longest = max((len(t.words) for t in every), default=0)

    def postings(chosen: list[tuple[int, Template]]) -> list[list[int]]:
        """For each word by rank the templates whose key phrase has it as its rarest word, and where.

        A place has the whole key phrase, so one posting of each template finds every place once.
        """
        lists: list[list[int]] = [[] for _ in ranked]
        for t, tpl in chosen:
            at = min(range(tpl.key[0], tpl.key[1] + 1), key=lambda p: rank[tpl.words[p]])
            lists[rank[tpl.words[at]]].append(t * wide + at)
        return lists

    numbered = list(enumerate(every))
    base_lists, own_lists = postings(numbered[:len(plain)]), postings(numbered[len(plain):])
    posted = [word for word, x, y in zip(ranked, base_lists, own_lists, strict=True) if x or y]
    base_postings, own_postings = (
        F.array(*(F.array(*map(F.lit, x)) if x else F.array().cast("array<int>") for x in lists))
        for lists in (base_lists, own_lists))

    def hits_of(words: Column) -> Column:
        """Rank and place of every posted word."""
        placed = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                          lambda x: F.lower(x["w"]).isin(posted))
        ranks = F.transform(placed, lambda x: F.struct(
            (F.array_position(_strings(ranked), lower_ascii(x["w"])) - 1).cast("int").alias("r"), x["i"].alias("i")))
        return F.filter(ranks, lambda x: x["r"] >= 0)

    def places(hits: Column, lists: Column) -> Column:
        """Template and start, in one number, to which the postings of the words point."""
        starts = F.flatten(F.transform(hits, lambda h: F.transform(
            F.get(lists, h["r"]),
            lambda p: F.shiftright(p, 20).cast("long") * (1 << 40) + (h["i"] - p.bitwiseAND(wide - 1) + longest).cast("long"))))
        return F.array_distinct(starts)

    def judged(words: Column, starts: Column) -> Column:
        def one(s: Column) -> Column:
            t, start = F.shiftright(s, 40).cast("int"), s.bitwiseAND((1 << 40) - 1).cast("int") - longest
            text, first, last = F.get(texts, t), F.get(firsts, t), F.get(lasts, t)
            match = F.transform(text, lambda w, j: F.coalesce(lower_ascii(F.get(words, start + j)) == w, F.lit(False)))
            return once(match, lambda m: F.struct(
                F.get(labels, t).alias("label"), start.cast("long").alias("word"),
                (F.size(F.filter(m, lambda x: x)) / F.size(text)).alias("aligned"),
                F.forall(F.slice(m, first + 1, last - first + 1), lambda x: x).alias("keyed")))

        return F.transform(starts, one)

    def found(words: Column, hits: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.filter(judged(words, places(hits, base_postings)), lambda x: x["aligned"] == 1).alias("base"),
            F.filter(judged(words, places(hits, own_postings)),
                     lambda x: x["keyed"] & (x["aligned"] >= least_aligned)).alias("found"))

    scanned = documents.select(row_but(documents, "scan"), once(
        words_of(F.col("text")), lambda words: once(hits_of(words), lambda hits: once(
            found(words, hits), lambda x: x.withField("score", F.greatest(
                F.coalesce(F.array_max(F.transform(x["found"], lambda y: y["aligned"])), F.lit(0.0)),
                F.when(F.size(x["base"]) > 0, 0.5).otherwise(0.0)))))).alias("scan"))
    return scanned.select("row.*", "scan")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def _oracle() -> str:
    base = [(label, phrase.split()) for phrase, label in BASE]
    own = [_template(*t) for t in TEMPLATES]
    words = ", ".join(f"({t}, '{label}', {p}, '{w}', {len(ws)}, true)"
                      for t, (label, ws) in enumerate(base) for p, w in enumerate(ws))
    words += ", " + ", ".join(
        f"({len(base) + t}, '{x.label}', {p}, '{w}', {len(x.words)}, {str(x.key[0] <= p <= x.key[1]).lower()})"
        for t, x in enumerate(own) for p, w in enumerate(x.words))
    return rf"""
WITH tw(t, label, p, w, n, key) AS (VALUES {words}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
e AS (SELECT doc_id, unnest(words) AS w, generate_subscripts(words, 1) - 1 AS i FROM d),
h AS (SELECT * FROM e WHERE w IN (SELECT w FROM tw)),
c AS (SELECT DISTINCT h.doc_id, tw.t, tw.label, tw.n, h.i - tw.p AS s FROM h JOIN tw USING (w) WHERE tw.key),
m AS (SELECT c.doc_id, c.t, c.label, c.s, count(*) / any_value(c.n) AS aligned,
             count(*) FILTER (WHERE tw.key) = (SELECT count(*) FROM tw x WHERE x.t = c.t AND x.key) AS keyed
      FROM c JOIN tw ON tw.t = c.t JOIN h ON h.doc_id = c.doc_id AND h.i = c.s + tw.p AND h.w = tw.w
      GROUP BY c.doc_id, c.t, c.label, c.s),
b AS (SELECT * FROM m WHERE t < {len(base)} AND aligned = 1),
o AS (SELECT * FROM m WHERE t >= {len(base)} AND keyed AND aligned >= 0.6),
g AS (SELECT doc_id, count(*) AS n_base, min(s) AS first_word, max(s) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id),
l AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM (SELECT doc_id, label FROM b UNION ALL SELECT doc_id, label FROM o) GROUP BY doc_id),
q AS (SELECT doc_id, max(aligned) AS best FROM o GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(greatest(coalesce(best, 0), CASE WHEN n_base > 0 THEN 0.5 ELSE 0 END) AS DOUBLE) AS score
FROM d LEFT JOIN g USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN q USING (doc_id)
"""


@registered("op1_license_scan", _oracle())
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, all templates."""
    scanned = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base, found = F.col("scan.base"), F.col("scan.found")
    starts = F.transform(base, lambda x: x["word"])
    return scanned.select(
        "doc_id", "scan.n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _joined(F.transform(base, lambda x: x["label"])).alias("base_labels"),
        _joined(F.transform(F.concat(base, found), lambda x: x["label"])).alias("labels"), "scan.score")
