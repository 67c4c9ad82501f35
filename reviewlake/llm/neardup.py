"""Near copies by HyperMinHash: compressed registers, banding, estimation, exact verification.

A text's set of word shingles is spread over 128 buckets. Each bucket keeps its smallest hash as the
number of leading zeros (6 bits) and the 10 bits after the first one; empty buckets borrow from full
ones in an order that is the same for all texts. Four registers make a band. At the similarity of 0.85
two texts share none of the 32 bands with probability 1e-10.

Texts with equal sets are one class, so exact copies cost nothing further. In each band bucket every
class is first paired with one centre only. Pairs pass a Jaccard estimate, corrected for chance
collisions of registers, and are then confirmed on full sets. Buckets whose classes are still in
different components are looked at again so that no link is missed: blocks of such a bucket meet in
tasks of bounded size, where 512 registers a text rule out nearly all pairs, and only what is left
across components is confirmed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from reviewlake.llm.common import cut, registered, table
from reviewlake.llm.graph import components
from reviewlake.llm.tokens import Texts, gram_hashes, mixed, slices, space_table, split, word_hashes
from reviewlake.llm.vectors import meet

SHINGLE = 5
REGISTERS, FINE, MANTISSA, BAND = 128, 512, 10, 4
# Classes of one bucket that meet in one task; smaller buckets share tasks of about so many rows.
BLOCK, PACKED = 1_024, 4_096
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
# Expected share of registers that agree by chance, times 2 ** MANTISSA (HyperMinHash paper).
CHANCE = 0.169919487159739093975315012348
_LETTERS = space_table(lower=True)


def shingle_sets(texts: Texts, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and where each text's begin.

    A text of fewer than ``k`` words has its whole sequence as one shingle, a text without words none.
    """
    words = split(texts, _LETTERS)
    hashes, counts = word_hashes(words), words.counts()
    of_word = np.repeat(np.arange(len(counts)), counts)
    grams = gram_hashes(hashes, k)
    whole = np.flatnonzero(np.arange(len(grams)) + k <= words.of[1:][of_word[:len(grams)]])
    values, owner = [grams[whole]], [of_word[whole]]
    for n in range(1, k):
        few = np.flatnonzero(counts == n)
        value = np.full(len(few), n, np.uint64)
        for j in range(n):
            value = value * np.uint64(0x100000001B3) + hashes[words.of[:-1][few] + j]
        values.append(mixed(value))
        owner.append(few)
    value, text = np.concatenate(values), np.concatenate(owner)
    order = np.lexsort((value, text))
    value, text = value[order], text[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    value, text = value[new], text[new]
    return value, np.searchsorted(text, np.arange(len(counts) + 1))


def registers_of(values: np.ndarray, begins: np.ndarray, number: int = REGISTERS) -> np.ndarray:
    """A row of 16-bit registers for each text; rows of empty sets mean nothing."""
    n, bits = len(begins) - 1, number.bit_length() - 1
    text = np.repeat(np.arange(n), np.diff(begins))
    least = np.full(n * number, EMPTY)
    bucket = (values >> np.uint64(64 - bits)).astype(np.int64)
    np.minimum.at(least, text * number + bucket, values << np.uint64(bits))
    least = least.reshape(n, number)
    zeros = (64 - np.frexp(least.astype(np.float64))[1]).clip(0, 57).astype(np.uint64)
    mantissa = (least << (zeros + np.uint64(1))) >> np.uint64(64 - MANTISSA)
    own = (zeros << np.uint64(MANTISSA) | mantissa).astype(np.uint16)
    full = least != EMPTY
    out, filled, places = own.copy(), full.copy(), np.arange(number)
    for step in np.random.default_rng(17).permutation(np.arange(1, number)):
        if filled.all():
            break
        lender = places ^ step
        take = ~filled & full[:, lender]
        out[take] = own[:, lender][take]
        filled |= take
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    packed = np.ascontiguousarray(registers).view(np.uint64).copy()
    packed += np.arange(packed.shape[1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mixed(packed)


SKETCH = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType()),
    T.StructField("registers", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])


@F.arrow_udf(SKETCH)
def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Set size, two checksums of the set, registers and band keys of each text."""
    names = ["n", "s1", "s2", "registers", "bands"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
    for batch in batches:
        parts = []
        for _, _, texts in slices(batch):
            values, begins = shingle_sets(texts)
            some = np.diff(begins) > 0
            sums = np.zeros((2, len(texts)), np.uint64)
            if some.any():
                sums[0, some] = np.add.reduceat(values, begins[:-1][some])
                sums[1, some] = np.add.reduceat(mixed(values ^ np.uint64(0xA0761D6478BD642F)), begins[:-1][some])
            rows = registers_of(values, begins)
            keys = band_keys(rows)
            parts.append(pa.StructArray.from_arrays([
                pa.array(np.diff(begins)), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                pa.array([r.tobytes() for r in rows], pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * keys.shape[1]),
                                         pa.array(keys.reshape(-1).view(np.int64)))], names=names))
        yield pa.concat_arrays(parts) if parts else pa.StructArray.from_arrays(
            [pa.array([], t) for t in types], names=names)


def jaccard(same: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, number: int) -> np.ndarray:
    """Estimate from equal registers, less those expected to be equal by chance."""
    ratio = n_a / n_b
    return same / number - CHANCE / 2 ** MANTISSA * 4 * ratio / (1 + ratio) ** 2


@F.arrow_udf(T.DoubleType())
def estimated(a: pa.Array, b: pa.Array, n_a: pa.Array, n_b: pa.Array) -> pa.Array:
    if not len(a):
        return pa.array([], pa.float64())
    one, two = (np.frombuffer(b"".join(x.to_pylist()), np.uint16).reshape(-1, REGISTERS) for x in (a, b))
    return pa.array(jaccard((one == two).sum(1), n_a.to_numpy(zero_copy_only=False),
                            n_b.to_numpy(zero_copy_only=False), REGISTERS))


@F.arrow_udf(T.BinaryType())
def fine_registers(texts: pa.Array) -> pa.Array:
    return pa.array([row.tobytes() for _, _, some in slices(texts)
                     for row in registers_of(*shingle_sets(some), FINE)], pa.binary())


def across(percent: int, slack: float):
    """Pairs of classes of one bucket, in different components, that may be similar.

    A pair is told once: in the first of the bands that it shares.
    """

    def pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        out_a, out_b = [], []
        sides = []
        for t in (left, right):
            sides.append({c: t[c].to_numpy() for c in ("list", "doc_id", "component", "n")} | {
                "fine": np.frombuffer(b"".join(t["fine"].to_pylist()), np.uint16).reshape(-1, FINE),
                "bands": t["bands"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
                if t.num_rows else np.zeros((0, 1), np.int64)})
        one, two = sides
        order = np.argsort(two["list"], kind="stable")
        listed = two["list"][order]
        for i in range(len(one["list"])):
            x, y = np.searchsorted(listed, one["list"][i]), np.searchsorted(listed, one["list"][i], "right")
            c = order[x:y]
            n = one["n"][i]
            c = c[(two["doc_id"][c] > one["doc_id"][i]) & (two["component"][c] != one["component"][i])
                  & (100 * np.minimum(two["n"][c], n) >= percent * np.maximum(two["n"][c], n))]
            if not len(c):
                continue
            same = (two["fine"][c] == one["fine"][i]).sum(1)
            c = c[jaccard(same, n, two["n"][c], FINE) >= percent / 100 - slack]
            shared = two["bands"][c] == one["bands"][i]
            c = c[one["bands"][i][shared.argmax(1)] == one["list"][i]] if len(c) else c
            out_a.append(np.full(len(c), one["doc_id"][i]))
            out_b.append(two["doc_id"][c])
        join = lambda parts: np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        return pa.table({"a": join(out_a), "b": join(out_b)})

    return pairs


def similar(percent: int):
    """Whether two texts' full sets have a Jaccard similarity of at least ``percent`` per cent."""

    @F.arrow_udf(T.BooleanType())
    def confirmed(a: pa.Array, b: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.bool_())
        # Each distinct text of the batch is cut into shingles once.
        every = pa.concat_arrays([a.cast(pa.large_string()), b.cast(pa.large_string())]).dictionary_encode()
        sets = [values[x:y] for _, _, texts in slices(every.dictionary)
                for values, begins in [shingle_sets(texts)] for x, y in zip(begins[:-1], begins[1:], strict=True)]
        left, right = np.split(every.indices.to_numpy(), 2)
        out = np.zeros(len(left), bool)
        for i, (x, y) in enumerate(zip(left, right, strict=True)):
            one, two = sets[x], sets[y]
            if 100 * min(len(one), len(two)) >= percent * max(len(one), len(two)) > 0:
                both = len(np.intersect1d(one, two, assume_unique=True))
                out[i] = 100 * both >= percent * (len(one) + len(two) - both)
        return pa.array(out)

    return confirmed


def _confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose texts are similar."""
    text = lambda x: texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"text_{x}"))
    return cut(pairs.join(text("b"), "b").join(text("a"), "a")
               .filter(similar(percent)("text_a", "text_b")).select("a", "b").distinct(), "links")


def _left_over(in_bands: DataFrame, classes: DataFrame, texts: DataFrame, links: DataFrame, percent: int, slack: float) -> DataFrame:
    """Likely pairs (a, b) of buckets that hold more than one component of ``links``."""
    known = components(links)
    marked = in_bands.select(F.col("band").alias("list"), "doc_id").join(
        known, F.col("doc_id") == F.col("node"), "left").select(
        "list", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    open_lists = marked.groupBy("list").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("rows")).filter("x < y")
    marked = cut(marked.join(open_lists.select("list", "rows"), "list"), "open-bands")
    fine = cut(texts.join(marked.select("doc_id").distinct(), "doc_id", "left_semi").select(
        "doc_id", fine_registers("text").alias("fine")), "fine-registers")
    held = marked.join(fine, "doc_id").join(classes.select("doc_id", "n", "bands"), "doc_id").withColumn("k1", F.col("doc_id"))
    pairs = across(percent, slack)
    packs = max(1, -(-marked.count() // PACKED))
    small = held.filter(F.col("rows") <= BLOCK).withColumn("pack", F.pmod(F.xxhash64("list"), F.lit(packs))).groupBy(
        "pack").applyInArrow(lambda t: pairs(t, t), "a long, b long")
    large = held.filter(F.col("rows") > BLOCK)
    again = large.select(*(F.col(c).alias(c) for c in large.columns))
    return cut(small.union(meet(large, again, pairs, "a long, b long", BLOCK)).distinct(), "likely-pairs")


def near_duplicates(documents: DataFrame, percent: int = 85, slack: float = 0.16) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``documents``.

    Links join texts whose shingle sets are at least ``percent`` per cent similar; a component is what
    links reach, named by its smallest doc_id, whose row is kept. ``slack`` is how far below the
    threshold an estimate may fall: five standard deviations of 128 registers, and half of it of 512.

    - Null, empty and blank texts have an empty set: a component of their own, kept.
    - Texts of fewer than five words are one shingle and link with the same sequence only.
    - Rows that share a doc_id count as one document with several texts and get one component.
    - A null doc_id takes no part: component_id null, kept.
    - An empty table gives an empty result; other columns take no part.
    """
    documents = documents.select("doc_id", "text")
    sketches = cut(documents.select("doc_id", sketched(F.col("text")).alias("k")).select("doc_id", "k.*"), "sketches")
    named = sketches.filter("n > 0 and doc_id is not null")
    # One class per distinct set, named by its smallest id.
    heads = cut(named.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("head")), "class-heads")
    of_class = named.select("doc_id", "n", "s1", "s2").join(heads, ["n", "s1", "s2"]).select("doc_id", "head")
    classes = cut(named.join(heads.withColumnRenamed("head", "doc_id"), ["doc_id", "n", "s1", "s2"], "left_semi")
                  .select("doc_id", "n", "registers", "bands"), "classes")
    banded = classes.select(F.explode("bands").alias("band"), "doc_id")
    shared = banded.groupBy("band").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high")
    in_bands = cut(banded.join(shared.drop("high"), "band").distinct(), "shared-bands")
    # Texts of all classes that share a bucket with another, read once.
    texts = cut(documents.filter("text is not null").join(in_bands.select("doc_id").distinct(), "doc_id", "left_semi")
                .distinct(), "candidate-texts")
    side = lambda x: classes.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"),
                                    F.col("registers").alias(f"r_{x}"))
    stars = in_bands.filter("doc_id > low").select(F.col("low").alias("a"), F.col("doc_id").alias("b")).distinct()
    sized = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    likely = cut(stars.join(side("a"), "a").join(side("b"), "b").filter(sized)
                 .filter(estimated("r_a", "r_b", "n_a", "n_b") >= percent / 100 - slack).select("a", "b").distinct(), "likely-stars")
    links = _confirmed(likely, texts, percent)
    links = links.union(_confirmed(_left_over(in_bands, classes, texts, links, percent, slack / 2), texts, percent))
    same = cut(of_class.filter("doc_id != head").select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct(),
               "same-sets")
    found = components(links.union(same))
    return sketches.select("doc_id", "n").join(found, F.col("doc_id") == F.col("node"), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(documents: DataFrame, percent: int = 85) -> DataFrame:
    """One document of every group of near copies: a row of the smallest doc_id, whole as it was.

    - A document is a doc_id with its text. Where rows with different texts share a doc_id, each text is
      a document of its own: those that are no near copies of each other all stay, and of near copies
      one does, that of a doc_id with one text first.
    - Of rows equal in id and text one stays. Rows without a doc_id all stay.
    - Null, empty and blank texts are near copies of nothing and stay. An empty table gives an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    several = documents.filter("doc_id is not null").select("doc_id", F.xxhash64(text).alias("h")).groupBy("doc_id").agg(
        F.min("h").alias("low"), F.max("h").alias("high")).filter("low != high")
    shared = cut(several.select(F.col("doc_id").alias("shared_id")), "shared-ids")
    # Ids of their own, above those that documents have.
    own = F.shiftrightunsigned(F.xxhash64("doc_id", text), 2) + F.lit(1 << 62)
    named = documents.filter("doc_id is not null").select(F.struct("*").alias("row"), "doc_id", "text").join(
        shared, F.col("doc_id") == F.col("shared_id"), "left").select(
        "row", "text", F.when(F.col("shared_id").isNull(), F.col("doc_id").cast("long")).otherwise(own).alias("doc_id"))
    found = near_duplicates(named, percent)
    kept = cut(found.filter("kept").select(F.col("doc_id").alias("kept_id")).distinct(), "kept-ids")
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_first()))
    whole = named.join(kept, F.col("doc_id") == F.col("kept_id"), "left_semi").withColumn("place", place)
    return whole.filter("place = 1").select("row.*").union(documents.filter("doc_id is null"))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 85 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.y),
m AS (SELECT x, min(y) AS low FROM r GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(low, d.doc_id)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m ON m.x = d.doc_id
"""


@registered("op5_near_duplicates", ORACLE)
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, at a similarity of 0.85."""
    return near_duplicates(table(spark, sf_dir, "documents"))
