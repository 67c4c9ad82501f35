"""Operators on documents against brute force, with odd rows and with none."""

from __future__ import annotations

import hashlib
import re
import tempfile
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.llm.bpe import WordBpe, encode_documents, ids_text, vocabulary
from reviewlake.llm.licenses import TEMPLATES, scan_licenses
from reviewlake.llm.mixing import mix_sources
from reviewlake.llm.neardup import near_duplicates, one_of_each
from reviewlake.llm.phrases import located, remove_phrases
from reviewlake.llm.queries import ORACLES, QUERIES
from reviewlake.llm.suffixes import compare, remove_repeats
from tests.compare import differences
from tests.llm.conftest import LONG, PASSAGE

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, sf_dir):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]


def sha(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def brute_phrases(rows, window=13):
    first = {}
    for d, text in rows:
        words = WORDS.findall(text)
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, text in rows:
        words = WORDS.findall(text)
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if d is not None and first[tuple(words[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        out.append((d, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone, strict=True) if not g))))
    return Counter(out)


def brute_repeats(rows, size=400):
    times = Counter()
    for _, text in rows:
        data = text.encode()
        times.update(data[i:i + size] for i in range(len(data) - size + 1))
    out = []
    for d, text in rows:
        data = text.encode()
        gone, end = bytearray(len(data)), 0
        for i in range(len(data) - size + 1):
            if times[data[i:i + size]] > 1:
                gone[max(i, end):i + size] = b"\1" * (i + size - max(i, end))
                end = i + size
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((d, len(data), sum(gone), spans, sha(bytes(c for c, g in zip(data, gone, strict=True) if not g))))
    return Counter(out)


def test_phrases_equal_brute_force(spark, sf_dir):
    got = QUERIES["op6_repeated_phrases"](spark, sf_dir).select("doc_id", "n_words", "n_removed", "kept_sha256")
    assert Counter(map(tuple, got.collect())) == brute_phrases(documents(spark, sf_dir))


def test_phrases_of_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    got = remove_phrases(odd).select("doc_id", "phrases.n_words", "phrases.n_removed", F.sha2("phrases.kept", 256))
    assert Counter(map(tuple, got.collect())) == brute_phrases(rows)
    assert remove_phrases(empty).count() == 0


def test_repeats_equal_brute_force(spark, sf_dir):
    got = QUERIES["op9_suffix_dedup"](spark, sf_dir)
    got = got.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert Counter(map(tuple, got.collect())) == brute_repeats(documents(spark, sf_dir))


def test_repeats_of_odd_rows(odd, empty):
    rows = [(r["doc_id"], (r["text"] or "") if r["text"] != LONG else "") for r in odd.collect()]
    short = odd.withColumn("text", F.when(F.col("text") == LONG, "").otherwise(F.col("text")))
    removed = F.aggregate("repeats.removed", F.lit(0), lambda n, x: n + x["b"] - x["a"])
    got = remove_repeats(short, 100).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)), removed, F.size("repeats.removed"), F.sha2("repeats.kept", 256))
    assert Counter(map(tuple, got.collect())) == brute_repeats(rows, 100)
    assert remove_repeats(empty).count() == 0


def test_first_copy_stays(spark):
    passage = "".join(f"{i:03d}" for i in range(100))
    docs = spark.createDataFrame([(3, "x" + passage), (1, passage + "y"), (2, passage[:250] + passage[50:])], "doc_id long, text string")
    kept = {r["doc_id"]: r["kept"] for r in
            remove_repeats(docs, 100, keep="first", as_text=True).select("doc_id", "repeats.kept").collect()}
    assert kept == {1: passage + "y", 2: "", 3: "x"}


@pytest.mark.parametrize("most", [0, 4096])
def test_crowded_anchors_go_the_exact_way(spark, sf_dir, monkeypatch, most):
    from reviewlake.llm import runs

    monkeypatch.setattr(runs, "MOST_CONTENTS", most)
    rows = documents(spark, sf_dir)[:80]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_phrases(docs).select("doc_id", "phrases.n_words", "phrases.n_removed", F.sha2("phrases.kept", 256))
    assert Counter(map(tuple, got.collect())) == brute_phrases(rows)


def periodic(repeats):
    phrase = "here the same few words stand again and again "
    return [(i, phrase * n + f"end {i}") for i, n in enumerate(repeats)]


@pytest.mark.parametrize("unit", ["word", "byte"])
def test_contents_of_periodic_texts_do_not_meet_in_one_task(spark, unit):
    from reviewlake.llm.runs import Windows, recurring, text_keys

    rows = periodic(range(9_000, 9_024))

    def shard(part):
        size = sum(map(len, part["content"].to_pylist()))
        assert size <= 1 << 23, size
        return located(13)(part) if unit == "word" else compare(100)(part)

    docs = spark.createDataFrame(rows, "id long, text string").select("id", "text", *text_keys(F.col("text")))
    kind = Windows("word", 13, 4) if unit == "word" else Windows("byte", 100, 32)
    found = recurring(docs, kind, shard).select(F.explode("found").alias("x"), "k1")
    found = found.filter("x.count > 1 and x.least = 0").groupBy("k1").agg(F.sum(F.expr("x.b - x.a + 1")).alias("n"))
    # All windows but those that hold the number at the end.
    got = {r["id"]: r["n"] for r in docs.join(found, "k1").select("id", "n").collect()}
    whole = {d: len(t.split()) - 13 if unit == "word" else len(t) - len(str(d)) - 99 for d, t in rows}
    assert got == whole


@pytest.mark.parametrize("most, piece", [(0, 40), (1 << 22, 40), (0, 1 << 16)])
def test_cut_contents_equal_brute_force(spark, monkeypatch, most, piece):
    from reviewlake.llm import runs

    monkeypatch.setattr(runs, "MOST_BYTES", most)
    monkeypatch.setattr(runs, "PIECE", piece)
    rows = periodic((3, 20, 21, 33, 60)) + [(9, PASSAGE + " end"), (10, "start " + PASSAGE)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = remove_phrases(docs).select("doc_id", "phrases.n_words", "phrases.n_removed", F.sha2("phrases.kept", 256))
    assert Counter(map(tuple, got.collect())) == brute_phrases(rows)
    removed = F.aggregate("repeats.removed", F.lit(0), lambda n, x: n + x["b"] - x["a"])
    got = remove_repeats(docs, 100).select(
        "doc_id", F.octet_length("text"), removed, F.size("repeats.removed"), F.sha2("repeats.kept", 256))
    assert Counter(map(tuple, got.collect())) == brute_repeats(rows, 100)


def shingles(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows, percent):
    sets = [shingles(t) for _, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (d, _) in enumerate(rows):
        for j, (e, _) in enumerate(rows[:i]):
            both = len(sets[i] & sets[j])
            if d is not None and e is not None and both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(d), root(e)))
                parent[b] = a
    return Counter((d, len(s), root(d) if d is not None else None, d is None or root(d) == d)
                   for (d, _), s in zip(rows, sets, strict=True))


def test_near_copies_of_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    assert Counter(map(tuple, near_duplicates(odd).collect())) == brute_components(rows, 85)
    assert near_duplicates(empty).count() == 0
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    # Of the two texts with the id 10 the one that copies no other stays.
    assert ids == Counter({None: 2, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 1, 9: 1, 10: 1, 11: 1, 12: 1, 13: 1} | (
        {6: 1} if (6, len(shingles(rows[6][1])), 6, True) in brute_components(rows, 85) else {}))


def test_texts_that_share_an_id_are_documents_of_their_own(spark):
    words = [f"w{i}" for i in range(60)]
    first, second, third = " ".join(words), " ".join(words[::-1]), " ".join(f"x{w}" for w in words)
    rows = [(1, first), (1, second), (1, second), (2, second + " end"), (3, third), (3, None), (3, ""), (4, None), (None, first)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(map(tuple, one_of_each(docs, 80).collect()))
    # A null and an empty text of one id are the same document.
    assert kept == Counter([(1, first), (2, second + " end"), (3, third), (3, None), (4, None), (None, first)])


def test_families_of_edited_copies(spark):
    """Chains and stars of copies whose similarities lie on both sides of the threshold."""
    import random

    draw = random.Random(4)
    rows = []
    for family in range(4):
        base = [f"w{draw.randrange(10**6)}" for _ in range(150)]
        for edits in range(60):
            words = list(base)
            for _ in range(edits // 6):
                words[draw.randrange(150)] = f"e{draw.randrange(10**6)}"
            rows.append((family * 1000 + draw.randrange(900) * 1, " ".join(words)))
    rows = list({d: (d, t) for d, t in rows}.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, near_duplicates(docs).collect())) == brute_components(rows, 85)


def test_tokens_equal_the_library(spark, sf_dir, odd, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary())
    rows = documents(spark, sf_dir)
    want = Counter()
    for d, text in rows:
        ids = library.encode(text, add_special_tokens=False).ids
        want[d, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))] += 1
    got = QUERIES["op7_bpe"](spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert Counter(map(tuple, got.collect())) == want
    for r in encode_documents(odd, vocabulary()).collect():
        assert r["tokens"]["ids"] == library.encode(r["text"] or "", add_special_tokens=False).ids
    assert encode_documents(empty, vocabulary()).count() == 0
    assert odd.limit(1).select(ids_text(F.array(F.lit(5), F.lit(60)))).first()[0] == "5 60"


def test_special_marks_and_odd_characters():
    from tokenizers import Tokenizer

    library, own = Tokenizer.from_file(vocabulary()), WordBpe(vocabulary(), words=3, chunks=2)
    for text in ("<|endoftext|> a<|startoftext|>B", "\u03a3\u03b1\u03c2 \u03a3\u0391\u03a3", "it's I'LL", "\x1c a\x1db\x85c\u3000d",
                 "e\u0301 \u0130 \uff11", "x" * 3000, "a b a c b a d <|end"):
        want = library.encode(text, add_special_tokens=False)
        ids, decoded = own.encode(text)
        ids = [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)]
        assert ids == want.ids and decoded == library.decode(want.ids, skip_special_tokens=False)


def test_a_task_remembers_little_more_than_ids():
    bpe = WordBpe(vocabulary())
    bpe.encode("weather Weather weather. " + "y" * 5000)
    # Of every word and chunk the ids alone; a word that is a chunk has one entry, and a very long chunk none.
    assert set(bpe.chunks) == {"weather", "Weather", "weather.", "."} and not bpe.words
    assert {type(x) for x in bpe.chunks.values()} == {bytes}
    bpe = WordBpe(vocabulary(), words=3, chunks=4)
    bpe.encode(" ".join(f"word{chr(97 + i)} {chr(0x3b1 + i)}" for i in range(20)))
    assert all(len(x) <= x.most and len(x.old) <= x.most for x in (bpe.chunks, bpe.words))


def test_every_code_point_is_split_as_the_library_does():
    from tokenizers import Tokenizer

    bpe, library = WordBpe(vocabulary()), Tokenizer.from_file(vocabulary())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = [" ".join(f"a{chr(c)}b {chr(c)}1" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    for text, want in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(bpe.encode(text)[0], np.int32).tolist() == want.ids


def test_licences_equal_sql_on_odd_rows(spark, odd):
    """The SQL twin on texts that the tables lack: cut at either end, with all templates and common words."""
    whole = [f"{' '.join(words)} and more" for _, words, _ in TEMPLATES]
    rows = [(i, t) for i, t in enumerate([*whole, " ".join(whole), *(w[len(w) // 3:] for w in whole), *(w[:2 * len(w) // 3] for w in whole)])]
    docs = odd.filter("doc_id < 100").select("doc_id", "text").dropDuplicates(["doc_id"]).selectExpr("doc_id + 1000 AS doc_id", "text").union(
        spark.createDataFrame(rows, "doc_id long, text string"))
    folder = tempfile.mkdtemp()
    docs.coalesce(1).write.parquet(f"{folder}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    assert differences(QUERIES["op1_license_scan"](spark, folder), con, ORACLES["op1_license_scan"]) == ""


def test_licences_of_odd_rows(odd, empty):
    got = {r["doc_id"]: r["scan"] for r in scan_licenses(odd).collect() if r["doc_id"] not in (None, 5, 10)}
    assert [(x["label"], x["word"]) for x in got[1]["base"]] == [("apache", 3)]
    assert "apache-2.0" in [x["label"] for x in got[1]["found"]] and got[1]["score"] == 1
    assert sorted((x["label"], x["word"]) for x in got[11]["base"]) == [("cc-by", 2), ("gpl", 4), ("gpl", 8)]
    assert got[11]["score"] >= 0.5 and got[2]["n_words"] == 0 and got[2]["base"] == [] and got[3]["score"] == 0
    assert scan_licenses(empty).count() == 0 and scan_licenses(odd).count() == odd.count()


def brute_licences(text):
    words, out = re.findall(r"[a-z0-9]+", text.lower()), Counter()
    for label, template, key in TEMPLATES:
        want, key = template.split(), key.split()
        at = next(i for i in range(len(want)) if want[i:i + len(key)] == key)
        for s in range(len(words)):
            aligned = sum(x == y for x, y in zip(want, words[s:], strict=False)) / len(want)
            if words[s + at:s + at + len(key)] == key and aligned >= 0.6:
                out[label, s, aligned] += 1
    return out


def test_every_licence_place_counts_however_common_its_words(spark):
    """One file holds all notices, and the words of some of them are common in the others."""
    pad = "one two three four five six seven eight nine ten eleven twelve "
    notices = [template for _, template, _ in TEMPLATES]
    rows = [(0, pad + " - ".join(notices)), (1, pad + " - ".join(notices * 3))]
    # The words of the key phrase alone are common, so those outside it are posted first by rarity.
    rows += [(10 + i, pad + "gnu general public license version 3 2 0 mozilla") for i in range(9)]
    rows += [(30, pad + "this item is licensed under the general public license version 3"),
             (31, pad + "subject to all terms from the mozilla public license v 2 0 " + pad)]
    rows += [(40 + i, pad + f"{x} {pad}" * 2) for i, x in enumerate(notices)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: Counter((x["label"], x["word"], x["aligned"]) for x in r["scan"]["found"])
           for r in scan_licenses(docs).collect()}
    assert got == {d: brute_licences(text) for d, text in rows}
    assert {label for label, *_ in got[0]} == {label for label, *_ in TEMPLATES}


def test_licences_cut_by_either_end_of_the_text(spark):
    rows = [(1, "under the GNU General Public License version 3 as published"),
            (2, "it is licensed under the Apache License, Version 2.0"), (3, "Apache License version 2.0"),
            (4, "granted free of charge"), (5, "redistribution and use in source and binary forms")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [(x["label"], x["word"], x["aligned"]) for x in r["scan"]["found"]]
           for r in scan_licenses(docs).collect()}
    assert got == {1: [("gpl-3.0", -4, 8 / 12)], 2: [("apache-2.0", 2, 1.0)], 3: [("apache-2.0", -3, 5 / 8)],
                   4: [], 5: []}


def test_mixture_of_odd_rows(odd, empty):
    rows = mix_sources(odd, (5, 2, 1)).collect()
    assert len(rows) == odd.count() and mix_sources(empty, (5, 2, 1)).count() == 0
    total, by = sum(r["mix"]["size"] for r in rows), defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
        assert 0 <= r["mix"]["taken"] <= 3 * r["mix"]["size"]
    assert abs(sum(v[0]["mix"]["target"] for v in by.values()) - total) < 1e-6 * total
    for v in by.values():
        size, target = v[0]["mix"]["source_size"], v[0]["mix"]["target"]
        assert size == sum(r["mix"]["size"] for r in v) and target <= 3 * size
        # Off by half a document at most; rows of one id go together.
        assert abs(sum(r["mix"]["taken"] for r in v) - target) <= 2 * max(r["mix"]["size"] for r in v)
    again = sorted(map(str, mix_sources(odd.repartition(7), (5, 2, 1)).collect()))
    assert again == sorted(map(str, rows))


def test_given_weights(spark):
    docs = spark.createDataFrame([(i, "w " * 10, s) for i, s in enumerate("aaaabbbbc" * 20)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "source string, weight double")
    mixed = mix_sources(docs, weights, max_epochs=1.5).collect()
    assert {r["source"]: r["mix"]["target"] for r in mixed} == {"a": 1200.0, "b": 0.0, "c": 0.0}
