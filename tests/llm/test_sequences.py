"""Alignment, prefix trie and packing against brute force, with odd rows and with none."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from reviewlake.llm.alignment import Pair, align_tokens, aligned, shared_cuts
from reviewlake.llm.bpe import byte_letters, vocabulary
from reviewlake.llm.packing import best_fit, bin_completion, lower_bound, pack_documents, undominated
from reviewlake.llm.queries import QUERIES
from reviewlake.llm.tries import SpillingQueue, end_digests, prefix_trie, rebuilt
from reviewlake.llm.units import word_ids
from tests.conftest import rows

A, B, WORDS = (vocabulary(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model", "word_bpe_49k.json"))
ODD = ["", None, " ", "  ", "a", "\n", "\n\n x", "a\nb", "foo \n bar\n", "foo\n", "x\t\ty  z   ", "▁", "a▁b",
       "<|endoftext|> x <s> </s> <unk> <0x41>", "你好 世界", "　全角 x", "a\xa0b \n c", "é é", "a" * 5000, "😀😀 👩‍👩‍👧",
       " " * 1000 + "x" + "\n" * 50, "\x00a\x01 \x1c b\x1f", "1234567 89.01", "\r\n\r\n a\r\nb", "don't  I'll", "﻿bom", "x²Ⅷ y",
       "<|startoftext|>x<|endoftext|>", "Σας ΟΔΟΣ ǅ ß İ"]


@pytest.fixture(scope="module")
def libraries():
    left, right = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    left.encode_special_tokens = True
    return left, right


def brute_alignment(libraries, text):
    left, right = libraries
    none = 0, 0, 0, 0, "", Counter()
    if not text:
        return none
    byte = {letter: i for i, letter in enumerate(byte_letters())}
    a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
    parts_a = [bytes(byte[c] for c in left.id_to_token(i)) for i in a]
    parts_b = [bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode()
               for i in b]
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return none
    ends_a, ends_b = (np.cumsum([len(x) for x in parts]).tolist() for parts in (parts_a, parts_b))
    groups, links, i, j = [], Counter(), 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        x, y = i, j
        while i < len(a) and ends_a[i] <= end:
            i += 1
        while j < len(b) and ends_b[j] <= end:
            j += 1
        groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        links.update((p, q) for p in a[x:i] for q in b[y:j])
    return len(a), len(b), len(groups), sum(links.values()), ";".join(groups), links


def brute_counted(libraries, texts):
    done = [brute_alignment(libraries, t) for t in texts]
    count = Counter(pair for *_, links in done for pair in links)
    top = defaultdict(int)
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    return [(*d[:5], sum(n for p, n in d[5].items() if count[p] == top[p[0]]), sum(n * count[p] for p, n in d[5].items()))
            for d in done]


def random_texts(n):
    letters = [*"ab \n\t.,'0é你😀▁", "the", " of", "<s>", "  ", "\n\n", "It's", "́"]
    draw = random.Random(4)
    return ["".join(draw.choice(letters) for _ in range(draw.randint(1, 60))) for _ in range(n)]


def test_alignment_of_odd_texts(libraries):
    texts = ODD + random_texts(2000)
    for text, got in zip(texts, aligned(Pair(A, B), [t or "" for t in texts]), strict=True):
        want = brute_alignment(libraries, text)
        assert got[:5] == want[:5], repr(text)
        assert dict(zip(got[5].tolist(), got[6].tolist(), strict=True)) == {a << 16 | b: n for (a, b), n in want[5].items()}


def test_long_texts_are_aligned_in_stretches(libraries, monkeypatch):
    from reviewlake.llm import alignment

    monkeypatch.setattr(alignment, "STRETCH", 40)
    monkeypatch.setattr(alignment, "LARGE", 2)
    texts = [t for t in random_texts(300) if "▁" not in t] + ["word " * 200]
    for text, got in zip(texts, aligned(Pair(A, B), texts), strict=True):
        assert got[:5] == brute_alignment(libraries, text)[:5]


def test_cuts_are_the_common_ends():
    draw = np.random.default_rng(1)
    for share in (0.02, 0.5, 1.0):
        for _ in range(30):
            n = int(draw.integers(1, 400))
            a, b = (np.flatnonzero(draw.random(n) < p) + 1 for p in (share, draw.random()))
            a, b = np.union1d(a, [n]), np.union1d(b, [n])
            cuts = shared_cuts(a, b, np.array([0]), np.array([len(a) - 1]))
            assert a[cuts].tolist() == np.intersect1d(a[:-1], b).tolist()


def test_aligned_tokens_equal_brute_force(spark, sf_dir, libraries):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op11_token_alignment"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for doc, want in zip(docs, brute_counted(libraries, [d["text"] for d in docs]), strict=True):
        row = got[doc["doc_id"]]
        digest = hashlib.sha256(want[4].encode()).hexdigest() if want[0] else ""
        assert tuple(row[1:]) == (*want[:4], *want[5:], digest)


def test_aligned_tokens_of_odd_rows(odd, empty, libraries):
    got = align_tokens(odd, A, B)
    assert got.columns == [*odd.columns, "aligned", "counted"]
    texts = [r["text"] for r in odd.select("text").collect()]
    want = Counter(brute_counted(libraries, texts))
    assert Counter((*r["aligned"], *r["counted"]) for r in got.collect()) == want
    assert align_tokens(empty, A, B).count() == 0


def test_queue_spills_in_order():
    draw, queue, held, out = random.Random(2), SpillingQueue(8), [], []
    for i in range(3000):
        held.append((draw.randint(-50, 50), bytes([draw.randint(0, 9)]), i, 1))
        queue.push(held[-1])
        if i % 7 == 0:
            least = min(held)
            assert queue.least() == least and queue.pop() == least
            held.remove(least)
    while queue.least() is not None:
        out.append(queue.pop())
    assert out == sorted(held)


def brute_trie(turns):
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    whole = {}
    for c, mine in said.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = said.get(c - c % 5, [])[:h] + mine[h:]
    members = defaultdict(list)
    for c, turns_of in whole.items():
        for d in range(len(turns_of) + 1):
            members[tuple(turns_of[:d])].append(c)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[:len(node)] == node]
        leaves = [x for x in below if not any(y[:-1] == x and y for y in below if y != x and len(y) == len(x) + 1)]
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(node))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
                    sum(len(x) == len(node) + 1 for x in below), len(leaves),
                    sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x), hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


TURNS = "conv_id long, turn long, role string, text string, depth int, key string, place int"
TOLD = [(c, t, r, x, 1, "k", 2) for c, t, r, x in [
    *((c, t, "user", f"hello {t}") for c in range(5, 14) for t in range(6)), *((c, t, "user", f"other {c % 2}") for c in (20, 21, 22) for t in range(12)),
    (30, 1, None, None), (30, None, "user", "first"), (30, 1, None, ""), (31, 0, "a", "é"), (31, 0, "a", "é"), (31, 0, "a", "b"),
    (None, 0, "user", "nobody"), (33, 0, "user", "alone"), (44, 2, "x", "long " * 5000), (0, 0, "user", "zero")]]


@pytest.mark.parametrize("light, held", [(4096, 1 << 18), (2, 2)])
def test_trie_of_odd_rows(spark, light, held):
    turns = spark.createDataFrame(TOLD, TURNS)
    trie = prefix_trie(*rebuilt(turns), light=light, in_memory=held)
    digests = end_digests(trie.ends, most=8)
    got = trie.nodes.join(digests, "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
    assert Counter(rows(got)) == brute_trie([x[:4] for x in TOLD])


def test_trie_of_nothing(spark):
    nobody = spark.createDataFrame([(None, 0, "user", "nobody", 1, "k", 2)], TURNS)
    for turns in (nobody, nobody.limit(0)):
        trie = prefix_trie(*rebuilt(turns))
        assert trie.nodes.count() == 0 and end_digests(trie.ends).count() == 0


def least_bins(items, capacity):
    """The fewest bins by trying everything."""
    best = len(items)
    items = sorted(items, reverse=True)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for k in sorted(set(range(len(bins))), key=lambda k: bins[k]):
            if bins[k] + items[i] <= capacity and bins[k] not in [bins[j] for j in range(k)]:
                bins[k] += items[i]
                place(i + 1, bins)
                bins[k] -= items[i]
        bins.append(items[i])
        place(i + 1, bins)
        bins.pop()

    place(0, [])
    return best


def test_packing_is_optimal_on_small_instances():
    draw, better = random.Random(1), 0
    for _ in range(150):
        capacity = draw.choice([20, 50, 100])
        items = [draw.randint(capacity // 6, capacity * 3 // 5) for _ in range(draw.randint(1, 10))]
        counts = Counter(items)
        bins = bin_completion(counts, capacity)
        assert all(0 < sum(f) <= capacity for f in bins)
        held = Counter()
        for filling, n in bins.items():
            held.update({x: n * m for x, m in Counter(filling).items()})
        assert held == counts
        assert lower_bound(counts, capacity) <= sum(bins.values()) == least_bins(items, capacity)
        better += sum(bins.values()) < sum(best_fit(counts, capacity).values())
    assert better
    assert bin_completion(Counter(), 10) == {}


def test_fillings_are_not_dominated():
    assert list(undominated(Counter([9, 6, 5, 4, 3, 2]), 9, 15, 50)) == [(6,)]
    # 5 + 3 + 2 gives way to 8 + 2, and 4 + 3 + 2 to 8 + 2 or 5 + 4.
    assert list(undominated(Counter([9, 8, 5, 4, 3, 2]), 9, 19, 50)) == [(8, 2), (5, 4)]
    assert list(undominated(Counter([7]), 7, 10, 5)) == [()]


def test_word_ids_equal_the_library():
    library, texts = Tokenizer.from_file(WORDS), [t or "" for t in ODD] + random_texts(500)
    for text, ids in zip(texts, word_ids(WORDS).ids(texts), strict=True):
        assert np.frombuffer(ids, np.uint32).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def check_packed(packed, docs, capacity):
    library = Tokenizer.from_file(WORDS)
    want = Counter()
    for d, text in docs:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        for k, s in enumerate(range(0, len(ids), capacity)):
            piece = ids[s:s + capacity]
            want[d, k, s, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += 1
    assert Counter(p[:5] for p in packed) == want
    sequences = defaultdict(list)
    for *_, length, _, sequence, offset in packed:
        sequences[sequence].append((offset, length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    total = sum(p[3] for p in packed)
    return len(sequences), -(-total // capacity)


def test_packed_documents(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    used, least = check_packed(rows(QUERIES["op13_best_fit_packing"](spark, sf_dir)), docs, 2048)
    assert used == least


def test_packing_of_odd_rows(odd, empty):
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = pack_documents(odd, WORDS, 64)
    assert got.columns == [*odd.columns, "pieces", "packed"]
    flat = got.select("doc_id", "pieces.piece", "pieces.start", "pieces.length", F.crc32("pieces.ids"), "packed.*")
    used, least = check_packed(rows(flat), docs, 64)
    assert used <= least + 1
    assert pack_documents(empty, WORDS).count() == 0
