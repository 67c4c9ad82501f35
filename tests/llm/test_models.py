"""Trained operators and searches: held-out accuracy, gradients, recall, odd rows."""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import products
from reviewlake.llm.nearest import nearest
from reviewlake.llm.products import near_duplicate_vectors
from reviewlake.llm.queries import QUERIES
from reviewlake.llm.toxicity import INPUTS, Network, ToxicityModel, fit_toxicity, score_toxicity, train
from reviewlake.llm.urls import RULES, filter_urls


def test_gradients_equal_differences():
    net, random = Network(1), np.random.default_rng(2)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64) * 0.5
    inputs = random.standard_normal((6, INPUTS))
    at = random.integers(0, 6, (5, 32))
    at[1, 20:] = -1
    at[4, :] = -1
    label, weight = np.array([1.0, 0, 1, 0, 1]), np.ones(5)

    def loss():
        p = 1 / (1 + np.exp(-net.forward(inputs, at)))
        return -(label * np.log(p) + (1 - label) * np.log(1 - p)).mean()

    g = net.gradients(inputs, at, label, weight)
    for k, v in net.p.items():
        for i in np.ndindex(*(min(2, n) for n in v.shape)):
            old = v[i]
            v[i] = old + 1e-2
            up = loss()
            v[i] = old - 1e-2
            down = loss()
            v[i] = old
            assert abs((up - down) / 2e-2 - g[k][i]) < 2e-3


def test_toxicity_on_held_out_rows(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = {r["doc_id"]: r for r in QUERIES["op10_toxicity"](spark, sf_dir).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in scored.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in scored.values())
    labels = [r for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if scored[r["doc_id"]]["held_out"]]
    right = [scored[r["doc_id"]]["predicted"] == r["toxic"] for r in labels]
    assert np.mean(right) > 0.95


def test_toxicity_learns_parts_of_words():
    random = np.random.default_rng(5)
    parts = ["ba", "do", "ri", "lu", "me", "ka", "so", "ti"]
    word = lambda: "".join(random.choice(parts, 3))
    texts = [[word() for _ in range(120)] for _ in range(400)]
    labels = np.arange(400) % 4 == 0
    for t, bad in zip(texts, labels, strict=True):
        if bad:
            for _ in range(3):
                t[random.integers(120)] = "xyzwq" + word()
    model = train(pa.array([" ".join(t) for t in texts[:300]]), labels[:300].astype(int))
    from reviewlake.llm.tokens import slices

    score = np.concatenate([model.scores(s) for _, _, s in slices(pa.array([" ".join(t) for t in texts[300:]]))])
    assert ((score >= 0.5) == labels[300:]).mean() > 0.95


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (5, 0), (9, 0), (11, None), (None, 1), (99, 1), (7, 1), (7, 1), (12, 0)], "doc_id long, toxic int")
    model = fit_toxicity(odd, labels)
    rows = score_toxicity(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["toxicity"] <= 1 for r in rows)
    assert len({r["toxicity"] for r in rows if not (r["text"] or "").strip()}) == 1
    assert score_toxicity(empty, model).count() == 0
    nothing = fit_toxicity(empty, labels)
    assert nothing.network is None and {r["toxicity"] for r in score_toxicity(odd, nothing).collect()} == {0.0}
    assert ToxicityModel(0.25).base == 0.25


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [h + p for h, p, _ in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits, key=len, default=None)


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/1", "https://a.example.com/en/2?x=1&y=2#z",
        "http://example.com", "http://x.net/es/", "http://net/fr/1", "http://notnet/es/1", "ftp://a.b/c://d", "http://m.org?q/",
        "http://www.example.com/en/1", "http://x.com/" + "9" * 5000]


def test_url_rules_equal_brute_force(spark, sf_dir):
    says = {h + p: v for h, p, v in RULES}
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in QUERIES["op2_url_filter"](spark, sf_dir).collect():
        host, path, rule = brute_rule(pages[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == says[rule] if rule else r["verdict"] in ("allow", "block")


def test_urls_of_odd_rows(spark):
    pages = spark.createDataFrame([(i % 5, u, "x", "y", 1.0) for i, u in enumerate(URLS * 3)],
                                  "page_id long, url string, host string, suffix string, features double")
    rows = filter_urls(pages).collect()
    assert len(rows) == 3 * len(URLS)
    for r in rows:
        assert (r["judged"]["host"], r["judged"]["path"], r["judged"]["rule"]) == brute_rule(r["url"])
    assert filter_urls(pages.limit(0)).count() == 0
    # With verdicts of one kind nothing can be learnt.
    alone = filter_urls(pages.filter("url like 'http://net%' or url is null")).collect()
    assert {r["judged"]["verdict"] for r in alone if not r["url"]} == {"allow"}


def test_a_url_counts_once_however_often_it_is_repeated(spark):
    """Were the rows sampled, a sample of twenty would hold one URL only."""
    often = spark.range(100_000).select(F.lit("http://www.example.com/en/1").alias("url"))
    some = spark.range(40).selectExpr("concat('http://', if(id % 2 = 0, 'a.com/', 'b.net/es/'), id) AS url")
    judged = filter_urls(often.union(some).union(spark.sql("SELECT 'http://c.org/es/1' AS url")), sample=20)
    told = {r["url"]: (r["judged"]["rule"], r["judged"]["verdict"]) for r in judged.distinct().collect()}
    assert len(told) == 42 and judged.count() == 100_041
    assert told["http://www.example.com/en/1"] == ("www.example.com/en/", "allow") and told["http://c.org/es/1"][0] is None


def test_sample_of_texts_is_bounded_in_bytes(spark, monkeypatch):
    from reviewlake.llm import toxicity

    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, seed: seen.append((texts, labels)) or toxicity.ToxicityModel(0.5))
    rows = [(i, f"text {i} " * (20_000 if i % 5 == 0 else 1)) for i in range(60)] + [(7, "same id"), (61, "text 1 ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(62)], "doc_id long, toxic int")
    toxicity.fit_toxicity(docs, labels, sample_bytes=400_000)
    texts, known = seen[0][0].to_pylist(), seen[0][1]
    assert len(texts) == len(known) == len(set(texts)) and sum(map(len, texts)) <= 400_000
    assert any(len(t) > 10_000 for t in texts) and sum(len(t) < 10_000 for t in texts) > 25


def test_trees_learn_lexical_features(spark):
    rows = [(i, f"http://h{i}.org/{'x' * (30 if i % 2 else 3)}/{i}?a=1") for i in range(600)]
    rules = tuple((f"h{i}.org", "/", "block" if i % 2 else "allow") for i in range(200))
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    right = [r["judged"]["verdict"] == ("block" if r["page_id"] % 2 else "allow") for r in got if r["judged"]["rule"] is None]
    assert len(right) == 400 and np.mean(right) > 0.95


def odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]),
            (8, [1.0, 0.1]), (9, [0.0, 1.0]), (10, [1.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]), (11, [1e-30, 0.0]), (12, [])]
    return spark.createDataFrame([(i, v, 0, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, label int, k1 string, n int")


def test_links_of_odd_vectors(spark):
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicate_vectors(odd_vectors(spark)).collect()}
    assert got[1] == (4, 1, True) and got[8] == (4, 1, False) and got[11] == (4, 1, False) and got[9] == (0, 9, True)
    for alone in (3, 4, 5, 6, 7, 10, 12):
        assert got[alone] == (0, alone, True)
    assert got[None][1:] == (None, True)
    assert near_duplicate_vectors(odd_vectors(spark).limit(0)).count() == 0
    assert near_duplicate_vectors(odd_vectors(spark).filter("vec_id = 4")).count() == 1


def links_by_brute_force(x, cosine=0.95):
    """n_links and component of every vector."""
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    linked = x @ x.T >= cosine
    low = np.arange(len(x))
    while True:
        new = np.where(linked, low, len(x)).min(1)
        if (new == low).all():
            return linked.sum(1) - 1, low
        low = new


def test_links_over_several_shelves_and_rounds(spark, monkeypatch, tmp_path):
    random = np.random.default_rng(3)
    around = lambda n, width: random.standard_normal((1, 24)) + width * random.standard_normal((n, 24))
    # A group that crowds one list, near copies, chains of links and vectors that lie anywhere.
    x = np.concatenate([around(300, 0.1), *[around(4, 0.15) for _ in range(50)], random.standard_normal((500, 24))])
    x = np.concatenate([x, x[::7]])[random.permutation(len(x) + len(x[::7]))]
    monkeypatch.setattr(products, "LEAST_ASKING", 120)
    monkeypatch.setattr(products, "LEAST_COPIES", 1)
    tables, served, per_round = [], [], products.in_rounds
    scratch = lambda spark, label: tables.append(f"{tmp_path}/{len(tables)}-{label}") or tables[-1]
    monkeypatch.setattr("reviewlake.llm.common.scratch_dir", scratch)
    monkeypatch.setattr(products, "in_rounds", lambda copies, most: served.extend(
        (sum(copies[s] for s in some), most, len(some)) for some in per_round(copies, most)) or per_round(copies, most))
    vectors = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_duplicate_vectors(vectors).collect()}
    n, low = links_by_brute_force(x)
    assert got == {i: (n[i], low[i], low[i] == i) for i in range(len(x))}
    assert len(served) > 2 and all(held <= most or shelves == 1 for held, most, shelves in served)
    # A vector lies on disk once, however many lists it probes.
    kept = [spark.read.parquet(t) for t in tables if os.path.exists(t)]
    assert [df.count() for df in kept if "embedding" in df.columns] == [len(np.unique(x, axis=0))]


def test_groups_are_bounded_by_values():
    assert [products.asking_size(n, d) for n, d in ((10, 64), (10**5, 64), (10**7, 64), (10**7, 1024))] == [4096, 6250, 16384, 1024]


def test_shelves_hold_whole_lists_or_pieces_of_crowded_ones():
    shelves = products.Shelves({0: 5, 1: 4, 2: 25, 4: 3, 5: 8}, 6, 10)
    assert shelves.first.tolist() == [0, 0, 1, 4, 4, 5] and shelves.pieces.tolist() == [1, 1, 3, 1, 1, 1]
    reached = np.array([[1, 1, 0, 0, 0, 0], [0, 0, 1, 0, 0, 1]], bool)
    assert [s.tolist() for s in shelves.of(reached)] == [[0], [1, 2, 3, 5]]
    assert list(products.in_rounds([3, 4, 9, 1, 1], 7)) == [[0, 1], [2], [3, 4]]


def test_nearest_of_odd_vectors(spark):
    vectors = odd_vectors(spark)
    got = [tuple(r) for r in nearest(vectors, vectors.filter("vec_id in (1, 3, 4)"), k=2).orderBy("rank").collect()]
    assert [(q, rank, v) for q, rank, v, _ in got] == [(1, 1, 8), (1, 2, 2)]
    assert nearest(vectors.limit(0), vectors.limit(0)).count() == 0
    assert nearest(vectors.filter("vec_id = 4"), vectors.filter("vec_id = 4")).count() == 0


def test_ties_and_copies_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(100, [0.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nearest(vectors, vectors.filter("vec_id in (3, 100)"), k=4).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in got] == [(3, 0), (3, 1), (3, 2), (3, 4), (100, 0), (100, 1), (100, 2), (100, 3)]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_recall(spark, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in table]), np.array([r["embedding"] for r in table], np.float64)
    found = {}
    for r in QUERIES["op3_nearest"](spark, sf_dir).collect():
        found.setdefault(r["query_id"], {})[r["vec_id"]] = r["score"]
    hits = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((x - x[ids == q]) ** 2).sum(1))
        far[ids == q] = np.inf
        assert all(abs(far[ids == v][0] - s) < 1e-12 for v, s in found[q].items())
        hits += len(set(ids[np.lexsort((ids, far))[:10]]) & set(found[q]))
    assert hits >= 0.9 * 10 * (ids % 100 == 0).sum()
