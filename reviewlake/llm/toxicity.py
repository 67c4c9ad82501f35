"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is read as words. The word input of a word is how much more often it stands in toxic texts; its
character input is the same for its character sequences (four to six bytes, the space before a word
included), so unknown words are judged by their parts. Two gated recurrent layers read each window in
both directions, attention pools their states, and a text scores as its worst window does. All windows
of every text are scored, each overlapping the next by half.

The network and the input tables are fitted on the driver from a bounded seeded sample of labelled
texts; what is sent to the tasks has a fixed size. While training, a text's inputs come from the labels
of the other half of the sample, so the network learns from inputs as noisy as those of new texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.llm.common import cut, registered, row_but, table
from reviewlake.llm.tokens import Texts, mixed, slices, space_table, split, word_hashes

WINDOW, STRIDE, HIDDEN, INPUTS = 32, 16, 8, 4
# While training: windows a batch, and windows of a text among which the network looks for the worst.
BATCH, TRIED = 192, 4
# Windows whose words are looked up together.
SCORED = 2048
TABLE_BITS = 20
GRAMS = (4, 5, 6)
_LETTERS = space_table(lower=True, punctuation=True)


def _slot(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class Read:
    """Texts as a list of distinct words and, for each word in turn, its place in that list."""

    of: np.ndarray  # where each text's words begin, and their number
    token: np.ndarray
    hashes: np.ndarray
    gram_slots: np.ndarray
    grams_of: np.ndarray  # where each distinct word's character sequences begin, and their number

    @property
    def word_slots(self) -> np.ndarray:
        return _slot(self.hashes)

    def counts(self) -> np.ndarray:
        return np.diff(self.of)


def read(texts: Texts) -> Read:
    words = split(texts, _LETTERS)
    hashes, first, token = np.unique(word_hashes(words), return_index=True, return_inverse=True)
    lengths = (words.ends - words.starts)[first]
    # Each distinct word with one space before it, on end.
    size = lengths + 1
    begin = np.cumsum(size) - size
    within = np.arange(int(size.sum())) - np.repeat(begin, size)
    source = np.repeat(words.starts[first], size) + within - 1
    data = np.where(within == 0, 0x20, words.data[np.maximum(source, 0)]).astype(np.uint64)
    left = np.repeat(size, size) - within
    found, owner = [], []
    of_byte = np.repeat(np.arange(len(size), dtype=np.int32), size)
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        value = np.full(len(at), n, np.uint64)
        for j in range(n):
            value = value * np.uint64(0x100000001B3) + data[at + j]
        found.append(_slot(mixed(value)).astype(np.int32))
        owner.append(of_byte[at])
    owner, slots = np.concatenate(owner), np.concatenate(found)
    order = np.argsort(owner, kind="stable")
    return Read(words.of, token.astype(np.int32), hashes, slots[order], np.searchsorted(owner[order], np.arange(len(size) + 1)))


def spread(begins: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """``begins[i]``, ``begins[i] + 1`` and so on, ``numbers[i]`` of them for each i, on end."""
    ends = np.cumsum(numbers)
    return np.arange(int(numbers.sum())) + np.repeat(begins - ends + numbers, numbers)


def joined(parts: list[Read]) -> Read:
    """Several reads as one."""
    hashes, first, place = np.unique(np.concatenate([p.hashes for p in parts]), return_index=True, return_inverse=True)
    shift = np.cumsum([0] + [len(p.hashes) for p in parts])
    token = np.concatenate([place[p.token + shift[i]].astype(np.int32) for i, p in enumerate(parts)])
    numbers = np.concatenate([np.diff(p.grams_of) for p in parts])
    begins = (np.cumsum(numbers) - numbers)[first]
    slots = np.concatenate([p.gram_slots for p in parts])[spread(begins, numbers[first])]
    of = np.cumsum(np.concatenate([[0]] + [p.counts() for p in parts]))
    return Read(of, token, hashes, slots, np.append(0, np.cumsum(numbers[first])))


def inputs_of(seen: Read, word_table: np.ndarray, gram_table: np.ndarray) -> np.ndarray:
    """The inputs of each distinct word: its own score, the best and the mean of its parts', one."""
    n = len(seen.word_slots)
    out = np.ones((n, INPUTS), np.float32)
    out[:, 0] = word_table[seen.word_slots]
    out[:, 1:3] = gram_table.min() if n else 0
    some = np.diff(seen.grams_of) > 0
    if some.any():
        values, begins = gram_table[seen.gram_slots], seen.grams_of[:-1][some]
        out[some, 1] = np.maximum.reduceat(values, begins)
        out[some, 2] = np.add.reduceat(values, begins) / np.diff(seen.grams_of)[some]
    return out


def windows_of(seen: Read) -> np.ndarray:
    """Each text's first window, and the number of windows; a text has one at least."""
    per_text = np.maximum(1, -(-(seen.counts() - (WINDOW - STRIDE)) // STRIDE))
    return np.append(0, np.cumsum(per_text))


def words_in(seen: Read, first: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The distinct words of some windows in turn, -1 beyond a text's end."""
    text = np.searchsorted(first, windows, "right") - 1
    place = ((windows - first[text]) * STRIDE)[:, None] + np.arange(WINDOW)
    inside = place < seen.counts()[text][:, None]
    token = np.append(seen.token, 0)
    return np.where(inside, token[np.where(inside, place + seen.of[text][:, None], -1)], -1).astype(np.int32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _own(inputs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The inputs of the words that stand in the windows alone, and the windows by their places among them."""
    if len(inputs) <= at.size:
        return inputs, at
    words = np.unique(at[at >= 0])
    return inputs[words], np.where(at < 0, -1, np.searchsorted(words, at))


class Network:
    """Parameters and both passes; arrays are steps x windows x units."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        h = HIDDEN
        scale = lambda *shape: (random.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.p = {f"{kind}{d}": value for d in (0, 1) for kind, value in (
            ("w", scale(INPUTS, 3 * h)), ("u", scale(h, 3 * h)), ("b", np.zeros(3 * h, np.float32)))}
        self.p |= {"a": scale(2 * h), "o": scale(2 * h), "c": np.zeros(1, np.float32)}
        # One unit of each direction starts as a detector of inputs above even odds.
        for d in (0, 1):
            self.p[f"w{d}"][:, 2 * h] = (0.5, 0.5, 0.0, 1.0)
            self.p["a"][d * h], self.p["o"][d * h] = 3.0, 3.0
        self.scale, self.shift = 1.0, 0.0

    def forward(self, inputs: np.ndarray, at: np.ndarray, keep: bool = False):
        """Logits of windows; ``inputs`` by distinct word, ``at``: windows x steps, -1 for none."""
        h, (n, steps) = HIDDEN, at.shape
        inputs, at = _own(inputs, at)
        mask = (at >= 0).T
        states, kept = np.zeros((steps, n, 2 * h), np.float32), {}
        for d in (0, 1):
            gates = np.vstack([inputs @ self.p[f"w{d}"] + self.p[f"b{d}"], np.zeros((1, 3 * h), np.float32)])
            u, state, trace = self.p[f"u{d}"], np.zeros((n, h), np.float32), []
            for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
                x, r = gates[at[:, t]], state @ u
                zr = 1 / (1 + np.exp(-(x[:, :2 * h] + r[:, :2 * h])))
                z, reset = zr[:, :h], zr[:, h:]
                new = np.tanh(x[:, 2 * h:] + reset * r[:, 2 * h:])
                now = np.where(mask[t][:, None], new + z * (state - new), state)
                if keep:
                    trace.append((t, state, z, reset, new, r[:, 2 * h:]))
                state = states[t, :, d * h:(d + 1) * h] = now
            kept[d] = trace
        score = np.where(mask, states @ self.p["a"], -30)
        weight = np.exp(score - score.max(0))
        weight *= mask
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", weight, states)
        logit = pooled @ self.p["o"] + self.p["c"]
        return (logit, states, weight, pooled, kept, mask) if keep else logit

    def gradients(self, inputs: np.ndarray, at: np.ndarray, label: np.ndarray, importance: np.ndarray):
        h, (inputs, at) = HIDDEN, _own(inputs, at)
        logit, states, weight, pooled, kept, mask = self.forward(inputs, at, keep=True)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d_logit = ((_sigmoid(logit) - label) * importance / importance.sum()).astype(np.float32)
        g["c"][0], g["o"] = d_logit.sum(), pooled.T @ d_logit
        d_pooled = d_logit[:, None] * self.p["o"]
        d_weight = np.einsum("tnh,nh->tn", states, d_pooled)
        d_score = weight * (d_weight - (weight * d_weight).sum(0))
        g["a"] = np.einsum("tn,tnh->h", d_score, states)
        d_states = weight[:, :, None] * d_pooled + d_score[:, :, None] * self.p["a"]
        rows = np.vstack([inputs, np.zeros((1, INPUTS), np.float32)])
        for d in (0, 1):
            u, back = self.p[f"u{d}"], np.zeros((len(label), h), np.float32)
            for t, state, z, reset, new, r in reversed(kept[d]):
                m = mask[t][:, None]
                d_now = back + d_states[t, :, d * h:(d + 1) * h]
                d_new = d_now * (1 - z) * (1 - new * new) * m
                d_z = d_now * (state - new) * z * (1 - z) * m
                d_r = d_new * r * reset * (1 - reset)
                d_gate = np.hstack([d_z, d_r, d_new])
                d_rec = np.hstack([d_z, d_r, d_new * reset])
                g[f"w{d}"] += rows[at[:, t]].T @ d_gate
                g[f"b{d}"] += d_gate.sum(0)
                g[f"u{d}"] += state.T @ d_rec
                back = np.where(m, d_now * z, d_now) + d_rec @ u.T
        return g


@dataclass
class ToxicityModel:
    """What scores texts. Without a network (nothing to learn from) every text scores ``base``."""

    base: float
    word_table: np.ndarray | None = None
    gram_table: np.ndarray | None = None
    network: Network | None = field(default=None)

    def window_logits(self, seen: Read, inputs: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.concatenate([self.network.forward(inputs, words_in(seen, first, np.arange(i, min(i + SCORED, first[-1]))))
                               for i in range(0, int(first[-1]), SCORED)])

    def scores(self, texts: Texts) -> np.ndarray:
        if self.network is None or not len(texts):
            return np.full(len(texts), self.base)
        seen = read(texts)
        first = windows_of(seen)
        logits = self.window_logits(seen, inputs_of(seen, self.word_table, self.gram_table), first)
        worst = np.maximum.reduceat(logits, first[:-1]).astype(np.float64)
        return _sigmoid(worst * self.network.scale + self.network.shift)


def _rates(seen: Read, label: np.ndarray, rows: np.ndarray, prior: float = 4.0) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of toxicity by word and by character sequence, from the given texts."""
    rate, slots = max(1e-3, float(label[rows].mean())), 1 << TABLE_BITS
    tables = np.zeros((4, slots), np.float32)

    def add(kind: int, slot: np.ndarray, text: np.ndarray) -> None:
        """Counts each text once for every slot it holds: the toxic ones and all."""
        once = np.unique(text.astype(np.int64) << TABLE_BITS | slot)
        slot = once & (slots - 1)
        np.add.at(tables[kind], slot, label[once >> TABLE_BITS].astype(np.float32))
        np.add.at(tables[kind + 1], slot, 1)

    for first in range(0, len(label), 100):  # a hundred texts at a time, to bound what is held
        last = min(first + 100, len(label))
        text = np.repeat(np.arange(first, last), seen.counts()[first:last])
        word = seen.token[seen.of[first]:seen.of[last]]
        text, word = text[rows[text]], word[rows[text]]
        pairs = np.unique(text * np.int64(len(seen.hashes)) + word)
        text, word = pairs // len(seen.hashes), pairs % len(seen.hashes)
        number = np.diff(seen.grams_of)[word]
        add(0, _slot(seen.hashes[word]), text)
        add(2, seen.gram_slots[spread(seen.grams_of[:-1][word], number)], np.repeat(text, number))
    share = [(tables[k] + prior * rate) / (tables[k + 1] + prior) for k in (0, 2)]
    return tuple(np.log(x / (1 - x)).astype(np.float32) for x in share)


def train(texts: pa.Array, labels: np.ndarray, epochs: int = 6, seed: int = 3) -> ToxicityModel:
    """Fits the tables and the network; of each text the currently worst window is learnt from.

    The network chooses it among those few that the inputs call worst, and learns a random one of each
    clean text besides.
    """
    # Copies would count as evidence for every rare word in them.
    once = sorted({blake2b((x.as_py() or "").encode(), digest_size=16).digest(): i for i, x in enumerate(texts)}.values())
    texts, label = texts.take(pa.array(once, pa.int64())), np.asarray(labels, np.float64)[once]
    if not len(label) or label.min() == label.max():
        return ToxicityModel(float(label.mean()) if len(label) else 0.0)
    seen, random = joined([read(some) for _, _, some in slices(texts)]), np.random.default_rng(seed)
    half = random.random(len(label)) < 0.5
    first = windows_of(seen)
    # Texts of either half see the other half's tables: two lists of distinct words on end.
    inputs, words = np.vstack([inputs_of(seen, *_rates(seen, label, rows)) for rows in (half, ~half)]), len(seen.hashes)
    model = ToxicityModel(float(label.mean()), network=Network(seed))
    net = model.network

    def learnt(windows: np.ndarray) -> np.ndarray:
        at, text = words_in(seen, first, windows), np.searchsorted(first, windows, "right") - 1
        return np.where(at < 0, -1, at + np.where(half[text], words, 0)[:, None].astype(np.int32))

    importance = np.where(label == 1, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    moments, step = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items()}, 0
    # Of all windows only a guess is held; their words are looked up some at a time.
    call, guess = inputs[:, 0] + inputs[:, 1], np.empty(int(first[-1]), np.float32)
    for i in range(0, len(guess), SCORED):
        at = learnt(np.arange(i, min(i + SCORED, len(guess))))
        guess[i:i + len(at)] = np.where(at < 0, -9, call[at]).max(1)
    text = np.repeat(np.arange(len(label), dtype=np.int32), np.diff(first))
    order = np.lexsort((-guess, text))
    few = np.sort(order[np.arange(len(text)) - first[:-1][text] < TRIED])
    few_first = np.searchsorted(text[few], np.arange(len(label) + 1))
    peak, few_at, clean = guess[few], learnt(few), np.flatnonzero(label == 0)
    del guess, text, order, call
    for _ in range(epochs):
        other = (first[:-1] + random.random(len(label)) * np.diff(first)).astype(np.int64)
        rows = np.concatenate([np.arange(len(label)), clean])
        chosen = np.concatenate([few_at[_worst(peak, few_first)], learnt(other[clean])])
        order = random.permutation(len(rows))
        for i in range(0, len(order), BATCH):
            part = order[i:i + BATCH]
            g = net.gradients(inputs, chosen[part], label[rows[part]], importance[rows[part]])
            step += 1
            for k, v in net.p.items():
                m1, m2 = moments[k]
                m1 += 0.1 * (g[k] - m1)
                m2 += 0.01 * (g[k] * g[k] - m2)
                v -= 0.005 * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.99 ** step)) + 1e-6)
        peak = np.concatenate([net.forward(inputs, few_at[i:i + SCORED]) for i in range(0, len(few), SCORED)])
    _calibrate(net, peak[_worst(peak, few_first)].astype(np.float64), label)
    model.word_table, model.gram_table = _rates(seen, label, np.ones(len(label), bool))
    return model


def _worst(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Index of each text's greatest value."""
    top = np.maximum.reduceat(value, first[:-1])
    hit = np.flatnonzero(value == np.repeat(top, np.diff(first)))
    return hit[np.searchsorted(hit, first[:-1])]


def _calibrate(net: Network, logit: np.ndarray, label: np.ndarray) -> None:
    """One logistic step over whole texts, so that 0.5 is the even chance."""
    scale, shift = 1.0, 0.0
    x = np.clip(logit, -20, 20)
    for _ in range(50):
        p = _sigmoid(scale * x + shift)
        w = p * (1 - p) + 1e-6
        hess = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        grad = np.array([((p - label) * x).sum() + (scale - 1), (p - label).sum() + 0.1 * shift])
        delta = np.linalg.solve(hess, grad)
        scale, shift = scale - np.clip(delta[0], -1, 1), shift - np.clip(delta[1], -2, 2)
    net.scale, net.shift = float(max(scale, 0.05)), float(shift)


def held_out(id_column: Column) -> Column:
    """True for ids whose checksum is divisible by 5; a null id is not held out."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def fit_toxicity(
    documents: DataFrame, labels: DataFrame, sample: int = 5_000, sample_bytes: int = 1 << 24, seed: int = 3
) -> ToxicityModel:
    """A model from at most ``sample`` labelled texts that are not held out and ``sample_bytes`` of text.

    Texts are taken in the order of a hash of the id, each if it still fits; equal texts count once. Only
    ids, sizes and hashes of at most ``sample`` rows are looked at to choose them; no text is cut.
    Null labels and labels of unknown documents are left out; of repeated ids any text may be taken.
    """
    place = F.xxhash64(F.col("doc_id"), F.lit(seed))
    chosen = cut(
        labels.select("doc_id", "toxic").filter("doc_id is not null and toxic in (0, 1)")
        .filter(~held_out(F.col("doc_id"))).distinct().orderBy(place, "toxic").limit(sample),
        "toxicity-sample")
    text = F.coalesce("text", F.lit(""))
    known = documents.select("doc_id", text.alias("text"), F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(7), text).alias("h2"))
    # The sample is bounded by the parameters, so it may be broadcast.
    sized = (known.select("doc_id", "h1", "h2", F.octet_length("text").alias("bytes")).join(F.broadcast(chosen), "doc_id")
             .orderBy(place, "toxic", "h1", "h2").limit(sample))
    taken, used, left = [], set(), sample_bytes
    for row in sized.collect():
        if (row["h1"], row["h2"]) not in used and row["bytes"] <= left:
            left -= row["bytes"]
            used.add((row["h1"], row["h2"]))
            taken.append((row["doc_id"], row["h1"], row["h2"], row["toxic"], len(taken)))
    few = documents.sparkSession.createDataFrame(taken, "doc_id long, h1 long, h2 long, toxic int, at int")
    # The first of equal rows: so many rows come back as were taken.
    found = known.join(F.broadcast(few), ["doc_id", "h1", "h2"]).groupBy("at").agg(
        F.first("text").alias("text"), F.first("toxic").alias("toxic")).toArrow().sort_by("at")
    return train(found["text"].combine_chunks().cast(pa.string()), found["toxic"].to_numpy(), seed=seed)


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """0 to 1; null text counts as empty."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = [model.scores(some) for _, _, some in slices(batch)]
            yield pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    return score(text)


def score_toxicity(documents: DataFrame, model: ToxicityModel) -> DataFrame:
    """The documents with ``toxicity``, from 0 to 1.

    - Null and empty texts have one window without words and get the network's answer to that.
    - Every row is scored by its text alone: repeated rows, null and repeated ids are kept. An empty
      table gives an empty result; other columns pass through unchanged.
    - Labels of one kind only, or none: every text scores the share of toxic labels.
    """
    return documents.select(
        row_but(documents, "toxicity"), toxicity_score(F.col("text"), model).alias("toxicity")
    ).select("row.*", "toxicity")


@registered("op10_toxicity")
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, by a model of the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
        F.when(F.col("toxicity") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))
