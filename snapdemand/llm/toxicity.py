"""Toxicity: a bidirectional gated recurrent network with attention pooling over words and their characters."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .recurrent import Adam, gradients, logits, new_network
from .tables import of_small_hash

#: words in a window, and from one window's start to the next
STEPS, STRIDE = 32, 16
HIDDEN, WORD_SIZE, GRAM_SIZE = 8, 6, 6
#: words and character grams that the network knows at most: those in most training documents, and those that tell most
KNOWN_WORDS, KNOWN_GRAMS = 20_000, 8_000
GRAMS = (3, 4, 5)
#: labelled documents, toxic and clean, that are fitted on, at most, and their longest text in bytes; chosen by hash of the id
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_BYTES = 1_500, 3_500, 1 << 14
EPOCHS, ROUNDS, BATCH = 2, 3, 256
#: share of the words that training hides, so that the network learns to tell by characters too
HIDDEN_WORDS = 0.1
#: documents of one in so many are held back from fitting, to calibrate the score
CALIBRATE = 5


def _find(known: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of every value in the sorted ``known``; ``len(known)`` if it isn't there."""
    if not len(known):
        return np.zeros(len(values), np.int64)
    at = np.searchsorted(known, values)
    return np.where(known[np.minimum(at, len(known) - 1)] == values, at, len(known))


def _different(words: W.Words) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Hash and text of each different word, and for every word the number of its own."""
    hashes, first, number = np.unique(W.word_hashes(words), return_index=True, return_inverse=True)
    text = words.text
    return hashes, number, [text[a:b] for a, b in zip(words.start[first].tolist(), words.end[first].tolist())]


def _gram_hashes(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the grams of words with marked ends, and the word of each, for some words at a time."""
    data = np.frombuffer(b"".join(b"<%b>" % t for t in texts), np.uint8)
    first = np.concatenate(([0], np.cumsum([len(t) + 2 for t in texts]))).astype(np.int64)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(first, first[low] + (1 << 18), side="right")) - 1)
        part, own = data[first[low]:first[high]], first[low:high + 1] - first[low]
        for n in GRAMS:
            starts = W.window_starts(own, n)
            yield W.span_hashes(part + np.uint64(1), starts, starts + n), low + np.searchsorted(own, starts, side="right") - 1
        low = high


@dataclass
class Inputs:
    """What is known of words and grams: their hashes, sorted, and how much more often toxic documents have them (log)."""

    words: np.ndarray
    word_odds: np.ndarray
    grams: np.ndarray
    gram_odds: np.ndarray
    maybe: np.ndarray

    def of(self, hashes: np.ndarray, texts: list[bytes]):
        """For different words: number of the word, numbers of known grams and the word of each, and three fixed inputs."""
        word = _find(self.words, hashes)
        numbers, owners = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for grams, owner in _gram_hashes(texts):
            some = self.maybe[(grams & np.uint64(len(self.maybe) - 1)).astype(np.int64)]
            number, owner = _find(self.grams, grams[some]), owner[some]
            known = number < len(self.grams)
            numbers.append(number[known])
            owners.append(owner[known])
        number, owner = np.concatenate(numbers), np.concatenate(owners)
        odds, n = self.gram_odds[number], np.bincount(owner, minlength=len(texts))
        # the third highest odds of a word's grams: one gram alone says little
        order = np.lexsort((-odds, owner))
        third = np.cumsum(n) - n + 2
        some = n >= 3
        most = np.zeros(len(texts))
        most[some] = odds[order[third[some]]]
        mean = np.bincount(owner, odds, len(texts)) / np.maximum(n, 1)
        return word, number, owner, np.maximum(n, 1), np.stack([self.word_odds[word], most, mean], 1).astype(np.float32)


def _gram_counts(texts: list[bytes], bad: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams of words of toxic documents, sorted, and the sums of ``bad`` and ``good`` over the words that have each."""
    of_bad = [texts[i] for i in np.flatnonzero(bad)]
    keys = np.zeros(0, np.uint64)
    for grams, _ in _gram_hashes(of_bad):
        keys = np.union1d(keys, grams)
    sums = np.zeros((2, len(keys) + 1))
    for grams, owner in _gram_hashes(texts):
        at = _find(keys, grams)
        own = at < len(keys)
        for k, counts in enumerate((bad, good)):
            np.add.at(sums[k], at[own], counts[owner[own]])
    return keys, sums[0, :-1], sums[1, :-1]


def _odds(keys: np.ndarray, bad: np.ndarray, good: np.ndarray, most: int, telling: bool, least: int = 3):
    """At most ``most`` of the keys counted ``least`` times or more, sorted, with their smoothed log odds: those of the
    largest odds, if ``telling``, or those of the largest counts.
    """
    odds = np.log((bad + 1) / (bad.sum() + 2)) - np.log((good + 1) / (good.sum() + 2))
    rank = np.where(bad + good >= least, np.abs(odds) if telling else bad + good, -1)
    chosen = np.sort(np.argsort(-rank, kind="stable")[:most])
    chosen = chosen[rank[chosen] >= 0]
    return keys[chosen], odds[chosen]


def _windows(words: W.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and number of words of all overlapping windows, and where those of each document begin.

    A document without words has one window without words.
    """
    n = np.maximum(-(-(words.counts - (STEPS - STRIDE)) // STRIDE), 1)
    begin = np.concatenate(([0], np.cumsum(n)))
    doc = np.repeat(np.arange(len(n)), n)
    start = words.first[doc] + STRIDE * (np.arange(begin[-1]) - begin[doc])
    return start, np.minimum(words.first[doc + 1] - start, STEPS), begin


def _steps(start: np.ndarray, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.arange(STEPS)
    mask = place < length[:, None]
    at = np.where(mask, start[:, None] + place, 0)
    return (number[at] if len(number) else np.zeros(at.shape, np.int64)), mask.astype(np.float32)


@dataclass
class Model:
    inputs: Inputs
    net: dict[str, np.ndarray]
    slope: float
    shift: float

    def rows(self, hashes: np.ndarray, texts: list[bytes]):
        word, gram, owner, n, fixed = self.inputs.of(hashes, texts)
        mean = _sums(owner, self.net["grams"][gram], len(texts)) / n[:, None]
        return np.concatenate([self.net["words"][word], mean, fixed], 1, dtype=np.float32), (word, gram, owner, n)

    def window_logits(self, words: W.Words) -> tuple[np.ndarray, np.ndarray]:
        hashes, number, texts = _different(words)
        net, out = self.net, []
        if not texts:  # one row that no step reads
            texts, hashes = [b""], np.zeros(1, np.uint64)
        x, _ = self.rows(hashes, texts)
        gates = np.concatenate([x @ net["Wf"] + net["bf"], x @ net["Wb"] + net["bb"]], 1)
        start, length, begin = _windows(words)
        for low in range(0, len(start), 2048):
            index, mask = _steps(start[low:low + 2048], length[low:low + 2048], number)
            out.append(logits(net, gates, index, mask))
        return np.concatenate(out) if out else np.zeros(0), begin

    def scores(self, column: pa.Array) -> np.ndarray:
        """Score of every text: that of its worst window, calibrated."""
        out = np.zeros(len(column))
        for low, part in W.pieces(column):
            each, begin = self.window_logits(W.split(part, W.ALPHANUMERIC, lower=True))
            worst = np.maximum.reduceat(each, begin[:-1])
            out[low:low + len(part)] = 1 / (1 + np.exp(-(self.slope * worst + self.shift)))
        return out


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on one value, by Newton's method; the score never falls with the value."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(a * x + b)))
        w = p * (1 - p)
        g = np.array([((y - p) * x).sum() - 0.1 * (a - 1), (y - p).sum() - 0.1 * b])
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -1, 1)
    return max(float(a), 1e-3), float(b)


def fit(texts: list[str], labels: list[int], share: float | None = None, seed: int = 1) -> Model:
    """A model of ``labels``. The label is the document's; it is the worst windows that have to bear it.

    Each round takes, by the model so far, the three worst windows of every document and four others of clean ones, and
    trains on them for some epochs. Before the first round, windows are ranked by the odds of their words and grams. Documents held back
    calibrate the score, weighted to the ``share`` of toxic documents. Without both classes the score is that share.
    """
    y = np.array(labels, float)
    share = float(np.clip(y.mean() if share is None and len(y) else share or 0.0, 1e-3, 1 - 1e-3))
    held = np.arange(len(y)) % CALIBRATE == 0
    words = W.split(pa.array(texts, pa.string()), W.ALPHANUMERIC, lower=True)
    hashes, number, different = _different(words)
    doc = np.repeat(np.arange(len(y)), words.counts)
    toxic = np.where(held, 0, y)
    # documents, of either class, that have a word; a gram counts as often as words with it do
    pairs = np.unique(doc * len(different) + number)
    pairs = pairs[~held[pairs // max(1, len(different))]] if len(pairs) else pairs
    bad = np.bincount(pairs % max(1, len(different)), toxic[pairs // max(1, len(different))], len(different))
    good = np.bincount(pairs % max(1, len(different)), minlength=len(different)) - bad
    known, odds = _odds(hashes, bad, good, KNOWN_WORDS, False)
    grams, gram_odds = _odds(*_gram_counts(different, bad, good), KNOWN_GRAMS, True, 16)
    maybe = np.zeros(1 << 20, bool)
    maybe[(grams & np.uint64(len(maybe) - 1)).astype(np.int64)] = True
    inputs = Inputs(known, np.append(odds, 0.0), grams, gram_odds, maybe)
    rng = np.random.default_rng(seed)
    net = new_network(WORD_SIZE + GRAM_SIZE + 3, HIDDEN, seed)
    net["words"] = (0.1 * rng.standard_normal((len(known) + 1, WORD_SIZE))).astype(np.float32)
    net["grams"] = (0.1 * rng.standard_normal((max(1, len(grams)), GRAM_SIZE))).astype(np.float32)
    model = Model(inputs, net, 1.0, 0.0)
    if not 0 < toxic.sum() < (~held).sum():
        net["o"][:] = 0
        model.shift = float(np.log(share / (1 - share)))
        return model
    start, length, begin = _windows(words)
    x, parts = model.rows(hashes, different)
    evidence = np.concatenate(([0.0], np.cumsum(np.maximum(x[:, -3:-1].max(1), 0)[number])))
    ranked = evidence[start + length] - evidence[start]
    adam, weight = Adam(), np.where(y > 0, 0.5 / y[~held].mean(), 0.5 / (1 - y[~held].mean()))
    for turn in range(ROUNDS):
        if turn:
            ranked = model.window_logits(words)[0]
        chosen, of = [], []
        for d in np.flatnonzero(~held):
            low, high = int(begin[d]), int(begin[d + 1])
            worst = low + np.argsort(-ranked[low:high], kind="stable")[:3]
            if y[d]:  # a window far from the worst may be harmless
                worst = worst[ranked[worst] >= 0.5 * ranked[worst[0]]] if ranked[worst[0]] > 0 else worst[:1]
            else:
                worst = np.unique(np.concatenate([worst, rng.integers(low, high, 4)]))
            chosen.append(worst)
            of.append(np.full(len(worst), d))
        window, of = np.concatenate(chosen), np.concatenate(of)
        for _ in range(EPOCHS):
            shuffled = rng.permutation(len(window))
            for low in range(0, len(shuffled), BATCH):
                _train_batch(model, adam, window[shuffled[low:low + BATCH]], of[shuffled[low:low + BATCH]], y, weight,
                             start, length, number, parts, x, rng)
    each, begin = model.window_logits(words)
    worst = np.maximum.reduceat(each, begin[:-1])
    if 0 < y[held].sum() < held.sum():
        model.slope, model.shift = _calibrated(worst[held], y[held])
    # from the sample's share of toxic documents to that of all
    model.shift += float(np.log(share / (1 - share)) - np.log(y.mean() / (1 - y.mean()))) if 0 < y.mean() < 1 else 0.0
    return model


def _train_batch(model, adam, window, of, y, weight, start, length, number, parts, x, rng) -> None:
    index, mask = _steps(start[window], length[window], number)
    used, local = np.unique(index, return_inverse=True)
    word, gram, owner, n = parts
    here = np.full(len(x), -1)
    here[used] = np.arange(len(used))
    low, high = np.searchsorted(owner[_order(parts)], used), np.searchsorted(owner[_order(parts)], used, side="right")
    count = high - low
    flat = _order(parts)[np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())]
    mine, g = np.repeat(np.arange(len(used)), count), gram[flat]
    mean = _sums(mine, model.net["grams"][g], len(used)) / n[used, None]
    hidden = rng.random(len(used)) < HIDDEN_WORDS
    shown = np.where(hidden, len(model.inputs.words), word[used])
    fixed = x[used, -3:].copy()
    fixed[hidden, 0] = 0
    rows = np.concatenate([model.net["words"][shown], mean, fixed], 1, dtype=np.float32)
    _, grad, d_x = gradients(model.net, rows, local.reshape(index.shape), mask, y[of], weight[of])
    grad["words"] = _sums(shown, d_x[:, :WORD_SIZE], len(model.net["words"]))
    grad["grams"] = _sums(g, (d_x[:, WORD_SIZE:-3] / n[used, None])[mine], len(model.net["grams"]))
    adam.step(model.net, grad)


def _sums(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(at, rows[:, k], size) for k in range(rows.shape[1])], 1).astype(np.float32)


def _order(parts) -> np.ndarray:
    """Grams by word; made once for all batches."""
    word, gram, owner, n = parts
    if not hasattr(_order, "last") or _order.last[0] is not owner:
        _order.last = (owner, np.argsort(owner, kind="stable"))
    return _order.last[1]


def held_out(doc_id) -> F.Column:
    """Documents whose labels are never learnt from: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN,
          most_bytes: int = TRAIN_BYTES) -> Model:
    """Fitted on at most so many ``toxic`` and ``clean`` labelled documents, none held out; see ``fit``.

    Null ids, labels and texts are passed over, and texts over ``most_bytes`` (for fitting only). Ids with both labels count as toxic.
    """
    known = (labels.where("toxic in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
             .where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    # of bounded size, so it may be sent to every task
    first = [of_small_hash(known.where(F.col("toxic") == kind), "doc_id", n).orderBy(*by_hash).limit(n)
             for kind, n in ((1, toxic), (0, clean))]
    sample = F.broadcast(first[0].union(first[1]))
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .where((F.octet_length("text") <= most_bytes)).join(sample, "doc_id")
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text")).orderBy(*by_hash).collect())
    total = sum(counts.values())
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows], counts.get(1, 0) / total if total else 0.0)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs(doc_id, text)``; whole texts, no shuffle.

    A score is that of the worst of all overlapping windows, between 0 and 1. Null and empty texts have one empty window.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sent.value.scores(batch.column("text")))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
