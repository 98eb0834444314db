"""Quality classifier: random-indexing word vectors and a two-layer network.

Every word has a sparse random index vector, a function of its letters alone.
On a bounded labelled sample a word's vector is the sum of the index vectors
seen next to it (random indexing), damped by the logarithm of counts. Words
outside the sample's vocabulary stand for their shape (runs of capitals, small
letters, digits; other signs as they are). A document is the mean and the
spread of its words' vectors over the whole text; a two-layer numpy network
gives a logit, and one temperature, fitted on a part of the sample that the
network has not seen, makes it a probability.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from fraudlake.llm.common import text_rows
from fraudlake.llm.toxicity import labelled_sample

DIM = 64
FEATURES = 2 * DIM + 3
_SIGNS = 4  # entries of an index vector that are not zero
_PIECE = 1 << 16
_RUNS = re.compile(r"[^\W\d_]+|\d+|(.)\1*", re.S)


def index_vector(word: str) -> np.ndarray:
    """Sparse vector of +1 and -1, from a hash of the word."""
    h = hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=2 * _SIGNS).digest()
    v = np.zeros(DIM, np.float32)
    for k in range(_SIGNS):
        v[h[2 * k] % DIM] += 1.0 if h[2 * k + 1] & 1 else -1.0
    return v


def shape(word: str) -> str:
    """``A`` for words of capitals, ``a`` for others, ``0`` for digits, one of each
    run of other signs; at most eight runs, then ``~``."""
    out = []
    for m in _RUNS.finditer(word):
        c = m[0]
        out.append(("A" if c.isupper() and len(c) > 1 else "a") if c[0].isalpha()
                   else "0" if c[0].isdigit() else c[0])
        if len(out) == 8:
            out.append("~")
            break
    return "\0" + "".join(out)


class WordIds(dict):
    """Word -> row of the vector table. Other words: the row of their shape, kept
    while there is room for it."""

    ROOM = 500_000

    def __init__(self, rows: dict[str, int], none: int):
        super().__init__(rows)
        self.none = none

    def __missing__(self, word: str) -> int:
        row = dict.get(self, shape(word), self.none)
        if len(self) < self.ROOM and len(word) < 64:
            self[word] = row
        return row


@dataclass
class QualityModel:
    vocabulary: list[str]
    vectors: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    layers: tuple
    temperature: float

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: QualityModel):
        self.model = model
        self.ids = WordIds({w: k for k, w in enumerate(model.vocabulary)}, len(model.vocabulary))

    def pooled(self, text: str | None) -> np.ndarray:
        return pool((text or "").split(), self.ids, self.model.vectors)

    def scores(self, texts) -> np.ndarray:
        x = np.array([self.pooled(t) for t in texts], np.float64).reshape(-1, FEATURES)
        x = (x - self.model.center) / self.model.scale
        z = _forward(x, self.model.layers)[1] / self.model.temperature
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def pool(words: list[str], ids: WordIds, vectors: np.ndarray) -> np.ndarray:
    """Mean and standard deviation of the words' vectors, the mean squared step
    from a word's vector to the next, the share of steps between equal words,
    and log(1 + words)."""
    n = len(words)
    if not n:
        return np.zeros(FEATURES)
    total, squares, steps = np.zeros(DIM), np.zeros(DIM), 0.0
    for at in range(0, n, _PIECE):
        v = vectors[[*map(ids.__getitem__, words[at:at + _PIECE + 1])]]
        if len(v) > 1:
            step = v[1:] - v[:-1]
            steps += float(np.einsum("ij,ij->", step, step))
        v = v[:_PIECE]
        total += v.sum(0)
        squares += np.einsum("ij,ij->j", v, v)
    mean = total / n
    same = sum(map(eq, words, islice(words, 1, None)))
    return np.r_[mean, np.sqrt(np.maximum(squares / n - mean * mean, 0)),
                 steps / max(n - 1, 1), same / max(n - 1, 1), np.log1p(n)]


def random_indexing(texts: list[str], max_words: int, reach: int = 2) -> tuple[list, np.ndarray]:
    """(vocabulary, vectors) of the ``max_words`` most frequent words (seen at
    least five times) and all shapes of ``texts``; a last, zero, row stands for
    anything else."""
    counts: Counter = Counter()
    for t in texts:
        counts.update(t.split())
    common = sorted((w for w, k in counts.items() if k >= 5 and len(w) < 64),
                    key=lambda w: (-counts[w], w))[:max_words]
    shapes = sorted({shape(w) for w in counts})[:max_words]
    vocabulary = common + shapes
    rows = {w: k for k, w in enumerate(vocabulary)}
    ids = WordIds(rows, len(vocabulary))
    index = np.array([index_vector(w) for w in vocabulary] + [np.zeros(DIM)], np.float32)
    size = len(index)
    codes = []
    for t in texts:
        own = np.array([*map(ids.__getitem__, t.split())], np.int64)
        for d in range(1, reach + 1):
            codes += [own[:-d] * size + own[d:], own[d:] * size + own[:-d]]
    code, k = np.unique(np.concatenate(codes) if codes else np.zeros(0, np.int64),
                        return_counts=True)
    vectors = index.copy()
    word, weight = code // size, np.log1p(k).astype(np.float32)
    for at in range(0, len(code), 200_000):
        part = slice(at, at + 200_000)
        first = np.flatnonzero(np.r_[True, word[part][1:] != word[part][:-1]])
        sums = np.add.reduceat(weight[part, None] * index[code[part] % size], first, axis=0)
        vectors[word[part][first]] += sums
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vocabulary, vectors / np.maximum(length, 1e-9)


def _forward(x: np.ndarray, layers: tuple) -> tuple[np.ndarray, np.ndarray]:
    w1, b1, w2, b2 = layers
    h = np.tanh(x @ w1 + b1)
    return h, h @ w2 + b2


def _train_network(x: np.ndarray, y: np.ndarray, w: np.ndarray, hidden: int, epochs: int,
                   seed: int, decay: float = 1e-3) -> tuple:
    """Two layers by Adam on the weighted cross entropy, with weight decay."""
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden),
              rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(())]
    first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for at in range(0, len(x), 128):
            i = order[at:at + 128]
            h, z = _forward(x[i], tuple(layers))
            dz = w[i] * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) / len(i)
            dh = np.outer(dz, layers[2]) * (1 - h * h)
            grads = [x[i].T @ dh, dh.sum(0), h.T @ dz, dz.sum()]
            step += 1
            for k, g in enumerate(grads):
                g = g + decay * layers[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                layers[k] = layers[k] - 2e-3 * (first[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return tuple(layers)


def _temperature(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """The temperature with the smallest weighted cross entropy against targets
    drawn in from 0 and 1 as few examples warrant (one pseudo-example a class),
    so that a small, cleanly parted sample does not give certainties."""
    ones, zeros = max(y.sum(), 0), max((1 - y).sum(), 0)
    t = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))

    def loss(heat: float) -> float:
        return float(np.mean(w * (np.logaddexp(0, z / heat) - t * z / heat)))

    return min(np.exp(np.linspace(np.log(0.05), np.log(20), 241)).tolist(), key=loss)


def train(texts: list[str], y: np.ndarray, prior: float, max_words: int = 50_000,
          hidden: int = 32, epochs: int = 60, seed: int = 42) -> QualityModel:
    """Model of sample texts with labels ``y``; ``prior`` is the share of 1 among
    all labels. With one class only, the score is the prior."""
    y = np.asarray(y, np.float64)
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    vocabulary, vectors = random_indexing(texts, max_words)
    ids = WordIds({v: k for k, v in enumerate(vocabulary)}, len(vocabulary))
    x = np.array([pool(t.split(), ids, vectors) for t in texts]).reshape(-1, FEATURES)
    if len(set(y.tolist())) < 2:
        n = FEATURES
        layers = (np.zeros((n, 1)), np.zeros(1), np.zeros(1), np.log(prior / (1 - prior)))
        return QualityModel(vocabulary, vectors, np.zeros(n), np.ones(n), layers, 1.0)
    w = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    center, scale = x.mean(0), x.std(0) + 1e-6
    x = (x - center) / scale
    seen = np.arange(len(x)) % 5 != 0
    layers = _train_network(x[seen], y[seen], w[seen], hidden, epochs, seed)
    z = _forward(x[~seen], layers)[1]
    return QualityModel(vocabulary, vectors, center, scale, layers,
                        _temperature(z, y[~seen], w[~seen]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_docs: int = 2000,
        max_chars: int = 65_536, **options) -> QualityModel:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label)."""
    frame, prior = labelled_sample(docs, labels, label, max_docs, max_chars)
    texts = [t or "" for t in frame.text]
    return train(texts, frame.y.to_numpy(), prior, **options)


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, score): one row per document; the whole text is scored.

    Null and empty texts have the score of a text without words. Repeated rows
    and null doc_ids stay; an empty table gives an empty result; other columns
    are not read. The model, of bounded size, goes to the tasks as a broadcast
    variable.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = QualityModel(*shared.value).scorer()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": scorer.scores(batch["text"])})

    return text_rows(docs).mapInPandas(run, "doc_id long, score double")
