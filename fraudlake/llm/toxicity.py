"""Toxicity by compression distance: two zstandard dictionaries.

Training, on a bounded sample of labelled documents (``max_docs`` a class):

* letter sequences of ``GRAM`` bytes that toxic documents have far more often
  than ordinary ones (a binomial bound on the chance of it) mark the segments
  where toxic text differs;
* both dictionaries begin with what zstandard learns from windows of ordinary
  text; the *toxic* one goes on with the marked segments of toxic text, the
  *ordinary* one with as many bytes that match nothing, so that a difference
  in length comes from toxic segments alone;
* a third of the sample is kept apart: it sets the threshold of a window's
  distance and the logistic curve of the score.

Scoring: a text is lower-cased and cut, between words, into windows of about
``width`` characters; each window is compressed with either dictionary. Its
distance is the bytes that the ordinary dictionary needs beyond the toxic one.

This is not a pair of dictionaries trained on toxic and on ordinary text: only
the common base is trained, and a toxic text without a marked segment has
distances near 0. The README has figures of both forms.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.llm.common import text_rows

GRAM = 5
_SPACE = re.compile(r"\s+")


def normal(text: str | None) -> str:
    return _SPACE.sub(" ", (text or "").lower()).strip()


def windows(text: str, width: int) -> list[bytes]:
    """Whole words, ``width`` characters and up to the end of the last word, with
    a space on either side. A word of over four widths is cut."""
    out: list[bytes] = []
    start, n = 0, len(text)
    while start < n:
        end = text.find(" ", start + width, start + 4 * width)
        if end < 0:
            end = min(n, start + 4 * width)
        out.append(b" %b " % text[start:end].encode("utf-8", "surrogatepass"))
        start = end + (text[end:end + 1] == " ")
    return out


@dataclass
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    width: int
    threshold: int
    weights: list[float]

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: ToxicityModel):
        self.model = model
        params = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_LAZY2, min_match=5, window_log=16, hash_log=14,
            chain_log=14, search_log=3, target_length=16, write_content_size=False,
            write_dict_id=False)
        pair = []
        for content in (model.toxic, model.ordinary):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            pair.append(zstandard.ZstdCompressor(compression_params=params, dict_data=d).compress)
        self.pair = pair

    def distances(self, text: str | None) -> np.ndarray:
        toxic, ordinary = self.pair
        parts = windows(normal(text), self.model.width)
        return np.fromiter((len(ordinary(w)) - len(toxic(w)) for w in parts), np.int64, len(parts))

    def score(self, text: str | None) -> float:
        z = float(np.dot(self.model.weights, summary(self.distances(text), self.model.threshold)))
        return 1.0 / (1.0 + float(np.exp(-min(max(z, -30.0), 30.0))))


def summary(d: np.ndarray, threshold: int) -> np.ndarray:
    """Features of a text's distances: the three largest, windows at the threshold
    and at one and two bytes less (logs of numbers, and shares), the log of the
    number of windows, and 1. Texts without windows: zeros and 1."""
    out = np.zeros(11)
    out[10] = 1.0
    if len(d):
        top = np.sort(d)[-3:][::-1]
        out[:len(top)] = top
        for k in range(3):
            hits = np.count_nonzero(d >= threshold - k)
            out[3 + k], out[6 + k] = np.log1p(hits), 10.0 * hits / len(d)
        out[9] = np.log1p(len(d))
    return out


def _grams(text: str) -> tuple[np.ndarray, bytes]:
    raw = f" {text} ".encode("utf-8", "surrogatepass")
    b = np.frombuffer(raw, np.uint8).astype(np.uint64)
    n = max(len(b) - GRAM + 1, 0)
    out = np.zeros(n, np.uint64)
    for k in range(GRAM):
        out = out << np.uint64(8) | b[k:k + n]
    return out, raw


def _document_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    sets = [np.unique(_grams(t)[0]) for t in texts] or [np.zeros(0, np.uint64)]
    return np.unique(np.concatenate(sets), return_counts=True)


def marked_grams(toxic: list[str], ordinary: list[str], chance: float = 1e-5,
                 lift: float = 8.0) -> np.ndarray:
    """Sequences inside one word (its spaces included) that at least ``lift``
    times as large a share of toxic as of ordinary documents has, and that
    would have come so by chance with a probability below ``chance``."""
    grams, n = _document_counts(toxic)
    others, counts = _document_counts(ordinary)
    m = np.zeros(len(grams))
    if len(others):
        at = np.minimum(np.searchsorted(others, grams), len(others) - 1)
        same = others[at] == grams
        m[same] = counts[at[same]]
    p = len(toxic) / (len(toxic) + len(ordinary))
    q = np.clip(n / (n + m), 1e-9, 1 - 1e-9)
    bound = (n + m) * (q * np.log(q / p) + (1 - q) * np.log((1 - q) / (1 - p)))
    inner = np.zeros(len(grams), bool)
    for k in range(1, GRAM - 1):
        inner |= grams >> np.uint64(8 * k) & np.uint64(255) == 32
    keep = (q > p) & (bound > -np.log(chance)) & ~inner
    keep &= n / len(toxic) >= lift * (m + 0.5) / max(len(ordinary), 1)
    return grams[keep]


def marked_segments(text: str, marked: np.ndarray) -> set[bytes]:
    """Maximal runs of marked sequences, cut at spaces."""
    grams, raw = _grams(text)
    if not len(grams) or not len(marked):
        return set()
    at = np.minimum(np.searchsorted(marked, grams), len(marked) - 1)
    on = np.flatnonzero(marked[at] == grams)
    if not len(on):
        return set()
    letters = np.frombuffer(raw, np.uint8)
    cuts = np.flatnonzero((np.diff(on) > 1) | (letters[on[1:]] == 32)) + 1
    return {raw[s[0]:s[-1] + GRAM] for s in np.split(on, cuts)}


def train(toxic: list[str], ordinary: list[str], prior: float, width: int = 48,
          dictionary_bytes: int = 8192, seed: int = 42) -> ToxicityModel:
    """Model of lists of sample texts; ``prior`` is the share of toxic documents
    among all labelled ones. Without either class the score is the prior."""
    toxic, ordinary = list(map(normal, toxic)), list(map(normal, ordinary))
    cut_t, cut_o = len(toxic) * 2 // 3, len(ordinary) * 2 // 3
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    flat = ToxicityModel(b"\0" * 64, b"\0" * 64, width, 1,
                         [0.0] * 10 + [float(np.log(prior / (1 - prior)))])
    if cut_t < 3 or cut_o < 3:
        return flat
    marked = np.sort(marked_grams(toxic[:cut_t], ordinary[:cut_o]))
    seen: Counter = Counter()
    for t in toxic[:cut_t]:
        seen.update(marked_segments(t, marked))
    # The most frequent segments come last: near matches are the cheapest.
    ranked = sorted((s for s in seen if seen[s] >= 2), key=lambda s: (seen[s], s))
    segments = b"".join(ranked)[-dictionary_bytes:]
    samples = [w for t in ordinary[:cut_o] for w in windows(t, 64)][:20_000]
    try:
        base = zstandard.train_dictionary(dictionary_bytes, samples, k=16, d=6).as_bytes()
    except zstandard.ZstdError:  # too little text to learn from: take it as it is
        base = b"".join(samples)[:dictionary_bytes]
    filler = np.random.default_rng(seed).integers(128, 256, max(len(segments), 1), np.uint8)
    model = ToxicityModel(base + (segments or filler.tobytes()), base + filler.tobytes(), width,
                          1, flat.weights)
    scorer = Scorer(model)
    d = [scorer.distances(t) for t in toxic[cut_t:] + ordinary[cut_o:]]
    y = np.r_[np.ones(len(toxic) - cut_t), np.zeros(len(ordinary) - cut_o)]
    top = np.array([x.max() if len(x) else 0 for x in d])
    model.threshold = max(range(1, 13), key=lambda t: (top >= t)[y == 1].mean()
                          - (top >= t)[y == 0].mean())
    x = np.array([summary(v, model.threshold) for v in d])
    w = np.where(y == 1, prior / y.sum(), (1 - prior) / (len(y) - y.sum())) * len(y)
    model.weights = _logistic(x, y, w, flat.weights).tolist()
    return model


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, start: list[float]) -> np.ndarray:
    """Weighted logistic regression by Newton steps with a small ridge."""
    beta = np.array(start)
    ridge = np.diag([0.5] * (x.shape[1] - 1) + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + ridge,
                               x.T @ (w * (p - y)) + ridge @ beta)
        beta = beta - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_docs: int,
                    max_chars: int) -> tuple[pd.DataFrame, float]:
    """(frame of text and y, share of y = 1 among all labels): at most ``max_docs``
    documents of each class, those whose ids' hashes are smallest, without texts
    of over ``max_chars``. A document with several labels counts as the largest;
    labels other than 0 and 1 count as none."""
    marks = (labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(label).cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64("doc_id")
    some = None
    for y in (0, 1):
        part = marks.filter(F.col("y") == y).orderBy(order, "doc_id").limit(max_docs)
        some = part if some is None else some.union(part)
    # Broadcast: at most two times max_docs rows.
    frame = (text_rows(docs).filter(F.length("text") <= max_chars)
             .join(F.broadcast(some), "doc_id").toPandas())
    frame = frame.sort_values(["doc_id", "text"], ignore_index=True)
    # A fixed shuffle, so that parts of the sample are alike.
    frame = frame.sample(frac=1.0, random_state=7, ignore_index=True)
    total = sum(counts.values())
    return frame, counts.get(1, 0) / total if total else 0.5


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_docs: int = 2000,
        max_chars: int = 65_536, **options) -> ToxicityModel:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label)."""
    frame, prior = labelled_sample(docs, labels, label, max_docs, max_chars)
    return train(frame.text[frame.y == 1].tolist(), frame.text[frame.y == 0].tolist(), prior,
                 **options)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, text_key, score): one row per document; the whole text is scored.

    ``text_key`` is the xxhash64 of the text. Null and empty texts have the
    score of a text without windows. Repeated rows and null doc_ids stay; an
    empty table gives an empty result; other columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = model.scorer()
        for batch in batches:
            batch["score"] = [scorer.score(t) for t in batch["text"]]
            yield batch[["doc_id", "text_key", "score"]]

    own = text_rows(docs).withColumn("text_key", F.xxhash64("text"))
    return own.mapInPandas(run, "doc_id long, text_key long, score double")


def keep_clean(docs: DataFrame, model: ToxicityModel, reject_at: float = 0.3) -> DataFrame:
    """Rows of ``docs`` whose text scores below ``reject_at``."""

    @F.pandas_udf("double")
    def toxicity(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.scorer()
        for part in parts:
            yield pd.Series([scorer.score(t) for t in part], dtype=float)

    return docs.filter(toxicity(F.col("text").cast("string")) < reject_at)
