"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability comes from a logistic model of its
words and word stems; the document's is the noisy-or of its sentences, 1 - prod(1 - p).  Only
document labels are known: the model is trained by the likelihood of those, which
assigns the blame to sentences.  Afterwards sentence scores locate the offending sentences.

Noisy-or alone adds up the faint probabilities of ordinary sentences, so that a clean text would be
rejected once it is long enough.  So training also learns a floor, the logit that ``1 - TAIL`` of the
sentences of clean training documents stay below (between probabilities 0.05 and 0.5).  Sentences above
the floor enter the noisy-or each for itself; of those below it, the greatest alone.

Training uses at most ``SAMPLE`` labelled rows, in the order of a hash of their ids, as far as their
texts fit ``SAMPLE_BYTES`` together; both bounds are parameters, and a text is left out only if it does
not fit what is left.  Every document is scored over its whole text.  Sentences end at ``.``, ``!``, ``?`` and line breaks.  Null and empty texts score the
probability of a bag without sentences, 0.  Labels other than 0 and 1, null labels and null
texts are not learnt from.  A document with contradicting labels is learnt from as toxic if any
says so.  Without a positive label every score is 0.  Ties, repeated rows and extra columns
change nothing.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, local_table, slices, table, tidy

SAMPLE = 8_000
#: Bytes of their texts, together.
SAMPLE_BYTES = 20 << 20
#: Share of the sentences of clean documents that may lie above the floor.
TAIL = 1e-4
FEATURES = 4_096
#: Least association with the label, in standard errors, of a feature that is used.
ASSOCIATION = 4.0
#: Numbers of leading characters that make a word's stems.
STEMS = (4, 5, 6)
_SENTENCE = re.compile(rb"[.!?\n]+")
_EDGE = b".,;:!?()[]{}\"'|*#%$&<>-_/"


def _bare(word: bytes) -> bytes:
    return word.strip(_EDGE)


def _names(word: bytes) -> list[str]:
    """Features of a word: itself and its stems."""
    bare = _bare(word).decode(errors="replace")
    return [f"w{bare}"] * bool(bare) + [f"{n}{bare[:n]}" for n in STEMS if n < len(bare)]


class _Weights(dict):
    """Word to its summed weight; filled on first use and emptied when it grows too large."""

    LIMIT = 200_000

    def __init__(self, known: dict[str, float]) -> None:
        super().__init__()
        self.known = known

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = sum(self.known.get(n, 0.0) for n in _names(word))
        return value


class Model:
    """Weights of features, the bias of a sentence, and the logit from which sentences count each for itself."""

    def __init__(self, weights: dict[str, float], bias: float, floor: float = 0.0) -> None:
        self.weights, self.bias, self.floor = weights, bias, floor

    def score(self, logits: np.ndarray) -> float:
        """A document's score from the logits of all its sentences."""
        high = logits >= self.floor
        return noisy_or(np.append(logits[high], logits[~high].max())) if (~high).any() else noisy_or(logits)

    def sentence_logits(self, sentences: list[bytes], cache: _Weights | None = None) -> np.ndarray:
        cache = _Weights(self.weights) if cache is None else cache
        return np.array([self.bias + sum(map(cache.__getitem__, s.lower().split())) for s in sentences])


def sentences(text: bytes | None) -> list[bytes]:
    return [s for s in _SENTENCE.split(text or b"") if s.strip()]


def noisy_or(logits: np.ndarray) -> float:
    """1 - prod(1 - sigmoid(logit)), computed by logarithms."""
    return float(-np.expm1(-np.logaddexp(0, logits).sum())) if len(logits) else 0.0


def train(texts: list[bytes], labels: list[int], features: int = FEATURES, steps: int = 300, rate: float = 0.05, decay: float = 1e-4) -> Model:
    """Fit by gradient ascent (Adam) on the bags' log likelihood; deterministic."""
    if not any(labels):
        return Model({}, -40.0)
    # One number for each word; features are expanded from the distinct words, in text order.
    number: dict[bytes, int] = {}
    words, ends, owner = array("i"), array("q"), array("i")
    for d, text in enumerate(texts):
        for s in sentences(text):
            words.extend(number.setdefault(w, len(number)) for w in s.lower().split())
            ends.append(len(words))
            owner.append(d)
    words, ends, owner = np.array(words, np.int32), np.array(ends, np.int64), np.array(owner, np.int64)
    feature: dict[str, int] = {}
    made = [[feature.setdefault(n, len(feature)) for n in _names(w)] for w in number]
    lengths = np.diff(ends, prepend=0)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    count = np.zeros((2, len(feature)), np.int64)
    starts = np.concatenate([[0], ends])
    for d, label in enumerate(labels):
        own = {i for w in np.unique(words[starts[bounds[d]] : starts[bounds[d + 1]]]).tolist() for i in made[w]}
        count[1 if label else 0, list(own)] += 1
    n_pos, n_neg = max(1, sum(labels)), max(1, len(labels) - sum(labels))
    a, b = count[1] / n_pos, count[0] / n_neg
    strength = np.abs(a - b) / np.sqrt((a + b) / 2 * np.maximum(1e-9, 1 - (a + b) / 2) * (1 / n_pos + 1 / n_neg) + 1e-12)
    used = [(-strength[i], n, i) for n, i in feature.items() if count[:, i].sum() >= 3 and strength[i] >= ASSOCIATION]
    used = sorted(used)[:features]
    chosen = [n for _, n, _ in used]
    index = {i: at for at, (_, _, i) in enumerate(used)}
    mine = [[index[i] for i in ids if i in index] for ids in made]
    size = np.array([len(x) for x in mine], np.int64)
    flat, at = np.array([i for x in mine for i in x], np.int32), np.concatenate([[0], np.cumsum(size)])[:-1]
    del made, mine, feature
    sentence = np.repeat(np.arange(len(owner), dtype=np.int32), lengths)
    sentence, words = sentence[size[words] > 0], words[size[words] > 0]
    times = size[words]
    row = np.repeat(sentence, times)
    col = flat[np.repeat(at[words] - np.concatenate([[0], np.cumsum(times)[:-1]]) if len(words) else at[words], times) + np.arange(len(row))]
    y = np.array(labels, float)
    m, d = len(owner), len(texts)
    w = np.zeros(len(chosen) + 1)
    w[-1] = -6.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        logit = w[-1] + np.bincount(row, w[col], m)
        soft = np.logaddexp(0, logit)  # -log(1 - p)
        total = np.bincount(owner, soft, d)
        # d/dS of log(1 - exp(-S)) is 1/(exp(S) - 1); of -S it is -1.
        outer = np.where(y > 0, 1 / np.expm1(np.clip(total, 1e-9, 500)), -1.0) / d
        by = outer[owner] / (1 + np.exp(-logit)) if m else np.zeros(0)
        grad = np.concatenate([np.bincount(col, by[row], len(chosen)) - decay * w[:-1], [by.sum()]])
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        w += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = {n: float(v) for n, v in zip(chosen, w[:-1], strict=True) if abs(v) > 1e-3}
    clean = (w[-1] + np.bincount(row, w[col], m))[y[owner] == 0] if m else np.zeros(0)
    # Logits of the probabilities 0.05 and 0.5.
    floor = float(np.clip(np.quantile(clean, 1 - TAIL), np.log(0.05 / 0.95), 0.0)) if len(clean) else 0.0
    return Model(weights, float(w[-1]), floor)


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Train on a bounded sample of the labelled rows that are not held out."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id", F.lit("sample")).alias("o")
    # The sample has at most `sample` rows, which bounds what is broadcast and collected.
    chosen = known.select("doc_id", "toxic", order).orderBy("o", "doc_id").limit(sample)
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    sized = found.select("doc_id", "o", F.xxhash64("text").alias("h"), F.octet_length("text").alias("size")).orderBy("o", "doc_id", "h").limit(sample)
    left, fits = sample_bytes, {}
    for r in sized.collect():
        if r["size"] <= left and r["h"] not in fits:
            left -= r["size"]
            fits[r["h"]] = r["doc_id"]
    if not fits:
        return train([], [])
    wanted = local_table(docs.sparkSession, list(fits.items()), "h long, doc_id long")
    rows = found.withColumn("h", F.xxhash64("text")).join(F.broadcast(wanted), ["doc_id", "h"]).dropDuplicates(["h"]).orderBy("h").select("text", "toxic").toArrow()
    return train(as_bytes(rows.column(0)), [int(x) for x in rows.column(1).to_pylist()])


_SCORED = "doc_id long, score double, n_offending long, worst_sentence string"


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``(doc_id, score, n_offending, worst_sentence)`` of every row, over the whole text.

    ``n_offending`` counts the sentences of a probability of 0.5 or more; ``worst_sentence`` is the first
    of the greatest probability, null where there is no offending one.
    """
    known, bias, floor = model.weights, model.bias, model.floor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = Model(known, bias, floor), _Weights(known)
        for batch in slices(batches, 1024):
            out = []
            for key, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                parts = sentences(text)
                logits = own.sentence_logits(parts, cache)
                many = int((logits >= 0).sum())
                out.append((key, own.score(logits), many, parts[int(np.argmax(logits))].strip().decode(errors="replace") if many else None))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.float64(), pa.int64(), pa.string()), strict=True)], names=[c.split()[0] for c in _SCORED.split(", ")])

    return docs.select(F.col(key).cast("long").alias("key"), F.col("text").cast("string").alias("text")).mapInArrow(lambda b: tidy(run(b)), _SCORED)


def locate(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``(doc_id, sentence, at, score)`` of the sentences that score at least ``least``."""
    known, bias = model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = Model(known, bias), _Weights(known)
        for batch in slices(batches):
            out = []
            for key, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                parts = sentences(text)
                p = 1 / (1 + np.exp(-own.sentence_logits(parts, cache)))
                out += [(key, parts[i].strip().decode(errors="replace"), int(i), float(p[i])) for i in np.flatnonzero(p >= least)]
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.float64()), strict=True)], names=["doc_id", "sentence", "at", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lambda b: tidy(run(b)), "doc_id long, sentence string, at long, score double")


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, all columns kept."""
    model = fit(docs, labels)
    known, bias, floor = model.weights, model.bias, model.floor
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = Model(known, bias, floor), _Weights(known)
        for batch in slices(batches, 1024):
            yield batch.filter(pa.array([own.score(own.sentence_logits(sentences(t), cache)) < 0.5 for t in as_bytes(batch.column(place))], pa.bool_()))

    return docs.mapInArrow(lambda b: tidy(run(b)), docs.schema)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, learnt from labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_offending", "worst_sentence")
