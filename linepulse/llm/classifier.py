"""Quality classifier: logistic regression on hashed word n-grams, trained by FTRL-proximal.

Features are hashed unigrams and bigrams of the words and marks of a text, and n-grams of their
shapes (case, digit, mark, and whether a word repeats the one before). A document is the unit
vector of their counts, and its score the logistic function of a sparse dot product.

The model is fitted to at most about `most_rows` labelled documents, chosen by a hash of doc_id, whose whole
texts are learnt from in several rounds; of those whose vectors are beyond `most_bytes` together, the later
ones are learnt from in the first round only. That is the only sample. All documents are scored, over
their whole texts; a vector has no more places than the model. Equal scores are equal vectors. An empty table
gives no rows. Other columns, whatever their names, are ignored.

Null and empty texts have only the constant feature, so their score is that of the constant.
Repeated label rows count once (the least quality). Without labelled rows every score is 0.5.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linepulse.llm.common import map_batches, parts_for, text_or_empty

BITS = 18
#: Shape n-grams lie beyond the hashed words, the constant is last.
SHAPES = 16
SIZE = (1 << BITS) + SHAPES**3 + 1
#: Labelled documents that the model is fitted to, about, and bytes of their vectors that are kept.
MOST_ROWS, MOST_BYTES = 8000, 256_000_000
#: Words a worker remembers.
REMEMBERED = 300_000

_WORD = re.compile(r"\w+|[^\w\s]+")
_known: dict[str, tuple[int, int]] = {}


def _look(word: str) -> tuple[int, int]:
    """Hash and shape of a word."""
    if word[0].isalpha():
        shape = 2 if len(word) > 1 and word.isupper() else 1 if word[0].isupper() else 0
    elif word[0].isalnum() or word[0] == "_":
        shape = 3
    else:
        shape = 5 if word in ".,;:" else 6 if len(word) > 1 else 7
    return zlib.crc32(word.encode()), shape


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's unit vector."""
    global _known
    if len(_known) > REMEMBERED:
        _known = {}
    known, words = _known, _WORD.findall(text)
    for w in words:
        if w not in known:
            known[w] = _look(w)
    looks = np.array([known[w] for w in words], np.uint64).reshape(-1, 2)
    word, shape = looks[:, 0], looks[:, 1]
    mask = np.uint64((1 << BITS) - 1)
    mixed = (word * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)
    pairs = (
        (word[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + word[1:]) * np.uint64(0x9E3779B97F4A7C15)
    ) >> np.uint64(64 - BITS)
    same = np.zeros(len(word), np.uint64)
    same[1:] = word[1:] == word[:-1]
    shape = shape + np.uint64(8) * same
    n = np.uint64(SHAPES)
    triples = np.uint64(1 << BITS) + (shape[:-2] * n + shape[1:-1]) * n + shape[2:]
    places, counts = np.unique(
        np.concatenate([mixed & mask, pairs & mask, triples]).astype(np.int64), return_counts=True
    )
    values = np.sqrt(counts)
    values = values / max(1e-12, np.sqrt(counts.sum()))
    return np.append(places, SIZE - 1), np.append(values, 1.0)


class Ftrl:
    """Follow-the-regularised-leader: one adaptive learning rate for each place."""

    def __init__(self, alpha=0.5, beta=1.0, l1=0.01, l2=0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(SIZE), np.zeros(SIZE)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        rate = (self.beta + np.sqrt(n)) / self.alpha + self.l2
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / rate)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ value, -35, 35))) - label) * value
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, rounds: int = 3, most_bytes: int = MOST_BYTES):
    """Weights of all places. docs: doc_id, text; labels: doc_id, quality (rows to learn from)."""
    labelled = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    part = parts_for(labelled.count(), most_rows)
    chosen = dict(
        labelled.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(part)) == 0)
        .select("doc_id", "quality")
        .collect()
    )

    def vectors(batches):
        for batch in batches:
            out = {k: [] for k in ("key", "quality", "place", "value")}
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                if doc in chosen:
                    place, value = features(text)
                    row = (zlib.crc32(b"%d" % doc), chosen[doc], place, value)
                    for k, v in zip(out, row, strict=True):
                        out[k].append(v)
            yield out

    def learn(batches):
        model, held, kept = Ftrl(), [], 0
        for batch in batches:
            for y, at, x in zip(batch["quality"], batch["place"], batch["value"], strict=True):
                at, x = np.array(at, np.int32), np.frombuffer(x, "<f4")
                model.learn(at, x.astype(float), y)
                kept += at.nbytes + x.nbytes
                if kept <= most_bytes:
                    held.append((y, at, x))
        for _ in range(rounds - 1):
            for y, at, x in held:
                model.learn(at, x.astype(float), y)
        w = model.weights(np.arange(SIZE))
        used = np.flatnonzero(w)
        yield {"place": used, "weight": w[used]}

    def small(batches):
        for out in vectors(batches):
            out["value"] = [v.astype("<f4").tobytes() for v in out["value"]]
            yield out

    rows = map_batches(
        docs, "key bigint, quality int, place array<int>, value binary", small
    ).repartition(1)
    found = map_batches(rows.sortWithinPartitions("key"), "place int, weight double", learn)
    weights = np.zeros(SIZE)
    for place, weight in found.collect():
        weights[place] = weight
    return weights


def score(docs: DataFrame, labels: DataFrame, learn_from, **options) -> DataFrame:
    """doc_id and score of all documents; `learn_from` is the condition on doc_id for training."""
    docs = docs.select(F.col("doc_id").cast("bigint"), text_or_empty().alias("text"))
    weights = train(docs, labels.where(learn_from), **options).astype(np.float32)

    def work(batches):
        for batch in batches:
            out = []
            for text in batch["text"]:
                at, x = features(text)
                out.append(1 / (1 + np.exp(-np.clip(weights[at] @ x, -35, 35))))
            yield {"doc_id": batch["doc_id"], "score": out}

    return map_batches(docs, "doc_id bigint, score double", work)
