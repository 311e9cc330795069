"""Operator 7: a quality classifier of averaged subword embeddings.

Every word and word pair and every character n-gram of a word is hashed to a bucket that has a learned
vector; a document is the average of its features' vectors, and a softmax layer gives the class.  Vectors
and layer are trained together by stochastic gradient descent in numpy, on a bounded sample of labelled
documents (``most``).  The layer is linear, so for scoring each bucket's vector is reduced to its share of
the logit: the average is then taken over numbers, with the same result.

Defined results: an empty or null text has no features and gets the score of the bias alone; without
training rows every score is 0.5; repeated rows each get a row; other columns are never read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.llm.batches import held_out, id_text, map_batches, per_task, record, texts_of
from topicforge.llm.labelled import training_rows

BUCKETS = 1 << 17
GRAMS = (3, 4)
REPEAT = 0  # the bucket of a word pair whose words are the same
TRAINING_DOCS = 2000


#: Checksums go on from the mark of their kind.
_WORD, _GRAM = zlib.crc32(b"w"), zlib.crc32(b"g")


def word_features(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams, with marks at both ends."""
    crc, most, raw = zlib.crc32, BUCKETS - 1, word.encode()
    if word.isascii():  # characters are bytes
        marked = b"<%b>" % raw
        grams = [marked[i:i + n] for n in GRAMS for i in range(len(marked) - n + 1)]
    else:
        text = f"<{word}>"
        grams = [text[i:i + n].encode() for n in GRAMS for i in range(len(text) - n + 1)]
    return [crc(raw, _WORD) % most + 1] + [crc(g, _GRAM) % most + 1 for g in grams]


class WordTable:
    """What is known of each word met so far, in arrays; forgets all beyond ``most`` words."""

    def __init__(self, share: np.ndarray | None = None, most: int = 200_000):
        self.share, self.most = share, most
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.features: list[np.ndarray] = []
        self.sums, self.counts = np.zeros(1024), np.zeros(1024, dtype=np.int64)
        self.codes = np.zeros(1024, dtype=np.uint64)

    def _add(self, word: str) -> int:
        k, f = len(self.at), np.array(word_features(word))
        if k == len(self.sums):
            self.sums, self.counts, self.codes = (np.concatenate([a, np.zeros_like(a)]) for a in (self.sums, self.counts, self.codes))
        if self.share is None:
            self.features.append(f)
        else:
            self.sums[k] = self.share[f].sum()
        self.counts[k], self.codes[k] = len(f), zlib.crc32(word.encode())
        self.at[word] = k
        return k

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self.at) + len(words) > self.most:
            self._clear()
        for w in set(words).difference(self.at):
            self._add(w)
        return np.fromiter(map(self.at.__getitem__, words), dtype=np.int64, count=len(words))

    def pairs(self, rows: np.ndarray) -> np.ndarray:
        """Buckets of neighbouring words."""
        a, b = self.codes[rows[:-1]], self.codes[rows[1:]]
        mixed = (a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(29)
        return np.where(a == b, REPEAT, (mixed % np.uint64(BUCKETS - 1) + np.uint64(1)).astype(np.int64))


def document_features(table: WordTable, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a document and how often each occurs."""
    words = text.split()
    rows = table.rows(words)
    if not len(rows):
        return np.zeros(0, dtype=np.int64), np.zeros(0)
    every = np.concatenate([table.pairs(rows), *(table.features[r] for r in rows)])
    ids, n = np.unique(every, return_counts=True)
    return ids, n.astype(np.float64)


def train(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int = 12, epochs: int = 20,
          rate: float = 0.5, seed: int = 7) -> tuple[np.ndarray, float]:
    """Stochastic gradient descent on the cross-entropy of the softmax.  Returns each bucket's share of
    the logit of class 1, and the bias."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / size, 1 / size, (BUCKETS, size))
    layer, bias = np.zeros((2, size)), np.zeros(2)
    steps, done = max(1, epochs * len(docs)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(docs)):
            now, done = rate * (1 - done / steps), done + 1
            ids, n = docs[k]
            part = n / max(n.sum(), 1)
            x = part @ vectors[ids]
            z = layer @ x + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = p @ layer
            layer -= now * np.outer(p, x)
            bias -= now * 0.1 * p
            # A feature moves with the square root of its share, else vectors of long documents hardly learn.
            vectors[ids] -= now * np.sqrt(part)[:, None] * back
    return (vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0])


def fit_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAINING_DOCS,
                id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    """Features are made on the executors; at most ``most`` documents' features come to the driver."""

    @per_task
    def start():
        words = WordTable(most=100_000)

        def each(b: pa.RecordBatch) -> pa.RecordBatch:
            f = [document_features(words, t) for t in texts_of(b)]
            return record(doc_id=b.column(0), label=b.column(2), ids=pa.array([x.astype("<i4").tobytes() for x, _ in f], pa.binary()),
                          n=pa.array([n.astype("<f4").tobytes() for _, n in f], pa.binary()))

        return each

    rows = map_batches(training_rows(docs, labels, label, most, id_col, text_col).select("doc_id", "text", "label"), start,
                       "doc_id bigint, label int, ids binary, n binary").collect()
    rows.sort(key=lambda r: (r[0], bytes(r[2])))
    data = [(np.frombuffer(bytes(r[2]), "<i4"), np.frombuffer(bytes(r[3]), "<f4")) for r in rows]
    marks = np.array([min(max(r[1], 0), 1) for r in rows])
    del rows
    return train(data, marks) if data else (np.zeros(BUCKETS, dtype=np.float32), 0.0)


def _scorer(model: tuple[np.ndarray, float]):
    share, bias = model
    words = WordTable(share.astype(np.float64))

    def score(text: str) -> float:
        r = words.rows(text.split())
        logit = bias
        if len(r):
            logit += (words.sums[r].sum() + share[words.pairs(r)].sum()) / (words.counts[r].sum() + len(r) - 1)
        return float(1 / (1 + np.exp(-np.clip(logit, -500, 500))))

    return score


def keep_quality(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, whose whole text scores ``threshold`` or more.  Map-only."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    @per_task
    def start():
        score = _scorer(shared.value)
        return lambda b: b.filter(pa.array([score(t or "") >= threshold for t in b.column(at).to_pylist()], pa.bool_()))

    return map_batches(docs, start, docs.schema)


def score_quality(docs: DataFrame, model: tuple[np.ndarray, float], threshold: float = 0.5,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from its whole text.  Map-only; the model (one
    number for each bucket) is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @per_task
    def start():
        score = _scorer(shared.value)
        return lambda b: record(doc_id=b.column(0), score=pa.array([score(t) for t in texts_of(b)], pa.float64()))

    scored = map_batches(id_text(docs, id_col, text_col), start, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
