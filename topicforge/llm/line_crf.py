"""Operator 9: quality rules with line sequence labelling.

Counts of a document's words, symbols, repeated lines and repeated word windows give the base verdict.
Beside them a linear-chain conditional random field marks every line with a word as content or
boilerplate: features of the line vote, transitions tie neighbours together, and the Viterbi algorithm finds
the likeliest marking.  A document is kept if it passes the base rules and enough of its words stand in
content lines.

The field is trained here by stochastic gradient descent on the log-likelihood (forward-backward), on the
lines of a bounded sample of documents with a quality label: the lines of low-quality documents are taken as
boilerplate, those of the others as content.  What single lines are follows from what they share.

Defined results: a null or empty text has no words and fails the base rules; without training rows no
line is boilerplate; repeated rows each get a row; texts of any length are read whole; columns other than id
and text are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.llm.batches import id_text, map_batches, per_task, record, texts_of
from topicforge.llm.labelled import training_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = re.compile(r"[#*$%&|<>]")
MIN_WORDS = 50
#: A document fails if more than this share of its words stands in repeated windows of three words.
REPEAT_PERCENT = 50
CONTENT_SHARE = 0.5
TRAINING_DOCS = 2000
CONTENT, BOILERPLATE = 0, 1

_STEPS = {
    "words": (1, 2, 4, 8, 16, 32, 64), "symbols": (0.001, 0.02, 0.1, 0.3), "upper": (0.1, 0.3, 0.6, 0.9),
    "digits": (0.02, 0.1, 0.3), "repeats": (0.1, 0.25, 0.5, 0.75), "marks": (0.02, 0.1, 0.3), "length": (2, 4, 6, 9, 14),
}
_FIRST: dict[str, int] = {}
N_FEATURES = 1
for _name, _cuts in _STEPS.items():
    _FIRST[_name] = N_FEATURES
    N_FEATURES += len(_cuts) + 1
DUPLICATE, OPEN_END, FIRST_LINE, LAST_LINE = range(N_FEATURES, N_FEATURES + 4)
N_FEATURES += 4
_PUNCTUATION = re.compile(r"[!?.,;:=/\\@_~^{}\[\]()-]")
_DIGIT, _UPPER = re.compile(r"\d"), re.compile(r"[^\W\d_a-zß-öø-ÿ]")


def _bin(name: str, value: float) -> int:
    cuts, k = _STEPS[name], 0
    while k < len(cuts) and value > cuts[k]:
        k += 1
    return _FIRST[name] + k


def line_features(line: str, words: list[str], duplicate: bool, first: bool, last: bool) -> list[int]:
    """Indices of the features of a line that has words: 0 stands for every line, then one step for each
    measure, then the yes-or-no features that hold."""
    n, chars = len(words), sum(map(len, words))
    upper = 0 if line.islower() else len(_UPPER.findall(line))
    out = [0, _bin("words", n), _bin("symbols", len(SYMBOLS.findall(line)) / chars), _bin("upper", upper / chars),
           _bin("digits", len(_DIGIT.findall(line)) / chars), _bin("repeats", 1 - len(set(words)) / n if n > 3 else 0.0),
           _bin("marks", len(_PUNCTUATION.findall(line)) / chars), _bin("length", chars / n)]
    if duplicate:
        out.append(DUPLICATE)
    if words[-1][-1] not in ".!?\"')…":
        out.append(OPEN_END)
    if first:
        out.append(FIRST_LINE)
    if last:
        out.append(LAST_LINE)
    return out


class Document:
    """The counts of a text and the features of its lines."""

    def __init__(self, text: str):
        lines = text.split("\n")
        seen: set[str] = set()
        self.dup_lines, self.line_words, found = 0, [], []
        every: list[str] = []
        for line in lines:
            words = WORD.findall(line)
            if words:
                again = line in seen
                self.dup_lines += again
                seen.add(line)
                found.append((line, words, again))
                self.line_words.append(len(words))
                every += words
        self.features = [line_features(*f, k == 0, k == len(found) - 1) for k, f in enumerate(found)]
        self.n_words, self.word_chars = len(every), sum(map(len, every))
        self.n_symbols = len(SYMBOLS.findall(text))
        self.n_repeat_words = self._repeated(every)

    @staticmethod
    def _repeated(words: list[str]) -> int:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        at: dict[tuple, int] = {}
        hit = np.zeros(len(words), dtype=bool)
        for i, w in enumerate(windows):
            j = at.setdefault(w, i)
            if j != i:
                hit[i:i + 3] = True
                hit[j:j + 3] = True
        return int(hit.sum())

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > REPEAT_PERCENT * self.n_words


class Field:
    """A linear-chain conditional random field with two labels: ``emit`` (label x feature), ``move``
    (label before x label) and ``first`` (label of the first line)."""

    def __init__(self):
        self.emit, self.move, self.first = np.zeros((2, N_FEATURES)), np.zeros((2, 2)), np.zeros(2)

    def _scores(self, features: list[list[int]]) -> np.ndarray:
        return np.array([self.emit[:, f].sum(axis=1) for f in features])

    def learn(self, features: list[list[int]], labels: list[int], rate: float, penalty: float) -> None:
        """One step up the gradient of the log-likelihood: observed minus expected counts."""
        s, n = self._scores(features), len(features)
        ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = self.first + s[0]
        for t in range(1, n):
            ahead[t] = s[t] + np.logaddexp(ahead[t - 1, 0] + self.move[0], ahead[t - 1, 1] + self.move[1])
        for t in range(n - 2, -1, -1):
            later = self.move + s[t + 1] + back[t + 1]
            back[t] = np.logaddexp(later[:, 0], later[:, 1])
        total = np.logaddexp(*ahead[-1])
        at = np.exp(ahead + back - total)
        rate /= n
        for t, f in enumerate(features):
            up = -at[t] * rate
            up[labels[t]] += rate
            self.emit[:, f] += up[:, None]
        for t in range(1, n):
            self.move -= rate * np.exp(ahead[t - 1][:, None] + self.move + (s[t] + back[t])[None] - total)
            self.move[labels[t - 1], labels[t]] += rate
        self.first -= rate * at[0]
        self.first[labels[0]] += rate
        self.emit *= 1 - rate * penalty
        self.move *= 1 - rate * penalty

    def decoder(self):
        """A Viterbi decoder over plain numbers: features of the lines -> labels."""
        gap = (self.emit[1] - self.emit[0]).tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        f0, f1 = self.first.tolist()

        def decode(features: list[list[int]]) -> list[int]:
            if not features:
                return []
            a, b, came = f0, f1 + sum(gap[k] for k in features[0]), []
            for f in features[1:]:
                to0 = (a + m00, 0) if a + m00 >= b + m10 else (b + m10, 1)
                to1 = (a + m01, 0) if a + m01 >= b + m11 else (b + m11, 1)
                came.append((to0[1], to1[1]))
                a, b = to0[0], to1[0] + sum(gap[k] for k in f)
            out = [CONTENT if a >= b else BOILERPLATE]
            for step in reversed(came):
                out.append(step[out[-1]])
            return out[::-1]

        return decode


def train(sequences: list[tuple[list[list[int]], int]], epochs: int = 6, rate: float = 0.5, seed: int = 3) -> Field:
    field, rng = Field(), np.random.default_rng(seed)
    for e in range(epochs):
        for k in rng.permutation(len(sequences)):
            features, label = sequences[k]
            field.learn(features, [label] * len(features), rate / (1 + e), 0.001)
    return field


def fit_lines(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = TRAINING_DOCS,
              id_col: str = "doc_id", text_col: str = "text") -> Field:
    """Line features are made on the executors; those of at most ``most`` documents come to the driver."""

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [Document(t).features for t in texts_of(b)]
        return record(doc_id=b.column(0), label=b.column(2), lines=pa.array(found, pa.list_(pa.list_(pa.int32()))))

    rows = map_batches(training_rows(docs, labels, label, most, id_col, text_col, by_class=True).select("doc_id", "text", "label"),
                       each, "doc_id bigint, label int, lines array<array<int>>").collect()
    data = sorted((r[0], [list(f) for f in r[2]], CONTENT if r[1] else BOILERPLATE) for r in rows)
    return train([(lines, mark) for _, lines, mark in data if lines])


def mark_lines(docs: DataFrame, field: Field, content_share: float = CONTENT_SHARE, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The counts, base_failed, kept, content_share and the marks of the lines with words ('c' or 'b' each)
    of every row.  Map-only."""

    @per_task
    def start():
        decode = field.decoder()

        def each(b: pa.RecordBatch) -> pa.RecordBatch:
            d = [Document(t) for t in texts_of(b)]
            marks = [decode(x.features) for x in d]
            share = [sum(n for n, m in zip(x.line_words, ms) if m == CONTENT) / max(x.n_words, 1) for x, ms in zip(d, marks)]
            long = lambda name: pa.array([getattr(x, name) for x in d], pa.int64())
            return record(doc_id=b.column(0), n_words=long("n_words"), word_chars=long("word_chars"), n_symbols=long("n_symbols"),
                          n_dup_lines=long("dup_lines"), n_repeat_words=long("n_repeat_words"),
                          base_failed=pa.array([x.base_failed for x in d], pa.bool_()),
                          kept=pa.array([not x.base_failed and s >= content_share for x, s in zip(d, share)], pa.bool_()),
                          content_share=pa.array(share, pa.float64()), marks=pa.array(["".join("cb"[m] for m in ms) for ms in marks], pa.string()))

        return each

    return map_batches(id_text(docs, id_col, text_col), start,
                       "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
                       "n_repeat_words bigint, base_failed boolean, kept boolean, content_share double, marks string")
