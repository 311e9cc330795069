"""Operator 3: toxicity by noisy-channel deobfuscation.

A writer who hides a word passes it through a channel: letters become look-alike signs (leetspeak),
letters are spaced out or separated by signs, letters are repeated.  Each suspicious stretch of text is
turned into a lattice whose arcs undo these with a cost, and the Viterbi algorithm finds the path with the
least channel cost plus cost under a character trigram language model.  The model's counts are gathered
from every document.  The restored words are then scored by a logistic model over words, word beginnings
and word ends that mark toxic documents, learned from a bounded sample of labelled documents.

Defined results: an empty or null text has no features and gets the score of the bias alone; without
training rows every score is 0; repeated rows each get a row; columns other than id and text are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.llm.batches import held_out, id_text, map_arrow, map_batches, per_task, record, texts_of
from topicforge.llm.labelled import training_rows
from topicforge.llm.pretokens import Memo

# Symbols of the language model: 0 is a word border, 1-26 the letters a-z, 27 any other letter.
SYMBOLS = 28
OTHER = 27

# What a look-alike sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = ".-_*·~/\\ "
# Channel costs in nats.
SIGN_COST, SIGN_KEPT, SEPARATOR_COST, SEPARATOR_KEPT, REPEAT_COST = 1.0, 9.0, 0.5, 6.0, 0.3

TRAINING_DOCS = 6000
MOST_FEATURES = 20_000


def _symbol_table() -> np.ndarray:
    codes = np.zeros(0x110000, dtype=np.uint8)
    for c in chain(range(0x41, 0x250), range(0x370, 0x590), range(0x5D0, 0x700), range(0x900, 0x1900), range(0x3040, 0xA000), range(0xAC00, 0xD7A4)):
        if chr(c).isalpha():
            codes[c] = OTHER
    for k in range(26):
        codes[ord("a") + k] = codes[ord("A") + k] = k + 1
    return codes


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    return _symbol_table()


def trigram_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(code, n): how often each triple of symbols follows each other in all texts; a border stands before
    and after each word.  A task sends at most one row for each triple."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 3, dtype=np.int64)
        codes = symbol_table()
        for b in batches:
            for t in texts_of(b):
                s = codes[np.frombuffer(f"  {t}  ".encode("utf-32-le", "replace"), dtype="<u4")].astype(np.int32)
                # a second border between words, so that a word's first letter is predicted from borders alone
                s = np.repeat(s, np.where(s == 0, 2, 1))
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=len(total))
        hit = np.flatnonzero(total)
        yield record(code=pa.array(hit, pa.int64()), n=pa.array(total[hit], pa.int64()))

    return map_arrow(id_text(docs, id_col, text_col).select("text"), run, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame) -> np.ndarray:
    """Cost (negative log probability) of a symbol after two others, as a cube; the counts are at most
    SYMBOLS ** 3 rows.  Trigrams are interpolated with bigrams and single symbols."""
    n = np.zeros(SYMBOLS ** 3)
    for code, c in counts.collect():
        n[code] = c
    cube = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    pair, one = cube.sum(axis=0), cube.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (pair + 10 * p1) / (pair.sum(axis=1, keepdims=True) + 10)
    p3 = (cube + 10 * p2[None]) / (cube.sum(axis=2, keepdims=True) + 10)
    return -np.log(p3)


class Restorer:
    """Viterbi decoding of character lattices."""

    def __init__(self, cost: np.ndarray):
        self.cost = cost.tolist()
        self.codes = symbol_table()

    def _arcs(self, stretch: str) -> Iterator[list[tuple[str, float, int]]]:
        """For each position, what may have been meant: (letters, channel cost, next position)."""
        n, run = len(stretch), 0
        for i, c in enumerate(stretch):
            here: list[tuple[str, float, int]] = []
            run = max(run, i + 1)
            while run < n and stretch[run] == c:
                run += 1
            signs = LOOKALIKES.get(c)
            if c.isalpha():
                here.append((c, 0.0, i + 1))
                if run - i >= 2:
                    here.append((c, REPEAT_COST * (run - i - 1), run))
            else:
                here.append((c, SIGN_KEPT if signs else SEPARATOR_KEPT, i + 1))
                for letter in signs or ():
                    here.append((letter, SIGN_COST, i + 1))
                    if run - i >= 2:
                        here.append((letter, SIGN_COST + REPEAT_COST * (run - i - 1), run))
                if c in SEPARATORS:
                    here.append(("", SEPARATOR_COST, i + 1))
            yield here

    def restore(self, stretch: str) -> str:
        """The likeliest letters behind a stretch of text, however long: time grows with its length, and
        positions that are passed are given up."""
        text = stretch.lower()
        n, cost, codes = len(text), self.cost, self.codes
        # best[i]: (last two symbols) -> (cost, text so far, as a linked list)
        best: defaultdict[int, dict[tuple[int, int], tuple[float, tuple | None]]] = defaultdict(dict)
        best[0][0, 0] = (0.0, None)
        for i, arcs in enumerate(self._arcs(text)):
            for (a, b), (so_far, path) in best.pop(i, {}).items():
                for letters, price, to in arcs:
                    total, x, y, p = so_far + price, a, b, path
                    if letters:
                        z = int(codes[ord(letters)])
                        if z == 0 and y == 0:
                            total += 0.5  # a second sign in a row
                        else:
                            total += cost[x][y][z]
                        x, y, p = (y, z, (p, letters)) if z else (0, 0, (p, letters))
                    old = best[to].get((x, y))
                    if old is None or total < old[0]:
                        best[to][x, y] = (total, p)
        _, path = min(((c + cost[a][b][0], p) for (a, b), (c, p) in best[n].items()), key=lambda v: v[0], default=(0.0, None))
        out = []
        while path is not None:
            path, letter = path
            out.append(letter)
        return "".join(reversed(out))


SPACED = re.compile(r"(?<!\S)\S(?:\s++\S){2,}(?!\S)")
EVENLY = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")
SPACE = re.compile(r"\s+")
WORD = re.compile(r"[^\W\d_]+")
PLAIN = re.compile(r"\W*[^\W\d_]+\W*\Z")
THREE = re.compile(r"(.)\1\1")
SIGNED = re.compile(r"[^\W_].*[\W\d_].*[^\W_]|[$@!|+(<€£¡\d][^\W\d_]|[^\W\d_][$@!|+\d]")


def suspicious(token: str) -> bool:
    """A token with a look-alike sign or a separator among letters, or a letter three times in a row, or
    without letters but with two look-alike signs."""
    if not any(c.isalpha() for c in token):
        return sum(c in LOOKALIKES for c in token) >= 2
    return bool(THREE.search(token)) or bool(SIGNED.search(token.strip(".,;:?\"')]}")))


def words_of(token: str, restorer: Restorer) -> list[str]:
    """The lower-case words of one token, as written and, if it is suspicious, as restored, as a whole."""
    out = WORD.findall(token.lower())
    if suspicious(token):
        out += WORD.findall(restorer.restore(token))
    return out


def stretches(text: str) -> Iterator[str]:
    """Runs of single characters with white space between, as in 's p a c e d', each gap as one space; of
    a run with other gaps than single spaces also its parts that have those alone."""
    for m in SPACED.finditer(text):
        run = m.group()
        even = SPACE.sub(" ", run)
        yield even
        if even != run:
            for part in EVENLY.finditer(run):
                yield part.group()


def word_marks(word: str) -> list[str]:
    """The features of a word: itself, its beginnings and its end."""
    out = [f"={word}"] + [f"^{word[:k]}" for k in (4, 5, 6) if len(word) >= k]
    return out + ([f"${word[-5:]}"] if len(word) >= 5 else [])


def restored_marks(text: str, token_marks: Callable[[str], tuple], stretch_marks: Callable[[str], tuple]) -> set:
    found = set(chain.from_iterable(map(token_marks, set(text.split()))))
    if SPACED.search(text):
        found.update(chain.from_iterable(map(stretch_marks, set(stretches(text)))))
    return found


def _readers(cost: np.ndarray, weights: dict[str, object] | None) -> tuple[Memo, Memo]:
    """Token -> its marks (or, of those in ``weights``, what stands there), and the same for stretches."""
    r = Restorer(cost)

    def marks(words: list[str]) -> tuple:
        every = dict.fromkeys(chain.from_iterable(map(word_marks, words)))
        return tuple(every) if weights is None else tuple(weights[m] for m in every if m in weights)

    def spaced(stretch: str) -> tuple:
        return marks(WORD.findall(r.restore(stretch)))

    return Memo(lambda token: marks(words_of(token, r)), most=150_000), Memo(spaced, most=50_000)


def fit_toxicity(docs: DataFrame, labels: DataFrame, cost: np.ndarray, label: str = "toxic",
                 most: int = TRAINING_DOCS, id_col: str = "doc_id", text_col: str = "text") -> tuple[dict[str, float], float]:
    """Weights of marks, and the bias.  Which marks take part is counted over the sample by Spark: those
    clearly more frequent in toxic documents (likelihood ratio), at most ``MOST_FEATURES``."""
    sample = training_rows(docs, labels, label, most, id_col, text_col, by_class=True).select("doc_id", "text", "label")
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(cost)

    @per_task
    def start():
        tokens, spaced = _readers(shared.value, None)

        def each(b: pa.RecordBatch) -> pa.RecordBatch:
            found = [sorted(restored_marks(t, tokens.__getitem__, spaced.__getitem__)) for t in texts_of(b)]
            return record(doc_id=b.column(0), label=b.column(2), marks=pa.array(found, pa.list_(pa.string())))

        return each

    rows = map_batches(sample, start, "doc_id bigint, label int, marks array<string>").persist()
    try:
        sizes = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
        n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
        if not n1 or not n0:
            return {}, -500.0 if not n1 else 500.0
        by = rows.select("label", F.explode("marks").alias("mark")).groupBy("mark").agg(
            F.sum(F.col("label").cast("bigint")).alias("a"), F.sum((1 - F.col("label")).cast("bigint")).alias("b"))
        a, b = F.col("a"), F.col("b")
        both = (a + b) / (n1 + n0)
        gain = 2 * (a * F.log(a / (n1 * both)) + F.when(b > 0, b * F.log(b / (n0 * both))).otherwise(0.0))
        chosen = (by.where((a >= 3) & (a / n1 >= 4 * b / n0)).withColumn("gain", gain).where("gain >= 9")
                  .orderBy(F.desc("gain"), "mark").limit(MOST_FEATURES))
        names = sorted(r[0] for r in chosen.select("mark").collect())
        known = spark.sparkContext.broadcast(frozenset(names))

        def keep(b: pa.RecordBatch) -> pa.RecordBatch:
            kept = [[m for m in found if m in known.value] for found in b.column(1).to_pylist()]
            return record(label=b.column(0), marks=pa.array(kept, pa.list_(pa.string())))

        data = map_batches(rows.select("label", "marks"), keep, "label int, marks array<string>").collect()
    finally:
        rows.unpersist()
    return logistic(sorted((int(r[0]), tuple(r[1])) for r in data), names)


def logistic(rows: list[tuple[int, tuple[str, ...]]], names: list[str], penalty: float = 1e-4, steps: int = 2000,
             rate: float = 0.2, cut: float = 0.7) -> tuple[dict[str, float], float]:
    """Logistic regression on the presence of marks, both classes weighing the same, weights not below
    zero; gradient descent with a step of its own for each weight (root of its summed squared gradients).
    The bias is then set so that the sample is parted best at the score ``cut``."""
    at = {m: k for k, m in enumerate(names)}
    doc = np.array([i for i, (_, ms) in enumerate(rows) for _ in ms], dtype=np.int64)
    col = np.array([at[m] for _, ms in rows for m in ms], dtype=np.int64)
    y = np.array([r[0] for r in rows], dtype=float)
    share = np.where(y == 1, 0.5 / max(y.sum(), 1), 0.5 / max(len(y) - y.sum(), 1))
    w, bias, past, past_b = np.zeros(len(names)), -1.0, np.full(len(names), 1e-12), 1e-12
    for _ in range(steps):
        z = np.bincount(doc, weights=w[col], minlength=len(rows)) + bias
        e = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * share
        g = np.bincount(col, weights=e[doc], minlength=len(names)) + penalty * w / max(len(names), 1)
        past, past_b = past + g * g, past_b + e.sum() ** 2
        w = np.maximum(w - rate * g / np.sqrt(past), 0)
        bias -= rate * e.sum() / math.sqrt(past_b)
    z = np.bincount(doc, weights=w[col], minlength=len(rows)) + bias
    return {m: float(w[k]) for m, k in at.items() if w[k] > 0}, float(bias + math.log(cut / (1 - cut)) - _boundary(z, y, share))


def _boundary(z: np.ndarray, y: np.ndarray, share: np.ndarray) -> float:
    """The value that parts the classes best: the middle of the widest gap among those with the least
    weighted error."""
    order = np.argsort(z, kind="stable")
    z, y, share = z[order], y[order], share[order]
    wrong = np.cumsum(np.where(y == 1, share, -share))[:-1]  # toxic below the gap and clean above it, but for a constant
    gap = np.diff(z)
    best = wrong <= wrong[gap > 0].min(initial=np.inf) + 1e-12
    k = int(np.argmax(np.where(best, gap, -1.0)))
    return float((z[k] + z[k + 1]) / 2)


def score_toxicity(docs: DataFrame, cost: np.ndarray, model: tuple[dict[str, float], float], threshold: float = 0.7,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from its whole text.  Map-only; the language model
    and the weights (at most ``MOST_FEATURES``) are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast((cost, model))

    @per_task
    def start():
        cube, (weights, bias) = shared.value
        names = list(weights)
        tokens, spaced = _readers(cube, {m: k for k, m in enumerate(names)})
        value = [weights[m] for m in names]

        def score(text: str) -> float:
            z = bias + math.fsum(value[k] for k in restored_marks(text, tokens.__getitem__, spaced.__getitem__))
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))

        return lambda b: record(doc_id=b.column(0), score=pa.array([score(t) for t in texts_of(b)], pa.float64()))

    scored = map_batches(id_text(docs, id_col, text_col), start, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    cost = language_model(trigram_counts(docs))
    return score_toxicity(docs, cost, fit_toxicity(docs, labels, cost), threshold)
