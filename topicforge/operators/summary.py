"""Extractive summaries.

The reference summarises with a generative model (output <= 120
tokens).  Here each sentence is scored by the mean TF-IDF weight of its
words, the best sentences are kept while they fit the token budget, and
they are put back in document order.  Lead-n (B6) is the baseline.

Plan: document frequencies are summed where the texts are (an Arrow
helper counts the words of many rows before it gives them out) and then
per word; words of one document are dropped.  A row whose key no other
row has is scored where it is: an Arrow helper weighs its sentences and
picks the best, with the idf of the ``BROADCAST_WORDS`` most frequent
words at hand.  If there are more words than that, a row's other words
are joined by word first and the weights that were found are brought to
the row, a list a key.  Rows whose key repeats are counted over a window
and ranked by a salted two-stage top-k per document bounded by the budget
(a sentence has at least one token, so at most ``max_tokens`` sentences
can be kept).
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from topicforge.constants import MAX_SUMMARY_TOKENS
from topicforge.functions.text import SENT_MARK, WS, WS_CHARS, bind, mark_sentences, marked_sentences, split_sentences
from topicforge.llm.batches import map_batches, record
from topicforge.operators.skew import top_k_per_group
from topicforge.session import reliable_checkpoint

SCORE_DIGITS = 9
#: Words of the idf lookup that every worker holds, the most frequent ones.
BROADCAST_WORDS = 500_000
#: Bytes of text whose words are counted or looked up together.
TEXT_BYTES = 4 << 20
_WS_RUN = re.compile(f"[{re.escape(WS_CHARS)}]+")


class _Corpus(NamedTuple):
    """The rows (_key, _text) apart by whether their key repeats, and the idf lookup: ``known`` (word, _df) has
    the words of two rows or keys at least, those of ``least`` or more are in ``often`` too."""
    once: DataFrame
    more: DataFrame | None
    n_docs: int
    known: DataFrame
    least: int
    often: Broadcast


def _idf(n_docs: int, df: int) -> float:
    return math.log((1.0 + n_docs) / (1.0 + df)) + 1.0


def _lower_texts(rows: DataFrame) -> DataFrame:
    return rows.select("_key", F.lower("_text").alias("text"))


def _encoded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of the words of all texts the index of the text and that of the word, and the different words.  Arrow parts
    texts where ``str.split`` does, at the characters of ``WS``."""
    parted = pc.utf8_split_whitespace(texts)
    words, of = parted.flatten(), pc.list_parent_indices(parted)
    real = pc.greater(pc.binary_length(words), 0)  # what stands before whitespace at an end is empty
    coded = words.filter(real).dictionary_encode()
    return of.filter(real).to_numpy(), coded.indices.to_numpy(), coded.dictionary


def _row_bounds(of: np.ndarray, n: int) -> list[int]:
    return np.searchsorted(of, np.arange(n + 1)).tolist()


def _parts(texts: pa.Array) -> pa.Array:
    """Texts in lower case with sentences parted by a space."""
    return pc.replace_substring(texts, SENT_MARK, " ")


def _counted_words(rows: DataFrame) -> DataFrame:
    """(word, n): in how many rows of (_key, text) a word is, in parts to be summed."""
    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        of, ids, words = _encoded(_parts(b.column(1)))
        bounds, order = _row_bounds(of, b.num_rows), np.arange(len(ids))
        at, last = np.zeros(len(words), np.int64), np.zeros(len(ids), bool)
        for x, y in zip(bounds, bounds[1:]):  # a word is counted where the row has it last
            at[ids[x:y]] = order[x:y]
            last[x:y] = at[ids[x:y]] == order[x:y]
        return record(word=words, n=pa.array(np.bincount(ids[last], minlength=len(words)), pa.int64()))

    return map_batches(rows, each, "word string, n bigint", TEXT_BYTES)


def _row_words(rows: DataFrame, often: Broadcast) -> DataFrame:
    """(_key, word): the different words of each row of (_key, text) that are not in ``often``."""
    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        of, ids, words = _encoded(_parts(b.column(1)))
        rare = np.isnan(_known_idf(words, often))[ids]
        row, word = np.divmod(np.unique(of[rare] * len(words) + ids[rare]), max(len(words), 1))
        return record(_key=b.column(0).take(pa.array(row)), word=words.take(pa.array(word)))

    schema = T.StructType([rows.schema["_key"], T.StructField("word", T.StringType())])
    return map_batches(rows, each, schema, TEXT_BYTES)


def _word_places(sents: DataFrame) -> DataFrame:
    """(_key, word, places): for every row of (_key, sents) and every different word of its sentences, the
    index of the sentence of each of the word's occurrences.  Sentences come in lower case; ``str.split``
    parts them at the characters of ``WS``."""
    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        of_row, found, ends, flat = [], [], [0], []
        for row, sentences in enumerate(b.column(1).to_pylist()):
            at: dict[str, list[int]] = {}
            for k, sentence in enumerate(sentences or ()):
                for w in sentence.split():
                    at.setdefault(w, []).append(k)
            of_row.append(len(at))
            found.extend(at)
            for places in at.values():
                flat += places
                ends.append(len(flat))
        keys = b.column(0).take(pa.array(np.repeat(np.arange(len(of_row)), of_row)))
        return record(_key=keys, word=pa.array(found, pa.string()),
                      places=pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())))

    return map_batches(sents, each, T.StructType([
        sents.schema["_key"], T.StructField("word", T.StringType()), T.StructField("places", T.ArrayType(T.IntegerType()))]))


def _least_broadcast(known: DataFrame) -> int:
    """The smallest document frequency whose words, with all more frequent ones, are ``BROADCAST_WORDS`` at
    most."""
    total, least = 0, 2
    for frequency, n in sorted(((r[0], r[1]) for r in known.groupBy("_df").count().collect()), reverse=True):
        total += n
        if total > BROADCAST_WORDS:
            least = frequency + 1
            break
    return least


def _known_idf(words: pa.Array, often: Broadcast) -> np.ndarray:
    """The idf of each of the (different) words that was broadcast, else NaN.  The broadcast words are looked up
    in the few of a batch, not the other way around: they are read in order and need no table of their own."""
    known, idf = often.value
    out = np.full(len(words), np.nan)
    at = pc.index_in(known, value_set=words)
    out[at.drop_null().to_numpy()] = idf[at.is_valid().to_numpy(zero_copy_only=False)]
    return out


def _corpus(df: DataFrame, key: str, text: str) -> _Corpus:
    rows = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    counts = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    n_docs, most = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.max("_n")).first()
    once, more = rows, None
    if (most or 0) > 1:
        repeated, same = counts.where("_n > 1").select(F.col("_key").alias("_again")), F.col("_key").eqNullSafe(F.col("_again"))
        once, more = rows.join(repeated, same, "left_anti"), rows.join(repeated, same, "left_semi")
    words = _counted_words(_lower_texts(once))
    if more is not None:
        words = words.unionByName(_word_places(_lower_sentences(more)).select("_key", "word").distinct().select("word", F.lit(1).cast("bigint").alias("n")))
    known = reliable_checkpoint(words.groupBy("word").agg(F.sum("n").alias("_df")).where("_df > 1"))
    least = _least_broadcast(known)
    top = known.where(F.col("_df") >= least).toArrow().combine_chunks()
    words, idf = top.column(0).combine_chunks(), [_idf(n_docs, n) for n in top.column(1).to_pylist()]
    often = df.sparkSession.sparkContext.broadcast((words, np.array(idf, np.float64)))
    return _Corpus(once, more, n_docs, known, least, often)


def _lower_sentences(rows: DataFrame) -> DataFrame:
    return rows.select("_key", F.transform(split_sentences(F.col("_text")), F.lower).alias("sents"))


def _rounded(scores: np.ndarray) -> np.ndarray:
    """The scores to ``SCORE_DIGITS`` digits as Spark's ``round`` has them: half up, of their shortest decimal form."""
    scaled = scores * 10 ** SCORE_DIGITS
    out = np.floor(scaled + 0.5) / 10 ** SCORE_DIGITS
    unsure = (np.abs(scaled - np.floor(scaled) - 0.5) < 0.01) | (scaled > 1 << 45)
    for k in np.flatnonzero(unsure).tolist():
        out[k] = float(Decimal(repr(float(scores[k]))).quantize(Decimal(1).scaleb(-SCORE_DIGITS), ROUND_HALF_UP))
    return out


class _Scores(NamedTuple):
    """Of the sentences with tokens in a batch of rows: the index in the row, the number of tokens, the score; those
    of row ``i`` are from ``bounds[i]`` to ``bounds[i + 1]``."""
    sidx: np.ndarray
    n_tokens: np.ndarray
    score: np.ndarray
    bounds: list[int]


def _batch_scores(low: pa.Array, idf: Callable[[pa.Array], np.ndarray]) -> _Scores:
    """The scores of marked texts in lower case."""
    parted = pc.split_pattern(low, SENT_MARK)
    real = pc.greater(pc.binary_length(parted.flatten()), 0)
    row = pc.list_parent_indices(parted).filter(real).to_numpy()
    of, ids, words = _encoded(parted.flatten().filter(real))
    starts, tf, count = _row_bounds(row[of], len(low)), np.zeros(len(ids), np.int64), np.zeros(len(words), np.int64)
    for a, b in zip(starts, starts[1:]):
        w = ids[a:b]
        np.add.at(count, w, 1)
        tf[a:b] = count[w]
        count[w] = 0
    n_tokens = np.bincount(of, minlength=len(row))
    total = np.bincount(of, tf * idf(words)[ids], minlength=len(row))
    sidx = np.arange(len(row)) - np.searchsorted(row, row)
    some = n_tokens > 0
    return _Scores(sidx[some], n_tokens[some], _rounded(total[some] / n_tokens[some]), _row_bounds(row[some], len(low)))


def _scored_rows(c: _Corpus, each: Callable[[pa.RecordBatch, _Scores], pa.RecordBatch], schema: T.StructType) -> DataFrame:
    """``each`` of the batches of (_key, marked, _low, rare) of ``c.once`` and their scores; ``marked`` is the text as
    ``mark_sentences`` gives it."""
    rows, often, n_docs = c.once, c.often, c.n_docs
    found = F.lit(None).cast("array<struct<word:string,_df:bigint>>").alias("rare")
    if c.least > 2:
        rare = _row_words(_lower_texts(rows), often).join(c.known.where(F.col("_df") < c.least), "word")
        found_of = rare.groupBy("_key").agg(F.collect_list(F.struct("word", "_df")).alias("rare"))
        rows, found = rows.join(found_of.withColumnRenamed("_key", "_of"), F.col("_key").eqNullSafe(F.col("_of")), "left"), F.col("rare")
    marked = rows.select("_key", mark_sentences(F.col("_text")).alias("marked"), found)
    plain = F.length("marked") == F.octet_length("marked")  # of ASCII alone Arrow makes the lower case
    marked = marked.select("_key", "marked", F.when(~plain, F.lower("marked")).alias("_low"), "rare")

    def scored(b: pa.RecordBatch) -> pa.RecordBatch:
        entries = b.column(3).flatten()
        rare = dict(zip(entries.field(0).to_pylist(), entries.field(1).to_pylist()))

        def idf(words: pa.Array) -> np.ndarray:
            out = _known_idf(words, often)
            other = np.flatnonzero(np.isnan(out))
            out[other] = [_idf(n_docs, rare.get(w, 1)) for w in words.take(pa.array(other)).to_pylist()]
            return out

        return each(b, _batch_scores(pc.coalesce(b.column(2), pc.ascii_lower(b.column(1))), idf))

    return map_batches(marked, scored, schema, TEXT_BYTES)


def _shared_scores(c: _Corpus) -> DataFrame:
    """The scores of the rows whose keys repeat: term frequencies by a window on (key, word)."""
    counted = _word_places(_lower_sentences(c.more)).withColumn("tf", F.sum(F.size("places")).over(Window.partitionBy("_key", "word")))

    def idf(n: Column) -> Column:
        return F.log(F.lit(1.0 + c.n_docs) / (F.lit(1.0) + n)) + F.lit(1.0)

    known = c.known.select("word", idf(F.col("_df")).alias("idf"), "_df")
    often, rare = known.where(F.col("_df") >= c.least).drop("_df"), known.where(F.col("_df") < c.least).drop("_df")
    looked = counted.join(F.broadcast(often), "word", "left")
    if c.least > 2:  # both parts read the one broadcast
        looked = looked.where("idf is not null").unionByName(
            looked.where("idf is null").drop("idf").join(rare, "word", "left"))
    weighed = looked.select(
        "_key", (F.col("tf") * F.coalesce(F.col("idf"), idf(F.lit(1)))).alias("weight"), F.explode("places").alias("sidx"))
    return weighed.groupBy("_key", "sidx").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.round(F.avg("weight"), SCORE_DIGITS).alias("score"),
    )


def sentence_scores(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_key, sidx, n_tokens, score): score = mean tf*idf over the
    sentence's tokens.  Every sentence has at least one token (pieces are
    non-empty and hold no whitespace at their ends).

    Term frequencies belong to a key: rows of a key that no other row has
    are counted alone, rows of a repeated key (a null key counts as one)
    together, by a window on (key, word)."""
    c = _corpus(df, key, text)

    def each(part: pa.RecordBatch, s: _Scores) -> pa.RecordBatch:
        keys = part.column(0).take(pa.array(np.repeat(np.arange(part.num_rows), np.diff(s.bounds))))
        return record(_key=keys, sidx=pa.array(s.sidx, pa.int32()), n_tokens=pa.array(s.n_tokens, pa.int64()), score=pa.array(s.score))

    alone = _scored_rows(c, each, T.StructType([
        c.once.schema["_key"], T.StructField("sidx", T.IntegerType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("score", T.DoubleType())]))
    return alone if c.more is None else alone.unionByName(_shared_scores(c))


def _picked(marked: str, s: _Scores, row: int, max_tokens: int, sep: str) -> str:
    """The best-scoring sentences of a row that fit ``max_tokens`` together, in order."""
    a, b = s.bounds[row], s.bounds[row + 1]
    if a == b:
        return ""
    best = np.argsort(-s.score[a:b], kind="stable")
    fit = int(np.searchsorted(np.cumsum(s.n_tokens[a:b][best]), max_tokens, "right"))
    sents = [x for x in marked.split(SENT_MARK) if x]
    if not fit:
        return " ".join(_WS_RUN.split(sents[s.sidx[a + best[0]]])[:max_tokens])
    return sep.join([sents[k] for k in np.sort(s.sidx[a:b][best[:fit]]).tolist()])


def _own_summaries(c: _Corpus, max_tokens: int, sep: str, texts: bool) -> DataFrame:
    """(_key, summary) of ``c.once``, with ``texts`` (_key, marked, summary).  A null key has an empty summary."""
    names = ["_key", "marked"] if texts else ["_key"]

    def each(part: pa.RecordBatch, s: _Scores) -> pa.RecordBatch:
        rows = zip(part.column(0).is_valid().to_pylist(), part.column(1).to_pylist())
        summary = [_picked(marked, s, k, max_tokens, sep) if valid and marked else "" for k, (valid, marked) in enumerate(rows)]
        return pa.RecordBatch.from_arrays([*part.columns[:len(names)], pa.array(summary, pa.string())], [*names, "summary"])

    return _scored_rows(c, each, T.StructType([
        c.once.schema["_key"], *[T.StructField(n, T.StringType()) for n in names[1:]], T.StructField("summary", T.StringType())]))


def _shared_summaries(c: _Corpus, max_tokens: int, sep: str) -> DataFrame:
    """(_key, summary) of the rows whose keys repeat.

    The ranking runs on (doc, sentence index, size, score) only; the
    chosen indices are collected per document (at most ``max_tokens``) and
    the sentences are picked from a fresh split of each document's text
    in the final projection."""
    order = [F.col("score").desc(), F.col("sidx").asc()]
    best = top_k_per_group(_shared_scores(c), "_key", order, max_tokens)
    w = Window.partitionBy("_key").orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0)
    best = best.withColumn("_cum", F.sum("n_tokens").over(w))
    keep = best.where((F.col("_cum") <= max_tokens) | (F.col("_rank") == 1)).select(
        "_key", F.struct("sidx", (F.col("_cum") > max_tokens).alias("cut")).alias("_p"))
    chosen = keep.groupBy("_key").agg(F.array_sort(F.collect_list("_p")).alias("_picks"))
    j = c.more.join(chosen, "_key", "left")

    def pick(sents):
        def one(p):
            sentence = F.get(sents, p["sidx"])
            first_cut = F.array_join(F.slice(F.split(sentence, WS + "+"), 1, max_tokens), " ")
            return F.when(p["cut"], first_cut).otherwise(sentence)
        return F.array_join(F.transform(F.col("_picks"), one), sep)

    summary = F.when(F.col("_picks").isNull(), F.lit("")).otherwise(
        bind(split_sentences(F.col("_text")), pick))
    return j.select("_key", summary.alias("summary"))


def summarise(df: DataFrame, key: str = "doc_id", text: str = "text",
              max_tokens: int = MAX_SUMMARY_TOKENS, sep: str = " ") -> DataFrame:
    """Key, summary -- the best-scoring sentences (ties -> earlier)
    that fit ``max_tokens`` together, in document order, joined by ``sep``.  When even the
    best sentence is longer than the budget it is cut to ``max_tokens``
    words.  Documents without sentences get an empty summary."""
    c = _corpus(df, key, text)
    made = _own_summaries(c, max_tokens, sep, texts=False)
    if c.more is not None:
        made = made.unionByName(_shared_summaries(c, max_tokens, sep))
    return made.withColumnRenamed("_key", key)


def sentences_and_summary(df: DataFrame, key: str = "doc_id", text: str = "text",
                          max_tokens: int = MAX_SUMMARY_TOKENS, sep: str = " ") -> DataFrame:
    """key, sents, summary: the sentences of each row, joined by key to what ``summarise`` gives of ``df``.  Only
    rows of a repeated key meet in a join; rows without a key have no match."""
    c = _corpus(df, key, text)
    made = _own_summaries(c, max_tokens, sep, texts=True).where("_key is not null")
    if c.more is not None:
        made = made.unionByName(c.more.select("_key", mark_sentences(F.col("_text")).alias("marked")).join(
            _shared_summaries(c, max_tokens, sep), "_key"))
    return made.select(F.col("_key").alias(key), marked_sentences("marked").alias("sents"), "summary")
