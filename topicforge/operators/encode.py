"""Featurisation (B17-B20): vocabulary, fixed-width token ids, labels.

Tokens are joined to the vocabulary as a table join, not looked up in a
Python dict: the vocabulary is broadcast when its size is bounded below
``BROADCAST_MAX_ROWS`` (it is, by construction, when it comes from
``build_vocab``), otherwise the join is a salted shuffle join so that a
frequent word does not land in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.constants import MAX_INPUT_TOKENS
from topicforge.functions.arrays import multi_hot as multi_hot_col
from topicforge.functions.arrays import topic_id
from topicforge.functions.text import words
from topicforge.operators.skew import global_top_k, lookup_join

PAD_ID = 0
UNK_ID = 1
FIRST_ID = 2


def build_vocab(df: DataFrame, text: str = "text", size: int = 30_000) -> DataFrame:
    """Word -> id for the ``size`` most frequent words, ordered by
    (count desc, word asc); ids start at 2 (0 = pad, 1 = unknown).

    Word counts are a partial+final aggregate (hot words are reduced
    map-side); the ordering is a salted two-stage top-k whose rank is the
    id, so no task orders more than ``64 * size`` rows."""
    counts = (
        df.select(F.explode(words(F.col(text))).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    top = global_top_k(counts, [F.col("n").desc(), F.col("word").asc()], size)
    return top.select("word", (F.col("_rank") + F.lit(FIRST_ID - 1)).cast("int").alias("id"), "n")


def encode_tokens(df: DataFrame, key: str, text: str, vocab: DataFrame, max_length: int = MAX_INPUT_TOKENS,
                  vocab_rows: int | None = None) -> DataFrame:
    """Key, input_ids array<int>[max_length], attention_mask array<int>[max_length].

    Truncation happens before the join (at most ``max_length`` tokens per
    row are exploded); missing words map to 1, padding is 0; an empty or
    null text yields all padding (``posexplode_outer`` keeps its row, so
    no join back to the keys is needed)."""
    toks = df.select(
        F.col(key).alias("_key"),
        F.posexplode_outer(F.slice(words(F.col(text)), 1, max_length)).alias("pos", "word"),
    )
    joined = lookup_join(toks, vocab.select("word", "id"), "word", ["_key", "pos"], "left",
                         lookup_rows=vocab_rows)
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce(F.col("id"), F.lit(UNK_ID)).alias("id")))
    full = joined.groupBy("_key").agg(F.array_sort(F.collect_list(entry)).alias("_s"))
    ids = F.transform(F.col("_s"), lambda s: s["id"])
    pad = F.greatest(F.lit(max_length) - F.size(ids), F.lit(0))
    return full.select(
        F.col("_key").alias(key),
        F.concat(ids, F.array_repeat(F.lit(PAD_ID), pad)).alias("input_ids"),
        F.concat(F.array_repeat(F.lit(1), F.size(ids)), F.array_repeat(F.lit(0), pad)).alias("attention_mask"),
    )


def add_multi_hot(df: DataFrame, categories: str = "categories", out: str = "labels",
                  on_unknown: str = "error") -> DataFrame:
    """B19 over a table (after B11 normalisation of the names)."""
    return df.withColumn(out, multi_hot_col(F.col(categories), on_unknown=on_unknown))


def topic_ids(df: DataFrame, key: str, categories: str = "categories") -> DataFrame:
    """One row per (key, topic) with its index (null if unknown)."""
    return df.select(key, F.explode(F.col(categories)).alias("topic")).withColumn(
        "topic_id", topic_id(F.col("topic"))
    )
