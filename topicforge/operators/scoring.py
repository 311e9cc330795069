"""Scoring and evaluation.

Per-row work (top-k, thresholds, votes, per-row losses) is expressed
with higher-order array functions, so it runs inside the scan stage with
no shuffle.  Dataset-level numbers are global aggregates (partial per
task, one tiny final merge).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicforge.constants import THRESHOLD, TOP_K_TOPICS
from topicforge.functions.arrays import binarise, sigmoid, softmax_max, top_k_names
from topicforge.taxonomy import INTENTS, TOPICS


def top_topics(df: DataFrame, logits: str = "logits", k: int = TOP_K_TOPICS, out: str = "top_topics",
               names: Sequence[str] = TOPICS) -> DataFrame:
    """The ``k`` most probable topic names (ties -> lower index) and
    the top probability."""
    return df.withColumn(out, top_k_names(F.col(logits), k, names)).withColumn("p_top1", softmax_max(F.col(logits)))


def add_predictions(df: DataFrame, logits: str = "logits", threshold: float = THRESHOLD,
                    out: str = "preds") -> DataFrame:
    """E4 over a table."""
    return df.withColumn(out, binarise(F.col(logits), threshold))


def _row_match(preds: str, labels: str) -> Column:
    return (F.col(preds) == F.col(labels)).cast("double")


def row_bce(logits: Column, labels: Column) -> Column:
    """Sum over labels of the stable BCE-with-logits:
    max(z,0) - z*y + log1p(exp(-|z|))."""
    pairs = F.arrays_zip(logits.alias("z"), labels.alias("y"))
    return F.aggregate(
        pairs, F.lit(0.0),
        lambda acc, p: acc + F.greatest(p["z"], F.lit(0.0)) - p["z"] * p["y"].cast("double")
        + F.log1p(F.exp(-F.abs(p["z"]))),
    )


def subset_accuracy(df: DataFrame, preds: str = "preds", labels: str = "labels") -> DataFrame:
    """E5: share of rows whose whole prediction vector equals the labels."""
    return df.agg(F.avg(_row_match(preds, labels)).alias("accuracy"))


def batch_mean_accuracy(df: DataFrame, batch: str = "batch", preds: str = "preds",
                        labels: str = "labels") -> DataFrame:
    """E5 as the reference reports it: the mean of per-batch accuracies
    (differs from the global mean when the last batch is short)."""
    per = df.groupBy(batch).agg(F.avg(_row_match(preds, labels)).alias("acc"))
    return per.agg(F.avg("acc").alias("batch_mean_accuracy"))


def bce_loss(df: DataFrame, logits: str = "logits", labels: str = "labels") -> DataFrame:
    """Mean BCE over rows x labels."""
    return df.agg(
        (F.sum(row_bce(F.col(logits), F.col(labels))) / F.sum(F.size(F.col(logits)))).alias("loss")
    )


def batch_mean_bce(df: DataFrame, batch: str = "batch", logits: str = "logits",
                   labels: str = "labels") -> DataFrame:
    """E6 as reported: mean over batches of each batch's mean BCE."""
    per = df.groupBy(batch).agg(
        (F.sum(row_bce(F.col(logits), F.col(labels))) / F.sum(F.size(F.col(logits)))).alias("l")
    )
    return per.agg(F.avg("l").alias("batch_mean_loss"))


def top3_good(true_topics: Column, top3: Column) -> Column:
    """Every true topic is among the top 3 (none -> good, more than 3 -> bad)."""
    return F.size(F.array_except(true_topics, top3)) == 0


def accuracy_report(df: DataFrame, batch: str = "batch", preds: str = "preds",
                    labels: str = "labels") -> DataFrame:
    """E5 both ways in one plan: per-batch partial sums, then the global
    accuracy and the mean of batch accuracies from the same rows."""
    per = df.groupBy(batch).agg(F.sum(_row_match(preds, labels)).alias("ok"), F.count(F.lit(1)).alias("n"))
    return per.agg(
        (F.sum("ok") / F.sum("n")).alias("accuracy"),
        F.avg(F.col("ok") / F.col("n")).alias("batch_mean_accuracy"),
    )


def loss_report(df: DataFrame, batch: str = "batch", logits: str = "logits",
                labels: str = "labels") -> DataFrame:
    """E6 both ways in one plan (global mean and mean of batch means)."""
    per = df.groupBy(batch).agg(
        F.sum(row_bce(F.col(logits), F.col(labels))).alias("l"), F.sum(F.size(F.col(logits))).alias("w")
    )
    return per.agg(
        (F.sum("l") / F.sum("w")).alias("loss"),
        F.avg(F.col("l") / F.col("w")).alias("batch_mean_loss"),
    )


def validate_top3(df: DataFrame, categories: str = "categories", top3: str = "top_topics") -> DataFrame:
    """Totals of good/bad rows; ``bad_ratio`` = bad/total and the
    reference's own figure ``ref_ratio`` = bad/good/100 (null when good=0)."""
    good = top3_good(F.col(categories), F.col(top3))
    t = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(good).alias("good"),
        F.count_if(~good).alias("bad"),
    )
    return t.select(
        "total", "good", "bad",
        F.try_divide(F.col("bad").cast("double"), F.col("total")).alias("bad_ratio"),
        (F.try_divide(F.col("bad").cast("double"), F.col("good")) / F.lit(100.0)).alias("ref_ratio"),
    )


def bad_rows(df: DataFrame, key: str = "id", categories: str = "categories",
             top3: str = "top_topics", title: str | None = None) -> DataFrame:
    """Wrong rows with their true and predicted topics (comma-joined)."""
    cols = [key] + ([title] if title else [])
    return df.where(~top3_good(F.col(categories), F.col(top3))).select(
        *cols,
        F.array_join(F.col(categories), ",").alias("true_topics"),
        F.array_join(F.col(top3), ",").alias("predicted"),
    )


def intent_vote(topics: Column | str,
                intents: Sequence[tuple[str, Sequence[str]]] = INTENTS) -> Column:
    """The intent whose topic list holds most of ``topics``; ties go
    to the earlier intent; no match -> the first intent.

    The intent map is a fixed literal (52 pairs), so the vote is a
    per-row expression: no join, no shuffle."""
    t = F.col(topics) if isinstance(topics, str) else topics
    def votes(names: Sequence[str]) -> Column:
        lits = F.array(*[F.lit(n) for n in names])
        return F.aggregate(t, F.lit(0), lambda acc, x: acc + F.array_contains(lits, x).cast("int"))

    counts = [votes(names) for _, names in intents]
    arr = F.array(*counts)
    names_arr = F.array(*[F.lit(i) for i, _ in intents])
    best = F.array_position(arr, F.array_max(arr))
    return F.element_at(names_arr, best.cast("int"))


def intent_vote_table(df: DataFrame, key: str, topics: str, intent_map: DataFrame,
                      default: str = INTENTS[0][0]) -> DataFrame:
    """E9 against an intent table ``(intent_rank, intent, topic)`` of any
    size: explode -> join -> count -> best per key (partial aggregates,
    so a hot key is reduced map-side).  Keys with no match get
    ``default`` (the first intent)."""
    ex = df.select(key, F.explode(F.col(topics)).alias("topic"))
    votes = ex.join(intent_map, "topic").groupBy(key, "intent_rank", "intent").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy(key).agg(F.max_by("intent", F.struct(F.col("n"), -F.col("intent_rank"))).alias("intent"))
    return df.select(key).join(best, key, "left").select(key, F.coalesce("intent", F.lit(default)).alias("intent"))


def model_agreement(a: DataFrame, b: DataFrame, key: str = "id", col: str = "pred") -> DataFrame:
    """Side-by-side outputs of two models and their agreement rate."""
    j = a.select(key, F.col(col).alias("a")).join(b.select(key, F.col(col).alias("b")), key)
    return j.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("a") == F.col("b")).alias("agree"),
        F.try_divide(F.count_if(F.col("a") == F.col("b")).cast("double"), F.count(F.lit(1))).alias("agreement"),
    )


__all__ = [
    "top_topics", "add_predictions", "subset_accuracy", "batch_mean_accuracy", "bce_loss",
    "batch_mean_bce", "validate_top3", "bad_rows", "intent_vote", "intent_vote_table",
    "model_agreement", "row_bce", "sigmoid",
]
