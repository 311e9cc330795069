"""L3: train -> evaluate -> validate on a curated dataset.

The classifier is fitted on the ``train`` split and every metric is read
on the ``test`` split (a model scores perfectly on its own training rows
at small scale).  Batches for the reference's batch-mean figures come
from a dense ordinal supplied with the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.operators.model import TopicModel, fit_topic_classifier, score_topics
from topicforge.operators.scoring import accuracy_report, add_predictions, loss_report, top_topics, validate_top3
from topicforge.operators.splits import assign_batches


def train(dataset: DataFrame, text: str, labels: str, names: tuple[str, ...], **kw) -> TopicModel:
    return fit_topic_classifier(dataset.where(F.col("split") == "train"), text, labels, names, **kw)


def evaluate(dataset: DataFrame, model: TopicModel, text: str, labels: str, ordinal: str,
             categories: str | None = None, batch_size: int = 8) -> DataFrame:
    """Long-form report ``(metric, value)``: accuracy, batch_mean_accuracy,
    loss, batch_mean_loss (+ top-3 validation totals when ``categories``
    holds the true topic names).  Each part is one aggregate; they are
    stacked, not joined."""
    test = dataset.where(F.col("split") == "test")
    scored = add_predictions(score_topics(test, model, "logits"), "logits")
    scored = assign_batches(scored, ordinal, batch_size)
    parts = [accuracy_report(scored, "batch", "preds", labels), loss_report(scored, "batch", "logits", labels)]
    if categories:
        parts.append(validate_top3(top_topics(scored, "logits", 3, names=model.names), categories, "top_topics"))
    out = None
    for p in parts:
        long = p.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in p.columns
        ])).alias("m")).select("m.metric", "m.value")
        out = long if out is None else out.unionByName(long)
    return out
