"""Bounded samples of labelled documents, for the classifiers that learn from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.llm.batches import held_out, id_text


def training_rows(docs: DataFrame, labels: DataFrame, label: str, most: int, id_col: str = "doc_id",
                  text_col: str = "text", by_class: bool = False) -> DataFrame:
    """(doc_id, text, label) of at most ``most`` labelled documents that are not held out: those with the
    smallest hashes of doc_id, of each label separately if ``by_class`` (then half of ``most`` each).
    A doc_id labelled more than once counts with its largest label; null labels do not count."""
    one = (labels.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
           .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col(id_col)))
           .groupBy("doc_id").agg(F.max("label").alias("label")))
    order = [F.xxhash64("doc_id"), "doc_id"]
    if by_class:
        chosen = (one.where("label = 1").orderBy(*order).limit(most // 2)
                  .unionByName(one.where("label = 0").orderBy(*order).limit(most // 2)))
    else:
        chosen = one.orderBy(*order).limit(most)
    return id_text(docs, id_col, text_col).join(F.broadcast(chosen), "doc_id")  # at most ``most`` rows
