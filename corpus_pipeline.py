"""A training corpus from ``documents``: quality, near duplicates, repeated passages, source mix, token ids.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the next stage's docs.
Each stage works on all rows its predecessor kept and, but for the last, returns the columns of documents.
``run`` applies them to the table ``documents``, each stage's result written to the shared checkpoint folder
and read again, so that a lost executor costs one stage at most.

An empty table, null texts, repeated rows and further columns pass through as the operators define; null and
empty texts are judged like any other.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from topicforge.llm import bpe, jaccard, mixing, passages, quality_model, queries
from topicforge.llm.batches import table
from topicforge.session import reliable_checkpoint


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labelled rows of ``docs``, does not reject."""
    return quality_model.keep_quality(docs, quality_model.fit_quality(docs, table(spark, sf_dir, "labels")), threshold=0.5)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest doc_id."""
    return jaccard.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has; what is left of a text stays."""
    return passages.cut_passages(docs, passages.repeated_passages(docs), size_col="n_chars" if "n_chars" in docs.columns else None)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by the target weights of their domain, language and source, repeated for whole epochs."""
    return mixing.mixed_documents(docs, queries.mix_levels(), queries.mix_weights(spark), queries.MIX_BUDGET_PERCENT, queries.MIX_EPOCHS, queries.MIX_SEED)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the SHA-256 of the decoded text of every document of the mix."""
    return bpe.bpe_round_trip(docs, public_tokenizers.path(queries.WORD_BPE), give="ids")


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: Learned and order-dependent stages have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = reliable_checkpoint(docs)
    return docs
