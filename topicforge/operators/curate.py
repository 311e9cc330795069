"""Row-level curation operators.

All are narrow (no shuffle) except the two aggregations, which are
partial+final hash aggregates and therefore immune to a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicforge.constants import LEAD_SENTENCES, MAX_SUMMARY_LENGTH, MIN_REPORTED_COUNT
from topicforge.functions.text import lead_sentences
from topicforge.taxonomy import topics_spaced


def latest_revision(pages: DataFrame, mode: str = "latest", revisions: str = "revisions") -> DataFrame:
    """A3 on dump-shaped rows: replace ``revisions`` by one ``text``.

    ``mode="latest"`` keeps the revision with the greatest (ts, rev_id);
    ``mode="first"`` keeps the first one met, as the reference's loop does.
    Works inside the row: no shuffle.
    """
    revs = F.col(revisions)
    if mode == "first":
        pick = F.get(revs, 0)
    elif mode == "latest":
        keyed = F.transform(revs, lambda r: F.struct(r["ts"].alias("ts"), r["rev_id"].alias("rev_id"),
                                                     r["text"].alias("text")))
        pick = F.array_max(keyed)
    else:
        raise ValueError("mode must be 'latest' or 'first'")
    return pages.withColumn("_rev", pick).select(
        *[c for c in pages.columns if c != revisions],
        F.col("_rev.rev_id").alias("rev_id"),
        F.col("_rev.text").alias("text"),
    )


def latest_by_key(rows: DataFrame, key: str | Sequence[str], order: Sequence[str],
                  value_cols: Sequence[str]) -> DataFrame:
    """A3 on exploded rows: for each key, the values of the row with the
    greatest ``order`` tuple.  ``max_by`` is a partial aggregate, so a key
    holding a third of all rows is reduced map-side before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    ordering = F.struct(*[F.col(c) for c in order])
    payload = F.struct(*[F.col(c) for c in value_cols])
    return rows.groupBy(*keys).agg(F.max_by(payload, ordering).alias("_v")).select(
        *keys, *[F.col(f"_v.{c}").alias(c) for c in value_cols]
    )


def select_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Keep only model columns (Catalyst prunes the scan)."""
    return df.select(*cols)


def keep_topics(df: DataFrame, col: str = "categories",
                taxonomy: Sequence[str] | None = None, out: str | None = None) -> DataFrame:
    """Keep categories in the taxonomy (repeats kept), drop rows with none."""
    names = list(taxonomy) if taxonomy is not None else list(topics_spaced())
    lits = F.array(*[F.lit(n) for n in names])
    kept = F.filter(F.col(col), lambda c: F.array_contains(lits, c))
    out = out or col
    return df.withColumn(out, kept).where(F.size(F.col(out)) > 0)


def page_summary(summary: Column | str, text: Column | str, n: int = LEAD_SENTENCES) -> Column:
    """The summary if non-empty, else the text; then the first n sentences."""
    s = F.col(summary) if isinstance(summary, str) else summary
    t = F.col(text) if isinstance(text, str) else text
    return lead_sentences(F.coalesce(F.nullif(s, F.lit("")), t), n)


def members_by_namespace(members: DataFrame, ns: str, ns_col: str = "ns") -> DataFrame:
    """Pages (``MAIN``) or subcategories (``CATEGORY``) of a listing."""
    return members.where(F.col(ns_col) == F.lit(ns))


def filter_long_docs(df: DataFrame, max_len: int = MAX_SUMMARY_LENGTH, length: str = "summary_length",
                     summary: str = "summary_text", chapter: str = "chapter") -> DataFrame:
    """summary_length <= max_len, summary and chapter present.
    A null length drops the row."""
    return df.where(
        (F.col(length) <= F.lit(max_len)) & F.col(summary).isNotNull() & F.col(chapter).isNotNull()
    )


def topic_counts(df: DataFrame, col: str = "categories", min_count: int = MIN_REPORTED_COUNT,
                 name: str = "topic") -> DataFrame:
    """Hits per topic, repeats within a page counted, reporting
    topics with ``count >= min_count``."""
    return (
        df.select(F.explode(F.col(col)).alias(name))
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= F.lit(min_count))
    )


def extract_progress(df: DataFrame, col: str = "categories") -> DataFrame:
    """C8 as a query: pages processed and pages with a topic hit.
    ``df`` holds every page with its kept-topic array (maybe empty)."""
    return df.agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.size(F.col(col)) > 0).alias("hits"),
    )
