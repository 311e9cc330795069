"""The dump-extract pipeline as one narrow plan.

A1 read -> A3 one revision -> B3/B4/B5 categories from the raw text ->
(only surviving pages) B1 strip markup -> B2 clean -> B6 lead sentences.

The cheap category test runs first, so markup stripping and sentence
splitting only run on pages that are kept; the result rows equal the
reference's.  No shuffle: the whole plan is one map stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.functions.text import clean_text, lead_sentences
from topicforge.functions.wikitext import clean_categories, extract_categories, strip_markup
from topicforge.operators.curate import latest_revision
from topicforge.taxonomy import topics_spaced


def page_topics(dump: DataFrame, taxonomy: Sequence[str] | None = None, mode: str = "latest",
                drop_sort_key: bool = False) -> DataFrame:
    """Every page with its kept taxonomy categories (maybe empty)."""
    names = list(taxonomy) if taxonomy is not None else list(topics_spaced())
    lits = F.array(*[F.lit(n) for n in names])
    pages = latest_revision(dump, mode) if "revisions" in dump.columns else dump
    cats = clean_categories(extract_categories(F.col("text")), drop_sort_key)
    return pages.withColumn("categories", F.filter(cats, lambda c: F.array_contains(lits, c)))


def run_extract(dump: DataFrame, taxonomy: Sequence[str] | None = None, mode: str = "latest",
                drop_sort_key: bool = False, n_sentences: int = 5) -> DataFrame:
    """page_id, title, categories array<string>, text (lead sentences)."""
    hits = page_topics(dump, taxonomy, mode, drop_sort_key).where(F.size("categories") > 0)
    return hits.select(
        "page_id",
        "title",
        "categories",
        lead_sentences(clean_text(strip_markup(F.col("text"))), n_sentences).alias("text"),
    )


def extract_rows(extracted: DataFrame) -> DataFrame:
    """The four CSV columns of the reference's extract file."""
    return extracted.select(
        F.col("page_id").alias("Page ID"),
        F.col("title").alias("Page Title"),
        F.array_join("categories", ",").alias("Categories"),
        F.col("text").alias("Page Text"),
    )
