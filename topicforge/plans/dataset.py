"""Build the curated multi-label dataset.

edges + members + roots --walk with quota (C1+C2)--> hits(root, page_id)
--merge labels (C3)--> join page content --summary (B7)--> split (D1)
--> (A5) write partitioned by split.

Shuffles: one per walk level (bounded by the level's size), two for the
salted quota, one for the label merge (keyed by page), one for the
content join.  The driver only ever sees per-root counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.constants import LEAD_SENTENCES, MAX_DEPTH, PAGES_PER_ROOT, TEST_SHARE
from topicforge.functions.text import strip_prefix
from topicforge.operators.curate import page_summary
from topicforge.operators.graph import merge_labels, walk_with_quota
from topicforge.operators.splits import train_test_split

LIMIT_PER_ROOT = PAGES_PER_ROOT


def build_dataset(edges: DataFrame, members: DataFrame, pages: DataFrame, roots: DataFrame,
                  limit: int = LIMIT_PER_ROOT, max_depth: int = MAX_DEPTH, test: float = TEST_SHARE,
                  n_sentences: int = LEAD_SENTENCES) -> DataFrame:
    """page_id, title, summary, text, categories array<string>, split."""
    hits = walk_with_quota(edges, roots, members, limit, max_depth)
    labels = merge_labels(hits.withColumn("root", strip_prefix("root")))
    content = pages.select("page_id", "title", "summary", "text")
    ds = labels.join(content, "page_id").select(
        "page_id",
        "title",
        page_summary("summary", "text", n_sentences).alias("summary"),
        "text",
        "categories",
    )
    return train_test_split(ds, "page_id", test)
