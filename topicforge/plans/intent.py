"""L4: web page -> topics -> user intent, over a whole table of pages.

page HTML --(B14/B15/B16 card)--> prompt (B12) --(E2 score)--> top-3
topics (E3) --(E9 vote)--> intent.  Every step is a narrow projection;
scoring is the model's own transform.  No shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.functions.html import html_title, page_summary_from_html
from topicforge.functions.text import render_prompt
from topicforge.operators.model import TopicModel, score_topics
from topicforge.operators.scoring import intent_vote, top_topics


def page_cards(pages: DataFrame, html: str = "html", n_sentences: int = 10) -> DataFrame:
    """Title and first sentences of the paragraphs, plus the prompt."""
    cards = pages.withColumn("title", html_title(F.col(html))).withColumn(
        "summary", page_summary_from_html(F.col(html), n_sentences)
    )
    return cards.withColumn("prompt", render_prompt("classify", title="title", summary="summary"))


def page_intent(pages: DataFrame, model: TopicModel, html: str = "html", k: int = 3) -> DataFrame:
    """key columns of ``pages`` + title, top_topics, intent."""
    cards = page_cards(pages, html).withColumnRenamed("prompt", model.text_col)
    scored = top_topics(score_topics(cards, model, "logits"), "logits", k)
    return scored.withColumn("intent", intent_vote("top_topics"))
