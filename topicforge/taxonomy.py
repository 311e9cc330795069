"""Fixed label sets: the 40 topics and the intent map.

Both are tiny, fixed-size lookups (40 names, 52 pairs), so they are
shipped to executors as literal arrays or broadcast DataFrames; their
size does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's; order is the label index) ---
TOPICS: tuple[str, ...] = (
    "Academic_disciplines",
    "Business",
    "Communication",
    "Concepts",
    "Culture",
    "Economy",
    "Education",
    "Energy",
    "Engineering",
    "Entertainment",
    "Entities",
    "Ethics",
    "Food_and_drink",
    "Geography",
    "Government",
    "Health",
    "History",
    "Human_behavior",
    "Humanities",
    "Information",
    "Internet",
    "Knowledge",
    "Language",
    "Law",
    "Life",
    "Lists",
    "Mass_media",
    "Mathematics",
    "Military",
    "Nature",
    "People",
    "Philosophy",
    "Politics",
    "Religion",
    "Science",
    "Society",
    "Sports",
    "Technology",
    "Time",
    "Universe",
)

# Intent -> topics, in declaration order (the order breaks ties).
INTENTS: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Information", (
        "Academic_disciplines", "Concepts", "Information", "Knowledge",
        "Science", "Education", "Geography", "History", "Mathematics",
        "Engineering", "Technology", "Health", "Law", "Economy", "Government",
    )),
    ("Communication", (
        "Communication", "Language", "Human_behavior", "Business", "Society",
        "Politics", "Ethics", "Philosophy",
    )),
    ("Social Networking", (
        "Culture", "Entertainment", "Humanities", "People", "Society",
        "Religion", "Ethics", "Philosophy", "Life", "Entities",
    )),
    ("Entertainment", (
        "Entertainment", "Food_and_drink", "Sports", "Mass_media", "Music",
        "Culture", "Arts", "History", "Human_behavior",
    )),
    ("Online Media", (
        "Internet", "Technology", "Mass_media", "Engineering", "Computers",
        "Software", "Information", "Business", "Economy", "Education",
    )),
)
# --- end of fixed values ---

NUM_TOPICS = len(TOPICS)
DEFAULT_INTENT = INTENTS[0][0]


def topics_spaced() -> tuple[str, ...]:
    """The same 40 names with spaces, as they appear in wiki category links."""
    return tuple(t.replace("_", " ") for t in TOPICS)


def topic_array(spaced: bool = False) -> Column:
    """Literal array of topic names; index i (0-based) is label i."""
    names = topics_spaced() if spaced else TOPICS
    return F.array(*[F.lit(n) for n in names])


def topic_frame(spark: SparkSession) -> DataFrame:
    """topic(topic_id int, name string) -- 40 rows, safe to broadcast."""
    return spark.createDataFrame(
        [(i, n) for i, n in enumerate(TOPICS)], "topic_id int, name string"
    )


def intent_frame(spark: SparkSession) -> DataFrame:
    """intent(intent_rank int, intent string, topic string) -- 52 rows."""
    rows = [
        (rank, intent, topic)
        for rank, (intent, topics) in enumerate(INTENTS)
        for topic in topics
    ]
    return spark.createDataFrame(rows, "intent_rank int, intent string, topic string")
