"""Abbreviations learned from a corpus, for the sentence rule.

A word that is written with a period far more often than words are is an
abbreviation (Dunning's log-likelihood ratio of the word's periods, as in
the published unsupervised sentence splitters): its ratio is weighed by
its length, by periods inside it and by how often it stands without one.
Counts are one partial aggregate a word; only the words that pass, at
most ``most``, come to the driver, as the parameter of the sentence rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.functions.text import DEFAULT_ABBREVIATIONS, WS

# A token: opening signs, letters with periods inside, perhaps a last period, closing signs.
TOKEN = r"""^["'(\[“‘]*(\p{L}+(?:\.\p{L}+)*)(\.?)[,;:!?"')\]”’]*$"""
# Share of an abbreviation's occurrences that have the period; score from which a word counts as one.
PERIOD_SHARE, THRESHOLD = 0.99, 0.3


def abbreviation_scores(df: DataFrame, text: str = "text") -> DataFrame:
    """word, n_period, n_plain, score of every word that ends in a period somewhere.  Words differ by case.
    Null texts have no words; a corpus without a period gives no rows."""
    tokens = df.select(F.explode(F.split(F.col(text), WS + "+")).alias("t")).where(F.col("t").rlike(TOKEN))
    words = tokens.groupBy(F.regexp_extract("t", TOKEN, 1).alias("word")).agg(
        F.count_if(F.regexp_extract("t", TOKEN, 2) == ".").alias("n_period"), F.count(F.lit(1)).alias("n"))
    share = words.agg((F.sum("n_period") / F.sum("n")).alias("p"))  # one row
    each = words.where("n_period > 0").crossJoin(F.broadcast(share))
    plain = F.col("n") - F.col("n_period")

    def likelihood(p):
        return F.col("n_period") * F.log(p) + plain * F.log(F.greatest(1 - p, F.lit(1e-12)))

    ratio = -2 * (likelihood(F.col("p")) - likelihood(F.lit(PERIOD_SHARE)))
    letters = F.length(F.replace("word", F.lit("."), F.lit("")))
    periods = F.length("word") - letters + 1
    score = ratio * F.exp(-letters) * periods * F.pow(letters.cast("double"), -plain)
    return each.select("word", "n_period", plain.alias("n_plain"), score.alias("score"))


def learn_abbreviations(df: DataFrame, text: str = "text", threshold: float = THRESHOLD, min_count: int = 5,
                        most: int = 500) -> tuple[str, ...]:
    """The words that score ``threshold`` or more and have the period ``min_count`` times, the ``most`` best (ties by
    word), sorted; the fixed list if there is none.  Feeds ``abbreviations`` of ``split_sentences``."""
    good = abbreviation_scores(df, text).where((F.col("score") >= threshold) & (F.col("n_period") >= min_count))
    best = good.orderBy(F.col("score").desc(), "word").limit(most).select("word").collect()
    return tuple(sorted(r["word"] for r in best)) or DEFAULT_ABBREVIATIONS
