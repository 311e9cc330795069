import math
import re
from collections import Counter, defaultdict

import pytest

from topicforge.operators import summary as S

SCHEMA = "doc_id long, text string"
TEXTS = ["One two two. Three one one four. Five.", "Two six. One", "", None, "Seven two eight. Seven Two."]


def plain_scores(rows):
    """Term frequencies of a key over all its rows, document frequencies over keys."""
    at, tf = defaultdict(list), defaultdict(Counter)
    for key, text in rows:
        for k, sentence in enumerate(x for x in re.split(r"(?<=[.])\s+", (text or "").strip()) if x):
            words = sentence.lower().split()
            at[key, k] += words
            tf[key].update(words)
    df = Counter(w for words in tf.values() for w in words)
    weight = lambda key, w: tf[key][w] * (math.log((1 + len(rows)) / (1 + df[w])) + 1)
    return {(key, k): (len(ws), pytest.approx(sum(weight(key, w) for w in ws) / len(ws))) for (key, k), ws in at.items()}


@pytest.mark.parametrize("keys", [[1, 2, 3, 4, 5], [1, 1, 3, 4, 5], [1, None, 3, 4, None], [7, 7, 7, 7, 7]])
def test_sentence_scores(spark, keys):
    rows = list(zip(keys, TEXTS))
    got = {(r["_key"], r["sidx"]): (r["n_tokens"], r["score"]) for r in S.sentence_scores(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain_scores(rows)


@pytest.mark.parametrize("most", [0, 1, 1 << 20])
def test_idf_lookup_broadcast_whole_in_part_or_not(spark, monkeypatch, most):
    monkeypatch.setattr(S, "BROADCAST_WORDS", most)
    rows = list(enumerate(TEXTS))
    got = {(r["_key"], r["sidx"]): (r["n_tokens"], r["score"]) for r in S.sentence_scores(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == plain_scores(rows)


def test_words_of_single_rows_go_through_no_window(spark):
    scores = S.sentence_scores(spark.createDataFrame(list(enumerate(TEXTS)), SCHEMA))
    assert "Window" not in scores._jdf.queryExecution().optimizedPlan().toString()


def test_an_empty_table_gives_no_summary(spark):
    assert S.summarise(spark.createDataFrame([], SCHEMA)).collect() == []


ODD = [(1, "Long one two three four. Short one. Last five six."), (2, "Two\x01 six.\x01 \x01One ÄÖ äö ΑΣ. ας"), (3, ""), (4, None), (5, " a " * 130 + "\u2028b."),
       (6, "Kk Two\u00a0three! One? \"Yes.\" no"), (7, "x. X. y."), (7, "x y. z"), (None, "One two."), (None, "x"), (8, "Dr. Who one. Two")]


def plain_summaries(rows, most, sep):
    """One for each row, by the scores of the rows together."""
    from topicforge.functions.text import WS_CHARS

    mark = re.compile(f"(?<!Dr)([.!?]+\"*)[{re.escape(WS_CHARS)}]+")
    sents = [[s for s in mark.sub("\\1\x01", (t or "").strip(WS_CHARS)).split("\x01") if s] for _, t in rows]
    tf, n, sums = defaultdict(Counter), Counter(), defaultdict(float)
    for (key, _), ss in zip(rows, sents):
        tf[key].update(w for s in ss for w in s.lower().split())
    df = Counter(w for words in tf.values() for w in words)
    for (key, _), ss in zip(rows, sents):
        for k, s in enumerate(ss):
            for w in s.lower().split():
                n[key, k] += 1
                sums[key, k] += tf[key][w] * (math.log((1 + len(rows)) / (1 + df[w])) + 1)
    out = []
    for (key, _), ss in zip(rows, sents):
        ranked = sorted((k for i, k in n if i == key and key is not None), key=lambda k: (-round(sums[key, k] / n[key, k], 9), k))
        fit = [k for i, k in enumerate(ranked) if sum(n[key, x] for x in ranked[:i + 1]) <= most]
        if ranked and not fit:
            out.append(" ".join(re.split(f"[{re.escape(WS_CHARS)}]+", ss[ranked[0]])[:most]) if ranked[0] < len(ss) else "")
        else:
            out.append(sep.join(ss[k] for k in sorted(fit) if k < len(ss)))
    return sents, out


@pytest.mark.parametrize("most", [0, 3, 1 << 20])
@pytest.mark.parametrize("budget", [2, 5, 120])
def test_summaries_with_all_some_or_no_words_at_hand(spark, monkeypatch, most, budget):
    monkeypatch.setattr(S, "BROADCAST_WORDS", most)
    got = S.summarise(spark.createDataFrame(ODD, SCHEMA), max_tokens=budget).collect()
    _, want = plain_summaries(ODD, budget, " ")
    assert Counter((r["doc_id"], r["summary"]) for r in got) == Counter((key, s) for (key, _), s in zip(ODD, want))


def test_pairs_of_texts_whose_keys_do_not_repeat_are_made_without_join_or_window(spark, tmp_path):
    from topicforge.plans.standins import summary_pairs

    def pairs(rows, name):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        return summary_pairs(spark, f"{tmp_path}/{name}")

    single = [r for r in ODD if r[0] not in (7, None)]
    for rows, name in ((single, "once"), (ODD, "again")):
        made = pairs(rows, name)
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert name == "again" or not ("Join" in plan or "Window" in plan)  # three joins and three windows before
        sents, summary = plain_summaries(rows, 120, "\n")
        want = Counter()
        for (key, text), ss in zip(rows, sents):
            for (other, _), s in zip(rows, summary):
                if key is not None and key == other:
                    ref = None if text is None else "\n".join(ss)
                    want.update([(key, "lead1", None if text is None else "\n".join(ss[:1]), ref), (key, "summarise", s, ref),
                                 (key, "lead3", None if text is None else "\n".join(ss[:3]), ref)])
        assert Counter((r["id"], r["system"], r["prediction"], r["reference"]) for r in made.collect()) == want


def test_scores_are_rounded_half_up_as_decimals():
    import numpy as np

    x = [0.1234567895, 2.5, 1e16 / 3, 0.1234567885, 123456.7890123455, 0.0]
    assert S._rounded(np.array(x)).tolist() == [0.12345679, 2.5, 1e16 / 3, 0.123456789, 123456.789012346, 0.0]
