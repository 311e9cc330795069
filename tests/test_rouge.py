import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from topicforge.functions import lcs
from topicforge.operators import rouge as R


def dp_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            t[i][j] = t[i - 1][j - 1] + 1 if a[i - 1] == b[j - 1] else max(t[i - 1][j], t[i][j - 1])
    return t[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=30), st.lists(st.sampled_from("abcd"), max_size=30))
def test_bit_parallel_lcs_equals_dp(a, b):
    assert lcs.lcs_length(a, b) == dp_lcs(a, b)
    idx = lcs.lcs_indices(a, b)
    assert len(idx) == dp_lcs(a, b) and idx == sorted(idx)


def pairs(spark, rows):
    return spark.createDataFrame([(i, "s", p, r) for i, (p, r) in enumerate(rows)],
                                 "id long, system string, prediction string, reference string")


def test_rouge_n_cases(spark):
    df = pairs(spark, [("the cat sat", "the cat sat"), ("a b", "c d"), ("", "x y"), ("the the the", "the cat")])
    r1 = {r["id"]: (r["precision"], r["recall"], r["f1"]) for r in R.rouge_n(df, 1).collect()}
    assert r1[0] == (1.0, 1.0, 1.0)
    assert r1[1] == (0.0, 0.0, 0.0)
    assert r1[2] == (0.0, 0.0, 0.0)
    assert r1[3][0] == pytest.approx(1 / 3) and r1[3][1] == pytest.approx(1 / 2)   # clipping
    r2 = {r["id"]: r["f1"] for r in R.rouge_n(df, 2).collect()}
    assert r2[0] == 1.0 and r2[1] == 0.0


def test_rouge_l_and_lsum(spark):
    df = pairs(spark, [("a b c d", "a b c d"), ("a x b", "a b"), ("one two\nthree four", "three four\none two")])
    rl = {r["id"]: r["f1"] for r in R.rouge_l(df).collect()}
    ls = {r["id"]: r["f1"] for r in R.rouge_l(df, summary_level=True).collect()}
    assert rl[0] == 1.0 and ls[0] == 1.0
    assert rl[1] == pytest.approx(2 * (2 / 3) * 1 / (2 / 3 + 1))
    assert ls[2] == 1.0 and rl[2] == pytest.approx(0.5)


def test_lcs_random_strings_stable():
    rnd = random.Random(7)
    for _ in range(50):
        a = [rnd.choice("xyz") for _ in range(rnd.randint(0, 80))]
        b = [rnd.choice("xyz") for _ in range(rnd.randint(0, 80))]
        assert lcs.lcs_length(a, b) == dp_lcs(a, b)


def brute_rouge_n(pred, ref, n):
    toks = [[t for t in re.split("[^a-z0-9]+", x.lower()) if t] for x in (pred, ref)]
    a, b = (Counter(tuple(t[i:i + n]) for i in range(len(t) - n + 1)) for t in toks)
    hits = sum((a & b).values())
    p, r = hits / max(sum(a.values()), 1), hits / max(sum(b.values()), 1)
    return 2 * p * r / (p + r) if p + r else 0.0


def test_summary_systems_are_scored_against_whole_texts(spark):
    from topicforge.functions.text import split_sentences
    from topicforge.operators.summary import summarise
    from topicforge.plans.standins import summary_pairs

    sf = "/root/testdata/sf0.001"
    got = {(r["id"], r["system"]): r for r in summary_pairs(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["s"] or [] for r in docs.select("doc_id", split_sentences(F.col("text")).alias("s")).collect()}
    summaries = {r["doc_id"]: r["summary"] for r in summarise(docs, "doc_id", "text").collect()}
    assert len(got) == 3 * len(texts) and max(len(s) for s in texts.values()) > 5
    for (i, system), r in got.items():
        assert r["reference"] == "\n".join(texts[i])
        want = {"lead1": "\n".join(texts[i][:1]), "lead3": "\n".join(texts[i][:3])}.get(system)
        assert r["prediction"] == want if want is not None else r["prediction"].replace("\n", " ") == summaries[i].replace("\n", " ")
    table = {r["system"]: r for r in R.evaluate_summaries(summary_pairs(spark, sf)).collect()}
    for system, r in table.items():
        mine = [x for (_, s), x in got.items() if s == system]
        assert r["pairs"] == len(texts)
        for n, name in ((1, "rouge1"), (2, "rouge2")):
            assert r[name] == pytest.approx(sum(brute_rouge_n(x["prediction"], x["reference"], n) for x in mine) / len(mine))
        assert r["rougeL"] == pytest.approx(sum(lcs.rouge_l(x["prediction"], x["reference"])[2] for x in mine) / len(mine))
        for x in mine[:12]:
            a, b = ([t for t in re.split("[^a-z0-9]+", v.lower()) if t] for v in (x["prediction"], x["reference"]))
            hits = dp_lcs(a, b)
            assert lcs.rouge_l(x["prediction"], x["reference"])[:2] == pytest.approx((hits / max(len(a), 1), hits / max(len(b), 1)))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_pairs_are_scored_without_exchanging_their_texts(spark):
    df = pairs(spark, [("the cat sat", "the cat sat on it"), ("a b", "c d"), (None, "x")])
    scored = R.rouge_n(df, 1)
    assert "Aggregate" not in plan_of(scored) and "Join" not in plan_of(scored)
    assert {r["id"]: r["precision"] for r in scored.collect()} == {0: 1.0, 1: 0.0}


def test_rows_that_repeat_a_key_are_one_pair_to_rouge_n(spark):
    df = spark.createDataFrame([(1, "s", "a b", "a c"), (1, "s", "c", "b b"), (1, "s", None, "a"), (2, "s", "a", "a"),
                                (None, "s", "a", "a a"), (None, "s", "b", "a")],
                               "id long, system string, prediction string, reference string")
    got = {r["id"]: r for r in R.rouge_n(df, 1).collect()}
    assert len(got) == 3 and got[2]["f1"] == 1.0
    assert (got[1]["precision"], got[1]["recall"]) == (pytest.approx(3 / 3), pytest.approx(3 / 4))
    assert (got[None]["precision"], got[None]["recall"]) == (pytest.approx(1 / 2), pytest.approx(1 / 3))
    # The table counts the rows of a key that is not null, each with the key's ROUGE-N.
    row = R.evaluate_summaries(df).collect()[0]
    assert row["pairs"] == 4 and row["rouge1"] == pytest.approx((3 * got[1]["f1"] + 1) / 4)
    assert R.evaluate_summaries(df, with_lcs=False).collect()[0]["pairs"] == 3


def plain_indices(ref, can):
    """The backtrack over the whole table."""
    t = [[0] * (len(can) + 1) for _ in range(len(ref) + 1)]
    for i in range(1, len(ref) + 1):
        for j in range(1, len(can) + 1):
            t[i][j] = t[i - 1][j - 1] + 1 if ref[i - 1] == can[j - 1] else max(t[i - 1][j], t[i][j - 1])
    i, j, out = len(ref), len(can), []
    while i and j:
        if ref[i - 1] == can[j - 1]:
            out, i, j = [i - 1, *out], i - 1, j - 1
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return out


def plain_lsum(pred, ref):
    pred_s, ref_s = (([t for t in re.split("[^a-z0-9]+", s.lower()) if t] for s in x.split("\n") if s) for x in (pred, ref))
    pred_s, ref_s = list(pred_s), list(ref_s)
    p, r = Counter(t for s in pred_s for t in s), Counter(t for s in ref_s for t in s)
    n, m, hits = p.total(), r.total(), 0
    for s in ref_s:
        for i in sorted({i for c in pred_s for i in plain_indices(s, c)}):
            if p[s[i]] > 0 and r[s[i]] > 0:
                hits, p[s[i]], r[s[i]] = hits + 1, p[s[i]] - 1, r[s[i]] - 1
    return (hits / n, hits / m) if n and m else (0.0, 0.0)


SENTENCES = st.lists(st.lists(st.sampled_from("abcdexy"), max_size=8).map(" ".join), max_size=5).map("\n".join)


@settings(max_examples=300, deadline=None)
@given(SENTENCES, SENTENCES)
def test_lsum_equals_the_plain_union_of_backtracks(pred, ref):
    assert lcs.rouge_lsum(pred, ref)[:2] == plain_lsum(pred, ref)


def test_lsum_compares_only_what_can_count(monkeypatch):
    seen, indices = [], lcs.lcs_indices
    monkeypatch.setattr(lcs, "lcs_indices", lambda r, c: seen.append((r, c)) or indices(r, c))
    ref = [f"w{k} x{k}" for k in range(50)] + ["w0 y", "w0 x1"]
    assert lcs.rouge_lsum("\n".join(ref[:10]), "\n".join(ref))[0] == 1.0
    assert len(seen) <= 3  # 520 before: every reference sentence with every predicted one


def test_tokens_of_every_character():
    texts = [f"aB{chr(c)}Z9 {chr(c)}{chr(c)}" for c in range(0x110000) if not 0xd800 <= c < 0xe000]
    assert [lcs.tokenize(t) for t in texts] == [re.sub("[^a-z0-9]+", " ", t.lower()).split() for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcdx"), max_size=12), st.lists(st.sampled_from("abcdy"), max_size=12))
def test_lcs_indices_equal_the_plain_backtrack(ref, can):
    assert lcs.lcs_indices(ref, can) == (list(range(len(ref))) if ref == can else plain_indices(ref, can))


def test_a_used_up_prediction_ends_the_reference():
    looked = []

    class Line(list):
        def __iter__(self):
            looked.append(len(looked))
            return super().__iter__()

    ref = [Line([f"w{k}", "x"]) for k in range(50)]
    assert lcs.rouge_lsum_tokens([["w0", "x"], ["w1", "x"]], ref)[:2] == (1.0, 0.04)
    assert len(looked) <= 8  # each line was read before
