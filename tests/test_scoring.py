import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicforge.functions import arrays as A
from topicforge.operators import distill as D
from topicforge.operators import scoring as S
from topicforge.operators.splits import assign_batches
from topicforge.taxonomy import TOPICS


def test_top_k_ties_and_extremes(spark):
    rows = [(0, [1.0, 1.0, 1.0, 1.0]), (1, [800.0, -800.0, 0.0, 800.0]), (2, [0.1, 0.5, 0.3, 0.2])]
    df = spark.createDataFrame(rows, "id int, z array<double>")
    got = {r["id"]: (r["k"], r["p"]) for r in df.select(
        "id", A.top_k_indices("z", 3).alias("k"), A.softmax_max("z").alias("p")).collect()}
    assert got[0][0] == [0, 1, 2] and got[0][1] == pytest.approx(0.25)
    assert got[1][0] == [0, 3, 2] and got[1][1] == pytest.approx(0.5)
    assert got[2][0] == [1, 2, 3]


def test_binarise_threshold_is_strict(spark):
    df = spark.createDataFrame([([0.0, 1e-9, -1e-9, 800.0, -800.0],)], "z array<double>")
    assert df.select(A.binarise("z").alias("b")).first()["b"] == [0, 1, 0, 1, 0]


def test_argmax_first_max(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([],)], "z array<double>")
    assert [r["a"] for r in df.select(A.argmax("z").alias("a")).collect()] == [1, None]


def test_multi_hot_unknown(spark):
    df = spark.createDataFrame([(["Law", "Sports"],), ([],)], "c array<string>")
    vecs = [r["v"] for r in df.select(A.multi_hot("c").alias("v")).collect()]
    assert vecs[0][TOPICS.index("Law")] == 1 and sum(vecs[0]) == 2 and sum(vecs[1]) == 0
    bad = spark.createDataFrame([(["Nope"],)], "c array<string>")
    with pytest.raises(Exception):
        bad.select(A.multi_hot("c")).collect()
    assert sum(bad.select(A.multi_hot("c", on_unknown="drop").alias("v")).first()["v"]) == 0


def test_batch_mean_differs_on_short_last_batch(spark):
    # 17 rows at size 8: batches of 8, 8, 1; only row 16 is correct
    rows = [(i, [1] if i == 16 else [0], [1]) for i in range(17)]
    df = assign_batches(spark.createDataFrame(rows, "o long, preds array<int>, labels array<int>"), "o", 8)
    r = S.accuracy_report(df).first()
    assert r["accuracy"] == pytest.approx(1 / 17)
    assert r["batch_mean_accuracy"] == pytest.approx((0 + 0 + 1) / 3)


def test_bce_matches_numpy(spark):
    z = np.array([[0.0, 2.0, -3.0], [800.0, -800.0, 0.5]])
    y = np.array([[1, 0, 1], [1, 0, 0]])
    df = spark.createDataFrame([(z[i].tolist(), y[i].tolist()) for i in range(2)], "logits array<double>, labels array<int>")
    got = S.bce_loss(df).first()["loss"]
    expect = np.mean(np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z))))
    assert got == pytest.approx(expect)


def test_validate_top3_labels(spark):
    rows = [
        (0, [], ["Law", "Science", "Sports"]),                        # empty -> good
        (1, ["Law"], ["Law", "Science", "Sports"]),                   # one -> good
        (2, ["Law", "Sports", "Science", "Life"], ["Law", "Science", "Sports"]),  # four -> bad
        (3, ["Unknown"], ["Law", "Science", "Sports"]),               # unknown -> bad
    ]
    df = spark.createDataFrame(rows, "id int, categories array<string>, top_topics array<string>")
    r = S.validate_top3(df).first()
    assert (r["total"], r["good"], r["bad"]) == (4, 2, 2)
    assert r["bad_ratio"] == pytest.approx(0.5) and r["ref_ratio"] == pytest.approx(0.01)
    assert sorted(x["id"] for x in S.bad_rows(df).collect()) == [2, 3]


def test_intent_vote_cases(spark):
    rows = [
        (0, ["Society"]),                       # in two intents -> first of them (Communication)
        (1, ["Energy"]),                        # in none -> Information
        (2, []),                                # no topics -> Information
        (3, ["Law", "Language"]),               # tie Information vs Communication -> Information
        (4, ["Sports", "Food_and_drink", "Law"]),  # Entertainment 2 vs Information 1
    ]
    df = spark.createDataFrame(rows, "id int, t array<string>")
    got = {r["id"]: r["i"] for r in df.select("id", S.intent_vote("t").alias("i")).collect()}
    assert got == {0: "Communication", 1: "Information", 2: "Information", 3: "Information", 4: "Entertainment"}
    from topicforge.taxonomy import intent_frame
    tab = {r["id"]: r["intent"] for r in S.intent_vote_table(df, "id", "t", intent_frame(spark)).collect()}
    assert tab == got


def _np_kl(t, s, T):
    def logsm(x):
        x = np.asarray(x, dtype=float) / T
        m = x.max()
        return x - (m + math.log(np.exp(x - m).sum()))
    lt, ls = logsm(t), logsm(s)
    return float((np.exp(lt) * (lt - ls)).sum())


@pytest.mark.parametrize("T", [1.0, 2.0, 4.0])
def test_kl_matches_numpy(spark, T):
    rows = [([1.0, 2.0, 3.0], [3.0, 2.0, 1.0]), ([800.0, -800.0, 0.0], [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "teacher array<double>, student array<double>")
    got = D.distillation_loss(df, temperature=T, alpha=0.5).first()
    expect = sum(_np_kl(t, s, T) for t, s in rows) / len(rows)
    assert got["kl"] == pytest.approx(expect, rel=1e-9, abs=1e-12)
    assert got["loss"] == pytest.approx(0.5 * T * T * expect, rel=1e-9, abs=1e-12)


def test_kl_identical_zero_and_shape_mismatch(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 2.0])], "teacher array<double>, student array<double>")
    assert D.distillation_loss(df).first()["kl"] == pytest.approx(0.0, abs=1e-12)
    bad = spark.createDataFrame([([1.0, 2.0], [1.0])], "teacher array<double>, student array<double>")
    with pytest.raises(Exception):
        D.distillation_loss(bad).collect()


def test_kl_long_form_divides_by_sequences(spark):
    rows = [(1, 0, [1.0, 2.0], [2.0, 1.0]), (1, 1, [0.5, 0.5], [0.0, 1.0]), (2, 0, [3.0, 0.0], [0.0, 3.0])]
    df = spark.createDataFrame(rows, "id long, pos int, teacher array<double>, student array<double>")
    got = D.distillation_loss(df, temperature=2.0, batch_key="id").first()["kl"]
    expect = sum(_np_kl(t, s, 2.0) for _, _, t, s in rows) / 2
    assert got == pytest.approx(expect)
