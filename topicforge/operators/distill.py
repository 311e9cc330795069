"""Teacher -> student distillation loss.

loss = alpha * student_loss + (1 - alpha) * T^2 * KL(softmax(t/T) || softmax(s/T))

with the KL summed over classes (and positions, for sequence logits)
and divided by the number of batch rows (``batchmean``).  Per-row KL is
an array expression; the dataset total is one global aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from topicforge.constants import DISTIL_ALPHA, DISTIL_TEMPERATURE



def row_kl(teacher: Column, student: Column, temperature: float) -> Column:
    """sum_c p_t(c) * (log p_t(c) - log p_s(c)) for one logit row, in one
    pass over the zipped rows (online max-shifted sums), so no
    per-row quantity is re-evaluated per class.  Raises when the widths
    differ.

    KL = W / St - (mt + log St) + (ms + log Ss) with
    St = sum exp(a - mt), W = sum exp(a - mt) * (a - b), Ss = sum exp(b - ms).
    """
    inv_t = 1.0 / temperature
    init = F.struct(
        F.lit(float("-inf")).alias("mt"), F.lit(0.0).alias("st"), F.lit(0.0).alias("w"),
        F.lit(float("-inf")).alias("ms"), F.lit(0.0).alias("ss"),
    )

    def step(acc, p):
        a = p["t"] * F.lit(inv_t)
        b = p["s"] * F.lit(inv_t)
        up_t = a > acc["mt"]
        scale = F.exp(acc["mt"] - a)
        e = F.exp(a - acc["mt"])
        up_s = b > acc["ms"]
        return F.struct(
            F.when(up_t, a).otherwise(acc["mt"]).alias("mt"),
            F.when(up_t, acc["st"] * scale + F.lit(1.0)).otherwise(acc["st"] + e).alias("st"),
            F.when(up_t, acc["w"] * scale + (a - b)).otherwise(acc["w"] + e * (a - b)).alias("w"),
            F.when(up_s, b).otherwise(acc["ms"]).alias("ms"),
            F.when(up_s, acc["ss"] * F.exp(acc["ms"] - b) + F.lit(1.0))
            .otherwise(acc["ss"] + F.exp(b - acc["ms"])).alias("ss"),
        )

    def finish(acc):
        return (acc["w"] / acc["st"] - (acc["mt"] + F.log(acc["st"]))
                + (acc["ms"] + F.log(acc["ss"])))

    check = F.assert_true(F.size(teacher) == F.size(student), "teacher/student logit widths differ")
    kl = F.aggregate(F.arrays_zip(teacher.alias("t"), student.alias("s")), init, step, finish)
    return F.when(check.isNull(), kl)


def distillation_loss(df: DataFrame, teacher: str = "teacher", student: str = "student",
                      student_loss: str | None = None, temperature: float = DISTIL_TEMPERATURE,
                      alpha: float = DISTIL_ALPHA,
                      batch_key: str | None = None) -> DataFrame:
    """Kl (batchmean), loss.  ``student_loss`` is a per-row hard-label
    loss column (averaged); without it the hard part is 0.

    Long-form sequence logits (one row per (id, position)) are handled
    with ``batch_key=id``: the KL sum is divided by the number of
    distinct ids instead of rows."""
    kl = row_kl(F.col(teacher), F.col(student), temperature)
    rows = F.count_distinct(F.col(batch_key)) if batch_key else F.count(F.lit(1))
    hard = F.avg(F.col(student_loss)) if student_loss else F.lit(0.0)
    agg = df.agg((F.sum(kl) / rows).alias("kl"), hard.alias("_hard"))
    return agg.select(
        "kl",
        (F.lit(alpha) * F.col("_hard") + F.lit(1.0 - alpha) * F.lit(temperature ** 2) * F.col("kl")).alias("loss"),
    )
