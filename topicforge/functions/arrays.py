"""Array scalars over label vectors and logits.

All are higher-order-function expressions (``transform``, ``aggregate``,
``array_sort``) evaluated per row on the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicforge.constants import THRESHOLD, TOP_K_TOPICS
from topicforge.taxonomy import TOPICS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid(x: Column) -> Column:
    """1 / (1 + exp(-x)); Spark has no built-in sigmoid."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def binarise(logits: Column | str, threshold: float = THRESHOLD) -> Column:
    """``sigmoid(z) > threshold`` strictly, as 0/1 ints."""
    return F.transform(_col(logits), lambda z: (sigmoid(z) > F.lit(threshold)).cast("int"))


def argmax(arr: Column | str) -> Column:
    """0-based index of the first maximum (null for an empty array)."""
    a = _col(arr)
    return (F.array_position(a, F.array_max(a)) - F.lit(1)).cast("int")


def multi_hot(categories: Column | str, names: Sequence[str] = TOPICS,
              on_unknown: str = "error") -> Column:
    """Width-``len(names)`` 0/1 vector with 1 at each category's index.

    ``on_unknown="error"`` raises for a name outside ``names`` (as the
    reference's KeyError does); ``"drop"`` ignores such names.  The vector
    is unrolled over the fixed names, so ``categories`` is never
    re-evaluated inside a lambda.
    """
    cats = _col(categories)
    lits = F.array(*[F.lit(n) for n in names])
    vec = F.array(*[F.array_contains(cats, F.lit(n)).cast("int") for n in names])
    if on_unknown == "drop":
        return vec
    if on_unknown != "error":
        raise ValueError("on_unknown must be 'error' or 'drop'")
    unknown = F.size(F.array_except(cats, lits)) > 0
    return F.when(unknown, F.raise_error(F.concat(
        F.lit("unknown category in "), F.array_join(cats, ",")))
    ).otherwise(vec)


def topic_id(name: Column | str, names: Sequence[str] = TOPICS) -> Column:
    """B20 name -> index (null when unknown)."""
    lits = F.array(*[F.lit(n) for n in names])
    pos = F.array_position(lits, _col(name))
    return F.when(pos > 0, (pos - 1).cast("int"))


def topic_name(idx: Column | str, names: Sequence[str] = TOPICS) -> Column:
    """B20 index -> name (null when out of range)."""
    lits = F.array(*[F.lit(n) for n in names])
    return F.get(lits, _col(idx))


def top_k_indices(logits: Column | str, k: int = TOP_K_TOPICS) -> Column:
    """E3 core: indices of the ``k`` largest values, descending; ties go
    to the lower index.  Softmax is monotone, so ranking the logits is
    the same as ranking the probabilities."""
    z = _col(logits)
    pairs = F.transform(z, lambda v, i: F.struct((-v).alias("neg"), i.alias("idx")))
    ranked = F.array_sort(pairs)
    return F.transform(F.slice(ranked, 1, k), lambda s: s["idx"])


def top_k_names(logits: Column | str, k: int = TOP_K_TOPICS, names: Sequence[str] = TOPICS) -> Column:
    lits = F.array(*[F.lit(n) for n in names])
    return F.transform(top_k_indices(logits, k), lambda i: F.get(lits, i))


def log_sum_exp(z: Column) -> Column:
    """Max-shifted log(sum(exp(z))) in one pass."""
    return F.aggregate(_col(z), F.struct(F.lit(float("-inf")).alias("m"), F.lit(0.0).alias("s")),
                       lambda acc, v: F.struct(
                           F.when(v > acc["m"], v).otherwise(acc["m"]).alias("m"),
                           F.when(v > acc["m"], acc["s"] * F.exp(acc["m"] - v) + F.lit(1.0))
                           .otherwise(acc["s"] + F.exp(v - acc["m"])).alias("s")),
                       lambda acc: acc["m"] + F.log(acc["s"]))


def softmax_max(logits: Column | str) -> Column:
    """Largest softmax probability = 1 / sum(exp(z - max z))."""
    return F.aggregate(_col(logits), F.struct(F.lit(float("-inf")).alias("m"), F.lit(0.0).alias("s")),
                       lambda acc, v: F.struct(
                           F.when(v > acc["m"], v).otherwise(acc["m"]).alias("m"),
                           F.when(v > acc["m"], acc["s"] * F.exp(acc["m"] - v) + F.lit(1.0))
                           .otherwise(acc["s"] + F.exp(v - acc["m"])).alias("s")),
                       lambda acc: F.lit(1.0) / acc["s"])


def to_double_array(arr: Column | str) -> Column:
    return _col(arr).cast("array<double>")
