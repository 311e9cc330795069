"""Splits and sampling.

The train/test split is a stable hash of the key, computed per row: no
shuffle, no global row numbering, the same answer on any partitioning
and in any engine that has md5.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicforge.constants import BATCH_SIZE, TEST_SHARE
from topicforge.session import reliable_checkpoint


def hash32(key: Column | str) -> Column:
    """0..2^32-1: the first 32 bits of md5(key as string)."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")


def train_test_split(df: DataFrame, key: str, test: float = TEST_SHARE, split_col: str = "split") -> DataFrame:
    """``split`` = ``test`` for about ``test`` of the rows, else ``train``.
    Expected, not exact, proportions; stable across runs and partitionings."""
    cut = int(round(test * (1 << 32)))
    return df.withColumn(
        split_col, F.when(hash32(key) < F.lit(cut), F.lit("test")).otherwise(F.lit("train"))
    )


def split_sizes(df: DataFrame, split_col: str = "split") -> DataFrame:
    """D3: rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n"))


def slice_size(n: int, percent: float) -> int:
    """Rows in the first ``percent`` % of ``n`` (nearest, ties to even)."""
    return int(round(n * percent / 100.0))


def dense_ordinal(df: DataFrame, key: str, out: str = "ordinal") -> DataFrame:
    """0-based position of each row in ``key`` order (``key`` unique),
    without a single-partition window: range-partition, number rows
    inside each partition, and add the partition's offset (a prefix sum
    over one row per partition, broadcast -- bounded by the partition
    count).

    The numbered frame is written once and read back, so that the counts
    and the rows see the same partitions whatever the planner does with
    either of them."""
    ranged = df.repartitionByRange(F.col(key)).sortWithinPartitions(F.col(key))
    ranged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_local", F.monotonically_increasing_id()
    )
    ranged = reliable_checkpoint(
        ranged.withColumn("_local", F.col("_local") - F.shiftleft(F.col("_pid").cast("bigint"), 33)))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = counts.withColumn(
        "_off", F.sum("_cnt").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1))
    ).select("_pid", F.coalesce(F.col("_off"), F.lit(0)).alias("_off"))
    ranked = ranged.join(F.broadcast(offsets), "_pid")
    return ranked.withColumn(out, F.col("_off") + F.col("_local")).drop("_pid", "_local", "_off")


#: Bins of a histogram round: what the driver sees of the data.
BINS = 4096


def _kth(values: DataFrame, k: int, lo: int, hi: int) -> tuple[int, int, int]:
    """The k-th smallest of the bigints ``v`` between lo and hi, how many are smaller and how many equal: by
    histograms over ranges that shrink ``BINS`` times a round."""
    below = 0
    while True:
        width = (hi - lo) // BINS + 1
        # decimals: differences of bigints may not be bigints
        bins = values.where(F.col("v").between(lo, hi)).groupBy(
            F.expr(f"(cast(v AS decimal(20,0)) - cast('{lo}' AS decimal(20,0))) div cast('{width}' AS decimal(20,0))").alias("bin")).count()
        for bin_, n in sorted((int(r["bin"]), r["count"]) for r in bins.collect()):
            if below + n >= k:
                break
            below += n
        lo, hi = lo + bin_ * width, min(hi, lo + (bin_ + 1) * width - 1)
        if lo == hi:
            return lo, below, n


def first_rows(df: DataFrame, key: str, k: int) -> DataFrame:
    """The first ``k`` rows in ``key`` order (an integer column; nulls first), as a filter of ``df``: only
    histograms of the key move, at most six rounds of them, whatever ``k``.  Among rows of the
    boundary key those with the smallest hash of all columns are taken, and of equal rows as many as are due."""
    values = df.select(F.col(key).cast("bigint").alias("v"))
    n, nulls, lo, hi = values.agg(F.count(F.lit(1)), F.count_if(F.col("v").isNull()), F.min("v"), F.max("v")).first()
    if k >= n:
        return df
    if k <= 0:
        return df.where(F.lit(False))
    if k <= nulls:
        before, tied, due, equal = F.lit(False), F.col(key).isNull(), k, nulls
    else:
        t, below, equal = _kth(values, k - nulls, lo, hi)
        before, tied, due = F.col(key).isNull() | (F.col(key) < t), F.col(key) == t, k - nulls - below
    if due == equal:
        return df.where(before | tied)
    row = F.xxhash64(*[F.col(c) for c in df.columns])
    ties = df.where(tied).select(row.alias("v"))
    low, high = ties.agg(F.min("v"), F.max("v")).first()
    h, below, equal = _kth(ties, due, low, high)
    if below + equal == due:
        return df.where(before | (tied & (row <= h)))
    return df.where(before | (tied & (row < h))).unionByName(df.where(tied & (row == h)).limit(due - below))


_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def percent_slice(df: DataFrame, key: str, percent: float) -> DataFrame:
    """The first ``percent`` % of ``df`` in ``key`` order (``train[:p%]``).

    With an integer key the cut is found by distributed selection
    (``first_rows``) and no row moves; other keys are cut by a global rank
    built from per-partition counts (``dense_ordinal``)."""
    k = slice_size(df.count(), percent)
    if dict(df.dtypes)[key] in _INTEGERS:
        return first_rows(df, key, k)
    return dense_ordinal(df, key, "_ord").where(F.col("_ord") < F.lit(k)).drop("_ord")


def assign_batches(df: DataFrame, ordinal: str, size: int = BATCH_SIZE, batch_col: str = "batch") -> DataFrame:
    """Fixed-size batches in row order from a caller-supplied dense
    0-based ordinal (never a global row_number)."""
    return df.withColumn(batch_col, F.floor(F.col(ordinal) / F.lit(size)).cast("bigint"))
