"""Skew-safe building blocks shared by the operators.

* ``top_k_per_group``: exact top-k per group in two salted stages, so a
  group holding a third of all rows is ranked by many tasks, and the
  final ranking task sees at most ``buckets * k`` rows of it.  The salt is
  the number of the map task, so that a task's local top-k before the
  first shuffle is ``k`` rows a group.
* ``salted_join``: equi-join a large table to a per-key lookup table
  when the lookup is too large to broadcast; the large side is spread
  over ``buckets`` salts and the lookup replicated per salt, so a hot key
  is split across tasks.
* ``lookup_join``: broadcast when the lookup's row count is proven below
  a bound, salted shuffle join otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicforge.session import tune_for_group_limits

SALT_BUCKETS = 64
BROADCAST_MAX_ROWS = 2_000_000


def top_k_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column], k: int,
                    buckets: int = SALT_BUCKETS) -> DataFrame:
    """Rows ranked 1..k within each group by ``order`` (exact).

    ``order`` must be a total order within the group.  Both stages are
    ``row_number() <= k`` windows, planned as partial window-group-limits
    before their shuffles: a map task gives out ``k`` rows of a group at
    most.  Which task a row is in decides no result."""
    groups = [group] if isinstance(group, str) else list(group)
    tune_for_group_limits(df.sparkSession, k)
    salted = df.withColumn("_salt", F.spark_partition_id() % buckets)
    w1 = Window.partitionBy(*groups, "_salt").orderBy(*order)
    stage1 = salted.withColumn("_rn", F.row_number().over(w1)).where(F.col("_rn") <= k).drop("_rn", "_salt")
    w2 = Window.partitionBy(*groups).orderBy(*order)
    return stage1.withColumn("_rank", F.row_number().over(w2)).where(F.col("_rank") <= k)


def global_top_k(df: DataFrame, order: Sequence[Column], k: int, buckets: int = SALT_BUCKETS) -> DataFrame:
    """The first ``k`` rows of ``df`` in ``order`` with their 1-based
    ``_rank``.  Unlike ``orderBy().limit(k)``, whose single final task reads
    every partition's local top-k, the final task here reads at most
    ``buckets * k`` rows."""
    one = df.withColumn("_all", F.lit(0))
    return top_k_per_group(one, "_all", order, k, buckets).drop("_all")


def salted_join(big: DataFrame, lookup: DataFrame, on: str, spread: Sequence[str],
                how: str = "left", buckets: int = SALT_BUCKETS) -> DataFrame:
    salted_big = big.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in spread]), F.lit(buckets)))
    salted_lookup = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return salted_big.join(salted_lookup, [on, "_salt"], how).drop("_salt")


def lookup_join(big: DataFrame, lookup: DataFrame, on: str, spread: Sequence[str],
                how: str = "left", lookup_rows: int | None = None,
                max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``big`` to a one-row-per-key ``lookup``.  The lookup is
    broadcast only when its row count (given, or counted here) is at most
    ``max_broadcast_rows``."""
    if lookup_rows is None:
        lookup_rows = lookup.count()
    if lookup_rows <= max_broadcast_rows:
        return big.join(F.broadcast(lookup), on, how)
    return salted_join(big, lookup, on, spread, how)
