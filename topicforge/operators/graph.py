"""Category graph walk, quotas and label merging.

The graph is two tables: ``edges(parent, child)`` between categories and
``members(category, page_id)`` from categories to pages.  The walk is a
breadth-first frontier loop from all roots at once: a row holds a category
and a bitmap of the roots that reach it (one row for each ``BANK`` roots),
and a level is the bitwise or of the bitmaps over the edges, less what was
reached before.  So the frontier grows with the categories, not with roots
times categories.  Each level's rows are written with a reliable
checkpoint, so the lineage stays one level deep and a lost executor costs
one level, not the whole walk.

Per-root quotas are exact top-k by (depth, page_id).  Because there are
only a few roots, a root can hold a third of all candidates; the top-k
is therefore done in two salted stages so no task ever sees more than
``SALT_BUCKETS * limit`` rows of one root.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from topicforge.operators.skew import top_k_per_group
from topicforge.operators.splits import dense_ordinal
from topicforge.session import reliable_checkpoint


#: Roots of one bitmap.
BANK = 64


def _by_key(df: DataFrame, *key: str) -> DataFrame:
    """Stored once, sorted by ``key``, and dealt by ranges of it, which part the rows of a hot first column."""
    return reliable_checkpoint(df.select(*key).distinct().repartitionByRange(*key).sortWithinPartitions(*key))


def _numbered(roots: DataFrame, root: str) -> DataFrame:
    """root, and its place in the bitmaps: bank and bit."""
    names = dense_ordinal(roots.select(F.col(root).alias("root")).where(F.col("root").isNotNull()).distinct(), "root", "_n")
    return reliable_checkpoint(names.select("root", F.floor(F.col("_n") / BANK).alias("bank"), (F.col("_n") % BANK).cast("int").alias("bit")))


def _any(rows: DataFrame, *key: str) -> DataFrame:
    return rows.groupBy(*key).agg(F.bit_or("mask").alias("mask"))


def _unseen(rows: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """The bits of ``rows`` that are new, by ``key`` and bank."""
    before = _any(seen, key, "bank").withColumnRenamed("mask", "_seen")
    new = _any(rows, key, "bank").join(before, [key, "bank"], "left")
    mask = F.col("mask").bitwiseAND(F.bitwise_not(F.coalesce("_seen", F.lit(0).cast("bigint"))))
    return new.select(key, "bank", mask.alias("mask")).where("mask <> 0")


def _roots_of(rows: DataFrame, numbered: DataFrame, key: str) -> DataFrame:
    """One row a set bit: (root, key, depth)."""
    return rows.join(numbered, "bank").where("getbit(mask, bit) = 1").select("root", key, "depth")


def _start(numbered: DataFrame) -> DataFrame:
    own = numbered.select(F.col("root").alias("category"), "bank", F.expr("shiftleft(1L, bit)").alias("mask"))
    return _any(own, "category", "bank").withColumn("depth", F.lit(0))


def _next(level: DataFrame, edges: DataFrame, reached: DataFrame, depth: int) -> DataFrame:
    over = level.join(edges, level["category"] == edges["parent"]).select(F.col("child").alias("category"), "bank", "mask")
    return reliable_checkpoint(_unseen(over, reached, "category").withColumn("depth", F.lit(depth)))


def category_closure(edges: DataFrame, roots: DataFrame, max_depth: int = 10,
                     root: str = "root") -> DataFrame:
    """(root, category, depth) for every category reachable from a
    root within ``max_depth`` steps, at its smallest depth.

    Cycle-safe: a category already reached from a root is never expanded
    for it again, and the loop stops early when a level adds nothing."""
    e, numbered = _by_key(edges, "parent", "child"), _numbered(roots, root)
    level = reliable_checkpoint(_start(numbered))
    reached = level
    for depth in range(1, max_depth + 1):
        level = _next(level, e, reached, depth)
        if level.isEmpty():
            break
        reached = reached.unionByName(level)
    return _roots_of(reached, numbered, "category")


def root_pages(closure: DataFrame, members: DataFrame) -> DataFrame:
    """Candidate pages per root at their smallest depth: (root, page_id, depth).
    The aggregate is keyed by (root, page_id), which spreads a hot root."""
    m = members.select("category", "page_id")
    return (
        closure.join(m, "category")
        .groupBy("root", "page_id")
        .agg(F.min("depth").alias("depth"))
    )


def quota_pages(candidates: DataFrame, limit: int = 2000) -> DataFrame:
    """Per root, at most ``limit`` distinct pages, nearest levels first
    (ties by page_id)."""
    return top_k_per_group(candidates, "root", [F.col("depth"), F.col("page_id")], limit).drop("_rank")


def _full(seen: DataFrame, numbered: DataFrame, limit: int) -> DataFrame:
    """A bitmap a bank of the roots that hold ``limit`` pages or more: at most one row for ``BANK`` roots."""
    held = seen.join(numbered, "bank").where("getbit(mask, bit) = 1").groupBy("bank", "bit").agg(F.count(F.lit(1)).alias("n"))
    return held.where(F.col("n") >= limit).groupBy("bank").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("_full"))


def walk_with_quota(edges: DataFrame, roots: DataFrame, members: DataFrame, limit: int = 2000,
                    max_depth: int = 10) -> DataFrame:
    """C1+C2 with the reference's early stop: a root whose quota is already
    filled by levels <= d is not expanded further.  Returns the same rows
    as ``quota_pages(root_pages(category_closure(...)))``.

    Pages carry bitmaps of roots like categories do.  Full roots are bits
    of a table that is joined to the frontier; nothing is collected.  Edges
    and members are stored once and read by every level."""
    e, m = _by_key(edges, "parent", "child"), _by_key(members, "category", "page_id")
    numbered = _numbered(roots, "root")

    def pages_of(level: DataFrame, seen: DataFrame, depth: int) -> DataFrame:
        met = level.join(m, "category").select("page_id", "bank", "mask")
        return reliable_checkpoint(_unseen(met, seen, "page_id").withColumn("depth", F.lit(depth)))

    level = reliable_checkpoint(_start(numbered))
    reached = level
    nothing = m.select("page_id", F.lit(0).cast("bigint").alias("bank"), F.lit(0).cast("bigint").alias("mask")).limit(0)
    seen = pages_of(level, nothing, 0)
    for depth in range(1, max_depth + 1):
        open_ = F.col("mask").bitwiseAND(F.bitwise_not(F.coalesce("_full", F.lit(0).cast("bigint"))))
        frontier = level.join(_full(seen, numbered, limit), "bank", "left").select("category", "bank", open_.alias("mask")).where("mask <> 0")
        level = _next(frontier, e, reached, depth)
        if level.isEmpty():
            break
        reached = reached.unionByName(level)
        seen = seen.unionByName(pages_of(level, seen, depth))
    return quota_pages(_roots_of(seen, numbered, "page_id"), limit)


def merge_labels(hits: DataFrame, key: str = "page_id", label: str = "root",
                 out: str = "categories") -> DataFrame:
    """One row per page with the sorted set of roots that reached it.
    A page's set is bounded by the number of roots."""
    return hits.groupBy(key).agg(F.array_sort(F.collect_set(F.col(label))).alias(out))


def upsert_pages(existing: DataFrame, incoming: DataFrame, key: str = "page_id",
                 fields: tuple[str, ...] = ("title", "summary", "text"),
                 categories: str = "categories", order: str | None = None) -> DataFrame:
    """C4: merge incoming pages into the stored table.

    A known page keeps its stored fields (even a null one) and gains the
    incoming categories; a new page is inserted with the fields of its
    first arrival: the incoming row with the smallest ``order`` (equal
    orders, or none given: the smallest fields).  The result is a new
    table (write it to a new path)."""
    arrival = [F.col(order).alias("_o")] if order else []
    inc = incoming.groupBy(key).agg(
        F.min(F.struct(*arrival, F.struct(*[F.col(f) for f in fields]).alias("f")))["f"].alias("_f"),
        # collect_set is deduplicated map-side: a page met a million times with
        # the same labels contributes one array, not a million
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.col(categories))))).alias("_c"),
    )
    ex = existing.select(key, F.struct(*[F.col(f) for f in fields]).alias("_e"),
                         F.col(categories).alias("_ec"), F.lit(True).alias("_known"))
    j = ex.join(inc, key, "full_outer")
    known = F.coalesce(F.col("_known"), F.lit(False))
    cols = [F.when(known, F.col(f"_e.{f}")).otherwise(F.col(f"_f.{f}")).alias(f) for f in fields]
    empty = F.array().cast("array<string>")
    cats = F.array_sort(F.array_union(F.coalesce("_ec", empty), F.coalesce("_c", empty))).alias(categories)
    return j.select(key, *cols, cats)


def visit_counts(memberships: DataFrame, key: str = "page_id", label: str = "root") -> DataFrame:
    """Times each page was met over all memberships, and by how many roots."""
    return memberships.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_visits"),
        F.countDistinct(F.col(label)).alias("n_roots"),
    )


def page_categories(pages: DataFrame, links: DataFrame, key: str = "page_id") -> DataFrame:
    """Resolve page ids to their category memberships (equi-join;
    AQE turns it into a broadcast join when a side is measured small)."""
    return pages.join(links, key)
