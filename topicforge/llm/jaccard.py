"""Operator 8: n-gram Jaccard join as a blocked sparse matrix product.

Documents are rows and distinct word shingles columns of an incidence matrix; the product of the matrix with
its transpose holds the overlaps.  Only what can reach the threshold is multiplied out:

1. Rows with the same set are one class; its smallest doc_id stands for it.
2. Of each row only the first columns in a global order are kept: of a set of n, any partner must share one
   of the first n - ceil(t n) + 1.  The order puts frequent columns last (counted over all documents), so
   that common lines and passages hardly ever serve as meeting point.
3. The product of these columns, blocked by column, accumulates the overlap of every pair that meets.  With
   p kept columns and n in all, the whole overlap is at most the accumulated one plus the larger n - p; pairs
   whose sizes demand more are discarded.  A column that one row alone has cannot add to any overlap, so the
   number of the others bounds the overlap of a row before any pair is formed, and rows with too few go.
4. The pairs left are multiplied out over all columns, and linked if they reach the threshold.

A large group of near copies would meet in nearly all pairs.  So the product is first taken with one row of
each column only: the one with the largest share of frequent columns, which is likely what the others were
copied from.  Rows that have ``FAMILY_PERCENT`` in common with it form a family.  Families that are not yet one component are multiplied out in square blocks of rows,
in memory, from which only a spanning forest of the links comes out; pairs of different families are joined
by column as above.  A pair inside a component cannot change the result, so none that matters is lost.

Defined results: a null or empty text, or one without words, has an empty set and is linked with nothing; a
text with fewer words than a shingle is one shingle; rows that repeat a doc_id count as one document (the
union of what they link); a null doc_id is left out; other columns are ignored; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicforge.llm.batches import free_names, id_text, map_arrow, map_batches, per_task, record, slices, texts_of
from topicforge.llm.components import components
from topicforge.llm.shingles import Words
from topicforge.session import reliable_checkpoint

SHINGLE, PERCENT = 5, 80
#: Columns in so many documents or more come last in the order; of them at most the ``MOST_FREQUENT`` most
#: frequent, which bounds what is broadcast.  Any choice gives the same links; it only moves work.
FREQUENT, MOST_FREQUENT = 32, 400_000
EXTRA = 8
#: Up to so many documents or pairs, their ids are broadcast to fetch texts and sets; beyond, these are shuffled to the ids.
BROADCAST_IDS = 1_000_000
#: Rows that have so many percent in common with the row they are first compared with form a family.
FAMILY_PERCENT = 30
#: A block of a family: at most about so many rows, and so many entries of the matrix; columns go by blocks too.
BLOCK_ROWS, BLOCK_ENTRIES, COLUMN_BLOCK = 1024, 2_000_000, 2048
#: Parts into which the rows that are compared with one row are dealt.
SALTS = 64


def prefix_size(n: int, percent: int) -> int:
    """How many columns of a row with n are kept: n - ceil(percent n / 100) + 1 must be, ``EXTRA`` more
    sharpen the bound on what is not kept."""
    return min(n, n - -(-(percent * n) // 100) + 1 + EXTRA)


def _needed(a: Column, b: Column, percent: int) -> Column:
    """The least overlap at which sizes a and b reach the threshold: ceil(percent (a + b) / (100 + percent))."""
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100 + percent)).cast("bigint")


def _can_reach(percent: int, over: Column) -> Column:
    """Whether rows x and y (size n, last kept column e) can reach the threshold if they share ``over`` kept
    columns.  What they share beyond stands, in the row whose kept columns end first, after its end."""
    xn, yn = F.col("x.n"), F.col("y.n")
    rest = lambda n: F.greatest(F.lit(0), F.ceil(F.lit(percent) * n / F.lit(100)).cast("bigint") - 1 - EXTRA)
    return ((F.lit(100) * F.least(xn, yn) >= F.lit(percent) * F.greatest(xn, yn))
            & (over + F.when(F.col("x.e") <= F.col("y.e"), rest(xn)).otherwise(rest(yn)) >= _needed(xn, yn, percent)))


def least_shared(n: Column, percent: int) -> Column:
    """How many kept columns a row of size n must have in common with others to link with any.  Of sizes that
    can link, each is at least ``percent`` percent of the other, and so is the overlap of each: what
    ``_can_reach`` asks of a pair is never less than this asks of either row."""
    share = lambda m: F.ceil(F.lit(percent) * m / F.lit(100)).cast("bigint")
    return F.least(share(share(n)), F.lit(1 + EXTRA))


def _frequent(rows: DataFrame, size: int, percent: int) -> np.ndarray:
    """The frequent columns, counted over the columns that an order by hash alone would keep."""

    @per_task
    def start():
        def each(b: pa.RecordBatch) -> pa.RecordBatch:
            kept = [s[:prefix_size(len(s), percent)] for s in (Words(t).shingles(size) for t in texts_of(b)) if len(s)]
            h, n = np.unique(np.concatenate(kept), return_counts=True) if kept else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            return record(h=pa.array(h.view(np.int64)), n=pa.array(n))

        return each

    counts = map_batches(rows, start, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    found = [r[0] for r in counts.orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).select("h").collect()]
    return np.sort(np.array(found, dtype=np.int64).view(np.uint64))


def shingle_sets(rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, n, common, e, s1, s2, kept array<bigint>): size of the set, how many frequent columns it
    has, the place of the last column kept, its 128-bit digest, and the columns kept."""
    shared = rows.sparkSession.sparkContext.broadcast(_frequent(rows, size, percent))

    @per_task
    def start():
        frequent = shared.value

        def each(b: pa.RecordBatch) -> pa.RecordBatch:
            n, common, digests, kept, edge = [], [], [], [], []
            for t in texts_of(b):
                s = Words(t).shingles(size)
                n.append(len(s))
                digests.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=np.int64))
                last = np.zeros(len(s), dtype=bool)
                if len(frequent) and len(s):
                    at = np.searchsorted(frequent, s)
                    last = frequent[np.minimum(at, len(frequent) - 1)] == s
                common.append(int(last.sum()))
                columns = np.concatenate([s[~last], s[last]])[:prefix_size(len(s), percent) if len(s) else 0]
                kept.append(columns.view(np.int64))
                # the last one's place in the order, as a number that compares like it
                edge.append((int(columns[-1]) >> 2) + (len(columns) > len(s) - common[-1]) * (1 << 62) if len(s) else 0)
            d = np.array(digests).reshape(-1, 2)
            return record(doc_id=b.column(0), n=pa.array(n, pa.int64()), common=pa.array(common, pa.int64()), e=pa.array(edge, pa.int64()), s1=pa.array(d[:, 0]), s2=pa.array(d[:, 1]),
                          kept=pa.array(kept, pa.list_(pa.int64())))

        return each

    return map_batches(rows, start, "doc_id bigint, n bigint, common bigint, e bigint, s1 bigint, s2 bigint, kept array<bigint>")


def column_sets(ids: DataFrame, rows: DataFrame, size: int) -> DataFrame:
    """(doc_id, cols binary): the whole sets of the documents in ``ids`` (doc_id)."""
    ids = reliable_checkpoint(ids.distinct())
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")

    def each(b: pa.RecordBatch) -> pa.RecordBatch:
        return record(doc_id=b.column(0), cols=pa.array([Words(t).shingles(size).tobytes() for t in texts_of(b)], pa.binary()))

    return reliable_checkpoint(map_batches(rows.join(side, "doc_id").select("doc_id", "text"), each, "doc_id bigint, cols binary"))


def overlaps(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """(a, b, percent double) of the ``pairs`` (a, b) that reach ``least`` percent, multiplied out over all
    columns.  Each b goes, with its whole set, to where a's set is; many b for one a are dealt over
    ``SALTS`` parts."""
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(SALTS)).alias("salt"))
    wanted = (salted.select(F.col("b").alias("doc_id"), "a", "salt", F.lit(1).alias("role"))
              .unionByName(salted.select(F.col("a").alias("doc_id"), "a", "salt", F.lit(0).alias("role")).distinct()))
    # Whole sets travel once, to where they are compared, and not to the pairs first.
    side = F.broadcast(wanted) if 2 * pairs.count() <= BROADCAST_IDS else wanted
    met = (sets.join(side, "doc_id").select("a", "salt", "role", "doc_id", "cols")
           .repartition("a", "salt").sortWithinPartitions("a", "salt", "role"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, ours = None, []
        for batch in batches:
            out = []
            for a, salt, role, doc, raw in zip(*(c.to_pylist() for c in batch.columns)):
                cols = np.frombuffer(raw, dtype=np.uint64)
                if (a, salt) != at:
                    at, ours = (a, salt), []
                if role == 0:
                    ours.append(cols)  # one set, but for rows that repeat a doc_id with other texts
                    continue
                best = 0.0
                for mine in ours:
                    k = len(np.intersect1d(mine, cols, assume_unique=True))
                    if 100 * k >= least * (len(mine) + len(cols) - k):
                        best = max(best, 100 * k / (len(mine) + len(cols) - k))
                if best:
                    out.append((a, doc, best))
            yield record(a=pa.array([r[0] for r in out], pa.int64()), b=pa.array([r[1] for r in out], pa.int64()),
                         percent=pa.array([r[2] for r in out], pa.float64()))

    return map_arrow(met, compare, "a bigint, b bigint, percent double").groupBy("a", "b").agg(F.max("percent").alias("percent"))


def block_product(sets: list[np.ndarray], first: int) -> np.ndarray:
    """Overlap counts of the first ``first`` sets with the sets from there on (with themselves if there are
    no others), accumulated over blocks of columns."""
    right = first if first < len(sets) else 0
    cols, where, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    kept = n[where] > 1  # a column of one row adds to no overlap
    at = np.cumsum(n > 1) - 1
    row, col = row[kept], at[where[kept]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    total = np.zeros((first, len(sets) - right), dtype=np.float32)
    for k in range(0, int(col[-1]) + 1 if len(col) else 0, COLUMN_BLOCK):
        i, j = np.searchsorted(col, [k, k + COLUMN_BLOCK])
        part = np.zeros((len(sets), COLUMN_BLOCK), dtype=np.float32)
        part[row[i:j], col[i:j] - k] = 1
        total += part[:first] @ part[right:].T
    return total.astype(np.int64)


def family_links(families: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that tie the components of each family together.  ``families``: doc_id, family,
    component, n.  A family is cut into blocks of bounded rows and columns, and every pair of blocks is a
    task's group; of its links a spanning forest of the components comes out."""
    blocks = families.groupBy("family").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("n") / BLOCK_ENTRIES)).cast("bigint").alias("blocks"))
    owned = families.join(blocks, "family").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
    side = F.broadcast(owned) if families.count() <= BROADCAST_IDS else owned
    placed = (sets.join(side, "doc_id")
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
              .select("family", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                      (F.col("own") > F.col("other")).alias("second"), "doc_id", "component", "cols"))
    dealt = placed.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "second", "doc_id")

    def forest(group: list[tuple]) -> list[tuple[int, int]]:
        sets_ = [np.frombuffer(r[6], dtype=np.uint64) for r in group]
        first = sum(not r[3] for r in group)
        overlap = block_product(sets_, first)
        right = first if first < len(group) else 0
        n = np.array([len(x) for x in sets_])
        link = 100 * overlap >= percent * (n[:first, None] + n[None, right:] - overlap)
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = x = up[up[x]]
            return x

        out = []
        for x, y in zip(*np.nonzero(link)):
            p, q = group[x], group[right + y]
            if (a := top(p[5])) != (b := top(q[5])):
                up[a] = b
                out.append((min(p[4], q[4]), max(p[4], q[4])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []

        def shut() -> pa.RecordBatch:
            out = forest(group) if len(group) > 1 and any(not r[3] for r in group) else []
            return record(a=pa.array([x for x, _ in out], pa.int64()), b=pa.array([y for _, y in out], pa.int64()))

        for batch in batches:
            for part in slices(batch):
                for row in zip(*(c.to_pylist() for c in part.columns)):
                    if group and row[:3] != group[0][:3]:
                        yield shut()
                        group = []
                    group.append(row)
        if group:
            yield shut()

    return map_arrow(dealt, run, "a bigint, b bigint").distinct()


def shared_columns(reps: DataFrame) -> DataFrame:
    """(row, hs array<bigint>, k): the kept columns of each row of ``reps`` (row, kept) that some other row has
    too.  Most columns are one row's alone, so all that travels of them is the column and its row."""
    meeting = reps.select("row", F.explode("kept").alias("h"))
    shared = meeting.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("h"))).where("df > 1").drop("df")
    return shared.groupBy("row").agg(F.collect_list("h").alias("hs")).withColumn("k", F.size("hs").cast("bigint"))


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, that stay when of each group of near duplicates the smallest
    doc_id stays.  Of rows that repeat a doc_id the one with the smallest text stays; rows without a doc_id
    stay."""
    found = jaccard_components(docs, size, percent, id_col, text_col)
    gone_col, twice_col, nth_col = free_names(docs, "__gone", "__twice", "__n")
    gone = reliable_checkpoint(found.where("doc_id <> component_id").select(F.col("doc_id").alias(gone_col)))
    side = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone.hint("shuffle_hash")
    left = docs.join(side, docs[id_col].cast("bigint") == F.col(gone_col), "left_anti")
    twice = reliable_checkpoint(docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias(twice_col))
                                .agg(F.count(F.lit(1)).alias(nth_col)).where(F.col(nth_col) > 1).select(twice_col))
    if twice.isEmpty():
        return left
    again = left[id_col].cast("bigint") == F.col(twice_col)
    first = Window.partitionBy(id_col).orderBy(text_col, F.xxhash64(*docs.columns))
    return (left.join(twice, again, "left_anti")
            .unionByName(left.join(twice, again, "left_semi").withColumn(nth_col, F.row_number().over(first)).where(F.col(nth_col) == 1).drop(nth_col)))


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id",
                       text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, class_id and n_tree_links of every document.  component_id is the
    smallest doc_id reachable by links, class_id the smallest with the very same set, n_tree_links the
    links of the class that were used (enough to tie the component together, not all there are)."""
    rows = id_text(docs, id_col, text_col).where("doc_id is not null")
    sets = reliable_checkpoint(shingle_sets(rows, size, percent))
    # Of each class the row of the smallest doc_id, in one exchange that is combined before it.
    reps = reliable_checkpoint(sets.where("n > 0").groupBy("s1", "s2", "n").agg(F.min(F.struct("doc_id", "common", "e", "kept")).alias("r"))
                               .select(F.monotonically_increasing_id().alias("row"), "s1", "s2", "n", F.col("r.doc_id").alias("rep"), "r.common", "r.e", "r.kept"))
    member = reliable_checkpoint(sets.select("doc_id", "n", "s1", "s2").distinct().join(reps.select("s1", "s2", "n", "rep"), ["s1", "s2", "n"], "left")
                                 .select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")))
    # A doc_id that is repeated with other texts joins their classes.
    same = member.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    # k: kept columns that some other row has too; rows with too few to reach the threshold go.  A row has its own
    # number, as texts that repeat a doc_id share a rep.
    rich = reliable_checkpoint(shared_columns(reps).join(reps.select("row", "rep", "n", "common", "e"), "row")
                               .where(F.col("k") >= least_shared(F.col("n"), percent)).drop("row"))
    table = rich.select("rep", "n", "common", "e", "k", F.explode("hs").alias("h"))
    pivot = table.groupBy("h").agg(F.max(F.struct((F.col("common") / F.col("n")).alias("alike"), (F.col("k") / F.col("n")).alias("own"), (-F.col("rep")).alias("first"), "rep", "n", "k", "e")).alias("p"))
    star = (table.alias("y").join(pivot.select("h", "p.rep", "p.n", "p.k", "p.e").alias("x"), "h")
            .where((F.col("x.rep") != F.col("y.rep")) & _can_reach(percent, F.least("x.k", "y.k")))
            .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct())
    star = reliable_checkpoint(star)
    cols = column_sets(star.select(F.col("a").alias("doc_id")).unionByName(star.select(F.col("b").alias("doc_id"))), rows, size)
    near = reliable_checkpoint(overlaps(star, cols, min(FAMILY_PERCENT, percent)))
    # Overlaps are compared in whole numbers, so the rounded percentage is no second opinion on the threshold.
    links = near.where(F.col("percent") >= percent).select("a", "b")
    label = lambda c, name: c.select(F.col("node").alias("rep"), F.col("component").alias(name))
    labelled = reliable_checkpoint(
        rich.join(label(components(links), "component"), "rep", "left").join(label(components(near), "family"), "rep", "left")
        .select("hs", "rep", "n", "k", "e", F.coalesce("component", "rep").alias("component"), F.coalesce("family", "rep").alias("family")))
    placed = labelled.select(F.explode("hs").alias("h"), "rep", "n", "k", "e", "component", "family")
    member_of = labelled.select(F.col("rep").alias("doc_id"), "family", "component", "n").distinct()
    split = member_of.groupBy("family").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("family")
    within = reliable_checkpoint(family_links(reliable_checkpoint(member_of.join(split, "family")), cols, percent))
    open_ = placed.groupBy("h").agg(F.min("family").alias("lo"), F.max("family").alias("hi")).where("lo <> hi").select("h")
    left = reliable_checkpoint(placed.join(open_, "h"))
    x, y = left.alias("x"), left.alias("y")
    met = (x.join(y, (F.col("x.h") == F.col("y.h")) & (F.col("x.rep") < F.col("y.rep")) & (F.col("x.family") != F.col("y.family"))
                  & _can_reach(percent, F.least("x.k", "y.k")))
           .groupBy(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"), F.struct(F.col("x.n").alias("n"), F.col("x.e").alias("e")).alias("x"), F.struct(F.col("y.n").alias("n"), F.col("y.e").alias("e")).alias("y")).agg(F.count(F.lit(1)).alias("c")))
    across = reliable_checkpoint(met.where(_can_reach(percent, F.col("c"))).select("a", "b").distinct())
    more = within
    if not across.isEmpty():
        far = column_sets(across.select(F.col("a").alias("doc_id")).unionByName(across.select(F.col("b").alias("doc_id"))), rows, size)
        more = within.unionByName(reliable_checkpoint(overlaps(across, far, percent).select("a", "b")))
    every = links.unionByName(more).distinct()
    final = components(every.unionByName(same))
    degree = every.unionByName(every.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.count(F.lit(1)).alias("n_tree_links"))
    out = member.groupBy("doc_id").agg(F.max("n").alias("n_shingles"), F.min("rep").alias("class_id"))
    return (out.join(final, out["doc_id"] == final["node"], "left").join(degree, F.col("class_id") == F.col("a"), "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), "class_id",
                    F.coalesce("n_tree_links", F.lit(0).cast("bigint")).alias("n_tree_links")))
