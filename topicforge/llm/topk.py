"""Operator 10: exact top-k search by sorted lists without random access.

Vectors of whole numbers; the score is the inner product, so a candidate's score is a sum with one part for
each dimension, and a dimension's list of candidates, sorted by component, is the list of parts sorted from
the best (read from one end for a positive query component, from the other for a negative one).  A block of
candidates is sorted into its lists once; queries then stream through it.  For a query the lists are read in
order, a run at a time: each round reads every list down to a common level of what it can still give, so lists
that matter little to the query are hardly read.  The parts met are added up by candidate: that sum plus the
least the other lists can give is a candidate's lower bound, that sum plus what the others still give at their
reading positions its upper bound.  Candidates whose upper bound is under the k-th best lower bound are
dropped; reading stops when few are left or the lists end, and only their scores are resolved from the vectors.

Candidates are dealt to blocks by a hash of their content, after rows equal in id and vector have become one
with a count, so no row repeated often fills a block.  Each block gets every query in rows sorted behind its
candidates: a task holds one block and one batch of queries.  A block returns at most k rows a query, and the
k best of these are exact.

Defined results: a vector that is null or holds a null or non-finite component takes no part, as query or as
candidate; all vectors must have one length, others are an error; ties go to the smaller id; a repeated id
is a candidate for each of its rows, but never for its own queries; query rows equal in id and vector are one
query, those of one id with different vectors are queries of their own, told apart by ``query_key`` (a hash of
the vector); fewer candidates give fewer rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from topicforge.llm.batches import map_arrow, record
from topicforge.session import reliable_checkpoint

#: Candidates in a block; a small table is dealt over all cores in blocks of at least ``LEAST`` on average.
BLOCK, LEAST = 16_384, 1024
#: A round reads the lists down to this share of what they could give in the round before.
FALL = 0.6


class SortedLists:
    """The vectors of a block and, for each dimension, the list of its candidates from the smallest
    component to the largest."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray):
        self.ids, self.copies, self.vectors = ids, copies, vectors
        self.n, self.size = vectors.shape
        self.lists = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32))
        self.sorted = np.take_along_axis(np.ascontiguousarray(vectors.T), self.lists, axis=1)
        #: Entries of lists read, of all queries.
        self.read = 0

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best of the block for a query, its own id left out."""
        left = np.flatnonzero(self.ids != own)
        if len(left) == 0:
            return self.ids[:0], np.zeros(0, dtype=np.int64)
        used = np.flatnonzero(query)  # a list under a zero gives nothing to anyone
        weight, rising = query[used], query[used] < 0
        ends = self.sorted[used][:, [0, -1]] * weight[:, None]
        least, ahead = ends.min(axis=1), ends.max(axis=1) - ends.min(axis=1)
        depth = np.zeros(len(used), dtype=np.int64)
        gain = np.zeros(self.n, dtype=np.int64)  # parts met, each beyond the least of its list
        met = np.zeros(self.n, dtype=np.int32)
        level, kk, few = float(ahead.max(initial=0)), min(k, len(left)), max(4 * k, self.n // 64)
        while len(left) > few and ahead.any():
            level *= FALL
            for j in np.flatnonzero(ahead > int(level)):
                ahead[j], depth[j] = self._run(used[j], int(weight[j]), rising[j], int(least[j]), int(depth[j]), int(level), gain, met)
            bar = np.partition(gain[left], len(left) - kk)[len(left) - kk]
            # What the lists not met can still give: all but as many of the smallest among those begun.
            begun = np.sort(ahead[depth > 0])
            spared = np.concatenate([[0], np.cumsum(begun)])
            left = left[gain[left] + ahead.sum() - spared[met[left]] >= bar]  # an equal score may win by its id
        self.read += int(depth.sum())
        scores = self.vectors[left] @ query
        best = np.lexsort((self.ids[left], -scores))[:k]
        best = np.repeat(best, self.copies[left[best]])[:k]
        return self.ids[left[best]], scores[best]

    def _run(self, d: int, weight: int, rising: bool, least: int, depth: int, level: int, gain: np.ndarray, met: np.ndarray) -> tuple[int, int]:
        """Reads on in list ``d`` until what comes next gives no more than ``level`` beyond the least; returns
        what it then gives and the depth reached.  The run is read in the order of memory, which ends no sooner."""
        row, n = self.sorted[d], self.n
        if rising:  # value * weight > level + least while value < (level + least) / weight
            end = int(np.searchsorted(row, -(-(level + least) // weight), side="left"))
            run, after = slice(depth, end), row[end] if end < n else None
        else:
            end = n - int(np.searchsorted(row, (level + least) // weight, side="right"))
            run, after = slice(n - end, n - depth), row[n - end - 1] if end < n else None
        who = self.lists[d, run]
        gain[who] += row[run] * weight - least
        met[who] += 1
        return (0 if after is None else int(after) * weight - least), end


def whole_vectors(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str, scale: int, k: int) -> DataFrame:
    """(vec_id, v array<bigint>, copies, is_query): components as floor(scale * x), x as double; rows that take
    part, equal ones as one with their count (k at most, as more cannot be among the k best)."""
    x = F.col(vector_col)
    sound = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.where(F.coalesce(sound, F.lit(False)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"))
    return rows.groupBy("vec_id", "v").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies"), F.max("is_query").alias("is_query"))


def _matrix(v: pa.ListArray) -> np.ndarray:
    size = set(np.diff(v.offsets.to_numpy()).tolist())
    if len(size) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(size)}")
    return v.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(v), -1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, bool, np.ndarray, np.ndarray, np.ndarray, pa.ListArray]]:
    """(block, asks, ids, copies, keys, vectors) for each run of rows of one block and one kind."""
    block, asks, ids, copies, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in range(5))
    cuts = np.flatnonzero((block[1:] != block[:-1]) | (asks[1:] != asks[:-1])) + 1
    for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if hi > lo:
            yield int(block[lo]), bool(asks[lo]), ids[lo:hi], copies[lo:hi], keys[lo:hi], batch.column(5).slice(lo, hi - lo)


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = 1024, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """query_id, query_key, rank (from 1), vec_id, score: the k best of all other rows for each row with
    ``is_query``.  Candidates move once; each query goes to every block, as the task asks."""
    rows = reliable_checkpoint(whole_vectors(vectors, is_query, id_col, vector_col, scale, k))
    n = rows.count()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, -(-n // BLOCK), min(cores, n // LEAST))
    block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int")
    key = F.xxhash64("v").alias("key")
    candidates = rows.select(block.alias("block"), F.lit(False).alias("asks"), "vec_id", "copies", key, "v")
    queries = rows.where("is_query").select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), "vec_id", "copies", key, "v")
    dealt = candidates.unionByName(queries).repartition(blocks, "block").sortWithinPartitions("block", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, lists = None, [], None
        for batch in batches:
            for number, asks, ids, copies, keys, v in _runs(batch):
                if number != at:
                    at, parts, lists = number, [], None
                if not asks:
                    parts.append((ids, copies, v))
                    continue
                if lists is None:
                    if not parts:  # a block without candidates
                        continue
                    lists = SortedLists(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
                                        _matrix(pa.concat_arrays([p[2] for p in parts])))
                    parts = []
                asked = _matrix(v)
                if asked.shape[1] != lists.size:
                    raise ValueError("vectors of different lengths")
                found = [lists.search(q, own, k) for own, q in zip(ids, asked)]
                size = [len(f[0]) for f in found]
                yield record(query_id=pa.array(np.repeat(ids, size)), query_key=pa.array(np.repeat(keys, size)),
                             vec_id=pa.array(np.concatenate([f[0] for f in found])), score=pa.array(np.concatenate([f[1] for f in found])))

    found = map_arrow(dealt, run, "query_id bigint, query_key bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "query_key", "rank", "vec_id", "score")
